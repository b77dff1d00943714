"""Helpers the operators share: input, stored intermediates, words, ordinals, components."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from granary.session import scratch_dir

# The white space of the contracts, as Java and Python regexes.
GAP = r"[\x20\x09-\x0D]"
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Cut the lineage with a table in the shared folder; every reader sees the same rows."""
    path = scratch_dir(df.sparkSession, f"llm-{purpose}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def word_count(text: Column) -> Column:
    """Runs of characters outside `GAP`; the empty text has none."""
    pieces = F.size(F.split(text, GAP + "+", -1))
    edges = sum(F.when(F.regexp_like(text, F.lit(end)), 1).otherwise(0) for end in ("^" + GAP, GAP + "\\z"))
    return F.when(text == "", 0).otherwise(pieces - edges).cast("long")


def unit(*columns: Column | str) -> Column:
    """A number in (0, 1) that depends on the columns' values only."""
    bits = F.shiftrightunsigned(F.xxhash64(*columns), 11)
    return (bits.cast("double") + 0.5) / float(1 << 53)


def literal_array(values: list[int]) -> Column:
    """A constant array; the optimizer folds it once."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<int>")


def ordinals(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Number the rows from 0 in the given order, without one task that sorts them all.

    Range partitions are sorted apart and stored; only their row counts, one
    per partition, meet in one place.
    """
    parted = df.repartitionByRange(*order).sortWithinPartitions(*order)
    parted = stored(parted.withColumns({"_part": F.spark_partition_id(),
                                        "_at": F.monotonically_increasing_id()}), "ordinals")
    parted = parted.withColumn("_at", F.col("_at") - F.shiftleft(F.col("_part").cast("long"), 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = parted.groupBy("_part").agg(F.count("*").alias("_n"))
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return parted.join(starts, "_part").withColumn(name, F.col("_start") + F.col("_at")).drop("_part", "_at", "_start")


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for each node that has a link; root is the smallest node it can reach.

    Alternating star contraction: every round links neighbours to the smallest
    node each sees, until nothing changes. Rounds are stored, no group is
    gathered, nothing but two numbers a round comes to the driver.
    """
    links = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .filter("a <> b").distinct(), "links")
    mark = None
    for _ in range(most_rounds):
        both = links.union(links.select("b", "a")).toDF("node", "other")
        lowest = both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("low"))
        large = (both.filter("other > node").join(lowest, "node")
                 .select(F.col("other").alias("a"), F.col("low").alias("b")).filter("a <> b").distinct())
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (large.join(lowest, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("low").alias("b")),
            F.struct("a", F.col("low").alias("b")))).alias("e")).select("e.*").filter("a <> b").distinct())
        links = stored(small, "links")
        seen = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if seen == mark:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                links.select("b", "b").distinct())
        mark = seen
    raise RuntimeError("the components did not settle")
