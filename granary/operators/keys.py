"""Surrogate keys and junk dimensions."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN_MEMBER = -1


def surrogate_key(*natural: str) -> Column:
    """A 64-bit key from the natural key; no global numbering, so no single task.

    With an SCD2 dimension `natural` includes valid_from. A NULL natural key is
    the unknown member. Equal hashes of two members are possible beyond some
    10^9 rows, so the natural key stays beside it.
    """
    any_null = F.greatest(*[F.col(name).isNull() for name in natural]) if len(natural) > 1 \
        else F.col(natural[0]).isNull()
    return F.when(any_null, F.lit(UNKNOWN_MEMBER).cast("bigint")).otherwise(F.xxhash64(*natural))


def or_unknown(key: str) -> Column:
    """Facts point to the unknown member instead of holding a NULL key."""
    return F.coalesce(F.col(key), F.lit(UNKNOWN_MEMBER).cast("bigint"))


def junk_dimension(fact: DataFrame, attributes: list[str]) -> DataFrame:
    """The combinations that occur, how often, and one key for each."""
    combos = fact.groupBy(*attributes).agg(F.count("*").alias("num_rows"))
    return combos.select(F.xxhash64(*attributes).alias("junk_key"), "*")


def numbered(df: DataFrame, order: list[str], name: str, first: int, store: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Number the rows from `first` without gaps, in the given order.

    Each task numbers its range of rows; only the row counts of the ranges, one
    number per task, meet in one place. `store` writes the ranges, so that every
    later step sees the same ones.
    """
    ranges = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumns(
        {"_range": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    ranges = store(ranges.withColumn("_at", F.col("_at") - F.shiftleft(F.col("_range").cast("bigint"), 33)), "numbered")
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.groupBy("_range").agg(F.count("*").alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    return ranges.join(starts, "_range").withColumn(name, F.col("_start") + F.col("_at") + first).select(*df.columns, name)


def extend_dictionary(dictionary: DataFrame | None, members: DataFrame, natural: list[str],
                      store: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """The key dictionary (natural key, sk) with every member of `members`.

    Old members keep their keys; new ones get the next numbers without a gap, in
    the order of their natural keys, so a repeated run gives the same ones. A
    member whose natural key holds a NULL is the unknown one and gets none.
    """
    known = " and ".join(f"{name} is not null" for name in natural)
    fresh = members.filter(known).select(*natural).distinct()
    if dictionary is None:
        return numbered(fresh, natural, "sk", 1, store)
    last = dictionary.agg(F.coalesce(F.max("sk"), F.lit(0))).first()[0]
    added = numbered(fresh.join(dictionary.select(*natural), natural, "left_anti"), natural, "sk", last + 1, store)
    return store(dictionary.unionByName(added), "key-dictionary")


def with_dense_key(fact: DataFrame, dictionary: DataFrame, natural: list[str], name: str) -> DataFrame:
    """Facts with the member's number; the unknown member's where the dictionary has none."""
    keyed = fact.join(dictionary.select(*natural, F.col("sk").alias(name)), natural, "left")
    return keyed.withColumn(name, or_unknown(name))
