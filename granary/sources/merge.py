"""Upsert that rewrites only the partitions a change set touches, guarded by a stored hash of each row."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.session import scratch_dir
from granary.sources.tables import PARTITION_FORMATS, Layout, write_folder

ROW_HASH = "_row_hash"


def row_hash(columns: list[str]) -> Column:
    """Changes if any of the columns does; a NULL differs from every value and keeps its place."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)


def write_hashed(df: DataFrame, path: str, layout: Layout) -> DataFrame:
    """A partitioned folder that `upsert_partitions` can change."""
    return write_folder(df.withColumn(ROW_HASH, row_hash(df.columns)), path, layout)


def _check_keys(changes: DataFrame, keys: list[str]) -> None:
    no_key = changes.filter(" or ".join(f"{key} is null" for key in keys)).limit(1).collect()
    twice = changes.groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if no_key or twice:
        raise ValueError(f"changes hold a NULL or repeated key: {tuple((no_key or twice)[0])}")


def upsert_partitions(spark: SparkSession, path: str, changes: DataFrame, keys: list[str], layout: Layout) -> list[str | None]:
    """Apply `changes` to a folder of `write_hashed`; returns the partitions that were written anew.

    Rows whose stored hash is the same are no changes, so a repeated run finds
    nothing to do. The others touch the partition they go to and those that hold
    their key now, which a scan of keys, hashes and partition values tells. Only
    these partitions are read whole and replaced; all other files stay. A row
    that moves to another partition leaves the old one, which goes if it is empty.

    The new partitions are complete in the scratch folder before any is replaced,
    so a run that breaks off before leaves the table as it was; one that breaks
    off between two partitions is mended by running it again. One run at a time.
    """
    if layout.kind not in PARTITION_FORMATS:
        raise ValueError("partition-wise upsert needs a month or year layout")
    label, columns = layout.partition, changes.columns
    new = write_folder(changes.withColumns({
        label: F.date_format(layout.column, PARTITION_FORMATS[layout.kind]), ROW_HASH: row_hash(columns)}),
        scratch_dir(spark, "upsert-changes"))
    _check_keys(new, keys)
    table = spark.read.parquet(path)
    table = table.withColumn(label, F.col(label).cast("string"))

    held = table.select(*keys, F.col(label).alias("_label"), F.col(ROW_HASH).alias("_hash")).join(
        new.select(*keys), keys, "left_semi")
    found = write_folder(held, scratch_dir(spark, "upsert-held"))
    unchanged = found.groupBy(*keys).agg(F.count("*").alias("_n"), F.max("_hash").alias(ROW_HASH)).filter("_n = 1")
    changed = write_folder(new.join(unchanged.select(*keys, ROW_HASH), [*keys, ROW_HASH], "left_anti").select(new.columns),
                           scratch_dir(spark, "upsert-changed"))
    # As many values as the table has partitions at most.
    old_labels = found.join(changed.select(*keys), keys, "left_semi").select(F.col("_label").alias(label))
    touched = [row[0] for row in old_labels.union(changed.select(label)).distinct().collect()]
    if not touched:
        return []

    named = F.col(label).isin([value for value in touched if value is not None])
    hit = named | F.col(label).isNull() if None in touched else named
    kept = table.filter(hit).join(changed.select(*keys), keys, "left_anti")
    fresh = write_folder(kept.unionByName(changed), scratch_dir(spark, "upsert-partitions"))
    (fresh.hint("rebalance", label).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(label).parquet(path))
    left = {row[0] for row in fresh.select(label).distinct().collect()}
    _drop_partitions(spark, path, label, [value for value in touched if value not in left])
    return sorted(touched, key=str)


def _drop_partitions(spark: SparkSession, path: str, label: str, values: list[str | None]) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for value in values:
        folder = hadoop.Path(f"{path.rstrip('/')}/{label}={value or '__HIVE_DEFAULT_PARTITION__'}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
