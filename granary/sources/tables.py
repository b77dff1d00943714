"""Table layouts, idempotent writers, upsert and date-pruned reads."""

from dataclasses import dataclass
from math import ceil
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Row counts and the partition size at which a layout changes.
MONTH_MIN_ROWS = 500_000
YEAR_MIN_ROWS = 40_000
MIN_PARTITION_BYTES = 1 << 20
DEFAULT_BUCKETS = 16

BUCKET_BYTES = 512 << 20
PARTITION_FORMATS = {"month": "yyyy-MM", "year": "yyyy"}


@dataclass(frozen=True)
class Layout:
    """plain; month or year of a date column; or hash buckets of a join key."""

    kind: str = "plain"
    column: str | None = None
    buckets: int = DEFAULT_BUCKETS

    @property
    def partition(self) -> str:
        return f"_{self.kind}"


def choose_layout(rows: int, size_bytes: int, date_column: str | None = None, date_months: int = 0,
                  join_key: str | None = None, hottest_share: float = 0.0) -> Layout:
    """Pick the finest layout that still gives partitions of a useful size.

    The number of buckets follows the size, so one bucket stays one task's work.
    A table whose hottest key overfills a bucket stays plain: one task reads a
    whole bucket, while `skew_join` can split the rows of a plain table.
    """
    if date_column:
        if rows > MONTH_MIN_ROWS and size_bytes >= max(date_months, 1) * MIN_PARTITION_BYTES:
            return Layout("month", date_column)
        if rows >= YEAR_MIN_ROWS:
            return Layout("year", date_column)
    elif join_key and rows >= YEAR_MIN_ROWS:
        buckets = max(DEFAULT_BUCKETS, ceil(size_bytes / BUCKET_BYTES))
        if hottest_share <= 1 / buckets:
            return Layout("bucket", join_key, buckets)
    return Layout()


def measured_layout(spark: SparkSession, path: str, date_column: str | None = None,
                    join_key: str | None = None) -> tuple[Layout, dict]:
    """The layout that the written parquet folder at `path` calls for, and the figures it was chosen by.

    Bytes are those of the files. Rows, months and the rows of the most frequent
    key come from one scan of one column.
    """
    column = date_column or join_key
    table = spark.read.parquet(path)
    key = F.trunc(F.col(date_column), "month") if date_column else F.col(join_key) if join_key else F.lit(0)
    counts = table.groupBy(key.alias("k")).agg(F.count("*").alias("n"))
    row = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count_if(F.col("k").isNotNull()).alias("keys"),
                     F.coalesce(F.max("n"), F.lit(0)).alias("hottest")).first()
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    figures = {"num_rows": row["rows"], "num_keys": row["keys"] if column else 0, "hottest_rows": row["hottest"] if column else 0,
               "num_bytes": files.getContentSummary(folder).getLength()}
    share = row["hottest"] / row["rows"] if row["rows"] else 0.0
    return choose_layout(row["rows"], figures["num_bytes"], date_column, row["keys"] if date_column else 0, join_key,
                         share), figures


def create_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}")


def _laid_out(df: DataFrame, layout: Layout) -> DataFrame:
    """Gather the rows of a partition or bucket, so that each gets few files.

    REBALANCE does so without one task per value: AQE splits a month or bucket
    that holds a third of the table and merges the small ones. Plain tables
    are written as they come.
    """
    if layout.kind in PARTITION_FORMATS:
        label = F.date_format(layout.column, PARTITION_FORMATS[layout.kind])
        return df.withColumn(layout.partition, label).hint("rebalance", layout.partition)
    if layout.kind == "bucket":
        return df.hint("rebalance", layout.buckets, layout.column)
    return df


def _writer(df: DataFrame, layout: Layout, observe: tuple | None = None):
    laid = _laid_out(df, layout)
    if observe:  # above the exchange: there each row is counted once, also if executors are lost
        laid = laid.observe(*observe)
    writer = laid.write.mode("overwrite").format("parquet")
    if layout.kind in PARTITION_FORMATS:
        return writer.partitionBy(layout.partition)
    if layout.kind == "bucket":
        return writer.bucketBy(layout.buckets, layout.column).sortBy(layout.column)
    return writer


def write_folder(df: DataFrame, path: str, layout: Layout = Layout(), observe: tuple | None = None) -> DataFrame:
    """Replace a parquet folder and return it; a re-run gives the same rows.

    `observe` is an Observation and the aggregates it takes of the rows written. The rows go to a new folder beside it, which takes its place once it is
    complete. A write that fails leaves the old folder as it was.
    """
    if layout.kind == "bucket":
        raise ValueError("buckets are kept in the catalog: use write_table")
    spark = df.sparkSession
    fresh = f"{path.rstrip('/')}.new-{uuid4().hex}"
    _writer(df, layout, observe).save(fresh)
    _take_place(spark, fresh, path)
    return spark.read.parquet(path)


def _take_place(spark: SparkSession, fresh: str, path: str) -> None:
    """Rename the complete folder `fresh` to `path`; the old one is set aside first and deleted last."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    target, aside = hadoop.Path(path), hadoop.Path(f"{path.rstrip('/')}.old-{uuid4().hex}")
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    had = files.exists(target)
    if had and not files.rename(target, aside):
        raise OSError(f"{path} cannot be set aside")
    if not files.rename(hadoop.Path(fresh), target):
        if had:
            files.rename(aside, target)
        raise OSError(f"{path} cannot be replaced")
    if had:
        files.delete(aside, True)


def write_table(df: DataFrame, name: str, layout: Layout = Layout(), path: str | None = None,
                observe: tuple | None = None) -> DataFrame:
    """Replace a catalog table and return it."""
    writer = _writer(df, layout, observe)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def write_iceberg(df: DataFrame, name: str, layout: Layout = Layout()) -> DataFrame:
    """Replace a table of a configured Iceberg catalog, with hidden partitioning."""
    writer = df.writeTo(name).using("iceberg").tableProperty("format-version", "2")
    if layout.kind == "month":
        writer = writer.partitionedBy(F.partitioning.months(layout.column))
    elif layout.kind == "year":
        writer = writer.partitionedBy(F.partitioning.years(layout.column))
    elif layout.kind == "bucket":
        writer = writer.partitionedBy(F.partitioning.bucket(layout.buckets, layout.column))
    writer.createOrReplace()
    return df.sparkSession.table(name)


def append_run(df: DataFrame, path: str, run_id: str) -> None:
    """Append one run's rows; repeating the same run replaces its own rows only."""
    (df.withColumn("_run_id", F.lit(run_id))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("_run_id").parquet(path))


def upsert(base: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `changes` replace base rows with the same keys; new keys are added.

    A key that `changes` holds twice is an error, as no row of the two is the newer.
    Write the result to a new folder, never over the one `base` is read from.
    """
    twice = changes.groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"changes repeat the key {tuple(twice[0])[:-1]}")
    changed = changes.select(*keys).distinct()
    return base.join(changed, keys, "left_anti").unionByName(changes)


def between_dates(df: DataFrame, layout: Layout, low: str, high: str) -> DataFrame:
    """Days low to high, both included, pruned to the partitions that can hold them."""
    day = F.col(layout.column)
    wanted = df.filter(day.between(F.lit(low).cast("date"), F.lit(high).cast("date")))
    if layout.kind not in PARTITION_FORMATS:
        return wanted
    width = len(PARTITION_FORMATS[layout.kind])
    return wanted.filter(F.col(layout.partition).cast("string").between(low[:width], high[:width]))
