"""CSV input with an explicit schema, audit columns and the ingest job."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from granary.operators.flagging import VALID, TableSpec, flag, valid_counts
from granary.sources.tables import PARTITION_FORMATS, Layout, measured_layout, write_folder, write_table

DATE_FORMAT = "yyyy-MM-dd"
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
FILE_AUDIT = ("_source_path", "_source_modified")


def read_csv(spark: SparkSession, path: str, spec: TableSpec, header: bool = True,
             check_header: bool = False) -> DataFrame:
    """Read any Hadoop path with the spec's schema; a bad cell becomes NULL, its row stays.

    Columns are matched by position. With `check_header` the file's own names are
    compared with the expected ones first, so a source that moves columns fails.
    """
    reader = (
        spark.read.option("header", header)
        .option("dateFormat", DATE_FORMAT)
        .option("timestampFormat", TIMESTAMP_FORMAT)
    )
    if not check_header:
        return reader.schema(spec.schema).csv(path)
    headers = spec.header or tuple(spec.names)
    expected = StructType([StructField(header_name, column.dataType)
                           for header_name, column in zip(headers, spec.schema)])
    by_name = reader.option("enforceSchema", False).schema(expected).csv(path)
    return by_name.withColumnsRenamed(dict(zip(headers, spec.names)))


def with_audit(df: DataFrame, source_file: str) -> DataFrame:
    """Technical columns, after the flag columns."""
    return df.withColumns({"_source_file": F.lit(source_file), "_ingested_at": F.current_timestamp()})


def bronze_from(df: DataFrame, spec: TableSpec, source_file: str) -> DataFrame:
    return with_audit(flag(df, spec), source_file)


def with_file_audit(df: DataFrame) -> DataFrame:
    """The file each row was read from and when that was last changed; `df` comes straight from a file scan."""
    path, modified = FILE_AUDIT
    return df.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.file_modification_time").alias(modified))


def _read_bronze(spark: SparkSession, spec: TableSpec, source: str, file_audit: bool, csv_options: dict) -> DataFrame:
    raw = read_csv(spark, source, spec, **csv_options)
    bronze = with_audit(flag(with_file_audit(raw), spec, FILE_AUDIT), source) if file_audit else bronze_from(raw, spec, source)
    if bronze.isEmpty():  # before anything is written: the old table stays
        raise ValueError(f"{source} gave no rows; are its files hidden by a leading '_' or '.'?")
    return bronze


def ingest(spark: SparkSession, spec: TableSpec, source: str, target: str,
           write: Callable[..., DataFrame] = write_folder, file_audit: bool = False, observe: tuple | None = None,
           **csv_options) -> DataFrame:
    """CSV to a bronze table in the spec's layout; source and target are free to choose.

    `write` is `write_folder`, `write_table` or `write_iceberg`. A plain folder
    cannot record buckets, so bucketed specs go there without them. `observe`
    takes figures of the written rows, see `observed_report`.
    """
    bronze = _read_bronze(spark, spec, source, file_audit, csv_options)
    unbucketed = write is write_folder and spec.layout.kind == "bucket"
    extra = {"observe": observe} if observe else {}
    return write(bronze, target, Layout() if unbucketed else spec.layout, **extra)


def ingest_measured(spark: SparkSession, spec: TableSpec, source: str, target: str, table: str | None = None,
                    **csv_options) -> tuple[DataFrame, Layout, dict]:
    """CSV to bronze in the layout that the data call for; returns table, layout and the figures behind it.

    The rows are written plainly first and measured there; if that layout will
    do, they stay as they are. `table` names the catalog table that a bucketed
    result needs; without it buckets are left out. The spec tells which column
    holds the date or the join key.
    """
    bronze = _read_bronze(spark, spec, source, False, csv_options)
    plain = write_folder(bronze, f"{target.rstrip('/')}.measure")
    by_date = spec.layout.column if spec.layout.kind in PARTITION_FORMATS else None
    by_key = spec.layout.column if spec.layout.kind == "bucket" else None
    layout, figures = measured_layout(spark, f"{target.rstrip('/')}.measure", by_date, by_key)
    if layout.kind == "bucket":
        return (write_table(plain, table, layout, target) if table else write_folder(plain, target)), layout, figures
    return write_folder(plain, target, layout), layout, figures


def observed_counts(spec: TableSpec) -> list[Column]:
    """The figures of `ingest_report` as aggregates of the rows that are written."""
    notes = [F.count_if(F.col(name)).alias(f"{name.strip('_')}_rows") for name in spec.notes]
    return [F.count("*").alias("total_rows"), F.count_if(F.col(VALID)).alias("valid_rows"),
            F.count_if(~F.col(VALID)).alias("invalid_rows"), *notes]


def ingest_times(bronze: dict[str, DataFrame]) -> DataFrame:
    """Per table and source file: rows and the latest time they were ingested; needs `file_audit`."""
    parts = [df.groupBy("_source_path").agg(F.count("*").alias("num_rows"), F.max("_ingested_at").alias("last_ingested_at"),
                                            F.max("_source_modified").alias("source_modified"))
             .select(F.lit(name).alias("table_name"), "*") for name, df in bronze.items()]
    return reduce(DataFrame.unionByName, parts)


def ingest_report(bronze: DataFrame, spec: TableSpec) -> DataFrame:
    """Counts of one table in one pass, plus each informational flag."""
    counts = valid_counts(bronze, {f"{name.strip('_')}_rows": name for name in spec.notes})
    return counts.select(F.lit(spec.name).alias("table_name"), "*")
