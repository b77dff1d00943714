"""The whole way from 13 CSV sources to checked gold tables."""

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark.sql import DataFrame, Observation, SparkSession

from granary.plans.build import build
from granary.plans.silver import silver_sql
from granary.sources.files import ingest, ingest_report, observed_counts
from granary.sources.specs import SPECS
from granary.sources.tables import create_namespace, write_folder, write_table

JOBS_AT_ONCE = 4


def ingest_all(spark: SparkSession, sources: dict[str, str], target_of: Callable[[str], str],
               write: Callable = write_folder, **csv_options) -> tuple[dict[str, DataFrame], DataFrame]:
    """Ingest the named CSV sources; returns the bronze tables and one report row for each.

    Folders and catalog tables are counted while they are written.

    The tables do not depend on each other, so a few are loaded side by side:
    the many small ones would leave the cluster idle one after another.
    """
    seen = {name: Observation(f"ingest-{name}") for name in sources}

    def load(name: str) -> DataFrame:
        observe = (seen[name], *observed_counts(SPECS[name])) if counted else None
        return ingest(spark, SPECS[name], sources[name], target_of(name), write, observe=observe, **csv_options)

    counted = write in (write_folder, write_table)  # these count the rows as they write them
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        bronze = dict(zip(sources, pool.map(load, sources)))
    if not counted:
        parts = [ingest_report(table, SPECS[name]) for name, table in bronze.items()]
        return bronze, reduce(partial(DataFrame.unionByName, allowMissingColumns=True), parts)
    figures = {name: observation.get for name, observation in seen.items()}
    columns = list(dict.fromkeys(column for row in figures.values() for column in row))
    schema = ", ".join(["table_name string", *[f"{column} bigint" for column in columns]])
    rows = [(name, *[row.get(column) for column in columns]) for name, row in figures.items()]
    return bronze, spark.createDataFrame(rows, schema)


def publish_catalog(spark: SparkSession, database: str, bronze: dict[str, DataFrame], gold: dict[str, DataFrame]) -> None:
    """Bronze and gold as catalog tables, silver as views on bronze: what other sessions find by name.

    A silver view is SQL text, so it follows its bronze table; gold stays as built.
    """
    create_namespace(spark, database)
    for name, df in bronze.items():
        write_table(df, f"{database}.bronze_{name}")
        spark.sql(f"CREATE OR REPLACE VIEW {database}.silver_{name} AS {silver_sql(name, f'{database}.bronze_{name}')}")
    for name, df in gold.items():
        write_table(df, f"{database}.{name}")


def publish(frames: dict[str, DataFrame]) -> None:
    """Make models known to SQL by name; views are computed anew by each reader."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def run(spark: SparkSession, sources: dict[str, str], target: str, calendar: tuple[str, str],
        **csv_options) -> tuple[DataFrame, DataFrame]:
    """Ingest, build and publish below the folder `target`; returns both reports.

    `calendar` is the first day of the date dimension and the day after its last.
    """
    bronze, ingested = ingest_all(spark, sources, lambda name: f"{target}/bronze/{name}", **csv_options)
    report, _, frames = build(spark, bronze, calendar,
                           lambda df, name: write_folder(df, f"{target}/gold/{name}"))
    publish({f"bronze_{name}": table for name, table in bronze.items()})
    publish({name: df for name, df in frames.items() if name not in bronze})
    return ingested, report
