"""Layouts measured at ingest, counts taken while writing, file audit, catalog models, dense keys."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from granary.operators.keys import UNKNOWN_MEMBER, extend_dictionary, with_dense_key
from granary.plans import pipeline
from granary.plans.silver import silver, silver_sql
from granary.sources import tables
from granary.sources.files import ingest, ingest_measured, ingest_report, ingest_times, observed_counts, read_csv
from granary.sources.specs import SPECS
from granary.sources.tables import Layout, measured_layout, write_folder


def _csv(lake, name, path, files=1):
    header = SPECS[name].header or SPECS[name].names
    lake.source(name).repartition(files).toDF(*header).write.option("header", True).option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def test_layout_follows_what_was_written(spark, tmp_path, monkeypatch):
    rows = spark.range(900).select("id", F.expr("date '2020-01-15' + cast(id % 90 as int)").alias("day"), (F.col("id") % 7).alias("k"))
    path = str(tmp_path / "rows")
    write_folder(rows, path)
    for name, value in (("MONTH_MIN_ROWS", 500), ("YEAR_MIN_ROWS", 100), ("MIN_PARTITION_BYTES", 10)):
        monkeypatch.setattr(tables, name, value)
    layout, figures = measured_layout(spark, path, "day")
    assert layout == Layout("month", "day") and figures["num_keys"] == 4 and figures["num_rows"] == 900
    assert figures["num_bytes"] > 1000
    monkeypatch.setattr(tables, "MIN_PARTITION_BYTES", 1 << 30)
    assert measured_layout(spark, path, "day")[0] == Layout("year", "day")
    assert measured_layout(spark, path, None, "id")[0].kind == "bucket"
    assert measured_layout(spark, path, None, "k")[0] == Layout()  # a key with a seventh of the rows overfills a bucket
    monkeypatch.setattr(tables, "BUCKET_BYTES", 100)
    assert measured_layout(spark, path, None, "id")[0].buckets > tables.DEFAULT_BUCKETS
    assert measured_layout(spark, path)[0] == Layout()
    write_folder(rows.limit(0), path)
    assert measured_layout(spark, path, "day")[0] == Layout()


def test_ingest_in_the_measured_layout(lake, spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "YEAR_MIN_ROWS", 10)
    source = _csv(lake, "customers", str(tmp_path / "csv"))
    table, layout, _ = ingest_measured(spark, SPECS["customers"], source, str(tmp_path / "bronze"))
    assert layout == Layout("year", "signup_date") and "_year" in table.columns
    assert table.count() == lake.source("customers").count()


def test_counts_are_taken_while_writing(lake, spark, tmp_path):
    source = _csv(lake, "sales_daily", str(tmp_path / "csv"), 3)
    seen = Observation("seen")
    table = ingest(spark, SPECS["sales_daily"], source, str(tmp_path / "bronze"), observe=(seen, *observed_counts(SPECS["sales_daily"])))
    assert seen.get == ingest_report(table, SPECS["sales_daily"]).drop("table_name").first().asDict()
    _, report = pipeline.ingest_all(spark, {"sales_daily": source}, lambda name: str(tmp_path / name))
    assert report.first() == ingest_report(table, SPECS["sales_daily"]).select(report.columns).first()


def test_file_audit(lake, spark, tmp_path):
    source = _csv(lake, "customers", str(tmp_path / "csv"), 3)
    table = ingest(spark, SPECS["customers"], source, str(tmp_path / "bronze"), file_audit=True)
    times = ingest_times({"customers": table}).collect()
    assert len(times) == 3 and sum(r.num_rows for r in times) == lake.source("customers").count()
    assert all(r.source_modified <= r.last_ingested_at and "part-" in r._source_path for r in times)


def test_catalog_models_outlive_the_session(lake, spark, tmp_path):
    spark.sql(f"CREATE NAMESPACE shop LOCATION '{tmp_path}/shop'")
    bronze = {name: lake.bronze(name) for name in ("products", "promotions", "order_items")}
    pipeline.publish_catalog(spark, "shop", bronze, {"dim_product": lake.dim_product})
    other = spark.newSession()
    for name in bronze:
        assert sorted(map(repr, other.table(f"shop.silver_{name}").collect())) == sorted(map(repr, lake.silver(name).collect()))
    before = other.table("shop.dim_product").count()
    tables.write_table(lake.bronze("products").filter("product_id < 50"), "shop.bronze_products")
    other = spark.newSession()  # the old one remembers the files it read
    assert other.table("shop.silver_products").count() < before == other.table("shop.dim_product").count()
    pipeline.publish_catalog(spark, "shop", bronze, {})  # a second run replaces views and tables
    other = spark.newSession()
    assert other.table("shop.silver_products").count() == lake.silver("products").count()


@pytest.mark.parametrize("name", sorted(SPECS))
def test_silver_text_is_the_silver_plan(lake, spark, name):
    lake.bronze(name).createOrReplaceTempView("bronze_here")
    assert spark.sql(silver_sql(name, "bronze_here")).schema == silver(name, lake.bronze(name)).schema


def test_dense_keys_stay_and_grow_without_gaps(lake, spark):
    def members(*names):
        return spark.createDataFrame([(n,) for n in names], "name string").repartition(4)

    first = extend_dictionary(None, members("d", "b", None, "b"), ["name"], lake.stored)
    assert {r.name: r.sk for r in first.collect()} == {"b": 1, "d": 2}
    second = extend_dictionary(first, members("a", "b", "c", None, "e"), ["name"], lake.stored)
    assert {r.name: r.sk for r in second.collect()} == {"b": 1, "d": 2, "a": 3, "c": 4, "e": 5}
    third = extend_dictionary(second, members("a"), ["name"], lake.stored)
    assert sorted(third.collect()) == sorted(second.collect())
    facts = with_dense_key(members("a", None, "zzz", "d"), third, ["name"], "name_sk")
    assert {r.name: r.name_sk for r in facts.collect()} == {"a": 3, None: UNKNOWN_MEMBER, "zzz": UNKNOWN_MEMBER, "d": 2}
    empty = extend_dictionary(None, members("a").limit(0), ["name"], lake.stored)
    assert empty.count() == 0 and {r.sk for r in extend_dictionary(empty, members("x", "y"), ["name"], lake.stored).collect()} == {1, 2}
    many = extend_dictionary(None, spark.range(5000).select(F.xxhash64("id").alias("k")), ["k"], lake.stored)
    assert sorted(r.sk for r in many.select("sk").collect()) == list(range(1, 5001))


def test_ingest_report_reads_packed_exports(lake, spark, monkeypatch):
    """Plain text was more than half of all bytes the query wrote."""
    from granary.plans import registry

    seen = {}
    monkeypatch.setattr(registry, "SPECS", {name: SPECS[name] for name in ("promotions", "orders")})
    monkeypatch.setattr(registry.pipeline, "ingest_all", lambda spark, files, target_of: (seen.update(files), None))
    registry.QUERIES["ingest_report"](lake)
    for name, folder in seen.items():
        paths = spark.read.format("binaryFile").load(folder).select("path").collect()
        assert paths and all(row.path.endswith(".csv.gz") for row in paths)
        assert read_csv(spark, folder, SPECS[name]).count() == lake.source(name).count()
