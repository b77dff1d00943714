"""CSV input, writers, layouts, upsert."""

import datetime

import pytest
from pyspark.sql import functions as F

from granary.operators.joins import hottest_share
from granary.sources.files import ingest, ingest_report, read_csv
from granary.sources.specs import SPECS
from granary.sources.tables import (Layout, append_run, between_dates, choose_layout, create_namespace, upsert,
                                    write_folder, write_table)


def _csv(tmp_path, text, name="sales.csv"):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_bad_cells_become_null_and_rows_stay(spark, tmp_path):
    path = _csv(tmp_path, "Date,Revenue,COGS\n2020-01-02,1.5,1\n2020-02-30,2,1\nxx,3,1\n2020-1-2,4,1\n,5,\"\"\n"
                          "2020-01-03,oops,1\n")
    rows = read_csv(spark, path, SPECS["sales_daily"]).collect()
    assert len(rows) == 6
    assert [row.sale_date for row in rows] == [datetime.date(2020, 1, 2), None, None, None, None,
                                               datetime.date(2020, 1, 3)]
    assert rows[4].cogs is None and rows[5].revenue is None


def test_position_ignores_names_and_header_check_catches_moves(spark, tmp_path):
    moved = _csv(tmp_path, "Revenue,Date,COGS\n2020-01-02,1.5,1\n")
    spec = SPECS["sales_daily"]
    assert read_csv(spark, moved, spec).first().revenue == 1.5
    with pytest.raises(Exception, match="CSV header"):
        read_csv(spark, moved, spec, check_header=True).collect()
    right = _csv(tmp_path, "Date,Revenue,COGS\n2020-01-02,1.5,1\n", "right.csv")
    assert read_csv(spark, right, spec, check_header=True).columns == spec.names


def test_ingest_twice_gives_the_same_rows(spark, tmp_path):
    path = _csv(tmp_path, "Date,Revenue,COGS\n2020-01-02,1.5,2\n2020-01-03,-1,1\n")
    for _ in range(2):
        bronze = ingest(spark, SPECS["sales_daily"], path, str(tmp_path / "bronze"))
    assert bronze.columns[-5:] == ["_invalid_reason", "_is_valid", "_margin_negative", "_source_file",
                                   "_ingested_at"]
    report = ingest_report(bronze, SPECS["sales_daily"]).first()
    assert tuple(report) == ("sales_daily", 2, 1, 1, 2)


def test_hidden_file_fails_loudly(spark, tmp_path):
    hidden = _csv(tmp_path, "Date,Revenue,COGS\n2020-01-02,1.5,2\n", "_sales.csv")
    with pytest.raises(Exception):
        ingest(spark, SPECS["sales_daily"], hidden, str(tmp_path / "out"))


def _old_rows(spark, tmp_path, name):
    target = str(tmp_path / "bronze")
    ingest(spark, SPECS["sales_daily"], _csv(tmp_path, "Date,Revenue,COGS\n2020-01-02,1.5,2\n2020-01-03,1,1\n", "a.csv"), target)
    with pytest.raises(Exception):
        ingest(spark, SPECS["sales_daily"], name, target)
    return spark.read.parquet(target).count(), sorted(p.name for p in tmp_path.iterdir() if p.is_dir())


def test_an_empty_or_hidden_source_leaves_the_good_table(spark, tmp_path):
    empty = _csv(tmp_path, "Date,Revenue,COGS\n", "empty.csv")
    assert _old_rows(spark, tmp_path, empty) == (2, ["bronze"])
    hidden = _csv(tmp_path, "Date,Revenue,COGS\n2020-01-02,1.5,2\n", "_sales.csv")
    assert _old_rows(spark, tmp_path, hidden) == (2, ["bronze"])


def test_a_write_that_fails_leaves_the_good_table(spark, tmp_path):
    target = str(tmp_path / "t")
    write_folder(spark.range(5), target)
    with pytest.raises(Exception):
        write_folder(spark.range(100).withColumn("x", F.assert_true(F.col("id") < 90)), target)
    assert spark.read.parquet(target).count() == 5


def test_layout_choice():
    mb = 1 << 20
    assert choose_layout(646_945, 200 * mb, "order_date", 140) == Layout("month", "order_date")
    assert choose_layout(646_945, 44 * mb, "order_date", 140) == Layout("year", "order_date")
    assert choose_layout(121_930, 7 * mb, "signup_date", 132) == Layout("year", "signup_date")
    assert choose_layout(714_669, 30 * mb, join_key="order_id") == Layout("bucket", "order_id", 16)
    assert choose_layout(10 ** 12, 100 << 40, join_key="order_id").buckets == 204_800
    assert choose_layout(10 ** 12, 100 << 40, join_key="order_id", hottest_share=0.3) == Layout()
    assert choose_layout(2_412, mb) == Layout()


def test_month_layout_prunes(spark, tmp_path):
    days = spark.range(0, 400).select(F.expr("date_add(date '2020-01-01', cast(id as int))").alias("d"), "id")
    layout = Layout("month", "d")
    stored = write_folder(days, str(tmp_path / "days"), layout)
    wanted = between_dates(stored, layout, "2020-03-10", "2020-04-05")
    assert wanted.count() == 27
    plan = wanted._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_month" in plan and "2020-03" in plan


def test_bucketed_join_has_no_shuffle(spark, tmp_path, no_broadcast):
    left = spark.range(0, 1000).select((F.col("id") % 300).alias("k"), "id")
    right = spark.range(0, 300).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    a = write_table(left, "bucket_left", Layout("bucket", "k", 16), str(tmp_path / "a"))
    b = write_table(right, "bucket_right", Layout("bucket", "k", 16), str(tmp_path / "b"))
    joined = a.join(b, "k")
    assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 1000
    with pytest.raises(ValueError):
        write_folder(left, str(tmp_path / "c"), Layout("bucket", "k"))


def test_namespace(spark):
    create_namespace(spark, "granary_test_ns")
    create_namespace(spark, "granary_test_ns")
    assert spark.catalog.databaseExists("granary_test_ns")


def test_upsert_and_append(spark, tmp_path):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    changes = spark.createDataFrame([(2, "B"), (3, "c")], "k long, v string")
    assert sorted(map(tuple, upsert(base, changes, ["k"]).collect())) == [(1, "a"), (2, "B"), (3, "c")]
    path = str(tmp_path / "runs")
    for run_id in ("r1", "r1", "r2"):
        append_run(base, path, run_id)
    assert spark.read.parquet(path).count() == 4


def test_hottest_share(spark):
    skewed = spark.range(0, 9000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    assert abs(hottest_share(skewed, ["k"]).first().share - 1 / 3) < 1e-3
    assert hottest_share(spark.range(0).select(F.col("id").alias("k")), ["k"]).first().share == 0.0
