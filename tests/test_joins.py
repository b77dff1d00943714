"""Skew joins against plain joins, and their spread of rows over tasks."""

import pytest
from pyspark.sql import functions as F

from granary.operators.joins import hot_keys, orphan_count, row_number_in_scan, skew_join, without_match


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def many(spark):
    """A third of the rows have key 7, a tenth have no key, some keys are unknown on the right."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 500)
    return spark.range(0, 6000).select(key.alias("k"), F.col("id").alias("v"))


@pytest.fixture
def few(spark):
    return spark.range(0, 450).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("spread", [None, "position"])
def test_same_rows_as_a_plain_join(many, few, no_broadcast, how, spread):
    number = row_number_in_scan() if spread else None
    joined = skew_join(many, few, ["k"], how, hot_keys(many, ["k"]), spread=number).select("k", "v", "w")
    assert _rows(joined) == _rows(many.join(few, "k", how).select("k", "v", "w"))


def test_extra_condition(many, few, no_broadcast):
    condition = F.col("v") > F.col("w")
    joined = skew_join(many, few, ["k"], "left", hot_keys(many, ["k"]), condition=condition).select("k", "v", "w")
    plain = many.join(few.withColumnRenamed("k", "k2"), (F.col("k") == F.col("k2")) & condition, "left")
    assert _rows(joined) == _rows(plain.select("k", "v", "w"))


def test_hot_rows_are_spread(spark, many, few, no_broadcast):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        def largest(df):
            return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

        plain = largest(many.join(few, "k"))
        salted = largest(skew_join(many, few, ["k"], hot=hot_keys(many, ["k"]), spread=row_number_in_scan(), salts=64))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert plain >= 2000
    assert salted < plain / 2


def test_identical_rows_are_spread_too(spark, few, no_broadcast):
    copies = spark.range(0, 4000).select(F.lit(7).cast("long").alias("k"))
    joined = skew_join(copies, few, ["k"], hot=hot_keys(copies, ["k"]), spread=row_number_in_scan(), salts=16)
    assert joined.count() == 4000


def test_hot_keys_find_the_hot_one_and_stay_few(spark, many):
    hashes = {row[0] for row in hot_keys(many, ["k"]).collect()}
    wanted = spark.range(1).select(F.xxhash64(F.lit(7).cast("long"))).first()[0]
    assert wanted in hashes and len(hashes) <= 10_000


@pytest.mark.parametrize("partitions", ["8", "200", "2500"])
def test_no_key_of_unique_keys_is_hot(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    unique = spark.range(2_000_000).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = hot_keys(unique, ["k"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found.count() == 0


def test_bucketed_tables_join_without_a_shuffle(spark, many, few, no_broadcast):
    for name, df in (("join_many", many), ("join_few", few)):
        df.write.mode("overwrite").bucketBy(4, "k").saveAsTable(name)
    try:
        joined = skew_join(spark.table("join_many"), spark.table("join_few"), ["k"])
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        assert joined.count() == many.join(few, "k").count()
    finally:
        for name in ("join_many", "join_few"):
            spark.sql(f"DROP TABLE {name}")


def test_only_inner_and_left(many, few):
    with pytest.raises(ValueError):
        skew_join(many, few, ["k"], "full")


def test_anti_join_and_orphans(many, few):
    assert without_match(many, few, ["k"]).filter("k is not null").count() == orphan_count(
        many, "k", few, "k").first().orphan_rows
