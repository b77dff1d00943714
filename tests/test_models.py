"""Gold models, profiles and history on small hand-made tables."""

import datetime
import re

from pyspark.sql import functions as F

from granary.functions.calendar import date_attributes, day_spine
from granary.functions.money import ratio_of_sums
from granary.operators import history, keys, profile
from granary.plans import facts, gold, recipes

D = datetime.date


def test_calendar(spark):
    days = date_attributes(day_spine(spark, "2012-01-01", "2023-01-01"))
    assert days.count() == 4018
    first = days.orderBy("date_key").first()
    assert (first.year, first.week_of_year, first.day_of_week, first.day_name, first.is_weekend) == (
        2012, 52, 7, "Sunday", True)
    assert days.agg(F.max("date_key")).first()[0] == D(2022, 12, 31)


def test_revenue_keeps_the_grain_when_an_order_is_huge(spark):
    items = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("order_id"), F.lit(2).alias("quantity"),
        F.lit(0.1).alias("line_amount"), F.lit(0.0).alias("discount_amount"))
    orders = spark.range(0, 3000).select(F.col("id").alias("order_id"), F.lit(D(2020, 1, 1)).alias("order_date"))
    row = gold.revenue_daily(items, orders).first()
    assert (row.num_orders, row.num_lines, row.num_units, row.revenue) == (2000, 3000, 6000, 300.0)


def test_unknown_zip_keeps_the_customer(spark):
    customers = spark.createDataFrame(
        [(1, "A", "Hue", D(2020, 1, 2), "male", "55+", "direct"), (2, "?", "Hue", D(2020, 1, 2), None, None, None)],
        "customer_id long, zip string, city string, signup_date date, gender string, age_group string, "
        "acquisition_channel string")
    places = spark.createDataFrame([("A", "X", "east", "D1")], "zip string, city string, region string, district string")
    rows = {row.customer_id: row for row in gold.dim_customer(customers, places).collect()}
    assert rows[1].region == "east" and rows[1].city == "Hue" and rows[1].signup_year_month == "2020-01"
    assert rows[2].region is None


def test_no_promo_member_is_typed_like_the_rest(lake):
    dim = lake.dim_promotion
    assert dim.schema["duration_days"].dataType.simpleString() == "bigint"
    member = dim.filter("promo_id = 'NO_PROMO'").first()
    assert member.promo_type == "none" and member.is_stackable is False and member.start_date is None


def test_rows_are_kept(lake):
    for name in ("orders", "order_items", "promotions", "web_traffic"):
        assert lake.bronze(name).count() == lake.source(name).count()
    broken = lake.fact.filter("abs(gross_amount - discount_amount - net_amount) > 1e-6")
    assert broken.isEmpty()


def test_fan_out_equals_real_joins(spark):
    left = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 5), (None, 1)], "o int, p int")
    right = spark.createDataFrame([(1, 1), (1, 1), (1, 3), (2, 6)], "o int, p int")
    rows = {row.join_form: row.joined_rows for row in profile.fan_out(left, right, ["o"], ["o", "p"]).collect()}
    assert rows["by o"] == left.join(right, ["o"], "left").count()
    assert rows["by o, p"] == left.join(right, ["o", "p"], "left").count()
    assert rows["aggregated first"] == 5


SNAPSHOTS = {
    "2020-01-01": [(1, "A"), (2, "B"), (3, None)],
    "2020-02-01": [(1, "A"), (2, "C"), (4, "D")],
    "2020-03-01": [(1, "A2"), (2, "B"), (3, "E"), (4, "D")],
}


def _snapshots(spark):
    return {day: spark.createDataFrame(rows, "id int, zip string") for day, rows in SNAPSHOTS.items()}


def _versions(df):
    return sorted((row.id, row.zip or "", str(row.valid_from), str(row.valid_to), row.is_current)
                  for row in df.collect())


EXPECTED = [
    (1, "A", "2020-01-01", "2020-03-01", False), (1, "A2", "2020-03-01", "None", True),
    (2, "B", "2020-01-01", "2020-02-01", False), (2, "B", "2020-03-01", "None", True),
    (2, "C", "2020-02-01", "2020-03-01", False),
    (3, "", "2020-01-01", "2020-03-01", False), (3, "E", "2020-03-01", "None", True),
    (4, "D", "2020-02-01", "None", True),
]


def test_scd2_keeps_history_also_of_a_value_that_returns(spark):
    assert _versions(history.scd2(history.stack_snapshots(_snapshots(spark)), "id", ["zip"])) == EXPECTED


def test_scd2_step_by_step_gives_the_same(spark):
    days = list(_snapshots(spark).items())
    versions = history.scd2(history.stack_snapshots(dict(days[:1])), "id", ["zip"])
    for day, snapshot in days[1:]:
        versions = history.scd2_advance(versions, snapshot, day, "id", ["zip"])
    assert _versions(versions) == EXPECTED
    again = history.scd2_advance(versions, days[-1][1], "2020-03-01", "id", ["zip"])
    assert _versions(again) == EXPECTED


def test_other_scd_types(spark):
    stacked = history.stack_snapshots(_snapshots(spark))
    versions = history.scd2(stacked, "id", ["zip"])
    first = {row.id: row.zip for row in history.as_first_seen(stacked, "id", "zip").collect()}
    last = {row.id: row.zip for row in history.as_last_seen(stacked, "id", "zip").collect()}
    assert first[2] == "B" and last[1] == "A2"
    third = {row.id: (row.current_zip, row.previous_zip)
             for row in history.with_previous(versions, "id", "zip").collect()}
    assert third == {1: ("A2", "A"), 2: ("B", "C"), 3: ("E", None), 4: ("D", None)}
    current, closed = history.split_current(versions)
    assert (current.count(), closed.count()) == (4, 4)


def test_orders_as_of(spark):
    versions = history.scd2(history.stack_snapshots(_snapshots(spark)), "id", ["zip"]).withColumnRenamed(
        "id", "customer_id")
    orders = spark.createDataFrame(
        [(10, 2, D(2020, 2, 1)), (11, 2, D(2020, 1, 31)), (12, 2, D(2019, 1, 1)), (13, 9, D(2020, 2, 1))],
        "order_id int, customer_id int, order_date date")
    rows = {row.order_id: row for row in facts.orders_as_of(orders, versions).collect()}
    assert rows[10].customer_zip == "C" and rows[11].customer_zip == "B"
    assert rows[12].customer_sk == rows[13].customer_sk == keys.UNKNOWN_MEMBER


def test_surrogate_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 1)], "n string, v int")
    found = [row[0] for row in df.select(keys.surrogate_key("n", "v")).collect()]
    assert len(set(found)) == 3 and found[2] == -1
    assert df.select(keys.surrogate_key("n").alias("k")).distinct().count() == 2


def test_ratio_of_sums_is_not_the_mean_of_ratios(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 99.0)], "n double, d double")
    assert df.agg(ratio_of_sums("n", "d")).first()[0] == 0.02
    assert df.limit(0).agg(ratio_of_sums("n", "d")).first()[0] is None


def test_bridge_allocates_each_line_once(spark):
    items = spark.createDataFrame(
        [(1, 1, 10.0, "P1", "P2"), (1, 2, 6.0, "P1", None), (2, 1, 5.0, None, None)],
        "order_id int, product_id int, line_amount double, promo_id string, promo_id_2 string")
    promos = spark.createDataFrame([("P1", "one"), ("P2", "two")], "promo_id string, promo_name string")
    rows = {row.promo_id: row for row in facts.bridge_revenue(facts.promo_bridge(items), promos).collect()}
    assert (rows["P1"].touched_revenue, rows["P1"].allocated_revenue) == (16.0, 11.0)
    assert rows["P2"].allocated_revenue == 5.0


def test_stock_is_never_added_over_time(spark):
    stock = spark.createDataFrame(
        [(1, D(2020, 1, 31), "genz", 100), (1, D(2020, 2, 29), "genz", 100), (2, D(2020, 1, 31), "genz", 50)],
        "product_id int, snapshot_date date, category string, stock_on_hand long")
    assert facts.inventory_last(stock).first().stock_on_hand == 150
    assert facts.inventory_average(stock).first().avg_stock == 125.0


def test_plans_stay_in_the_jvm_and_push_filters_down(lake):
    plan = lake.revenue_daily._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    stored = lake.stored(lake.bronze("orders"), "orders")
    from granary.plans.silver import silver

    scan = silver("orders", stored).select("order_id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(_is_valid), EqualTo(_is_valid,true)]" in scan
    assert "ReadSchema: struct<order_id:bigint,_is_valid:boolean>" in scan


def test_days_outside_the_calendar_stay(lake, spark, folder):
    from granary.plans import recipes
    from granary.plans.lake import Lake

    short = Lake(spark, folder, ("1996-01-01", "1996-02-01")).dim_date
    assert short.count() == 31
    sales = recipes.weekend_vs_weekday(lake.fact, short)
    assert {row.is_weekend for row in sales.collect()} == {None, False, True}
    orders = facts.fact_orders(lake.silver("orders"), lake.silver("shipments"))
    counted = facts.role_playing_dates(orders, short).agg(F.sum("num_orders")).first()[0]
    assert counted == lake.silver("orders").count()
    coverage = facts.promo_coverage(lake.silver("promotions"))
    assert facts.concurrent_promos(coverage, short).agg(F.sum("promo_days")).first()[0] == coverage.count()


def test_default_calendar_spans_the_data(spark, folder):
    from granary.plans import registry
    from granary.plans.lake import Lake

    late, plain = Lake(spark, folder), Lake(spark, folder).silver
    late.silver = lambda name: plain(name) if name != "orders" else plain(name).withColumn(
        "order_date", F.date_add("order_date", 4000))
    assert late.calendar == ("1994-01-01", "2013-01-01")
    days = late.dim_date.agg(F.min("date_key").cast("string"), F.max("date_key").cast("string"), F.count("*")).first()
    assert tuple(days) == ("1994-01-01", "2012-12-31", 6940)
    assert {row.is_weekend for row in registry.QUERIES["weekend_vs_weekday"](late).collect()} == {False, True}
    orders = registry.QUERIES["role_playing_dates"](late)
    assert orders.filter("order_weekend is null").count() == 0
    late = Lake(spark, folder)
    late.silver = lambda name: plain(name).filter("false")
    assert late.dim_date.count() == 2922


def test_promo_effectiveness_keeps_no_group_per_order(spark):
    """Two promotions of one name share orders, one order has no number, one promotion no line."""
    fact = spark.createDataFrame(
        [("a", 1, 5.0), ("a", 1, 7.0), ("b", 1, 1.0), ("b", 2, 1.0), ("c", 2, 2.0), ("c", None, 4.0)],
        "promo_key string, order_id long, net_amount double").withColumns(
        {"gross_amount": F.col("net_amount") + 1, "discount_amount": F.lit(1.0)})
    promotions = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y"), ("d", "z")],
                                       "promo_id string, promo_name string").withColumn("promo_type", F.lit(None).cast("string"))
    found = recipes.promo_effectiveness(fact, promotions)
    assert [tuple(row) for row in found.collect()] == [("x", None, 2, 18.0, 4.0, 14.0), ("y", None, 1, 8.0, 2.0, 6.0)]
    keys = re.findall(r"Aggregate\(keys=\[([^\]]*)\]", found._jdf.queryExecution().sparkPlan().toString())
    assert keys and not [key for key in keys if "order_id" in key]
