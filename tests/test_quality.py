"""Each check passes on clean rows, fails on broken ones; the build stops behind a failure."""

import datetime

import pytest
from pyspark.sql import functions as F

from granary.operators import quality as q
from granary.plans import build, checks
from granary.plans.lake import CALENDAR
from granary.operators.flagging import flag
from granary.sources.specs import SPECS
from granary.sources.tables import write_folder
from test_rules import CLEAN


def _status(df, check, parents=None):
    row = q.run_checks("m", df, [check], parents or {}).first()
    return row.failing_rows, row.status


@pytest.mark.parametrize("check, good, bad, failing", [
    (q.not_null("a"), [1, 2], [1, None, None], 2),
    (q.unique("a"), [1, 2, None, None], [1, 1, 1, 2, 2, 3], 2),
    (q.accepted("a", (1, 2)), [1, 2, None], [1, 3, 3], 2),
    (q.in_range("a", low=0), [0, 5, None], [-1, 0], 1),
    (q.in_range("a", above=0), [1, None], [0, -1, 2], 2),
    (q.in_range("a", low=1, high=4), [1, 4], [0, 5, 2], 2),
])
def test_checks_both_ways(spark, check, good, bad, failing):
    def frame(values):
        return spark.createDataFrame([(value,) for value in values], "a int")

    assert _status(frame(good), check) == (0, "pass")
    assert _status(frame(bad), check) == (failing, "fail")


def test_relationships(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    check = q.related("a", "p", "id")
    assert _status(spark.createDataFrame([(1,), (None,)], "a int"), check, {"p": parent}) == (0, "pass")
    assert _status(spark.createDataFrame([(1,), (9,), (9,)], "a int"), check, {"p": parent}) == (2, "fail")


def test_grain(spark):
    two, three = spark.range(2), spark.range(3)
    assert q.grain_breach(two, two).count() == 0
    assert tuple(q.grain_breach(two, three).first()) == (2, 3)
    assert q.check_grain("m", two, three).first().status == "fail"


def test_number_of_declared_checks():
    declared = [*checks.SOURCE_CHECKS.values(), *checks.model_checks(CALENDAR).values()]
    assert sum(map(len, declared)) == 112


def _bronze(spark, changes=None):
    frames = {}
    for name in checks.SOURCE_CHECKS:
        row = {**CLEAN[name], **(changes or {}).get(name, {})}
        schema = SPECS[name].schema
        for field in schema:
            field.nullable = True
        data = [tuple(row[column] for column in SPECS[name].names)]
        frames[name] = flag(spark.createDataFrame(data, schema), SPECS[name])
    return frames


def _build(spark, tmp_path, changes=None):
    day = datetime.date(1999, 5, 17)
    usual = {"orders": {"order_date": day}, "customers": {"signup_date": day}, "order_items": {"unit_price": 2.0}}
    merged = {name: {**usual.get(name, {}), **(changes or {}).get(name, {})} for name in CLEAN}
    report, _, frames = build.build(spark, _bronze(spark, merged), CALENDAR,
                                 lambda df, name: write_folder(df, f"{tmp_path}/{name}"))
    return {row.model: row.status for row in report.collect()}, frames


def test_clean_build_makes_everything(spark, tmp_path):
    status, frames = _build(spark, tmp_path)
    assert set(status.values()) == {"checked", "built"}
    fact = frames["fact_order_items"].first()
    assert fact.gross_amount - fact.discount_amount == fact.net_amount == 2.0


def test_failed_source_skips_what_depends_on_it(spark, tmp_path):
    status, _ = _build(spark, tmp_path, {"orders": {"order_id": None}})
    assert status["orders"] == "failed"
    assert status["silver_orders"] == status["fact_order_items"] == status["gold_orders_daily"] == "skipped"
    assert status["dim_customer"] == status["dim_product"] == "built"


def test_failed_model_skips_its_dependents(spark, tmp_path):
    status, _ = _build(spark, tmp_path, {"customers": {"zip": "99999"}})
    assert status["silver_customers"] == "failed" and status["dim_customer"] == "skipped"
    assert status["fact_order_items"] == "unchecked"  # its check against dim_customer could not run


def test_invalid_order_breaks_the_grain(spark, tmp_path):
    status, _ = _build(spark, tmp_path, {"orders": {"order_status": "lost"}})
    assert status["silver_order_items"] == "failed" and status["fact_order_items"] == "skipped"


def test_gold_is_stale_until_rebuilt(lake):
    from granary.plans import registry

    rows = {row.object: row.num_rows for row in registry.QUERIES["staleness_check"](lake).collect()}
    assert rows["gold table"] > rows["gold rebuilt"] == rows["silver view"] + 1


def test_unexpected_values(spark):
    df = spark.createDataFrame([("a",), ("x",), ("x",), (None,)], "s string")
    assert [tuple(row) for row in q.unexpected_values(df, q.accepted("s", ("a",))).collect()] == [("x", 2)]
    assert q.offenders(df, q.not_null("s")).count() == 1
    assert q.duplicates(df, ["s"]).select(F.col("s")).first().s == "x"


def test_many_frames_in_one_pass(spark):
    """Hot keys, nulls, an empty frame and a parent that is also checked, against counting by hand."""
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id int")
    child = spark.createDataFrame([(1, "x")] * 50 + [(9, "y")] * 7 + [(None, None)], "a int, b string")
    none = child.limit(0)
    found = q.run_all({"p": parent, "c": child, "e": none}, {
        "p": [q.unique("id"), q.not_null("id")],
        "c": [q.related("a", "p", "id"), q.accepted("b", ("x",)), q.unique("a"), q.in_range("a", low=1, high=8)],
        "e": [q.related("a", "p", "id"), q.unique("a"), q.not_null("b")]})
    assert {(r.model, r.check_name): r.failing_rows for r in found.collect()} == {
        ("p", "unique"): 1, ("p", "not_null"): 1,
        ("c", "relationships"): 7, ("c", "accepted_values"): 7, ("c", "unique"): 2, ("c", "accepted_range"): 7,
        ("e", "relationships"): 0, ("e", "unique"): 0, ("e", "not_null"): 0}


@pytest.mark.parametrize("name, most", [("fk_orphans", 16), ("scd2_customers", 3), ("test_unique", 8)])
def test_reads_each_table_once(lake, name, most):
    from granary.plans.registry import QUERIES

    plan = QUERIES[name](lake)._jdf.queryExecution().sparkPlan().toString()
    assert 0 < plan.count("FileScan") <= most


def test_offences_of_a_row_are_one_entry(spark):
    """Dates and keys of two types against counting by hand; without a function per row and one entry per check."""
    day = datetime.date
    parent = spark.createDataFrame([(day(2020, 1, 1), "1"), (day(2020, 1, 2), "2")], "d date, s string")
    child = spark.createDataFrame([(day(2020, 1, 1), 1, 0), (day(2020, 1, 3), 7, 9), (None, None, None)], "d date, k long, n int")
    wanted = [q.related("d", "p", "d"), q.related("k", "p", "s"), q.not_null("n"), q.in_range("n", above=0), q.unique("d")]
    found = q.run_all({"p": parent, "c": child}, {"c": wanted})
    assert {(r.column_name, r.check_name): r.failing_rows for r in found.collect()} == {
        ("d", "relationships"): 1, ("k", "relationships"): 1, ("n", "not_null"): 1, ("n", "accepted_range"): 1, ("d", "unique"): 0}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan.lower() and "array_compact" not in plan
