"""Tables that are changed in place against tables built anew."""

import datetime
import random
from collections import Counter
from pathlib import Path

import pytest

from granary.operators.profile import inclusions
from granary.plans import facts, gold, refresh, registry
from granary.sources.merge import row_hash, upsert_partitions, write_hashed
from granary.sources.tables import Layout

MONTH = Layout("month", "day")
DAY = datetime.date


def _rows(df):
    return Counter(map(tuple, df.collect()))


# --- upsert by partition --------------------------------------------------------------------

ROWS = "k long, day date, a string, b string"
BASE = [(1, DAY(2020, 1, 5), "x", None), (2, DAY(2020, 1, 9), "y", "z"), (3, DAY(2020, 2, 1), "x", "x"),
        (4, DAY(2020, 3, 1), None, "x"), (5, None, "n", "n"), (6, DAY(2020, 4, 1), "only", "one")]


def _files(path):
    return {str(file.relative_to(path)) for file in Path(path).rglob("*.parquet")}


def _table(spark, path):
    return {row.k: (row.day, row.a, row.b) for row in spark.read.parquet(path).collect()}


@pytest.fixture
def hashed(spark, tmp_path):
    path = str(tmp_path / "table")
    write_hashed(spark.createDataFrame(BASE, ROWS), path, MONTH)
    return path


def _upsert(spark, path, rows):
    return upsert_partitions(spark, path, spark.createDataFrame(rows, ROWS), ["k"], MONTH)


def test_upsert_rewrites_touched_partitions_only(spark, hashed):
    before = _files(hashed)
    changes = [(1, DAY(2020, 1, 5), "new", None), (7, DAY(2020, 5, 1), "q", "q"), (3, DAY(2020, 2, 1), "x", "x")]
    assert _upsert(spark, hashed, changes) == ["2020-01", "2020-05"]
    after = _files(hashed)
    assert {f for f in before if "2020-01" not in f} == {f for f in after if "2020-01" not in f and "2020-05" not in f}
    table = _table(spark, hashed)
    assert table == {k: (d, a, b) for k, d, a, b in BASE} | {1: (DAY(2020, 1, 5), "new", None), 7: (DAY(2020, 5, 1), "q", "q")}
    assert _upsert(spark, hashed, changes) == [] and _files(hashed) == after


def test_upsert_moves_rows_and_drops_empty_partitions(spark, hashed):
    changes = [(6, DAY(2020, 1, 31), "moved", "one"), (5, DAY(2020, 3, 9), "n", "n"), (2, None, "y", "z")]
    assert set(_upsert(spark, hashed, changes)) == {"2020-01", "2020-03", "2020-04", None}
    assert _table(spark, hashed) == {k: (d, a, b) for k, d, a, b in BASE} | {k: (d, a, b) for k, d, a, b in changes}
    assert len(spark.read.parquet(hashed).collect()) == 6 and not any("2020-04" in f for f in _files(hashed))


def test_upsert_mends_a_run_that_broke_off(spark, hashed):
    """The new partition was written, the old one not yet: the key is there twice."""
    row = spark.createDataFrame([(6, DAY(2020, 5, 5), "moved", "one")], ROWS)
    row.withColumn("_row_hash", row_hash(row.columns)).selectExpr("*", "'2020-05' as _month").write.mode("append").partitionBy(
        "_month").parquet(hashed)
    assert set(_upsert(spark, hashed, [(6, DAY(2020, 5, 5), "moved", "one")])) == {"2020-04", "2020-05"}
    assert _table(spark, hashed)[6][0] == DAY(2020, 5, 5) and spark.read.parquet(hashed).count() == 6


@pytest.mark.parametrize("rows", [[(None, DAY(2020, 1, 1), "a", "b")], [(1, None, "a", "b"), (1, None, "c", "b")]])
def test_upsert_refuses_unclear_keys(spark, hashed, rows):
    before = _files(hashed)
    with pytest.raises(ValueError):
        _upsert(spark, hashed, rows)
    assert _files(hashed) == before


def test_upsert_needs_partitions(spark, hashed):
    with pytest.raises(ValueError):
        upsert_partitions(spark, hashed, spark.createDataFrame(BASE, ROWS), ["k"], Layout())


def test_row_hash_keeps_nulls_apart(spark):
    rows = spark.createDataFrame([("x", None), (None, "x"), (None, None), ("", "x"), ("null", "x")], "a string, b string")
    assert rows.select(row_hash(["a", "b"])).distinct().count() == 5
    assert rows.select(row_hash(["a", "b"]).alias("h")).collect() == rows.select(row_hash(["b", "a"]).alias("h")).collect()


# --- daily aggregates -----------------------------------------------------------------------

ORDERS = "order_id long, customer_id long, order_date date, order_status string"
ITEMS = "order_id long, quantity long, line_amount double, discount_amount double"
STATUSES = ["delivered", "cancelled", "returned", "paid", None]


def _order(draw, key):
    return (key, draw.choice([1, 2, 3, None]), DAY(2020, 1, draw.randrange(1, 6)), draw.choice(STATUSES))


def _lines(draw, key):
    return [(key, draw.randrange(1, 9), draw.randrange(10_000) / 100, draw.randrange(100) / 100)
            for _ in range(draw.randrange(4))]


@pytest.mark.parametrize("seed", range(2))
def test_refreshed_aggregates_equal_rebuilt_ones(spark, seed):
    draw = random.Random(seed)
    orders = {k: _order(draw, k) for k in range(30)}
    items = {k: _lines(draw, k) for k in range(32)}  # two orders are unknown

    def frames():
        return (spark.createDataFrame([row for rows in items.values() for row in rows], ITEMS),
                spark.createDataFrame(list(orders.values()), ORDERS))

    lines, heads = frames()
    daily, customers, state = gold.orders_daily(heads), refresh.customers_per_day(heads), refresh.revenue_state(lines, heads)
    for _ in range(2):
        before, old, old_items = frames(), dict(orders), dict(items)
        for key in draw.sample(sorted(orders), 8):
            orders.pop(key)
            if draw.random() < 0.7:
                orders[key] = _order(draw, key)
        orders |= {k: _order(draw, k) for k in range(100, 100 + draw.randrange(1, 5))}
        items |= {k: _lines(draw, k) for k in draw.sample(range(35), 9)}
        gone = [row for k, row in old.items() if orders.get(k) != row]
        come = [row for k, row in orders.items() if old.get(k) != row]
        gone, come = spark.createDataFrame(gone, ORDERS), spark.createDataFrame(come, ORDERS)
        changed = spark.createDataFrame([(k,) for k in items if items[k] != old_items.get(k)], "order_id long")
        after = frames()
        daily, customers = refresh.refresh_orders_daily(daily, customers, gone, come)
        state = refresh.refresh_revenue_daily(state, refresh.touched_orders(gone, come, changed), before, after)
        daily, customers, state = (spark.createDataFrame(df.collect(), df.schema) for df in (daily, customers, state))
        assert _rows(daily) == _rows(gold.orders_daily(after[1]).select(daily.columns))
        assert _rows(customers) == _rows(refresh.customers_per_day(after[1]))
        assert _rows(state) == _rows(refresh.revenue_state(*after).select(state.columns))
        assert _rows(refresh.revenue_view(state)) == _rows(gold.revenue_daily(*after))


def test_refresh_refuses_rows_never_counted(spark):
    rows = spark.createDataFrame([(1, 1, DAY(2020, 1, 1), "paid")], ORDERS)
    none = rows.limit(0)
    daily, _ = refresh.refresh_orders_daily(gold.orders_daily(none), refresh.customers_per_day(none), rows, none)
    with pytest.raises(Exception, match="never counted"):
        daily.collect()


# --- order life cycle -----------------------------------------------------------------------

SHIPPED = "order_id long, ship_date date, delivery_date date"


def test_a_date_is_never_lost(spark):
    orders = spark.createDataFrame([(1, 7, DAY(2020, 1, 1), "created"), (2, 8, DAY(2020, 1, 2), "created")], ORDERS)
    fact = facts.fact_orders(orders, spark.createDataFrame([(1, DAY(2020, 1, 3), None)], SHIPPED))
    news = spark.createDataFrame([(1, None, DAY(2020, 1, 9)), (1, None, None), (2, DAY(2020, 1, 1), None),
                                  (2, DAY(2019, 12, 30), None), (3, DAY(2020, 1, 4), None)], SHIPPED)
    later = spark.createDataFrame([(1, 7, DAY(2020, 1, 1), "delivered")], ORDERS)
    after = {row.order_id: row for row in refresh.advance_orders(fact, later, news).collect()}
    assert set(after) == {1, 2} and after[1].order_status == "delivered" and after[2].order_status == "created"
    assert (after[1].ship_date, after[1].delivery_date, after[1].total_days) == (DAY(2020, 1, 3), DAY(2020, 1, 9), 8)
    assert after[2].ship_date == DAY(2020, 1, 1) and after[2].ships_before_order and after[2].delivery_date is None
    assert [row.order_id for row in refresh.early_shipments(fact, later, news).collect()] == [3]


# --- dense stock, inclusions, calendar --------------------------------------------------------

def test_dense_inventory(spark):
    rows = spark.createDataFrame(
        [(1, DAY(2020, 1, 31), 5, 1, 2, 0), (1, DAY(2020, 4, 10), 9, 1, 1, 1), (1, DAY(2020, 4, 30), 7, 2, 2, 2),
         (2, DAY(2020, 3, 31), 3, 0, 0, 0), (9, None, 1, 1, 1, 1)],
        "product_id long, snapshot_date date, stock_on_hand long, units_received long, units_sold long, stockout_days int")
    products = spark.createDataFrame([(1,), (2,), (3,)], "product_id long")
    found = {(r.product_key, r.date_key.month): (r.stock_on_hand, r.units_sold, r.is_carried)
             for r in facts.dense_inventory(rows, products).collect()}
    assert found == {
        (1, 1): (5, 2, False), (1, 2): (5, 0, True), (1, 3): (5, 0, True), (1, 4): (7, 3, False),
        (2, 1): (0, 0, True), (2, 2): (0, 0, True), (2, 3): (3, 0, False), (2, 4): (3, 0, True),
        (3, 1): (0, 0, True), (3, 2): (0, 0, True), (3, 3): (0, 0, True), (3, 4): (0, 0, True)}


def test_inclusions(spark):
    fact = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "a")], "x_key int, y_key string")
    dims = {"x": (spark.createDataFrame([(1,), (2,), (None,)], "x long"), "x"),
            "y": (spark.createDataFrame([("a",), ("2",)], "y string"), "y")}
    found = {(r.key_column, r.dimension): tuple(r)[3:] for r in inclusions({"f": (fact, ["x_key", "y_key"])}, dims).collect()}
    assert found == {("x_key", "x"): (4, 2, 3, 2), ("x_key", "y"): (4, 2, 1, 1),
                     ("y_key", "x"): (4, 2, 0, 0), ("y_key", "y"): (4, 2, 2, 1)}
    empty = inclusions({"f": (fact.limit(0), ["x_key"])}, dims).collect()
    assert [tuple(r)[3:] for r in empty] == [(0, 0, 0, 0)] * 2


def test_inclusions_count_by_value_before_text(spark):
    """Against a plain count; and rows are counted by grouping sets, not as one text per row and column."""
    day = DAY(2020, 1, 1)
    first = [(1, day, "1"), (1, day, "2"), (2, None, "2020-01-01"), (None, DAY(2020, 1, 2), None)] * 3
    second = [(1,), (7,), (None,)]
    frames = {"f": (spark.createDataFrame(first, "x_key long, d_key date, s_key string"), ["x_key", "d_key", "s_key"]),
              "g": (spark.createDataFrame(second, "x_key int"), ["x_key"])}
    members = {"number": [1, 1, 7, None], "day": [day, None]}
    dims = {"number": (spark.createDataFrame([(m,) for m in members["number"]], "k long"), "k"),
            "day": (spark.createDataFrame([(m,) for m in members["day"]], "k date"), "k")}
    found = inclusions(frames, dims)
    expected = set()
    for fact, rows in (("f", first), ("g", second)):
        for at, column in enumerate(frames[fact][1]):
            values = [None if row[at] is None else str(row[at]) for row in rows]
            for dim, keys in members.items():
                hit = [v for v in values if v is not None and v in {str(key) for key in keys if key is not None}]
                expected.add((fact, column, dim, len(values), len(set(values) - {None}), len(hit), len(set(hit))))
    assert set(map(tuple, found.collect())) == expected
    assert "Expand" in found._jdf.queryExecution().optimizedPlan().toString()


def test_bus_matrix_groups_lines_once(spark, folder):
    """Shipments and inventory are stored; the query itself reads the lines for order lines and returns."""
    plan = registry.run("bus_matrix", spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet [l_") == 2


def _scans(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")


@pytest.mark.parametrize("name, most", [("star_four_dims", 6), ("weekend_vs_weekday", 4), ("bus_matrix", 30),
                                        ("concurrent_promos", 4), ("role_playing_dates", 8)])
def test_reports_do_not_scan_every_table_for_the_calendar(spark, folder, name, most):
    assert _scans(registry.run(name, spark, folder)) <= most


def test_refresh_cuts_only_the_lines_to_touched_orders(spark):
    """One more semi-join for each table of headers put two more sorts into the largest task."""
    items, orders = spark.createDataFrame([], ITEMS), spark.createDataFrame([], ORDERS)
    state = refresh.refresh_revenue_daily(refresh.revenue_state(items, orders), refresh.touched_orders(orders),
                                          (items, orders), (items, orders))
    assert state._jdf.queryExecution().analyzed().toString().count("Join LeftSemi") == 2
