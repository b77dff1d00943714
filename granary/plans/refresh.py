"""Gold tables kept up to date from a change set instead of being built anew.

A change set is two frames of whole rows: those that no longer hold and those
that hold now. A changed row is in both, a new one only in the second, a deleted
one only in the first. Its effect is computed from these rows and the stored
state alone. Totals are decimals, so a table refreshed a thousand times equals
the one built from scratch.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.money import TOTAL, exact_sum, ratio
from granary.plans.facts import milestone_columns

STATES = ("delivered", "cancelled", "returned")


def _signed(gone: DataFrame, come: DataFrame) -> DataFrame:
    return gone.withColumn("_sign", F.lit(-1)).unionByName(come.withColumn("_sign", F.lit(1)))


def _joined(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """A join on keys that may be NULL; the key columns of the result come from either side."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    same = reduce(lambda a, b: a & b, [left[key].eqNullSafe(renamed[f"_right_{key}"]) for key in keys])
    rest = [name for name in (*left.columns, *renamed.columns) if name not in keys and not name.startswith("_right_")]
    return left.join(renamed, same, how).select(
        *[F.coalesce(left[key], renamed[f"_right_{key}"]).alias(key) for key in keys], *rest)


def _added(state: DataFrame, delta: DataFrame, keys: list[str], counts: list[str], alive: str) -> DataFrame:
    """State plus delta per key, missing sides as 0; keys whose `alive` count falls to 0 go, below 0 is an error."""
    joined = _joined(state, delta.withColumnsRenamed({name: f"_d_{name}" for name in counts}), keys, "full")
    summed = joined.select(*keys, *[(F.coalesce(F.col(name), F.lit(0)) + F.coalesce(F.col(f"_d_{name}"), F.lit(0)))
                                    .cast(state.schema[name].dataType).alias(name) for name in counts])
    wrong = F.raise_error(F.lit("the change set takes back rows that were never counted")).cast("boolean")
    return summed.filter(F.when(F.col(alive) < 0, wrong).otherwise(F.col(alive) > 0))


# --- orders per day -------------------------------------------------------------------------

def customers_per_day(orders: DataFrame) -> DataFrame:
    """(order_date, customer_id, num_orders): what the distinct customers of a day are counted from."""
    return orders.filter("customer_id is not null").groupBy("order_date", "customer_id").agg(
        F.count("*").alias("num_orders"))


def refresh_orders_daily(daily: DataFrame, customers: DataFrame, gone: DataFrame,
                         come: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`gold.orders_daily` and `customers_per_day` after a change set of silver orders.

    A customer is new to a day when their count there rises from 0 and has left
    it when it falls to 0, which only needs the counts of the changed pairs.
    """
    moved = _signed(gone, come)

    def net(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("_sign")).otherwise(0))

    pairs = moved.groupBy("order_date", "customer_id").agg(
        F.sum("_sign").alias("num_orders"),
        *[net(F.col("order_status") == state).alias(f"num_{state}") for state in STATES])
    before = F.coalesce(F.col("_before"), F.lit(0))
    known = customers.select("order_date", "customer_id", F.col("num_orders").alias("_before"))
    counted = _joined(pairs, known, ["order_date", "customer_id"], "left").withColumn(
        "num_customers", F.when(F.col("customer_id").isNull(), 0).otherwise(
            (before + F.col("num_orders") > 0).cast("int") - (before > 0).cast("int")))
    counts = ["num_orders", "num_customers", *[f"num_{state}" for state in STATES]]
    days = counted.groupBy("order_date").agg(*[F.sum(name).alias(name) for name in counts])
    return (_added(daily, days, ["order_date"], counts, "num_orders"),
            _added(customers, pairs.filter("customer_id is not null").select("order_date", "customer_id", "num_orders"),
                   ["order_date", "customer_id"], ["num_orders"], "num_orders"))


# --- revenue per day ------------------------------------------------------------------------

_REVENUE = ["num_orders", "num_lines", "num_units", "net", "discount"]


def _per_order(items: DataFrame, orders: DataFrame) -> DataFrame:
    lines = items.groupBy("order_id").agg(
        F.count("*").alias("num_lines"), F.sum("quantity").alias("num_units"),
        exact_sum("line_amount").alias("net"), exact_sum("discount_amount").alias("discount"))
    return lines.join(orders.select("order_id", "order_date"), "order_id").withColumn("num_orders", F.lit(1))


def _per_day(per_order: DataFrame) -> DataFrame:
    return per_order.groupBy("order_date").agg(*[
        (F.sum(name).cast(TOTAL) if name in ("net", "discount") else F.sum(name).cast("long")).alias(name)
        for name in _REVENUE])


def revenue_state(items: DataFrame, orders: DataFrame) -> DataFrame:
    """What `gold.revenue_daily` shows, as exact totals that can be added to."""
    return _per_day(_per_order(items, orders))


def revenue_view(state: DataFrame) -> DataFrame:
    """`gold.revenue_daily` from its state."""
    revenue = F.col("net").cast("double")
    return state.select("order_date", "num_orders", "num_lines", "num_units", revenue.alias("revenue"),
                        F.col("discount").cast("double").alias("total_discount"),
                        ratio(revenue, F.col("num_orders")).alias("avg_order_value"))


def touched_orders(*changes: DataFrame) -> DataFrame:
    """The ids of all orders with a row in one of the frames."""
    return reduce(DataFrame.union, [df.select("order_id") for df in changes]).distinct()


def refresh_revenue_daily(state: DataFrame, touched: DataFrame, before: tuple[DataFrame, DataFrame],
                          after: tuple[DataFrame, DataFrame]) -> DataFrame:
    """The revenue state after a change of silver lines or orders.

    `before` and `after` are (items, orders) of either time. An order belongs to
    one day, so all lines of the touched orders are taken back from their old day
    and added to their new one; distinct orders then need no state of their own.
    Only lines are cut to the touched orders: the join with their headers drops the others.
    """
    def totals(tables: tuple[DataFrame, DataFrame], sign: int) -> DataFrame:
        items, orders = tables
        return _per_order(items.join(touched, "order_id", "left_semi"), orders).select("order_date", *[(F.col(name) * sign).alias(name) for name in _REVENUE])

    moved = _per_day(totals(before, -1).unionByName(totals(after, 1)))
    return _added(state, moved, ["order_date"], _REVENUE, "num_orders")


# --- accumulating snapshot ------------------------------------------------------------------

_HEADER = ("customer_id", "order_status", "order_date")
_DATES = ("ship_date", "delivery_date")


def advance_orders(fact: DataFrame, orders: DataFrame, shipments: DataFrame) -> DataFrame:
    """`facts.fact_orders` after a batch of orders and shipments: one row per order, as before.

    An order of the batch replaces the header of the stored one. A date of the
    batch replaces the stored date, a NULL never does; of several dates for one
    order the latest counts. Shipments of unknown orders are left out, see
    `early_shipments`.
    """
    fresh = orders.select("order_id", F.struct(*_HEADER).alias("_new")).groupBy("order_id").agg(F.max("_new").alias("_new"))
    dates = shipments.groupBy("order_id").agg(*[F.max(name).alias(f"_{name}") for name in _DATES])
    stored = fact.select("order_id", F.struct(*_HEADER).alias("_old"), *_DATES)
    head = F.coalesce(F.col("_new"), F.col("_old"))
    merged = stored.join(fresh, "order_id", "full").join(dates, "order_id", "left").select(
        "order_id", *[head[name].alias(name) for name in _HEADER],
        *[F.coalesce(f"_{name}", name).alias(name) for name in _DATES])
    return merged.select("order_id", *_HEADER, *_DATES, *milestone_columns())


def early_shipments(fact: DataFrame, orders: DataFrame, shipments: DataFrame) -> DataFrame:
    """Shipments of orders that neither the fact nor the batch knows; they wait for the next batch."""
    known = fact.select("order_id").union(orders.select("order_id"))
    return shipments.join(known, "order_id", "left_anti")
