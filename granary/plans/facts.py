"""Further facts: returns, order life cycle, inventory, coverage, bridge, and the rest."""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.functions.calendar import days_between
from granary.functions.money import add_up, exact_sum, ratio
from granary.operators.joins import skew_join, without_match
from granary.operators.keys import UNKNOWN_MEMBER, or_unknown, surrogate_key
from granary.operators.profile import inclusions


# --- transaction facts --------------------------------------------------------------------

def fact_returns(returns: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per return, on the same date, product and customer keys as the sales fact."""
    buyers = orders.select("order_id", F.col("customer_id").alias("customer_key"))
    return skew_join(returns, buyers, ["order_id"], "left").select(
        F.col("return_date").alias("date_key"), F.col("product_id").alias("product_key"), "customer_key",
        "return_id", "order_id", "return_reason", "return_quantity", "refund_amount")


def fact_payments(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per payment."""
    header = orders.select("order_id", F.col("order_date").alias("date_key"),
                           F.col("customer_id").alias("customer_key"))
    return skew_join(payments, header, ["order_id"]).select(
        "date_key", "customer_key", "order_id", "payment_method", "payment_value", "installments")


def fact_shipments(shipments: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per shipment."""
    header = orders.select("order_id", F.col("customer_id").alias("customer_key"))
    return skew_join(shipments, header, ["order_id"]).select(
        F.col("ship_date").alias("date_key"), "customer_key", "order_id", "delivery_date", "shipping_fee",
        days_between(F.col("ship_date"), F.col("delivery_date")).alias("days_in_transit"))


def fact_reviews(reviews: DataFrame) -> DataFrame:
    return reviews.select(
        F.col("review_date").alias("date_key"), F.col("customer_id").alias("customer_key"),
        F.col("product_id").alias("product_key"), "review_id", "order_id", "rating")


def fact_web_traffic(traffic: DataFrame) -> DataFrame:
    """Additive counts only; rates are kept as their additive parts."""
    return traffic.select(
        F.col("traffic_date").alias("date_key"), "traffic_source", "sessions", "unique_visitors", "page_views",
        (F.col("bounce_rate") * F.col("sessions")).alias("bounced_sessions"),
        (F.col("avg_session_duration_sec") * F.col("sessions")).alias("duration_sec"))


# --- accumulating snapshot ----------------------------------------------------------------

def milestone_columns() -> list:
    """Days between the three dates of an order, and whether they are out of order."""
    ordered, sent, arrived = F.col("order_date"), F.col("ship_date"), F.col("delivery_date")
    return [days_between(ordered, sent).alias("days_to_ship"),
            days_between(sent, arrived).alias("days_in_transit"),
            days_between(ordered, arrived).alias("total_days"),
            F.coalesce(sent < ordered, F.lit(False)).alias("ships_before_order")]


def fact_orders(orders: DataFrame, shipments: DataFrame) -> DataFrame:
    """One row per order with its milestones and the days between them.

    A shipment dated before its order stays, flagged, with negative days.
    """
    milestones = shipments.select("order_id", "ship_date", "delivery_date")
    return orders.join(milestones, "order_id", "left").select(
        "order_id", "customer_id", "order_status", "order_date", "ship_date", "delivery_date", *milestone_columns())


def role_playing_dates(orders_fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Delivery time by the day kind of order, shipment and delivery: one calendar, three roles.

    Rows shrink to one per triple of dates before the three joins. A date outside the calendar has no day kind.
    """
    per_dates = orders_fact.groupBy("order_date", "ship_date", "delivery_date").agg(
        F.count("*").alias("n"), F.sum("total_days").alias("days"), F.count("total_days").alias("dated"))
    for role in ("order", "ship", "delivery"):
        calendar = dim_date.select(F.col("date_key").alias(f"{role}_date"),
                                   F.col("is_weekend").alias(f"{role}_weekend"))
        per_dates = per_dates.join(calendar, f"{role}_date", "left")
    return per_dates.groupBy("order_weekend", "ship_weekend", "delivery_weekend").agg(
        F.sum("n").alias("num_orders"), ratio(F.sum("days"), F.sum("dated")).alias("avg_total_days"))


# --- periodic snapshot --------------------------------------------------------------------

def fact_inventory(inventory: DataFrame) -> DataFrame:
    """One row per product and month. Stock is semi-additive; rates are left to their parts."""
    return inventory.select(
        F.col("snapshot_date").alias("date_key"), F.col("product_id").alias("product_key"),
        "stock_on_hand", "units_received", "units_sold", "stockout_days")


def dense_inventory(inventory: DataFrame, products: DataFrame) -> DataFrame:
    """One row per product and month of the table's span, also for months in which nothing was counted.

    A month without a snapshot has no movement and the stock of the month before,
    0 before the first one. Of several snapshots in a month the last one's stock
    counts and movements add up. Rows without a date belong to no month. A window
    holds the months of one product.
    """
    dated = inventory.filter("snapshot_date is not null")
    monthly = dated.groupBy(F.col("product_id").alias("product_key"), F.last_day("snapshot_date").alias("date_key")).agg(
        F.max_by("stock_on_hand", "snapshot_date").alias("_stock"),
        *[F.sum(name).alias(name) for name in ("units_received", "units_sold", "stockout_days")])
    first, last = (dated.agg(F.trunc(end("snapshot_date"), "month")).scalar() for end in (F.min, F.max))
    members = products.select("product_id").union(dated.select("product_id")).filter("product_id is not null").distinct()
    grid = members.select(F.col("product_id").alias("product_key"), F.explode(
        F.sequence(first, last, F.expr("interval 1 month"))).alias("_month")).select(
        "product_key", F.last_day("_month").alias("date_key"))
    so_far = Window.partitionBy("product_key").orderBy("date_key").rowsBetween(Window.unboundedPreceding, 0)
    return grid.join(monthly, ["product_key", "date_key"], "left").select(
        "date_key", "product_key",
        F.coalesce(F.last("_stock", ignorenulls=True).over(so_far), F.lit(0)).alias("stock_on_hand"),
        *[F.coalesce(name, F.lit(0)).alias(name) for name in ("units_received", "units_sold", "stockout_days")],
        F.col("units_sold").isNull().alias("is_carried"))


def inventory_last(inventory: DataFrame) -> DataFrame:
    """Stock per category: the last value of each product, then the sum over products."""
    last = inventory.groupBy("product_id").agg(
        F.max_by(F.struct("category", "stock_on_hand"), "snapshot_date").alias("last"))
    return last.groupBy(F.col("last.category").alias("category")).agg(
        F.count("*").alias("num_products"), F.sum("last.stock_on_hand").alias("stock_on_hand"))


def inventory_average(inventory: DataFrame) -> DataFrame:
    """Stock per category: the sum over products of each month, then the mean over months."""
    monthly = inventory.groupBy("category", "snapshot_date").agg(F.sum("stock_on_hand").alias("stock"))
    return monthly.groupBy("category").agg(
        F.count("*").alias("num_months"), ratio(F.sum("stock"), F.count("stock")).alias("avg_stock"))


def sell_through(inventory: DataFrame) -> DataFrame:
    """Ratio of sums beside the misleading mean of ratios."""
    offered = F.col("units_sold") + F.col("stock_on_hand")
    share = F.round(ratio(F.col("units_sold"), offered), 6).cast("decimal(18,6)")
    return inventory.groupBy("category").agg(
        ratio(F.sum("units_sold"), F.sum(offered)).alias("ratio_of_sums"),
        ratio(F.sum(share), F.count(share)).alias("mean_of_ratios"))


# --- promotions: factless coverage and bridge -----------------------------------------------

def promo_coverage(promotions: DataFrame) -> DataFrame:
    """Factless: one row per promotion and day it runs; a date range becomes an equi-join key."""
    return promotions.filter("start_date <= end_date").select(
        "promo_id", F.explode(F.sequence("start_date", "end_date")).alias("date_key"))


def concurrent_promos(coverage: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Promotions that run in each month, and promotion days; days outside the calendar have no month."""
    per_day = coverage.groupBy("date_key", "promo_id").agg(F.count("*").alias("n"))
    return (per_day.join(dim_date.select("date_key", "year_month"), "date_key", "left")
            .groupBy("year_month")
            .agg(F.countDistinct("promo_id").alias("num_promos"), F.sum("n").alias("promo_days")))


def unused_promos(coverage: DataFrame, bridge: DataFrame) -> DataFrame:
    """Promotions that ran but are on no order line, neither first nor second."""
    days = coverage.groupBy("promo_id").agg(F.count("*").alias("days_active"))
    return without_match(days, bridge, ["promo_id"])


def promo_bridge(items: DataFrame) -> DataFrame:
    """One row per line and promotion; the weight splits a line's amount, so sums stay right."""
    promos = F.array_compact(F.array("promo_id", "promo_id_2"))
    lines = items.select("order_id", "product_id", "line_amount", promos.alias("promos"))
    return lines.select(
        "order_id", "product_id", F.explode("promos").alias("promo_id"),
        ratio(F.lit(1), F.size("promos")).alias("weight"), "line_amount")


def bridge_revenue(bridge: DataFrame, promotions: DataFrame) -> DataFrame:
    """Per promotion: lines touched, full amount (counts a line twice) and allocated amount."""
    per_promo = bridge.groupBy("promo_id").agg(
        F.count("*").alias("num_lines"), exact_sum("line_amount").alias("touched"),
        F.sum((F.col("weight") * F.col("line_amount")).cast("decimal(18,4)")).alias("allocated"))
    return per_promo.join(promotions.select("promo_id", "promo_name"), "promo_id").select(
        "promo_id", "promo_name", "num_lines", F.col("touched").cast("double").alias("touched_revenue"),
        F.col("allocated").cast("double").alias("allocated_revenue"))


# --- conformed dimensions -----------------------------------------------------------------

def drill_across(fact: DataFrame, returns_fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Revenue and refunds by the same category, each aggregated on its own, then joined."""
    categories = dim_product.select(F.col("product_id").alias("product_key"), "category")

    def by_category(df: DataFrame, amount: str, name: str) -> DataFrame:
        per_product = df.groupBy("product_key").agg(exact_sum(amount).alias(name))
        return (per_product.join(categories, "product_key")
                .groupBy("category").agg(add_up(name).alias(name)))

    sold = by_category(fact, "net_amount", "revenue")
    returned = by_category(returns_fact, "refund_amount", "refunds")
    return sold.join(returned, "category", "full").select(
        "category", "revenue", "refunds", ratio(F.col("refunds"), F.col("revenue")).alias("refund_rate"))


def region_two_ways(orders: DataFrame, geography: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Orders by the region they went to and by the region the customer lives in now."""
    places = geography.select("zip", F.col("region").alias("order_region"))
    homes = dim_customer.select("customer_id", F.col("region").alias("customer_region"))
    sent = skew_join(orders.select("zip", "customer_id"), places, ["zip"], "left")
    per_customer = sent.groupBy("customer_id", "order_region").agg(F.count("*").alias("n"))
    return (per_customer.join(homes, "customer_id", "left")
            .groupBy("order_region", "customer_region").agg(F.sum("n").alias("num_orders")))


def bus_matrix(facts: dict[str, tuple[DataFrame, dict[str, str]]],
               dimensions: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Fact by dimension: rows, and rows whose key the dimension knows.

    `facts` maps a name to its frame and to `dimension -> key column`. All cells come from one pass, see `inclusions`.
    """
    columns = {name: (fact, list(dict.fromkeys(keys.values()))) for name, (fact, keys) in facts.items()}
    cells = [(fact, dim, keys.get(dim)) for fact, (_, keys) in facts.items() for dim in dimensions]
    spark = next(iter(facts.values()))[0].sparkSession
    grid = spark.createDataFrame(cells, "fact string, dimension string, key_column string")
    found = inclusions(columns, dimensions).select("fact", "dimension", "key_column", "num_rows", "matched_rows")
    return grid.join(found, ["fact", "dimension", "key_column"], "left").select(
        "fact", "dimension", F.col("key_column").isNotNull().alias("usable"), "num_rows", "matched_rows")


# --- customers over time ------------------------------------------------------------------

def customer_snapshots(customers: DataFrame, orders: DataFrame, days: tuple[str, ...]) -> DataFrame:
    """One row per day and customer known by then: the address is where the latest order by that day went.

    Customers and orders are read once for all days; the latest address of each
    day is one aggregate of the same grouping.
    """
    dates = [F.lit(day).cast("date") for day in days]
    latest = [F.max_by("zip", F.when(F.col("order_date") <= day, F.struct("order_date", "order_id"))) for day in dates]
    moved = orders.groupBy("customer_id").agg(F.array(*latest).alias("_zips"))
    both = customers.select("customer_id", "zip", "acquisition_channel", "signup_date").join(moved, "customer_id", "left")
    per_day = [F.when(F.col("signup_date") <= day, F.struct(
        day.alias("snapshot_date"), F.coalesce(F.col("_zips")[k], F.col("zip")).alias("zip"))) for k, day in enumerate(dates)]
    return both.select("customer_id", "acquisition_channel", F.inline(F.array_compact(F.array(*per_day)))).select(
        "customer_id", "zip", "acquisition_channel", "snapshot_date")


def orders_as_of(orders: DataFrame, history: DataFrame) -> DataFrame:
    """Each order with the customer version that was valid on its day, or the unknown member."""
    versions = history.select(
        "customer_id", F.col("zip").alias("customer_zip"), "valid_from", "valid_to",
        surrogate_key("customer_id", "valid_from").alias("customer_sk"))
    in_force = (F.col("order_date") >= F.col("valid_from")) & (
        F.col("valid_to").isNull() | (F.col("order_date") < F.col("valid_to")))
    placed = orders.select("order_id", "customer_id", "order_date")
    return skew_join(placed, versions, ["customer_id"], "left",
                     condition=in_force).select(
        "order_id", "customer_id", "order_date", "customer_zip", "valid_from",
        or_unknown("customer_sk").alias("customer_sk"))


def surrogate_key_audit(history: DataFrame, placed: DataFrame) -> DataFrame:
    """Versions against distinct keys (equal: no collision), and orders with the unknown member."""
    keyed = history.select(surrogate_key("customer_id", "valid_from").alias("k")).agg(
        F.count("*").alias("versions"), F.countDistinct("k").alias("distinct keys"))
    orders = placed.agg(F.count("*").alias("orders"),
                        F.count_if(F.col("customer_sk") == UNKNOWN_MEMBER).alias("unknown member orders"))
    return reduce(DataFrame.unionByName, [
        frame.select(F.lit(name).alias("measure"), F.col(name).alias("num_rows"))
        for frame in (keyed, orders) for name in frame.columns])
