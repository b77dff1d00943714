"""Reports. Each function takes frames of any layer and returns a lazy frame.

Whatever joins two many-sides aggregates both to the common grain first.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.functions.calendar import days_between
from granary.functions.money import add_up, exact, exact_sum, exact_total, ratio, total
from granary.operators.joins import skew_join, without_match
from granary.sources import vocab


def _line_amount():
    """Amount of a bronze line; a missing discount is no discount."""
    return F.col("quantity") * F.col("unit_price") - F.coalesce("discount_amount", F.lit(0.0))


# --- money and orders ---------------------------------------------------------------------

def revenue_by_category(items: DataFrame, orders: DataFrame, products: DataFrame, since: str) -> DataFrame:
    recent = orders.filter(F.col("order_date") >= F.lit(since).cast("date")).select("order_id")
    lines = skew_join(items.select("order_id", "product_id", _line_amount().alias("amount")),
                      recent, ["order_id"])
    per_product = lines.groupBy("product_id").agg(exact_sum("amount").alias("amount"))
    return (per_product.join(products.select("product_id", "category"), "product_id")
            .groupBy("category").agg(add_up("amount").alias("revenue"))
            .orderBy(F.desc("revenue")))


def orders_by_region(orders: DataFrame, geography: DataFrame) -> DataFrame:
    """By the address the order went to, without a detour over customers."""
    placed = skew_join(orders.select("zip", "order_id"), geography.select("zip", "region"), ["zip"])
    return placed.groupBy("region").agg(F.countDistinct("order_id").alias("num_orders"))


def orders_by_status(orders: DataFrame) -> DataFrame:
    return orders.groupBy("order_status").agg(F.count("*").alias("num_orders"))


def cohort_revenue(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Signup year and channel: buying customers and their revenue."""
    per_customer = fact.groupBy("customer_key").agg(exact_sum("net_amount").alias("net"))
    members = dim_customer.select(F.col("customer_id").alias("customer_key"), "signup_year",
                                  "acquisition_channel")
    return (per_customer.join(members, "customer_key")
            .groupBy("signup_year", "acquisition_channel")
            .agg(F.countDistinct("customer_key").alias("num_customers"), add_up("net").alias("revenue"))
            .orderBy("signup_year", F.desc("revenue")))


def top_days(daily: DataFrame, k: int = 20, newest: bool = False) -> DataFrame:
    """The first or last k days of a daily table."""
    return daily.orderBy(F.desc("order_date") if newest else F.asc("order_date")).limit(k)


# --- star queries -------------------------------------------------------------------------

def star_four_dims(fact: DataFrame, dim_date: DataFrame, dim_customer: DataFrame, dim_product: DataFrame,
                   dim_promotion: DataFrame, year: int) -> DataFrame:
    """Weekend orders and revenue of one year by region, category and promotion type.

    Dimensions are best stored tables, whose true size decides how they are joined.
    """
    dimensions = {
        "promo_key": dim_promotion.select(F.col("promo_id").alias("promo_key"), "promo_type"),
        "product_key": dim_product.select(F.col("product_id").alias("product_key"), "category"),
        "customer_key": dim_customer.select(F.col("customer_id").alias("customer_key"), "region"),
    }
    days = dim_date.filter((F.col("year") == year) & F.col("is_weekend")).select("date_key", "year")
    lines = fact.join(days, "date_key").select("year", "order_id", *dimensions,
                                               exact("net_amount").alias("net"))
    for key, dimension in dimensions.items():
        lines = skew_join(lines, dimension, [key])
    return (lines.groupBy("year", "region", "category", "promo_type")
            .agg(F.countDistinct("order_id").alias("num_orders"), add_up("net").alias("revenue"))
            .orderBy(F.desc("revenue")))


def weekend_vs_weekday(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Revenue adds up; a unit price is averaged, never added up.

    Days outside the calendar are a row of their own, with no day kind.
    """
    per_day = fact.groupBy("date_key").agg(
        exact_sum("net_amount").alias("net"), exact_sum("unit_price").alias("prices"),
        F.count("unit_price").alias("n"))
    return (per_day.join(dim_date.select("date_key", "is_weekend"), "date_key", "left")
            .groupBy("is_weekend")
            .agg(add_up("net").alias("revenue"), ratio(F.sum("prices"), F.sum("n")).alias("avg_unit_price")))


def promo_effectiveness(fact: DataFrame, dim_promotion: DataFrame) -> DataFrame:
    """Orders and money per promotion, "no promotion" included.

    Distinct orders are the first lines of each promotion and order. A window finds
    these in the partitioning by order that the fact's join leaves: it sorts lines,
    and no task holds a group with totals for each of its orders.
    """
    amounts = {"gross": "gross_amount", "discount": "discount_amount", "net": "net_amount"}
    promotions = dim_promotion.select(F.col("promo_id").alias("promo_key"), "promo_name", "promo_type")
    lines = fact.select("promo_key", "order_id",
                        *[exact(column).alias(name) for name, column in amounts.items()])
    one_order = Window.partitionBy("order_id", "promo_name", "promo_type").orderBy("order_id")
    is_first = F.col("order_id").isNotNull() & (F.row_number().over(one_order) == 1)
    return (skew_join(lines, promotions, ["promo_key"]).withColumn("_is_first", is_first)
            .groupBy("promo_name", "promo_type")
            .agg(F.count_if("_is_first").alias("num_orders"),
                 add_up("gross").alias("before_discount"), add_up("discount").alias("total_discount"),
                 add_up("net").alias("revenue"))
            .orderBy(F.desc("revenue")))


def no_promo_share(fact: DataFrame) -> DataFrame:
    """Share of lines and share of revenue; the two are different figures."""
    none = F.col("promo_key") == vocab.NO_PROMO
    sums = fact.agg(
        F.count("*").alias("num_lines"), F.count_if(none).alias("no_promo_lines"),
        total("net_amount").alias("revenue"),
        F.sum(F.when(none, exact("net_amount"))).cast("double").alias("no_promo_revenue"))
    return sums.select("*", ratio(F.col("no_promo_lines"), F.col("num_lines")).alias("line_share"),
                       ratio(F.col("no_promo_revenue"), F.col("revenue")).alias("revenue_share"))


def null_key_loss(items: DataFrame, dim_promotion: DataFrame) -> DataFrame:
    """Lines that survive an inner join to promotions with the raw key and with the extra member."""
    per_key = items.groupBy(F.col("promo_id").alias("raw_key")).agg(F.count("*").alias("n")).withColumn(
        "promo_id", F.coalesce("raw_key", F.lit(vocab.NO_PROMO)))
    known = dim_promotion.select("promo_id", F.lit(True).alias("known"))

    def lines(condition) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    return per_key.join(known, "promo_id", "left").agg(
        lines(F.lit(True)).alias("num_lines"),
        lines(F.col("known") & F.col("raw_key").isNotNull()).alias("kept_with_null_key"),
        lines(F.col("known")).alias("kept_with_member"))


# --- shipping -----------------------------------------------------------------------------

def shipping_by_status(orders: DataFrame, shipments: DataFrame) -> DataFrame:
    """Orders, shipped orders and mean days on the road; orders without shipment stay."""
    days = days_between(F.col("ship_date"), F.col("delivery_date"))
    per_order = shipments.groupBy("order_id").agg(
        F.count("*").alias("n"), F.sum(days).alias("days"), F.count(days).alias("dated"))
    return (orders.select("order_id", "order_status").join(per_order, "order_id", "left")
            .groupBy("order_status")
            .agg(F.sum(F.coalesce("n", F.lit(1))).alias("num_orders"),
                 F.coalesce(F.sum("n"), F.lit(0)).alias("num_shipped"),
                 ratio(F.sum("days"), F.sum("dated")).alias("avg_delivery_days")))


def missing_shipments(orders: DataFrame, shipments: DataFrame) -> DataFrame:
    """Orders in a state that implies a shipment, without one."""
    sent = orders.filter(F.col("order_status").isin(*vocab.SHIPPED_STATUSES))
    return without_match(sent.select("order_id", "order_date", "order_status"), shipments, ["order_id"])


def status_shipment_matrix(orders: DataFrame, shipments: DataFrame) -> DataFrame:
    shipped = shipments.select("order_id").distinct().withColumn("has_shipment", F.lit(True))
    return (orders.select("order_id", "order_status").join(shipped, "order_id", "left")
            .groupBy("order_status")
            .agg(F.count_if("has_shipment").alias("with_shipment"),
                 F.count_if(F.col("has_shipment").isNull()).alias("without_shipment")))


# --- returns ------------------------------------------------------------------------------

def _bought_and_returned(items: DataFrame, returns: DataFrame, how: str) -> DataFrame:
    pair = ["order_id", "product_id"]
    bought = items.groupBy(*pair).agg(F.sum("quantity").alias("bought"))
    returned = returns.groupBy(*pair).agg(F.sum("return_quantity").alias("returned"))
    return bought.join(returned, pair, how)


def returns_by_product(items: DataFrame, returns: DataFrame, products: DataFrame) -> DataFrame:
    per_product = (_bought_and_returned(items, returns, "left").groupBy("product_id")
                   .agg(F.sum("bought").alias("bought"), F.sum("returned").alias("returned")))
    return (per_product.join(products.select("product_id", "product_name"), "product_id")
            .groupBy("product_name")
            .agg(F.sum("bought").alias("units_sold"),
                 F.coalesce(F.sum("returned"), F.lit(0)).alias("units_returned")))


def over_returns(items: DataFrame, returns: DataFrame) -> DataFrame:
    """Pairs of order and product, and those with more units returned than bought."""
    return _bought_and_returned(items, returns, "inner").agg(
        F.count("*").alias("num_pairs"),
        F.count_if(F.col("returned") > F.col("bought")).alias("over_returned_pairs"))


# --- promotions ---------------------------------------------------------------------------

def promo_stacking(items: DataFrame, promotions: DataFrame) -> DataFrame:
    """Pairs of promotions on one line, with the stackable flag of both."""
    pairs = (items.filter("promo_id is not null and promo_id_2 is not null")
             .groupBy("promo_id", "promo_id_2").agg(F.count("*").alias("num_lines")))
    first = promotions.select("promo_id", F.col("stackable_flag").alias("stackable_1"))
    second = promotions.select(F.col("promo_id").alias("promo_id_2"),
                               F.col("stackable_flag").alias("stackable_2"))
    return pairs.join(first, "promo_id", "left").join(second, "promo_id_2", "left").select(
        "promo_id", "stackable_1", "promo_id_2", "stackable_2", "num_lines")


def discount_promo_consistency(items: DataFrame) -> DataFrame:
    has_promo = F.col("promo_id").isNotNull()
    discounted = F.coalesce(F.col("discount_amount") > 0, F.lit(False))
    return items.agg(
        F.count_if(has_promo).alias("with_promo"),
        F.count_if(discounted).alias("with_discount"),
        F.count_if(has_promo & ~discounted).alias("promo_without_discount"),
        F.count_if(~has_promo & discounted).alias("discount_without_promo"))


def list_price_match(items: DataFrame, products: DataFrame) -> DataFrame:
    """Lines of known products, and those sold at exactly the current list price."""
    both = skew_join(items.select("product_id", "unit_price"), products.select("product_id", "price"),
                     ["product_id"])
    return both.agg(F.count("*").alias("num_lines"),
                    F.count_if(F.col("unit_price") == F.col("price")).alias("at_list_price"))


# --- days ---------------------------------------------------------------------------------

def traffic_vs_orders(traffic: DataFrame, orders: DataFrame) -> DataFrame:
    """Sessions and orders per traffic day; both sides are brought to one row per day first."""
    sessions = traffic.groupBy("traffic_date").agg(F.sum("sessions").alias("sessions"))
    placed = (orders.groupBy(F.col("order_date").alias("traffic_date"))
              .agg(F.countDistinct("order_id").alias("num_orders")))
    return sessions.join(placed, "traffic_date", "left").select(
        "traffic_date", "sessions", F.coalesce("num_orders", F.lit(0)).alias("num_orders"))


def days_without_orders(dim_date: DataFrame, orders: DataFrame) -> DataFrame:
    days = orders.select(F.col("order_date").alias("date_key"))
    return without_match(dim_date.select("date_key", "day_name", "is_weekend"), days, ["date_key"])


def loss_days(sales: DataFrame) -> DataFrame:
    """Days sold at a loss, against all days with a known margin."""
    loss = F.col("_margin_negative")
    return sales.agg(F.count("*").alias("num_days"), F.count_if(loss).alias("loss_days"),
                     ratio(F.count_if(loss), F.count(loss)).alias("loss_share"))


def reconcile_daily_orders(by_orders: DataFrame, by_items: DataFrame) -> DataFrame:
    """Days on which two gold tables count different numbers of orders."""
    sold = by_items.select("order_date", F.col("num_orders").alias("orders_sold"))
    placed = by_orders.select("order_date", F.col("num_orders").alias("orders_placed"))
    return placed.join(sold, "order_date", "left").filter(~F.col("orders_placed").eqNullSafe(F.col("orders_sold")))


def reconcile_two_sources(sales: DataFrame, revenue_daily: DataFrame) -> DataFrame:
    """The source's own daily revenue against ours: amount and percentage of the gap."""
    given = sales.groupBy(F.col("sale_date").alias("order_date")).agg(exact_sum("revenue").alias("given"))
    ours = revenue_daily.select("order_date", exact_total("revenue").alias("ours"))
    gap = F.col("given") - F.col("ours")
    return given.join(ours, "order_date", "full").select(
        "order_date", F.col("given").cast("double").alias("source_revenue"),
        F.col("ours").cast("double").alias("line_revenue"), gap.cast("double").alias("gap"),
        (ratio(gap, F.col("ours")) * 100).alias("gap_percent"))


def rollup_check(fact: DataFrame, revenue_daily: DataFrame) -> DataFrame:
    """Daily revenue rebuilt from the fact; the days on which the daily table differs.

    Both figures are one decimal total turned into a double once, so they are
    compared as doubles: equal totals stay equal at any size.
    """
    rebuilt = fact.groupBy(F.col("date_key").alias("order_date")).agg(
        exact_sum("net_amount").alias("rebuilt"), F.count("*").alias("rebuilt_lines"))
    stored = revenue_daily.select("order_date", F.col("revenue").alias("stored"), "num_lines")
    both = rebuilt.join(stored, "order_date", "full")
    same = F.col("rebuilt").cast("double").eqNullSafe(F.col("stored")) & F.col("rebuilt_lines").eqNullSafe(F.col("num_lines"))
    return both.agg(F.count("*").alias("num_days"), F.count_if(~same).alias("differing_days"),
                    add_up("rebuilt").alias("rebuilt_revenue"),
                    F.sum(exact_total("stored")).cast("double").alias("stored_revenue"))
