"""Gold: four dimensions, the order-line fact and two daily aggregates.

No sort here: a written table does not keep an order, readers sort.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.functions.calendar import date_attributes, year_month
from granary.functions.money import add_up, exact_sum, ratio
from granary.operators.joins import skew_join
from granary.sources import vocab


def dim_date(spine: DataFrame) -> DataFrame:
    return date_attributes(spine)


def dim_customer(customers: DataFrame, geography: DataFrame) -> DataFrame:
    """One flat row per customer; an unknown zip keeps the customer without a region.

    City is the customer's own, region and district are those of the zip.
    """
    places = geography.select("zip", "region", "district")
    return skew_join(customers, places, ["zip"], "left").select(
        "customer_id", "gender", "age_group", "acquisition_channel", "signup_date",
        F.year("signup_date").alias("signup_year"),
        year_month(F.col("signup_date")).alias("signup_year_month"),
        "zip", "city", "region", "district",
    )


def dim_product(products: DataFrame) -> DataFrame:
    """The names say that prices are today's, so nobody computes past revenue from them."""
    return products.select(
        "product_id", "product_name", "category", "segment", "size", "color",
        F.col("price").alias("current_list_price"),
        F.col("cogs").alias("current_unit_cost"),
        F.col("list_margin").alias("current_list_margin"),
    )


def no_promo_member(promotions: DataFrame) -> DataFrame:
    """One row, typed like `promotions`, that stands for "no promotion"."""
    values = {
        "promo_id": vocab.NO_PROMO, "promo_name": vocab.NO_PROMO_NAME,
        "promo_type": vocab.NO_PROMO_CODE, "promo_channel": vocab.NO_PROMO_CODE,
        "discount_value": 0.0, "min_order_value": 0.0, "is_stackable": False,
    }
    columns = [F.lit(values.get(field.name)).cast(field.dataType).alias(field.name)
               for field in promotions.schema]
    return promotions.sparkSession.range(1).select(*columns)


def dim_promotion(promotions: DataFrame) -> DataFrame:
    """With the extra member no fact row has a NULL promotion, so star joins may be inner."""
    return promotions.unionByName(no_promo_member(promotions))


def fact_order_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per order line."""
    header = orders.select("order_id", "order_date", "customer_id", "order_status",
                           "payment_method", "device_type", "order_source")
    lines = skew_join(items, header, ["order_id"])
    return lines.select(
        F.col("order_date").alias("date_key"),
        F.col("customer_id").alias("customer_key"),
        F.col("product_id").alias("product_key"),
        F.coalesce("promo_id", F.lit(vocab.NO_PROMO)).alias("promo_key"),
        "order_id", "order_status", "payment_method", "device_type", "order_source",
        F.col("promo_id_2").alias("promo_id_2_degenerate"),
        "quantity",
        (F.col("quantity") * F.col("unit_price")).alias("gross_amount"),
        "discount_amount",
        F.col("line_amount").alias("net_amount"),
        "unit_price",
    )


def orders_daily(orders: DataFrame) -> DataFrame:
    """Per day: orders, distinct customers and three states."""
    def in_state(state: str):
        return F.count_if(F.col("order_status") == state)

    return orders.groupBy("order_date").agg(
        F.count("*").alias("num_orders"),
        F.countDistinct("customer_id").alias("num_customers"),
        in_state("delivered").alias("num_delivered"),
        in_state("cancelled").alias("num_cancelled"),
        in_state("returned").alias("num_returned"),
    )


def revenue_daily(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Per day, whatever the order's state: lines, units, revenue, discount, mean order value.

    Lines shrink to one row per order before the join, so no order is too big
    for it, and the join's partitioning serves the distinct count as well.
    """
    per_order = items.groupBy("order_id").agg(
        F.count("*").alias("lines"),
        F.sum("quantity").alias("units"),
        exact_sum("line_amount").alias("net"),
        exact_sum("discount_amount").alias("discount"),
    )
    dated = per_order.join(orders.select("order_id", "order_date"), "order_id")
    return dated.groupBy("order_date").agg(
        F.countDistinct("order_id").alias("num_orders"),
        F.sum("lines").alias("num_lines"),
        F.sum("units").alias("num_units"),
        add_up("net").alias("revenue"),
        add_up("discount").alias("total_discount"),
    ).withColumn("avg_order_value", ratio(F.col("revenue"), F.col("num_orders")))
