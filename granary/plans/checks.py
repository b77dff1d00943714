"""The declared data checks: 112 column checks and the grain check, per model.

Fixed values, but for the years of `dim_date`, which follow its calendar.
"""

from datetime import date, timedelta

from granary.operators.quality import Check, accepted, in_range, not_null, related, unique
from granary.sources import vocab

SOURCE_CHECKS = {
    "orders": [not_null("order_id"), unique("order_id")],
    "order_items": [not_null("order_id"), not_null("product_id")],
    "customers": [not_null("customer_id"), unique("customer_id"), not_null("zip")],
    "geography": [not_null("zip"), unique("zip")],
    "products": [not_null("product_id"), unique("product_id")],
    "promotions": [not_null("promo_id"), unique("promo_id")],
}

SILVER_CHECKS = {
    "silver_customers": [
        not_null("customer_id"), unique("customer_id"),
        not_null("zip"), related("zip", "silver_geography", "zip"),
        accepted("gender", vocab.GENDERS),
        accepted("age_group", vocab.AGE_GROUPS),
        accepted("acquisition_channel", vocab.CHANNELS),
        not_null("signup_date"),
    ],
    "silver_geography": [
        not_null("zip"), unique("zip"), not_null("city"), accepted("region", vocab.REGIONS),
    ],
    "silver_order_items": [
        not_null("order_id"), related("order_id", "silver_orders", "order_id"),
        not_null("product_id"), in_range("quantity", above=0), in_range("line_amount", low=0),
    ],
    "silver_orders": [
        not_null("order_id"), unique("order_id"), not_null("customer_id"), not_null("order_date"),
        accepted("order_status", vocab.ORDER_STATUSES),
    ],
    "silver_products": [
        not_null("product_id"), unique("product_id"), not_null("product_name"),
        accepted("category", vocab.CATEGORIES), accepted("size", vocab.SIZES),
        not_null("price"), in_range("price", above=0), in_range("cogs", low=0),
        in_range("list_margin", low=0),
    ],
    "silver_promotions": [
        not_null("promo_id"), unique("promo_id"),
        accepted("promo_type", vocab.PROMO_TYPES), accepted("promo_channel", vocab.PROMO_CHANNELS),
        not_null("discount_value"), in_range("discount_value", above=0),
        in_range("duration_days", low=0), not_null("is_stackable"),
    ],
}


def gold_checks(calendar: tuple[str, str]) -> dict[str, list[Check]]:
    """`calendar` is the first day of the date dimension and the day after its last."""
    first_year = date.fromisoformat(calendar[0]).year
    last_year = (date.fromisoformat(calendar[1]) - timedelta(days=1)).year
    return {
        "dim_customer": [
            not_null("customer_id"), unique("customer_id"),
            not_null("region"), accepted("region", vocab.REGIONS), not_null("city"),
            accepted("gender", vocab.GENDERS), accepted("acquisition_channel", vocab.CHANNELS),
            not_null("signup_year"),
        ],
        "dim_date": [
            not_null("date_key"), unique("date_key"), not_null("year"),
            in_range("year", low=first_year, high=last_year),
            in_range("quarter", low=1, high=4), in_range("month", low=1, high=12),
            in_range("day_of_week", low=1, high=7), not_null("is_weekend"),
        ],
        "dim_product": [
            not_null("product_id"), unique("product_id"), not_null("product_name"),
            not_null("category"), accepted("category", vocab.CATEGORIES), accepted("size", vocab.SIZES),
            not_null("current_list_price"), in_range("current_list_price", above=0),
            in_range("current_list_margin", low=0),
        ],
        "dim_promotion": [
            not_null("promo_id"), unique("promo_id"), not_null("promo_name"),
            accepted("promo_type", (*vocab.PROMO_TYPES, vocab.NO_PROMO_CODE)), not_null("is_stackable"),
        ],
        "fact_order_items": [
            not_null("date_key"), related("date_key", "dim_date", "date_key"),
            not_null("customer_key"), related("customer_key", "dim_customer", "customer_id"),
            not_null("product_key"), related("product_key", "dim_product", "product_id"),
            not_null("promo_key"), related("promo_key", "dim_promotion", "promo_id"),
            not_null("order_id"), accepted("order_status", vocab.ORDER_STATUSES),
            not_null("quantity"), in_range("quantity", above=0),
            not_null("gross_amount"), in_range("gross_amount", low=0),
            not_null("net_amount"), in_range("net_amount", low=0),
            not_null("unit_price"), in_range("unit_price", above=0),
        ],
        "gold_orders_daily": [
            not_null("order_date"), unique("order_date"),
            not_null("num_orders"), in_range("num_orders", above=0),
        ],
        "gold_revenue_daily": [
            not_null("order_date"), unique("order_date"),
            not_null("num_orders"), in_range("num_orders", above=0), in_range("num_units", above=0),
            not_null("revenue"), in_range("revenue", low=0), in_range("total_discount", low=0),
        ],
    }


def model_checks(calendar: tuple[str, str]) -> dict[str, list[Check]]:
    return {**SILVER_CHECKS, **gold_checks(calendar)}


# Fact rows must equal the silver rows the fact is made from.
GRAIN_CHECK = ("fact_order_items", "silver_order_items")
