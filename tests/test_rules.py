"""Each bronze rule on hand-made rows: one offence, two offences, and NULLs that stay valid."""

import datetime

import pytest

from granary.operators.flagging import flag, reason_histogram, valid_counts
from granary.sources.specs import SPECS

DAY = datetime.date(2020, 5, 17)
LATER = datetime.date(2020, 6, 1)
CLEAN = {
    "customers": dict(customer_id=1, zip="01234", city="Hue", signup_date=DAY, gender="female",
                      age_group="18-24", acquisition_channel="direct"),
    "geography": dict(zip="01234", city="Hue", region="east", district="D1"),
    "inventory": dict(snapshot_date=DAY, product_id=1, stock_on_hand=1, units_received=1, units_sold=1,
                      stockout_days=0, days_of_supply=1.0, fill_rate=1.0, stockout_flag=0, overstock_flag=1,
                      reorder_flag=0, sell_through_rate=0.0, product_name="Cap", category="genz",
                      segment="trendy", year=2020, month=5),
    "order_items": dict(order_id=1, product_id=1, quantity=1, unit_price=0.0, discount_amount=0.0,
                        promo_id="P", promo_id_2=None),
    "orders": dict(order_id=1, order_date=DAY, customer_id=1, zip="01234", order_status="paid",
                   payment_method="cod", device_type="mobile", order_source="app"),
    "payments": dict(order_id=1, payment_method="cod", payment_value=1.0, installments=1),
    "products": dict(product_id=1, product_name="Cap", category="genz", segment="trendy", size="s",
                     color="red", price=2.0, cogs=2.0),
    "promotions": dict(promo_id="P", promo_name="Sale", promo_type="percentage", discount_value=100.0,
                       start_date=DAY, end_date=DAY, applicable_category="genz", promo_channel="email",
                       stackable_flag=1, min_order_value=0.0),
    "returns": dict(return_id="R", order_id=1, product_id=1, return_date=DAY, return_reason="defective",
                    return_quantity=1, refund_amount=0.0),
    "reviews": dict(review_id="V", order_id=1, product_id=1, customer_id=1, review_date=DAY, rating=5,
                    review_title="Good"),
    "sales_daily": dict(sale_date=DAY, revenue=0.0, cogs=0.0),
    "shipments": dict(order_id=1, ship_date=DAY, delivery_date=DAY, shipping_fee=0.0),
    "web_traffic": dict(traffic_date=DAY, sessions=2, unique_visitors=2, page_views=2, bounce_rate=1.0,
                        avg_session_duration_sec=0.0, traffic_source="direct"),
}

# (table, changed columns, expected reason).
BROKEN = [
    ("customers", dict(signup_date=None), "signup_date_missing"),
    ("customers", dict(zip=None), "zip_missing"),
    ("customers", dict(gender="x"), "gender_unknown"),
    ("customers", dict(age_group="0-17"), "age_group_unknown"),
    ("customers", dict(acquisition_channel=""), "channel_unknown"),
    ("geography", dict(zip=None), "zip_missing"),
    ("geography", dict(city=None), "city_missing"),
    ("geography", dict(region="north"), "region_unknown"),
    ("inventory", dict(stock_on_hand=-1), "stock_on_hand_negative"),
    ("inventory", dict(units_received=-1), "units_received_negative"),
    ("inventory", dict(units_sold=-1), "units_sold_negative"),
    ("inventory", dict(stockout_days=-1), "stockout_days_negative"),
    ("inventory", dict(fill_rate=1.01), "fill_rate_out_of_range"),
    ("inventory", dict(sell_through_rate=-0.01), "sell_through_out_of_range"),
    ("inventory", dict(stockout_flag=2), "stockout_flag_invalid"),
    ("inventory", dict(overstock_flag=-1), "overstock_flag_invalid"),
    ("inventory", dict(reorder_flag=9), "reorder_flag_invalid"),
    ("inventory", dict(year=2021), "year_mismatch"),
    ("inventory", dict(month=6), "month_mismatch"),
    ("inventory", dict(category="x"), "category_unknown"),
    ("inventory", dict(segment="x"), "segment_unknown"),
    ("order_items", dict(product_id=None), "product_id_missing"),
    ("order_items", dict(quantity=0), "quantity_invalid"),
    ("order_items", dict(quantity=None), "quantity_invalid"),
    ("order_items", dict(unit_price=-0.5), "unit_price_invalid"),
    ("order_items", dict(unit_price=None), "unit_price_invalid"),
    ("order_items", dict(discount_amount=-1.0), "discount_negative"),
    ("orders", dict(customer_id=None), "customer_id_missing"),
    ("orders", dict(order_date=None), "order_date_missing"),
    ("orders", dict(order_status="lost"), "status_unknown"),
    ("payments", dict(payment_value=0.0), "payment_value_invalid"),
    ("payments", dict(payment_value=None), "payment_value_invalid"),
    ("payments", dict(installments=0), "installments_invalid"),
    ("payments", dict(installments=None), "installments_invalid"),
    ("payments", dict(payment_method="cash"), "method_unknown"),
    ("products", dict(product_name=None), "product_name_missing"),
    ("products", dict(price=None), "price_invalid"),
    ("products", dict(price=0.0, cogs=0.0), "price_invalid"),
    ("products", dict(cogs=None), "cogs_invalid"),
    ("products", dict(cogs=-1.0), "cogs_invalid"),
    ("products", dict(cogs=2.5), "cogs_above_price"),
    ("products", dict(category="x"), "category_unknown"),
    ("products", dict(segment="x"), "segment_unknown"),
    ("products", dict(size="xxl"), "size_unknown"),
    ("promotions", dict(start_date=None), "start_date_missing"),
    ("promotions", dict(end_date=None), "end_date_missing"),
    ("promotions", dict(start_date=LATER), "end_before_start"),
    ("promotions", dict(discount_value=0.0), "discount_value_invalid"),
    ("promotions", dict(discount_value=None), "discount_value_invalid"),
    ("promotions", dict(discount_value=100.5), "percentage_above_100"),
    ("promotions", dict(min_order_value=-1.0), "min_order_value_negative"),
    ("promotions", dict(promo_type="gift"), "promo_type_unknown"),
    ("promotions", dict(promo_channel="radio"), "promo_channel_unknown"),
    ("returns", dict(order_id=None), "order_id_missing"),
    ("returns", dict(product_id=None), "product_id_missing"),
    ("returns", dict(return_date=None), "return_date_missing"),
    ("returns", dict(return_quantity=0), "return_quantity_invalid"),
    ("returns", dict(return_quantity=None), "return_quantity_invalid"),
    ("returns", dict(refund_amount=-1.0), "refund_amount_invalid"),
    ("returns", dict(refund_amount=None), "refund_amount_invalid"),
    ("returns", dict(return_reason="bored"), "reason_unknown"),
    ("reviews", dict(order_id=None), "order_id_missing"),
    ("reviews", dict(product_id=None), "product_id_missing"),
    ("reviews", dict(customer_id=None), "customer_id_missing"),
    ("reviews", dict(review_date=None), "review_date_missing"),
    ("reviews", dict(rating=6), "rating_out_of_range"),
    ("reviews", dict(rating=None), "rating_out_of_range"),
    ("sales_daily", dict(sale_date=None), "sale_date_missing"),
    ("sales_daily", dict(revenue=-1.0), "revenue_invalid"),
    ("sales_daily", dict(revenue=None), "revenue_invalid"),
    ("sales_daily", dict(cogs=None), "cogs_invalid"),
    ("shipments", dict(ship_date=None), "ship_date_missing"),
    ("shipments", dict(ship_date=LATER), "delivery_before_ship"),
    ("shipments", dict(shipping_fee=-1.0), "shipping_fee_invalid"),
    ("shipments", dict(shipping_fee=None), "shipping_fee_invalid"),
    ("web_traffic", dict(traffic_date=None), "traffic_date_missing"),
    ("web_traffic", dict(sessions=None), "sessions_invalid"),
    ("web_traffic", dict(unique_visitors=-1), "unique_visitors_negative"),
    ("web_traffic", dict(page_views=-1, sessions=None), "sessions_invalid, page_views_negative"),
    ("web_traffic", dict(page_views=-1), "page_views_negative, page_views_below_sessions"),
    ("web_traffic", dict(unique_visitors=3), "visitors_above_sessions"),
    ("web_traffic", dict(page_views=1), "page_views_below_sessions"),
    ("web_traffic", dict(bounce_rate=-0.1), "bounce_rate_out_of_range"),
    ("web_traffic", dict(avg_session_duration_sec=-1.0), "duration_negative"),
    ("web_traffic", dict(traffic_source="bot"), "source_unknown"),
    ("orders", dict(order_status="lost", customer_id=None, order_date=None),
     "customer_id_missing, order_date_missing, status_unknown"),
    ("products", dict(cogs=9.0, size="?"), "cogs_above_price, size_unknown"),
]

# NULLs and texts that no rule objects to.
HARMLESS = [
    ("customers", dict(gender=None, age_group=None, acquisition_channel=None, customer_id=None)),
    ("customers", dict(zip="  ", city=None)),
    ("customers", dict(gender=" Female ", age_group=" 55+", acquisition_channel="DIRECT")),
    ("geography", dict(region=None, district=None)),
    ("inventory", dict(stock_on_hand=None, units_received=None, units_sold=None, fill_rate=None,
                       sell_through_rate=None, stockout_flag=None, category=None, segment=None, year=None)),
    ("inventory", dict(snapshot_date=None)),
    ("order_items", dict(discount_amount=None, promo_id=None, order_id=None)),
    ("orders", dict(order_status=None, payment_method=None, zip=None)),
    ("payments", dict(payment_method=None)),
    ("products", dict(category=None, segment=None, size=None)),
    ("promotions", dict(promo_type="fixed", discount_value=5000.0, min_order_value=None)),
    ("promotions", dict(promo_type=None, promo_channel=None, applicable_category="  ")),
    ("returns", dict(return_reason=None, return_id=None)),
    ("reviews", dict(review_title="  ", rating=1)),
    ("shipments", dict(delivery_date=None)),
    ("web_traffic", dict(unique_visitors=None, page_views=None, bounce_rate=None, traffic_source=None)),
]


def _flagged(spark, table, rows):
    spec = SPECS[table]
    data = [tuple({**CLEAN[table], **row}[name] for name in spec.names) for row in rows]
    relaxed = spec.schema
    for field in relaxed:
        field.nullable = True
    return flag(spark.createDataFrame(data, relaxed).coalesce(1), spec)


@pytest.mark.parametrize("table", sorted(CLEAN))
def test_rules_of_a_table(spark, table):
    broken = [(row, reason) for name, row, reason in BROKEN if name == table]
    harmless = [row for name, row in HARMLESS if name == table]
    result = _flagged(spark, table, [{}, *harmless, *[row for row, _ in broken]]).collect()
    expected = [None] * (1 + len(harmless)) + [reason for _, reason in broken]
    assert [row["_invalid_reason"] for row in result] == expected
    assert [row["_is_valid"] for row in result] == [reason is None for reason in expected]


def test_every_rule_is_broken():
    """Alone, but for negative page views: these are also below any number of sessions."""
    alone = {(table, reason) for table, _, reason in BROKEN if ", " not in reason}
    rules = {(name, rule.code) for name, spec in SPECS.items() for rule in spec.rules}
    assert len(rules) == 72
    assert rules - alone == {("web_traffic", "page_views_negative")}


def test_normalised_text(spark):
    row = _flagged(spark, "promotions", [dict(
        promo_id=" P-1 ", promo_name=" Spring Sale ", promo_type=" FIXED", applicable_category="   ",
        promo_channel="Email ")]).first()
    assert (row.promo_id, row.promo_name, row.promo_type) == ("P-1", "Spring Sale", "fixed")
    assert (row.applicable_category, row.promo_channel) == (None, "email")
    item = _flagged(spark, "order_items", [dict(promo_id="  ", promo_id_2=" P ")]).first()
    assert (item.promo_id, item.promo_id_2) == (None, "P")
    assert _flagged(spark, "customers", [dict(zip="   ")]).first().zip == ""


def test_loss_day_is_information_not_an_error(spark):
    row = _flagged(spark, "sales_daily", [dict(revenue=1.0, cogs=2.0)]).first()
    assert row["_is_valid"] and row["_margin_negative"]


def test_reports_on_flags(spark):
    df = _flagged(spark, "orders", [{}, dict(customer_id=None), dict(customer_id=None, order_date=None)])
    assert tuple(valid_counts(df).first()) == (3, 1, 2)
    per_code = {row.reason: row.num_rows for row in reason_histogram(df, per_code=True).collect()}
    assert per_code == {"customer_id_missing": 2, "order_date_missing": 1}
