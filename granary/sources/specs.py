"""The 13 source tables: columns, normalisation, rules in order, layout.

Reason codes and their order are fixed values that consumers of
`_invalid_reason` depend on. Keys are BIGINT, so they outlast 32 bits.
"""

from granary.functions.text import code, code_or_null, trimmed, trimmed_or_null
from granary.operators.flagging import Rule, TableSpec, missing, missing_or, not_one_of, not_within
from granary.sources import vocab
from granary.sources.tables import Layout

CUSTOMERS = TableSpec(
    name="customers",
    columns="customer_id long!, zip string, city string, signup_date date, gender string, "
            "age_group string, acquisition_channel string",
    tidy={"zip": trimmed, "city": trimmed, "gender": code, "age_group": code, "acquisition_channel": code},
    rules=(
        Rule("signup_date_missing", missing("signup_date")),
        Rule("zip_missing", missing("zip")),
        Rule("gender_unknown", not_one_of("gender", vocab.GENDERS)),
        Rule("age_group_unknown", not_one_of("age_group", vocab.AGE_GROUPS)),
        Rule("channel_unknown", not_one_of("acquisition_channel", vocab.CHANNELS)),
    ),
    layout=Layout("year", "signup_date"),
)

GEOGRAPHY = TableSpec(
    name="geography",
    columns="zip string!, city string, region string, district string",
    tidy={"zip": trimmed, "city": trimmed, "region": code, "district": trimmed},
    rules=(
        Rule("zip_missing", missing("zip")),
        Rule("city_missing", missing("city")),
        Rule("region_unknown", not_one_of("region", vocab.REGIONS)),
    ),
)

INVENTORY = TableSpec(
    name="inventory",
    columns="snapshot_date date!, product_id long!, stock_on_hand long, units_received long, "
            "units_sold long, stockout_days integer, days_of_supply double, fill_rate double, "
            "stockout_flag integer, overstock_flag integer, reorder_flag integer, "
            "sell_through_rate double, product_name string, category string, segment string, "
            "year integer, month integer",
    tidy={"product_name": trimmed, "category": code, "segment": code},
    rules=(
        Rule("stock_on_hand_negative", "stock_on_hand < 0"),
        Rule("units_received_negative", "units_received < 0"),
        Rule("units_sold_negative", "units_sold < 0"),
        Rule("stockout_days_negative", "stockout_days < 0"),
        Rule("fill_rate_out_of_range", not_within("fill_rate", 0, 1)),
        Rule("sell_through_out_of_range", not_within("sell_through_rate", 0, 1)),
        Rule("stockout_flag_invalid", not_one_of("stockout_flag", (0, 1))),
        Rule("overstock_flag_invalid", not_one_of("overstock_flag", (0, 1))),
        Rule("reorder_flag_invalid", not_one_of("reorder_flag", (0, 1))),
        Rule("year_mismatch", "year <> year(snapshot_date)"),
        Rule("month_mismatch", "month <> month(snapshot_date)"),
        Rule("category_unknown", not_one_of("category", vocab.CATEGORIES)),
        Rule("segment_unknown", not_one_of("segment", vocab.SEGMENTS)),
    ),
    layout=Layout("year", "snapshot_date"),
)

ORDER_ITEMS = TableSpec(
    name="order_items",
    columns="order_id long!, product_id long, quantity long, unit_price double, "
            "discount_amount double, promo_id string, promo_id_2 string",
    tidy={"promo_id": trimmed_or_null, "promo_id_2": trimmed_or_null},
    rules=(
        Rule("product_id_missing", missing("product_id")),
        Rule("quantity_invalid", missing_or("quantity", "<= 0")),
        Rule("unit_price_invalid", missing_or("unit_price", "< 0")),
        Rule("discount_negative", "discount_amount < 0"),
    ),
    layout=Layout("bucket", "order_id"),
)

ORDERS = TableSpec(
    name="orders",
    columns="order_id long!, order_date date, customer_id long, zip string, order_status string, "
            "payment_method string, device_type string, order_source string",
    tidy={"zip": trimmed, "order_status": code, "payment_method": code, "device_type": code,
          "order_source": code},
    rules=(
        Rule("customer_id_missing", missing("customer_id")),
        Rule("order_date_missing", missing("order_date")),
        Rule("status_unknown", not_one_of("order_status", vocab.ORDER_STATUSES)),
    ),
    layout=Layout("month", "order_date"),
)

PAYMENTS = TableSpec(
    name="payments",
    columns="order_id long!, payment_method string, payment_value double, installments integer",
    tidy={"payment_method": code},
    rules=(
        Rule("payment_value_invalid", missing_or("payment_value", "<= 0")),
        Rule("installments_invalid", missing_or("installments", "< 1")),
        Rule("method_unknown", not_one_of("payment_method", vocab.PAYMENT_METHODS)),
    ),
    layout=Layout("bucket", "order_id"),
)

PRODUCTS = TableSpec(
    name="products",
    columns="product_id long!, product_name string, category string, segment string, size string, "
            "color string, price double, cogs double",
    tidy={"product_name": trimmed, "category": code, "segment": code, "size": code, "color": code},
    rules=(
        Rule("product_name_missing", missing("product_name")),
        Rule("price_invalid", missing_or("price", "<= 0")),
        Rule("cogs_invalid", missing_or("cogs", "< 0")),
        Rule("cogs_above_price", "cogs > price"),
        Rule("category_unknown", not_one_of("category", vocab.CATEGORIES)),
        Rule("segment_unknown", not_one_of("segment", vocab.SEGMENTS)),
        Rule("size_unknown", not_one_of("size", vocab.SIZES)),
    ),
)

PROMOTIONS = TableSpec(
    name="promotions",
    columns="promo_id string!, promo_name string, promo_type string, discount_value double, "
            "start_date date, end_date date, applicable_category string, promo_channel string, "
            "stackable_flag integer, min_order_value double",
    tidy={"promo_id": trimmed, "promo_name": trimmed, "promo_type": code, "promo_channel": code,
          "applicable_category": code_or_null},
    rules=(
        Rule("start_date_missing", missing("start_date")),
        Rule("end_date_missing", missing("end_date")),
        Rule("end_before_start", "end_date < start_date"),
        Rule("discount_value_invalid", missing_or("discount_value", "<= 0")),
        Rule("percentage_above_100",
             f"promo_type = 'percentage' and discount_value > {vocab.MAX_PERCENTAGE}"),
        Rule("min_order_value_negative", "min_order_value < 0"),
        Rule("promo_type_unknown", not_one_of("promo_type", vocab.PROMO_TYPES)),
        Rule("promo_channel_unknown", not_one_of("promo_channel", vocab.PROMO_CHANNELS)),
    ),
)

RETURNS = TableSpec(
    name="returns",
    columns="return_id string!, order_id long, product_id long, return_date date, "
            "return_reason string, return_quantity long, refund_amount double",
    tidy={"return_id": trimmed, "return_reason": code},
    rules=(
        Rule("order_id_missing", missing("order_id")),
        Rule("product_id_missing", missing("product_id")),
        Rule("return_date_missing", missing("return_date")),
        Rule("return_quantity_invalid", missing_or("return_quantity", "<= 0")),
        Rule("refund_amount_invalid", missing_or("refund_amount", "< 0")),
        Rule("reason_unknown", not_one_of("return_reason", vocab.RETURN_REASONS)),
    ),
    layout=Layout("year", "return_date"),
)

REVIEWS = TableSpec(
    name="reviews",
    columns="review_id string!, order_id long, product_id long, customer_id long, "
            "review_date date, rating integer, review_title string",
    tidy={"review_id": trimmed, "review_title": trimmed_or_null},
    rules=(
        Rule("order_id_missing", missing("order_id")),
        Rule("product_id_missing", missing("product_id")),
        Rule("customer_id_missing", missing("customer_id")),
        Rule("review_date_missing", missing("review_date")),
        Rule("rating_out_of_range",
             f"rating is null or {not_within('rating', vocab.MIN_RATING, vocab.MAX_RATING)}"),
    ),
    layout=Layout("year", "review_date"),
)

SALES_DAILY = TableSpec(
    name="sales_daily",
    columns="sale_date date!, revenue double, cogs double",
    header=("Date", "Revenue", "COGS"),
    rules=(
        Rule("sale_date_missing", missing("sale_date")),
        Rule("revenue_invalid", missing_or("revenue", "< 0")),
        Rule("cogs_invalid", missing_or("cogs", "< 0")),
    ),
    notes={"_margin_negative": "cogs > revenue"},
)

SHIPMENTS = TableSpec(
    name="shipments",
    columns="order_id long!, ship_date date, delivery_date date, shipping_fee double",
    rules=(
        Rule("ship_date_missing", missing("ship_date")),
        Rule("delivery_before_ship", "delivery_date < ship_date"),
        Rule("shipping_fee_invalid", missing_or("shipping_fee", "< 0")),
    ),
    layout=Layout("month", "ship_date"),
)

WEB_TRAFFIC = TableSpec(
    name="web_traffic",
    columns="traffic_date date!, sessions long, unique_visitors long, page_views long, "
            "bounce_rate double, avg_session_duration_sec double, traffic_source string",
    header=("date", "sessions", "unique_visitors", "page_views", "bounce_rate",
            "avg_session_duration_sec", "traffic_source"),
    tidy={"traffic_source": code},
    rules=(
        Rule("traffic_date_missing", missing("traffic_date")),
        Rule("sessions_invalid", missing_or("sessions", "< 0")),
        Rule("unique_visitors_negative", "unique_visitors < 0"),
        Rule("page_views_negative", "page_views < 0"),
        Rule("visitors_above_sessions", "unique_visitors > sessions"),
        Rule("page_views_below_sessions", "page_views < sessions"),
        Rule("bounce_rate_out_of_range", not_within("bounce_rate", 0, 1)),
        Rule("duration_negative", "avg_session_duration_sec < 0"),
        Rule("source_unknown", not_one_of("traffic_source", vocab.CHANNELS)),
    ),
)

SPECS = {spec.name: spec for spec in (
    CUSTOMERS, GEOGRAPHY, INVENTORY, ORDER_ITEMS, ORDERS, PAYMENTS, PRODUCTS, PROMOTIONS, RETURNS,
    REVIEWS, SALES_DAILY, SHIPMENTS, WEB_TRAFFIC,
)}
