"""Named SQL views of the layers, and the helper that puts the needed ones before a query.

Only the texts of the source views are shared with the library; rules, models
and everything after them are written out again here.
"""

import re

from granary.sources import retail

VIEWS = {f"src_{name}": text.format(**{table: table for table in retail.GIVEN_TABLES})
         for name, text in retail.VIEWS.items()}

# --- bronze: normalised columns and the reason text ------------------------------------------

VIEWS["n_customers"] = """
select customer_id, trim(zip) as zip, trim(city) as city, signup_date, lower(trim(gender)) as gender,
  lower(trim(age_group)) as age_group, lower(trim(acquisition_channel)) as acquisition_channel
from src_customers"""
VIEWS["b_customers"] = """
select *, nullif(concat_ws(', ',
  case when signup_date is null then 'signup_date_missing' end,
  case when zip is null then 'zip_missing' end,
  case when gender not in ('female', 'male', 'non-binary') then 'gender_unknown' end,
  case when age_group not in ('18-24', '25-34', '35-44', '45-54', '55+') then 'age_group_unknown' end,
  case when acquisition_channel not in ('direct', 'email_campaign', 'organic_search', 'paid_search', 'referral', 'social_media')
       then 'channel_unknown' end), '') as _invalid_reason
from n_customers"""

VIEWS["n_geography"] = """
select trim(zip) as zip, trim(city) as city, lower(trim(region)) as region, trim(district) as district
from src_geography"""
VIEWS["b_geography"] = """
select *, nullif(concat_ws(', ',
  case when zip is null then 'zip_missing' end,
  case when city is null then 'city_missing' end,
  case when region not in ('central', 'east', 'west') then 'region_unknown' end), '') as _invalid_reason
from n_geography"""

VIEWS["n_inventory"] = """
select snapshot_date, product_id, stock_on_hand, units_received, units_sold, stockout_days, days_of_supply,
  fill_rate, stockout_flag, overstock_flag, reorder_flag, sell_through_rate, trim(product_name) as product_name,
  lower(trim(category)) as category, lower(trim(segment)) as segment, year, month
from src_inventory"""
VIEWS["b_inventory"] = """
select *, nullif(concat_ws(', ',
  case when stock_on_hand < 0 then 'stock_on_hand_negative' end,
  case when units_received < 0 then 'units_received_negative' end,
  case when units_sold < 0 then 'units_sold_negative' end,
  case when stockout_days < 0 then 'stockout_days_negative' end,
  case when fill_rate < 0 or fill_rate > 1 then 'fill_rate_out_of_range' end,
  case when sell_through_rate < 0 or sell_through_rate > 1 then 'sell_through_out_of_range' end,
  case when stockout_flag not in (0, 1) then 'stockout_flag_invalid' end,
  case when overstock_flag not in (0, 1) then 'overstock_flag_invalid' end,
  case when reorder_flag not in (0, 1) then 'reorder_flag_invalid' end,
  case when year <> extract(year from snapshot_date) then 'year_mismatch' end,
  case when month <> extract(month from snapshot_date) then 'month_mismatch' end,
  case when category not in ('casual', 'genz', 'outdoor', 'streetwear') then 'category_unknown' end,
  case when segment not in ('activewear', 'all-weather', 'balanced', 'everyday', 'performance', 'premium', 'standard', 'trendy')
       then 'segment_unknown' end), '') as _invalid_reason
from n_inventory"""

VIEWS["n_order_items"] = """
select order_id, product_id, quantity, unit_price, discount_amount, nullif(trim(promo_id), '') as promo_id,
  nullif(trim(promo_id_2), '') as promo_id_2
from src_order_items"""
VIEWS["b_order_items"] = """
select *, nullif(concat_ws(', ',
  case when product_id is null then 'product_id_missing' end,
  case when coalesce(quantity, 0) <= 0 then 'quantity_invalid' end,
  case when coalesce(unit_price, -1) < 0 then 'unit_price_invalid' end,
  case when discount_amount < 0 then 'discount_negative' end), '') as _invalid_reason
from n_order_items"""

VIEWS["n_orders"] = """
select order_id, order_date, customer_id, trim(zip) as zip, lower(trim(order_status)) as order_status,
  lower(trim(payment_method)) as payment_method, lower(trim(device_type)) as device_type,
  lower(trim(order_source)) as order_source
from src_orders"""
VIEWS["b_orders"] = """
select *, nullif(concat_ws(', ',
  case when customer_id is null then 'customer_id_missing' end,
  case when order_date is null then 'order_date_missing' end,
  case when order_status not in ('created', 'paid', 'shipped', 'delivered', 'returned', 'cancelled')
       then 'status_unknown' end), '') as _invalid_reason
from n_orders"""

VIEWS["n_payments"] = """
select order_id, lower(trim(payment_method)) as payment_method, payment_value, installments from src_payments"""
VIEWS["b_payments"] = """
select *, nullif(concat_ws(', ',
  case when coalesce(payment_value, 0) <= 0 then 'payment_value_invalid' end,
  case when coalesce(installments, 0) < 1 then 'installments_invalid' end,
  case when payment_method not in ('apple_pay', 'bank_transfer', 'cod', 'credit_card', 'paypal')
       then 'method_unknown' end), '') as _invalid_reason
from n_payments"""

VIEWS["n_products"] = """
select product_id, trim(product_name) as product_name, lower(trim(category)) as category,
  lower(trim(segment)) as segment, lower(trim(size)) as size, lower(trim(color)) as color, price, cogs
from src_products"""
VIEWS["b_products"] = """
select *, nullif(concat_ws(', ',
  case when product_name is null then 'product_name_missing' end,
  case when coalesce(price, 0) <= 0 then 'price_invalid' end,
  case when coalesce(cogs, -1) < 0 then 'cogs_invalid' end,
  case when cogs > price then 'cogs_above_price' end,
  case when category not in ('casual', 'genz', 'outdoor', 'streetwear') then 'category_unknown' end,
  case when segment not in ('activewear', 'all-weather', 'balanced', 'everyday', 'performance', 'premium', 'standard', 'trendy')
       then 'segment_unknown' end,
  case when size not in ('s', 'm', 'l', 'xl') then 'size_unknown' end), '') as _invalid_reason
from n_products"""

VIEWS["n_promotions"] = """
select trim(promo_id) as promo_id, trim(promo_name) as promo_name, lower(trim(promo_type)) as promo_type,
  discount_value, start_date, end_date, nullif(lower(trim(applicable_category)), '') as applicable_category,
  lower(trim(promo_channel)) as promo_channel, stackable_flag, min_order_value
from src_promotions"""
VIEWS["b_promotions"] = """
select *, nullif(concat_ws(', ',
  case when start_date is null then 'start_date_missing' end,
  case when end_date is null then 'end_date_missing' end,
  case when end_date < start_date then 'end_before_start' end,
  case when coalesce(discount_value, 0) <= 0 then 'discount_value_invalid' end,
  case when promo_type = 'percentage' and discount_value > 100 then 'percentage_above_100' end,
  case when min_order_value < 0 then 'min_order_value_negative' end,
  case when promo_type not in ('fixed', 'percentage') then 'promo_type_unknown' end,
  case when promo_channel not in ('all_channels', 'email', 'in_store', 'online', 'social_media')
       then 'promo_channel_unknown' end), '') as _invalid_reason
from n_promotions"""

VIEWS["n_returns"] = """
select trim(return_id) as return_id, order_id, product_id, return_date, lower(trim(return_reason)) as return_reason,
  return_quantity, refund_amount
from src_returns"""
VIEWS["b_returns"] = """
select *, nullif(concat_ws(', ',
  case when order_id is null then 'order_id_missing' end,
  case when product_id is null then 'product_id_missing' end,
  case when return_date is null then 'return_date_missing' end,
  case when coalesce(return_quantity, 0) <= 0 then 'return_quantity_invalid' end,
  case when coalesce(refund_amount, -1) < 0 then 'refund_amount_invalid' end,
  case when return_reason not in ('changed_mind', 'defective', 'late_delivery', 'not_as_described', 'wrong_size')
       then 'reason_unknown' end), '') as _invalid_reason
from n_returns"""

VIEWS["n_reviews"] = """
select trim(review_id) as review_id, order_id, product_id, customer_id, review_date, rating,
  nullif(trim(review_title), '') as review_title
from src_reviews"""
VIEWS["b_reviews"] = """
select *, nullif(concat_ws(', ',
  case when order_id is null then 'order_id_missing' end,
  case when product_id is null then 'product_id_missing' end,
  case when customer_id is null then 'customer_id_missing' end,
  case when review_date is null then 'review_date_missing' end,
  case when coalesce(rating, 0) < 1 or rating > 5 then 'rating_out_of_range' end), '') as _invalid_reason
from n_reviews"""

VIEWS["b_sales_daily"] = """
select *, nullif(concat_ws(', ',
  case when sale_date is null then 'sale_date_missing' end,
  case when coalesce(revenue, -1) < 0 then 'revenue_invalid' end,
  case when coalesce(cogs, -1) < 0 then 'cogs_invalid' end), '') as _invalid_reason,
  cogs > revenue as _margin_negative
from src_sales_daily"""

VIEWS["b_shipments"] = """
select *, nullif(concat_ws(', ',
  case when ship_date is null then 'ship_date_missing' end,
  case when delivery_date < ship_date then 'delivery_before_ship' end,
  case when coalesce(shipping_fee, -1) < 0 then 'shipping_fee_invalid' end), '') as _invalid_reason
from src_shipments"""

VIEWS["n_web_traffic"] = """
select traffic_date, sessions, unique_visitors, page_views, bounce_rate, avg_session_duration_sec,
  lower(trim(traffic_source)) as traffic_source
from src_web_traffic"""
VIEWS["b_web_traffic"] = """
select *, nullif(concat_ws(', ',
  case when traffic_date is null then 'traffic_date_missing' end,
  case when coalesce(sessions, -1) < 0 then 'sessions_invalid' end,
  case when unique_visitors < 0 then 'unique_visitors_negative' end,
  case when page_views < 0 then 'page_views_negative' end,
  case when unique_visitors > sessions then 'visitors_above_sessions' end,
  case when page_views < sessions then 'page_views_below_sessions' end,
  case when bounce_rate < 0 or bounce_rate > 1 then 'bounce_rate_out_of_range' end,
  case when avg_session_duration_sec < 0 then 'duration_negative' end,
  case when traffic_source not in ('direct', 'email_campaign', 'organic_search', 'paid_search', 'referral', 'social_media')
       then 'source_unknown' end), '') as _invalid_reason
from n_web_traffic"""

TABLES = ("customers", "geography", "inventory", "order_items", "orders", "payments", "products",
          "promotions", "returns", "reviews", "sales_daily", "shipments", "web_traffic")

# --- silver ---------------------------------------------------------------------------------

for _name in TABLES:
    VIEWS[f"s_{_name}"] = f"select * exclude (_invalid_reason) from b_{_name} where _invalid_reason is null"
VIEWS["s_order_items"] = """
select order_id, product_id, quantity, unit_price, coalesce(discount_amount, 0) as discount_amount,
  quantity * unit_price - coalesce(discount_amount, 0) as line_amount, promo_id, promo_id_2
from b_order_items where _invalid_reason is null"""
VIEWS["s_products"] = """
select product_id, product_name, category, segment, size, color, price, cogs, price - cogs as list_margin
from b_products where _invalid_reason is null"""
VIEWS["s_promotions"] = """
select promo_id, promo_name, promo_type, discount_value, start_date, end_date, applicable_category,
  promo_channel, stackable_flag = 1 as is_stackable, min_order_value,
  datediff('day', start_date, end_date) as duration_days
from b_promotions where _invalid_reason is null"""

# --- gold -----------------------------------------------------------------------------------

_CALENDAR_COLUMNS = """
  cast(year(d) as int) as year, cast(quarter(d) as int) as quarter, cast(month(d) as int) as month,
  monthname(d) as month_name, cast(day(d) as int) as day_of_month, cast(isodow(d) as int) as day_of_week,
  dayname(d) as day_name, isodow(d) >= 6 as is_weekend, cast(weekofyear(d) as int) as week_of_year,
  strftime(d, '%Y-%m') as year_month"""
VIEWS["d_date"] = f"""
select d as date_key, {_CALENDAR_COLUMNS}
from (select cast(unnest(range(date '1994-01-01', date '2002-01-01', interval 1 day)) as date) as d) as days"""
VIEWS["order_calendar"] = f"""
select d as date_key, {_CALENDAR_COLUMNS}
from (select cast(unnest(range(date_trunc('year', min(order_date)),
        date_trunc('year', max(order_date)) + interval 1 year, interval 1 day)) as date) as d from s_orders) as days"""
VIEWS["d_customer"] = """
select c.customer_id, c.gender, c.age_group, c.acquisition_channel, c.signup_date,
  cast(year(c.signup_date) as int) as signup_year, strftime(c.signup_date, '%Y-%m') as signup_year_month,
  c.zip, c.city, g.region, g.district
from s_customers c left join s_geography g on c.zip = g.zip"""
VIEWS["d_product"] = """
select product_id, product_name, category, segment, size, color, price as current_list_price,
  cogs as current_unit_cost, list_margin as current_list_margin from s_products"""
VIEWS["d_promotion"] = """
select * from s_promotions
union all
select 'NO_PROMO', 'Không áp dụng khuyến mãi', 'none', cast(0 as double), cast(null as date), cast(null as date),
  cast(null as varchar), 'none', false, cast(0 as double), cast(null as bigint)"""
VIEWS["fact"] = """
select o.order_date as date_key, o.customer_id as customer_key, i.product_id as product_key,
  coalesce(i.promo_id, 'NO_PROMO') as promo_key, i.order_id, o.order_status, o.payment_method, o.device_type,
  o.order_source, i.promo_id_2 as promo_id_2_degenerate, i.quantity, i.quantity * i.unit_price as gross_amount,
  i.discount_amount, i.line_amount as net_amount, i.unit_price
from s_order_items i join s_orders o on i.order_id = o.order_id"""


def money(expression: str) -> str:
    return f"cast(sum(cast({expression} as decimal(18,4))) as double)"


VIEWS["g_orders_daily"] = """
select order_date, count(*) as num_orders, count(distinct customer_id) as num_customers,
  count(*) filter (where order_status = 'delivered') as num_delivered,
  count(*) filter (where order_status = 'cancelled') as num_cancelled,
  count(*) filter (where order_status = 'returned') as num_returned
from s_orders group by order_date"""
VIEWS["g_revenue_daily"] = f"""
select o.order_date, count(distinct o.order_id) as num_orders, count(*) as num_lines,
  cast(sum(i.quantity) as bigint) as num_units, {money("i.line_amount")} as revenue,
  {money("i.discount_amount")} as total_discount,
  {money("i.line_amount")} / count(distinct o.order_id) as avg_order_value
from s_order_items i join s_orders o on i.order_id = o.order_id group by o.order_date"""

# --- customers over time ----------------------------------------------------------------------

_DAYS = "('1996-01-01'), ('1998-01-01'), ('2000-01-01'), ('2002-01-01')"
VIEWS["snapshot_days"] = f"select cast(day as date) as day from (values {_DAYS}) as v(day)"
VIEWS["last_address"] = """
select day, customer_id, zip from (
  select day, customer_id, zip,
    row_number() over (partition by day, customer_id order by order_date desc, order_id desc) as rn
  from s_orders join snapshot_days on order_date <= day) as ranked
where rn = 1"""
VIEWS["snapshots"] = """
select c.customer_id, coalesce(a.zip, c.zip) as zip, c.acquisition_channel, d.day as snapshot_date
from s_customers c join snapshot_days d on c.signup_date <= d.day
left join last_address a on a.customer_id = c.customer_id and a.day = d.day"""
VIEWS["versions_marked"] = """
select *, case when lag(snapshot_date) over w is null or lag(zip) over w is distinct from zip
    or lag(acquisition_channel) over w is distinct from acquisition_channel then 1 else 0 end as is_change
from snapshots window w as (partition by customer_id order by snapshot_date)"""
VIEWS["customer_history"] = """
select customer_id, zip, acquisition_channel, snapshot_date as valid_from,
  lead(snapshot_date) over (partition by customer_id order by snapshot_date) as valid_to,
  lead(snapshot_date) over (partition by customer_id order by snapshot_date) is null as is_current
from versions_marked where is_change = 1"""
VIEWS["orders_as_of"] = """
select o.order_id, o.customer_id, o.order_date, h.zip as customer_zip, h.valid_from,
  h.customer_id is null as is_unknown
from s_orders o left join customer_history h on o.customer_id = h.customer_id
  and o.order_date >= h.valid_from and (h.valid_to is null or o.order_date < h.valid_to)"""

# --- further facts ----------------------------------------------------------------------------

VIEWS["f_returns"] = """
select r.return_date as date_key, r.product_id as product_key, o.customer_id as customer_key, r.return_id,
  r.order_id, r.return_reason, r.return_quantity, r.refund_amount
from s_returns r left join s_orders o on r.order_id = o.order_id"""
VIEWS["f_orders"] = """
select o.order_id, o.customer_id, o.order_status, o.order_date, s.ship_date, s.delivery_date,
  datediff('day', o.order_date, s.ship_date) as days_to_ship,
  datediff('day', s.ship_date, s.delivery_date) as days_in_transit,
  datediff('day', o.order_date, s.delivery_date) as total_days,
  coalesce(s.ship_date < o.order_date, false) as ships_before_order
from s_orders o left join s_shipments s on o.order_id = s.order_id"""
VIEWS["coverage"] = """
select promo_id, cast(unnest(generate_series(start_date, end_date, interval 1 day)) as date) as date_key
from s_promotions"""
VIEWS["bridge"] = """
select order_id, product_id, promo_id, 1.0 / (1 + cast(promo_id_2 is not null as int)) as weight, line_amount
from s_order_items where promo_id is not null
union all
select order_id, product_id, promo_id_2, 1.0 / (1 + cast(promo_id is not null as int)), line_amount
from s_order_items where promo_id_2 is not null"""

_WORD = re.compile(r"[a-z_][a-z_0-9]*")


# --- admission: rows that no rule names, with what models require and whose references are admitted

_IN = "{c} is not null and {c} not in (select {k} from m_{t} where refused is null)"


def _marked(table: str, *cases: tuple[str, str]) -> str:
    texts = " ".join(f"when {condition} then '{reason}'" for condition, reason in cases)
    first = f"coalesce(_invalid_reason, case {texts} end)" if texts else "_invalid_reason"
    return f"select *, {first} as refused from b_{table}"


VIEWS["m_geography"] = _marked("geography", ("region is null", "region_missing"))
VIEWS["m_products"] = _marked("products")
VIEWS["m_promotions"] = _marked("promotions")
VIEWS["m_customers"] = _marked("customers", (_IN.format(c="zip", k="zip", t="geography"), "zip_unknown"))
VIEWS["m_orders"] = _marked("orders", (_IN.format(c="customer_id", k="customer_id", t="customers"), "customer_id_unknown"))
VIEWS["m_order_items"] = _marked(
    "order_items", *[(_IN.format(c=key, k=key, t=table), f"{key}_unknown")
                     for key, table in (("order_id", "orders"), ("product_id", "products"), ("promo_id", "promotions"))])
MARKED = ("geography", "products", "promotions", "customers", "orders", "order_items")


def on_admitted(query: str) -> str:
    """The query with its views, where the source tables hold admitted rows only."""
    views = dict(VIEWS)
    for name in MARKED:
        views[f"all_{name}"] = VIEWS[f"b_{name}"]
        views[f"m_{name}"] = VIEWS[f"m_{name}"].replace(f"from b_{name}", f"from all_{name}")
        views[f"b_{name}"] = f"select * exclude (refused) from m_{name} where refused is null"
    return with_views(query, views)


def with_views(query: str, views: dict[str, str] = VIEWS) -> str:
    """Prefix the views that the query needs, each after the ones it reads."""
    ordered: list[str] = []

    def need(text: str) -> None:
        for word in _WORD.findall(text):
            if word in views and word not in ordered and views[word] is not text:
                need(views[word])
                if word not in ordered:
                    ordered.append(word)

    need(query)
    ctes = ",\n".join(f"{name} as ({views[name]})" for name in ordered)
    return f"with {ctes}\n{query}" if ordered else query
