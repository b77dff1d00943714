"""The 13 source tables as views over the given tables, with quality faults.

Each view keeps every row of the tables it reads. Faults (blanks, case, wrong
codes, NULLs, numbers out of range) only change values, and each rule of
`specs` is broken somewhere. One text per view runs in Spark and in the SQL
that checks the results; the braces name the given tables.
"""

from pyspark.sql import DataFrame, SparkSession

# Numbers each line, for the faults below; lines of one order get different numbers.
_LINE = "(l_orderkey * 7 + l_linenumber)"
_PERCENT = "cast(floor(l_discount * 100 + 0.5) as int)"


def _code(expression: str, values: dict) -> str:
    cases = " ".join(f"when {key!r} then '{value}'" for key, value in values.items())
    return f"case {expression} {cases} end"


_METHOD_OF_PRIORITY = _code("o_orderpriority", {
    "1-URGENT": "credit_card", "2-HIGH": "paypal", "3-MEDIUM": "bank_transfer",
    "4-NOT SPECIFIED": "apple_pay", "5-LOW": "cod",
})
_SEGMENT_NUMBER = {0: "activewear", 1: "all-weather", 2: "balanced", 3: "everyday",
                   4: "performance", 5: "premium", 6: "standard", 7: "Trendy "}
_CATEGORY_OF_TYPE = _code("p_type", {
    "STANDARD": "casual", "PROMO": "GenZ", "LARGE": " Outdoor", "SMALL": "streetwear",
    "MEDIUM": "Casual", "ECONOMY": "streetwear",
})
_SEGMENT_OF_BRAND = _code("cast(substr(p_brand, 7) as int) % 8", _SEGMENT_NUMBER)
_CHANNEL_OF_EVENT = _code("event_type", {
    "signup": "direct", "view": "organic_search", "click": "paid_search", "error": " Referral ",
    "purchase": "Email_Campaign",
})
_CHANNEL_NUMBER = {0: "direct", 1: "email_campaign", 2: "organic_search", 3: "Paid_Search",
                   4: "referral", 5: " social_media"}

GEOGRAPHY = f"""
select case when z % 97 = 13 then null else lpad(cast(z as string), 12, '0') end as zip,
  case when z % 61 = 7 then null else concat(' ', n_name) end as city,
  case when z % 53 = 5 then 'north' when z % 59 = 3 then null
       when z % 4 = 0 then concat('  ', upper({_code("n_regionkey", {0: "central", 1: "west", 2: "east", 3: "central", 4: "east"})}))
       else {_code("n_regionkey", {0: "central", 1: "west", 2: "east", 3: "central", 4: "east"})} end as region,
  concat('D', cast(z % 7 as string), ' ') as district
from (select cast(floor(c_custkey / 3) as bigint) as z, min(c_nationkey) as nation_no
      from {{customer}} group by cast(floor(c_custkey / 3) as bigint)) as zips
join {{nation}} on n_nationkey = nation_no
"""

CUSTOMERS = f"""
select customer_id,
  case when customer_id % 211 = 7 then null when customer_id % 101 = 9 then concat('X', zip)
       when customer_id % 5 = 0 then concat(' ', zip, '  ') else zip end as zip,
  concat(' City ', cast(nation_no as string)) as city,
  case when customer_id % 89 = 8 then null
       else date '1994-01-01' + cast(customer_id % 2500 as int) end as signup_date,
  case when customer_id % 73 = 1 then 'unknown' when customer_id % 71 = 2 then null
       else {_code("customer_id % 3", {0: "female", 1: "Male ", 2: "non-binary"})} end as gender,
  case when customer_id % 79 = 3 then 'senior' when customer_id % 83 = 4 then null
       else {_code("segment", {"AUTOMOBILE": "18-24", "BUILDING": "25-34", "FURNITURE": " 35-44",
                               "HOUSEHOLD": "45-54", "MACHINERY": "55+"})} end as age_group,
  case when customer_id % 97 = 5 then 'tv' else {_code("customer_id % 6", _CHANNEL_NUMBER)} end as acquisition_channel
from (select c_custkey as customer_id, c_nationkey as nation_no, c_mktsegment as segment,
        lpad(cast(cast(floor(c_custkey / 3) as bigint) as string), 12, '0') as zip
      from {{customer}}) as base
"""

PRODUCTS = f"""
select product_id,
  case when product_id % 89 = 11 then null else concat(name, ' ') end as product_name,
  case when product_id % 103 = 12 then 'misc' else category end as category,
  case when product_id % 109 = 13 then null when product_id % 113 = 14 then 'luxury' else segment end as segment,
  case when product_id % 107 = 15 then 'xxl' when size_no <= 12 then 's' when size_no <= 25 then ' M'
       when size_no <= 38 then 'l' else 'XL' end as size,
  upper(split_part(name, ' ', 1)) as color,
  case when product_id % 97 = 16 then 0.0 else cast(cents as double) / 100 end as price,
  case when product_id % 101 = 17 then null
       when size_no = 50 then cast(cents * 11 as double) / 1000
       else cast((cents * 6 - cents * 6 % 10) / 10 as double) / 100 end as cogs
from (select p_partkey as product_id, p_name as name, p_size as size_no,
        {_CATEGORY_OF_TYPE} as category, {_SEGMENT_OF_BRAND} as segment,
        cast(round(p_retailprice * 100) as bigint) as cents
      from {{part}}) as base
"""

PROMOTIONS = f"""
select concat('PROMO-', lpad(cast(k as string), 4, '0'), ' ') as promo_id,
  concat(' Promo ', cast(k as string)) as promo_name,
  case when k = 42 then 'bogof' when k % 5 = 0 then 'Fixed' when k % 7 = 0 then ' PERCENTAGE ' else 'percentage' end as promo_type,
  cast(case when k = 37 then 120 when k = 38 then 0 else k end as double) as discount_value,
  case when k = 39 then null else date '1995-01-01' + cast((k - 1) * 45 as int) end as start_date,
  case when k = 40 then null when k = 41 then date '1995-01-01'
       else date '1995-01-01' + cast((k - 1) * 45 + 60 + k % 30 as int) end as end_date,
  case k % 5 when 1 then ' Outdoor' when 2 then 'Streetwear' when 3 then '   ' else '' end as applicable_category,
  case when k = 43 then 'radio' else
  {_code("k % 5", {0: "all_channels", 1: "Email", 2: "in_store", 3: " online", 4: "social_media"})} end as promo_channel,
  cast((k + 1) % 2 as int) as stackable_flag,
  case when k = 44 then -1.0 else cast(cast(floor(min_price) as bigint) as double) end as min_order_value
from (select p_size as k, min(p_retailprice) as min_price from {{part}} group by p_size) as sizes
"""

ORDERS = f"""
select o_orderkey as order_id,
  case when o_orderkey % 89 = 0 then null else cast(o_orderdate as date) end as order_date,
  case when o_orderkey % 83 = 0 then null else o_custkey end as customer_id,
  lpad(cast(cast(floor(o_custkey / 3) as bigint) + case when o_orderkey % 50 = 1 then 1 else 0 end as string), 12, '0') as zip,
  case when o_orderkey % 97 = 0 then 'bogus' when o_orderkey % 101 = 0 then null
       when o_orderkey % 5 = 0 then concat('  ', upper(status), ' ') else status end as order_status,
  concat(method, ' ') as payment_method,
  {_code("o_orderkey % 3", {0: "mobile", 1: "Desktop", 2: "tablet"})} as device_type,
  {_code("o_orderkey % 4", {0: "organic", 1: "ads", 2: " email", 3: "app"})} as order_source
from (select o_orderkey, o_custkey, o_orderdate, {_METHOD_OF_PRIORITY} as method,
        case when o_orderstatus = 'F' then case when o_orderpriority = '5-LOW' then 'returned' else 'delivered' end
             when o_orderstatus = 'P' then 'shipped'
             when o_orderpriority = '1-URGENT' then 'paid'
             when o_orderpriority = '5-LOW' then 'cancelled' else 'created' end as status
      from {{orders}}) as base
"""

# Prices are cut to whole cents and discounts to whole units.
ORDER_ITEMS = f"""
select l_orderkey as order_id, case when {_LINE} % 199 = 1 then null else l_partkey end as product_id,
  case when {_LINE} % 193 = 2 then 0 when {_LINE} % 191 = 3 then null else cast(l_quantity as bigint) end as quantity,
  case when {_LINE} % 181 = 4 then null when {_LINE} % 197 = 5 then -1.0
       else cast(floor(l_extendedprice / l_quantity * 100) as double) / 100 end as unit_price,
  case when {_LINE} % 179 = 6 then -5.0 when l_discount < 0.005 and l_linenumber % 2 = 1 then null
       else cast(floor(l_extendedprice * l_discount) as double) end as discount_amount,
  case when l_discount > 0.005 then concat(' PROMO-', lpad(cast({_PERCENT} as string), 4, '0'))
       when l_linenumber = 1 then '   ' end as promo_id,
  case when l_discount > 0.095 and l_tax > 0.075 then 'PROMO-0011' when l_linenumber = 2 then '' end as promo_id_2
from {{lineitem}}
"""

PAYMENTS = f"""
select o_orderkey as order_id,
  case when o_orderkey % 139 = 3 then 'cash' when o_orderkey % 149 = 4 then null
       else concat(' ', upper({_METHOD_OF_PRIORITY})) end as payment_method,
  case when o_orderkey % 131 = 1 then 0.0 when o_orderkey % 127 = 5 then null else o_totalprice end as payment_value,
  cast(case when o_orderkey % 137 = 2 then 0 else 1 + o_orderkey % 6 end as int) as installments
from {{orders}}
"""

SHIPMENTS = """
select order_id, case when order_id % 157 = 1 then null else first_day end as ship_date,
  case when order_id % 151 = 2 then first_day - 1 when order_id % 167 = 3 then null else last_day end as delivery_date,
  case when order_id % 163 = 4 then -2.5 else cast(num_lines as double) * 2.5 end as shipping_fee
from (select l_orderkey as order_id, cast(min(l_shipdate) as date) as first_day,
        cast(max(l_shipdate) as date) as last_day, count(*) as num_lines
      from {lineitem} where l_linestatus = 'F' group by l_orderkey) as shipped
"""

RETURNS = f"""
select concat('RET-', cast(l_orderkey as string), '-', cast(l_linenumber as string), '-', cast(l_partkey as string), ' ') as return_id,
  case when {_LINE} % 173 = 1 then null else l_orderkey end as order_id,
  case when {_LINE} % 167 = 2 then null else l_partkey end as product_id,
  case when {_LINE} % 163 = 3 then null else cast(l_shipdate as date) end as return_date,
  case when {_LINE} % 157 = 4 then 'other' when {_LINE} % 151 = 5 then null else
  {_code("l_suppkey % 5", {0: "changed_mind", 1: "Defective", 2: "late_delivery", 3: "not_as_described", 4: " wrong_size"})} end as return_reason,
  case when {_LINE} % 149 = 6 then 0 when {_LINE} % 61 = 7 then cast(l_quantity as bigint) + 5
       else cast(l_quantity as bigint) end as return_quantity,
  case when {_LINE} % 139 = 8 then -1.0
       else cast(floor(l_extendedprice - l_extendedprice * l_discount) as double) end as refund_amount
from {{lineitem}} where l_returnflag = 'R'
"""

# Reviews and web traffic come from `events`, whose days are moved back by
# 24 years (8,766 days) to lie within the order dates.
REVIEWS = """
select concat(' REV-', cast(event_id as string)) as review_id,
  case when event_id % 71 = 1 then null else event_id end as order_id,
  case when event_id % 67 = 2 then null else user_id end as product_id,
  case when event_id % 61 = 3 then null else user_id end as customer_id,
  case when event_id % 59 = 4 then null else cast(ts as date) - 8766 end as review_date,
  cast(case when event_id % 41 = 5 then 6 when event_id % 43 = 6 then null
       else 1 + cast(floor(abs(value)) as bigint) % 5 end as int) as rating,
  case when event_id % 3 = 0 then '   ' else concat('  Rated on ', cast(cast(ts as date) as string)) end as review_title
from {events} where event_type = 'purchase'
"""

INVENTORY = f"""
select case when n % 211 = 0 then null else month_end end as snapshot_date, product_id,
  case when n % 139 = 1 then -1 else 2000 - sold end as stock_on_hand,
  case when n % 137 = 2 then -1 else sold + 10 end as units_received,
  case when n % 131 = 3 then -1 else sold end as units_sold,
  cast(case when n % 127 = 4 then -1 else sold % 7 end as int) as stockout_days,
  cast(2000 - sold as double) / 30 as days_of_supply,
  case when n % 113 = 5 then 1.5 else cast(sold as double) / (sold + sold % 7) end as fill_rate,
  cast(case when n % 109 = 6 then 2 when sold % 7 > 0 then 1 else 0 end as int) as stockout_flag,
  cast(case when n % 107 = 7 then 3 when sold < 10 then 1 else 0 end as int) as overstock_flag,
  cast(case when n % 103 = 8 then 4 when sold > 40 then 1 else 0 end as int) as reorder_flag,
  case when n % 101 = 9 then -0.5 else cast(sold as double) / 2000 end as sell_through_rate,
  product_name, case when n % 97 = 10 then 'misc' else category end as category,
  case when n % 89 = 11 then 'luxury' else segment end as segment,
  cast(year(month_end) + case when n % 83 = 12 then 1 else 0 end as int) as year,
  cast(case when n % 79 = 13 then 13 else month(month_end) end as int) as month
from (select l_partkey as product_id, last_day(cast(l_shipdate as date)) as month_end,
        cast(sum(cast(l_quantity as bigint)) as bigint) as sold,
        l_partkey * 12 + min(month(l_shipdate)) as n
      from {{lineitem}} group by l_partkey, last_day(cast(l_shipdate as date))) as sales
join (select p_partkey, concat(' ', p_name) as product_name, {_CATEGORY_OF_TYPE} as category,
        {_SEGMENT_OF_BRAND} as segment from {{part}}) as goods on p_partkey = product_id
"""

SALES_DAILY = """
select case when month(day) = 5 and day(day) = 5 then null else day end as sale_date,
  case when month(day) = 3 and day(day) = 3 then -1.0 else cast(cents as double) / 100 end as revenue,
  case when month(day) = 4 and day(day) = 4 then null
       when day(day) % 10 = 0 then cast(cents * 11 as double) / 1000
       else cast((cents * 6 - cents * 6 % 10) / 10 as double) / 100 end as cogs
from (select cast(o_orderdate as date) as day, cast(sum(cast(round(o_totalprice * 100) as bigint)) as bigint) as cents
      from {orders} group by cast(o_orderdate as date)) as days
"""

WEB_TRAFFIC = f"""
select case when d = 27 then null else day end as traffic_date,
  case when d = 13 then null when d = 14 then -1 else sessions end as sessions,
  case when d = 11 then sessions + 1 when d = 15 then -1 else visitors end as unique_visitors,
  case when d = 3 then sessions - 1 when d = 16 then -1 else sessions + bounces end as page_views,
  case when d = 5 then 1.5 when d = 6 then null else cast(bounces as double) / sessions end as bounce_rate,
  case when d = 7 then -1.0 else cast(seconds as double) / sessions end as avg_session_duration_sec,
  case when d = 9 then 'bot' else {_CHANNEL_OF_EVENT} end as traffic_source
from (select cast(ts as date) - 8766 as day, day(cast(ts as date)) as d, event_type, count(*) as sessions,
        count(distinct user_id) as visitors, count(*) filter (where value < 20) as bounces,
        cast(sum(cast(floor(abs(value)) as bigint)) as bigint) as seconds
      from {{events}} group by cast(ts as date), event_type) as days
"""

VIEWS = {
    "customers": CUSTOMERS, "geography": GEOGRAPHY, "inventory": INVENTORY, "order_items": ORDER_ITEMS,
    "orders": ORDERS, "payments": PAYMENTS, "products": PRODUCTS, "promotions": PROMOTIONS,
    "returns": RETURNS, "reviews": REVIEWS, "sales_daily": SALES_DAILY, "shipments": SHIPMENTS,
    "web_traffic": WEB_TRAFFIC,
}
GIVEN_TABLES = ("region", "nation", "customer", "part", "orders", "lineitem", "events")


def source_view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    text = VIEWS[name]
    used = {table: spark.read.parquet(f"{folder}/{table}.parquet")
            for table in GIVEN_TABLES if f"{{{table}}}" in text}
    return spark.sql(text, **used)
