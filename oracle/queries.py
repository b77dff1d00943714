"""The checking SQL of each query."""

from granary.plans import checks
from granary.plans.lake import CALENDAR
from granary.sources.specs import SPECS
from oracle.views import MARKED, TABLES, money, on_admitted, with_views

Q: dict[str, str] = {}
MODEL_CHECKS = checks.model_checks(CALENDAR)

# --- layers -----------------------------------------------------------------------------------

for _t in TABLES:
    Q[f"bronze_{_t}"] = (f"select *, _invalid_reason is null as _is_valid, '{_t}' as _source_file from b_{_t}")
    Q[f"silver_{_t}"] = f"select * from s_{_t}"
Q["dim_date"] = "select * from d_date"
Q["order_calendar"] = "select * from order_calendar"
Q["dim_customer"] = "select * from d_customer"
Q["dim_product"] = "select * from d_product"
Q["dim_promotion"] = "select * from d_promotion"
Q["fact_order_items"] = "select * from fact"
Q["gold_orders_daily"] = "select * from g_orders_daily"
Q["gold_revenue_daily"] = "select * from g_revenue_daily"


def _each(template: str, names=TABLES) -> str:
    return "\nunion all\n".join(template.format(t=name) for name in names)


Q["valid_counts"] = _each("""
select '{t}' as table_name, count(*) as total_rows, count(*) filter (where _invalid_reason is null) as valid_rows,
  count(*) filter (where _invalid_reason is not null) as invalid_rows from b_{t}""")
Q["invalid_reason_histogram"] = _each("""
select '{t}' as table_name, _invalid_reason as reason, count(*) as num_rows from b_{t}
where _invalid_reason is not null group by _invalid_reason""", ("orders", "order_items"))
Q["invalid_code_histogram"] = _each("""
select '{t}' as table_name, reason, count(*) as num_rows
from (select unnest(string_split(_invalid_reason, ', ')) as reason from b_{t}) as codes group by reason""")

# --- sources, sinks, layouts --------------------------------------------------------------------

Q["csv_roundtrip"] = """
select sale_date, revenue, cogs, _invalid_reason, _invalid_reason is null as _is_valid, _margin_negative
from b_sales_daily"""
Q["csv_orders"] = "select *, _invalid_reason is null as _is_valid from b_orders"
Q["ingest_report"] = "\nunion all\n".join(f"""
select '{t}' as table_name, count(*) as total_rows, count(*) filter (where _invalid_reason is null) as valid_rows,
  count(*) filter (where _invalid_reason is not null) as invalid_rows,
  {"count(*) filter (where cogs > revenue)" if t == "sales_daily" else "cast(null as bigint)"} as margin_negative_rows
from b_{t}""" for t in TABLES)
Q["ingest_files"] = _each("""
select '{t}' as table_name, count(*) as num_rows, count(*) as traced_rows, true as has_latest, true as is_read_after_write
from b_{t}""", ("promotions", "sales_daily"))
# At these sizes no table has the rows that months need, so bytes do not matter.


def _measured_sql(table: str) -> str:
    layout = SPECS[table].layout
    key = {"month": f"date_trunc('month', {layout.column})", "year": f"date_trunc('month', {layout.column})",
           "bucket": layout.column}.get(layout.kind)
    if not key:
        return f"select '{table}' as table_name, 'plain' as layout, count(*) as num_rows, 0 as num_keys, 0 as hottest_rows from b_{table}"
    wanted = "'bucket'" if layout.kind == "bucket" else "'year'"
    small = "or max(n) * 16 > sum(n)" if layout.kind == "bucket" else ""
    return (f"select '{table}' as table_name, case when sum(n) < 40000 {small} then 'plain' else {wanted} end as layout, "
            f"cast(sum(n) as bigint) as num_rows, count(k) as num_keys, max(n) as hottest_rows "
            f"from (select {key} as k, count(*) as n from b_{table} group by 1) as per_key")


Q["layout_measured"] = "\nunion all\n".join(map(_measured_sql, TABLES))
Q["catalog_models"] = "\nunion all\n".join([
    *[f"select 'bronze_{t}' as model, 'table' as kind, count(*) as num_rows from b_{t}" for t in checks.SOURCE_CHECKS],
    *[f"select 'silver_{t}', 'view', count(*) from s_{t}" for t in checks.SOURCE_CHECKS],
    "select 'dim_product', 'table', count(*) from d_product", "select 'gold_orders_daily', 'table', count(*) from g_orders_daily"])
Q["layout_month"] = """
select strftime(order_date, '%Y-%m') as month, count(*) as num_rows from b_orders
where order_date between date '1997-03-15' and date '1997-06-10' group by 1"""
Q["layout_year"] = """
select cast(year(signup_date) as int) as year, count(*) as num_rows from b_customers
where signup_date between date '1996-07-01' and date '1998-02-28' group by 1"""
Q["layout_bucket"] = """
select o.device_type, p.installments, count(distinct o.order_id) as num_orders, count(*) as num_lines
from b_order_items i join b_orders o on i.order_id = o.order_id join b_payments p on p.order_id = o.order_id
group by o.device_type, p.installments"""
Q["upsert_overwrite"] = """
select product_id, category, case when category = 'outdoor' then price + 1 else price end as price from s_products
union all
select product_id + 1000000000000, category, price from s_products where category = 'genz'"""
# Orders after the changes of the refreshed tables; `hit` says which rows the change set may touch.
def _orders_after(hit: str, deletes: bool) -> str:
    gone = f"where not coalesce({hit} and order_status = 'shipped' and order_source = 'ads', false)" if deletes else ""
    return f"""
select order_id, customer_id, device_type, order_source,
  case when {hit} and order_status = 'paid' and order_source = 'email' then order_date + 40 else order_date end as order_date,
  case when {hit} and order_status = 'created' and device_type = 'tablet' then 'cancelled' else order_status end as order_status,
  {hit} and ((order_status = 'paid' and order_source = 'email') or (order_status = 'created' and device_type = 'tablet')) as is_changed
from s_orders {gone}
union all
select order_id + 1000000000000, customer_id, device_type, order_source, order_date + 1, order_status, true
from s_orders where {hit} and order_status = 'returned' and device_type = 'mobile'"""


Q["upsert_months"] = f"""
select order_id, customer_id, order_date, order_status, strftime(order_date, '%Y-%m') in (
    select strftime(order_date, '%Y-%m') from ({_orders_after("strftime(order_date, '%Y-%m') = '1997-03'", False)}) as c where is_changed
    union all
    select '1997-03' from ({_orders_after("strftime(order_date, '%Y-%m') = '1997-03'", False)}) as c
    where is_changed and order_id < 1000000000000) as in_rewritten_month,
  cast(0 as int) as rewritten_again
from ({_orders_after("strftime(order_date, '%Y-%m') = '1997-03'", False)}) as after_changes"""
Q["append_by_run"] = """
select run_id, count(*) as num_rows from s_payments cross join (values ('run-1'), ('run-2')) as r(run_id)
group by run_id"""
Q["staleness_check"] = """
select 'bronze' as object, count(*) as num_rows from b_promotions where start_date < date '2000-01-01'
union all select 'silver view', count(*) from s_promotions where start_date < date '2000-01-01'
union all select 'gold table', count(*) + 1 from s_promotions
union all select 'gold rebuilt', count(*) + 1 from s_promotions where start_date < date '2000-01-01'"""

# --- data checks --------------------------------------------------------------------------------


def _check_sql(model: str, view: str, check, parent_views: dict) -> str:
    c = check.column
    if check.kind == "not_null":
        failing = f"select count(*) as n from {view} where {c} is null"
    elif check.kind == "unique":
        failing = (f"select count(*) as n from (select {c} from {view} where {c} is not null "
                   f"group by {c} having count(*) > 1) as dup")
    elif check.kind == "accepted_values":
        allowed = ", ".join(repr(value) for value in check.values)
        failing = f"select count(*) as n from {view} where {c} not in ({allowed})"
    elif check.kind == "relationships":
        failing = (f"select count(*) as n from {view} where {c} is not null and {c} not in "
                   f"(select {check.parent_column} from {parent_views[check.parent]})")
    elif not check.inclusive:
        failing = f"select count(*) as n from {view} where {c} <= {check.low}"
    else:
        high = f" or {c} > {check.high}" if check.high is not None else ""
        failing = f"select count(*) as n from {view} where {c} < {check.low}{high}"
    return (f"select '{model}' as model, '{c}' as column_name, '{check.kind}' as check_name, n as failing_rows, "
            f"case when n = 0 then 'pass' else 'fail' end as status from ({failing}) as f")


_VIEW_OF_MODEL = {
    **{f"silver_{name}": f"s_{name}" for name in checks.SOURCE_CHECKS},
    "dim_customer": "d_customer", "dim_date": "d_date", "dim_product": "d_product",
    "dim_promotion": "d_promotion", "fact_order_items": "fact", "gold_orders_daily": "g_orders_daily",
    "gold_revenue_daily": "g_revenue_daily",
}


def _source_check_sql(kinds: tuple) -> list[str]:
    return [_check_sql(name, f"b_{name}", check, {}) for name, declared in checks.SOURCE_CHECKS.items()
            for check in declared if check.kind in kinds]


_GRAIN = """
select 'fact_order_items' as model, '*' as column_name, 'grain' as check_name, n as failing_rows,
  case when n = 0 then 'pass' else 'fail' end as status
from (select cast((select count(*) from fact) <> (select count(*) from s_order_items) as bigint) as n) as g"""
Q["test_not_null"] = "\nunion all\n".join(_source_check_sql(("not_null",)))
Q["test_unique"] = "\nunion all\n".join(_source_check_sql(("unique",)))
Q["test_accepted_values"] = """
select order_status as value, count(*) as num_rows from b_orders
where order_status not in ('created', 'paid', 'shipped', 'delivered', 'returned', 'cancelled')
group by order_status"""
Q["test_relationships"] = """
select count(*) as orphan_rows from fact where product_key not in (select product_id from d_product)"""
Q["test_accepted_range"] = "select order_id, product_id, quantity from b_order_items where quantity <= 0"
Q["test_fact_grain"] = """
select * from (select (select count(*) from fact) as fact_rows, (select count(*) from s_order_items) as silver_rows)
  as counts
where fact_rows <> silver_rows"""
_SUITE = [*_source_check_sql(("not_null", "unique")),
          *[_check_sql(model, _VIEW_OF_MODEL[model], check, _VIEW_OF_MODEL)
            for model, declared in MODEL_CHECKS.items() for check in declared], _GRAIN]
Q["quality_suite"] = "\nunion all\n".join(_SUITE)

# --- reports on bronze --------------------------------------------------------------------------

_AMOUNT = "i.quantity * i.unit_price - coalesce(i.discount_amount, 0)"
Q["revenue_by_category"] = f"""
select p.category, {money(_AMOUNT)} as revenue
from b_order_items i join b_orders o on i.order_id = o.order_id join b_products p on i.product_id = p.product_id
where o.order_date >= date '1999-01-01' group by p.category"""
Q["orders_by_region"] = """
select g.region, count(distinct o.order_id) as num_orders from b_orders o join b_geography g on o.zip = g.zip
group by g.region"""
Q["shipping_by_status"] = """
select o.order_status, count(*) as num_orders, count(s.order_id) as num_shipped,
  cast(sum(datediff('day', s.ship_date, s.delivery_date)) as double)
    / count(datediff('day', s.ship_date, s.delivery_date)) as avg_delivery_days
from b_orders o left join b_shipments s on o.order_id = s.order_id group by o.order_status"""
Q["returns_by_product"] = """
select p.product_name, cast(sum(b.n) as bigint) as units_sold, cast(coalesce(sum(r.n), 0) as bigint) as units_returned
from (select order_id, product_id, sum(quantity) as n from b_order_items group by 1, 2) as b
join b_products p on b.product_id = p.product_id
left join (select order_id, product_id, sum(return_quantity) as n from b_returns group by 1, 2) as r
  on r.order_id = b.order_id and r.product_id = b.product_id
group by p.product_name"""
Q["over_returns"] = """
select count(*) as num_pairs, count(*) filter (where r.n > b.n) as over_returned_pairs
from (select order_id, product_id, sum(quantity) as n from b_order_items group by 1, 2) as b
join (select order_id, product_id, sum(return_quantity) as n from b_returns group by 1, 2) as r
  on r.order_id = b.order_id and r.product_id = b.product_id"""
Q["missing_shipments"] = """
select o.order_id, o.order_date, o.order_status from b_orders o left join b_shipments s on o.order_id = s.order_id
where s.order_id is null and o.order_status in ('delivered', 'returned', 'shipped')"""
Q["status_shipment_matrix"] = """
select o.order_status, count(s.order_id) as with_shipment, count(*) - count(s.order_id) as without_shipment
from b_orders o left join b_shipments s on o.order_id = s.order_id group by o.order_status"""
Q["orders_by_status"] = "select order_status, count(*) as num_orders from b_orders group by order_status"
Q["traffic_vs_orders"] = """
select t.traffic_date, t.sessions, coalesce(o.num_orders, 0) as num_orders
from (select traffic_date, cast(sum(sessions) as bigint) as sessions from b_web_traffic group by 1) as t
left join (select order_date, count(distinct order_id) as num_orders from b_orders group by 1) as o
  on o.order_date = t.traffic_date"""
Q["promo_stacking"] = """
select i.promo_id, a.stackable_flag as stackable_1, i.promo_id_2, b.stackable_flag as stackable_2, count(*) as num_lines
from b_order_items i left join b_promotions a on i.promo_id = a.promo_id
left join b_promotions b on i.promo_id_2 = b.promo_id
where i.promo_id is not null and i.promo_id_2 is not null group by 1, 2, 3, 4"""
Q["discount_promo_consistency"] = """
select count(promo_id) as with_promo, count(*) filter (where discount_amount > 0) as with_discount,
  count(*) filter (where promo_id is not null and coalesce(discount_amount, 0) <= 0) as promo_without_discount,
  count(*) filter (where promo_id is null and discount_amount > 0) as discount_without_promo
from b_order_items"""
Q["list_price_match"] = """
select count(*) as num_lines, count(*) filter (where i.unit_price = p.price) as at_list_price
from b_order_items i join b_products p on i.product_id = p.product_id"""
Q["loss_days"] = """
select count(*) as num_days, count(*) filter (where cogs > revenue) as loss_days,
  cast(count(*) filter (where cogs > revenue) as double) / count(cogs > revenue) as loss_share
from b_sales_daily"""

# --- profiles -----------------------------------------------------------------------------------

_EDGES = (
    ("customers", "zip", "geography", "zip"),
    ("orders", "zip", "geography", "zip"),
    ("orders", "customer_id", "customers", "customer_id"),
    ("reviews", "customer_id", "customers", "customer_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("payments", "order_id", "orders", "order_id"),
    ("shipments", "order_id", "orders", "order_id"),
    ("returns", "order_id", "orders", "order_id"),
    ("reviews", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("returns", "product_id", "products", "product_id"),
    ("reviews", "product_id", "products", "product_id"),
    ("inventory", "product_id", "products", "product_id"),
    ("order_items", "promo_id", "promotions", "promo_id"),
    ("order_items", "promo_id_2", "promotions", "promo_id"),
)


def _edge_sql(child: str, column: str, parent: str, key: str) -> str:
    return f"""
select '{child}' as child, '{column}' as child_column, '{parent}' as parent, count(*) as orphan_rows
from s_{child} c left join s_{parent} p on c.{column} = p.{key}
where p.{key} is null and c.{column} is not null"""


Q["fk_orphans"] = "\nunion all\n".join(_edge_sql(*edge) for edge in _EDGES)
Q["silver_orphan_lines"] = """
select count(*) as orphan_rows from s_order_items i left join s_orders o on i.order_id = o.order_id
where o.order_id is null"""
_CHILDREN = ("order_items", "payments", "shipments", "reviews", "returns")
Q["cardinality_profile"] = _each("""
select '{t}' as child, count(order_id) as num_rows, count(distinct order_id) as distinct_keys,
  (select max(n) from (select count(*) as n from b_{t} where order_id is not null group by order_id) as k)
    as max_rows_per_key,
  case when count(order_id) = count(distinct order_id) then '1:1' else '1:n' end as relation from b_{t}""", _CHILDREN)
Q["coverage_check"] = _each("""
select '{t}' as child, count(*) as parent_rows, count(c.order_id) as covered_rows,
  count(*) - count(c.order_id) as missing_rows
from b_orders o left join (select distinct order_id from b_{t}) as c on c.order_id = o.order_id""", _CHILDREN)
Q["redundant_column"] = """
select 'zip' as column_name, count(*) as compared_rows, count(*) filter (where o.zip <> c.zip) as differing_rows
from b_orders o join b_customers c on o.customer_id = c.customer_id
union all
select 'payment_method', count(*), count(*) filter (where o.payment_method <> p.payment_method)
from b_orders o join b_payments p on o.order_id = p.order_id"""
Q["fanout_meter"] = """
select join_form, left_rows, joined_rows, joined_rows - left_rows as extra_rows from (
  select 'by order_id' as join_form, (select count(*) from b_order_items) as left_rows,
    (select count(*) from b_order_items i left join b_returns r on r.order_id = i.order_id) as joined_rows
  union all
  select 'by order_id, product_id', (select count(*) from b_order_items),
    (select count(*) from b_order_items i left join b_returns r
       on r.order_id = i.order_id and r.product_id = i.product_id)
  union all
  select 'aggregated first', (select count(*) from b_order_items),
    (select count(*) from b_order_items i left join (select distinct order_id, product_id from b_returns) as r
       on r.order_id = i.order_id and r.product_id = i.product_id)) as forms"""
Q["repeated_grain"] = _each("""
select '{t}' as table_name, order_id, product_id, count(*) as num_rows from b_{t}
where order_id is not null and product_id is not null group by order_id, product_id having count(*) > 1""",
                            ("order_items", "returns"))
_DATED = {"orders": "order_date", "customers": "signup_date", "shipments": "ship_date", "returns": "return_date",
          "reviews": "review_date", "inventory": "snapshot_date", "sales_daily": "sale_date",
          "web_traffic": "traffic_date", "promotions": "start_date"}
Q["time_coverage"] = "\nunion all\n".join(f"""
select '{t}' as table_name, min({d}) as first_day, max({d}) as last_day, count({d}) as dated_rows,
  count(distinct {d}) as num_days from b_{t}""" for t, d in _DATED.items())
Q["lines_per_order"] = """
select count(*) as num_rows, count(distinct order_id) as num_keys,
  cast(count(*) as double) / count(distinct order_id) as rows_per_key from b_order_items"""

# --- reports on gold ----------------------------------------------------------------------------

Q["star_four_dims"] = f"""
select d.year, c.region, p.category, r.promo_type, count(distinct f.order_id) as num_orders,
  {money("f.net_amount")} as revenue
from fact f join d_date d on f.date_key = d.date_key join d_customer c on f.customer_key = c.customer_id
join d_product p on f.product_key = p.product_id join d_promotion r on f.promo_key = r.promo_id
where d.year = 2000 and d.is_weekend group by 1, 2, 3, 4"""
Q["weekend_vs_weekday"] = f"""
select d.is_weekend, {money("f.net_amount")} as revenue,
  {money("f.unit_price")} / count(f.unit_price) as avg_unit_price
from fact f left join d_date d on f.date_key = d.date_key group by d.is_weekend"""
Q["promo_effectiveness"] = f"""
select r.promo_name, r.promo_type, count(distinct f.order_id) as num_orders,
  {money("f.gross_amount")} as before_discount, {money("f.discount_amount")} as total_discount,
  {money("f.net_amount")} as revenue
from fact f join d_promotion r on f.promo_key = r.promo_id group by 1, 2"""
Q["cohort_revenue"] = f"""
select c.signup_year, c.acquisition_channel, count(distinct f.customer_key) as num_customers,
  {money("f.net_amount")} as revenue
from fact f join d_customer c on f.customer_key = c.customer_id group by 1, 2"""
Q["no_promo_share"] = f"""
select *, cast(no_promo_lines as double) / num_lines as line_share, no_promo_revenue / revenue as revenue_share
from (select count(*) as num_lines, count(*) filter (where promo_key = 'NO_PROMO') as no_promo_lines,
  {money("net_amount")} as revenue,
  {money("case when promo_key = 'NO_PROMO' then net_amount end")} as no_promo_revenue from fact) as sums"""
Q["null_fk_loss"] = """
select (select count(*) from s_order_items) as num_lines,
  (select count(*) from s_order_items i join d_promotion r on i.promo_id = r.promo_id) as kept_with_null_key,
  (select count(*) from s_order_items i join d_promotion r on coalesce(i.promo_id, 'NO_PROMO') = r.promo_id)
    as kept_with_member"""
Q["top_days"] = "select * from g_orders_daily order by order_date limit 20"
Q["newest_days"] = "select * from g_revenue_daily order by order_date desc limit 20"
Q["reconcile_daily_orders"] = """
select order_date, placed.num_orders as orders_placed, sold.num_orders as orders_sold
from g_orders_daily as placed left join g_revenue_daily as sold using (order_date)
where placed.num_orders is distinct from sold.num_orders"""
Q["reconcile_two_sources"] = f"""
select coalesce(s.sale_date, r.order_date) as order_date, cast(s.given as double) as source_revenue,
  r.revenue as line_revenue, cast(s.given - cast(r.revenue as decimal(18,4)) as double) as gap,
  cast(s.given - cast(r.revenue as decimal(18,4)) as double) / r.revenue * 100 as gap_percent
from (select sale_date, sum(cast(revenue as decimal(18,4))) as given from s_sales_daily group by 1) as s
full join g_revenue_daily r on s.sale_date = r.order_date"""
Q["rollup_check"] = f"""
select (select count(*) from g_revenue_daily) as num_days, cast(0 as bigint) as differing_days,
  {money("net_amount")} as rebuilt_revenue, (select {money("revenue")} from g_revenue_daily) as stored_revenue
from fact"""
Q["days_without_orders"] = """
select d.date_key, d.day_name, d.is_weekend from order_calendar d left join s_orders o on o.order_date = d.date_key
where o.order_id is null"""

# --- further facts ------------------------------------------------------------------------------

Q["fact_returns"] = "select * from f_returns"
Q["fact_payments"] = """
select o.order_date as date_key, o.customer_id as customer_key, p.order_id, p.payment_method, p.payment_value,
  p.installments from s_payments p join s_orders o on p.order_id = o.order_id"""
Q["fact_shipments"] = """
select s.ship_date as date_key, o.customer_id as customer_key, s.order_id, s.delivery_date, s.shipping_fee,
  datediff('day', s.ship_date, s.delivery_date) as days_in_transit
from s_shipments s join s_orders o on s.order_id = o.order_id"""
Q["fact_reviews"] = """
select review_date as date_key, customer_id as customer_key, product_id as product_key, review_id, order_id, rating
from s_reviews"""
Q["fact_web_traffic"] = """
select traffic_date as date_key, traffic_source, sessions, unique_visitors, page_views,
  bounce_rate * sessions as bounced_sessions, avg_session_duration_sec * sessions as duration_sec
from s_web_traffic"""
Q["fact_orders_lifecycle"] = "select * from f_orders"
Q["role_playing_dates"] = """
select a.is_weekend as order_weekend, b.is_weekend as ship_weekend, c.is_weekend as delivery_weekend,
  count(*) as num_orders, cast(sum(f.total_days) as double) / count(f.total_days) as avg_total_days
from f_orders f left join d_date a on f.order_date = a.date_key left join d_date b on f.ship_date = b.date_key
left join d_date c on f.delivery_date = c.date_key group by 1, 2, 3"""
Q["fact_inventory"] = """
select snapshot_date as date_key, product_id as product_key, stock_on_hand, units_received, units_sold, stockout_days
from s_inventory"""
Q["fact_orders_advanced"] = "select * from f_orders"
Q["orders_daily_refreshed"] = f"""
select order_date, count(*) as num_orders, count(distinct customer_id) as num_customers,
  count(*) filter (where order_status = 'delivered') as num_delivered,
  count(*) filter (where order_status = 'cancelled') as num_cancelled,
  count(*) filter (where order_status = 'returned') as num_returned
from ({_orders_after("true", True)}) as o group by order_date"""
Q["revenue_daily_refreshed"] = f"""
select o.order_date, count(distinct o.order_id) as num_orders, count(*) as num_lines,
  cast(sum(i.quantity) as bigint) as num_units, {money("i.line_amount")} as revenue,
  {money("i.discount_amount")} as total_discount,
  {money("i.line_amount")} / count(distinct o.order_id) as avg_order_value
from (select order_id, quantity, discount_amount,
        case when unit_price < 1000 then line_amount + quantity else line_amount end as line_amount
      from s_order_items where quantity <> 50) as i
join ({_orders_after("true", True)}) as o on i.order_id = o.order_id group by o.order_date"""
Q["fact_inventory_dense"] = """
select m.date_key, p.product_id as product_key,
  coalesce(last_value(i.stock ignore nulls) over (partition by p.product_id order by m.date_key
    rows between unbounded preceding and current row), 0) as stock_on_hand,
  cast(coalesce(i.received, 0) as bigint) as units_received, cast(coalesce(i.sold, 0) as bigint) as units_sold,
  cast(coalesce(i.empty_days, 0) as bigint) as stockout_days, i.sold is null as is_carried
from (select last_day(cast(unnest(generate_series(date_trunc('month', min(snapshot_date)), date_trunc('month', max(snapshot_date)),
        interval 1 month)) as date)) as date_key from s_inventory) as m
cross join (select product_id from d_product union select product_id from s_inventory where snapshot_date is not null) as p
left join (select product_id, last_day(snapshot_date) as month_end, arg_max(stock_on_hand, snapshot_date) as stock,
             sum(units_received) as received, sum(units_sold) as sold, sum(stockout_days) as empty_days
           from s_inventory where snapshot_date is not null group by 1, 2) as i
  on i.product_id = p.product_id and i.month_end = m.date_key"""
Q["fact_inventory_last"] = """
select category, count(*) as num_products, cast(sum(stock_on_hand) as bigint) as stock_on_hand
from (select category, stock_on_hand,
        row_number() over (partition by product_id order by snapshot_date desc nulls last) as rn
      from s_inventory) as ranked
where rn = 1 group by category"""
Q["fact_inventory_avg"] = """
select category, count(*) as num_months, cast(sum(stock) as double) / count(stock) as avg_stock
from (select category, snapshot_date, sum(stock_on_hand) as stock from s_inventory group by 1, 2) as months
group by category"""
Q["ratio_of_sums"] = """
select category, cast(sum(units_sold) as double) / sum(units_sold + stock_on_hand) as ratio_of_sums,
  cast(sum(cast(round(cast(units_sold as double) / (units_sold + stock_on_hand), 6) as decimal(18,6))) as double)
    / count(*) as mean_of_ratios
from s_inventory group by category"""
Q["promo_coverage"] = "select * from coverage"
Q["concurrent_promos"] = """
select d.year_month, count(distinct c.promo_id) as num_promos, count(*) as promo_days
from coverage c left join d_date d on c.date_key = d.date_key group by d.year_month"""
Q["unused_promos"] = """
select promo_id, count(*) as days_active from coverage
where promo_id not in (select promo_id from bridge) group by promo_id"""
Q["promo_bridge"] = "select * from bridge"
Q["promo_bridge_revenue"] = f"""
select b.promo_id, p.promo_name, count(*) as num_lines, {money("b.line_amount")} as touched_revenue,
  {money("b.weight * b.line_amount")} as allocated_revenue
from bridge b join s_promotions p on b.promo_id = p.promo_id group by 1, 2"""
Q["drill_across"] = f"""
select coalesce(s.category, r.category) as category, s.revenue, r.refunds, r.refunds / s.revenue as refund_rate
from (select p.category, {money("f.net_amount")} as revenue from fact f
      join d_product p on f.product_key = p.product_id group by 1) as s
full join (select p.category, {money("f.refund_amount")} as refunds from f_returns f
      join d_product p on f.product_key = p.product_id group by 1) as r on s.category = r.category"""
Q["region_two_ways"] = """
select g.region as order_region, c.region as customer_region, count(*) as num_orders
from s_orders o left join s_geography g on o.zip = g.zip left join d_customer c on o.customer_id = c.customer_id
group by 1, 2"""

_FACT_KEYS = {
    "fact_order_items": ("fact", {"dim_date": "date_key", "dim_customer": "customer_key",
                                  "dim_product": "product_key", "dim_promotion": "promo_key"}),
    "fact_payments": ("s_payments join s_orders using (order_id)",
                      {"dim_date": "order_date", "dim_customer": "customer_id"}),
    "fact_shipments": ("s_shipments join s_orders using (order_id)",
                       {"dim_date": "ship_date", "dim_customer": "customer_id"}),
    "fact_returns": ("f_returns", {"dim_date": "date_key", "dim_customer": "customer_key",
                                   "dim_product": "product_key"}),
    "fact_reviews": ("s_reviews", {"dim_date": "review_date", "dim_customer": "customer_id",
                                   "dim_product": "product_id"}),
    "fact_inventory": ("s_inventory", {"dim_date": "snapshot_date", "dim_product": "product_id"}),
    "fact_web_traffic": ("s_web_traffic", {"dim_date": "traffic_date"}),
}
_DIM_KEYS = {"dim_date": ("d_date", "date_key"), "dim_customer": ("d_customer", "customer_id"),
             "dim_product": ("d_product", "product_id"), "dim_promotion": ("d_promotion", "promo_id")}


def _bus_cell(fact: str, dim: str) -> str:
    view, keys = _FACT_KEYS[fact]
    if dim not in keys:
        return (f"select '{fact}' as fact, '{dim}' as dimension, false as usable, cast(null as bigint) as num_rows, "
                "cast(null as bigint) as matched_rows")
    dim_view, dim_key = _DIM_KEYS[dim]
    return (f"select '{fact}' as fact, '{dim}' as dimension, true as usable, count(*) as num_rows, "
            f"count(*) filter (where {keys[dim]} in (select {dim_key} from {dim_view})) as matched_rows from {view}")


Q["bus_matrix"] = "\nunion all\n".join(_bus_cell(fact, dim) for fact in _FACT_KEYS for dim in _DIM_KEYS)
Q["key_inclusions"] = "\nunion all\n".join(f"""
select '{fact}' as fact, '{dim.replace("dim_", "").replace("promotion", "promo")}_key' as key_column, '{other}' as dimension,
  count(*) as num_rows, count(distinct {column}) as num_values, count(*) filter (where known) as matched_rows,
  count(distinct case when known then {column} end) as matched_values
from (select *, cast({column} as varchar) in (select cast({_DIM_KEYS[other][1]} as varchar) from {_DIM_KEYS[other][0]}) as known
      from {view}) as f"""
    for fact, (view, keys) in _FACT_KEYS.items() for dim, column in keys.items() for other in _DIM_KEYS)
Q["junk_dim"] = """
select order_status, payment_method, device_type, order_source, count(*) as num_rows from s_orders
group by 1, 2, 3, 4"""

# --- customers over time --------------------------------------------------------------------------

Q["scd2_customers"] = "select * from customer_history"
Q["scd2_incremental"] = "select * from customer_history"
Q["scd2_asof_lookup"] = "select * from orders_as_of"
Q["surrogate_keys"] = """
select 'versions' as measure, count(*) as num_rows from customer_history
union all
select 'distinct keys', count(*) from (select distinct customer_id, valid_from from customer_history) as k
union all
select 'orders', count(*) from orders_as_of
union all
select 'unknown member orders', count(*) from orders_as_of where is_unknown"""
Q["dense_keys"] = """
select measure, num_rows from (
  select count(*) as members, 1 as least, count(*) as greatest, count(*) as distinct_keys,
    count(*) filter (where signup_date < date '1996-01-01') as early, 0 as changed,
    (select count(*) from s_orders where customer_id not in (select customer_id from s_customers)) as unknown
  from s_customers) as c,
lateral (values ('members', members), ('least key', least), ('greatest key', greatest), ('distinct keys', distinct_keys),
  ('early members', early), ('greatest early key', early), ('changed keys', changed), ('unknown member orders', unknown)) as v(measure, num_rows)"""
Q["scd_variants"] = """
select customer_id, first(zip order by snapshot_date) as type0_zip, last(zip order by snapshot_date) as type1_zip,
  last(zip order by snapshot_date) as current_zip,
  last(zip order by snapshot_date) filter (where next_zip is not null and rest_changes > 0 and next_zip <> zip)
    as previous_zip
from (select *, lead(zip) over w as next_zip,
        sum(case when zip <> lagged then 1 else 0 end) over (partition by customer_id order by snapshot_date
          rows between 1 following and unbounded following) as rest_changes
      from (select *, lag(zip) over (partition by customer_id order by snapshot_date) as lagged from snapshots) as l
      window w as (partition by customer_id order by snapshot_date)) as z
group by customer_id"""
Q["scd4_tables"] = """
select case when is_current then 'current' else 'history' end as table_name, acquisition_channel, count(*) as num_rows
from customer_history group by 1, 2"""

Q["admission_report"] = _each(
    "select '{t}' as table_name, coalesce(refused, 'admitted') as outcome, count(*) as num_rows from m_{t} group by 2", MARKED)

# --- the gated build: a model is skipped if anything before it failed -------------------------------

_INPUTS = {
    "silver_orders": ("orders",), "silver_order_items": ("order_items",), "silver_geography": ("geography",),
    "silver_customers": ("customers",), "silver_products": ("products",), "silver_promotions": ("promotions",),
    "dim_customer": ("silver_customers", "silver_geography"), "dim_product": ("silver_products",),
    "dim_promotion": ("silver_promotions",), "dim_date": (),
    "fact_order_items": ("silver_order_items", "silver_orders"), "gold_orders_daily": ("silver_orders",),
    "gold_revenue_daily": ("silver_order_items", "silver_orders"),
}


def _parents(model: str) -> list[str]:
    return [check.parent for check in MODEL_CHECKS.get(model, ()) if check.parent]


def _blockers(model: str) -> set[str]:
    """The models and sources whose failure keeps this one from being built."""
    found: set[str] = set()
    for name in _INPUTS.get(model, ()):
        found |= {name} | _blockers(name)
        for parent in _parents(name):
            found |= _blockers(parent)
    return found


def _gate_sql(suite: str) -> str:
    """The suite as the gate sees it: a check that cannot run is skipped."""
    rows = []
    for model in _INPUTS:
        for check in MODEL_CHECKS[model]:
            blockers = _blockers(model) | (_blockers(check.parent) if check.parent else set())
            rows += [(model, check.column, check.kind, name) for name in sorted(blockers)]
    grain = checks.GRAIN_CHECK[0]
    rows += [(grain, "*", "grain", name) for name in sorted(_blockers(grain))]
    values = ", ".join(str(row) for row in sorted(set(rows)))
    return f"""with suite as ({suite}), failed as (select distinct model from suite where status = 'fail'),
blockers(model, column_name, check_name, blocker) as (values {values}),
gate as (select s.model, s.column_name, s.check_name, case when b.n is null then s.failing_rows end as failing_rows,
  case when b.n is null then s.status else 'skipped' end as status
  from suite s left join (select b.model, b.column_name, b.check_name, count(*) as n
                          from blockers b join failed f on f.model = b.blocker group by all) as b
    on b.model = s.model and b.column_name = s.column_name and b.check_name = s.check_name)
"""


def _gated_sql() -> str:
    rows = [f"select '{name}' as model, 'source' as kind, case when f > 0 then 'failed' else 'checked' end as status, "
            f"f as failed_checks from (select count(*) filter (where status = 'fail') as f from gate where model = '{name}')"
            for name in checks.SOURCE_CHECKS]
    for model in _INPUTS:
        assert set(_parents(model)) <= set(_INPUTS)
        kind = "view" if model.startswith("silver") else "table"
        before = ", ".join(f"'{name}'" for name in sorted(_blockers(model))) or "''"
        rows.append(
            f"select '{model}', '{kind}', case when (select count(*) from failed where model in ({before})) > 0 then 'skipped' "
            f"when f > 0 then 'failed' when l > 0 then 'unchecked' else 'built' end, f from (select "
            f"count(*) filter (where status = 'fail') as f, count(*) filter (where status = 'skipped') as l "
            f"from gate where model = '{model}')")
    return "\nunion all\n".join(rows)


ORACLES = {name: with_views(text) for name, text in Q.items()}
_gate = _gate_sql(with_views(Q["quality_suite"]))
ORACLES["gated_build"] = _gate + _gated_sql()
ORACLES["gated_checks"] = _gate + "select * from gate"
_counts = "\nunion all\n".join(f"select '{model}' as model, count(*) as num_rows from {view}" for model, view in (
    ("dim_customer", "d_customer"), ("dim_product", "d_product"), ("dim_promotion", "d_promotion"),
    ("fact_order_items", "fact"), ("gold_orders_daily", "g_orders_daily"),
    ("gold_revenue_daily", "g_revenue_daily")))
ORACLES["gated_build_admitted"] = (
    f"with report as ({_gate_sql(on_admitted(Q['quality_suite']))}{_gated_sql()}), sizes as ({on_admitted(_counts)}) "
    "select r.*, s.num_rows from report r left join sizes s on s.model = r.model and r.status <> 'skipped'")
