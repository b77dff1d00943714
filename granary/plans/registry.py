"""Every query of this library over the given tables, by name."""

from collections.abc import Callable
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions.calendar import day_spine
from granary.operators import history, keys, profile, quality
from granary.operators.flagging import REASON, reason_histogram, valid_counts
from granary.plans import admission, build, checks, facts, pipeline, recipes, refresh
from granary.plans import gold
from granary.plans.gold import dim_promotion
from granary.plans.lake import Lake
from granary.plans.silver import silver
from granary.session import scratch_dir
from granary.sources.files import bronze_from, ingest, ingest_measured, ingest_times
from granary.sources.merge import upsert_partitions, write_hashed
from granary.sources.specs import SPECS
from granary.sources.tables import (Layout, append_run, between_dates, upsert, write_folder, write_table)

SNAPSHOT_DAYS = ("1996-01-01", "1998-01-01", "2000-01-01", "2002-01-01")
TRACKED = ["zip", "acquisition_channel"]
STAR_YEAR = 2000
SINCE = "1999-01-01"
QUERIES: dict[str, Callable[[Lake], DataFrame]] = {}


def query(make: Callable[[Lake], DataFrame]):
    """Register under the function's name; `_q` ends names that would hide a library function."""
    QUERIES[make.__name__.removesuffix("_q")] = make
    return make


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return QUERIES[name](Lake(spark, folder))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# --- bronze, silver and gold models ---------------------------------------------------------

def _register_models() -> None:
    for name in SPECS:
        # The load time differs from run to run, so it is left out of the comparison.
        QUERIES[f"bronze_{name}"] = lambda lake, n=name: bronze_from(
            lake.source(n), SPECS[n], n).drop("_ingested_at")
        QUERIES[f"silver_{name}"] = lambda lake, n=name: lake.silver(n)
    for name in ("dim_customer", "dim_product", "dim_promotion", "dim_date", "order_calendar"):
        QUERIES[name] = lambda lake, n=name: getattr(lake, n)
    QUERIES["fact_order_items"] = lambda lake: lake.fact
    QUERIES["gold_orders_daily"] = lambda lake: lake.orders_daily
    QUERIES["gold_revenue_daily"] = lambda lake: lake.revenue_daily


_register_models()


@query
def valid_counts_q(lake):
    return _union([valid_counts(lake.bronze(name)).select(F.lit(name).alias("table_name"), "*")
                   for name in SPECS])


@query
def invalid_reason_histogram(lake):
    return _union([reason_histogram(lake.bronze(name)).select(F.lit(name).alias("table_name"), "*")
                   for name in ("orders", "order_items")])


@query
def invalid_code_histogram(lake):
    return _union([reason_histogram(lake.bronze(name), per_code=True)
                   .select(F.lit(name).alias("table_name"), "*") for name in SPECS])


# --- sources, sinks, layouts ----------------------------------------------------------------

def _as_csv(lake: Lake, name: str, compression: str = "none") -> str:
    """The source table as a folder of CSV files with the source's own header; one file per task, so none has to be split."""
    path = scratch_dir(lake.spark, f"csv-{name}")
    header = SPECS[name].header or SPECS[name].names
    (lake.source(name).toDF(*header).write.option("header", True).option("compression", compression)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def _ingested(lake: Lake, name: str, check_header: bool = False) -> DataFrame:
    target = scratch_dir(lake.spark, f"bronze-{name}")
    return ingest(lake.spark, SPECS[name], _as_csv(lake, name), target, check_header=check_header)


@query
def csv_roundtrip(lake):
    written = _ingested(lake, "sales_daily", check_header=True)
    return written.select(*SPECS["sales_daily"].names, REASON, "_is_valid", "_margin_negative")


@query
def csv_orders(lake):
    return _ingested(lake, "orders").select(*SPECS["orders"].names, REASON, "_is_valid")


@query
def ingest_report_q(lake):
    """All 13 tables from CSV, packed as exports are, to bronze."""
    files = {name: _as_csv(lake, name, "gzip") for name in SPECS}
    target = scratch_dir(lake.spark, "bronze")
    _, report = pipeline.ingest_all(lake.spark, files, lambda name: f"{target}/{name}")
    return report


@query
def ingest_files(lake):
    """What each source file brought and when; file names and times differ from run to run, so only their sums are shown."""
    bronze = {}
    for name in ("promotions", "sales_daily"):
        target = scratch_dir(lake.spark, f"audited-{name}")
        bronze[name] = ingest(lake.spark, SPECS[name], _as_csv(lake, name), target, file_audit=True)
    times = ingest_times(bronze)
    latest = _union([df.agg(F.max("_ingested_at").alias("latest")).select(F.lit(name).alias("table_name"), "*")
                     for name, df in bronze.items()])
    return times.join(latest, "table_name").groupBy("table_name").agg(
        F.sum("num_rows").alias("num_rows"), F.sum(F.when(F.col("_source_path").endswith(".csv"), F.col("num_rows"))).alias("traced_rows"),
        (F.max("last_ingested_at") == F.max("latest")).alias("has_latest"),
        (F.max("source_modified") <= F.max("latest")).alias("is_read_after_write"))


@query
def layout_measured(lake):
    """The layout that ingest chooses for each table from what it wrote."""
    rows = []
    for name in SPECS:
        target = scratch_dir(lake.spark, f"measured-{name}")
        _, layout, figures = ingest_measured(lake.spark, SPECS[name], _as_csv(lake, name), target,
                                             f"granary_measured_{name}_{uuid4().hex}")
        rows.append((name, layout.kind, figures["num_rows"], figures["num_keys"], figures["hottest_rows"]))
    return lake.spark.createDataFrame(
        rows, "table_name string, layout string, num_rows bigint, num_keys bigint, hottest_rows bigint")


@query
def catalog_models(lake):
    """Bronze and gold tables and silver views in a database of their own, as a second session finds them."""
    database = f"granary_{uuid4().hex}"
    lake.spark.sql(f"CREATE NAMESPACE {database} LOCATION '{scratch_dir(lake.spark, database)}'")
    pipeline.publish_catalog(lake.spark, database, {name: lake.bronze(name) for name in checks.SOURCE_CHECKS},
                             {"dim_product": lake.dim_product, "gold_orders_daily": lake.orders_daily})
    other = lake.spark.newSession()
    names = sorted((row.name, row.tableType) for row in other.catalog.listTables(database))
    return _union([lake.spark.table(f"{database}.{name}").agg(F.count("*").alias("num_rows")).select(
        F.lit(name).alias("model"), F.lit("view" if kind == "VIEW" else "table").alias("kind"), "num_rows")
        for name, kind in names])


@query
def layout_month(lake):
    layout = SPECS["orders"].layout
    stored = write_folder(lake.bronze("orders"), scratch_dir(lake.spark, "orders"), layout)
    wanted = between_dates(stored, layout, "1997-03-15", "1997-06-10")
    return wanted.groupBy(F.col("_month").alias("month")).agg(F.count("*").alias("num_rows"))


@query
def layout_year(lake):
    layout = SPECS["customers"].layout
    stored = write_folder(lake.bronze("customers"), scratch_dir(lake.spark, "customers"), layout)
    wanted = between_dates(stored, layout, "1996-07-01", "1998-02-28")
    return wanted.groupBy(F.col("_year").cast("int").alias("year")).agg(F.count("*").alias("num_rows"))


@query
def layout_bucket(lake):
    """Items, orders and payments in the same buckets of order_id: their joins need no shuffle."""
    tables = {}
    for name in ("order_items", "orders", "payments"):
        table = f"granary_{name}_{uuid4().hex}"
        tables[name] = write_table(lake.bronze(name), table, Layout("bucket", "order_id"),
                                   scratch_dir(lake.spark, table))
    lines = tables["order_items"].groupBy("order_id").agg(F.count("*").alias("lines"))
    return (lines.join(tables["orders"].select("order_id", "device_type"), "order_id")
            .join(tables["payments"].select("order_id", "installments"), "order_id")
            .groupBy("device_type", "installments")
            .agg(F.count("*").alias("num_orders"), F.sum("lines").alias("num_lines")))


@query
def upsert_overwrite(lake):
    """Products with new prices for one category and new products; written to a new folder."""
    base = lake.silver("products").select("product_id", "category", "price")
    repriced = base.filter("category = 'outdoor'").withColumn("price", F.col("price") + 1)
    added = (base.filter("category = 'genz'")
             .withColumn("product_id", F.col("product_id") + F.lit(1_000_000_000_000)))
    first = lake.stored(base, "products-1")
    return lake.stored(upsert(first, repriced.unionByName(added), ["product_id"]), "products-2")


# Changes to orders, told by what the rows say: cancelled ones, some on another day, some gone, some new.
NEW_ORDERS = 1_000_000_000_000
_CANCELLED = "order_status = 'created' and device_type = 'tablet'"
_POSTPONED = "order_status = 'paid' and order_source = 'email'"
_DELETED = "order_status = 'shipped' and order_source = 'ads'"
_REPEATED = "order_status = 'returned' and device_type = 'mobile'"


def _later_orders(orders: DataFrame, month: str | None = None) -> DataFrame:
    """Rows of orders that change or come, as they are afterwards; only those of one month if it is given."""
    some = orders.filter(F.date_format("order_date", "yyyy-MM") == month) if month else orders
    cancelled = some.filter(_CANCELLED).withColumn("order_status", F.lit("cancelled"))
    postponed = some.filter(_POSTPONED).withColumn("order_date", F.date_add("order_date", 40))
    repeated = some.filter(_REPEATED).withColumn("order_id", F.col("order_id") + NEW_ORDERS).withColumn(
        "order_date", F.date_add("order_date", 1))
    return _union([cancelled, postponed, repeated])


@query
def upsert_months(lake):
    """Orders in months: one month's changes rewrite the months they touch, and repeating them rewrites none."""
    layout = Layout("month", "order_date")
    orders = lake.silver("orders").select("order_id", "customer_id", "order_date", "order_status", "device_type",
                                          "order_source")
    path = scratch_dir(lake.spark, "orders-by-month")
    table = write_hashed(orders, path, layout)
    changes = lake.stored(_later_orders(orders, "1997-03"), "changed-orders")
    months = upsert_partitions(lake.spark, path, changes, ["order_id"], layout)
    again = upsert_partitions(lake.spark, path, changes, ["order_id"], layout)
    table = lake.spark.read.schema(table.schema).parquet(path)
    return table.select("order_id", "customer_id", "order_date", "order_status",
                        F.col("_month").cast("string").isin(months).alias("in_rewritten_month"),
                        F.lit(len(again)).alias("rewritten_again"))


@query
def append_by_run(lake):
    """The same run appended twice counts once."""
    path = scratch_dir(lake.spark, "payments")
    rows = lake.silver("payments").select("order_id", "installments")
    for run_id in ("run-1", "run-2", "run-1"):
        append_run(rows, path, run_id)
    stored = lake.spark.read.parquet(path)
    return stored.groupBy(F.col("_run_id").alias("run_id")).agg(F.count("*").alias("num_rows"))


@query
def staleness_check(lake):
    """After bronze loses rows the silver view follows at once, the gold table only when rebuilt."""
    bronze_path = scratch_dir(lake.spark, "promotions")
    write_folder(lake.bronze("promotions"), f"{bronze_path}/1")
    stored = lake.spark.read.parquet(f"{bronze_path}/1")
    table = lake.stored(dim_promotion(silver("promotions", stored)), "dim_promotion")
    shorter = write_folder(stored.filter("start_date < date '2000-01-01'"), f"{bronze_path}/2")
    view = silver("promotions", shorter)
    rebuilt = dim_promotion(view)
    return _union([df.agg(F.count("*").alias("num_rows")).select(F.lit(name).alias("object"), "num_rows")
                   for name, df in (("bronze", shorter), ("silver view", view), ("gold table", table),
                                    ("gold rebuilt", rebuilt))])


# --- data checks ----------------------------------------------------------------------------

def _source_checks(lake: Lake, kind: str) -> DataFrame:
    declared = {name: [check for check in some if check.kind == kind] for name, some in checks.SOURCE_CHECKS.items()}
    return quality.run_all({name: lake.bronze(name) for name in declared}, declared)


@query
def test_not_null(lake):
    return _source_checks(lake, "not_null")


@query
def test_unique(lake):
    return _source_checks(lake, "unique")


@query
def test_accepted_values(lake):
    return quality.unexpected_values(
        lake.bronze("orders"), quality.accepted("order_status", checks.vocab.ORDER_STATUSES))


@query
def test_relationships(lake):
    return quality.orphan_count(lake.fact, "product_key", lake.dim_product, "product_id")


@query
def test_accepted_range(lake):
    return quality.offenders(lake.bronze("order_items"), quality.in_range("quantity", above=0)).select(
        "order_id", "product_id", "quantity")


@query
def test_fact_grain(lake):
    return quality.grain_breach(lake.fact, lake.silver("order_items"))


@query
def quality_suite(lake):
    models = {f"silver_{name}": lake.silver(name) for name in checks.SOURCE_CHECKS}
    models |= {
        name: lake.stored(df, name) for name, df in (
            ("dim_customer", lake.dim_customer), ("dim_date", lake.spanned_dates), ("dim_product", lake.dim_product),
            ("dim_promotion", lake.dim_promotion), ("fact_order_items", lake.fact),
            ("gold_orders_daily", lake.orders_daily), ("gold_revenue_daily", lake.revenue_daily))
    }
    models |= {name: lake.bronze(name) for name in checks.SOURCE_CHECKS}
    results = quality.run_all(models, checks.SOURCE_CHECKS | checks.model_checks(lake.calendar))
    fact, base = checks.GRAIN_CHECK
    return results.unionByName(quality.check_grain(fact, models[fact], models[base]))


@query
def gated_build(lake):
    bronze = {name: lake.bronze(name) for name in checks.SOURCE_CHECKS}
    report, _, _ = build.build(lake.spark, bronze, lake.calendar, lake.stored)
    return report


@query
def gated_checks(lake):
    """What the gate found, check by check; those it could not run are listed as skipped."""
    bronze = {name: lake.bronze(name) for name in checks.SOURCE_CHECKS}
    _, found, _ = build.build(lake.spark, bronze, lake.calendar, lake.stored)
    return found


@query
def admission_report(lake):
    """Per source table: rows admitted to the build, and rows in quarantine by reason."""
    bronze = {name: lake.bronze(name) for name in checks.SOURCE_CHECKS}
    return _union([df.groupBy(F.coalesce(admission.REFUSED, F.lit("admitted")).alias("outcome"))
                   .agg(F.count("*").alias("num_rows")).select(F.lit(name).alias("table_name"), "*")
                   for name, df in admission.mark(bronze, lake.stored).items()])


@query
def gated_build_admitted(lake):
    """The gated build on admitted rows only: the gate lets everything through to the fact and the daily tables."""
    bronze = {name: lake.bronze(name) for name in checks.SOURCE_CHECKS}
    kept = {name: admission.admitted(df) for name, df in admission.mark(bronze, lake.stored).items()}
    report, _, frames = build.build(lake.spark, kept, lake.calendar, lake.stored)
    sizes = _union([frames[model.name].agg(F.count("*").alias("num_rows")).select(F.lit(model.name).alias("model"), "*")
                    for model in build.MODELS if model.is_table and model.name in frames and model.name != "dim_date"])
    return report.join(sizes, "model", "left")


# --- reports on bronze ----------------------------------------------------------------------

@query
def revenue_by_category(lake):
    return recipes.revenue_by_category(lake.bronze("order_items"), lake.bronze("orders"),
                                       lake.bronze("products"), SINCE)


@query
def orders_by_region(lake):
    return recipes.orders_by_region(lake.bronze("orders"), lake.bronze("geography"))


@query
def shipping_by_status(lake):
    return recipes.shipping_by_status(lake.bronze("orders"), lake.bronze("shipments"))


@query
def returns_by_product(lake):
    return recipes.returns_by_product(lake.bronze("order_items"), lake.bronze("returns"),
                                      lake.bronze("products"))


@query
def over_returns(lake):
    return recipes.over_returns(lake.bronze("order_items"), lake.bronze("returns"))


@query
def missing_shipments(lake):
    return recipes.missing_shipments(lake.bronze("orders"), lake.bronze("shipments"))


@query
def status_shipment_matrix(lake):
    return recipes.status_shipment_matrix(lake.bronze("orders"), lake.bronze("shipments"))


@query
def orders_by_status(lake):
    return recipes.orders_by_status(lake.bronze("orders"))


@query
def traffic_vs_orders(lake):
    return recipes.traffic_vs_orders(lake.bronze("web_traffic"), lake.bronze("orders"))


@query
def promo_stacking(lake):
    return recipes.promo_stacking(lake.bronze("order_items"), lake.bronze("promotions"))


@query
def discount_promo_consistency(lake):
    return recipes.discount_promo_consistency(lake.bronze("order_items"))


@query
def list_price_match(lake):
    return recipes.list_price_match(lake.bronze("order_items"), lake.bronze("products"))


@query
def loss_days(lake):
    return recipes.loss_days(lake.bronze("sales_daily"))


# --- profiles -------------------------------------------------------------------------------

ORDER_CHILDREN = ("order_items", "payments", "shipments", "reviews", "returns")
FOREIGN_KEYS = (
    ("customers", "zip", "geography", "zip"), ("orders", "zip", "geography", "zip"),
    ("orders", "customer_id", "customers", "customer_id"),
    ("reviews", "customer_id", "customers", "customer_id"),
    ("order_items", "order_id", "orders", "order_id"), ("payments", "order_id", "orders", "order_id"),
    ("shipments", "order_id", "orders", "order_id"), ("returns", "order_id", "orders", "order_id"),
    ("reviews", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("returns", "product_id", "products", "product_id"),
    ("reviews", "product_id", "products", "product_id"),
    ("inventory", "product_id", "products", "product_id"),
    ("order_items", "promo_id", "promotions", "promo_id"),
    ("order_items", "promo_id_2", "promotions", "promo_id"),
)
DATED = {"orders": "order_date", "customers": "signup_date", "shipments": "ship_date",
         "returns": "return_date", "reviews": "review_date", "inventory": "snapshot_date",
         "sales_daily": "sale_date", "web_traffic": "traffic_date", "promotions": "start_date"}


@query
def fk_orphans(lake):
    return profile.fk_orphans([(child, lake.silver(child), child_key, parent, lake.silver(parent), parent_key)
                               for child, child_key, parent, parent_key in FOREIGN_KEYS])


@query
def silver_orphan_lines(lake):
    return quality.orphan_count(lake.silver("order_items"), "order_id", lake.silver("orders"), "order_id")


@query
def cardinality_profile(lake):
    return profile.cardinality(lake.bronze("orders"), {n: lake.bronze(n) for n in ORDER_CHILDREN}, "order_id")


@query
def coverage_check(lake):
    return profile.coverage(lake.bronze("orders"), {n: lake.bronze(n) for n in ORDER_CHILDREN}, "order_id")


@query
def redundant_column(lake):
    orders = lake.bronze("orders")
    by_zip = profile.copies_agree(orders, lake.bronze("customers"), "customer_id", "zip")
    by_method = profile.copies_agree(orders, lake.bronze("payments"), "order_id", "payment_method")
    return _union([by_zip.select(F.lit("zip").alias("column_name"), "*"),
                   by_method.select(F.lit("payment_method").alias("column_name"), "*")])


@query
def fanout_meter(lake):
    return profile.fan_out(lake.bronze("order_items"), lake.bronze("returns"), ["order_id"],
                           ["order_id", "product_id"])


@query
def repeated_grain(lake):
    pair = ["order_id", "product_id"]
    return _union([quality.duplicates(lake.bronze(name), pair).select(F.lit(name).alias("table_name"), "*")
                   for name in ("order_items", "returns")])


@query
def time_coverage(lake):
    return profile.time_coverage({name: (lake.bronze(name), column) for name, column in DATED.items()})


@query
def lines_per_order(lake):
    return profile.mean_rows_per_key(lake.bronze("order_items"), "order_id")


# --- reports on gold ------------------------------------------------------------------------

def star(lake: Lake, year: int = STAR_YEAR) -> DataFrame:
    """Dimensions are stored tables, so their true size decides how they are joined."""
    dims = [lake.stored(getattr(lake, name), name) for name in ("dim_customer", "dim_product", "dim_promotion")]
    days = gold.dim_date(day_spine(lake.spark, f"{year}-01-01", f"{year + 1}-01-01"))  # no other day can join
    return recipes.star_four_dims(lake.fact, days, *dims, year)


@query
def star_four_dims(lake):
    return star(lake)


@query
def weekend_vs_weekday(lake):
    return recipes.weekend_vs_weekday(lake.fact, lake.dates_of(("orders", "order_date")))


@query
def promo_effectiveness(lake):
    return recipes.promo_effectiveness(lake.fact, lake.stored(lake.dim_promotion, "dim_promotion"))


@query
def cohort_revenue(lake):
    return recipes.cohort_revenue(lake.fact, lake.dim_customer)


@query
def no_promo_share(lake):
    return recipes.no_promo_share(lake.fact)


@query
def null_fk_loss(lake):
    return recipes.null_key_loss(lake.silver("order_items"), lake.dim_promotion)


@query
def top_days(lake):
    return recipes.top_days(lake.orders_daily)


@query
def newest_days(lake):
    return recipes.top_days(lake.revenue_daily, newest=True)


@query
def reconcile_daily_orders(lake):
    return recipes.reconcile_daily_orders(lake.orders_daily, lake.revenue_daily)


@query
def reconcile_two_sources(lake):
    return recipes.reconcile_two_sources(lake.silver("sales_daily"), lake.revenue_daily)


@query
def rollup_check(lake):
    return recipes.rollup_check(lake.fact, lake.revenue_daily)


@query
def days_without_orders(lake):
    return recipes.days_without_orders(lake.order_calendar, lake.silver("orders"))


# --- further facts --------------------------------------------------------------------------

@query
def fact_returns(lake):
    return facts.fact_returns(lake.silver("returns"), lake.silver("orders"))


@query
def fact_payments(lake):
    return facts.fact_payments(lake.silver("payments"), lake.silver("orders"))


@query
def fact_shipments(lake):
    return facts.fact_shipments(lake.silver("shipments"), lake.silver("orders"))


@query
def fact_reviews(lake):
    return facts.fact_reviews(lake.silver("reviews"))


@query
def fact_web_traffic(lake):
    return facts.fact_web_traffic(lake.silver("web_traffic"))


@query
def fact_orders_lifecycle(lake):
    return facts.fact_orders(lake.silver("orders"), lake.silver("shipments"))


@query
def role_playing_dates(lake):
    orders_fact = facts.fact_orders(lake.silver("orders"), lake.silver("shipments"))
    days = lake.stored(lake.dates_of(("orders", "order_date"), ("shipments", "ship_date"), ("shipments", "delivery_date")), "days")
    return facts.role_playing_dates(orders_fact, days)


@query
def fact_inventory(lake):
    return facts.fact_inventory(lake.silver("inventory"))


@query
def fact_inventory_dense(lake):
    return facts.dense_inventory(lake.silver("inventory"), lake.dim_product)


@query
def fact_inventory_last(lake):
    return facts.inventory_last(lake.silver("inventory"))


@query
def fact_inventory_avg(lake):
    return facts.inventory_average(lake.silver("inventory"))


@query
def ratio_of_sums(lake):
    return facts.sell_through(lake.silver("inventory"))


@query
def promo_coverage(lake):
    return facts.promo_coverage(lake.silver("promotions"))


@query
def concurrent_promos(lake):
    days = lake.dates_of(("promotions", "start_date"), ("promotions", "end_date"))
    return facts.concurrent_promos(facts.promo_coverage(lake.silver("promotions")), days)


@query
def unused_promos(lake):
    return facts.unused_promos(facts.promo_coverage(lake.silver("promotions")),
                               facts.promo_bridge(lake.silver("order_items")))


@query
def promo_bridge(lake):
    return facts.promo_bridge(lake.silver("order_items"))


@query
def promo_bridge_revenue(lake):
    return facts.bridge_revenue(facts.promo_bridge(lake.silver("order_items")), lake.silver("promotions"))


@query
def drill_across(lake):
    returns_fact = facts.fact_returns(lake.silver("returns"), lake.silver("orders"))
    return facts.drill_across(lake.fact, returns_fact, lake.dim_product)


@query
def region_two_ways(lake):
    return facts.region_two_ways(lake.silver("orders"), lake.silver("geography"), lake.dim_customer)


def _keyed_facts(lake: Lake) -> dict[str, tuple[DataFrame, dict[str, str]]]:
    """The tables made by grouping lines or events are stored, as both their fact and the calendar read them; of
    inventory, the longest, only the keys.
    """
    orders = lake.silver("orders")
    shipments = lake.held("shipments", "order_id", "ship_date", "delivery_date", "shipping_fee")
    inventory = lake.held("inventory", "snapshot_date", "product_id").toDF("date_key", "product_key")
    traffic = lake.held("web_traffic", *SPECS["web_traffic"].names)
    dated = {"dim_date": "date_key"}
    buyer, product = {"dim_customer": "customer_key"}, {"dim_product": "product_key"}
    return {
        "fact_order_items": (lake.fact, {**dated, **buyer, **product, "dim_promotion": "promo_key"}),
        "fact_payments": (facts.fact_payments(lake.silver("payments"), orders), {**dated, **buyer}),
        "fact_shipments": (facts.fact_shipments(shipments, orders), {**dated, **buyer}),
        "fact_returns": (facts.fact_returns(lake.silver("returns"), orders), {**dated, **buyer, **product}),
        "fact_reviews": (facts.fact_reviews(lake.silver("reviews")), {**dated, **buyer, **product}),
        "fact_inventory": (inventory, {**dated, **product}),
        "fact_web_traffic": (facts.fact_web_traffic(traffic), dated),
    }


def _keyed_dimensions(lake: Lake) -> dict[str, tuple[DataFrame, str]]:
    return {"dim_date": (lake.spanned_dates, "date_key"), "dim_customer": (lake.dim_customer, "customer_id"),
            "dim_product": (lake.dim_product, "product_id"), "dim_promotion": (lake.dim_promotion, "promo_id")}


@query
def bus_matrix(lake):
    return facts.bus_matrix(_keyed_facts(lake), _keyed_dimensions(lake))


@query
def key_inclusions(lake):
    """The bus matrix found from the tables: what share of each key column each dimension contains."""
    candidates = {name: (fact, [column for column in fact.columns if column.endswith("_key")])
                  for name, (fact, _) in _keyed_facts(lake).items()}
    return profile.inclusions(candidates, _keyed_dimensions(lake))


@query
def junk_dim(lake):
    attributes = ["order_status", "payment_method", "device_type", "order_source"]
    # The key is a Spark hash, which other engines do not compute alike.
    return keys.junk_dimension(lake.silver("orders"), attributes).drop("junk_key")


# --- tables kept up to date -----------------------------------------------------------------

def _changed_orders(lake: Lake) -> tuple[DataFrame, DataFrame]:
    """Rows of silver orders that no longer hold, and those that hold now."""
    orders = lake.silver("orders")
    gone = orders.filter(f"({_CANCELLED}) or ({_POSTPONED}) or ({_DELETED})")
    return lake.stored(gone, "orders-gone"), lake.stored(_later_orders(orders), "orders-come")


def _without(rows: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(gone.select(*keys), keys, "left_anti")


@query
def orders_daily_refreshed(lake):
    gone, come = _changed_orders(lake)
    daily = lake.stored(lake.orders_daily, "orders-daily")
    customers = lake.stored(refresh.customers_per_day(lake.silver("orders")), "customers-per-day")
    return refresh.refresh_orders_daily(daily, customers, gone, come)[0]


@query
def revenue_daily_refreshed(lake):
    """Orders change as above; besides, lines of big quantity go and the remaining lines of cheap goods get dearer."""
    gone, come = _changed_orders(lake)
    items, orders = lake.silver("order_items"), lake.silver("orders")
    changed = items.filter("quantity = 50 or unit_price < 1000")
    after = changed.filter("quantity < 50").withColumns({
        "unit_price": F.col("unit_price") + 1, "line_amount": F.col("line_amount") + F.col("quantity")})
    new_items = items.filter("not (quantity = 50 or unit_price < 1000)").unionByName(after)
    new_orders = _without(orders, gone, ["order_id"]).unionByName(come)
    state = lake.stored(refresh.revenue_state(items, orders), "revenue-state")
    touched = lake.stored(refresh.touched_orders(gone, come, changed), "touched-orders")
    return refresh.revenue_view(refresh.refresh_revenue_daily(state, touched, (items, orders), (new_items, new_orders)))


@query
def fact_orders_advanced(lake):
    """The order life cycle in four nightly batches; what a batch tells of an order yet unknown waits for it."""
    orders, shipments = lake.silver("orders"), lake.silver("shipments")
    bounds = ["0001-01-01", *SNAPSHOT_DAYS[:3], "9999-12-31"]
    fact = facts.fact_orders(orders, shipments).limit(0)
    waiting = shipments.select("order_id", "ship_date", "delivery_date").limit(0)
    for low, high in zip(bounds, bounds[1:]):
        def news(column: str, low=low, high=high):
            return F.when((F.col(column) > low) & (F.col(column) <= high), F.col(column))

        sent = shipments.select("order_id", news("ship_date").alias("ship_date"), F.lit(None).cast("date").alias("delivery_date"))
        arrived = shipments.select("order_id", F.lit(None).cast("date").alias("ship_date"),
                                   news("delivery_date").alias("delivery_date"))
        batch = lake.stored(waiting.unionByName(sent).unionByName(arrived).filter(
            "ship_date is not null or delivery_date is not null"), "shipment-batch")
        placed = orders.filter(news("order_date").isNotNull())
        waiting = lake.stored(refresh.early_shipments(fact, placed, batch), "early-shipments")
        fact = lake.stored(refresh.advance_orders(fact, placed, batch), "fact-orders")
    return fact


# --- customers over time --------------------------------------------------------------------

def _snapshots(lake: Lake) -> DataFrame:
    return facts.customer_snapshots(lake.silver("customers"), lake.silver("orders"), SNAPSHOT_DAYS)


def _history(lake: Lake) -> DataFrame:
    return lake.stored(history.scd2(_snapshots(lake), "customer_id", TRACKED), "customer-history")


@query
def scd2_customers(lake):
    return history.scd2(_snapshots(lake), "customer_id", TRACKED)


@query
def scd2_incremental(lake):
    """The same history, one snapshot at a time; each step is stored like a nightly run."""
    stacked = lake.stored(_snapshots(lake), "snapshots")
    days = {day: stacked.filter(F.col("snapshot_date") == F.lit(day).cast("date")) for day in SNAPSHOT_DAYS}
    versions = history.scd2(days.pop(SNAPSHOT_DAYS[0]), "customer_id", TRACKED)
    for day, snapshot in days.items():
        versions = history.scd2_advance(lake.stored(versions, "history-step"), snapshot.drop("snapshot_date"), day,
                                        "customer_id", TRACKED)
    return versions


@query
def scd2_asof_lookup(lake):
    return facts.orders_as_of(lake.silver("orders"), _history(lake)).select(
        "order_id", "customer_id", "order_date", "customer_zip", "valid_from",
        (F.col("customer_sk") == keys.UNKNOWN_MEMBER).alias("is_unknown"))


@query
def surrogate_keys(lake):
    versions = _history(lake)
    return facts.surrogate_key_audit(versions, facts.orders_as_of(lake.silver("orders"), versions))


@query
def dense_keys(lake):
    """Customers numbered in two batches: the first keep their numbers, the next follow without a gap; orders point to them."""
    customers, orders = lake.silver("customers"), lake.silver("orders")
    early = customers.filter(F.col("signup_date") < SNAPSHOT_DAYS[0])
    first = keys.extend_dictionary(None, early, ["customer_id"], lake.stored)
    second = keys.extend_dictionary(first, customers, ["customer_id"], lake.stored)
    placed = keys.with_dense_key(orders.select("order_id", "customer_id"), second, ["customer_id"], "customer_sk")
    kept = second.join(first.select("customer_id", F.col("sk").alias("old_sk")), "customer_id", "left")
    return _union([
        kept.agg(F.count("*").alias("members"), F.min("sk").alias("least key"), F.max("sk").alias("greatest key"),
                 F.countDistinct("sk").alias("distinct keys"), F.count("old_sk").alias("early members"),
                 F.max("old_sk").alias("greatest early key"), F.count_if(F.col("sk") != F.col("old_sk")).alias("changed keys"))
        .select(F.stack(F.lit(7), *[x for name in ("members", "least key", "greatest key", "distinct keys", "early members",
                                                    "greatest early key", "changed keys") for x in (F.lit(name), F.col(name))])
                .alias("measure", "num_rows")),
        placed.agg(F.count_if(F.col("customer_sk") == keys.UNKNOWN_MEMBER).alias("num_rows")).select(
            F.lit("unknown member orders").alias("measure"), "num_rows")])


@query
def scd_variants(lake):
    """Type 0, 1 and 3 of the address side by side."""
    stacked = lake.stored(_snapshots(lake), "snapshots")
    first = history.as_first_seen(stacked, "customer_id", "zip").withColumnRenamed("zip", "type0_zip")
    last = history.as_last_seen(stacked, "customer_id", "zip").withColumnRenamed("zip", "type1_zip")
    third = history.with_previous(history.scd2(stacked, "customer_id", ["zip"]), "customer_id", "zip")
    return first.join(last, "customer_id").join(third, "customer_id")


@query
def scd4_tables(lake):
    """Type 4: rows of the lean current table and of the history table, per channel."""
    current, closed = history.split_current(_history(lake))

    def counted(df: DataFrame, name: str) -> DataFrame:
        return (df.groupBy("acquisition_channel").agg(F.count("*").alias("num_rows"))
                .select(F.lit(name).alias("table_name"), "*"))

    return counted(current, "current").unionByName(counted(closed, "history"))
