"""All layers over one input folder, built on demand and lazily."""

from functools import cache, cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions.calendar import day_spine, spine_between, whole_years
from granary.operators.flagging import flag
from granary.plans import gold, silver
from granary.session import scratch_dir
from granary.sources.retail import source_view
from granary.sources.specs import SPECS
from granary.sources.tables import write_folder

# The years of the given tables, the end day excluded; the calendar of a lake without any date.
CALENDAR = ("1994-01-01", "2002-01-01")


class Lake:
    """Frames are plans, not data: a reader gets what the folder holds when it runs.

    The star's calendar holds the whole years from the least to the greatest date of the silver tables. A caller may
    give another one, the end day excluded; facts outside it stay, without calendar columns.
    """

    def __init__(self, spark: SparkSession, folder: str, calendar: tuple[str, str] | None = None):
        self.spark, self.folder, self.given = spark, folder, calendar
        self.source = cache(lambda name: source_view(spark, folder, name))
        self.bronze = cache(lambda name: flag(self.source(name), SPECS[name]))
        self.silver = cache(lambda name: silver.silver(name, self.bronze(name)))
        self._held: dict[str, DataFrame] = {}

    def held(self, name: str, *columns: str) -> DataFrame:
        """Columns of a silver table, all its dates among them, stored once; the calendar reads its dates from there."""
        if name not in self._held:
            self._held[name] = self.stored(self.silver(name).select(*columns), f"silver-{name}")
        return self._held[name]

    @cached_property
    def years(self) -> DataFrame:
        """First and last day of the calendar years of all silver dates, as one row."""
        ends = None
        for name in SPECS:
            df = self._held[name] if name in self._held else self.silver(name)
            dates = [column for column, kind in df.dtypes if kind == "date"]
            if dates:
                pair = df.agg(F.array(*[end(column) for column in dates for end in (F.min, F.max)]).alias("day"))
                ends = pair if ends is None else ends.union(pair)
        first, last = (F.lit(day).cast("date") for day in CALENDAR)
        return whole_years(ends.select(F.explode("day").alias("day")), "day").select(
            F.coalesce("first_day", first).alias("first_day"), F.coalesce("last_day", F.date_sub(last, 1)).alias("last_day"))

    @cached_property
    def calendar(self) -> tuple[str, str]:
        """First day of the date dimension and the day after its last."""
        if self.given:
            return self.given
        return tuple(self.years.select(F.col("first_day").cast("string"),
                                       F.date_add("last_day", 1).cast("string")).first())

    @cached_property
    def dim_date(self) -> DataFrame:
        return gold.dim_date(day_spine(self.spark, *self.given) if self.given else spine_between(self.years))

    @cached_property
    def spanned_dates(self) -> DataFrame:
        """The rows of `dim_date` from its two ends, which come to the driver once: what reads it reads no table."""
        return gold.dim_date(day_spine(self.spark, *self.calendar))

    def dates_of(self, *columns: tuple[str, str]) -> DataFrame:
        """The rows of `dim_date` for the whole years that the named (silver table, date column) pairs cover.

        A join of these dates needs no others, and only these columns are read.
        """
        days = reduce(DataFrame.union, [self.silver(name).agg(F.array(F.min(day), F.max(day)).alias("day"))
                                        for name, day in columns])
        return gold.dim_date(spine_between(whole_years(days.select(F.explode("day").alias("day")), "day")))

    @cached_property
    def order_calendar(self) -> DataFrame:
        """All days of the years in which orders were placed."""
        return gold.dim_date(spine_between(whole_years(self.silver("orders"), "order_date")))

    @cached_property
    def dim_customer(self) -> DataFrame:
        return gold.dim_customer(self.silver("customers"), self.silver("geography"))

    @cached_property
    def dim_product(self) -> DataFrame:
        return gold.dim_product(self.silver("products"))

    @cached_property
    def dim_promotion(self) -> DataFrame:
        return gold.dim_promotion(self.silver("promotions"))

    @cached_property
    def fact(self) -> DataFrame:
        return gold.fact_order_items(self.silver("order_items"), self.silver("orders"))

    @cached_property
    def orders_daily(self) -> DataFrame:
        return gold.orders_daily(self.silver("orders"))

    @cached_property
    def revenue_daily(self) -> DataFrame:
        return gold.revenue_daily(self.silver("order_items"), self.silver("orders"))

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        """Write a frame that several steps read, instead of computing it each time."""
        return write_folder(df, scratch_dir(self.spark, name))
