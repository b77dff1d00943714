"""The gated build: sources are checked, then each model is built and checked.

A model whose inputs did not pass is skipped. A check whose parent was skipped
cannot run: it is reported as skipped and its model as unchecked, which is not
passing. Only the check results, a few rows per model, come back to the driver.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from granary.functions.calendar import day_spine
from granary.operators.quality import check_grain, run_checks
from granary.plans import gold
from granary.plans.checks import GRAIN_CHECK, SOURCE_CHECKS, model_checks
from granary.plans.silver import silver

RESULT_SCHEMA = "model string, kind string, status string, failed_checks bigint"
CHECK_SCHEMA = "model string, column_name string, check_name string, failing_rows bigint, status string"


@dataclass(frozen=True)
class Model:
    """`make` receives its inputs by position. Views stay lazy, tables are written."""

    name: str
    inputs: tuple[str, ...]
    make: Callable[..., DataFrame]
    is_table: bool = True


def _silver_view(name: str) -> Model:
    return Model(f"silver_{name}", (name,), lambda bronze: silver(name, bronze), is_table=False)


# In dependency order: a relationship check needs its parent built before.
MODELS = (
    *[_silver_view(name) for name in ("orders", "order_items", "geography", "customers",
                                     "products", "promotions")],
    Model("dim_customer", ("silver_customers", "silver_geography"), gold.dim_customer),
    Model("dim_product", ("silver_products",), gold.dim_product),
    Model("dim_promotion", ("silver_promotions",), gold.dim_promotion),
    Model("dim_date", ("calendar",), gold.dim_date),
    Model("fact_order_items", ("silver_order_items", "silver_orders"), gold.fact_order_items),
    Model("gold_orders_daily", ("silver_orders",), gold.orders_daily),
    Model("gold_revenue_daily", ("silver_order_items", "silver_orders"), gold.revenue_daily),
)


def _failures(results: list) -> int:
    return sum(row["status"] == "fail" for row in results)


def build(spark: SparkSession, bronze: dict[str, DataFrame], calendar: tuple[str, str],
          store: Callable[[DataFrame, str], DataFrame]) -> tuple[DataFrame, DataFrame, dict[str, DataFrame]]:
    """Build all models; returns the report, every check's result, and the frames that were built.

    `calendar` is the first day of the date dimension and the day after its last.
    `store` writes a table model under its name and returns what was stored.
    A model is built, failed, skipped or unchecked; only after the first does
    what depends on it follow.
    """
    frames: dict[str, DataFrame] = {"calendar": day_spine(spark, *calendar)}
    declared = model_checks(calendar)
    report: list[tuple] = []
    checked: list[tuple] = []
    for name, checks in SOURCE_CHECKS.items():
        results = run_checks(name, bronze[name], checks, {}).collect()
        checked += [tuple(row) for row in results]
        failed = _failures(results)
        report.append((name, "source", "failed" if failed else "checked", failed))
        if not failed:
            frames[name] = bronze[name]
    passed = set(frames)
    for model in MODELS:
        kind = "table" if model.is_table else "view"
        if not passed.issuperset(model.inputs):
            report.append((model.name, kind, "skipped", 0))
            checked += [(model.name, check.column, check.kind, None, "skipped") for check in declared[model.name]]
            if model.name == GRAIN_CHECK[0]:
                checked.append((model.name, "*", "grain", None, "skipped"))
            continue
        df = model.make(*[frames[name] for name in model.inputs])
        if model.is_table:
            df = store(df, model.name)
        frames[model.name] = df
        lost = [check for check in declared[model.name] if check.parent and check.parent not in frames]
        results = run_checks(model.name, df, [check for check in declared[model.name] if check not in lost], frames)
        if model.name == GRAIN_CHECK[0]:
            results = results.unionByName(check_grain(model.name, df, frames[GRAIN_CHECK[1]]))
        rows = results.collect()
        checked += [tuple(row) for row in rows]
        checked += [(model.name, check.column, check.kind, None, "skipped") for check in lost]
        failed = _failures(rows)
        report.append((model.name, kind, "failed" if failed else "unchecked" if lost else "built", failed))
        if not failed and not lost:
            passed.add(model.name)
    return spark.createDataFrame(report, RESULT_SCHEMA), spark.createDataFrame(checked, CHECK_SCHEMA), frames
