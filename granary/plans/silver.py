"""Silver: the valid rows of each bronze table, as lazy frames."""

from pyspark.sql import DataFrame

from granary.operators.flagging import VALID
from granary.sources.specs import SPECS

# Columns that are new or differ from the bronze column of the same name, as SQL.
_DISCOUNT = "coalesce(discount_amount, 0.0D)"
DERIVED = {
    "order_items": {"discount_amount": _DISCOUNT, "line_amount": f"quantity * unit_price - {_DISCOUNT}"},
    "products": {"list_margin": "price - cogs"},
    "promotions": {"is_stackable": "stackable_flag = 1", "duration_days": "cast(datediff(end_date, start_date) as bigint)"},
}


COLUMNS = {
    "order_items": ["order_id", "product_id", "quantity", "unit_price", "discount_amount",
                    "line_amount", "promo_id", "promo_id_2"],
    "products": ["product_id", "product_name", "category", "segment", "size", "color", "price",
                 "cogs", "list_margin"],
    "promotions": ["promo_id", "promo_name", "promo_type", "discount_value", "start_date", "end_date",
                   "applicable_category", "promo_channel", "is_stackable", "min_order_value",
                   "duration_days"],
    "sales_daily": ["sale_date", "revenue", "cogs", "_margin_negative"],
}


def _selected(name: str) -> list[str]:
    derived = DERIVED.get(name, {})
    return [f"{derived[column]} as {column}" if column in derived else column for column in COLUMNS.get(name, SPECS[name].names)]


def silver(name: str, bronze: DataFrame) -> DataFrame:
    """Named columns of the valid rows; the other tables keep their source columns."""
    return bronze.filter(VALID).selectExpr(*_selected(name))


def silver_sql(name: str, bronze_table: str) -> str:
    """The same as a query on a catalog table, for a view."""
    return f"SELECT {', '.join(_selected(name))} FROM {bronze_table} WHERE {VALID}"
