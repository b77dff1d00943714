"""Admission: which rows of the sources the gated build can pass on.

A row is admitted if no rule names it, the values that models require are there,
and all it refers to is admitted; a reference that is absent is allowed where
the rules allow it. The other rows stay in quarantine under the first reason
found. Tables are decided after those they refer to, so what hangs on a refused
row is refused with it.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.operators.flagging import REASON

REFUSED = "_refused"
REQUIRED = {"geography": ("region",)}
# (column, table, its key), parents before children
REFERENCES = {
    "geography": (), "products": (), "promotions": (),
    "customers": (("zip", "geography", "zip"),),
    "orders": (("customer_id", "customers", "customer_id"),),
    "order_items": (("order_id", "orders", "order_id"), ("product_id", "products", "product_id"),
                    ("promo_id", "promotions", "promo_id")),
}


def admitted(marked: DataFrame) -> DataFrame:
    return marked.filter(F.col(REFUSED).isNull()).drop(REFUSED)


def mark(bronze: dict[str, DataFrame], store: Callable[[DataFrame, str], DataFrame]) -> dict[str, DataFrame]:
    """Every bronze row with the reason for which it is refused, NULL if it is admitted; each table is stored.

    The parents' side of a join is one row per key, so no row is multiplied and
    adaptive execution may split a hot key on the children's side.
    """
    marked: dict[str, DataFrame] = {}
    for name, references in REFERENCES.items():
        df = bronze[name].withColumn(REFUSED, F.coalesce(REASON, *[
            F.when(F.col(column).isNull(), f"{column}_missing") for column in REQUIRED.get(name, ())], F.lit(None).cast("string")))
        for column, parent, key in references:
            known = admitted(marked[parent]).select(F.col(key).alias("_known")).distinct()
            unknown = F.col(column).isNotNull() & F.col("_known").isNull()
            df = df.join(known, F.col(column) == F.col("_known"), "left").withColumn(
                REFUSED, F.coalesce(REFUSED, F.when(unknown, f"{column}_unknown"))).drop("_known")
        marked[name] = store(df, f"marked-{name}")
    return marked
