"""Exact money aggregates.

A sum of doubles depends on the order of the rows, so two runs of one query on
a cluster may differ. Amounts are therefore added up as decimals and turned
into doubles once, at the very end.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT = "decimal(18,4)"
TOTAL = "decimal(38,4)"


def exact(amount: Column | str) -> Column:
    return (F.col(amount) if isinstance(amount, str) else amount).cast(AMOUNT)


def exact_total(amount: Column | str) -> Column:
    """A finished total as decimal, wide enough for any sum of amounts."""
    return (F.col(amount) if isinstance(amount, str) else amount).cast(TOTAL)


def exact_sum(amount: Column | str) -> Column:
    """A decimal total, still addable; use it in pre-aggregates."""
    return F.sum(exact(amount)).cast(TOTAL)


def total(amount: Column | str) -> Column:
    """A finished total as double."""
    return exact_sum(amount).cast("double")


def add_up(partial: str) -> Column:
    """Finish decimal totals made by `exact_sum`."""
    return F.sum(partial).cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator as double, NULL when the denominator is 0."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ratio_of_sums(numerator: str, denominator: str) -> Column:
    """Non-additive rates: add up both parts first, divide once."""
    return ratio(exact_sum(numerator), exact_sum(denominator))
