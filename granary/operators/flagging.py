"""Declarative table specs and the flagging step that bronze applies.

A rule states what is wrong with a row. A rule that evaluates to NULL does not
fire: a NULL is an offence only where the rule says `is null`.
"""

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from granary.sources.tables import Layout

REASON = "_invalid_reason"
VALID = "_is_valid"


@dataclass(frozen=True)
class Rule:
    code: str
    offence: str


def missing(name: str) -> str:
    return f"{name} is null"


def missing_or(name: str, comparison: str) -> str:
    return f"{name} is null or {name} {comparison}"


def not_one_of(name: str, allowed: tuple) -> str:
    return f"{name} not in ({', '.join(repr(value) for value in allowed)})"


def not_within(name: str, low, high) -> str:
    return f"{name} not between {low} and {high}"


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: str
    rules: tuple[Rule, ...]
    tidy: Mapping[str, Callable[[str], Column]] = field(default_factory=dict)
    notes: Mapping[str, str] = field(default_factory=dict)
    header: tuple[str, ...] = ()
    layout: Layout = Layout()

    @property
    def schema(self) -> StructType:
        """`columns` reads "name type" pairs; a trailing `!` declares non-null intent."""
        fields = [part.split() for part in self.columns.split(",")]
        schema = StructType()
        for name, kind in fields:
            schema.add(name, kind.rstrip("!"), not kind.endswith("!"))
        return schema

    @property
    def names(self) -> list[str]:
        return self.schema.fieldNames()


def flag(df: DataFrame, spec: TableSpec, carried: tuple[str, ...] = ()) -> DataFrame:
    """Normalise the text columns and mark, never drop, the rows that break a rule; `carried` columns go along."""
    tidy = df.withColumns({name: how(name) for name, how in spec.tidy.items()})
    marks = {f"_breaks_{i}": F.coalesce(F.expr(rule.offence), F.lit(False))
             for i, rule in enumerate(spec.rules)}
    codes = F.concat_ws(", ", *[F.when(F.col(mark), F.lit(rule.code))
                                for mark, rule in zip(marks, spec.rules)])
    # A conjunction instead of "reason is null": readers that only want valid rows
    # then need no string work, and its null checks reach the file scan.
    clean = reduce(lambda a, b: a & b, [~F.col(mark) for mark in marks])
    return tidy.withColumns(marks).select(
        *[F.col(name) for name in spec.names],
        F.nullif(codes, F.lit("")).alias(REASON),
        clean.alias(VALID),
        *[F.expr(text).alias(name) for name, text in spec.notes.items()], *carried,
    )


def valid_counts(bronze: DataFrame, extra_flags: Mapping[str, str] | None = None) -> DataFrame:
    """Row counts in one pass; `extra_flags` maps an output name to another boolean column."""
    return bronze.agg(
        F.count("*").alias("total_rows"),
        F.count_if(F.col(VALID)).alias("valid_rows"),
        F.count_if(~F.col(VALID)).alias("invalid_rows"),
        *[F.count_if(F.col(flag_name)).alias(name) for name, flag_name in (extra_flags or {}).items()],
    )


def reason_histogram(bronze: DataFrame, per_code: bool = False) -> DataFrame:
    """Invalid rows per reason text, or per single code."""
    invalid = bronze.filter(~F.col(VALID))
    reason = F.explode(F.split(REASON, ", ")) if per_code else F.col(REASON)
    return invalid.select(reason.alias("reason")).groupBy("reason").agg(F.count("*").alias("num_rows"))
