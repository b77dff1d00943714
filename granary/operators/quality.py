"""Data checks. A check looks for offending rows; no offender means it passes.

NULL offends `not_null` only. All checks that run together share one read of each frame.
"""

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.operators.joins import orphan_count

RESULT = ("model", "column_name", "check_name", "failing_rows", "status")


@dataclass(frozen=True)
class Check:
    kind: str
    column: str
    values: tuple = ()
    parent: str | None = None
    parent_column: str | None = None
    low: float | None = None
    high: float | None = None
    inclusive: bool = True


def not_null(column: str) -> Check:
    return Check("not_null", column)


def unique(column: str) -> Check:
    return Check("unique", column)


def accepted(column: str, values: Sequence) -> Check:
    return Check("accepted_values", column, values=tuple(values))


def related(column: str, parent: str, parent_column: str) -> Check:
    return Check("relationships", column, parent=parent, parent_column=parent_column)


def in_range(column: str, low=None, high=None, above=None) -> Check:
    """Inclusive bounds `low` and `high`, or the exclusive lower bound `above`."""
    if above is not None:
        return Check("accepted_range", column, low=above, inclusive=False)
    return Check("accepted_range", column, low=low, high=high)


def offends(check: Check) -> Column:
    """The row condition of a row-by-row check; NULL means no offence."""
    value = F.col(check.column)
    if check.kind == "not_null":
        return value.isNull()
    if check.kind == "accepted_values":
        return ~value.isin(*check.values)
    bounds = []
    if check.low is not None:
        bounds.append(value >= check.low if check.inclusive else value > check.low)
    if check.high is not None:
        bounds.append(value <= check.high if check.inclusive else value < check.high)
    return ~reduce(lambda a, b: a & b, bounds)


def offenders(df: DataFrame, check: Check) -> DataFrame:
    """The offending rows of a row-by-row check."""
    return df.filter(offends(check))


def duplicates(df: DataFrame, columns: list[str]) -> DataFrame:
    """Non-null keys that occur more than once, with their number of rows."""
    known = reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in columns])
    return df.filter(known).groupBy(*columns).agg(F.count("*").alias("num_rows")).filter("num_rows > 1")


def unexpected_values(df: DataFrame, check: Check) -> DataFrame:
    """Distinct values outside the accepted list, with their number of rows."""
    return (offenders(df, check).groupBy(F.col(check.column).alias("value"))
            .agg(F.count("*").alias("num_rows")))


def grain_breach(fact: DataFrame, base: DataFrame) -> DataFrame:
    """One row with both counts if they differ, else no row."""
    sides = fact.select(F.lit("fact").alias("side")).unionAll(base.select(F.lit("silver").alias("side")))
    return sides.agg(
        F.count_if(F.col("side") == "fact").alias("fact_rows"),
        F.count_if(F.col("side") == "silver").alias("silver_rows"),
    ).filter("fact_rows <> silver_rows")


def _result(counted: DataFrame, model: str, column: str, kind: str, failing: str) -> DataFrame:
    return counted.select(
        F.lit(model).alias("model"), F.lit(column).alias("column_name"), F.lit(kind).alias("check_name"),
        F.col(failing).cast("bigint").alias("failing_rows"),
        F.when(F.col(failing) == 0, "pass").otherwise("fail").alias("status"),
    )


def count_failing(frames: dict[str, DataFrame], declared: list[tuple[str, Check]]) -> DataFrame:
    """(number, failing_rows) of each (frame, check), numbered as listed; every frame is read once.

    A row gives one tagged value for each key column that has to be unique, that others
    refer to or that refers to such a key, and one for all its row-by-row checks
    together, if any finds an offence: a text that says which. All tagged values are
    counted by key space and value, with partial sums in each task, so a hot key is
    one row per task. Whole numbers and dates are compared as numbers if a key space
    holds nothing else, other keys as text.
    """
    spaces: dict[tuple, int] = {}
    columns: dict[int, list[tuple[str, int | None, str]]] = {}  # of a key space: frame, slot, column
    row_checks: dict[str, list[int]] = {}
    places = []

    def key_space(frame: str, column: str) -> int:
        if (frame, column) not in spaces:
            space = spaces[frame, column] = len(spaces)
            columns[space] = [(frame, None, column)]
        return spaces[frame, column]

    for number, (frame, check) in enumerate(declared):
        if check.kind == "unique":
            places.append((number, key_space(frame, check.column), None))
        elif check.kind == "relationships":
            space = key_space(check.parent, check.parent_column)
            places.append((number, space, len(columns[space]) - 1))
            columns[space].append((frame, len(columns[space]) - 1, check.column))
        else:
            row_checks.setdefault(frame, []).append(number)

    entries: dict[str, list[Column]] = {}

    def emit(frame: str, space: int, slot: int | None, number: Column, text: Column, wanted: Column) -> None:
        entry = F.struct(F.lit(space).alias("space"), F.lit(slot).cast("int").alias("slot"),
                         number.cast("long").alias("num"), text.cast("string").alias("text"))
        entries.setdefault(frame, []).append(F.when(wanted, entry))

    for space, members in columns.items():
        kinds = {_key_kind(frames[frame], column) for frame, _, column in members}
        kind = kinds.pop() if len(kinds) == 1 else "text"
        for frame, slot, column in members:
            value, none = F.col(column), F.lit(None)
            as_number = F.unix_date(value) if kind == "date" else none if kind == "text" else value
            emit(frame, space, slot, as_number, value if kind == "text" else none, value.isNotNull())
    first_row_space = len(spaces)
    for k, (frame, numbers) in enumerate(row_checks.items()):
        offences = [F.coalesce(offends(declared[number][1]), F.lit(False)) for number in numbers]
        which = F.concat(*[F.when(offence, "1").otherwise("0") for offence in offences])
        emit(frame, first_row_space + k, None, F.lit(None), which, reduce(lambda a, b: a | b, offences))
    tagged = [frames[name].select(F.inline(F.array(*found))).filter("space is not null") for name, found in entries.items()]
    slots = range(max((len(members) - 1 for members in columns.values()), default=0))
    per_value = reduce(DataFrame.unionByName, tagged).groupBy("space", "num", "text").agg(
        F.count_if(F.col("slot").isNull()).alias("owners"),
        *[F.count_if(F.col("slot") == k).alias(f"n{k}") for k in slots])
    lost = [F.struct(F.lit(k).alias("slot"), F.sum(F.when(F.col("owners") == 0, F.col(f"n{k}"))).alias("n")) for k in slots]
    repeated = F.struct(F.lit(None).cast("int").alias("slot"), F.count_if(F.col("owners") > 1).alias("n"))
    most = max(map(len, row_checks.values()), default=0)
    broken = [F.struct(F.lit(j).alias("slot"), F.sum(F.when(F.substring("text", j + 1, 1) == "1", F.col("owners"))).alias("n"))
              for j in range(most)]
    totals = F.array(repeated, *lost)
    if broken:
        totals = F.when(F.col("space") < first_row_space, totals).otherwise(F.array(*broken))
    found = per_value.groupBy("space").agg(totals.alias("found")).select("space", F.inline("found"))
    places += [(number, first_row_space + k, j) for k, numbers in enumerate(row_checks.values()) for j, number in enumerate(numbers)]
    listed = found.sparkSession.createDataFrame(places, "number int, _space int, _slot int")
    return listed.join(found, (F.col("space") == F.col("_space")) & F.col("slot").eqNullSafe(F.col("_slot")), "left").select(
        "number", F.coalesce("n", F.lit(0)).cast("bigint").alias("failing_rows"))


def _key_kind(df: DataFrame, column: str) -> str:
    kind = df.schema[column].dataType.typeName()
    return "whole" if kind in ("byte", "short", "integer", "long") else kind if kind == "date" else "text"


def run_all(frames: dict[str, DataFrame], checks: dict[str, list[Check]]) -> DataFrame:
    """One result row per check of each frame, with one read of every frame.

    A row counts offending rows, for `unique` offending values.
    """
    declared = [(name, check) for name, some in checks.items() for check in some]
    names = [(k, name, check.column, check.kind) for k, (name, check) in enumerate(declared)]
    counted = count_failing(frames, declared)
    listed = counted.sparkSession.createDataFrame(names, "number int, model string, column_name string, check_name string")
    return listed.join(counted, "number").select(
        "model", "column_name", "check_name", "failing_rows",
        F.when(F.col("failing_rows") == 0, "pass").otherwise("fail").alias("status"))


def run_checks(model: str, df: DataFrame, checks: list[Check], parents: dict[str, DataFrame]) -> DataFrame:
    """The results of one frame's checks; `parents` are the frames that its relationships name."""
    return run_all({**parents, model: df}, {model: checks})


def check_grain(model: str, fact: DataFrame, base: DataFrame) -> DataFrame:
    counted = grain_breach(fact, base).agg(F.count("*").alias("n"))
    return _result(counted, model, "*", "grain", "n")
