"""Profiles of keys and relations. Everything is counted per key first, so hot keys
stay small and no join ever multiplies rows."""

import itertools
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.money import ratio
from granary.operators.joins import skew_join
from granary.operators.quality import count_failing, related


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def fk_orphans(edges: list[tuple[str, DataFrame, str, str, DataFrame, str]]) -> DataFrame:
    """Per edge (child name, child, column, parent name, parent, column): child rows without a parent.

    One name stands for one frame, which is read once, however many edges it has.
    """
    frames = {name: df for edge in edges for name, df in ((edge[0], edge[1]), (edge[3], edge[4]))}
    counted = count_failing(frames, [(child, related(child_key, parent, parent_key))
                                     for child, _, child_key, parent, _, parent_key in edges])
    names = counted.sparkSession.createDataFrame(
        [(k, edge[0], edge[2], edge[3]) for k, edge in enumerate(edges)],
        "number int, child string, child_column string, parent string")
    return names.join(counted, "number").select("child", "child_column", "parent", F.col("failing_rows").alias("orphan_rows"))


def rows_per_key(parent: DataFrame, children: dict[str, DataFrame], key: str) -> DataFrame:
    """One row per key value with the number of parent rows and of rows of each child.

    One union and one aggregation serve all relations of the key at once.
    """
    sides = {"parent": parent, **children}
    tagged = _all([df.select(F.col(key).alias("key"), F.lit(name).alias("side"))
                   for name, df in sides.items()])
    counts = [F.count_if(F.col("side") == name).alias(name) for name in sides]
    return tagged.filter("key is not null").groupBy("key").agg(*counts)


def cardinality(parent: DataFrame, children: dict[str, DataFrame], key: str) -> DataFrame:
    """Per child: rows, distinct keys and the class of the relation."""
    per_key = rows_per_key(parent, children, key)
    stats = per_key.agg(*[
        F.struct(F.lit(name).alias("child"),
                 F.sum(name).alias("num_rows"),
                 F.count_if(F.col(name) > 0).alias("distinct_keys"),
                 F.max(name).alias("max_rows_per_key")).alias(name) for name in children])
    return stats.select(F.inline(F.array(*children))).withColumn(
        "relation", F.when(F.col("num_rows") == F.col("distinct_keys"), "1:1").otherwise("1:n"))


def coverage(parent: DataFrame, children: dict[str, DataFrame], key: str) -> DataFrame:
    """Per child: parent rows, those with at least one child row, those without."""
    per_key = rows_per_key(parent, children, key)
    rows = F.col("parent")
    stats = per_key.agg(*[
        F.struct(F.lit(name).alias("child"),
                 F.sum(rows).alias("parent_rows"),
                 F.sum(F.when(F.col(name) > 0, rows).otherwise(0)).alias("covered_rows"),
                 F.sum(F.when(F.col(name) == 0, rows).otherwise(0)).alias("missing_rows")).alias(name)
        for name in children])
    return stats.select(F.inline(F.array(*children)))


def inclusions(facts: dict[str, tuple[DataFrame, list[str]]], dimensions: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Which key columns of which facts the dimensions contain: one row per column and dimension.

    Every frame is read once. Grouping sets count the values of each column as they are, with partial sums in each task;
    only values that were counted become text, as which they are compared, and meet once: a row per value holds its count
    in each column and which dimensions know it, so one pass settles all pairs and a hot value is one row. NULLs count
    as rows only.
    """
    tags = [(fact, column) for fact, (_, columns) in facts.items() for column in columns]
    names = list(dimensions)

    def counted(fact: str, df: DataFrame, columns: list[str]) -> DataFrame:
        sets = df.groupingSets([[column] for column in columns], *columns).agg(
            F.grouping_id().alias("_set"), F.count("*").alias("n"))
        last = len(columns) - 1
        tag = F.coalesce(*[F.when(F.col("_set") == (2 << last) - 1 - (1 << last - k), F.lit(tags.index((fact, column))))
                           for k, column in enumerate(columns)])
        return sets.select(F.coalesce(*[F.col(column).cast("string") for column in columns]).alias("value"), tag.alias("tag"), "n")

    def known(number: int, df: DataFrame, key: str) -> DataFrame:
        values = df.filter(F.col(key).isNotNull()).select(key).distinct()
        return values.select(F.col(key).cast("string").alias("value"), F.lit(len(tags) + number).alias("tag"),
                             F.lit(1).cast("long").alias("n"))

    parts = [counted(fact, df, columns) for fact, (df, columns) in facts.items() if columns]
    parts += [known(k, df, key) for k, (df, key) in enumerate(dimensions.values())]
    per_value = _all(parts).groupBy("value").agg(
        *[F.max(F.col("tag") == len(tags) + k).alias(f"known{k}") for k in range(len(names))],
        *[F.sum(F.when(F.col("tag") == t, F.col("n"))).alias(f"n{t}") for t in range(len(tags))])
    # A row for each set of dimensions that know the same values, however many values there are.
    kinds = per_value.groupBy(F.col("value").isNotNull().alias("given"), *[f"known{k}" for k in range(len(names))]).agg(
        *[F.struct(F.lit(t).alias("tag"), F.coalesce(F.sum(f"n{t}"), F.lit(0)).alias("rows"),
                   F.count(f"n{t}").alias("values")).alias(f"counts{t}") for t in range(len(tags))])
    cells = kinds.select("given", F.array(*[f"known{k}" for k in range(len(names))]).alias("known"),
                         F.inline(F.array(*[f"counts{t}" for t in range(len(tags))]))).select(
        "given", "tag", "rows", "values", F.posexplode("known").alias("dim", "is_known"))
    stats = cells.groupBy("tag", "dim").agg(
        F.sum("rows").alias("num_rows"), F.sum(F.when(F.col("given"), F.col("values"))).alias("num_values"),
        F.sum(F.when(F.col("is_known"), F.col("rows"))).alias("matched_rows"),
        F.sum(F.when(F.col("is_known"), F.col("values"))).alias("matched_values"))
    cell = list(itertools.product(range(len(tags)), range(len(names))))
    grid = stats.sparkSession.createDataFrame(
        [(t, d, *tags[t], names[d]) for t, d in cell],
        "tag int, dim int, fact string, key_column string, dimension string")
    return grid.join(stats, ["tag", "dim"], "left").select(
        "fact", "key_column", "dimension", *[F.coalesce(name, F.lit(0)).alias(name) for name in (
            "num_rows", "num_values", "matched_rows", "matched_values")])


def copies_agree(left: DataFrame, right: DataFrame, key: str, column: str) -> DataFrame:
    """Compare two copies of a column over an inner join on `key`; `right` is unique on it.

    `left` comes straight from a scan (see `row_number_in_scan`).
    """
    both = skew_join(left.select(key, column), right.select(key, F.col(column).alias("copy")), [key])
    return both.agg(F.count("*").alias("compared_rows"),
                    F.count_if(F.col(column) != F.col("copy")).alias("differing_rows"))


def fan_out(left: DataFrame, right: DataFrame, key: list[str], grain: list[str]) -> DataFrame:
    """Rows that a left join would give: on `key` only, on the full `grain`, and with the
    right side aggregated to the grain first.

    The rows are computed from counts per key; the joins themselves are never run.
    Products of counts are decimals, and a total beyond 64 bits raises an error.
    """
    def joined(on: list[str], form: str) -> DataFrame:
        n_left = left.groupBy(*on).agg(F.count("*").alias("n_left"))
        n_right = right.groupBy(*on).agg(F.count("*").alias("n_right"))
        matches = F.greatest(F.coalesce("n_right", F.lit(1)), F.lit(1)).cast("decimal(19,0)")
        product = F.col("n_left").cast("decimal(19,0)") * matches
        return n_left.join(n_right, on, "left").agg(
            F.sum("n_left").alias("left_rows"), F.sum(product).cast("bigint").alias("joined_rows"),
        ).select(F.lit(form).alias("join_form"), "*")

    first = left.agg(F.count("*").alias("left_rows")).select(
        F.lit("aggregated first").alias("join_form"), "left_rows", F.col("left_rows").alias("joined_rows"))
    forms = _all([joined(key, "by " + ", ".join(key)), joined(grain, "by " + ", ".join(grain)), first])
    return forms.withColumn("extra_rows", F.col("joined_rows") - F.col("left_rows"))


def time_coverage(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per table: first and last day, dated rows, days that occur."""
    parts = []
    for name, (df, column) in tables.items():
        per_day = df.groupBy(F.col(column).alias("day")).agg(F.count("*").alias("n")).filter("day is not null")
        parts.append(per_day.agg(
            F.min("day").alias("first_day"), F.max("day").alias("last_day"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("dated_rows"), F.count("*").alias("num_days"),
        ).select(F.lit(name).alias("table_name"), "*"))
    return _all(parts)


def mean_rows_per_key(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.count("*").alias("num_rows"), F.countDistinct(key).alias("num_keys")).withColumn(
        "rows_per_key", ratio(F.col("num_rows"), F.col("num_keys")))
