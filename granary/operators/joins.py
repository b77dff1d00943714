"""Joins that keep the grain and survive hot keys.

Three rules decide the form of every join in this library:

* only an aggregate of the many side is wanted: aggregate by the join key first.
  The map-side combine turns a hot key into one row per task;
* the rows of the many side are wanted: `skew_join`. It is a plain join, whose
  skewed partitions adaptive execution splits and whose buckets it keeps; only
  keys that the caller names as hot are salted;
* both sides are unique on the key: a plain join.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SALT, _HOT = "_salt", "_hot_hash"
MIN_SHARE = 1e-4


def hot_keys(df: DataFrame, keys: list[str], share: float | None = None) -> DataFrame:
    """Hashes of the keys that hold more than `share` of all rows, and their number of rows.

    The default share is a quarter of an average shuffle partition, though never
    below MIN_SHARE, so there are at most 1 / MIN_SHARE of them and the result
    is safe to broadcast. One pass finds candidates with bounded memory, a
    second counts them exactly; keys that are not hot are not reported.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(MIN_SHARE, 1 / (4 * partitions) if share is None else share)
    hashes = df.select(F.xxhash64(*keys).alias("h"))
    candidates = hashes.stat.freqItems(["h"], share).select(F.explode("h_freqItems").alias(_HOT))
    counted = (hashes.join(F.broadcast(candidates), F.col("h") == F.col(_HOT), "left")
               .groupBy(_HOT).agg(F.count("*").alias("rows")))
    total = counted.agg(F.sum("rows")).scalar()
    return (counted.select(_HOT, "rows", total.alias("all_rows"))
            .filter(F.col(_HOT).isNotNull() & (F.col("rows") > share * F.col("all_rows"))))


def hottest_share(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: the share of all rows that the most frequent key holds, 0 if none is hot."""
    return hot_keys(df, keys).agg(F.coalesce(F.max(F.col("rows") / F.col("all_rows")), F.lit(0.0)).alias("share"))


def skew_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", hot: DataFrame | None = None,
              salts: int | None = None, spread: Column | None = None, condition: Column | None = None) -> DataFrame:
    """Inner or left join of a many side with a side of few rows per key.

    Without `hot` this is a plain join. `hot`, from `hot_keys` or from stored
    statistics, names the hashes of keys to salt: their left rows are spread
    over `salts` shuffle groups, and their right rows, only these, are repeated
    once per group. `spread` numbers the rows; the default, a hash of the row,
    gives the same groups when a task is run again. A left side that may hold
    many identical rows passes `row_number_in_scan()`. `condition` is an extra
    match condition on left and right columns.
    """
    if how not in ("inner", "left"):
        raise ValueError("skew_join does inner and left joins")
    if hot is None:
        return _joined(left, right, on, how, condition)
    groups = salts or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = F.broadcast(hot.select(_HOT))

    def marked(side: DataFrame) -> DataFrame:
        return side.join(named, F.xxhash64(*[side[key] for key in on]) == named[_HOT], "left")

    is_hot = F.col(_HOT).isNotNull()
    number = F.xxhash64(*left.columns) if spread is None else spread
    salted_left = marked(left.withColumn(_SALT, F.pmod(number, F.lit(groups)).cast("int"))).withColumn(
        _SALT, F.when(is_hot, F.col(_SALT)).otherwise(0)).drop(_HOT)
    all_groups = F.sequence(F.lit(0), F.lit(groups - 1))
    salted_right = marked(right).withColumn(
        _SALT, F.explode(F.when(is_hot, all_groups).otherwise(F.array(F.lit(0))))).drop(_HOT)
    return _joined(salted_left, salted_right, [*on, _SALT], how, condition).drop(_SALT)


def _joined(left: DataFrame, right: DataFrame, on: list[str], how: str,
            condition: Column | None) -> DataFrame:
    if condition is None:
        return left.join(right, on, how)
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in on})
    match = condition
    for key in on:
        match = match & (F.col(key) == F.col(f"_right_{key}"))
    return left.join(renamed, match, how).drop(*[f"_right_{key}" for key in on])


def row_number_in_scan() -> Column:
    """Row position within the task. Stable on a re-run only for rows that come
    straight from a file scan, without a shuffle in between."""
    return F.monotonically_increasing_id()


def without_match(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Left rows whose key is absent on the right; the right side shrinks to its keys first."""
    return left.join(right.select(*on).distinct(), on, "left_anti")


def orphan_count(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """One row: child rows with a non-null key that the parent lacks."""
    per_key = (child.filter(F.col(child_key).isNotNull())
               .groupBy(F.col(child_key).alias("key")).agg(F.count("*").alias("n")))
    parents = parent.select(F.col(parent_key).alias("key"))
    return without_match(per_key, parents, ["key"]).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"))
