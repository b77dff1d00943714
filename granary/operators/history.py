"""Slowly changing dimensions built from dated snapshots.

A snapshot frame has one row per member and a date column. All window
partitions here hold one member's rows at one row per snapshot date, so their
size is bounded by the number of snapshots, however many rows a member has.
"""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def stack_snapshots(snapshots: dict[str, DataFrame]) -> DataFrame:
    """Union of `date -> frame` with the date as `snapshot_date`."""
    dated = [df.withColumn("snapshot_date", F.lit(day).cast("date")) for day, df in snapshots.items()]
    return reduce(DataFrame.unionByName, dated)


def scd2(stacked: DataFrame, key: str, tracked: list[str]) -> DataFrame:
    """Type 2: one row per member and version with valid_from, valid_to, is_current.

    `valid_to` is exclusive and NULL for the current version. A member that is
    absent from a later snapshot keeps its last version open.
    """
    per_day = (stacked.filter(F.col(key).isNotNull())
               .groupBy(key, "snapshot_date").agg(F.max(F.struct(*tracked)).alias("_state")))
    by_day = Window.partitionBy(key).orderBy("snapshot_date")
    previous = F.lag("_state").over(by_day)
    changes = per_day.withColumn("_changed", previous.isNull() | ~previous.eqNullSafe(F.col("_state")))
    versions = changes.filter("_changed").withColumn("valid_to", F.lead("snapshot_date").over(by_day))
    return versions.select(
        key, *[F.col(f"_state.{name}").alias(name) for name in tracked],
        F.col("snapshot_date").alias("valid_from"), "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
    )


def scd2_advance(history: DataFrame, snapshot: DataFrame, day: str, key: str,
                 tracked: list[str]) -> DataFrame:
    """Type 2, incremental: apply one newer snapshot to a history.

    Both sides of the join hold one row per member, so no key is hot.
    """
    today = F.lit(day).cast("date")
    new = snapshot.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(*tracked)).alias("_new"))
    current = history.filter("is_current").select(key, F.struct(*tracked).alias("_old"), "valid_from")
    both = current.join(new, key, "full")
    changed = F.col("_new").isNotNull() & ~F.col("_new").eqNullSafe(F.col("_old"))

    def rows(frame: DataFrame, state: str, valid_from, valid_to) -> DataFrame:
        return frame.select(
            key, *[F.col(f"{state}.{name}").alias(name) for name in tracked],
            valid_from.alias("valid_from"), valid_to.cast("date").alias("valid_to"),
            valid_to.isNull().alias("is_current"))

    closing = F.when(changed, today)
    kept = rows(both.filter(F.col("_old").isNotNull()), "_old", F.col("valid_from"), closing)
    opened = rows(both.filter(changed), "_new", today, F.lit(None))
    return history.filter("not is_current").unionByName(kept).unionByName(opened)


def as_first_seen(stacked: DataFrame, key: str, attribute: str) -> DataFrame:
    """Type 0: the first value stays for ever."""
    return stacked.groupBy(key).agg(F.min_by(attribute, "snapshot_date").alias(attribute))


def as_last_seen(stacked: DataFrame, key: str, attribute: str) -> DataFrame:
    """Type 1: the latest value overwrites."""
    return stacked.groupBy(key).agg(F.max_by(attribute, "snapshot_date").alias(attribute))


def with_previous(history: DataFrame, key: str, attribute: str) -> DataFrame:
    """Type 3: the current value and the one version before it."""
    past = F.when(~F.col("is_current"), F.col("valid_from"))
    return history.groupBy(key).agg(
        F.max_by(attribute, "valid_from").alias(f"current_{attribute}"),
        F.max_by(F.when(~F.col("is_current"), F.col(attribute)), past).alias(f"previous_{attribute}"),
    )


def split_current(history: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Type 4: a lean current table and a table of closed versions."""
    return (history.filter("is_current").drop("valid_to", "is_current"),
            history.filter("not is_current").drop("is_current"))
