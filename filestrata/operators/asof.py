"""As-of join: each row with the last known state of its key at or before its time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import materialize


def _states(right: DataFrame, key: str, time: str, columns: Sequence[str]) -> DataFrame:
    """One state per key and time: of several rows the greatest, column by column.
    Each task first reduces its own rows."""
    return right.where(F.col(key).isNotNull() & F.col(time).isNotNull()).groupBy(
        F.col(key).alias("_key"), F.col(time).alias("_time")).agg(
        F.max(F.struct(*columns)).alias("_state"))


def last_states(points: DataFrame) -> DataFrame:
    """``_key``, ``_time``, ``_wanted``, ``_state`` with nulls filled by the last state
    of the key at or before the time.

    Points are cut into slices of the order by key and time, so a key with very many
    times fills several tasks. Inside a slice the last state is a window's; what a
    slice takes over from those before it comes from one row per key and slice.
    """
    order = ("_key", "_time", "_wanted")
    sliced = materialize(
        points.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()), "asof-points")
    ends = sliced.where("_state is not null").groupBy("_key", "_slice").agg(
        F.max_by("_state", "_time").alias("_end"))
    # A slice without a state passes on what it took over, so gaps need no rows.
    before = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = sliced.select("_key", "_slice").distinct().join(ends, ["_key", "_slice"], "left")
    taken = slices.select("_key", "_slice", F.last("_end", ignorenulls=True).over(before).alias("_taken"))
    within = Window.partitionBy("_slice", "_key").orderBy("_time", "_wanted").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    filled = sliced.withColumn("_state", F.last("_state", ignorenulls=True).over(within))
    return filled.join(taken, ["_key", "_slice"], "left").select(
        "_key", "_time", "_wanted", F.coalesce("_state", "_taken").alias("_state"))


def asof_join(
    left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str,
    columns: Sequence[str], prefix: str,
) -> DataFrame:
    """Every row of ``left`` with ``columns`` of the last ``right`` row that has its
    ``key`` and a time at or before its own, named with ``prefix``; the right time is
    ``<prefix><right_time>``. Rows without such a state keep nulls, as do null keys
    and times. Of right rows with one key and time the greatest counts, column
    by column, so the result depends on no order of rows.

    Left rows are not sorted by time: their distinct keys and times are, together with
    the states, by one union. The rows then meet their answer by an equi-join
    whose other side is unique, so a key that holds most rows can be split.
    """
    wanted = dict.fromkeys([*columns, right_time])
    states = _states(right, key, right_time, [*wanted])
    empty = F.lit(None).cast(states.schema["_state"].dataType)
    moments = left.where(F.col(key).isNotNull() & F.col(left_time).isNotNull()).select(
        F.col(key).alias("_key"), F.col(left_time).alias("_time")).distinct()
    points = states.select("_key", "_time", F.lit(False).alias("_wanted"), "_state").unionByName(
        moments.select("_key", "_time", F.lit(True).alias("_wanted"), empty.alias("_state")))
    found = last_states(points).where("_wanted and _state is not null").select(
        "_key", "_time", "_state")
    return left.join(
        found, (left[key] == found["_key"]) & (left[left_time] == found["_time"]), "left",
    ).select(*[left[c] for c in left.columns],
             *[F.col("_state")[c].alias(f"{prefix}{c}") for c in wanted])
