"""Runs of consecutive rows with unchanged values."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions import inclusive_days
from tidewell.operators.keyed_order import SPLIT_FLOOR, KeyedOrder


def _numbered(rows: KeyedOrder, watched: Sequence[str]) -> KeyedOrder:
    """Flag rows that differ from the key's previous row and number the streaks.

    On a key's first row the previous values are NULL, so it counts as a change
    unless all watched values are NULL. Numbering, rather than grouping by value,
    keeps A, B, A as three streaks.
    """
    before = {f"__was_{c}": c for c in watched}
    changed = reduce(
        lambda a, b: a | b, [~F.col(was).eqNullSafe(F.col(c)) for was, c in before.items()]
    )
    return (
        rows.previous(**before)
        .with_columns({"is_change": changed.cast("int")})
        .running_sum("streak_id", "is_change")
    )


def numbered_streaks(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    watched: Sequence[str],
    floor: int = SPLIT_FLOOR,
) -> DataFrame:
    """``df`` with ``is_change`` and ``streak_id``; keys of any size, ``order`` unique in a key."""
    rows = _numbered(KeyedOrder.of(df, [key], order, floor), watched).rows()
    return rows.drop(*[f"__was_{c}" for c in watched])


def open_streaks(
    daily: DataFrame, key: str, label: str, day: str, watched: Sequence[str]
) -> DataFrame:
    """The latest streak of each key of a daily series, with its values, as it may go on.

    A key has at most one row per calendar day, so its rows fit one task. All the
    windows and the final grouping use the same partitioning by key: one shuffle. ``is_whole`` says
    that all rows of the key are this one streak.
    """
    rows = _numbered(KeyedOrder.bounded(daily, [key], [day]), watched).rows()
    latest = F.max("streak_id").over(Window.partitionBy(key))
    first = F.min("streak_id").over(Window.partitionBy(key))
    rows = rows.withColumn("__latest", latest).withColumn("__whole", first == latest)
    return rows.filter(F.col("streak_id") == F.col("__latest")).groupBy(key).agg(
        F.max(label).alias(label),
        F.min(day).alias("unchanged_since"),
        F.max(day).alias("last_snapshot_date"),
        F.count("*").alias("snapshots_unchanged"),
        *[F.first(c).alias(c) for c in watched],
        F.bool_and("__whole").alias("is_whole"),
    )


def late_keys(state: DataFrame, fresh: DataFrame, key: str, day: str) -> DataFrame:
    """Keys with a row that does not come after all days the state has of them."""
    first = fresh.groupBy(key).agg(F.min(day).alias("__first"))
    known = state.select(F.col(key), F.col("last_snapshot_date").alias("__last"))
    return first.join(known, key).filter(F.col("__first") <= F.col("__last")).select(key)


def advance_streaks(
    state: DataFrame,
    fresh: DataFrame,
    key: str,
    label: str,
    day: str,
    watched: Sequence[str],
    late: DataFrame | None = None,
) -> DataFrame:
    """``state``, open streaks, after new days of the series: rows ``fresh``, one per key and day.

    A key whose new rows all come after its last day goes on from its open streak, so no
    older day is read. ``late`` has the whole series of every other key that has new rows, the
    :func:`late_keys`; these are computed anew. Leave it out if there are none.
    """
    shape = [key, label, "unchanged_since", "last_snapshot_date", "snapshots_unchanged", *watched, "is_whole"]
    if late is not None:
        redone = late.select(key).distinct()
        state, fresh = (df.join(redone, key, "left_anti") for df in (state, fresh))
    old, new = (
        df.select(F.col(key).alias(f"__{name}_key"), F.struct(*shape).alias(name))
        for name, df in (("old", state), ("new", open_streaks(fresh, key, label, day, watched)))
    )
    both = old.join(new, F.col("__old_key") == F.col("__new_key"), "full_outer")
    same = reduce(lambda a, b: a & b, [F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in watched])
    joined = {
        label: F.greatest(f"old.{label}", f"new.{label}"),
        "unchanged_since": F.col("old.unchanged_since"),
        "snapshots_unchanged": F.col("old.snapshots_unchanged") + F.col("new.snapshots_unchanged"),
        "is_whole": F.col("old.is_whole"),
    }
    longer = F.struct(*[joined.get(c, F.col(f"new.{c}")).alias(c) for c in shape])
    other = F.struct(*[(F.lit(False) if c == "is_whole" else F.col(f"new.{c}")).alias(c) for c in shape])
    now = (
        F.when(F.col("new").isNull(), F.col("old"))
        .when(F.col("old").isNull(), F.col("new"))
        .when(F.col("new.is_whole") & same, longer)
        .otherwise(other)
    )
    out = both.select(F.inline(F.array(now)))
    if late is not None:
        out = out.unionByName(open_streaks(late, key, label, day, watched))
    return out


def unchanged_for(state: DataFrame, key: str, label: str) -> DataFrame:
    """How long each key's values have not changed; the newest day is that of any key."""
    since, last = F.col("unchanged_since"), F.col("last_snapshot_date")
    newest_day = state.agg(F.max(last)).scalar()
    return state.select(
        key,
        label,
        since,
        last,
        (last == newest_day).alias("is_in_latest_snapshot"),
        "snapshots_unchanged",
        inclusive_days(since, last).alias("days_unchanged"),
    )


def current_streaks(
    daily: DataFrame, key: str, label: str, day: str, watched: Sequence[str]
) -> DataFrame:
    """The latest streak of each key of a daily series (one row per key and day)."""
    return unchanged_for(open_streaks(daily, key, label, day, watched), key, label)
