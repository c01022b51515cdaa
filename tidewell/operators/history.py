"""Versioned history of a keyed table (slowly changing dimension, type 2).

A version has ``valid_from``, ``valid_to`` (NULL while open) and ``scd_id``. Keys that
vanish from the source keep their open version.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators.keyed_order import SPLIT_FLOOR, KeyedOrder
from tidewell.operators.ranking import last_per_group

STRATEGIES = ("timestamp", "check")


def _scd_id(keys: Sequence[str], valid_from: Column) -> Column:
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws("|", *parts, valid_from.cast("timestamp_ntz").cast("string")))


def _differs(pairs: Sequence[tuple[Column, Column]]) -> Column:
    return reduce(lambda a, b: a | b, [~a.eqNullSafe(b) for a, b in pairs])


def versions_from_log(
    log: DataFrame,
    keys: Sequence[str],
    stamp: str,
    check: Sequence[str] = (),
    tie: str | None = None,
    floor: int = SPLIT_FLOOR,
) -> DataFrame:
    """History from a log with one row per key and load.

    Without ``check`` each new ``stamp`` is a version. With ``check`` a row is a version
    only if one of those columns differs from the key's previous row. ``tie`` orders
    rows of the same key and stamp, of which the last one counts; leave it out if
    there are none, which saves a shuffle.
    """
    single = log if tie is None else last_per_group(log, [*keys, stamp], [tie])
    rows = KeyedOrder.of(single, keys, [stamp], floor, sized_by=log)
    if check:
        was = {f"__was_{c}": c for c in check}
        # an all-NULL first row is still a version, so look at the stamp as well
        rows = rows.previous(__was_stamp=stamp, **was)
        changed = _differs([(F.col(w), F.col(c)) for w, c in was.items()])
        rows = rows.filter(F.col("__was_stamp").isNull() | changed)
    out = rows.with_columns({"valid_from": F.col(stamp)}).following(valid_to=stamp).rows()
    out = out.drop("__was_stamp", *[f"__was_{c}" for c in check])
    return out.withColumn("scd_id", _scd_id(keys, F.col("valid_from")))


def apply_snapshot(
    history: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    *,
    updated_at: str | None = None,
    check: Sequence[str] = (),
    taken_at: Column | None = None,
) -> DataFrame:
    """``history`` after one more snapshot of ``source`` (one row per key).

    Give ``updated_at`` for the timestamp strategy: a new version when the stamp has
    moved past the open version's ``valid_from``. Give ``check`` and ``taken_at`` for
    the check strategy: a new version when a checked column differs, stamped with the
    time of the snapshot. Unchanged data adds nothing.

    Closed versions pass through untouched; only open ones meet the source.
    """
    if history is None:
        return _first_versions(source, keys, updated_at, check, taken_at)
    closed = history.filter(F.col("valid_to").isNotNull())
    still_open = history.filter(F.col("valid_to").isNull())
    touched = snapshot_step(
        still_open, source, keys, updated_at=updated_at, check=check, taken_at=taken_at
    )
    return closed.select(*touched.columns).unionByName(touched)


def _first_versions(
    source: DataFrame,
    keys: Sequence[str],
    updated_at: str | None,
    check: Sequence[str],
    taken_at: Column | None,
) -> DataFrame:
    if (updated_at is None) == (not check):
        raise ValueError("give either updated_at or check columns")
    if check and taken_at is None:
        raise ValueError("the check strategy needs taken_at")
    stamp = F.col(updated_at) if updated_at else taken_at
    return (
        source.withColumn("valid_from", stamp.cast("timestamp_ntz"))
        .withColumn("valid_to", F.lit(None).cast("timestamp_ntz"))
        .withColumn("scd_id", _scd_id(keys, F.col("valid_from")))
    )


def snapshot_step(
    still_open: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    updated_at: str | None = None,
    check: Sequence[str] = (),
    taken_at: Column | None = None,
) -> DataFrame:
    """Open versions after a snapshot, and the ones it closed.

    Rows with ``valid_to`` are closed for good: a store can append them and rewrite only
    the rest, so its work does not grow with the age of the history. Both sides hold
    a key at most once, so the one outer join on the key has no hot spots.
    """
    fresh = _first_versions(source, keys, updated_at, check, taken_at)
    columns = fresh.columns

    def packed(df: DataFrame, name: str) -> DataFrame:
        named = [F.col(k).alias(f"__{name}_{k}") for k in keys]
        return df.select(*named, F.struct(*columns).alias(name))

    old, new = packed(still_open, "old"), packed(fresh, "new")
    on_key = reduce(lambda a, b: a & b, [F.col(f"__old_{k}") == F.col(f"__new_{k}") for k in keys])
    both = old.join(new, on_key, "full_outer")

    if updated_at:
        moved = F.col("new.valid_from") > F.col("old.valid_from")
    else:
        moved = _differs([(F.col(f"old.{c}"), F.col(f"new.{c}")) for c in check])
    ended = F.struct(
        *[
            (F.col("new.valid_from") if c == "valid_to" else F.col(f"old.{c}")).alias(c)
            for c in columns
        ]
    )
    versions = (
        F.when(F.col("old").isNull(), F.array(F.col("new")))
        .when(F.col("new").isNull() | ~F.coalesce(moved, F.lit(False)), F.array(F.col("old")))
        .otherwise(F.array(ended, F.col("new")))
    )
    return both.select(F.inline(versions))


def is_latest(valid_to: str = "valid_to") -> Column:
    return F.col(valid_to).isNull()
