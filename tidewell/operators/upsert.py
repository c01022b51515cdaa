"""Insert-or-overwrite by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators.ranking import last_per_group


def upsert(
    base: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    seq: Sequence[str] = (),
    load_ts: Column | None = None,
    stamp: str = "loaded_at",
) -> DataFrame:
    """``base`` after ``batch`` was loaded: batch rows replace or add, nothing is deleted.

    ``seq`` orders duplicate keys inside the batch, the last one wins. Without it a key that the
    batch repeats fails the job. ``load_ts`` is one stamp for all rows of the batch.

    Kept base rows come from an anti join on the batch's keys. A batch that is
    small by Spark's own measure is broadcast and then the base is not shuffled at
    all; otherwise each side is shuffled once by key.
    """
    batch = one_per_key(batch, keys, seq)
    if load_ts is not None:
        batch = batch.withColumn(stamp, load_ts)
    return replace_keys(base, batch, keys)


def one_per_key(batch: DataFrame, keys: Sequence[str], seq: Sequence[str] = ()) -> DataFrame:
    """The last row of each key by ``seq``; without it a repeated key fails the job."""
    return last_per_group(batch, keys, seq) if seq else _once(batch, keys)


def replace_keys(base: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``base`` with the rows of ``batch``, one per key, in place of its own."""
    batch = batch.select(*base.columns)
    kept = base.join(batch.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(batch)


def _once(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``batch``, or a failure when it runs if a key is repeated."""
    repeated = batch.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
    key = F.concat_ws(", ", *(F.col(k).cast("string") for k in keys))
    failure = F.raise_error(F.concat(F.lit("key repeated in a batch: "), F.min(key))).cast("boolean")
    checked = repeated.agg(F.when(F.count("*") > 0, failure).otherwise(F.lit(True)))
    return batch.filter(checked.scalar())
