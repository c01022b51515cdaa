"""Membership of a row's key in another table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.operators.keyed_order import SPLIT_FLOOR, heavy_keys, join_same


def membership_flag(
    df: DataFrame,
    members: DataFrame,
    keys: Sequence[str],
    name: str,
    unique: bool = True,
    floor: int = SPLIT_FLOOR,
) -> DataFrame:
    """Flag the rows of ``df`` whose key occurs in ``members``; no row is duplicated.

    The key list is deduplicated before the join and Spark picks the join from its
    measured size. Say ``unique=False`` if keys repeat in ``df``: keys that
    repeat beyond one task's share are then looked up by a broadcast join (at most
    one key per shuffle partition can be that frequent) and only the rest shuffles.
    """
    wanted = members.select(*keys).distinct().withColumn("__hit", F.lit(True))

    def flagged(rows: DataFrame, hits: DataFrame) -> DataFrame:
        joined = rows.join(hits, list(keys), "left")
        return joined.select(*df.columns, F.col("__hit").isNotNull().alias(name))

    hot = None if unique else heavy_keys(df, keys, floor)
    if hot is None:
        return flagged(df, wanted)
    hot = F.broadcast(hot)
    light = flagged(join_same(df, hot, keys, "left_anti"), wanted)
    heavy = flagged(
        join_same(df, hot, keys, "left_semi"),
        F.broadcast(join_same(wanted, hot, keys, "left_semi")),
    )
    return light.unionByName(heavy)
