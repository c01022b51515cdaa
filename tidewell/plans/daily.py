"""The daily marts kept up to date: a build costs what was loaded since the last one.

The state is a set of releases of its own: the daily series with a part for each day, each game's
open streak, and how much of the history both have seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators.streaks import advance_streaks, late_keys, open_streaks, unchanged_for
from tidewell.plans import marts, staging
from tidewell.sources import releases

DAILY, STREAKS, SEEN = "game_daily_stats", "open_streaks", "seen"
_EPOCH = "1970-01-01"
_WATCHED = ["concurrent_users", "total_reviews"]
_SERIES = ("appid", "game_name", "snapshot_date")


def _seen(history: DataFrame) -> DataFrame:
    return history.agg(F.max("loaded_at").alias("upto"), F.count("*").alias("versions"))


def update(spark: SparkSession, root: str, name: str, history: DataFrame) -> dict[str, DataFrame]:
    """``game_daily_stats`` and ``game_freshness`` after the versions that ``history`` gained.

    Days with new versions are computed anew, of the others nothing is read but the
    series of games whose new rows do not come after their last day. If the history changed
    otherwise, by versions without a stamp or from before the last build, all is computed anew.
    """
    names = releases.release_names(spark, root)
    before = releases.read_release(spark, root, names=names) if names else None
    draft = releases.Draft(spark, root, name, names[-1] if names else None)
    added = None
    if before is not None:
        upto, versions = before[SEEN].first()
        same = history.filter(F.col("loaded_at") <= F.lit(upto)).count() == versions if upto else False
        if same and history.filter("loaded_at is null").isEmpty():
            added = history.filter(F.col("loaded_at") > F.lit(upto))
    number = F.date_diff("snapshot_date", F.lit(_EPOCH).cast("date"))
    if added is None:
        daily = marts.game_daily_stats(staging.stg_games_history(history))
        daily = draft.write_parts(DAILY, daily, F.coalesce(number, F.lit(-1)), 0, whole=True)
        state = open_streaks(daily.select(*_SERIES, *_WATCHED), *_SERIES, _WATCHED)
    else:
        days = sorted(r[0] for r in added.select(F.to_date("loaded_at")).distinct().collect())  # days since the last build
        if not days:
            return _marts(before[DAILY], before[STREAKS])
        touched = history.filter(F.to_date("loaded_at").isin(days) & (F.col("loaded_at") >= F.lit(days[0])))
        fresh = marts.game_daily_stats(staging.stg_games_history(touched))
        fresh = draft.write_parts(DAILY, fresh, number, 0, whole=False).select(*_SERIES, *_WATCHED)
        late, series = late_keys(before[STREAKS], fresh, "appid", "snapshot_date"), None
        if not late.isEmpty():
            past = before[DAILY].filter(~F.col("snapshot_date").isin(days)).select(*_SERIES, *_WATCHED)
            series = past.join(late, "appid", "left_semi").unionByName(fresh.join(late, "appid", "left_semi"))
        state = advance_streaks(before[STREAKS], fresh, *_SERIES, _WATCHED, series)
    draft.write(STREAKS, state)
    draft.write(SEEN, _seen(history))
    draft.publish()
    now = releases.read_release(spark, root)
    return _marts(now[DAILY], now[STREAKS])


def _marts(daily: DataFrame, state: DataFrame) -> dict[str, DataFrame]:
    return {DAILY: daily, "game_freshness": unchanged_for(state, "appid", "game_name")}
