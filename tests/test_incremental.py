"""Streaks and daily marts that are kept up to date equal those computed from all days."""

import random
from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidewell.operators.streaks import advance_streaks, current_streaks, late_keys, open_streaks, unchanged_for
from tidewell.plans import daily, marts, staging
from tidewell.sources import releases

AT, WATCHED = ("k", "label", "day"), ["a", "b"]
D0 = date(2026, 10, 1)


@pytest.mark.parametrize("seed", range(3))
def test_state_equals_the_whole_series(spark, seed):
    rng = random.Random(seed)
    every = {}
    for k in range(40):
        for n in range(24):
            if rng.random() < 0.7:  # gaps
                every[k, n] = (f"n{k}", rng.choice([None, 1, 1, 1, 2]), rng.choice([None, 5, 5, 5]))
    late = {x for x in every if rng.random() < 0.06}
    parts = [[x for x in every if x not in late and lo <= x[1] < lo + step] for lo, step in ((0, 6), (6, 1), (7, 1), (8, 9), (17, 7))]
    parts.insert(3, sorted(x for x in late if x[1] < 8))
    parts.append(sorted(x for x in late if x[1] >= 8))

    def frame(keys):
        data = [(k, every[k, n][0], D0 + timedelta(days=n), *every[k, n][1:]) for k, n in keys]
        return spark.createDataFrame(data, "k int, label string, day date, a int, b int")

    state, seen = None, []
    for part in parts:
        seen += part
        fresh = frame(part)
        if state is None:
            state = open_streaks(fresh, *AT, WATCHED)
        else:
            again = late_keys(state, fresh, "k", "day")
            series = None if again.isEmpty() else frame(seen).join(again, "k", "left_semi")
            state = advance_streaks(state, fresh, *AT, WATCHED, series)
        state = spark.createDataFrame(state.collect(), state.schema)  # as if it were stored
        assert rows(unchanged_for(state, "k", "label")) == rows(current_streaks(frame(seen), *AT, WATCHED))


def history(spark, loads):
    """Versions of games 1 to 5, one per load; numbers change now and then."""
    data = []
    for at, shift in loads:
        for k in range(1, 6):
            if (k + shift) % 4:
                n = (k * shift // 3) % 3
                data.append((k, f"g{k}", "d", "p", n, n, "0 .. 20,000", 0, 0, 0, 0, 100, 100, 0, n, at))
    columns = (
        "appid int, name string, developer string, publisher string, positive_reviews int, negative_reviews int, owners string, "
        "average_playtime_forever int, average_playtime_2weeks int, median_playtime_forever int, median_playtime_2weeks int, "
        "price_cents int, initial_price_cents int, discount_pct int, concurrent_users int, loaded_at timestamp_ntz"
    )
    out = spark.createDataFrame(data, columns)
    stamps = {"valid_from": F.col("loaded_at"), "valid_to": F.lit(None).cast("timestamp_ntz"), "scd_id": F.lit("x")}
    return out.withColumns(stamps)


def test_builds_after_each_load_equal_a_whole_build(spark, tmp_path):
    root, t0 = str(tmp_path / "state"), datetime(2026, 10, 1, 9)
    loads, written = [], []
    # two loads on one day, a gap, nothing new, and at last a load from before the others
    steps = [[0, 24], [25], [72, 96], [], [97, 120], [12]]
    for n, hours in enumerate(steps):
        loads += [(t0 + timedelta(hours=h), h) for h in hours]
        now = history(spark, loads)
        got = daily.update(spark, root, f"s{n}", now)
        want = marts.game_daily_stats(staging.stg_games_history(now))
        assert rows(got["game_daily_stats"].select(want.columns)) == rows(want)
        assert rows(got["game_freshness"]) == rows(marts.game_freshness(want))
        own = releases._manifest(spark, root).filter((F.col("release") == f"s{n}") & (F.col("table") == "game_daily_stats"))
        written.append(own.count())
    assert written == [2, 1, 2, 0, 2, 5]  # days: only those with new versions, all of them for the last step
