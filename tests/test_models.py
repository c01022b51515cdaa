"""Models, cards and checks on five made-up games and on hand-made rows."""

from datetime import date, datetime, timedelta
from decimal import Decimal
from itertools import product, takewhile

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_landed import SAMPLE_PAGE, documents

from tidewell.operators import quality
from tidewell.operators.history import apply_snapshot
from tidewell.plans import checks, marts, staging
from tidewell.plans.cards import CARDS
from tidewell.plans.models import MODELS, build, materialize
from tidewell.schemas import RAW_TABLES
from tidewell.sources.landed import game_rows

T0 = datetime(2026, 10, 1, 9)


def stamp(when=T0):
    return F.lit(str(when)).cast("timestamp_ntz")


def d(text):
    return Decimal(text)


@pytest.fixture(scope="module")
def raw(spark):
    games = game_rows(documents(spark, SAMPLE_PAGE)).drop("seq").withColumn("loaded_at", stamp())
    runs = spark.createDataFrame(
        [(1, T0 - timedelta(hours=1), T0, 0, 5, 5)], RAW_TABLES["catalog_runs"].schema()
    )
    friends = spark.createDataFrame(
        [(f"{i}", f"p{i}", f"u{i}", state, T0, i == 1) for i, state in [(1, 0), (2, 1), (3, 3)]],
        RAW_TABLES["friends"].schema(),
    )
    owned = spark.createDataFrame(
        [("1", 11, "Harbor Lights", 6402, 1767225600, T0), ("1", 77, "Salt Road", 0, 0, T0)],
        RAW_TABLES["player_owned_games"].schema(),
    )
    return {
        "games": games,
        "games_catalog": games,
        "catalog_runs": runs,
        "friends": friends,
        "player_owned_games": owned,
        "games_snapshot": apply_snapshot(None, games, ["appid"], updated_at="loaded_at"),
        "player_games_snapshot": apply_snapshot(
            None, owned, ["steamid", "appid"], check=["playtime_forever"], taken_at=stamp()
        ),
    }


@pytest.fixture(scope="module")
def models(spark, raw, tmp_path_factory):
    return materialize(spark, raw, str(tmp_path_factory.mktemp("marts")))


def test_game_rankings(models):
    got = models["game_rankings"].select(
        "appid", "owners_min", "owners_max", "owners_estimate", "total_reviews",
        "positive_review_ratio", "price_usd", "initial_price_usd", "discount_pct", "price_tier",
        "ccu_rank", "review_score_rank",
    )
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == {
        11: (200000, 500000, 350000, 1000, d("0.9000"), d("0.00"), d("0.00"), 0, "free", 1, 1),
        22: (20000, 50000, 35000, 40, d("0.7500"), d("7.99"), d("15.99"), 50, "under $10", 4, 3),
        33: (200000, 500000, 350000, 500, d("0.9000"), d("35.00"), d("35.00"), 0, "$30 and up", 2, 1),
        44: (0, 20000, 10000, 4, d("0.2500"), d("10.00"), d("12.50"), 20, "$10 to $30", 5, 5),
        55: (0, 20000, 10000, 3, d("0.6667"), d("2.50"), d("10.00"), 75, "under $10", 2, 4),
    }


def test_owners_distribution(models):
    assert rows(models["catalog_owners_distribution"]) == [
        ("0 .. 20,000", 0, 20000, 2, 2, 20000, 20000, d("0.4000"), d("0.0265")),
        ("20,000 .. 50,000", 20000, 50000, 1, 1, 35000, 35000, d("0.2000"), d("0.0464")),
        ("200,000 .. 500,000", 200000, 500000, 2, 2, 700000, 700000, d("0.4000"), d("0.9272")),
    ]


def test_publishers_and_coverage(models):
    publishers = models["publisher_summary"].select("publisher", "game_count", "free_game_count", "ccu_rank")
    assert rows(publishers) == sorted(
        [
            ("Tern House", 2, 1, 1),
            ("Quay Works", 1, 0, 2),
            ("Fen Studio", 1, 0, 3),
            ("Ola North", 1, 0, 4),
        ]
    )
    coverage = models["catalog_coverage"].first()
    assert (coverage.coverage, coverage.duplicate_rows, coverage.games_missed_estimate) == (1, 0, 0)
    assert (coverage.pages_loaded, coverage.run_hours) == (1, 1)


def card(models, name):
    run, inputs = CARDS[name]
    return [tuple(r) for r in run(*[models[i] for i in inputs]).collect()]


def test_cards(models):
    assert card(models, "players_online") == [(6520,)]
    assert card(models, "free_share") == [(d("20.0"),)]
    assert card(models, "discounted") == [(3,)]
    assert card(models, "review_by_tier") == [
        ("free", d("90.0")),
        ("under $10", d("70.8")),
        ("$10 to $30", d("25.0")),
        ("$30 and up", d("90.0")),
    ]
    assert sorted(card(models, "games_by_tier")) == [
        ("$10 to $30", 1), ("$30 and up", 1), ("free", 1), ("under $10", 2)
    ]
    assert [r[0] for r in card(models, "top10_games")][:1] == ["Harbor Lights"]
    assert [r[0] for r in card(models, "best_reviewed")] == [1, 1, 3, 4, 5]
    assert card(models, "top_share") == [(d("100.0"),)]
    assert [r[1:] for r in card(models, "share_by_bucket")] == [
        (d("40.0"), d("2.7")), (d("20.0"), d("4.6")), (d("40.0"), d("92.7"))
    ]
    assert len(card(models, "ccu_trend")) == 5
    assert len(card(models, "top10_publishers")) == 4


def test_shares_of_an_empty_mart_are_null(models):
    empty = {"game_rankings": models["game_rankings"].limit(0)}
    assert card(empty, "free_share") == [(None,)]


def test_staged_friends_and_playtime(models):
    friends = models["stg_friends"].select("persona_state", "is_current_friend")
    assert rows(friends) == [("away", True), ("offline", True), ("online", True)]
    playtime = models["stg_playtime_history"].select("appid", "playtime_forever_minutes", "is_latest_version")
    assert rows(playtime) == [(11, 6402, True), (77, 0, True)]


def test_dropped_games_lose_their_flag(raw):
    older = raw["games"].withColumn("appid", F.col("appid") + 1).withColumn(
        "loaded_at", stamp() - F.make_dt_interval(F.lit(1))
    )
    staged = staging.stg_games(raw["games"].unionByName(older))
    assert staged.filter("is_in_latest_top100").count() == 5
    assert marts.game_rankings(staged).count() == 5


def test_catalog_without_a_finished_run_has_no_current_rows(raw):
    open_runs = raw["catalog_runs"].withColumn("finished_at", F.lit(None).cast("timestamp_ntz"))
    staged = staging.stg_catalog(raw["games_catalog"], open_runs)
    assert rows(staged.select("is_in_latest_catalog").distinct()) == [(False,)]
    assert marts.catalog_coverage(staging.stg_runs(open_runs), staged).count() == 0


def test_build_makes_only_what_is_needed(raw):
    assert set(build({"games": raw["games"]}, "game_rankings")) == {"stg_games", "game_rankings"}
    assert set(build(raw)) == set(MODELS)


def test_marts_are_stored_and_staging_is_a_view(spark, models, raw):
    assert spark.sql("select count(*) from game_rankings").first()[0] == 5
    plan = models["game_rankings"]._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "Window" not in plan


# ---------------------------------------------------------------- streaks

DAILY = "appid int, game_name string, snapshot_date date, concurrent_users int, total_reviews int"


def test_streaks_of_all_short_series(spark):
    """Every series of four days, each of them missing or with one of three pairs of numbers."""
    days = [date(2026, 3, n) for n in range(1, 5)]
    every = [s for s in product([None, (7, 3), (8, 3), (7, 4)], repeat=4) if any(s)]
    daily, want = [], []
    for i, series in enumerate(every):
        seen = [(day, pair) for day, pair in zip(days, series, strict=True) if pair]
        daily += [(i, "g", day, *pair) for day, pair in seen]
        last, numbers = seen[-1]
        same = list(takewhile(lambda s, n=numbers: s[1] == n, reversed(seen)))
        since = same[-1][0]
        want.append((i, since, last, last == days[-1], len(same), (last - since).days + 1))
    got = marts.game_freshness(spark.createDataFrame(daily, DAILY)).drop("game_name")
    assert rows(got) == sorted(want, key=repr)


def test_streaks_of_unknown_numbers(spark):
    day = lambda n: date(2026, 10, n)
    daily = [(1, "a", day(1), None, None), (1, "a", day(2), None, None), (2, "b", day(1), None, 3)]
    got = marts.game_freshness(spark.createDataFrame(daily, DAILY))
    assert rows(got.select("appid", "snapshots_unchanged")) == [(1, 2), (2, 1)]


# ---------------------------------------------------------------- checks


def results(models, **thresholds):
    df = checks.check_results(models, checks.table_checks(min_catalog_games=5, **thresholds))
    return {r.unique_id.split(".", 2)[2]: (r.status, r.failures) for r in df.collect()}


def test_all_checks_pass_on_the_sample(models):
    got = results(models)
    assert len(got) == 39 + 9
    assert set(got.values()) == {("pass", 0)}
    checks.raise_on_errors(checks.check_results(models, checks.table_checks(min_catalog_games=5)))


def test_broken_models_fail_and_warn(spark, models):
    broken = dict(models)
    twice = models["game_rankings"].unionByName(models["game_rankings"])
    broken["game_rankings"] = twice.withColumn("price_tier", F.lit("cheap"))
    broken["stg_friends"] = models["stg_friends"].withColumn("is_current_friend", F.lit(None).cast("boolean"))
    broken["catalog_coverage"] = models["catalog_coverage"].withColumn("coverage", F.lit(0.5))
    got = results(broken, max_ranked=9)
    assert {k: v for k, v in got.items() if v[0] != "pass"} == {
        "unique_game_rankings_appid": ("fail", 5),
        "accepted_values_game_rankings_price_tier": ("fail", 1),
        "not_null_stg_friends_is_current_friend": ("fail", 3),
        "assert_rankings_at_most_100_games": ("fail", 1),
        "assert_catalog_coverage": ("warn", 1),
    }
    with pytest.raises(checks.ChecksFailed, match="unique_game_rankings_appid: 5 rows"):
        checks.raise_on_errors(checks.check_results(broken))


def test_truncated_catalog_is_found_without_a_list_size(spark, models):
    runs = models["stg_runs"].withColumn("list_size", F.lit(None).cast("int"))
    assert quality.truncated_run(runs, 6).count() == 1
    assert quality.truncated_run(runs, 5).count() == 0


def test_shares_check_passes_on_an_empty_mart(models):
    empty = models["catalog_owners_distribution"].limit(0)
    shares = {"games": "share_of_games", "owners": "share_of_owners"}
    assert quality.shares_off_one(empty, shares).count() == 0


def test_stale_share_has_a_strict_limit(spark):
    df = spark.createDataFrame([(1, True, 9), (2, True, 1), (3, False, 9)], "appid int, is_in_latest_snapshot boolean, days_unchanged int")
    assert quality.stale_share(df, 3, 0.5).count() == 0
    assert rows(quality.stale_share(df, 3, 0.4)) == [(1, 2)]


# ---------------------------------------------------------------- freshness and report


def test_freshness_limits(raw):
    late = checks.freshness_results(raw, stamp(T0 + timedelta(days=9)))
    got = {r.unique_id: r.status for r in late.collect()}
    assert got == {
        "source.catalogue.raw.games": "error",
        "source.catalogue.raw.friends": "error",
        "source.catalogue.raw.player_owned_games": "error",
        "source.catalogue.raw.games_catalog": "warn",
        "source.catalogue.raw.catalog_runs": "warn",
    }


def test_report_has_only_warnings(spark):
    """The number of rows goes before the message, a blank message counts as none."""
    states, counts, messages = ["pass", "warn", "fail"], [None, 0, 4], [None, "", "see log"]
    every = [
        (f"test.t.c{i}.x{i}", *case) for i, case in enumerate(product(states, counts, messages))
    ]
    hours = [1.2, 2.5, 3.5, 50.0]
    ages = [(f"source.t.raw.s{i}", "warn", h * 3600) for i, h in enumerate(hours)]
    ages.append(("source.t.raw.fresh", "pass", 60.0))
    want = [
        f"test {name.split('.')[2]}: " + (f"{n} rows" if n is not None else message or "warning")
        for name, state, n, message in every
        if state == "warn"
    ] + [f"source raw.s{i}: last loaded {round(h)} hours ago" for i, h in enumerate(hours)]
    got = quality.warning_report(
        spark.createDataFrame(every, quality.RESULT_SCHEMA),
        spark.createDataFrame(ages, quality.FRESHNESS_SCHEMA),
    )
    assert rows(got) == sorted([(w,) for w in want], key=repr)


def test_report_without_result_files(spark, tmp_path):
    missing = quality.read_optional(spark, f"{tmp_path}/none", quality.RESULT_SCHEMA)
    ages = spark.createDataFrame([("source.a.raw.games", "warn", 3600.0)], quality.FRESHNESS_SCHEMA)
    ages.write.parquet(f"{tmp_path}/ages")
    found = quality.read_optional(spark, f"{tmp_path}/ages", quality.FRESHNESS_SCHEMA)
    assert rows(quality.warning_report(missing, found)) == [("source raw.games: last loaded 1 hours ago",)]
