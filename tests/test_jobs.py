"""The jobs from landed files to marts, checks, report, export and restore."""

import json
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_landed import GAMES, SAMPLE_PAGE, game, libraries, page, players

from tidewell import __main__ as jobs
from tidewell.plans import checks, loads
from tidewell.sources import releases

DAY1 = datetime(2026, 10, 1, 9)


def day(n):
    return DAY1 + timedelta(days=n - 1)


@pytest.fixture(scope="module")
def place(spark, tmp_path_factory):
    """Two daily loads and a catalogue run of two pages."""
    place = tmp_path_factory.mktemp("jobs")
    root, landing = str(place / "root"), place / "landing" / "run-1"
    landing.mkdir(parents=True)

    (place / "games1.json").write_text(SAMPLE_PAGE)
    (place / "profiles.json").write_text(players("1", "2", "3"))
    lines = [
        json.dumps({"steamid": r.steamid, "owned": json.loads(r.owned), "recent": json.loads(r.recent)})
        for r in libraries(spark).collect()
    ]
    (place / "libraries.jsonl").write_text("\n".join(lines))
    jobs.daily(
        spark, root, day(1), str(place / "games1.json"), str(place / "profiles.json"),
        str(place / "libraries.jsonl"), "1",
    )

    # the second day: one game left the list, one has new numbers, playtime went up
    games = [game(g) for g in GAMES[:4]]
    games[0]["ccu"] = 99
    (place / "games2.json").write_text(page(*games))
    (place / "libraries2.jsonl").write_text("\n".join(lines).replace("6402", "6500"))
    jobs.daily(
        spark, root, day(2), str(place / "games2.json"), None, str(place / "libraries2.jsonl")
    )

    assert jobs.start_run(spark, root, day(2) + timedelta(hours=1)) == (1, 0, False)
    (landing / "page-00000.json").write_text(page(*[game(g) for g in GAMES[:3]]))
    jobs.catalog(spark, root, day(2) + timedelta(hours=2), str(landing.parent), page_size=3)
    # the attempt ended after a full page, so the run is still open
    assert jobs.start_run(spark, root, day(2) + timedelta(hours=3)) == (1, 1, True)
    (landing / "page-00001.json").write_text(page(*[game(g) for g in GAMES[2:4]]))
    jobs.catalog(spark, root, datetime(2100, 1, 1), str(landing.parent), page_size=3)
    return place


@pytest.fixture(scope="module")
def tables(spark, place):
    return loads.with_histories(loads.current_tables(spark, str(place / "root" / "tables")))


def test_raw_tables_after_two_days(tables):
    stamps = {r.appid: (r.concurrent_users, r.loaded_at) for r in tables["games"].collect()}
    assert stamps[11] == (99, day(2))
    assert stamps[55] == (700, day(1))
    assert rows(tables["friends"].select("steamid", "is_self")) == [
        ("1", True), ("2", False), ("3", False)
    ]
    assert rows(tables["player_library_status"].select("steamid", "owned_visible", "loaded_at")) == [
        ("1", True, day(2)), ("2", False, day(2)), ("3", True, day(2))
    ]


def test_history_of_both_strategies(tables):
    games = tables["games_snapshot"].filter("appid in (11, 55)")
    assert rows(games.select("appid", "concurrent_users", "valid_from", "valid_to")) == sorted(
        [
            (11, 5000, day(1), day(2)),
            (11, 99, day(2), None),
            (55, 700, day(1), None),
        ],
        key=repr,
    )
    played = tables["player_games_snapshot"]
    assert rows(played.select("appid", "playtime_forever", "valid_to")) == sorted(
        [(77, 0, None), (11, 6402, day(2)), (11, 6500, None)], key=repr
    )


def test_catalogue_run_was_resumed_and_finished(tables):
    [run] = tables["catalog_runs"].collect()
    assert (run.last_page, run.games_loaded, run.list_size) == (1, 5, 5)
    assert run.finished_at == datetime(2100, 1, 1)
    # one game was on both pages
    assert tables["games_catalog"].count() == 4


def test_build_report_export_and_restore(spark, place):
    root, now = str(place / "root"), datetime(2100, 1, 2)
    with pytest.raises(checks.ChecksFailed, match="assert_catalog_not_truncated: 1 rows"):
        jobs.build(spark, root, now)
    jobs.build(spark, root, now, min_catalog_games=5)
    assert spark.table("game_rankings").count() == 4
    assert spark.table("game_daily_stats").count() == 9
    # sources are 73 years old, which is an error and not a warning; coverage is 4 of 5
    assert rows(jobs.report(spark, root, now)) == [("test assert_catalog_coverage: 1 rows",)]
    assert jobs.report(spark, root, datetime(2100, 1, 3)).count() == 0

    target = str(place / "export")
    name = jobs.export(spark, root, target)
    before = releases.read_release(spark, target, name)
    fresh = str(place / "fresh")
    jobs.restore(spark, fresh, datetime(2100, 1, 4), target)
    after = loads.current_tables(spark, f"{fresh}/tables")
    assert {n: rows(t) for n, t in before.items()} == {n: rows(after[n]) for n in before}


def test_load_of_one_table_writes_no_other(spark, place):
    names = releases.release_names(spark, str(place / "root" / "tables"))
    # each day's games are a release of their own, before that day's players
    written = {p.name for p in (place / "root" / "tables" / "data" / names[2]).iterdir()}
    assert written == {"games", "games_snapshot_open", "games_snapshot_closed"}


def test_repeating_a_load_adds_no_version(spark, place, tables):
    root = str(place / "root")
    before = rows(tables["player_games_snapshot"]), tables["games_snapshot"].count()
    later = datetime(2100, 2, 1)
    jobs.daily(spark, root, later, libraries=str(place / "libraries2.jsonl"))
    now = loads.with_histories(loads.current_tables(spark, f"{root}/tables"))
    assert rows(now["player_games_snapshot"].drop("loaded_at")) == rows(
        tables["player_games_snapshot"].drop("loaded_at")
    )
    assert (len(before[0]), before[1]) == (3, now["games_snapshot"].count())


def test_load_that_another_one_came_between_is_done_anew(spark, tmp_path):
    root, read = str(tmp_path), []

    def friends(*ids):
        return lambda tables: loads.load_profiles(
            tables, spark.createDataFrame([(players(*ids), "f")], "value string, file string"), None, stamp
        )

    stamp = F.lit("2026-10-01 09:00:00").cast("timestamp_ntz")

    def slow(tables):
        read.append(tables["friends"].count())
        if len(read) == 1:
            loads.load_and_publish(spark, root, "n2", friends("1", "2"), stamp)
        return friends("3")(tables)

    loads.load_and_publish(spark, root, "n1", slow, stamp)
    assert read == [0, 2]
    assert releases.release_names(spark, root) == ["n2", "n2+"]
    assert rows(loads.current_tables(spark, root)["friends"].select("steamid")) == [("1",), ("2",), ("3",)]


def test_games_are_published_although_profiles_fail(spark, tmp_path):
    (tmp_path / "games.json").write_text(SAMPLE_PAGE)
    (tmp_path / "profiles.json").write_text(players("1").replace('"1"', "null"))
    root = str(tmp_path / "root")
    with pytest.raises(Exception, match="steamid"):
        jobs.daily(spark, root, DAY1, str(tmp_path / "games.json"), str(tmp_path / "profiles.json"))
    now = loads.current_tables(spark, f"{root}/tables")
    assert (now["games"].count(), now["friends"].count()) == (5, 0)


def test_null_in_a_required_column_fails_the_load(spark):
    base = loads.empty_tables(spark)
    status = [("1", None, 1, True, 1)]
    batch = spark.createDataFrame(
        status, "steamid string, owned_visible boolean, owned_game_count int, recent_visible boolean, recent_game_count int"
    )
    stamp = F.lit("2026-10-01 09:00:00").cast("timestamp_ntz")
    with pytest.raises(Exception, match="player_library_status: owned_visible is NULL"):
        loads._load(base, "player_library_status", batch, stamp).collect()


def test_command_line(spark, tmp_path, capsys):
    root = ["--root", str(tmp_path / "root")]
    jobs.main([*root, "start-run"])
    assert capsys.readouterr().out == "1 0 False\n"
    (tmp_path / "landing").mkdir()
    # no page has landed: the run stays open
    jobs.main([*root, "catalog", "--landing", str(tmp_path / "landing")])
    jobs.main([*root, "start-run"])
    assert capsys.readouterr().out == "1 0 True\n"

    (tmp_path / "games.json").write_text(SAMPLE_PAGE)
    jobs.main([*root, "daily", "--games", str(tmp_path / "games.json")])
    at = ["--now", "2100-01-02T00:00:00"]
    jobs.main([*root, *at, "build"])
    with pytest.raises(checks.ChecksFailed, match="rankings_at_most_100_games"):
        jobs.main([*root, *at, "build", "--max-ranked", "4"])
    jobs.main([*root, *at, "report"])
    assert spark.table("game_rankings").count() == 5


def test_last_row_of_a_key_wins_in_profiles_and_libraries(spark, tmp_path):
    from tidewell.sources import landed

    def profile(name):
        return {"steamid": "7", "personaname": name, "profileurl": "u", "personastate": 1}

    (tmp_path / "profiles.json").write_text(json.dumps({"response": {"players": [profile("old"), profile("new")]}}))
    lines = [
        {"steamid": "7", "owned": {"game_count": 1, "games": [{"appid": 1, "name": "G", "playtime_forever": n}]}, "recent": {}}
        for n in (10, 20)
    ]
    (tmp_path / "libraries.json").write_text("\n".join(map(json.dumps, lines)))
    tables, stamp = loads.empty_tables(spark), F.lit("2026-01-05 09:00:00").cast("timestamp_ntz")
    got = loads.load_profiles(tables, landed.read_documents(spark, str(tmp_path / "profiles.json")), None, stamp)
    assert [r.personaname for r in got["friends"].collect()] == ["new"]
    got = loads.load_libraries(tables, landed.read_libraries(spark, str(tmp_path / "libraries.json")), stamp)
    assert [r.playtime_forever for r in got["player_owned_games"].collect()] == [20]
    assert got["player_library_status"].count() == 1
