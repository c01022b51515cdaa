"""Incremental page loads."""

import json
import os

import pytest
from conftest import rows
from test_landed import GAMES, game

from tidewell.operators import ledger
from tidewell.streaming import pages


@pytest.fixture
def landing(tmp_path):
    os.makedirs(tmp_path / "landing" / "run-1")
    return tmp_path


def land(landing, page, ids, run=1, **changes):
    games = {str(i): game((i, *GAMES[0][1:]), **changes) for i in ids}
    path = landing / "landing" / f"run-{run}" / f"page-{page:05d}.json"
    os.makedirs(path.parent, exist_ok=True)
    path.write_text(json.dumps(games))


def load(spark, landing):
    query = pages.stream_pages(
        spark, str(landing / "landing"), str(landing / "store"), str(landing / "check"), 1
    )
    query.awaitTermination()
    return pages.read_store(spark, str(landing / "store"))


def log(stored):
    return rows(pages.committed_pages(stored))


def test_pages_are_loaded_once_and_later_ones_are_picked_up(spark, landing):
    land(landing, 0, [1, 2, 3])
    land(landing, 1, [4, 5, 6])
    stored = load(spark, landing)
    assert log(stored) == [(1, 0, 3), (1, 1, 3)]
    progress = ledger.run_progress(pages.committed_pages(stored), page_size=3)
    assert rows(progress) == [(1, 1, 6, False, None)]

    land(landing, 2, [7])
    stored = load(spark, landing)
    assert log(stored) == [(1, 0, 3), (1, 1, 3), (1, 2, 1)]
    progress = ledger.run_progress(pages.committed_pages(stored), page_size=3)
    assert rows(progress) == [(1, 2, 7, True, 7)]
    # nothing new: nothing loaded
    assert log(load(spark, landing)) == log(stored)


def test_game_on_two_pages_keeps_the_later_one(spark, landing):
    land(landing, 0, [1, 2])
    land(landing, 1, [2], ccu=77)
    catalog = pages.current_catalog(load(spark, landing))
    assert sorted((r.appid, r.concurrent_users) for r in catalog.collect()) == [(1, GAMES[0][-1]), (2, 77)]


def test_second_run_replaces_rows_of_the_first(spark, landing):
    land(landing, 0, [1, 2])
    load(spark, landing)
    land(landing, 0, [2, 3], run=2, ccu=5)
    stored = load(spark, landing)
    assert log(stored) == [(1, 0, 2), (2, 0, 2)]
    catalog = pages.current_catalog(stored)
    assert sorted((r.appid, r.concurrent_users) for r in catalog.collect()) == [
        (1, GAMES[0][-1]),
        (2, 5),
        (3, 5),
    ]


@pytest.fixture
def broken(landing):
    """Five pages, three of which cannot be loaded."""
    for page in (0, 2):
        land(landing, page, [3 * page + 1, 3 * page + 2, 3 * page + 3])
    folder = landing / "landing" / "run-1"
    (folder / "page-00001.json").write_text('{"4": {"appid": ')
    odd = {"10": game((10, *GAMES[0][1:])), "11": game((11, *GAMES[0][1:]))}
    del odd["11"]["owners"]
    (folder / "page-00003.json").write_text(json.dumps(odd))
    (folder / "page-00004.json").write_text(json.dumps({"12": game((12, *GAMES[0][1:]), price="much")}))
    return landing


def rejected(spark, landing):
    found = pages.open_rejects(spark, str(landing / "store")).orderBy("page").collect()
    return [(r.run_id, r.page, r.error) for r in found]


def load_together(spark, landing):
    pages.replay_rejects(spark, str(landing / "store"), 2)
    query = pages.stream_pages(spark, str(landing / "landing"), str(landing / "store"), str(landing / "check"))
    query.awaitTermination()
    return pages.read_store(spark, str(landing / "store"))


def test_broken_page_costs_only_itself(spark, broken):
    assert log(load_together(spark, broken)) == [(1, 0, 3), (1, 2, 3)]
    assert rejected(spark, broken) == [
        (1, 1, "not a map of objects"),
        (1, 3, "11: required field missing: owners"),
        (1, 4, "12: malformed"),
    ]
    # nothing was mended: nothing changes
    assert log(load_together(spark, broken)) == [(1, 0, 3), (1, 2, 3)]
    assert len(rejected(spark, broken)) == 3

    land(broken, 1, [4, 5, 6])
    (broken / "landing" / "run-1" / "page-00003.json").write_text('{"10": 1}')
    stored = load_together(spark, broken)
    assert log(stored) == [(1, 0, 3), (1, 1, 3), (1, 2, 3)]
    assert rejected(spark, broken) == [(1, 3, "10: malformed"), (1, 4, "12: malformed")]
    os.remove(broken / "landing" / "run-1" / "page-00003.json")
    land(broken, 4, [12])
    stored = load_together(spark, broken)
    assert log(stored)[-1] == (1, 4, 1)
    assert rejected(spark, broken) == []
    # a file that is gone is a gap of the run
    faults = rows(ledger.page_faults(pages.committed_pages(stored), page_size=3))
    assert faults == [(1, 3, 3, "missing")]


def test_replay_that_was_cut_off_is_done_again(spark, broken):
    load_together(spark, broken)
    land(broken, 1, [4, 5, 6])
    before = log(load_together(spark, broken))
    [again] = [n for n in os.listdir(broken / "store") if n.startswith("batch=again-")]
    os.remove(broken / "store" / again / "_SUCCESS")
    assert log(load_together(spark, broken)) == before
    assert sorted(r.appid for r in pages.current_catalog(pages.read_store(spark, str(broken / "store"))).collect()) == [
        *range(1, 10)
    ]


def test_store_of_rejects_only(spark, landing):
    land(landing, 0, [1])
    folder = landing / "landing" / "run-1"
    (folder / "page-00000.json").write_text("[]")
    (folder / "page-x.json").write_text("{}")
    assert log(load_together(spark, landing)) == []
    assert rejected(spark, landing) == [
        (1, None, "not named run-<id>/page-<n>.json"), (1, 0, "not a map of objects")
    ]


def test_batch_cut_off_between_both_writes(spark, broken):
    first = log(load_together(spark, broken))
    kept = rejected(spark, broken)
    # as after a crash behind the rejects: no pages, no commit
    for folder, _, names in os.walk(broken / "store" / "batch=0"):
        for name in names:
            os.remove(os.path.join(folder, name))
    for name in ("0", ".0.crc"):
        os.remove(broken / "check" / "commits" / name)
    assert log(load_together(spark, broken)) == first
    assert rejected(spark, broken) == kept


def test_replayed_batch_counts_its_rows_once(spark, landing):
    land(landing, 0, [1, 2])
    before = rows(load(spark, landing))
    # forget that the batch was committed, as after a crash right after its write
    for name in ("0", ".0.crc"):
        os.remove(landing / "check" / "commits" / name)
    assert rows(load(spark, landing)) == before


def test_empty_page_ends_a_list_of_full_pages(spark, landing):
    land(landing, 0, [1, 2, 3])
    land(landing, 1, [4, 5, 6])
    land(landing, 2, [])
    stored = load(spark, landing)
    assert log(stored) == [(1, 0, 3), (1, 1, 3), (1, 2, 0)]
    progress = ledger.run_progress(pages.committed_pages(stored), page_size=3)
    assert rows(progress) == [(1, 1, 6, True, 6)]
    assert pages.current_catalog(stored).count() == 6


def test_list_without_games_has_no_size(spark, landing):
    land(landing, 0, [])
    stored = load(spark, landing)
    progress = ledger.run_progress(pages.committed_pages(stored), page_size=3)
    assert rows(progress) == [(1, None, 0, True, None)]


def test_pages_with_old_time_stamps_are_loaded(spark, landing):
    land(landing, 1, [4, 5, 6])
    load(spark, landing)
    land(landing, 0, [1, 2, 3])
    path = landing / "landing" / "run-1" / "page-00000.json"
    old = os.stat(path).st_mtime - 100 * 86_400
    os.utime(path, (old, old))
    assert log(load(spark, landing)) == [(1, 0, 3), (1, 1, 3)]


def test_early_short_page_keeps_a_run_open(spark, landing):
    for page, n in enumerate((3, 1, 3, 2)):
        land(landing, page, range(10 * page, 10 * page + n))
    log_ = pages.committed_pages(load_together(spark, landing))
    assert rows(ledger.run_progress(log_, page_size=3)) == [(1, 3, 9, False, None)]
    assert rows(ledger.page_faults(log_, page_size=3)) == [
        (1, 1, 1, "short"), (1, 2, 2, "after the end"), (1, 3, 3, "after the end")
    ]
