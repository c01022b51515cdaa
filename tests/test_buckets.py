"""Raw tables in buckets of their keys: what a load writes, and what readers see."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidewell import __main__ as jobs
from tidewell.operators import history
from tidewell.plans import loads
from tidewell.schemas import RAW_TABLES
from tidewell.sources import releases

T0 = datetime(2026, 10, 1, 9)
KEYS = ["steamid", "appid"]


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(releases, "BUCKET_ROWS", 20)


def stamp(n):
    return F.lit((T0 + timedelta(days=n)).isoformat(sep=" ")).cast("timestamp_ntz")


def owned(spark, played, at):
    batch = spark.createDataFrame(
        [(str(k // 7), k, "g", n, 0) for k, n in played.items()],
        "steamid string, appid int, name string, playtime_forever int, rtime_last_played bigint",
    )
    return lambda tables: loads._changes(tables, at, {"player_owned_games": (batch, ("playtime_forever",))})


def written(spark, root, release):
    entries = releases._manifest(spark, root).filter((F.col("release") == release) & F.col("kind").isin("whole", "part"))
    return {t: sorted(r["bucket"] for r in g) for t, g in _grouped(entries.collect()).items()}


def _grouped(entries):
    out = {}
    for e in entries:
        out.setdefault(e["table"], []).append(e)
    return out


def test_loads_write_their_buckets_and_histories_equal_the_full_step(spark, tmp_path, small):
    root, rng = str(tmp_path), random.Random(2)
    now, open_, closed, sizes = {}, None, [], []
    for n in range(6):
        # the second load repeats numbers, the fourth outgrows the buckets, the last is a few rows
        batch = {k: rng.randrange(3) for k in rng.sample(range(300), (60, 60, 10, 200, 30, 2)[n])}
        loads.load_and_publish(spark, root, f"r{n}", owned(spark, batch, stamp(n)), stamp(n))
        now |= {k: (played, T0 + timedelta(days=n)) for k, played in batch.items()}
        found = releases.read_release(spark, root)
        got = found["player_owned_games"].select("appid", "playtime_forever", "loaded_at")
        assert rows(got) == sorted(((k, p, at) for k, (p, at) in now.items()), key=repr)
        assert "bucket" not in found["player_owned_games"].columns

        source = spark.createDataFrame(got.collect(), got.schema)
        step = (
            history.snapshot_step(open_, source, ["appid"], check=["playtime_forever"], taken_at=stamp(n))
            if open_ is not None
            else history.apply_snapshot(None, source, ["appid"], check=["playtime_forever"], taken_at=stamp(n))
        )
        step = step.collect()
        open_ = spark.createDataFrame([r for r in step if r.valid_to is None], source.schema.add("valid_from", "timestamp_ntz").add("valid_to", "timestamp_ntz").add("scd_id", "string"))
        closed += [r for r in step if r.valid_to is not None]
        names = ["appid", "playtime_forever", "valid_from", "valid_to"]
        assert rows(found["player_games_snapshot_open"].select(*names)) == rows(open_.select(*names))
        assert rows(found["player_games_snapshot_closed"].select(*names)) == sorted(((r.appid, r.playtime_forever, r.valid_from, r.valid_to) for r in closed), key=repr)
        sizes.append(releases.Draft(spark, root, "x").bucketing("player_owned_games")[0])

    assert sizes == sorted(sizes) and sizes[-1] > sizes[0]
    last = written(spark, root, "r5")
    assert len(last["player_owned_games"]) <= 2 < sizes[-1]
    assert last["player_games_snapshot_open"] == last["player_owned_games"]
    # readers of an older release still see that one
    assert releases.read_release(spark, root, "r0")["player_owned_games"].count() == 60


def test_few_keys_read_only_their_buckets(spark, tmp_path, small):
    root = str(tmp_path)
    every = {k: 1 for k in range(640)}
    loads.load_and_publish(spark, root, "r0", owned(spark, every, stamp(0)), stamp(0))
    buckets = releases.Draft(spark, root, "x").bucketing("player_owned_games")[0]
    assert buckets == 32
    base = releases.Draft(spark, root, "x").read_buckets("player_owned_games", [3], RAW_TABLES["player_owned_games"].schema())
    assert {p.rsplit("bucket=", 1)[1].split("/")[0] for p in base.inputFiles()} == {"3"}
    number = releases.bucket_of(KEYS, buckets)
    assert base.select(number.alias("b")).distinct().collect() == [(3,)]


def test_manifest_grows_with_the_changes(spark, tmp_path, small):
    root = str(tmp_path)
    loads.load_and_publish(spark, root, "r00", owned(spark, {k: 1 for k in range(320)}, stamp(0)), stamp(0))
    first = releases._manifest(spark, root).count()
    for n in range(1, 9):
        loads.load_and_publish(spark, root, f"r{n:02}", owned(spark, {n: 5}, stamp(n)), stamp(n))
    # a bucket of the table, one of its open history, and the rows closed
    assert releases._manifest(spark, root).count() == first + 8 * 3
    assert releases.held(spark, root).filter("table = 'player_owned_games'").count() == 16


def test_pruning_keeps_buckets_that_newer_releases_hold(spark, tmp_path, small):
    root = str(tmp_path / "root")
    tables = f"{root}/tables"
    for n, batch in enumerate([{k: 1 for k in range(320)}, {1: 2}, {1: 3}, {2: 9}]):
        loads.load_and_publish(spark, tables, f"r{n}", owned(spark, batch, stamp(n)), stamp(n))
    before = rows(releases.read_release(spark, tables)["player_owned_games"])
    for name in ("a", "b", "c"):
        (tmp_path / "root" / "marts" / name).mkdir(parents=True)
    assert jobs.prune(spark, root, keep=1) == ["r0", "r1", "r2"]
    assert rows(releases.read_release(spark, tables)["player_owned_games"]) == before
    assert [p.name for p in (tmp_path / "root" / "marts").iterdir()] == ["c"]
    left = {p.name for p in (tmp_path / "root" / "tables" / "data" / "r1" / "player_owned_games").iterdir() if p.is_dir()}
    assert not left  # its one bucket was written again by r2
    assert len(list((tmp_path / "root" / "tables" / "data" / "r0" / "player_owned_games").glob("bucket=*"))) >= 14
    assert jobs.prune(spark, root, keep=1) == []
    loads.load_and_publish(spark, tables, "r4", owned(spark, {2: 10}, stamp(9)), stamp(9))
    assert releases.read_release(spark, tables)["player_owned_games"].count() == 320
