"""Upserts, run ledger, history snapshots and releases."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidewell.operators import history, ledger
from tidewell.operators.upsert import upsert
from tidewell.schemas import RAW_TABLES, conform
from tidewell.session import reusable
from tidewell.sources import releases

T0 = datetime(2026, 10, 1, 9)


def ntz(when):
    return F.lit(str(when)).cast("timestamp_ntz")


# ---------------------------------------------------------------- schemas


def test_raw_tables_have_keys_among_their_columns(spark):
    for spec in RAW_TABLES.values():
        assert set(spec.keys) <= set(spec.schema().fieldNames())


def test_conform_adds_a_new_column_with_its_default(spark):
    old = spark.createDataFrame([("1", "n", "u", 0, T0)], "steamid string, personaname string, profileurl string, personastate int, loaded_at timestamp_ntz")
    assert rows(conform(old, "friends")) == [("1", "n", "u", 0, T0, False)]


# ---------------------------------------------------------------- upsert


def test_upsert_overwrites_adds_and_never_deletes(spark):
    base = spark.createDataFrame([(1, "a", T0), (2, "b", T0)], "id int, v string, loaded_at timestamp_ntz")
    batch = spark.createDataFrame([(2, "B", 0), (3, "c", 0), (2, "BB", 1)], "id int, v string, seq int")
    now = T0 + timedelta(days=1)
    got = upsert(base, batch, ["id"], seq=["seq"], load_ts=ntz(now))
    want = [(1, "a", T0), (2, "BB", now), (3, "c", now)]
    assert rows(got) == want
    # safe to repeat
    assert rows(upsert(got, batch, ["id"], seq=["seq"], load_ts=ntz(now))) == want


def test_upsert_of_random_batches_equals_a_dictionary(spark):
    rng = random.Random(3)
    state, table = {}, spark.createDataFrame([], "id int, v int")
    for _ in range(4):
        batch = [(rng.randint(0, 20), rng.randint(0, 99), i) for i in range(15)]
        state |= {i: v for i, v, _ in batch}
        table = upsert(table, spark.createDataFrame(batch, "id int, v int, seq int"), ["id"], ["seq"])
    assert rows(table) == sorted(state.items(), key=repr)


def test_upsert_does_not_shuffle_the_base_for_a_small_batch(spark, tmp_path):
    spark.range(100_000).selectExpr("id", "id * 2 as v").write.parquet(f"{tmp_path}/base")
    spark.range(10).selectExpr("id", "id * 3 as v").write.parquet(f"{tmp_path}/batch")
    base, batch = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("base", "batch"))
    plan = upsert(base, batch, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan


# ---------------------------------------------------------------- ledger

RUNS = "run_id bigint, started_at timestamp_ntz, finished_at timestamp_ntz, last_page int, games_loaded int, list_size int"


@pytest.mark.parametrize(
    "runs, want",
    [
        ([], (1, 0, False)),
        ([(11, T0, T0, 5, 10, 10)], (12, 0, False)),
        ([(5, T0, None, 3, 10, None)], (5, 4, True)),
        ([(5, T0, None, None, 0, None)], (5, 0, True)),
        ([(4, T0, None, 9, 1, None), (5, T0, None, 2, 1, None), (6, T0, T0, 7, 1, 1)], (5, 3, True)),
    ],
)
def test_resume_point(spark, runs, want):
    df = spark.createDataFrame(runs, RUNS)
    assert rows(ledger.resume_point(df)) == [want]
    started = ledger.start_run(df, ntz(T0))
    assert started.count() == len(runs) + (not want[2])


def pages(spark, *sizes, run=9):
    data = [(run, page, i) for page, n in enumerate(sizes) for i in range(n)]
    return spark.createDataFrame(data, "run_id bigint, page int, item int")


def test_ledger_of_a_finished_run_and_a_replayed_page(spark):
    runs = spark.createDataFrame([(9, T0, None, None, 0, None)], RUNS)
    done = T0 + timedelta(hours=1)
    loaded = pages(spark, 3, 3, 1)
    got = ledger.run_ledger(runs, ledger.page_log(loaded), ntz(done), page_size=3)
    assert rows(got) == [(9, T0, done, 2, 7, 7)]
    # bringing the ledger up to date again changes nothing
    again = ledger.run_ledger(got, ledger.page_log(loaded), ntz(done + timedelta(1)), page_size=3)
    assert rows(again) == rows(got)


def test_run_without_its_last_page_stays_open(spark):
    runs = spark.createDataFrame([(9, T0, None, None, 0, None), (10, T0, None, None, 0, None)], RUNS)
    got = ledger.run_ledger(runs, ledger.page_log(pages(spark, 3, 3)), ntz(T0), page_size=3)
    assert rows(got) == sorted(
        [(9, T0, None, 1, 6, None), (10, T0, None, None, 0, None)], key=repr
    )
    assert rows(ledger.resume_point(got.filter("run_id = 9"))) == [(9, 2, True)]


def test_run_with_a_gap_stays_open_and_goes_on_there(spark):
    runs = spark.createDataFrame([(9, T0, None, None, 0, None), (10, T0, None, None, 0, None)], RUNS)
    loaded = [(9, 0, i) for i in range(3)] + [(9, 2, 7)] + [(10, 1, i) for i in range(2)]
    log = ledger.page_log(spark.createDataFrame(loaded, "run_id bigint, page int, item int"))
    got = ledger.run_ledger(runs, log, ntz(T0), page_size=3)
    assert rows(got) == sorted([(9, T0, None, 0, 4, None), (10, T0, None, None, 2, None)], key=repr)
    assert rows(ledger.resume_point(got.filter("run_id = 9"))) == [(9, 1, True)]
    assert rows(ledger.resume_point(got.filter("run_id = 10"))) == [(10, 0, True)]


def test_batch_that_repeats_a_key_is_refused(spark):
    base = spark.createDataFrame([(1, 5)], "k int, v int")
    batch = spark.createDataFrame([(2, 1), (2, 2)], "k int, v int")
    with pytest.raises(Exception, match="key repeated in a batch: 2"):
        upsert(base, batch, ["k"]).collect()
    assert rows(upsert(base, batch.limit(1), ["k"])) == [(1, 5), (2, 1)]
    assert rows(upsert(base, batch.limit(0), ["k"])) == [(1, 5)]


# ---------------------------------------------------------------- history

LOG = "id int, v int, at timestamp_ntz"


def random_log(spark, loads=6, ids=8):
    """Every load holds most keys; some vanish and come back."""
    rng = random.Random(11)
    data = [
        (i, rng.choice([None, 1, 2]), T0 + timedelta(days=d))
        for d in range(loads)
        for i in range(ids)
        if rng.random() < 0.7
    ]
    return spark.createDataFrame(data, LOG)


def versions(df):
    return rows(df.select("id", "v", "valid_from", "valid_to", "scd_id"))


@pytest.mark.parametrize("check", [[], ["v"]])
@pytest.mark.parametrize("floor", [3, 10**6])
def test_snapshots_one_by_one_equal_the_history_from_the_log(spark, check, floor):
    log = random_log(spark).cache()
    got = None
    for day in range(6):
        at = T0 + timedelta(days=day)
        source = log.filter(F.col("at") == ntz(at))
        if check:
            source = source.drop("at")
            got = history.apply_snapshot(got, source, ["id"], check=check, taken_at=ntz(at))
        else:
            got = history.apply_snapshot(got, source, ["id"], updated_at="at")
        # a step per load would otherwise nest six joins
        got = spark.createDataFrame(got.collect(), got.schema)
    assert versions(got) == versions(history.versions_from_log(log, ["id"], "at", check, floor=floor))


def test_repeated_snapshot_adds_nothing(spark):
    source = spark.createDataFrame([(1, 5, T0), (2, None, T0)], LOG)
    first = history.apply_snapshot(None, source, ["id"], updated_at="at")
    assert versions(history.apply_snapshot(first, source, ["id"], updated_at="at")) == versions(first)
    plain = source.drop("at")
    first = history.apply_snapshot(None, plain, ["id"], check=["v"], taken_at=ntz(T0))
    later = ntz(T0 + timedelta(days=1))
    again = history.apply_snapshot(first, plain, ["id"], check=["v"], taken_at=later)
    assert versions(again) == versions(first)


def test_missing_keys_stay_open_and_changes_close(spark):
    first = history.apply_snapshot(
        None, spark.createDataFrame([(1, 5), (2, 6)], "id int, v int"), ["id"], check=["v"], taken_at=ntz(T0)
    )
    t1 = T0 + timedelta(days=1)
    source = spark.createDataFrame([(2, 7), (3, 1)], "id int, v int")
    after = history.apply_snapshot(first, source, ["id"], check=["v"], taken_at=ntz(t1))
    assert [r[:4] for r in versions(after)] == sorted(
        [(1, 5, T0, None), (2, 6, T0, t1), (2, 7, t1, None), (3, 1, t1, None)], key=repr
    )


def test_two_rows_of_the_same_load_count_once(spark):
    log = spark.createDataFrame([(1, 5, T0, 0), (1, 6, T0, 1)], LOG + ", seq int")
    got = history.versions_from_log(log, ["id"], "at", tie="seq")
    assert [(r.v, r.valid_to) for r in got.collect()] == [(6, None)]


def test_strategies_exclude_each_other(spark):
    df = spark.createDataFrame([(1, 5, T0)], LOG)
    with pytest.raises(ValueError):
        history.apply_snapshot(None, df, ["id"])
    with pytest.raises(ValueError):
        history.apply_snapshot(None, df, ["id"], check=["v"])


# ---------------------------------------------------------------- releases


def test_release_is_published_as_a_whole(spark, tmp_path):
    root = str(tmp_path)
    one = {"a": spark.range(5).toDF("x"), "b": spark.range(2).toDF("y")}
    releases.write_release(one, root, "2026-10-01")

    two = {"a": spark.range(9).toDF("x"), "b": spark.sql("select raise_error('x') as y from range(3)")}
    with pytest.raises(Exception):
        releases.write_release(two, root, "2026-10-02")
    assert releases.release_names(spark, root) == ["2026-10-01"]
    found = releases.read_release(spark, root)
    assert (found["a"].count(), found["b"].count()) == (5, 2)
    with pytest.raises(releases.ReleaseError, match="already published"):
        releases.write_release(one, root, "2026-10-01")


def test_release_that_reads_back_differently_is_rejected(spark, tmp_path, monkeypatch):
    # a row less than was written
    monkeypatch.setattr(releases, "fingerprint", lambda df, real=releases.fingerprint: real(df.limit(4)))
    with pytest.raises(releases.ReleaseError):
        releases.write_release({"a": spark.range(5)}, str(tmp_path), "r1")
    assert releases.release_names(spark, str(tmp_path)) == []


def test_only_the_newest_releases_are_kept(spark, tmp_path):
    root = str(tmp_path)
    for day in range(1, 5):
        releases.write_release({"a": spark.range(day).toDF("x")}, root, f"2026-10-0{day}")
    assert releases.prune_releases(spark, root, keep=2) == ["2026-10-01", "2026-10-02"]
    assert releases.release_names(spark, root) == ["2026-10-03", "2026-10-04"]
    assert releases.read_release(spark, root, "2026-10-03")["a"].count() == 3
    assert releases.prune_releases(spark, root, keep=2) == []
    with pytest.raises(releases.ReleaseError):
        releases.read_release(spark, root, "2026-10-01")


def test_appended_tables_refer_to_earlier_files(spark, tmp_path):
    root = str(tmp_path)
    for day in range(1, 5):
        new = {"log": spark.range(day).selectExpr(f"{day} as day", "id")}
        releases.write_release({"a": spark.range(day)}, root, f"2026-10-0{day}", appended=new)
    assert [releases.read_release(spark, root, f"2026-10-0{n}")["log"].count() for n in (1, 2, 3, 4)] == [1, 3, 6, 10]
    assert releases.prune_releases(spark, root, keep=1) == ["2026-10-01", "2026-10-02", "2026-10-03"]
    # the kept release still has the rows that older ones wrote
    found = releases.read_release(spark, root)
    assert (found["log"].count(), found["a"].count()) == (10, 4)
    assert not (tmp_path / "data" / "2026-10-02" / "a").exists()
    with pytest.raises(releases.ReleaseError, match="does not come after"):
        releases.write_release({"a": spark.range(1)}, root, "2026-10-03x")


def test_unchanged_tables_are_carried_over(spark, tmp_path):
    root = str(tmp_path)
    releases.write_release({"a": spark.range(3), "b": spark.range(2)}, root, "r1")
    releases.write_release({"a": spark.range(4)}, root, "r2")
    found = releases.read_release(spark, root)
    assert (found["a"].count(), found["b"].count()) == (4, 2)
    assert not (tmp_path / "data" / "r2" / "b").exists()
    assert releases.prune_releases(spark, root, keep=1) == ["r1"]
    assert releases.read_release(spark, root)["b"].count() == 2
    releases.write_release({"a": spark.range(5)}, root, "r3", carry=False)
    assert set(releases.read_release(spark, root)) == {"a"}


def test_release_made_from_an_older_one_is_refused(spark, tmp_path):
    root = str(tmp_path)
    releases.write_release({"a": spark.range(1)}, root, "r1", parent=None)
    releases.write_release({"a": spark.range(2)}, root, "r2", parent="r1")
    for parent in ("r1", None):
        with pytest.raises(releases.StaleError):
            releases.write_release({"a": spark.range(9)}, root, "r3", parent=parent)
    assert releases.read_release(spark, root)["a"].count() == 2


def test_of_two_releases_published_at_once_one_is_refused(spark, tmp_path, monkeypatch):
    root, names = str(tmp_path), releases.release_names
    releases.write_release({"a": spark.range(1)}, root, "r1")
    releases.write_release({"a": spark.range(2)}, root, "r2")
    # the other release was not there yet when this one looked
    monkeypatch.setattr(releases, "release_names", lambda *at: names(*at)[:1])
    with pytest.raises(releases.StaleError):
        releases.write_release({"a": spark.range(9)}, root, "r3", parent="r1")
    monkeypatch.undo()
    assert releases.release_names(spark, root) == ["r1", "r2"]
    assert releases.read_release(spark, root)["a"].count() == 2


def test_export_is_a_checked_copy(spark, tmp_path):
    root, target = f"{tmp_path}/root", f"{tmp_path}/target"
    releases.write_release({"a": spark.range(3)}, root, "r1", appended={"b": spark.range(2)})
    releases.write_release({"a": spark.range(4)}, root, "r2", appended={"b": spark.range(5)})
    assert releases.copy_release(spark, root, target) == "r2"
    found = releases.read_release(spark, target)
    assert (found["a"].count(), found["b"].count()) == (4, 7)


def test_nothing_published_yet(spark, tmp_path):
    assert releases.release_names(spark, f"{tmp_path}/none") == []
    with pytest.raises(releases.ReleaseError):
        releases.read_release(spark, f"{tmp_path}/none")


def test_reused_table_is_cut_off_where_a_checkpoint_folder_is_named(spark, tmp_path):
    df = spark.range(5).withColumn("x", F.col("id") * 2)
    if spark.sparkContext.getCheckpointDir() is None:
        assert reusable(df) is df
        spark.sparkContext.setCheckpointDir(str(tmp_path))
    kept = reusable(df)
    assert "Range" not in kept._jdf.queryExecution().optimizedPlan().toString()
    assert rows(kept) == rows(df)


def test_run_opened_anew_leaves_the_open_one(spark):
    runs = spark.createDataFrame([(9, T0, None, 3, 8, None)], RUNS)
    assert ledger.start_run(runs, ntz(T0)).count() == 1
    both = ledger.start_run(runs, ntz(T0), anew=True)
    assert sorted(r.run_id for r in both.collect()) == [9, 10]
    assert tuple(ledger.resume_point(both).first()) == (10, 0, True)
    none = runs.limit(0)
    assert [r.run_id for r in ledger.start_run(none, ntz(T0), anew=True).collect()] == [1]
