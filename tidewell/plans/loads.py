"""Loading landed documents into the raw tables and taking snapshots of them.

Functions take the current raw tables by name and return the tables they changed.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators.history import snapshot_step
from tidewell.operators.ledger import PAGE_SIZE, page_log, run_ledger
from tidewell.operators.upsert import one_per_key, replace_keys
from tidewell.schemas import RAW_TABLES, conform
from tidewell.session import reusable
from tidewell.sources import landed, releases

Tables = Mapping[str, DataFrame]

# history -> its raw table and how changes are recognised
SNAPSHOTS: dict[str, tuple[str, dict]] = {
    "games_snapshot": ("games", {"updated_at": "loaded_at"}),
    "player_games_snapshot": ("player_owned_games", {"check": ["playtime_forever"]}),
}


class Changes(dict):
    """Changed tables by name, with the rows that changed them where these replace by key.

    A table with a batch need not be written whole: the buckets of the batch's keys are enough.
    """

    def __init__(self, tables: Tables = (), batches: Mapping[str, DataFrame] = ()):  # type: ignore[assignment]
        super().__init__(tables)
        self.batches = {**getattr(tables, "batches", {}), **dict(batches)}

    def __or__(self, other: Tables) -> Changes:
        return Changes({**self, **other}, {**self.batches, **getattr(other, "batches", {})})

    __ior__ = __or__


def empty_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """Raw tables and histories before the first load."""
    out = {name: spark.createDataFrame([], spec.schema()) for name, spec in RAW_TABLES.items()}
    for name, (source, _) in SNAPSHOTS.items():
        fields = [
            *RAW_TABLES[source].schema().fields,
            T.StructField("valid_from", T.TimestampNTZType()),
            T.StructField("valid_to", T.TimestampNTZType()),
            T.StructField("scd_id", T.StringType()),
        ]
        for part in ("open", "closed"):
            out[f"{name}_{part}"] = spark.createDataFrame([], T.StructType(fields))
    return out


def _batch(name: str, rows: DataFrame, load_ts: Column | None, seq: tuple[str, ...] = ()) -> DataFrame:
    """One row per key, checked and stamped, with the declared columns of the raw table."""
    spec = RAW_TABLES[name]
    must = list(dict.fromkeys([*spec.keys, *spec.required]))
    batch = one_per_key(_filled(rows, name, must), spec.keys, seq)
    return conform(batch if load_ts is None else batch.withColumn("loaded_at", load_ts), name)


def _load(
    tables: Tables, name: str, rows: DataFrame, load_ts: Column | None, seq: tuple[str, ...] = ()
) -> DataFrame:
    return replace_keys(conform(tables[name], name), _batch(name, rows, load_ts, seq), RAW_TABLES[name].keys)


def _changes(
    tables: Tables, load_ts: Column | None, rows: Mapping[str, tuple[DataFrame, tuple[str, ...]]]
) -> Changes:
    batches = {name: _batch(name, own, load_ts, seq) for name, (own, seq) in rows.items()}
    whole = {
        name: replace_keys(conform(tables[name], name), batch, RAW_TABLES[name].keys)
        for name, batch in batches.items()
    }
    return Changes(whole, batches)


def _filled(rows: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """``rows``, or a failure when it runs if one has NULL in ``columns``."""
    for c in columns:
        failure = F.raise_error(F.lit(f"{name}: {c} is NULL")).cast("boolean")
        rows = rows.filter(F.when(F.col(c).isNotNull(), True).otherwise(failure))
    return rows


def load_top_list(tables: Tables, documents: DataFrame, load_ts: Column) -> Changes:
    rows = landed.game_rows(documents, keep=["file"])
    return _changes(tables, load_ts, {"games": (rows, ("file", "seq"))})


def load_profiles(
    tables: Tables, documents: DataFrame, self_id: str | None, load_ts: Column
) -> Changes:
    """A profile that comes again, in the same or a later file by name, keeps its last row."""
    rows = landed.player_rows(documents, self_id, position=["file"])
    return _changes(tables, load_ts, {"friends": (rows, ("file", "seq"))})


def load_libraries(tables: Tables, libraries: DataFrame, load_ts: Column) -> Changes:
    """Status, owned and recent games of all players, sharing one stamp.

    Of rows with the same key the last one in reading order stays.
    """
    at = landed.LINE_POSITION
    status = landed.library_status(libraries, position=at)
    owned = landed.owned_game_rows(libraries, position=at)
    recent = landed.recent_game_rows(libraries, position=at)
    return _changes(
        tables, load_ts,
        {
            "player_library_status": (status, at),
            "player_owned_games": (owned, (*at, "seq")),
            "player_recent_games": (recent, (*at, "seq")),
        },
    )


def load_catalog(
    tables: Tables, stored: DataFrame, finished_at: Column, page_size: int = PAGE_SIZE
) -> Changes:
    """Fold the page store of the stream into the catalogue and the run ledger.

    Only pages of open runs are read: finished ones were folded in before. A page of a run that
    the ledger does not have fails the load. Rows keep the stamp of their own page. A game seen
    on two pages keeps the later one.
    """
    runs = conform(tables["catalog_runs"], "catalog_runs")
    unknown = stored.select("run_id").distinct().join(runs, "run_id", "left_anti")
    first = unknown.orderBy("run_id").first()
    if first is not None:
        raise ValueError(f"pages of run {first['run_id']} have landed, which the ledger does not have")
    fresh = stored.join(runs.filter("finished_at is null").select("run_id"), "run_id", "left_semi")
    games = fresh.filter(F.col("appid").isNotNull())
    ledger = run_ledger(runs, page_log(fresh, "appid"), finished_at, page_size)
    return _changes(tables, None, {"games_catalog": (games, ("run_id", "page", "seq"))}) | {"catalog_runs": ledger}


def _write_raw(
    draft: releases.Draft, tables: Tables, changed: Tables, name: str
) -> tuple[DataFrame, list[int] | None, int]:
    """The table's changed buckets as written, their numbers (None: all of them), and how many it has.

    A table gets twice the buckets, and is written whole, when its rows have outgrown them; between
    two such times only the buckets that the batch has keys of are read and written.
    """
    spec = RAW_TABLES[name]
    batch = getattr(changed, "batches", {}).get(name)
    if batch is None:
        return draft.write(name, changed[name]), None, 0
    # The load is evaluated once: what follows reads the rows it came to.
    staged = draft.stage(name, batch)
    buckets, held = draft.bucketing(name)
    most = held + staged.count()
    if buckets is None or most > 2 * buckets * releases.BUCKET_ROWS:
        buckets = max(buckets or 1, releases.buckets_for(most))
        base = conform(tables[name], name)
        return draft.write_buckets(name, replace_keys(base, staged, spec.keys), spec.keys, buckets, whole=True), None, buckets
    number = releases.bucket_of(spec.keys, buckets) if buckets > 1 else F.lit(0)
    hit = sorted(r[0] for r in staged.select(number.alias("b")).distinct().collect())  # at most all buckets
    if not hit:
        return staged, [], buckets
    base = draft.read_buckets(name, hit, tables[name].schema)
    rows = replace_keys(conform(base, name), staged, spec.keys)
    return draft.write_buckets(name, rows, spec.keys, buckets, whole=False), hit, buckets


def _write_snapshot(
    draft: releases.Draft, tables: Tables, name: str, source: DataFrame, hit: list[int] | None, buckets: int, taken_at: Column
) -> None:
    """Open versions of the changed buckets, and rows for the versions that this snapshot closed."""
    raw, strategy = SNAPSHOTS[name]
    keys = RAW_TABLES[raw].keys
    extra = {"taken_at": taken_at} if "check" in strategy else {}
    table = f"{name}_open"
    if hit == []:
        return
    whole = hit is None or draft.bucketing(table)[0] != buckets
    before = tables[table]
    if whole and hit is not None:  # the open versions are in other buckets: read the source whole too
        number = releases.bucket_of(keys, buckets) if buckets > 1 else F.lit(0)
        rest = conform(tables[raw], raw).where(~number.isin(*hit))
        source = source.unionByName(rest)
    elif not whole:
        before = draft.read_buckets(table, hit, before.schema)
    step = reusable(snapshot_step(before, source, keys, **strategy, **extra))
    still_open, closed = step.filter("valid_to is null"), step.filter("valid_to is not null")
    if buckets:
        draft.write_buckets(table, still_open, keys, buckets, whole)
    else:
        draft.write(table, still_open)
    draft.write(f"{name}_closed", closed, releases.MORE)


def with_histories(tables: Tables) -> dict[str, DataFrame]:
    """``tables`` plus each whole history, which is what the models read."""
    whole = {
        name: tables[f"{name}_closed"].unionByName(tables[f"{name}_open"]) for name in SNAPSHOTS
    }
    return {**tables, **whole}


def current_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Tables of the newest release below ``root``, or empty ones before the first."""
    names = releases.release_names(spark, root)
    found = releases.read_release(spark, root, names=names) if names else {}
    return {**empty_tables(spark), **found}


def publish(
    spark: SparkSession,
    root: str,
    name: str,
    changed: Tables,
    taken_at: Column,
    parent: str | None = releases.NEWEST,
) -> dict[str, DataFrame]:
    """Publish the changed raw tables with their snapshots as one release.

    Tables that did not change are referred to. Of a table that was loaded by key only the buckets of
    those keys are written anew, and the snapshot compares what was written in them with the open
    versions of the same buckets; closed versions are appended. ``parent`` is the release that ``changed`` was made
    from; if it is no longer the newest one, nothing is published.
    """
    draft = releases.Draft(spark, root, name, parent)
    tables = current_tables(spark, root)
    for table in changed:
        rows, hit, buckets = _write_raw(draft, tables, changed, table)
        for history, (source, _) in SNAPSHOTS.items():
            if source == table:
                _write_snapshot(draft, tables, history, rows, hit, buckets, taken_at)
    draft.publish()
    return current_tables(spark, root)


def load_and_publish(
    spark: SparkSession,
    root: str,
    name: str,
    load: Callable[[Tables], Tables],
    taken_at: Column,
    attempts: int = 3,
) -> dict[str, DataFrame]:
    """Publish what ``load`` makes of the current tables, anew if another load came between.

    A name that does not come after the newest release is appended to that one's.
    """
    for attempt in range(attempts):
        newest = (releases.release_names(spark, root) or [None])[-1]
        own = name if newest is None or name > newest else f"{newest}+"
        try:
            return publish(spark, root, own, load(current_tables(spark, root)), taken_at, newest)
        except releases.StaleError:
            if attempt == attempts - 1:
                raise
    raise ValueError("attempts has to be positive")
