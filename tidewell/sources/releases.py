"""Sets of tables that become visible together.

The data of a release is written to its own folder first. One file of entries in
the manifest then publishes it: a reader either sees all tables of a release or
none. No path that a plan may still be reading is overwritten.

The entries of a release say only what it changed: a table written anew, rows added to one, or
single buckets of one. What a release holds follows from its own entries and those of
the releases before it, so the manifest grows with the changes and not with the number of
tables, buckets or releases.
"""

from __future__ import annotations

import uuid
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.sources import paths

_MANIFEST = (
    "release string, table string, path string, rows bigint, checksum decimal(38,0), "
    "kind string, bucket int, buckets int"
)
# kinds of entries: a table or all its buckets anew, one bucket anew, rows added; a release that
# begins without the tables before it; a release that was pruned, and a path that was deleted
WHOLE, PART, MORE, START, PRUNED, GONE = "whole", "part", "more", "start", "pruned", "gone"

#: Rows of a bucket; with twice as many on average a table gets more buckets.
BUCKET_ROWS = 100_000
BUCKET = "bucket"

#: Take the newest release as the one before.
NEWEST = "newest"


class ReleaseError(RuntimeError):
    pass


class StaleError(ReleaseError):
    """Another release was published since the tables were read."""


def _measures() -> list[Column]:
    hashes = F.xxhash64(F.struct("*")).cast("decimal(38,0)")
    return [F.count("*").alias("rows"), F.coalesce(F.sum(hashes), F.lit(0)).alias("checksum")]


def fingerprint(df: DataFrame) -> dict[str, object]:
    """Row count and order-independent content hash."""
    return df.agg(*_measures()).first().asDict()


def _manifest(spark: SparkSession, root: str) -> DataFrame:
    schema = T.StructType.fromDDL(_MANIFEST)
    if not paths.exists(spark, f"{root}/manifest"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/manifest")


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def buckets_for(rows: int) -> int:
    """Buckets for a table of that size: a power of two with at most BUCKET_ROWS rows in each."""
    return 1 << max(0, (-(-rows // BUCKET_ROWS) - 1).bit_length())


class Draft:
    """A release that is being written: data first, then one file of entries publishes it.

    Count and content hash are observed while data is written; it is then read back
    and must show the same.

    Say as ``parent`` which release the tables were made from, None if there was none. A release
    has one successor: if another one was published meanwhile, this one fails and changes
    nothing. Names must sort by age, such as a date and time, and are used
    once: a published release may have readers.
    """

    def __init__(self, spark: SparkSession, root: str, name: str, parent: str | None = NEWEST):
        self.spark, self.root, self.name = spark, root, name
        names = release_names(spark, root)
        self.newest = names[-1] if names else None
        if parent not in (NEWEST, self.newest):
            raise StaleError(f"release {self.newest!r} was published after {parent!r} was read")
        if name in names:
            raise ReleaseError(f"release {name!r} is already published in {root}")
        if names and name < names[-1]:
            raise ReleaseError(f"release {name!r} does not come after {names[-1]!r} in {root}")
        self._entries: list[tuple] = []
        self._id = uuid.uuid4().hex
        self._held: dict[str, list] = {}

    def _written(self, table: str, df: DataFrame, by: Sequence[str] = ()) -> tuple[str, dict]:
        path = f"{self.root}/data/{self.name}/{table}"
        observed = Observation()
        writer = df.observe(observed, *_measures()).write.mode("overwrite")
        (writer.partitionBy(*by) if by else writer).parquet(path)
        return path, observed.get

    def entries(self, table: str) -> list:
        """Entries of what the release before holds of a table: one, or one for each bucket."""
        if table not in self._held:
            own = [] if self.newest is None else _held(_manifest(self.spark, self.root), self.newest)
            self._held[table] = own and own.filter(F.col("table") == table).collect()
        return self._held[table]

    def bucketing(self, table: str) -> tuple[int | None, int]:
        """Buckets of a table in the release before, None if it has none, and its rows."""
        own = self.entries(table)
        buckets = {e["buckets"] for e in own}
        return (max(buckets) if buckets and None not in buckets else None), sum(e["rows"] for e in own)

    def read_buckets(self, table: str, numbers: Collection[int], schema: T.StructType) -> DataFrame:
        """Rows of some buckets of a table in the release before; the files of others are not touched."""
        files = [e["path"] for e in self.entries(table) if e["bucket"] in numbers and e["rows"]]
        return self.spark.read.schema(schema).parquet(*files) if files else self.spark.createDataFrame([], schema)

    def stage(self, table: str, df: DataFrame) -> DataFrame:
        """Rows for more than one use, written once beside the release; they go when it is published."""
        path = f"{self._drafts()}/{table}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _drafts(self) -> str:
        return f"{self.root}/drafts/{self.name}-{self._id}"

    def write(self, table: str, df: DataFrame, kind: str = WHOLE) -> DataFrame:
        """The table, or rows added to it; returns them as they were written."""
        path, observed = self._written(table, df)
        back = self.spark.read.schema(df.schema).parquet(path)
        found = fingerprint(back)
        self._check(table, observed, found)
        self._entries.append((self.name, table, path, found["rows"], found["checksum"], kind, None, None))
        return back

    def write_buckets(
        self, table: str, df: DataFrame, keys: Sequence[str], buckets: int, whole: bool
    ) -> DataFrame:
        """Buckets of a table: all of them, or those that ``df`` has rows of; returns their rows.

        A bucket is a folder of its own, so that the next change of one reads and writes no other.
        """
        number = bucket_of(keys, buckets) if buckets > 1 else F.lit(0)
        return self.write_parts(table, df, number, buckets, whole)

    def write_parts(
        self, table: str, df: DataFrame, number: Column, buckets: int, whole: bool
    ) -> DataFrame:
        """As :meth:`write_buckets`, with parts by any number, such as that of a day."""
        numbered = df.withColumn(BUCKET, number)
        # few files per bucket, while one too large for a task is still split
        dealt = numbered.hint("rebalance", BUCKET) if buckets != 1 else numbered
        path, observed = self._written(table, dealt, [BUCKET])
        back = self.spark.read.schema(numbered.schema).parquet(path)
        each = {r[BUCKET]: r for r in back.groupBy(BUCKET).agg(*_measures()).collect()}  # a row per bucket
        found = {
            "rows": sum(r["rows"] for r in each.values()), "checksum": sum(r["checksum"] for r in each.values()),
        }
        self._check(table, observed, found)
        kind = WHOLE if whole else PART
        for k, r in sorted(each.items()):
            self._entries.append(
                (self.name, table, f"{path}/{BUCKET}={k}", r["rows"], r["checksum"], kind, k, buckets)
            )
        if whole and not each:  # an empty table is a table
            self._entries.append((self.name, table, path, 0, 0, kind, 0, buckets))
        return back.drop(BUCKET)

    @staticmethod
    def _check(table: str, wrote: dict, found: dict) -> None:
        if found != wrote:
            raise ReleaseError(f"{table}: wrote {wrote}, read back {found}")

    def publish(self, carry: bool = True) -> None:
        """Make the release visible; without ``carry`` it has no table that it did not write."""
        if not carry:
            self._entries.append((self.name, None, None, None, None, START, None, None))
        manifest = self.spark.createDataFrame(self._entries, T.StructType.fromDDL(_MANIFEST))
        # one file, named after the release before, so the release appears at once or not at all
        draft = f"{self._drafts()}/entries"
        manifest.coalesce(1).write.parquet(draft)
        target = f"{self.root}/manifest/after-{self.newest or 'nothing'}.parquet"
        if not paths.move_new(self.spark, draft, target):
            raise StaleError(f"another release was published after {self.newest!r}")
        paths.delete(self.spark, self._drafts())


def write_release(
    tables: Mapping[str, DataFrame],
    root: str,
    name: str,
    appended: Mapping[str, DataFrame] | None = None,
    carry: bool = True,
    parent: str | None = NEWEST,
) -> None:
    """Write ``tables`` as release ``name``; it counts only once everything is written.

    Rows of ``appended`` are added to what the release before holds of that table. With
    ``carry`` its other tables belong to this release as well. Files written
    before are referred to and not copied, so a release costs what has changed. See :class:`Draft`.
    """
    appended = appended or {}
    spark = next(iter({**tables, **appended}.values())).sparkSession
    draft = Draft(spark, root, name, parent)
    for table, df in tables.items():
        draft.write(table, df)
    for table, df in appended.items():
        draft.write(table, df, MORE)
    draft.publish(carry)


def release_names(spark: SparkSession, root: str) -> list[str]:
    """Published releases that were not pruned, oldest first."""
    manifest = _manifest(spark, root).filter(F.col("kind") != GONE)
    pruned = manifest.filter(F.col("kind") == PRUNED).select("release")
    names = manifest.select("release").distinct().join(pruned, "release", "left_anti")
    return sorted(r[0] for r in names.toLocalIterator())


def _held(manifest: DataFrame, name: str) -> DataFrame:
    """Entries of what release ``name`` holds: of each table the newest whole writing, of each of its
    buckets the newest one since then, and all rows added since then."""
    upto = manifest.filter((F.col("release") <= name) & F.col("kind").isin(WHOLE, PART, MORE, START))
    start = upto.agg(F.max(F.when(F.col("kind") == START, F.col("release")))).scalar()
    upto = upto.filter((F.col("kind") != START) & (F.col("release") >= F.coalesce(start, F.lit(""))))
    whole = upto.groupBy("table").agg(F.max(F.when(F.col("kind") == WHOLE, F.col("release"))).alias("since"))
    live = upto.join(whole, "table").filter(F.col("since").isNull() | (F.col("release") >= F.col("since")))
    # Added rows stay all, as parts of their own.
    own = F.when(F.col("kind") == MORE, F.col("path")).otherwise(F.coalesce(F.col("bucket").cast("string"), F.lit("-")))
    newest = live.groupBy("table", own.alias("own")).agg(
        F.max_by(F.struct("release", "path", "rows", "checksum", "kind", "bucket", "buckets"), "release").alias("e")
    )
    return newest.select("table", "e.*")


def held(spark: SparkSession, root: str, name: str | None = None) -> DataFrame:
    """Entries (table, release, path, rows, checksum, kind, bucket, buckets) that a release consists of."""
    names = release_names(spark, root)
    name = name or (names[-1] if names else None)
    if name not in names:
        raise ReleaseError(f"no release {name!r} in {root}")
    return _held(_manifest(spark, root), name)


def read_release(
    spark: SparkSession, root: str, name: str | None = None, names: Sequence[str] | None = None
) -> dict[str, DataFrame]:
    """Tables of a release, the newest one by default; ``names`` if they were looked up before."""
    files: dict[str, list[str]] = {}
    own = _held(_manifest(spark, root), name or names[-1]) if names else held(spark, root, name)
    for r in own.select("table", "path").orderBy("path").collect():  # a row per table or bucket
        files.setdefault(r["table"], []).append(r["path"])
    return {table: spark.read.parquet(*found) for table, found in files.items()}


def copy_release(spark: SparkSession, root: str, target: str, name: str | None = None) -> str:
    """Export a release to another root, checked like any release; returns its name."""
    name = name or release_names(spark, root)[-1]
    write_release(read_release(spark, root, name), target, name, carry=False)
    return name


def prune_releases(spark: SparkSession, root: str, keep: int = 14) -> list[str]:
    """Delete all but the newest ``keep`` releases; returns their names.

    They are marked in the manifest first, so nobody is sent to a half-deleted release. Paths that
    no kept release holds are found by an anti join; only they come to the driver, and are marked as
    deleted afterwards. A prune that was interrupted is made up for by the next one.
    """
    names = release_names(spark, root)
    old, kept = names[: max(0, len(names) - keep)], names[max(0, len(names) - keep) :]
    if old:
        _mark(spark, root, [(n, None, None, None, None, PRUNED, None, None) for n in old])
    manifest = _manifest(spark, root)
    needed = None
    for n in kept:
        own = _held(manifest, n).select("path")
        needed = own if needed is None else needed.union(own)
    past = manifest.filter(F.col("kind") == PRUNED).select("release")
    gone = manifest.filter(F.col("kind") == GONE).select("path")
    unused = (
        manifest.filter(F.col("kind").isin(WHOLE, PART, MORE))
        .join(past, "release", "left_semi").join(gone, "path", "left_anti")
    )
    if needed is not None:
        unused = unused.join(needed, "path", "left_anti")
    deleted = []
    for r in unused.select("release", "path").toLocalIterator():
        paths.delete(spark, r["path"])
        deleted.append((r["release"], None, r["path"], None, None, GONE, None, None))
    if deleted:
        _mark(spark, root, deleted)
    return old


def _mark(spark: SparkSession, root: str, marks: list[tuple]) -> None:
    found = spark.createDataFrame(marks, T.StructType.fromDDL(_MANIFEST))
    found.coalesce(1).write.mode("append").parquet(f"{root}/manifest")
