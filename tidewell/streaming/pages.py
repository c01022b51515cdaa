"""Incremental load of landed catalogue pages.

Pages land as ``<landing>/run-<id>/page-<n>.json``. The stream appends the rows of each
micro-batch to a page store, with run, page and position in the page. Both the current
catalogue and the run ledger are derived from that store, so a page and its
progress are committed by the same write. A page without games leaves one row that has
no ``appid``.

A page that cannot be loaded does not hold back the others: it leaves a row in the table of
rejects beside the store, and is tried again once its file has changed.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewell.operators.ledger import page_log
from tidewell.operators.quality import read_optional
from tidewell.operators.ranking import last_per_group
from tidewell.schemas import RAW_TABLES
from tidewell.sources import paths
from tidewell.sources.landed import game_rows, page_fault, page_position, read_documents, with_file

_POSITION = ("run_id", "page", "seq")
_REJECTS = "attempt int, file string, run_id bigint, page int, modified timestamp_ntz, error string"
_AGAIN = "again-"


def stream_pages(
    spark: SparkSession,
    landing: str,
    store: str,
    checkpoint: str,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Load all landed pages that were not loaded yet, then stop.

    A batch overwrites its own folders, so replaying it after a failure changes
    nothing. Rows are stamped with the time their page landed, which a replay
    does not change either. Pages that cannot be loaded become rejects.
    """
    documents = with_file(
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "page-*.json")
        .option("maxFilesPerTrigger", files_per_batch)
        # Copied or resumed pages may carry any time stamp; none is too old to load.
        .option("maxFileAge", "36500d")
        .load(landing)
    ).withColumns(page_position("file"))

    return (
        documents.writeStream.foreachBatch(lambda batch, batch_id: _commit(batch, store, str(batch_id), 0))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _rejects_of(store: str) -> str:
    return f"{store}-rejects"


def _commit(batch: DataFrame, store: str, name: str, attempt: int) -> None:
    """Rows of the sound pages of a batch to the store, after a row for each other page to the rejects."""
    nameless = F.col("run_id").isNull() | F.col("page").isNull()
    error = F.when(nameless, "not named run-<id>/page-<n>.json").otherwise(page_fault("value"))
    folder = f"{_rejects_of(store)}/batch={name}"
    batch.select(
        F.lit(attempt).alias("attempt"), "file", "run_id", "page", "modified", error.alias("error")
    ).filter("error is not null").write.mode("overwrite").parquet(folder)
    rejected = batch.sparkSession.read.schema(_REJECTS).parquet(folder).select("file")
    sound = batch.join(rejected, "file", "left_anti")

    position = ["run_id", "page", "modified"]
    games = game_rows(sound, keep=position)
    empty = sound.filter(F.json_object_keys("value") == F.array()).select(*position)
    rows = games.unionByName(empty, allowMissingColumns=True)
    rows = rows.withColumnRenamed("modified", "loaded_at")
    # by run, so that work on the open run does not read the finished ones
    rows.write.mode("overwrite").partitionBy("run_id").parquet(f"{store}/batch={name}")


def replay_rejects(spark: SparkSession, store: str, files_per_batch: int = 1000) -> None:
    """Load the open rejects whose files have changed since; those still broken stay rejects.

    A reject whose file is gone is closed: the ledger shows its page as missing. Like a batch of
    the stream, a replay that was cut off is done again.
    """
    for name in paths.children(spark, store):
        if name.startswith(f"batch={_AGAIN}") and not paths.exists(spark, f"{store}/{name}/_SUCCESS"):
            paths.delete(spark, f"{store}/{name}")
    last = ""
    while True:
        some = open_rejects(spark, store).filter(F.col("file") > last).orderBy("file").limit(files_per_batch)
        found = some.select("file", "modified").collect()  # names of one batch of files
        if not found:
            return
        last = found[-1]["file"]
        there = [r for r in found if paths.exists(spark, unquote(r["file"]))]
        gone = [(r["file"],) for r in found if r not in there]
        attempt = 1 + len(paths.children(spark, _rejects_of(store)))
        if gone:
            closed = spark.createDataFrame(gone, "file string").withColumn("attempt", F.lit(attempt))
            closed.write.mode("overwrite").parquet(f"{_rejects_of(store)}/batch=gone-{attempt}")
        if there:
            tried = spark.createDataFrame([tuple(r) for r in there], "file string, tried timestamp_ntz")
            documents = read_documents(spark, [unquote(r["file"]) for r in there])
            changed = documents.join(tried, "file").filter("modified <> tried").drop("tried")
            if not changed.select("file").isEmpty():
                _commit(changed.withColumns(page_position("file")), store, f"{_AGAIN}{attempt}", attempt)


def open_rejects(spark: SparkSession, store: str) -> DataFrame:
    """``(file, run_id, page, modified, error)`` of rejected pages that the store does not have since."""
    tried = read_optional(spark, _rejects_of(store), _REJECTS)
    last = F.max_by(F.struct("run_id", "page", "modified", "error"), "attempt").alias("last")
    latest = tried.groupBy("file").agg(last).select("file", "last.*").filter("error is not null")
    if not paths.exists(spark, store):
        return latest
    return latest.join(read_store(spark, store).select("run_id", "page").distinct(), ["run_id", "page"], "left_anti").select(
        "file", "run_id", "page", "modified", "error"
    )


def read_store(spark: SparkSession, store: str) -> DataFrame:
    columns = RAW_TABLES["games_catalog"].schema()
    # declared, as a store whose pages were all rejected has no files
    declared = T.StructType([*columns.fields, *T.StructType.fromDDL("page int, seq int, batch string, run_id bigint").fields])
    return spark.read.schema(declared).parquet(store).drop("batch")


def current_catalog(stored: DataFrame) -> DataFrame:
    """The latest row of each game: a game seen on two pages keeps the later one."""
    spec = RAW_TABLES["games_catalog"]
    games = stored.filter(F.col("appid").isNotNull())
    return last_per_group(games, spec.keys, _POSITION).select(*spec.columns)


def committed_pages(stored: DataFrame) -> DataFrame:
    return page_log(stored, item="appid")
