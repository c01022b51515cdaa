"""Jobs for spark-submit: ``python -m tidewell <job> ...``, see ``--help``."""

from __future__ import annotations

import argparse
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators import ledger, quality
from tidewell.plans import checks, loads
from tidewell.plans import daily as daily_marts
from tidewell.plans.models import materialize
from tidewell.session import session
from tidewell.sources import landed, paths, releases
from tidewell.streaming import pages


def _stamp(when: datetime) -> Column:
    return F.lit(when.isoformat(sep=" ")).cast("timestamp_ntz")


def _name(when: datetime) -> str:
    return when.strftime("%Y-%m-%d_%H%M%S")


def _state_name(spark: SparkSession, root: str, when: datetime) -> str:
    """A name after that of the newest state, which a build of the same or an earlier time may follow."""
    newest = (releases.release_names(spark, f"{root}/state") or [""])[-1]
    return _name(when) if _name(when) > newest else f"{newest}+"


def _tables(root: str) -> str:
    return f"{root}/tables"


def daily(
    spark: SparkSession,
    root: str,
    now: datetime,
    games: str | None = None,
    profiles: str | None = None,
    libraries: str | None = None,
    self_id: str | None = None,
) -> None:
    """Load the landed documents that are given, games first: they do not wait for players."""

    def top_list(tables: loads.Tables) -> loads.Tables:
        return loads.load_top_list(tables, landed.read_documents(spark, games), _stamp(now))

    def players(tables: loads.Tables) -> loads.Tables:
        changed: dict[str, DataFrame] = {}
        if profiles:
            documents = landed.read_documents(spark, profiles)
            changed |= loads.load_profiles(tables, documents, self_id, _stamp(now))
        if libraries:
            responses = landed.read_libraries(spark, libraries)
            changed |= loads.load_libraries(tables, responses, _stamp(now))
        return changed

    if games:
        loads.load_and_publish(spark, _tables(root), _name(now), top_list, _stamp(now))
    if profiles or libraries:
        loads.load_and_publish(spark, _tables(root), _name(now), players, _stamp(now))


def catalog(
    spark: SparkSession, root: str, now: datetime, landing: str, page_size: int = ledger.PAGE_SIZE
) -> None:
    """Load new catalogue pages of the open run and bring its ledger up to date.

    Pages that cannot be loaded are set aside; while there are some the job fails, after all
    others were loaded. They are tried again by the next job that finds their files changed.
    """
    store, checkpoint = f"{root}/pages", f"{root}/checkpoints/pages"
    pages.replay_rejects(spark, store)
    pages.stream_pages(spark, landing, store, checkpoint).awaitTermination()
    if not paths.exists(spark, store):
        return  # nothing has landed yet, the run stays open
    stored = pages.read_store(spark, store)
    loads.load_and_publish(
        spark, _tables(root), _name(now),
        lambda tables: loads.load_catalog(tables, stored, _stamp(now), page_size), _stamp(now),
    )
    rejects = pages.open_rejects(spark, store)
    first = rejects.orderBy("run_id", "page", "file").first()
    if first is not None:
        raise ValueError(f"{rejects.count()} pages could not be loaded, the first: {first['file']}: {first['error']}")


def start_run(spark: SparkSession, root: str, now: datetime, anew: bool = False) -> tuple[int, int, bool]:
    """Open a catalogue run, or find the one to resume: run id, next page, resumed.

    ``anew`` opens one even if another is open, such as one with a short page in the middle.
    """
    newest = (releases.release_names(spark, _tables(root)) or [None])[-1]
    tables = loads.current_tables(spark, _tables(root))
    point = ledger.resume_point(tables["catalog_runs"]).first()
    if anew or not point["resumed"]:
        changed = {"catalog_runs": ledger.start_run(tables["catalog_runs"], _stamp(now), anew)}
        # two runs opened at once would have one number, so the later one fails
        tables = loads.publish(spark, _tables(root), _name(now), changed, _stamp(now), newest)
        point = ledger.resume_point(tables["catalog_runs"]).first()
        return point["run_id"], point["next_page"], False
    return tuple(point)


def build(spark: SparkSession, root: str, now: datetime, **thresholds: float) -> None:
    """Store the marts, run every check, and fail if one of severity error found rows."""
    tables = loads.with_histories(loads.current_tables(spark, _tables(root)))
    kept = daily_marts.update(spark, f"{root}/state", _state_name(spark, root, now), tables["games_snapshot"])
    models = materialize(spark, tables, f"{root}/marts/{_name(now)}", kept)
    found = checks.check_results(models, checks.table_checks(**thresholds))
    results = f"{root}/results/{_name(now)}"
    found.write.mode("overwrite").parquet(f"{results}/checks")
    raw = {n: t for n, t in tables.items() if n in loads.RAW_TABLES}
    ages = checks.freshness_results(raw, _stamp(now))
    ages.write.mode("overwrite").parquet(f"{results}/freshness")
    checks.raise_on_errors(spark.read.parquet(f"{results}/checks"))


def report(spark: SparkSession, root: str, now: datetime) -> DataFrame:
    """Warnings of the build of that time; a result that was not written is skipped."""
    results = f"{root}/results/{_name(now)}"
    found = quality.read_optional(spark, f"{results}/checks", quality.RESULT_SCHEMA)
    ages = quality.read_optional(spark, f"{results}/freshness", quality.FRESHNESS_SCHEMA)
    return quality.warning_report(found, ages)


def export(spark: SparkSession, root: str, target: str, keep: int = 14) -> str:
    """Copy the newest release to another place and keep the newest ``keep`` copies."""
    name = releases.copy_release(spark, _tables(root), target)
    releases.prune_releases(spark, target, keep)
    return name


def prune(spark: SparkSession, root: str, keep: int = 14) -> list[str]:
    """Keep the newest releases, marts and results of the working folder; returns the releases that went."""
    old = releases.prune_releases(spark, _tables(root), keep)
    releases.prune_releases(spark, f"{root}/state", keep)
    for folder in (f"{root}/marts", f"{root}/results"):
        for name in paths.children(spark, folder)[:-keep]:
            paths.delete(spark, f"{folder}/{name}")
    return old


def restore(
    spark: SparkSession, root: str, now: datetime, source: str, name: str | None = None
) -> None:
    """Publish an exported release as the newest one; build the marts again afterwards."""
    exported = releases.read_release(spark, source, name)
    releases.write_release(exported, _tables(root), _name(now), carry=False)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tidewell")
    parser.add_argument("--root", required=True, help="folder of tables, marts and results")
    parser.add_argument("--now", type=datetime.fromisoformat, default=None, help="time of the run")
    jobs = parser.add_subparsers(dest="job", required=True)
    job = jobs.add_parser("daily", help=daily.__doc__)
    for option in ("--games", "--profiles", "--libraries", "--self-id"):
        job.add_argument(option)
    job = jobs.add_parser("catalog", help=catalog.__doc__)
    job.add_argument("--landing", required=True)
    job.add_argument("--page-size", type=int, default=ledger.PAGE_SIZE)
    job = jobs.add_parser("start-run", help=start_run.__doc__)
    job.add_argument("--anew", action="store_true")
    job = jobs.add_parser("build", help=build.__doc__)
    for option, default in checks.THRESHOLDS.items():
        job.add_argument("--" + option.replace("_", "-"), type=type(default), default=default)
    jobs.add_parser("report", help=report.__doc__)
    job = jobs.add_parser("export", help=export.__doc__)
    job.add_argument("--target", required=True)
    job.add_argument("--keep", type=int, default=14)
    job = jobs.add_parser("prune", help=prune.__doc__)
    job.add_argument("--keep", type=int, default=14)
    job = jobs.add_parser("restore", help=restore.__doc__)
    job.add_argument("--source", required=True)
    job.add_argument("--name")

    args = vars(parser.parse_args(argv))
    name, root = args.pop("job"), args.pop("root")
    spark = session()
    # the wall clock in the zone of the session, which also stamps landed files
    now = args.pop("now") or spark.sql("select localtimestamp()").first()[0]
    if name == "export":
        print(export(spark, root, **args))
    elif name == "prune":
        print(*prune(spark, root, **{k: v for k, v in args.items() if k == "keep"}))
    elif name == "report":
        for row in report(spark, root, now).toLocalIterator():
            print(row["warning"])
    elif name == "start-run":
        print(*start_run(spark, root, now, **args))
    else:
        {"daily": daily, "catalog": catalog, "build": build, "restore": restore}[name](
            spark, root, now, **args
        )


if __name__ == "__main__":
    main()
