"""Data checks. A check returns the rows that break it; no rows means it passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions import name_part, seconds_between, tail_parts
from tidewell.operators.keyed_order import SPLIT_FLOOR, KeyedOrder
from tidewell.sources import paths


def duplicates(df: DataFrame, columns: Sequence[str], name: str = "n") -> DataFrame:
    """Key values occurring more than once. A single NULL column is not a duplicate."""
    if len(columns) == 1:
        df = df.filter(F.col(columns[0]).isNotNull())
    return df.groupBy(*columns).agg(F.count("*").alias(name)).filter(F.col(name) > 1)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column, all columns in one pass; only columns that have some."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in columns])
    return counts.select(F.inline(pairs)).filter(F.col("nulls") > 0)


def unexpected_values(df: DataFrame, column: str, accepted: Sequence[object]) -> DataFrame:
    """Values outside the accepted list with their counts; NULL passes."""
    c = F.col(column)
    return df.filter(c.isNotNull() & ~c.isin(*accepted)).groupBy(column).agg(F.count("*").alias("n"))


def inverted_ranges(
    tables: Mapping[str, DataFrame], low: str, high: str, columns: Sequence[str]
) -> DataFrame:
    """Rows of any of the tables whose lower bound exceeds the upper one."""
    parts = [
        df.filter(F.col(low) > F.col(high)).select(F.lit(label).alias("source"), *columns)
        for label, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def more_rows_than(df: DataFrame, limit: int, name: str = "games") -> DataFrame:
    return df.agg(F.count("*").alias(name)).filter(F.col(name) > limit)


def truncated_run(runs: DataFrame, minimum: int = 10_000) -> DataFrame:
    """The newest finished run if its list is shorter than ``minimum``."""
    newest = runs.filter("is_finished").agg(F.max("run_id")).scalar()
    size = F.coalesce("list_size", "games_upserted")
    return runs.filter((F.col("run_id") == newest) & (size < minimum)).select(
        "run_id", "list_size", "games_upserted"
    )


def shares_off_one(df: DataFrame, shares: Mapping[str, str], tolerance: float = 0.01) -> DataFrame:
    """Sums of share columns if one strays from 1. NULL sums of an empty table pass."""
    sums = df.agg(*[F.sum(c).alias(n) for n, c in shares.items()])
    off = [F.abs(F.col(n) - 1) > F.lit(tolerance) for n in shares]
    return sums.filter(reduce(lambda a, b: a | b, off))


def inconsistent_streaks(df: DataFrame, key: str) -> DataFrame:
    """Streaks with more snapshots than days, or ending before they start."""
    return df.filter(
        (F.col("snapshots_unchanged") > F.col("days_unchanged"))
        | (F.col("last_snapshot_date") < F.col("unchanged_since"))
    ).select(key, "unchanged_since", "last_snapshot_date", "snapshots_unchanged", "days_unchanged")


def decreases(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    measure: str,
    floor: int = SPLIT_FLOOR,
) -> DataFrame:
    """Key, order and measure of rows whose measure is lower than on the key's previous row.

    Of identical rows only the first can be lower than the one before.
    """
    columns = list(dict.fromkeys([*keys, *order, measure]))
    rows = KeyedOrder.of(df.select(*columns), keys, order, floor, merge_copies=True)
    lower = F.col(measure) < F.col("previous_value")
    return rows.previous(previous_value=measure).filter(lower).rows()


def inconsistent_history(
    df: DataFrame,
    keys: Sequence[str],
    observed: str,
    latest: str,
    measure: str,
    floor: int = SPLIT_FLOOR,
) -> DataFrame:
    """Three kinds of broken history: a version that occurs twice, a key without
    exactly one current version, and a measure that went down. Versions of the same
    time are compared in the order of their measure, NULL first.

    The versions are first folded to one row per key and time, where copies are reduced. One pass over a
    key's times then finds all three: a measure can only go down from the highest of the time before
    to the lowest of this one, and the number of current versions is known on the last time.
    """
    folded = df.groupBy(*keys, observed).agg(
        F.count("*").alias("__versions"),
        F.count_if(latest).alias("__current"),
        F.count_if(F.isnull(measure)).alias("__unknown"),
        F.min(measure).alias("__lowest"),
        F.max(measure).alias("__highest"),
        F.lit(True).alias("__more"),
    )
    times = (
        KeyedOrder.of(folded, keys, [observed], floor, sized_by=df)
        .previous(__before="__highest")
        .running_sum("__total", "__current")
        .following(__next="__more")
        .rows()
    )
    problems = {
        "duplicate version": F.col("__versions") > 1,
        "not exactly one current version": F.isnull("__next") & (F.col("__total") != 1),
        "playtime went down": (F.col("__unknown") == 0) & (F.col("__lowest") < F.col("__before")),
    }
    found = F.filter(F.array(*[F.when(c, F.lit(p)) for p, c in problems.items()]), F.isnotnull)
    return times.select(*keys, F.explode(found).alias("problem"))


def low_coverage(coverage: DataFrame, minimum: float = 0.9) -> DataFrame:
    return coverage.filter(F.col("coverage") < F.lit(minimum)).select(
        "run_id", "list_size", "distinct_games", "coverage"
    )


def stale_share(
    freshness: DataFrame, max_days: int = 3, max_share: float = 0.5
) -> DataFrame:
    """Counts of stale and current keys if too many have not changed for long."""
    counts = freshness.filter("is_in_latest_snapshot").agg(
        F.count_if(F.col("days_unchanged") > max_days).alias("stale_games"),
        F.count("*").alias("games"),
    )
    return counts.filter(F.col("stale_games") > F.lit(max_share) * F.col("games"))


def source_freshness(
    sources: Mapping[str, tuple[DataFrame, str, timedelta | None, timedelta | None]], as_of: Column
) -> DataFrame:
    """Age and status per source from ``name -> (table, stamp, warn after, error after)``."""
    parts = []
    for name, (df, stamp, warn, error) in sources.items():
        newest = df.agg(F.max(stamp).cast("timestamp_ntz").alias("max_loaded_at"))
        # an aggregate always gives one row, also for an empty table
        parts.append(
            newest.select(
                F.lit(name).alias("source"),
                "max_loaded_at",
                _seconds(warn).alias("warn_s"),
                _seconds(error).alias("error_s"),
            )
        )
    all_sources = reduce(DataFrame.unionByName, parts)
    age = seconds_between("max_loaded_at", as_of.cast("timestamp_ntz")).cast("double")
    aged = all_sources.withColumn("age_s", age)
    status = (
        F.when(F.col("age_s").isNull() | (F.col("age_s") > F.col("error_s")), "error")
        .when(F.col("age_s") > F.col("warn_s"), "warn")
        .otherwise("pass")
    )
    return aged.select("source", "max_loaded_at", "age_s", status.alias("status"))


def _seconds(limit: timedelta | None) -> Column:
    return F.lit(None if limit is None else limit.total_seconds()).cast("double")


RESULT_SCHEMA = "unique_id string, status string, failures bigint, message string"
FRESHNESS_SCHEMA = "unique_id string, status string, max_loaded_at_time_ago_in_s double"


def warning_report(results: DataFrame, freshness: DataFrame) -> DataFrame:
    """One line per check or source that ended in ``warn``."""
    rows = F.concat(F.col("failures").cast("string"), F.lit(" rows"))
    message = F.nullif(F.col("message"), F.lit(""))
    detail = F.coalesce(rows, message, F.lit("warning"))
    tests = results.filter("status = 'warn'").select(
        F.concat(F.lit("test "), name_part("unique_id"), F.lit(": "), detail).alias("warning")
    )
    hours = F.bround(F.col("max_loaded_at_time_ago_in_s") / 3600, 0).cast("bigint").cast("string")
    sources = freshness.filter("status = 'warn'").select(
        F.concat(
            F.lit("source "), tail_parts("unique_id"), F.lit(": last loaded "), hours, F.lit(" hours ago")
        ).alias("warning")
    )
    return tests.unionByName(sources)


def read_optional(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Parquet at ``path``, or an empty table if nothing was written there."""
    declared = T.StructType.fromDDL(schema)
    if not paths.exists(spark, path):
        return spark.createDataFrame([], declared)
    return spark.read.schema(declared).parquet(path)
