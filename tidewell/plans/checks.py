"""The checks of every model and how to run them."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators import quality
from tidewell.plans.marts import PRICE_TIERS
from tidewell.plans.staging import PERSONA_STATES
from tidewell.schemas import RAW_TABLES

ERROR, WARN = "error", "warn"


@dataclass(frozen=True)
class ColumnChecks:
    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    accepted: Mapping[str, tuple[str, ...]] = field(default_factory=dict)


COLUMN_CHECKS: dict[str, ColumnChecks] = {
    "stg_games": ColumnChecks(
        ("appid",), ("appid", "game_name", "owners_min", "owners_max", "is_in_latest_top100")
    ),
    "stg_catalog": ColumnChecks(
        ("appid",), ("appid", "owners_min", "owners_max", "is_in_latest_catalog")
    ),
    "stg_runs": ColumnChecks(("run_id",), ("run_id",)),
    "stg_playtime_history": ColumnChecks((), ("steam_id", "appid", "observed_at")),
    "stg_games_history": ColumnChecks((), ("appid", "snapshot_date")),
    "stg_friends": ColumnChecks(
        ("steam_id",),
        ("steam_id", "is_current_friend"),
        {"persona_state": tuple(PERSONA_STATES.values())},
    ),
    "game_rankings": ColumnChecks(
        ("appid",), ("appid", "ccu_rank", "review_score_rank"), {"price_tier": PRICE_TIERS}
    ),
    "publisher_summary": ColumnChecks(("publisher",), ("publisher",)),
    "game_daily_stats": ColumnChecks((), ("appid", "snapshot_date")),
    "catalog_owners_distribution": ColumnChecks(
        ("owners_bucket",), ("owners_bucket", "owners_min")
    ),
    "catalog_coverage": ColumnChecks(("run_id",), ("run_id",)),
    "game_freshness": ColumnChecks(("appid",), ("appid", "unchanged_since")),
}


@dataclass(frozen=True)
class TableCheck:
    """A check returning offending rows, with the models it reads."""

    violations: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    severity: str = ERROR


#: Of the checks of whole tables; every one is an option of the build.
THRESHOLDS: dict[str, int | float] = {
    "min_catalog_games": 10_000,
    "min_catalog_coverage": 0.9,
    "max_days_unchanged": 3,
    "max_stale_share": 0.5,
    "max_ranked": 100,
}


def table_checks(
    min_catalog_games: int = THRESHOLDS["min_catalog_games"],
    min_catalog_coverage: float = THRESHOLDS["min_catalog_coverage"],
    max_days_unchanged: int = THRESHOLDS["max_days_unchanged"],
    max_stale_share: float = THRESHOLDS["max_stale_share"],
    max_ranked: int = THRESHOLDS["max_ranked"],
) -> dict[str, TableCheck]:
    """The checks of whole tables, with their thresholds."""
    owners = ["appid", "owners_bucket", "owners_min", "owners_max"]
    return {
        "owners_range_valid": TableCheck(
            lambda top, catalog: quality.inverted_ranges(
                {"top100": top, "catalog": catalog}, "owners_min", "owners_max", owners
            ),
            ("stg_games", "stg_catalog"),
        ),
        "rankings_at_most_100_games": TableCheck(
            lambda t: quality.more_rows_than(t, max_ranked), ("game_rankings",)
        ),
        "one_row_per_game_per_day": TableCheck(
            lambda t: quality.duplicates(t, ["appid", "snapshot_date"], "rows"),
            ("game_daily_stats",),
        ),
        "catalog_not_truncated": TableCheck(
            lambda t: quality.truncated_run(t, min_catalog_games), ("stg_runs",)
        ),
        "catalog_shares_sum_to_one": TableCheck(
            lambda t: quality.shares_off_one(
                t, {"games": "share_of_games", "owners": "share_of_owners"}
            ),
            ("catalog_owners_distribution",),
        ),
        "freshness_streaks_consistent": TableCheck(
            lambda t: quality.inconsistent_streaks(t, "appid"), ("game_freshness",)
        ),
        "playtime_history_is_consistent": TableCheck(
            lambda t: quality.inconsistent_history(
                t,
                ["steam_id", "appid"],
                "observed_at",
                "is_latest_version",
                "playtime_forever_minutes",
            ),
            ("stg_playtime_history",),
        ),
        "catalog_coverage": TableCheck(
            lambda t: quality.low_coverage(t, min_catalog_coverage), ("catalog_coverage",), WARN
        ),
        "stats_refreshing": TableCheck(
            lambda t: quality.stale_share(t, max_days_unchanged, max_stale_share),
            ("game_freshness",),
            WARN,
        ),
    }


def _result(check: str, severity: str, failures: Column) -> Column:
    status = F.when(failures == 0, "pass").otherwise("warn" if severity == WARN else "fail")
    return F.struct(
        F.lit(f"test.catalogue.{check}").alias("unique_id"),
        status.alias("status"),
        failures.cast("bigint").alias("failures"),
        F.lit(None).cast("string").alias("message"),
    )


def _column_results(name: str, df: DataFrame, checks: ColumnChecks) -> list[DataFrame]:
    """NULL checks of a table in one pass, then a pass per grouped check."""
    nulls = [F.count_if(F.col(c).isNull()).alias(c) for c in checks.not_null]
    results = [_result(f"not_null_{name}_{c}", ERROR, F.col(c)) for c in checks.not_null]
    parts = [df.agg(*nulls).select(F.inline(F.array(*results)))] if nulls else []
    # a duplicated or unexpected value is one failure however often it occurs
    grouped = {f"unique_{name}_{c}": quality.duplicates(df.select(c), [c]) for c in checks.unique}
    for c, values in checks.accepted.items():
        grouped[f"accepted_values_{name}_{c}"] = quality.unexpected_values(df, c, values)
    return parts + [_counted(check, ERROR, rows) for check, rows in grouped.items()]


def _counted(check: str, severity: str, violations: DataFrame) -> DataFrame:
    found = violations.agg(F.count("*").alias("n"))
    return found.select(F.inline(F.array(_result(check, severity, F.col("n")))))


def check_results(
    models: Mapping[str, DataFrame], checks: Mapping[str, TableCheck] | None = None
) -> DataFrame:
    """One row per check of the given models: id, status and number of failures."""
    parts = []
    for name, column_checks in COLUMN_CHECKS.items():
        if name in models:
            parts += _column_results(name, models[name], column_checks)
    for name, check in (table_checks() if checks is None else checks).items():
        if all(i in models for i in check.inputs):
            rows = check.violations(*[models[i] for i in check.inputs])
            parts.append(_counted(f"assert_{name}", check.severity, rows))
    return reduce(DataFrame.unionByName, parts)


class ChecksFailed(RuntimeError):
    pass


def raise_on_errors(results: DataFrame) -> None:
    """Fail after all checks ran if one with severity error found something."""
    failed = results.filter("status = 'fail'").orderBy("unique_id")
    names = [f"{r['unique_id']}: {r['failures']} rows" for r in failed.toLocalIterator()]
    if names:
        raise ChecksFailed("; ".join(names))


def freshness_results(tables: Mapping[str, DataFrame], as_of: Column) -> DataFrame:
    """Freshness of every raw table given, in the layout the warning report reads."""
    sources = {
        name: (tables[name], spec.stamp, spec.warn_after, spec.error_after)
        for name, spec in RAW_TABLES.items()
        if name in tables
    }
    return quality.source_freshness(sources, as_of).select(
        F.concat(F.lit("source.catalogue.raw."), F.col("source")).alias("unique_id"),
        "status",
        F.col("age_s").alias("max_loaded_at_time_ago_in_s"),
    )
