"""All models with their inputs, and how they are stored."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidewell.plans import marts, staging


@dataclass(frozen=True)
class Model:
    build: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    stored: bool


def _view(build: Callable[..., DataFrame], *inputs: str) -> Model:
    return Model(build, inputs, stored=False)


def _table(build: Callable[..., DataFrame], *inputs: str) -> Model:
    return Model(build, inputs, stored=True)


# in an order in which inputs come first
MODELS: dict[str, Model] = {
    "stg_games": _view(staging.stg_games, "games"),
    "stg_catalog": _view(staging.stg_catalog, "games_catalog", "catalog_runs"),
    "stg_runs": _view(staging.stg_runs, "catalog_runs"),
    "stg_games_history": _view(staging.stg_games_history, "games_snapshot"),
    "stg_playtime_history": _view(staging.stg_playtime_history, "player_games_snapshot"),
    "stg_friends": _view(staging.stg_friends, "friends"),
    "game_rankings": _table(marts.game_rankings, "stg_games"),
    "publisher_summary": _table(marts.publisher_summary, "stg_games"),
    "game_daily_stats": _table(marts.game_daily_stats, "stg_games_history"),
    "game_freshness": _table(marts.game_freshness, "game_daily_stats"),
    "catalog_owners_distribution": _table(
        marts.catalog_owners_distribution, "stg_catalog", "stg_games"
    ),
    "catalog_coverage": _table(marts.catalog_coverage, "stg_runs", "stg_catalog"),
}


def build(tables: Mapping[str, DataFrame], *names: str) -> dict[str, DataFrame]:
    """The named models (all by default) and what they need, lazily, from raw tables."""
    wanted = set(names or MODELS)
    for name in reversed(MODELS):
        if name in wanted:
            wanted.update(i for i in MODELS[name].inputs if i in MODELS)
    out = dict(tables)
    for name, model in MODELS.items():
        if name in wanted:
            out[name] = model.build(*[out[i] for i in model.inputs])
    return {name: out[name] for name in MODELS if name in wanted}


def materialize(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    root: str,
    kept: Mapping[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Write every mart below ``root`` and register views for the staging models.

    Marts that are ``kept`` up to date elsewhere are taken from there as they are.

    Later models read the written marts, so each one is computed once. The daily series
    is laid out by day, which prunes a chart of a few days to their folders.
    """
    out = dict(tables)
    built = {}
    for name, model in MODELS.items():
        df = (kept or {}).get(name)
        if df is None:
            df = model.build(*[out[i] for i in model.inputs])
        if model.stored and name not in (kept or {}):
            path = f"{root}/{name}"
            writer = df.write.mode("overwrite")
            if name == "game_daily_stats":
                # few files per day, while a day too large for one task is still split
                writer = df.hint("rebalance", "snapshot_date").write.mode("overwrite")
                writer = writer.partitionBy("snapshot_date")
            writer.parquet(path)
            df = spark.read.schema(df.schema).parquet(path)
        df.createOrReplaceTempView(name)
        out[name] = built[name] = df
    return built
