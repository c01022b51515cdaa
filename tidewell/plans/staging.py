"""Staging models: typed, renamed and flagged views of the raw tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import (
    cents_to_dollars,
    decode,
    hours_between,
    range_bound,
    safe_ratio,
    zero_to_null,
)
from tidewell.operators.current import (
    latest_finished_start,
    latest_load_flag,
    since_boundary_flag,
)
from tidewell.operators.history import is_latest

# fixed values: profile status codes of the player API
PERSONA_STATES = {
    0: "offline",
    1: "online",
    2: "busy",
    3: "away",
    4: "snooze",
    5: "looking to trade",
    6: "looking to play",
}


def cleaned_game_columns() -> list[Column]:
    """Columns that the top list and the full catalogue share once cleaned."""
    reviews = F.col("positive_reviews").cast("bigint") + F.col("negative_reviews")
    minutes = {
        "avg_playtime_forever_minutes": "average_playtime_forever",
        "avg_playtime_2weeks_minutes": "average_playtime_2weeks",
        "median_playtime_forever_minutes": "median_playtime_forever",
        "median_playtime_2weeks_minutes": "median_playtime_2weeks",
    }
    return [
        F.col("appid"),
        F.col("name").alias("game_name"),
        F.col("developer"),
        F.col("publisher"),
        F.col("owners").alias("owners_bucket"),
        range_bound("owners", 1).alias("owners_min"),
        range_bound("owners", 2).alias("owners_max"),
        F.col("positive_reviews"),
        F.col("negative_reviews"),
        reviews.alias("total_reviews"),
        safe_ratio("positive_reviews", reviews).alias("positive_review_ratio"),
        *[zero_to_null(src).alias(name) for name, src in minutes.items()],
        cents_to_dollars("price_cents").alias("price_usd"),
        cents_to_dollars("initial_price_cents").alias("initial_price_usd"),
        F.col("discount_pct"),
        (F.col("price_cents") == 0).alias("is_free"),
        F.col("concurrent_users"),
    ]


def stg_games(games: DataFrame) -> DataFrame:
    """Every game that was ever in the top list, flagging those in the latest load."""
    flagged = latest_load_flag(games, "loaded_at", "is_in_latest_top100")
    return flagged.select(*cleaned_game_columns(), "is_in_latest_top100", "loaded_at")


def stg_catalog(games_catalog: DataFrame, catalog_runs: DataFrame) -> DataFrame:
    """Every catalogue game, flagging those written since the latest finished run began."""
    flagged = since_boundary_flag(
        games_catalog, "loaded_at", latest_finished_start(catalog_runs), "is_in_latest_catalog"
    )
    return flagged.select(*cleaned_game_columns(), "is_in_latest_catalog", "loaded_at")


def stg_runs(catalog_runs: DataFrame) -> DataFrame:
    return catalog_runs.select(
        "run_id",
        "started_at",
        "finished_at",
        F.col("finished_at").isNotNull().alias("is_finished"),
        (F.col("last_page") + 1).alias("pages_loaded"),
        "list_size",
        F.col("games_loaded").alias("games_upserted"),
        hours_between("started_at", "finished_at").alias("run_hours"),
    )


def stg_games_history(games_snapshot: DataFrame) -> DataFrame:
    """One row per game and load."""
    return games_snapshot.select(
        "appid",
        F.col("name").alias("game_name"),
        "concurrent_users",
        "positive_reviews",
        "negative_reviews",
        cents_to_dollars("price_cents").alias("price_usd"),
        "discount_pct",
        F.col("valid_from").alias("loaded_at"),
        F.to_date("valid_from").alias("snapshot_date"),
    )


def stg_playtime_history(player_games_snapshot: DataFrame) -> DataFrame:
    """One row per player, game and change of playtime."""
    return player_games_snapshot.select(
        F.col("steamid").alias("steam_id"),
        "appid",
        F.col("name").alias("game_name"),
        F.col("playtime_forever").alias("playtime_forever_minutes"),
        F.col("valid_from").alias("observed_at"),
        F.to_date("valid_from").alias("observed_date"),
        is_latest().alias("is_latest_version"),
    )


def stg_friends(friends: DataFrame) -> DataFrame:
    flagged = latest_load_flag(friends, "loaded_at", "is_current_friend")
    return flagged.select(
        F.col("steamid").alias("steam_id"),
        F.col("personaname").alias("persona_name"),
        F.col("profileurl").alias("profile_url"),
        F.col("personastate").alias("persona_state_code"),
        decode("personastate", PERSONA_STATES, "unknown").alias("persona_state"),
        "is_current_friend",
        "loaded_at",
    )
