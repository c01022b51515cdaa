"""Mart models: the tables that dashboards and checks read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import midpoint, safe_ratio, tier
from tidewell.operators.membership import membership_flag
from tidewell.operators.ranking import (
    RankBy,
    global_ranks,
    highest,
    last_per_group,
    share_of_total,
)
from tidewell.operators.streaks import current_streaks

# fixed values: price tier labels, cheapest first
PRICE_TIERS = ("free", "under $10", "$10 to $30", "$30 and up", "unknown")


def price_tier() -> Column:
    return tier(
        "price_usd",
        bounds=[(10, PRICE_TIERS[1]), (30, PRICE_TIERS[2])],
        top=PRICE_TIERS[3],
        missing=PRICE_TIERS[4],
        leading=[(F.col("is_free"), PRICE_TIERS[0])],
    )


def game_rankings(stg_games: DataFrame) -> DataFrame:
    games = stg_games.filter("is_in_latest_top100").select(
        "appid",
        "game_name",
        "developer",
        "publisher",
        "owners_min",
        "owners_max",
        midpoint("owners_min", "owners_max").alias("owners_estimate"),
        "concurrent_users",
        "total_reviews",
        "positive_review_ratio",
        "price_usd",
        "initial_price_usd",
        "discount_pct",
        "is_free",
        (F.col("discount_pct") > 0).alias("is_discounted"),
        price_tier().alias("price_tier"),
        "loaded_at",
    )
    return global_ranks(
        games,
        {
            "ccu_rank": RankBy("concurrent_users", nulls="first"),
            "review_score_rank": RankBy("positive_review_ratio", nulls="last"),
        },
    )


def publisher_summary(stg_games: DataFrame) -> DataFrame:
    """Totals per publisher text. Co-publishers share one text, which is never split."""
    totals = (
        stg_games.filter("is_in_latest_top100")
        .groupBy("publisher")
        .agg(
            F.count("*").alias("game_count"),
            F.count_if("is_free").alias("free_game_count"),
            F.sum("concurrent_users").alias("total_concurrent_users"),
            F.sum("total_reviews").alias("total_reviews"),
            F.sum("positive_reviews").alias("__positive"),
            highest("game_name", by="concurrent_users", tie="appid").alias("top_game_by_ccu"),
        )
        .withColumn("positive_review_ratio", safe_ratio("__positive", "total_reviews"))
        .drop("__positive")
    )
    return global_ranks(totals, {"ccu_rank": RankBy("total_concurrent_users", nulls="first")})


def game_daily_stats(stg_games_history: DataFrame) -> DataFrame:
    """The last load of each game and day."""
    last = last_per_group(stg_games_history, ["appid", "snapshot_date"], ["loaded_at"], nulls="highest")
    reviews = F.col("positive_reviews").cast("bigint") + F.col("negative_reviews")
    return last.select(
        "appid",
        "snapshot_date",
        "game_name",
        "concurrent_users",
        "positive_reviews",
        "negative_reviews",
        reviews.alias("total_reviews"),
        safe_ratio("positive_reviews", reviews).alias("positive_review_ratio"),
        "price_usd",
        "discount_pct",
        (F.col("discount_pct") > 0).alias("is_discounted"),
    )


def game_freshness(game_daily_stats: DataFrame) -> DataFrame:
    """How long each game's numbers have not changed; the price does not count."""
    daily = game_daily_stats.select(
        "appid", "game_name", "snapshot_date", "concurrent_users", "total_reviews"
    )
    return current_streaks(
        daily, "appid", "game_name", "snapshot_date", ["concurrent_users", "total_reviews"]
    )


def catalog_owners_distribution(stg_catalog: DataFrame, stg_games: DataFrame) -> DataFrame:
    catalog = stg_catalog.filter("is_in_latest_catalog").select(
        "appid",
        "owners_bucket",
        "owners_min",
        "owners_max",
        midpoint("owners_min", "owners_max").alias("estimate"),
    )
    top = stg_games.filter("is_in_latest_top100")
    games = membership_flag(catalog, top, ["appid"], "in_top")
    buckets = games.groupBy("owners_bucket", "owners_min", "owners_max").agg(
        F.count("*").alias("game_count"),
        F.count_if("in_top").alias("top100_game_count"),
        F.sum("estimate").alias("owners_estimate"),
        F.coalesce(F.sum(F.when(F.col("in_top"), F.col("estimate"))), F.lit(0)).alias(
            "top100_owners_estimate"
        ),
    )
    # totals of the rows before grouping: partial sums only, no shuffle of groups
    return buckets.withColumns(
        {
            "share_of_games": share_of_total("game_count", catalog.agg(F.count("*"))),
            "share_of_owners": share_of_total("owners_estimate", catalog.agg(F.sum("estimate"))),
        }
    )


def catalog_coverage(stg_runs: DataFrame, stg_catalog: DataFrame) -> DataFrame:
    """How much of its list the latest finished run saw; no row before one finished."""
    newest = [F.col("started_at").desc_nulls_first(), F.col("run_id").desc()]
    latest = stg_runs.filter("is_finished").orderBy(*newest).limit(1)
    seen = stg_catalog.filter("is_in_latest_catalog").agg(F.count("*")).scalar()
    with_count = latest.withColumn("distinct_games", seen)
    return with_count.select(
        "run_id",
        "started_at",
        "finished_at",
        "run_hours",
        "pages_loaded",
        "list_size",
        "games_upserted",
        "distinct_games",
        (F.col("games_upserted") - F.col("distinct_games")).alias("duplicate_rows"),
        (F.col("list_size") - F.col("distinct_games")).alias("games_missed_estimate"),
        safe_ratio("distinct_games", "list_size").alias("coverage"),
    )
