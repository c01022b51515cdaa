"""Dashboard queries over the marts. Column names are the chart titles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _percent(part: Column, whole: Column) -> Column:
    """Percentage with one digit; NULL instead of a division by zero on no rows."""
    operand = "decimal(20,0)"
    ratio = part.cast(operand) * 100 / F.nullif(whole.cast(operand), F.lit(0))
    return F.round(ratio, 1)


def players_online(game_rankings: DataFrame) -> DataFrame:
    return game_rankings.agg(F.sum("concurrent_users").alias("players"))


def free_share(game_rankings: DataFrame) -> DataFrame:
    return game_rankings.agg(_percent(F.count_if("is_free"), F.count("*")).alias("pct_free"))


def discounted(game_rankings: DataFrame) -> DataFrame:
    return game_rankings.agg(F.count_if("is_discounted").alias("discounted"))


def top10_games(game_rankings: DataFrame) -> DataFrame:
    top = game_rankings.filter("ccu_rank <= 10").orderBy("ccu_rank")
    return top.select(
        F.col("game_name").alias("Game"), F.col("concurrent_users").alias("Concurrent players")
    )


def top10_publishers(publisher_summary: DataFrame) -> DataFrame:
    top = publisher_summary.filter("ccu_rank <= 10").orderBy("ccu_rank")
    return top.select(
        F.col("publisher").alias("Publisher"),
        F.col("total_concurrent_users").alias("Concurrent players"),
    )


def review_by_tier(game_rankings: DataFrame) -> DataFrame:
    """Mean review ratio per price tier, cheapest tier first and unknown prices last.

    The mean is a sum of 4-digit decimals over a count, so it is exact up to the
    final rounding.
    """
    tiers = game_rankings.groupBy("price_tier").agg(
        F.sum(F.col("positive_review_ratio").cast("decimal(18,4)")).alias("total"),
        F.count("positive_review_ratio").alias("n"),
        F.min("price_usd").alias("cheapest"),
    )
    mean = (F.col("total") * 100).cast("decimal(24,4)") / F.nullif(
        F.col("n").cast("decimal(13,0)"), F.lit(0)
    )
    return (
        tiers.select(
            F.col("price_tier").alias("Price tier"),
            F.round(mean, 1).alias("Average positive reviews (%)"),
            "cheapest",
        )
        .orderBy(F.col("cheapest").asc_nulls_last())
        .drop("cheapest")
    )


def games_by_tier(game_rankings: DataFrame) -> DataFrame:
    tiers = game_rankings.groupBy(F.col("price_tier").alias("Price tier"))
    return tiers.agg(F.count("*").alias("Games"))


def best_reviewed(game_rankings: DataFrame) -> DataFrame:
    best = game_rankings.filter("review_score_rank <= 10").orderBy("review_score_rank")
    return best.select(
        F.col("review_score_rank").alias("Rank"),
        F.col("game_name").alias("Game"),
        F.round(F.col("positive_review_ratio") * 100, 1).alias("Positive reviews (%)"),
        F.col("total_reviews").alias("Total reviews"),
        F.col("price_tier").alias("Price tier"),
    )


def ccu_trend(game_daily_stats: DataFrame, game_rankings: DataFrame) -> DataFrame:
    """Daily players of the games ranked in today's top 5.

    Ties can put any number of games there, so Spark chooses the join by size.
    """
    top = game_rankings.filter("ccu_rank <= 5").select("appid")
    days = game_daily_stats.join(top, "appid").orderBy("snapshot_date")
    return days.select(
        F.col("snapshot_date").alias("Date"),
        F.col("game_name").alias("Game"),
        F.col("concurrent_users").alias("Concurrent players"),
    )


def top_share(catalog_owners_distribution: DataFrame) -> DataFrame:
    share = _percent(F.sum("top100_owners_estimate"), F.sum("owners_estimate"))
    return catalog_owners_distribution.agg(share.alias("top100_share"))


def share_by_bucket(catalog_owners_distribution: DataFrame) -> DataFrame:
    return (
        catalog_owners_distribution.orderBy("owners_min")
        .select(
            F.col("owners_bucket").alias("Owners range"),
            F.round(F.col("share_of_games") * 100, 1).alias("Share of games (%)"),
            F.round(F.col("share_of_owners") * 100, 1).alias("Share of estimated owners (%)"),
        )
    )


CARDS = {
    "players_online": (players_online, ("game_rankings",)),
    "free_share": (free_share, ("game_rankings",)),
    "discounted": (discounted, ("game_rankings",)),
    "top10_games": (top10_games, ("game_rankings",)),
    "top10_publishers": (top10_publishers, ("publisher_summary",)),
    "review_by_tier": (review_by_tier, ("game_rankings",)),
    "games_by_tier": (games_by_tier, ("game_rankings",)),
    "best_reviewed": (best_reviewed, ("game_rankings",)),
    "ccu_trend": (ccu_trend, ("game_daily_stats", "game_rankings")),
    "top_share": (top_share, ("catalog_owners_distribution",)),
    "share_by_bucket": (share_by_bucket, ("catalog_owners_distribution",)),
}
