"""The given tables in the shapes of the raw catalogue tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators.current import latest_finished_start
from tidewell.operators.history import versions_from_log
from tidewell.schemas import RAW_TABLES

LATEST_LOAD = "2026-01-06 09:00:00"
EARLIER_LOAD = "2026-01-05 09:00:00"


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _games(spark: SparkSession, sf_dir: str, loaded_at: Column) -> DataFrame:
    sold = (
        read(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(
            F.count_if(F.col("l_returnflag") == "N").alias("good"),
            F.count_if(F.col("l_returnflag") == "R").alias("bad"),
            F.sum("l_quantity").cast("bigint").alias("quantity"),
        )
    )
    key, size = F.col("p_partkey"), F.col("p_size")
    reviewed = key % 89 != 0

    def reviews(c: str) -> Column:
        return F.when(reviewed, F.coalesce(c, F.lit(0))).otherwise(0)

    def thousands(n: Column) -> Column:
        return F.format_number(n, 0)

    columns = {
        "appid": key,
        "name": F.col("p_name"),
        "developer": F.concat(F.lit("Dev#"), size.cast("string")),
        "publisher": F.col("p_brand"),
        "positive_reviews": reviews("good"),
        "negative_reviews": reviews("bad"),
        "owners": F.concat(thousands(size * 10000), F.lit(" .. "), thousands(size * 20000)),
        "average_playtime_forever": size % 4 * 30,
        "average_playtime_2weeks": size % 3 * 15,
        "median_playtime_forever": size % 5 * 20,
        "median_playtime_2weeks": size % 2 * 10,
        "price_cents": F.when(F.col("p_type") == "SMALL", F.lit(None))
        .when(F.col("p_type") == "PROMO", F.lit(0))
        .otherwise(key * 37 % 6000),
        "initial_price_cents": F.when(F.col("p_type") != "SMALL", key * 41 % 7000),
        "discount_pct": key % 4 * 10,
        "concurrent_users": F.when(key % 97 != 0, F.col("quantity")),
        "loaded_at": loaded_at,
    }
    types = RAW_TABLES["games"].columns
    parts = read(spark, sf_dir, "part").join(sold, "p_partkey", "left")
    return parts.select(*[c.cast(types[n]).alias(n) for n, c in columns.items()])


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = F.when(F.col("p_partkey") % 10 == 0, ntz(EARLIER_LOAD)).otherwise(ntz(LATEST_LOAD))
    return _games(spark, sf_dir, stamp)


def games_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = latest_finished_start(catalog_runs(spark, sf_dir))
    days = (F.col("p_partkey") % 5 - 2).cast("int")
    return _games(spark, sf_dir, start + F.make_dt_interval(days))


def month_run(c: str) -> Column:
    return (F.year(c) * 12 + F.month(c)).cast("bigint")


def catalog_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per month of orders; every seventh is open, some lack a list size."""
    months = (
        read(spark, sf_dir, "orders")
        .groupBy(month_run("o_orderdate").alias("run_id"))
        .agg(
            F.min("o_orderdate").alias("started_at"),
            F.max("o_orderdate").alias("last_at"),
            F.count("*").alias("n"),
        )
    )
    run = F.col("run_id")
    return months.select(
        "run_id",
        "started_at",
        F.when(run % 7 != 0, F.col("last_at")).alias("finished_at"),
        F.call_function("div", F.col("n"), F.lit(100)).cast("int").alias("last_page"),
        F.col("n").cast("int").alias("games_loaded"),
        F.when(run % 11 != 0, F.col("n") + run % 5).cast("int").alias("list_size"),
    )


def order_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as rows of 40 pages per monthly run."""
    return read(spark, sf_dir, "orders").select(
        month_run("o_orderdate").alias("run_id"),
        (F.col("o_orderkey") % 40).cast("int").alias("page"),
        "o_orderkey",
    )


def friends(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return read(spark, sf_dir, "customer").select(
        key.cast("string").alias("steamid"),
        F.col("c_name").alias("personaname"),
        F.concat(F.lit("https://example.com/id/"), key.cast("string")).alias("profileurl"),
        (F.col("c_nationkey") % 8).alias("personastate"),
        F.when(key % 6 == 0, ntz(EARLIER_LOAD)).otherwise(ntz(LATEST_LOAD)).alias("loaded_at"),
        (key == 0).alias("is_self"),
    )


def game_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as loads of games: one row per game and load."""
    value, user = F.col("value"), F.col("user_id")
    whole = F.floor(value).cast("int")
    return read(spark, sf_dir, "events").select(
        user.cast("int").alias("appid"),
        F.concat(F.lit("Game#"), user.cast("string")).alias("name"),
        F.when(F.col("event_type") != "error", whole % 2).alias("concurrent_users"),
        (F.lit(10) + user % 5).cast("int").alias("positive_reviews"),
        (whole % 2).alias("negative_reviews"),
        (F.floor(value * 100).cast("int") % 6000).alias("price_cents"),
        (F.col("event_id") % 4 * 10).cast("int").alias("discount_pct"),
        F.col("ts").alias("loaded_at"),
        "event_id",
    )


def playtime_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as observations of a player's time in a game (one game per event type)."""
    return read(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("steamid"),
        F.ascii("event_type").alias("appid"),
        F.col("event_type").alias("name"),
        F.floor("value").cast("int").alias("playtime_forever"),
        F.col("ts").alias("loaded_at"),
        "event_id",
    )


def shipped_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as a playtime history with faults of every kind."""
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("steam_id"),
        F.col("l_linenumber").alias("appid"),
        F.col("l_shipdate").alias("observed_at"),
        F.col("l_quantity").cast("int").alias("playtime_forever_minutes"),
        (F.col("l_linestatus") == "O").alias("is_latest_version"),
    )


def libraries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as players with library responses: hidden, empty or with games."""
    key = F.col("o_orderkey")

    def response(kind: Column, count: str, game) -> Column:
        n = (F.col("o_custkey") % 4 + 1).cast("int")
        games = F.transform(F.sequence(F.lit(1), n), game)
        full = F.to_json(F.struct(n.alias(count), games.alias("games")))
        return (
            F.when(kind == 0, F.lit("{}")).when(kind == 1, F.lit(f'{{"{count}": 0}}')).otherwise(full)
        )

    def appid(i: Column) -> Column:
        return (F.col("o_custkey") % 100000 * 10 + i).cast("int")

    def name(i: Column) -> Column:
        return F.when(i % 2 == 1, F.concat(F.lit("Game "), i.cast("string")))

    def owned(i: Column) -> Column:
        seen = F.when(i % 3 == 0, F.lit(1790500000) + i)
        return F.struct(
            appid(i).alias("appid"),
            name(i).alias("name"),
            (i * 60).alias("playtime_forever"),
            seen.alias("rtime_last_played"),
        )

    def recent(i: Column) -> Column:
        return F.struct(
            appid(i).alias("appid"),
            name(i).alias("name"),
            (i * 5).alias("playtime_2weeks"),
            (i * 60).alias("playtime_forever"),
        )

    return read(spark, sf_dir, "orders").select(
        key.cast("string").alias("steamid"),
        response(key % 3, "game_count", owned).alias("owned"),
        response((key + 1) % 3, "total_count", recent).alias("recent"),
    )


def game_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page document per part, with two games each."""
    key = F.col("p_partkey")

    def game(id_: Column) -> Column:
        price = (id_ % 6000).cast("string")
        return F.struct(
            id_.cast("int").alias("appid"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("developer"),
            F.col("p_brand").alias("publisher"),
            (id_ % 1000).cast("int").alias("positive"),
            (id_ % 100).cast("int").alias("negative"),
            F.lit("0 .. 20,000").alias("owners"),
            *[F.lit(0).alias(c) for c in ("average_forever", "average_2weeks", "median_forever")],
            F.col("p_size").alias("median_2weeks"),
            # given, empty or left out
            F.when(id_ % 3 == 0, price).when(id_ % 3 == 1, F.lit("")).alias("price"),
            price.alias("initialprice"),
            F.lit("0").alias("discount"),
            (id_ % 5000).cast("int").alias("ccu"),
            F.lit("unused").alias("score_rank"),
        )

    first, second = key, key + 1000000
    pages = F.create_map(
        first.cast("string"), game(first), second.cast("string"), game(second)
    )
    return read(spark, sf_dir, "part").select(
        key.alias("page"), F.to_json(pages).alias("value")
    )


def games_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions_from_log(game_log(spark, sf_dir), ["appid"], "loaded_at", tie="event_id")


def player_games_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions_from_log(
        playtime_log(spark, sf_dir),
        ["steamid", "appid"],
        "loaded_at",
        check=["playtime_forever"],
        tie="event_id",
    )
