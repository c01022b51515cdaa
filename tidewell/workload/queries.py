"""Named queries over the given tables, one or more per operator, model, card and check."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions import (
    cents_to_dollars,
    decode,
    hours_between,
    midpoint,
    optional_int,
    range_bound,
    redact_param,
    safe_ratio,
    zero_to_null,
)
from tidewell.operators import history, ledger, quality
from tidewell.operators.current import (
    latest_finished_start,
    latest_load_flag,
    since_boundary_flag,
)
from tidewell.operators.membership import membership_flag
from tidewell.operators.ranking import (
    RankBy,
    global_ranks,
    highest,
    last_per_group,
    share_of_total,
)
from tidewell.operators.streaks import (
    advance_streaks,
    late_keys,
    numbered_streaks,
    open_streaks,
    unchanged_for,
)
from tidewell.operators.upsert import upsert
from tidewell.plans.cards import CARDS
from tidewell.plans.marts import PRICE_TIERS, price_tier
from tidewell.plans.models import MODELS, build
from tidewell.plans.staging import PERSONA_STATES
from tidewell.schemas import add_columns
from tidewell.sources import landed
from tidewell.session import reusable
from tidewell.workload import tables as t

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register under the name of the function; ``_query`` sets it apart from the operator."""
    QUERIES[fn.__name__.removesuffix("_query")] = fn
    return fn


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for comparison with engines that divide in floating point."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


# ---------------------------------------------------------------- landed documents


@query
def json_map_explode(spark: SparkSession, sf: str) -> DataFrame:
    events = t.read(spark, sf, "events")
    return landed.map_values(events, "props", "int", ["event_id"], value="amount")


@query
def game_documents(spark: SparkSession, sf: str) -> DataFrame:
    return landed.game_rows(t.game_documents(spark, sf), keep=["page"]).drop("seq")


@query
def optional_int_query(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    text = F.when(kind == "click", "").when(
        kind != "error", F.floor("value").cast("int").cast("string")
    )
    loose = F.when(kind == "view", "n/a").otherwise(text)
    return t.read(spark, sf, "events").select(
        "event_id",
        optional_int(text).alias("amount"),
        optional_int(loose, strict=False).alias("loose_amount"),
    )


@query
def required_keys_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    name = F.when(F.col("event_type") != "error", F.col("event_type"))
    owner = F.when(F.col("event_id") % 5 != 0, F.col("user_id"))
    docs = t.read(spark, sf, "events").select(
        F.to_json(
            F.create_map(F.lit("x"), F.struct("event_id", name.alias("name"), owner.alias("owner")))
        ).alias("value")
    )
    fields = "event_id bigint, name string, owner bigint"
    rows = landed.map_entries(docs, "value", fields, required=["name", "owner"])
    good, bad = landed.split_required(rows)
    return good.select("event_id", F.lit("").alias("missing")).unionByName(
        bad.select("event_id", F.array_join("missing_fields", ",").alias("missing"))
    )


@query
def nested_array_inline(spark: SparkSession, sf: str) -> DataFrame:
    """Profiles from one response per turn, each with one to three players."""
    turns = t.read(spark, sf, "conversations")
    turn_id = F.concat_ws("-", "conv_id", "turn")

    def player(i: Column) -> Column:
        return F.struct(
            F.concat_ws("-", turn_id, i.cast("string")).alias("steamid"),
            F.col("text").alias("personaname"),
            F.col("role").alias("profileurl"),
            i.alias("personastate"),
        )

    players = F.transform(F.sequence(F.lit(0), (F.col("turn") % 3).cast("int")), player)
    response = F.struct(players.alias("players")).alias("response")
    docs = turns.select(F.to_json(F.struct(response)).alias("value"))
    return landed.player_rows(docs, self_id="0-0-0")


@query
def friend_id_list(spark: SparkSession, sf: str) -> DataFrame:
    """Ids from one friend list per customer, each naming three."""
    ids = F.transform(
        F.sequence(F.lit(0), F.lit(2)),
        lambda i: F.struct((F.col("c_custkey") * 3 + i).cast("string").alias("steamid")),
    )
    docs = t.read(spark, sf, "customer").select(
        F.to_json(F.struct(F.struct(ids.alias("friends")).alias("friendslist"))).alias("value")
    )
    return landed.friend_ids(docs)


@query
def json_key_visibility(spark: SparkSession, sf: str) -> DataFrame:
    return t.libraries(spark, sf).select(
        "steamid",
        landed.has_key("owned", "game_count").alias("owned_visible"),
        landed.has_key("recent", "total_count").alias("recent_visible"),
    )


@query
def owned_games(spark: SparkSession, sf: str) -> DataFrame:
    return landed.owned_game_rows(t.libraries(spark, sf))


@query
def recent_games(spark: SparkSession, sf: str) -> DataFrame:
    return landed.recent_game_rows(t.libraries(spark, sf))


@query
def library_status(spark: SparkSession, sf: str) -> DataFrame:
    return landed.library_status(t.libraries(spark, sf))


@query
def library_status_summary(spark: SparkSession, sf: str) -> DataFrame:
    return landed.status_summary(landed.library_status(t.libraries(spark, sf)))


@query
def redact_url_param(spark: SparkSession, sf: str) -> DataFrame:
    pages = t.read(spark, sf, "pages")
    return pages.select(
        "page_id",
        redact_param("url", "ref").alias("url"),
        redact_param("html", "page").alias("html"),
    )


# ---------------------------------------------------------------- keyed state


@query
def add_column_default(spark: SparkSession, sf: str) -> DataFrame:
    nation = t.read(spark, sf, "nation")
    customers = t.read(spark, sf, "customer").select(
        F.col("c_custkey").cast("int").alias("n_nationkey"),
        F.col("c_name").alias("n_name"),
        F.col("c_nationkey").alias("n_regionkey"),
        F.when(F.col("c_custkey") % 3 != 0, F.col("c_acctbal") > 0).alias("is_self"),
    )
    columns = dict(n_nationkey="int", n_name="string", n_regionkey="int", is_self="boolean")
    old, new = [add_columns(df, columns, {"is_self": False}) for df in (nation, customers)]
    return old.unionByName(new)


def _base_and_batch(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    orders = t.read(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    base = orders.filter("o_orderkey % 2 = 0 or o_orderkey % 3 <> 0").withColumn("loaded_at", t.ntz(t.EARLIER_LOAD))
    changed = orders.filter("o_orderkey % 3 = 0")
    first = changed.withColumns({"o_totalprice": F.col("o_totalprice") + 1, "seq": F.lit(0)})
    again = changed.withColumns({"o_orderstatus": F.lit("X"), "seq": F.lit(1)})
    return base, first.unionByName(again)


@query
def upsert_query(spark: SparkSession, sf: str) -> DataFrame:
    base, batch = _base_and_batch(spark, sf)
    once = batch.filter("seq = 0")
    return upsert(base, once, ["o_orderkey"], load_ts=t.ntz(t.LATEST_LOAD))


@query
def upsert_last_wins(spark: SparkSession, sf: str) -> DataFrame:
    base, batch = _base_and_batch(spark, sf)
    return upsert(base, batch, ["o_orderkey"], seq=["seq"], load_ts=t.ntz(t.LATEST_LOAD))


@query
def page_log_end(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.run_progress(ledger.page_log(t.order_pages(spark, sf)), page_size=5)


@query
def page_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Progress of runs of which every third lacks a page."""
    shift = ((F.col("run_id") % 3 == 0) & (F.col("page") >= 2)).cast("int")
    pages = t.order_pages(spark, sf).withColumn("page", F.col("page") + shift)
    return ledger.run_progress(ledger.page_log(pages), page_size=5)


@query
def page_progress(spark: SparkSession, sf: str) -> DataFrame:
    """Progress of runs in pages of five; some lack one order of the first page or all of the second."""
    run, k = F.col("run_id"), F.col("k")
    numbered = t.order_pages(spark, sf).withColumn(
        "k", F.row_number().over(Window.partitionBy("run_id").orderBy("o_orderkey"))
    )
    left = numbered.filter(~((run % 4 == 1) & (k == 4)) & ~((run % 4 == 2) & k.between(6, 10)))
    pages = left.withColumn("page", F.floor((k - 1) / 5).cast("int"))
    return ledger.run_progress(ledger.page_log(pages), page_size=5)


@query
def page_order(spark: SparkSession, sf: str) -> DataFrame:
    """Faults of the runs as they are: pages of five orders are missing, short, or behind a short one."""
    return ledger.page_faults(ledger.page_log(t.order_pages(spark, sf)), page_size=5)


@query
def run_ledger(spark: SparkSession, sf: str) -> DataFrame:
    pages = ledger.page_log(t.order_pages(spark, sf))
    return ledger.run_ledger(t.catalog_runs(spark, sf), pages, t.ntz(t.LATEST_LOAD), page_size=5)


@query
def resume_point(spark: SparkSession, sf: str) -> DataFrame:
    """The next step of an open ledger, and of one without open runs."""
    runs = t.catalog_runs(spark, sf)
    finished = runs.filter("finished_at is not null")
    return ledger.resume_point(runs).unionByName(ledger.resume_point(finished))


@query
def start_new_run(spark: SparkSession, sf: str) -> DataFrame:
    finished = t.catalog_runs(spark, sf).filter("finished_at is not null")
    return ledger.start_run(finished, t.ntz(t.LATEST_LOAD))


# ---------------------------------------------------------------- scalar functions


@query
def range_text_parse(spark: SparkSession, sf: str) -> DataFrame:
    return t.games(spark, sf).select(
        "appid",
        "owners",
        range_bound("owners", 1).alias("owners_min"),
        range_bound("owners", 2).alias("owners_max"),
        range_bound("name", 2, strict=False).alias("name_max"),
    )


@query
def range_midpoint(spark: SparkSession, sf: str) -> DataFrame:
    low, high = range_bound("owners", 1), range_bound("owners", 2)
    return t.games(spark, sf).select("appid", midpoint(low, high + F.col("appid")).alias("middle"))


@query
def review_ratio(spark: SparkSession, sf: str) -> DataFrame:
    total = F.col("positive_reviews").cast("bigint") + F.col("negative_reviews")
    ratio = safe_ratio("positive_reviews", total).alias("ratio")
    return plain(t.games(spark, sf).select("appid", total.alias("total_reviews"), ratio))


@query
def zero_to_null_query(spark: SparkSession, sf: str) -> DataFrame:
    names = ["average_playtime_forever", "average_playtime_2weeks"]
    lines = t.games(spark, sf).select("appid", *[zero_to_null(c).alias(c) for c in names])
    return lines


@query
def cents_to_dollars_query(spark: SparkSession, sf: str) -> DataFrame:
    games = t.games(spark, sf)
    return plain(games.select("appid", cents_to_dollars("price_cents").alias("price_usd")))


@query
def code_decode(spark: SparkSession, sf: str) -> DataFrame:
    state = decode("personastate", PERSONA_STATES, "unknown").alias("persona_state")
    return t.friends(spark, sf).select("steamid", "personastate", state)


@query
def price_tier_query(spark: SparkSession, sf: str) -> DataFrame:
    games = t.games(spark, sf).select(
        "appid",
        cents_to_dollars("price_cents").alias("price_usd"),
        (F.col("price_cents") == 0).alias("is_free"),
        (F.col("discount_pct") > 0).alias("is_discounted"),
    )
    return plain(games.withColumn("price_tier", price_tier()))


@query
def duration_hours(spark: SparkSession, sf: str) -> DataFrame:
    days = t.read(spark, sf, "events").groupBy("user_id", F.to_date("ts").alias("day"))
    spans = days.agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    hours = hours_between("first_ts", "last_ts").alias("hours")
    return plain(spans.select("user_id", "day", hours))


# ---------------------------------------------------------------- flags, joins, groups, ranks


@query
def latest_load_flag_query(spark: SparkSession, sf: str) -> DataFrame:
    flagged = latest_load_flag(t.read(spark, sf, "orders"), "o_orderdate", "is_latest")
    return flagged.select("o_orderkey", "is_latest")


@query
def current_by_run(spark: SparkSession, sf: str) -> DataFrame:
    boundary = latest_finished_start(t.catalog_runs(spark, sf))
    lines = t.read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return since_boundary_flag(lines, "l_shipdate", boundary, "is_current")


@query
def membership_join(spark: SparkSession, sf: str) -> DataFrame:
    lines = t.read(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_shipdate"
    )
    urgent = t.read(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'")
    return membership_flag(lines, urgent, ["o_orderkey"], "is_urgent", unique=False)


@query
def share_of_total_query(spark: SparkSession, sf: str) -> DataFrame:
    orders = t.read(spark, sf, "orders")
    share = share_of_total("orders", orders.agg(F.count("*")))
    counts = orders.groupBy("o_custkey").agg(F.count("*").alias("orders"))
    return plain(counts.withColumn("share", share))


@query
def filtered_agg(spark: SparkSession, sf: str) -> DataFrame:
    quantity = F.when(F.col("l_returnflag") == "R", F.col("l_quantity").cast("bigint"))
    return (
        t.read(spark, sf, "lineitem")
        .groupBy("l_suppkey", "l_linestatus")
        .agg(
            F.count("*").alias("lines"),
            F.count_if(F.col("l_returnflag") == "R").alias("returned"),
            F.coalesce(F.sum(quantity), F.lit(0)).alias("returned_quantity"),
        )
    )


@query
def argmax_per_group(spark: SparkSession, sf: str) -> DataFrame:
    games = t.games(spark, sf).groupBy("publisher")
    return games.agg(highest("name", by="concurrent_users", tie="appid").alias("top_game"))


@query
def global_rank(spark: SparkSession, sf: str) -> DataFrame:
    lines = t.read(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        F.nullif(F.col("l_quantity"), F.lit(1.0)).alias("quantity"),
    )
    return global_ranks(
        lines,
        {
            "price_rank": RankBy("l_extendedprice"),
            "quantity_rank": RankBy("quantity", nulls="last"),
            "quantity_rank_nulls_first": RankBy("quantity", nulls="first"),
        },
    )


@query
def daily_last(spark: SparkSession, sf: str) -> DataFrame:
    events = t.read(spark, sf, "events").withColumn("day", F.to_date("ts"))
    return last_per_group(events, ["user_id", "day"], ["ts", "event_id"])


@query
def last_unstamped(spark: SparkSession, sf: str) -> DataFrame:
    """The last event of each user where errors have no stamp, which counts as newest."""
    events = t.read(spark, sf, "events").select(
        "user_id", "event_id", "event_type", F.expr("CASE WHEN event_type <> 'error' THEN ts END").alias("stamp")
    )
    return last_per_group(events, ["user_id"], ["stamp", "event_id"], nulls="highest")


@query
def streaks(spark: SparkSession, sf: str) -> DataFrame:
    events = t.read(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    return numbered_streaks(events, "user_id", ["ts", "event_id"], ["event_type"])


# ---------------------------------------------------------------- history


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return t.read(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value")


_VERSION = ["user_id", "event_type", "value", "valid_from", "valid_to", "scd_id"]


@query
def scd2_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    versions = history.versions_from_log(_events(spark, sf), ["user_id"], "ts", tie="event_id")
    return versions.select(*_VERSION)


@query
def scd2_check(spark: SparkSession, sf: str) -> DataFrame:
    versions = history.versions_from_log(
        _events(spark, sf), ["user_id"], "ts", check=["event_type"], tie="event_id"
    )
    return versions.select(*_VERSION).withColumn("is_latest", history.is_latest())


def _before_and_after(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    events = _events(spark, sf)
    # one user in 25 is new in the source and one has vanished from it
    early = events.filter("ts < timestamp_ntz'2024-01-16' and user_id % 25 <> 3")
    late = events.filter("user_id % 25 <> 4")
    past = history.versions_from_log(early, ["user_id"], "ts", check=["event_type"], tie="event_id")
    source = last_per_group(late, ["user_id"], ["ts", "event_id"])
    return past.drop("event_id", "ts"), source.drop("event_id")


@query
def scd2_apply(spark: SparkSession, sf: str) -> DataFrame:
    past, source = _before_and_after(spark, sf)
    after = history.apply_snapshot(
        past,
        source.drop("ts"),
        ["user_id"],
        check=["event_type"],
        taken_at=t.ntz(t.LATEST_LOAD),
    )
    return after.select(*_VERSION)


@query
def scd2_apply_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    past, source = _before_and_after(spark, sf)
    past = past.withColumn("ts", F.col("valid_from"))
    return history.apply_snapshot(past, source, ["user_id"], updated_at="ts").select(*_VERSION)


# ---------------------------------------------------------------- hot keys

# rows from which a key counts as hot here, far below the usual bound
_FLOOR = 100


def _crowded_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events, those of every third user under one key."""
    user = F.when(F.col("user_id") % 3 == 0, 0).otherwise(F.col("user_id"))
    return _events(spark, sf).withColumn("user_id", user)


@query
def streaks_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Freshness from the first half of the days, then the other half, then rows that come late."""
    at, watched = ("appid", "game_name", "snapshot_date"), ["concurrent_users", "total_reviews"]
    daily = reusable(models(spark, sf, "game_daily_stats")["game_daily_stats"].select(*at, *watched))
    first, last = daily.agg(F.min("snapshot_date"), F.max("snapshot_date")).first()
    half = F.lit(first + (last - first) / 2)
    late = (F.col("appid") % 5 == 0) & (F.dayofmonth("snapshot_date") % 3 == 0)
    state = open_streaks(daily.filter((F.col("snapshot_date") <= half) & ~late), *at, watched)
    state = advance_streaks(state, daily.filter((F.col("snapshot_date") > half) & ~late), *at, watched)
    fresh = daily.filter(late)
    series = daily.join(late_keys(state, fresh, "appid", "snapshot_date"), "appid", "left_semi")
    return unchanged_for(advance_streaks(state, fresh, *at, watched, series), "appid", "game_name")


@query
def streaks_split(spark: SparkSession, sf: str) -> DataFrame:
    """Streaks with a hot key, in the order of months and then of ids: few stamps, many ties."""
    events = _crowded_events(spark, sf).select(
        "user_id", F.trunc("ts", "month").alias("month"), "event_id", "event_type"
    )
    return numbered_streaks(events, "user_id", ["month", "event_id"], ["event_type"], floor=_FLOOR)


@query
def scd2_check_split(spark: SparkSession, sf: str) -> DataFrame:
    versions = history.versions_from_log(
        _crowded_events(spark, sf), ["user_id"], "ts", check=["event_type"], tie="event_id", floor=_FLOOR
    )
    return versions.select(*_VERSION)


@query
def membership_split(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the supplier has money, where one supplier has a third of the lines."""
    supplier = F.when(F.col("l_suppkey") % 3 == 0, 1).otherwise(F.col("l_suppkey"))
    lines = t.read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", supplier.alias("s_suppkey"))
    solvent = t.read(spark, sf, "supplier").filter("s_acctbal > 0")
    return membership_flag(lines, solvent, ["s_suppkey"], "is_solvent", unique=False, floor=_FLOOR)


# ---------------------------------------------------------------- models and cards

_RAW: dict[str, Query] = {
    "games": t.games,
    "games_catalog": t.games_catalog,
    "catalog_runs": t.catalog_runs,
    "friends": t.friends,
    "games_snapshot": t.games_snapshot,
    "player_games_snapshot": t.player_games_snapshot,
}


def models(spark: SparkSession, sf: str, *names: str) -> dict[str, DataFrame]:
    """The named models and those below them, reading only the raw tables they need."""
    needed, todo = set(), list(names)
    while todo:
        name = todo.pop()
        if name in MODELS:
            todo += MODELS[name].inputs
        else:
            needed.add(name)
    return build({raw: _RAW[raw](spark, sf) for raw in needed}, *names)


def _model_query(name: str) -> Query:
    return lambda spark, sf: plain(models(spark, sf, name)[name])


def _card_query(name: str) -> Query:
    card, inputs = CARDS[name]

    def run(spark: SparkSession, sf: str) -> DataFrame:
        marts = models(spark, sf, *inputs)
        return plain(card(*[marts[i] for i in inputs]))

    return run


# shorter names of some models
_SHORT = {
    "stg_games_history": "stg_history",
    "game_daily_stats": "daily_stats",
    "catalog_owners_distribution": "owners_distribution",
    "catalog_coverage": "coverage",
}

for _name in MODELS:
    QUERIES[_SHORT.get(_name, _name)] = _model_query(_name)
for _name in CARDS:
    QUERIES[f"card_{_name}"] = _card_query(_name)


# ---------------------------------------------------------------- checks


@query
def qa_unique(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicates(t.read(spark, sf, "lineitem"), ["l_orderkey"])


@query
def qa_composite_unique(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicates(t.read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "rows")


@query
def qa_not_null(spark: SparkSession, sf: str) -> DataFrame:
    return quality.null_counts(
        t.games(spark, sf), ["appid", "price_cents", "concurrent_users", "loaded_at"]
    )


@query
def qa_accepted_values(spark: SparkSession, sf: str) -> DataFrame:
    stg = models(spark, sf, "stg_friends")["stg_friends"]
    return quality.unexpected_values(stg, "persona_state", list(PERSONA_STATES.values()))


@query
def qa_accepted_tiers(spark: SparkSession, sf: str) -> DataFrame:
    ranked = models(spark, sf, "game_rankings")["game_rankings"]
    return quality.unexpected_values(ranked, "price_tier", PRICE_TIERS[:3])


@query
def qa_range_valid(spark: SparkSession, sf: str) -> DataFrame:
    """Owner ranges of two tables after every seventh game's range was swapped."""
    both = models(spark, sf, "stg_games", "stg_catalog")
    swapped = F.col("appid") % 7 == 0

    def faulty(df: DataFrame) -> DataFrame:
        return df.select(
            "appid",
            "owners_bucket",
            F.when(swapped, F.col("owners_max")).otherwise(F.col("owners_min")).alias("owners_min"),
            F.when(swapped, F.col("owners_min")).otherwise(F.col("owners_max")).alias("owners_max"),
        )

    return quality.inverted_ranges(
        {"top100": faulty(both["stg_games"]), "catalog": faulty(both["stg_catalog"])},
        "owners_min",
        "owners_max",
        ["appid", "owners_bucket", "owners_min", "owners_max"],
    )


@query
def qa_max_rows(spark: SparkSession, sf: str) -> DataFrame:
    games = models(spark, sf, "stg_games")["stg_games"].filter("is_in_latest_top100")
    return quality.more_rows_than(games, 100)


@query
def qa_not_truncated(spark: SparkSession, sf: str) -> DataFrame:
    return quality.truncated_run(models(spark, sf, "stg_runs")["stg_runs"], 10_000)


@query
def qa_shares_sum(spark: SparkSession, sf: str) -> DataFrame:
    """Shares of a mart where those of even buckets count twice."""
    mart = models(spark, sf, "catalog_owners_distribution")["catalog_owners_distribution"]
    shares = {"games": "share_of_games", "owners": "share_of_owners"}
    times = F.when(F.col("owners_min") % 20000 == 0, 2).otherwise(1)
    wrong = mart.withColumns({c: F.col(c) * times for c in shares.values()})
    return plain(quality.shares_off_one(wrong, shares))


@query
def qa_streaks(spark: SparkSession, sf: str) -> DataFrame:
    """Streaks after two days were taken off every span."""
    mart = models(spark, sf, "game_freshness")["game_freshness"]
    short = mart.withColumn("days_unchanged", F.col("days_unchanged") - 2)
    return quality.inconsistent_streaks(short, "appid")


@query
def qa_monotone(spark: SparkSession, sf: str) -> DataFrame:
    events = t.read(spark, sf, "events").select("user_id", "ts", "event_id", "value")
    return quality.decreases(events, ["user_id"], ["ts", "event_id"], "value")


@query
def qa_history_consistent(spark: SparkSession, sf: str) -> DataFrame:
    return quality.inconsistent_history(
        t.shipped_history(spark, sf),
        ["steam_id", "appid"],
        "observed_at",
        "is_latest_version",
        "playtime_forever_minutes",
    )


@query
def qa_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Coverage of every run by the orders of its customers, warned about below 0.999."""
    runs = models(spark, sf, "stg_runs")["stg_runs"]
    seen = t.order_pages(spark, sf).groupBy("run_id").agg(F.count("*").alias("distinct_games"))
    coverage = runs.join(seen, "run_id").select(
        "run_id",
        "list_size",
        "distinct_games",
        safe_ratio("distinct_games", "list_size").alias("coverage"),
    )
    return plain(quality.low_coverage(coverage, 0.999))


@query
def qa_stale_share(spark: SparkSession, sf: str) -> DataFrame:
    mart = models(spark, sf, "game_freshness")["game_freshness"]
    return quality.stale_share(mart, max_days=1, max_share=0.05)


def _sources(spark: SparkSession, sf: str) -> dict:
    day = timedelta(days=1)
    return {
        "raw.games": (t.games(spark, sf), "loaded_at", day, 7 * day),
        "raw.orders": (t.read(spark, sf, "orders"), "o_orderdate", 8 * day, 15 * day),
        "raw.events": (t.read(spark, sf, "events"), "ts", 700 * day, 800 * day),
        "raw.lineitem": (t.read(spark, sf, "lineitem"), "l_shipdate", None, None),
    }


_AS_OF = "2026-01-06 20:30:00"


@query
def source_freshness(spark: SparkSession, sf: str) -> DataFrame:
    return quality.source_freshness(_sources(spark, sf), t.ntz(_AS_OF))


@query
def qa_warning_report(spark: SparkSession, sf: str) -> DataFrame:
    """Lines for parts as test results and sources in state warn."""
    size = F.col("p_size")
    results = t.read(spark, sf, "part").select(
        F.concat(F.lit("test.shop.part_"), F.col("p_partkey").cast("string"), F.lit(".x")).alias(
            "unique_id"
        ),
        F.when(size % 3 == 0, "warn").when(size % 3 == 1, "pass").otherwise("fail").alias("status"),
        F.when(size % 2 == 0, size.cast("bigint")).alias("failures"),
        F.when(size % 5 != 0, F.col("p_name")).alias("message"),
    )
    freshness = quality.source_freshness(_sources(spark, sf), t.ntz(_AS_OF)).select(
        F.concat(F.lit("source.shop."), F.col("source")).alias("unique_id"),
        "status",
        F.col("age_s").alias("max_loaded_at_time_ago_in_s"),
    )
    return quality.warning_report(results, freshness)
