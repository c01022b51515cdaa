"""Typed rows from landed JSON documents.

Documents land as files, one response per file. A response holds one page of
items or one player's list, so a whole document per row is small.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions import optional_int

# fields of one game in a page document, as the API names and types them
GAME_FIELDS = (
    "appid int, name string, developer string, publisher string, positive int, negative int, "
    "owners string, average_forever int, average_2weeks int, median_forever int, "
    "median_2weeks int, price string, initialprice string, discount string, ccu int"
)

# raw column -> field, for the fields that must be present
GAME_REQUIRED = {
    "appid": "appid",
    "name": "name",
    "developer": "developer",
    "publisher": "publisher",
    "positive_reviews": "positive",
    "negative_reviews": "negative",
    "owners": "owners",
    "average_playtime_forever": "average_forever",
    "average_playtime_2weeks": "average_2weeks",
    "median_playtime_forever": "median_forever",
    "median_playtime_2weeks": "median_2weeks",
    "concurrent_users": "ccu",
}

# raw column -> text field that may be missing, null or empty
GAME_OPTIONAL = {
    "price_cents": "price",
    "initial_price_cents": "initialprice",
    "discount_pct": "discount",
}

PLAYER_FIELDS = "steamid string, personaname string, profileurl string, personastate int"
FRIENDS_DOCUMENT = "friendslist struct<friends: array<struct<steamid: string>>>"
OWNED_FIELDS = "appid int, name string, playtime_forever int, rtime_last_played bigint"
RECENT_FIELDS = "appid int, name string, playtime_2weeks int, playtime_forever int"

_STRICT = {"mode": "FAILFAST"}


def read_documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per landed file: ``value`` (its text), ``file`` and ``modified``."""
    return with_file(spark.read.option("wholetext", True).text(path))


def with_file(texts: DataFrame) -> DataFrame:
    return texts.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("modified"),
    )


def page_position(file: Column | str) -> dict[str, Column]:
    """Run and page numbers from a file name ``.../run-<id>/page-<n>.json``, NULL in other names."""
    c = F.col(file) if isinstance(file, str) else file
    return {
        "run_id": F.regexp_extract(c, r"run-(\d+)/", 1).try_cast("bigint"),
        "page": F.regexp_extract(c, r"page-(\d+)\.json$", 1).try_cast("int"),
    }


def _parse(json: Column | str, fields: str) -> Column:
    return F.from_json(json, T.StructType.fromDDL(fields), _STRICT)


def has_key(json: Column | str, key: str) -> Column:
    """Whether an object has a key at all, which a NULL value would not tell."""
    c = F.col(json) if isinstance(json, str) else json
    return F.coalesce(F.array_contains(F.json_object_keys(c), key), F.lit(False))


def _typed(
    objects: DataFrame,
    keep: Sequence[str],
    fields: str,
    required: Sequence[str],
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """Fields of the objects in ``__json`` and the names of required keys they lack.

    A key may be there with the value null. So keys are only looked at where a value is NULL,
    which keeps the second look at the text to the few rows that need it.

    An object is parsed inside a generator: projections and filters that were merged with
    the parsing would repeat it for every field they use.
    """
    names = F.array(*[F.lit(c) for c in required]).cast("array<string>")
    absent = F.array_except(names, F.json_object_keys("__json"))

    def row(value: Column) -> Column:
        columns = {c: value[c] for c in T.StructType.fromDDL(fields).fieldNames()}
        for c, default in (defaults or {}).items():
            not_given = value[c].isNull() & ~has_key("__json", c)
            columns[c] = F.when(not_given, F.lit(default)).otherwise(value[c])
        some_null = F.lit(False)
        for c in required:
            some_null = some_null | value[c].isNull()
        missing = F.when(some_null, absent).otherwise(F.array().cast("array<string>"))
        named = [v.alias(c) for c, v in columns.items()]
        return F.struct(*named, missing.alias("missing_fields"))

    return objects.select(*keep, F.inline(F.transform(F.array(_parse("__json", fields)), row)))


def map_entries(
    docs: DataFrame,
    json: str,
    fields: str,
    keep: Sequence[str] = (),
    required: Sequence[str] = (),
) -> DataFrame:
    """Rows of documents that map ids to objects: ``keep``, ``seq``, ``entry``, fields.

    ``seq`` is the position in the document and ``missing_fields`` names the ``required``
    keys that an object lacks. A document that is not such a map fails the job.
    """
    objects = map_values(docs, json, "string", keep, value="__json")
    return _typed(objects, [*keep, "seq", "entry"], fields, required)


def map_values(
    docs: DataFrame, json: str, dtype: str, keep: Sequence[str] = (), value: str = "value"
) -> DataFrame:
    """Rows of documents that map names to plain values of one type."""
    map_type = T.MapType(T.StringType(), T.DataType.fromDDL(dtype))
    parsed = F.from_json(F.col(json), map_type, _STRICT)
    return docs.select(*keep, F.posexplode(parsed).alias("seq", "entry", value))


def split_required(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that have all required keys, and the rest with the names they lack."""
    complete = F.size("missing_fields") == 0
    return rows.filter(complete).drop("missing_fields"), rows.filter(~complete)


def require(rows: DataFrame) -> DataFrame:
    """``rows``, failing the job on the first one that lacks a required key."""
    names = F.array_join("missing_fields", ", ")
    failure = F.raise_error(F.concat(F.lit("required field missing: "), names)).cast("boolean")
    # a filter, because an unused column would be pruned together with its check
    return rows.filter(F.when(F.size("missing_fields") == 0, True).otherwise(failure)).drop(
        "missing_fields"
    )


def game_rows(docs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Raw game columns from page documents; unused fields are dropped."""
    entries = require(map_entries(docs, "value", GAME_FIELDS, keep, list(GAME_REQUIRED.values())))
    out = {raw: F.col(name) for raw, name in GAME_REQUIRED.items()}
    out |= {raw: optional_int(name) for raw, name in GAME_OPTIONAL.items()}
    return entries.select(*keep, "seq", *[c.alias(raw) for raw, c in out.items()])


def page_fault(json: Column | str = "value") -> Column:
    """Why ``game_rows`` cannot load a page document, named by its first broken object, or NULL.

    A document is sound if it maps names to objects with all required keys, an id, and
    values and optional numbers that can be read.
    """
    fields = T.StructType.fromDDL(GAME_FIELDS).add("broken", "string")
    lenient = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"}
    names = F.array(*[F.lit(c) for c in GAME_REQUIRED.values()])
    text = F.col(json) if isinstance(json, str) else json
    objects = F.from_json(text, T.MapType(T.StringType(), T.StringType()))

    def fault(entry: Column) -> Column:
        keys = F.coalesce(F.json_object_keys(entry["value"]), F.array().cast("array<string>"))
        absent = F.array_except(names, keys)

        def reason(row: Column) -> Column:
            unread = row["broken"].isNotNull()
            for c in GAME_OPTIONAL.values():
                given = F.nullif(row[c], F.lit("")).isNotNull()
                unread = unread | (given & optional_int(row[c], strict=False).isNull())
            return (
                F.when(entry["value"].isNull() | row.isNull() | unread, "malformed")
                .when(F.size(absent) > 0, F.concat(F.lit("required field missing: "), F.array_join(absent, ", ")))
                .when(row["appid"].isNull(), "appid is NULL")
            )

        # bound by a lambda, so that an object is parsed once and not for each field
        parsed = F.transform(F.array(F.from_json(entry["value"], fields, lenient)), reason)
        return F.concat(entry["key"], F.lit(": "), F.get(parsed, F.lit(0)))

    found = F.filter(F.transform(F.map_entries(objects), fault), lambda x: x.isNotNull())
    return F.when(objects.isNull(), "not a map of objects").otherwise(F.get(found, F.lit(0)))


def friend_ids(docs: DataFrame, json: str = "value") -> DataFrame:
    return docs.select(F.inline(_parse(json, FRIENDS_DOCUMENT)["friendslist"]["friends"]))


def _each(df: DataFrame, keep: Sequence[str], position: Sequence[str], objects: Column) -> DataFrame:
    """A row per object in ``__json``; with ``position`` also that, and its place as ``seq``."""
    if not position:
        return df.select(*keep, F.explode(objects).alias("__json"))
    return df.select(*keep, *position, F.posexplode(objects).alias("seq", "__json"))


def _placed(position: Sequence[str]) -> list[str]:
    return [*position, "seq"] if position else []


def player_rows(
    docs: DataFrame,
    self_id: str | None = None,
    json: str = "value",
    position: Sequence[str] = (),
) -> DataFrame:
    """Profiles, flagging the configured user's own one; no ``self_id`` flags nobody.

    ``position`` names columns that order the documents; they and the place in the document
    (``seq``) are kept, so that the last of equal keys can be told.
    """
    response = _parse(json, "response struct<players: array<string>>")["response"]
    objects = _each(docs, [], position, response["players"])
    required = ["steamid", "personaname", "profileurl", "personastate"]
    players = require(_typed(objects, _placed(position), PLAYER_FIELDS, required))
    is_self = F.coalesce(F.col("steamid") == F.lit(self_id).cast("string"), F.lit(False))
    return players.withColumn("is_self", is_self)


LINE_POSITION = ("file", "block", "line")


def _games(json: str) -> Column:
    return _parse(json, "games array<string>")["games"]


def owned_game_rows(
    libraries: DataFrame,
    player: str = "steamid",
    json: str = "owned",
    position: Sequence[str] = (),
) -> DataFrame:
    """Owned games; the time last played is 0 where the API does not give it."""
    objects = _each(libraries, [player], position, _games(json))
    required, keep = ["appid", "playtime_forever"], [player, *_placed(position)]
    return require(_typed(objects, keep, OWNED_FIELDS, required, {"rtime_last_played": 0}))


def recent_game_rows(
    libraries: DataFrame,
    player: str = "steamid",
    json: str = "recent",
    position: Sequence[str] = (),
) -> DataFrame:
    objects = _each(libraries, [player], position, _games(json))
    required = ["appid", "playtime_2weeks", "playtime_forever"]
    return require(_typed(objects, [player, *_placed(position)], RECENT_FIELDS, required))


def read_libraries(spark: SparkSession, path: str) -> DataFrame:
    """Players' responses from JSON lines ``{"steamid": ..., "owned": {...}, "recent": {...}}``.

    The two responses stay text: whether they have a key at all is part of their meaning.
    ``file``, ``block`` and ``line`` order the lines: a task reads a block of one file in order.
    """
    fields = _parse("value", "steamid string, owned string, recent string")
    return spark.read.text(path).select(
        fields.alias("f"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    ).select("f.*", *LINE_POSITION)


def library_status(
    libraries: DataFrame,
    player: str = "steamid",
    owned: str = "owned",
    recent: str = "recent",
    position: Sequence[str] = (),
) -> DataFrame:
    """Visibility and number of games of both lists for every player, also hidden ones.

    A hidden list comes as an empty response without its count, an empty one has a
    count of 0. The counts are array sizes of the same row: no join, no shuffle.
    """

    def size(json: str) -> Column:
        return F.coalesce(F.array_size(_games(json)), F.lit(0))

    return libraries.select(
        player,
        *position,
        has_key(owned, "game_count").alias("owned_visible"),
        size(owned).alias("owned_game_count"),
        has_key(recent, "total_count").alias("recent_visible"),
        size(recent).alias("recent_game_count"),
    )


def status_summary(statuses: DataFrame) -> DataFrame:
    return statuses.agg(
        F.count("*").alias("players"),
        F.count_if(~F.col("owned_visible")).alias("hidden_libraries"),
        F.coalesce(F.sum("owned_game_count"), F.lit(0)).alias("owned_games"),
        F.coalesce(F.sum("recent_game_count"), F.lit(0)).alias("recent_games"),
    )
