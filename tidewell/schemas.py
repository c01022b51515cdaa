"""Raw tables: column types, keys, defaults and freshness rules."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_GAME_COLUMNS = dict(
    appid="int",
    name="string",
    developer="string",
    publisher="string",
    positive_reviews="int",
    negative_reviews="int",
    owners="string",
    average_playtime_forever="int",
    average_playtime_2weeks="int",
    median_playtime_forever="int",
    median_playtime_2weeks="int",
    price_cents="int",
    initial_price_cents="int",
    discount_pct="int",
    concurrent_users="int",
    loaded_at="timestamp_ntz",
)


@dataclass(frozen=True)
class RawTable:
    """A keyed raw table and how fresh it has to be."""

    columns: dict[str, str]
    keys: tuple[str, ...]
    description: str
    defaults: dict[str, object] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    stamp: str = "loaded_at"
    warn_after: timedelta | None = timedelta(days=1)
    error_after: timedelta | None = timedelta(days=7)

    def schema(self) -> T.StructType:
        """Built on use: parsing a type string needs a running session."""
        return T.StructType.fromDDL(", ".join(f"{n} {t}" for n, t in self.columns.items()))


RAW_TABLES: dict[str, RawTable] = {
    "games": RawTable(
        _GAME_COLUMNS, ("appid",), "Most played games of the last two weeks, one row per game."
    ),
    "friends": RawTable(
        dict(
            steamid="string",
            personaname="string",
            profileurl="string",
            personastate="int",
            loaded_at="timestamp_ntz",
            is_self="boolean",
        ),
        ("steamid",),
        "Profiles of the configured user and their friends, one row per player.",
        defaults={"is_self": False},
        required=("is_self",),
    ),
    "player_owned_games": RawTable(
        dict(
            steamid="string",
            appid="int",
            name="string",
            playtime_forever="int",
            rtime_last_played="bigint",
            loaded_at="timestamp_ntz",
        ),
        ("steamid", "appid"),
        "Every game in every player's library; rtime_last_played 0 means unknown.",
    ),
    "player_recent_games": RawTable(
        dict(
            steamid="string",
            appid="int",
            name="string",
            playtime_2weeks="int",
            playtime_forever="int",
            loaded_at="timestamp_ntz",
        ),
        ("steamid", "appid"),
        "Games each player played in the last two weeks.",
    ),
    "player_library_status": RawTable(
        dict(
            steamid="string",
            owned_visible="boolean",
            owned_game_count="int",
            recent_visible="boolean",
            recent_game_count="int",
            loaded_at="timestamp_ntz",
        ),
        ("steamid",),
        "Whether each player's lists were visible; hidden is not the same as empty.",
        required=("owned_visible", "recent_visible"),
    ),
    "games_catalog": RawTable(
        _GAME_COLUMNS,
        ("appid",),
        "Full catalogue from the paged endpoint, one row per game.",
        warn_after=timedelta(days=8),
        error_after=timedelta(days=15),
    ),
    "catalog_runs": RawTable(
        dict(
            run_id="bigint",
            started_at="timestamp_ntz",
            finished_at="timestamp_ntz",
            last_page="int",
            games_loaded="int",
            list_size="int",
        ),
        ("run_id",),
        "One row per catalogue load; finished_at is NULL while a run is open.",
        defaults={"games_loaded": 0},
        required=("started_at", "games_loaded"),
        stamp="finished_at",
        warn_after=timedelta(days=8),
        error_after=timedelta(days=15),
    ),
}


def conform(df: DataFrame, table: str) -> DataFrame:
    """``df`` with the declared columns and types of ``table``.

    Columns that ``df`` lacks are added with the declared default, and NULLs in a
    defaulted column take that default: how a table gains a column later on.
    """
    spec = RAW_TABLES[table]
    return add_columns(df, spec.columns, spec.defaults).select(*spec.columns)


def add_columns(df: DataFrame, columns: dict[str, str], defaults: dict[str, object]) -> DataFrame:
    """Add the missing ones of ``columns``, cast all of them, and fill defaults."""
    out = {}
    for name, dtype in columns.items():
        c = F.col(name) if name in df.columns else F.lit(None)
        c = c.cast(dtype)
        if name in defaults:
            c = F.coalesce(c, F.lit(defaults[name]).cast(dtype))
        out[name] = c
    return df.withColumns(out)
