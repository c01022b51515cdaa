import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidewell.sources import landed

# made-up games; two share their review ratio, two their player count
GAMES = [
    (11, "Harbor Lights", "Quay Works", "Tern House", 900, 100, "200,000 .. 500,000", "0", "0", "0", 5000),
    (22, "Moss & Iron", "Fen Studio", "Fen Studio", 30, 10, "20,000 .. 50,000", "799", "1599", "50", 120),
    (33, "Glass Orchard", "Two Pears", "Tern House", 450, 50, "200,000 .. 500,000", "3500", "3500", "0", 700),
    (44, "Paper Comet", "Ola North", "Ola North", 1, 3, "0 .. 20,000", "1000", "1250", "20", 0),
    (55, "Night Ferry", "Quay Works", "Quay Works", 2, 1, "0 .. 20,000", "250", "1000", "75", 700),
]
FIELDS = (
    "appid name developer publisher positive negative owners price initialprice discount ccu"
).split()


def game(row, **changes):
    out = dict(zip(FIELDS, row))
    out |= dict.fromkeys(
        ["average_forever", "average_2weeks", "median_forever", "median_2weeks"], 0
    )
    out |= {"score_rank": "", "userscore": 0} | changes
    return {k: v for k, v in out.items() if v is not ...}


def page(*games):
    return json.dumps({str(g["appid"]): g for g in games})


SAMPLE_PAGE = page(*[game(g) for g in GAMES])


def documents(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def by_appid(df):
    return {r["appid"]: r for r in df.collect()}


def test_one_row_of_15_columns_per_game(spark):
    df = landed.game_rows(documents(spark, SAMPLE_PAGE)).drop("seq")
    assert len(df.columns) == 15
    assert set(by_appid(df)) == {g[0] for g in GAMES}


def test_prices_become_cents_and_free_is_zero(spark):
    found = by_appid(landed.game_rows(documents(spark, SAMPLE_PAGE)))
    reduced = found[22]
    assert (reduced.price_cents, reduced.initial_price_cents, reduced.discount_pct) == (799, 1599, 50)
    assert found[11].price_cents == 0
    assert found[11].owners == "200,000 .. 500,000"


def test_missing_null_and_empty_prices_are_null(spark):
    odd = game(GAMES[0], price="", initialprice=None, discount=...)
    [row] = landed.game_rows(documents(spark, page(odd))).collect()
    assert (row.price_cents, row.initial_price_cents, row.discount_pct) == (None, None, None)


def test_missing_required_field_fails(spark):
    bad = page(game(GAMES[0], ccu=...))
    with pytest.raises(Exception, match="required field missing: ccu"):
        landed.game_rows(documents(spark, bad)).collect()


def test_quarantine_names_the_missing_fields(spark):
    docs = documents(spark, page(game(GAMES[0], ccu=..., name=...), game(GAMES[1])))
    required = list(landed.GAME_REQUIRED.values())
    entries = landed.map_entries(docs, "value", landed.GAME_FIELDS, required=required)
    good, bad = landed.split_required(entries)
    assert [r.appid for r in good.collect()] == [22]
    assert [(r.appid, r.missing_fields) for r in bad.collect()] == [(11, ["name", "ccu"])]


def test_required_field_may_be_null(spark):
    [row] = landed.game_rows(documents(spark, page(game(GAMES[0], developer=None)))).collect()
    assert (row.appid, row.developer) == (11, None)


def test_check_does_not_depend_on_the_columns_used(spark):
    bad = page(game(GAMES[0], ccu=...))
    with pytest.raises(Exception, match="required field missing: ccu"):
        landed.game_rows(documents(spark, bad)).select("appid").collect()


def test_broken_document_fails(spark):
    with pytest.raises(Exception, match="MALFORMED|Malformed|BAD"):
        landed.game_rows(documents(spark, '{"1": {"appid": ')).collect()


def test_empty_page_has_no_rows(spark):
    assert landed.game_rows(documents(spark, "{}")).count() == 0


def players(*ids):
    people = [
        {"steamid": i, "personaname": f"n{i}", "profileurl": f"u{i}", "personastate": s, "extra": 1}
        for s, i in enumerate(ids)
    ]
    return json.dumps({"response": {"players": people}})


def test_player_rows_flag_the_own_profile(spark):
    docs = documents(spark, players("a", "b"))
    assert rows(landed.player_rows(docs, "b")) == [
        ("a", "na", "ua", 0, False),
        ("b", "nb", "ub", 1, True),
    ]
    assert [r.is_self for r in landed.player_rows(docs).collect()] == [False, False]
    assert landed.player_rows(documents(spark, players())).count() == 0


def test_friend_ids(spark):
    doc = json.dumps({"friendslist": {"friends": [{"steamid": "1", "since": 2}, {"steamid": "3"}]}})
    assert rows(landed.friend_ids(documents(spark, doc))) == [("1",), ("3",)]


def libraries(spark):
    owned = [
        {"appid": 11, "name": "Harbor Lights", "playtime_forever": 6402, "rtime_last_played": 1767225600, "x": 1},
        {"appid": 77, "playtime_forever": 0},
    ]
    recent = [{"appid": 11, "name": "Harbor Lights", "playtime_2weeks": 85, "playtime_forever": 6402}]
    data = [
        ("1", {"game_count": 2, "games": owned}, {"total_count": 1, "games": recent}),
        ("2", {}, {}),
        ("3", {"game_count": 0}, {"total_count": 0}),
    ]
    return spark.createDataFrame(
        [(i, json.dumps(o), json.dumps(r)) for i, o, r in data],
        "steamid string, owned string, recent string",
    )


def test_owned_and_recent_games_with_defaults(spark):
    assert rows(landed.owned_game_rows(libraries(spark))) == [
        ("1", 11, "Harbor Lights", 6402, 1767225600),
        ("1", 77, None, 0, 0),
    ]
    assert rows(landed.recent_game_rows(libraries(spark))) == [("1", 11, "Harbor Lights", 85, 6402)]


def test_given_null_is_not_a_missing_key(spark):
    text = '{"game_count": 1, "games": [{"appid": 1, "playtime_forever": 2, "rtime_last_played": null}]}'
    df = spark.createDataFrame([("1", text)], "steamid string, owned string")
    assert rows(landed.owned_game_rows(df)) == [("1", 1, None, 2, None)]
    with pytest.raises(Exception, match="required field missing: playtime_forever"):
        broken = df.withColumn("owned", F.replace("owned", F.lit("playtime_f"), F.lit("p")))
        landed.owned_game_rows(broken).collect()


def test_hidden_is_not_empty_and_all_players_have_a_status(spark):
    status = landed.library_status(libraries(spark))
    assert rows(status) == [
        ("1", True, 2, True, 1),
        ("2", False, 0, False, 0),
        ("3", True, 0, True, 0),
    ]
    assert rows(landed.status_summary(status)) == [(3, 1, 2, 1)]


def test_key_with_null_value_is_present(spark):
    df = documents(spark, '{"game_count": null}', "{}")
    assert [r[0] for r in df.select(landed.has_key("value", "game_count")).collect()] == [True, False]
