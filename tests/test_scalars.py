from decimal import Decimal

import pytest
from conftest import ts
from pyspark.sql import functions as F

from tidewell.functions import (
    cents_to_dollars,
    decode,
    hours_between,
    inclusive_days,
    midpoint,
    name_part,
    optional_int,
    range_bound,
    redact_param,
    safe_ratio,
    tail_parts,
    tier,
    zero_to_null,
)


def value(spark, column, schema="x int", row=(1,)):
    return spark.createDataFrame([row], schema).select(column).first()[0]


def test_range_bounds_keep_large_numbers(spark):
    text = "2,000,000,000 .. 5,000,000,000"
    assert value(spark, range_bound(F.lit(text), 1)) == 2_000_000_000
    assert value(spark, range_bound(F.lit(text), 2)) == 5_000_000_000
    assert value(spark, range_bound(F.lit(None).cast("string"), 1)) is None


def test_text_that_is_no_range_fails_unless_lenient(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        value(spark, range_bound(F.col("x"), 2), "x string", ("many",))
    assert value(spark, range_bound(F.col("x"), 2, strict=False), "x string", ("many",)) is None


def test_midpoint_truncates(spark):
    assert value(spark, midpoint(F.lit(1), F.lit(4))) == 2
    assert value(spark, midpoint(F.lit(2**31 - 1), F.lit(2**31 - 1))) == 2**31 - 1


def test_ratio_is_rounded_once(spark):
    # rounding to 6 digits first would give 0.1235
    assert value(spark, safe_ratio(F.lit(1234499996), F.lit(10**10))) == Decimal("0.1234")
    assert value(spark, safe_ratio(F.lit(12345), F.lit(100000))) == Decimal("0.1235")


def test_ratio_of_nothing_is_null(spark):
    assert value(spark, safe_ratio(F.lit(0), F.lit(0))) is None
    assert value(spark, safe_ratio(F.lit(None).cast("int"), F.lit(3))) is None


def test_money_and_zero(spark):
    assert value(spark, cents_to_dollars(F.lit(1999))) == Decimal("19.99")
    assert value(spark, zero_to_null(F.lit(0))) is None
    assert value(spark, zero_to_null(F.lit(7))) == 7


@pytest.mark.parametrize("text, want", [("1999", 1999), ("", None), (None, None), (" 12 ", 12)])
def test_optional_int(spark, text, want):
    assert value(spark, optional_int("x"), "x string", (text,)) == want


def test_optional_int_rejects_other_text(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        value(spark, optional_int("x"), "x string", ("12.5",))
    assert value(spark, optional_int("x", strict=False), "x string", ("free",)) is None


def test_decode_has_a_default(spark):
    labels = {0: "off", 1: "on"}
    for code, want in [(0, "off"), (1, "on"), (9, "?"), (None, "?")]:
        assert value(spark, decode("x", labels, "?"), "x int", (code,)) == want


@pytest.mark.parametrize(
    "price, want", [(None, "none"), (0, "zero"), (9, "low"), (10, "mid"), (29, "mid"), (30, "top")]
)
def test_tier_bounds_are_exclusive_and_missing_comes_first(spark, price, want):
    label = tier(
        "x", [(10, "low"), (30, "mid")], "top", "none", leading=[(F.col("x") == 0, "zero")]
    )
    assert value(spark, label, "x int", (price,)) == want


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])
def test_hours_ignore_clock_changes(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # the clocks change on this night in Berlin
        row = (ts("2026-03-28T12:00:00"), ts("2026-03-29T12:30:00.000001"))
        schema = "a timestamp_ntz, b timestamp_ntz"
        assert value(spark, hours_between("a", "b"), schema, row) == Decimal("24.50")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_hours_of_a_century(spark):
    row = (ts("2000-01-01T00:00:00"), ts("2100-01-01T00:00:00"))
    assert value(spark, hours_between("a", "b"), "a timestamp_ntz, b timestamp_ntz", row) == 876600


def test_inclusive_days(spark):
    row = (ts("2026-10-01T00:00:00").date(), ts("2026-10-03T00:00:00").date())
    assert value(spark, inclusive_days("a", "b"), "a date, b date", row) == 3


def test_redaction_covers_every_occurrence(spark):
    text = "https://x/y?key=SECRET&steamid=1 'https://x/z?a=1&key=OTHER'"
    want = "https://x/y?key=REDACTED&steamid=1 'https://x/z?a=1&key=REDACTED'"
    assert value(spark, redact_param("x"), "x string", (text,)) == want


def test_dotted_names(spark):
    assert value(spark, name_part("x"), "x string", ("test.a.check.b1",)) == "check"
    assert value(spark, tail_parts("x"), "x string", ("source.a.raw.games",)) == "raw.games"
