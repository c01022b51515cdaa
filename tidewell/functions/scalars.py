"""Scalar expressions shared by the staging and mart models."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# decimal(20,0) / decimal(20,0) keeps 18 fractional digits, so rounding to a few
# digits afterwards never rounds an already rounded value
_RATIO_OPERAND = "decimal(20,0)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def range_bound(text: Column | str, part: int, sep: str = " .. ", strict: bool = True) -> Column:
    """Bound ``part`` (1 or 2) of a text range such as ``20,000,000 .. 50,000,000``.

    ``strict`` fails on text that is not a range; otherwise such text gives NULL.
    """
    digits = F.replace(F.split_part(_col(text), F.lit(sep), F.lit(part)), F.lit(","), F.lit(""))
    return digits.cast("bigint") if strict else digits.try_cast("bigint")


def midpoint(low: Column | str, high: Column | str) -> Column:
    """Whole-number midpoint, truncated."""
    total = _col(low).cast("bigint") + _col(high).cast("bigint")
    return F.call_function("div", total, F.lit(2))


def safe_ratio(part: Column | str, whole: Column | str, digits: int = 4) -> Column:
    """``part / whole`` rounded half-up; NULL when ``whole`` is 0 or either side is NULL."""
    divisor = _col(whole).cast(_RATIO_OPERAND)
    return F.round(_col(part).cast(_RATIO_OPERAND) / F.nullif(divisor, F.lit(0)), digits)


def zero_to_null(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(0))


def cents_to_dollars(c: Column | str) -> Column:
    return (_col(c).cast("decimal(12,0)") / 100).cast("decimal(10,2)")


def optional_int(c: Column | str, strict: bool = True) -> Column:
    """Text to int where NULL and the empty string both mean "not given"."""
    text = F.nullif(_col(c), F.lit(""))
    return text.cast("int") if strict else text.try_cast("int")


def decode(code: Column | str, labels: Mapping[int, str], default: str) -> Column:
    """Label of a code, ``default`` for codes (and NULLs) that are not listed."""
    table = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return F.coalesce(F.try_element_at(table, _col(code)), F.lit(default))


def tier(
    value: Column | str,
    bounds: Sequence[tuple[object, str]],
    top: str,
    missing: str,
    leading: Sequence[tuple[Column, str]] = (),
) -> Column:
    """Label of the first upper bound above ``value`` (bounds are exclusive).

    A NULL value is labelled ``missing`` before anything else is looked at, then
    the ``leading`` conditions are tried, then the bounds in order.
    """
    v = _col(value)
    label = F.when(v.isNull(), missing)
    for condition, name in leading:
        label = label.when(condition, name)
    for bound, name in bounds:
        label = label.when(v < F.lit(bound), name)
    return label.otherwise(top)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Elapsed seconds between two zone-less timestamps, exact to the microsecond.

    Built from the parts of the interval: subtracting zone-less timestamps is the
    wall-clock difference whatever the session time zone is.
    """
    elapsed = _col(end) - _col(start)
    seconds = (
        F.extract(F.lit("DAY"), elapsed).cast("decimal(12,0)") * 86400
        + F.extract(F.lit("HOUR"), elapsed) * 3600
        + F.extract(F.lit("MINUTE"), elapsed) * 60
        + F.extract(F.lit("SECOND"), elapsed)
    )
    return seconds.cast("decimal(20,6)")


def hours_between(start: Column | str, end: Column | str, digits: int = 2) -> Column:
    return F.round(seconds_between(start, end) / F.lit(3600).cast("decimal(4,0)"), digits)


def inclusive_days(first: Column | str, last: Column | str) -> Column:
    """Calendar days from ``first`` to ``last``, counting both."""
    return F.datediff(_col(last), _col(first)) + 1


def redact_param(text: Column | str, name: str = "key", mask: str = "REDACTED") -> Column:
    """Replace the value of the URL parameter ``name`` wherever it occurs in a text."""
    return F.regexp_replace(_col(text), f"({re.escape(name)}=)[^&\\s'\"]+", f"$1{mask}")


def name_part(dotted: Column | str, n: int = 3) -> Column:
    return F.split_part(_col(dotted), F.lit("."), F.lit(n))


def tail_parts(dotted: Column | str, start: int = 3) -> Column:
    parts = F.split(_col(dotted), "[.]")
    return F.array_join(F.slice(parts, F.lit(start), F.size(parts)), ".")
