"""Column functions. Every function returns a Column built from Spark built-ins."""

from tidewell.functions.scalars import (
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
    seconds_between,
    tail_parts,
    tier,
    zero_to_null,
)

__all__ = [
    "cents_to_dollars",
    "decode",
    "hours_between",
    "inclusive_days",
    "midpoint",
    "name_part",
    "optional_int",
    "range_bound",
    "redact_param",
    "safe_ratio",
    "seconds_between",
    "tail_parts",
    "tier",
    "zero_to_null",
]
