"""Ranks, shares and per-group picks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions import safe_ratio
from tidewell.operators.bounds import bound_bits, bounds_below, quantile_bounds, require_quantiles


@dataclass(frozen=True)
class RankBy:
    """Rank ``column`` from the highest value down; ``nulls`` is "first" or "last"."""

    column: str
    nulls: str = "first"


def global_ranks(df: DataFrame, ranks: Mapping[str, RankBy], bits: int | None = None) -> DataFrame:
    """Add a ``rank()`` over the whole table for each entry of ``ranks``.

    ``rank() over (order by v)`` needs all rows in one task. Here each value falls
    in a bucket: the gaps between quantile bounds, and one bucket for every bound
    itself. Rows are ranked inside their bucket and shifted by the number of rows
    in the buckets before it. A value frequent enough to matter is a bound, so
    its bucket holds that one value only, where every row has rank 1: such a
    bucket is spread over tasks freely. NULLs are a single-value bucket as well.
    Ranked columns have to be numbers, dates or timestamps.
    """
    require_quantiles(df, {r.column for r in ranks.values()})
    bits = bits or bound_bits(df.sparkSession)
    values = {r.column: F.col(r.column) for r in ranks.values()}
    bucketed = bounds_below(df, values, quantile_bounds(df, values, bits), bits)
    on_bound = {
        f"__on_{c}": F.coalesce(
            F.get(F.col("__bounds")[c], F.col(f"__below_{c}")) == value, F.lit(False)
        )
        for c, value in values.items()
    }
    bucketed = bucketed.withColumns(on_bound)
    # rows of a one-value bucket stay apart by the task they come from: identical rows
    # could not be told apart by their content
    single = {c: F.col(c).isNull() | F.col(f"__on_{c}") for c in values}
    lanes = {f"__lane_{c}": F.when(single[c], F.spark_partition_id()).otherwise(-1) for c in values}

    # bucket numbers of different ranks do not overlap, so one table shifts them all
    width = 2 * (2**bits - 1) + 3
    buckets = {}
    for i, (name, r) in enumerate(ranks.items()):
        # the gap above the highest bound comes first, the one below the lowest last
        number = F.lit(width - 2) - F.col(f"__below_{r.column}") * 2
        number = number - F.col(f"__on_{r.column}").cast("int")
        edge = F.lit(0 if r.nulls == "first" else width - 1)
        number = F.when(F.col(r.column).isNull(), edge).otherwise(number)
        buckets[f"__bucket_{name}"] = number + i * width
    bucketed = bucketed.select(
        *df.columns, *[c.alias(name) for name, c in {**lanes, **buckets}.items()]
    )

    each = bucketed.select(F.explode(F.array(*buckets)).alias("__bucket"))
    counts = each.groupBy("__bucket").agg(F.count("*").alias("n"))
    # at most ``width`` rows per rank
    earlier = Window.partitionBy(F.floor(F.col("__bucket") / width)).orderBy("__bucket")
    before = F.sum("n").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    shifts = F.broadcast(counts.select("__bucket", F.coalesce(before, F.lit(0)).alias("__shift")))

    out = bucketed
    for c in values:
        # ranks of the same column differ in their shifts only
        names = [n for n, r in ranks.items() if r.column == c]
        window = Window.partitionBy(f"__bucket_{names[0]}", f"__lane_{c}")
        out = out.withColumn("__inside", F.rank().over(window.orderBy(F.col(c).desc_nulls_first())))
        for name in names:
            out = out.join(shifts, F.col(f"__bucket_{name}") == F.col("__bucket"), "left")
            out = out.withColumn(name, F.col("__inside") + F.col("__shift"))
            out = out.drop("__bucket", "__shift")
        out = out.drop("__inside")
    return out.select(*df.columns, *ranks)


def highest(value: str, by: str, tie: str) -> Column:
    """Aggregate: ``value`` of the row with the highest ``by``, a NULL ``by`` counting
    as highest and the lowest ``tie`` winning among equals."""
    return F.max_by(value, F.struct(F.col(by).isNull(), F.col(by), -F.col(tie)))


def share_of_total(measure: Column | str, total: DataFrame, digits: int = 4) -> Column:
    """``measure`` over the single value of ``total``, which is a scalar subquery.

    Take the total from the rows before grouping where that is possible: it then needs
    no shuffle of its own.
    """
    return safe_ratio(measure, total.scalar(), digits)


def last_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[str], nulls: str = "lowest"
) -> DataFrame:
    """The row with the highest ``order`` of each group; ``nulls`` is "lowest" or "highest".

    An aggregate rather than ``row_number() = 1``: rows are reduced to one per group
    before the shuffle, so the size of a group does not matter.
    """
    rest = [c for c in df.columns if c not in group]
    # NULLs in a struct compare lowest
    by = order if nulls == "lowest" else [c for o in order for c in (F.isnull(o), F.col(o))]
    best = F.max_by(F.struct(*rest), F.struct(*by))
    return df.groupBy(*group).agg(best.alias("__row")).select(
        *[F.col(c) if c in group else F.col("__row")[c].alias(c) for c in df.columns]
    )
