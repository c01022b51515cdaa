"""Splitting ordered columns at their quantiles."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# sketches of this many groups of input partitions are merged in parallel
_SKETCH_GROUPS = 64


_ORDERED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def has_quantiles(df: DataFrame, column: str) -> bool:
    """Whether quantiles order a column as a sort does, which they do not for texts."""
    return isinstance(df.schema[column].dataType, _ORDERED)


def require_quantiles(df: DataFrame, columns: Iterable[str]) -> None:
    """Refuse columns that quantiles would order differently from a sort."""
    for c in columns:
        if not has_quantiles(df, c):
            kind = df.schema[c].dataType.simpleString()
            raise TypeError(f"column {c} is {kind}; it has to be a number, date or timestamp")


def bound_bits(spark: SparkSession) -> int:
    """Bits b so that 2**b - 1 bounds make about one interval per shuffle partition."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(16, max(4, partitions.bit_length()))


def quantile_bounds(df: DataFrame, columns: Mapping[str, Column], bits: int) -> Column:
    """``2**bits - 1`` ascending bounds per column, as a struct of arrays from a subquery.

    The bounds only steer how rows are spread over tasks, every caller is exact
    whatever they are. So they are approximate, and quantiles of the quantiles of groups
    of partitions: a single merge of the sketches of all tasks would be one slow task.
    """
    n = 2**bits - 1
    points = [(i + 0.5) / n for i in range(n)]

    def sketch(c: Column) -> Column:
        return F.percentile_approx(c, points, max(1000, 2 * n))

    lane = (F.spark_partition_id() % _SKETCH_GROUPS).alias("__lane")
    grouped = df.select(lane, *[c.alias(name) for name, c in columns.items()]).groupBy("__lane")
    parts = grouped.agg(*[sketch(F.col(c)).alias(c) for c in columns])
    # a group without any value has no array; padding is NULL, which sketches ignore
    values = F.arrays_zip(*[F.coalesce(F.col(c), F.array()).alias(c) for c in columns])
    merged = parts.select(F.inline(values)).toDF(*columns)
    return merged.agg(F.struct(*[sketch(F.col(c)).alias(c) for c in columns])).scalar()


def bounds_below(
    df: DataFrame, columns: Mapping[str, Column], bounds: Column, bits: int
) -> DataFrame:
    """Add how many bounds are less than a row's value, as ``__below_<name>``, and the
    bounds as ``__bounds``. No bound counts as less than NULL.

    A binary search that settles two bits per projection, so each step is two comparisons in
    generated code. Written as one expression it would double with every step.
    """
    df = df.withColumns({"__bounds": bounds, **{f"__below_{c}": F.lit(0) for c in columns}})
    for low in reversed(range(0, bits, 2)):
        step = 2**low
        pair = low + 1 < bits

        def moved(name: str, value: Column, step: int = step, pair: bool = pair) -> Column:
            at = F.col(f"__below_{name}")

            def less(steps: int) -> Column:
                return F.get(F.col("__bounds")[name], at + (steps * step - 1)) < value

            near = F.when(less(1), step).otherwise(0)
            if not pair:
                return at + near
            far = F.when(less(3), 3 * step).otherwise(2 * step)
            return at + F.when(less(2), far).otherwise(near)

        df = df.withColumns({f"__below_{name}": moved(name, v) for name, v in columns.items()})
    return df
