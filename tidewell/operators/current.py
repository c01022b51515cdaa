"""Flags for the rows that belong to the latest load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_load_flag(df: DataFrame, stamp: str, name: str) -> DataFrame:
    """Flag rows carrying the newest ``stamp`` of the table.

    The newest stamp is a scalar subquery: a partial and a final max over one
    column, and no row of ``df`` is moved. A window over the whole table would
    pull every row into one task.
    """
    newest = df.agg(F.max(stamp)).scalar()
    return df.withColumn(name, F.col(stamp) == newest)


def latest_finished_start(runs: DataFrame) -> Column:
    """Start of the latest finished run as a scalar subquery, NULL if none finished."""
    return runs.filter(F.col("finished_at").isNotNull()).agg(F.max("started_at")).scalar()


def since_boundary_flag(df: DataFrame, stamp: str, boundary: Column, name: str) -> DataFrame:
    """Flag rows stamped at or after ``boundary``; false while there is no boundary."""
    return df.withColumn(name, F.coalesce(F.col(stamp) >= boundary, F.lit(False)))
