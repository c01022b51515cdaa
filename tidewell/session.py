"""Session settings the library counts on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "tidewell") -> SparkSession:
    """The running session, or one with adaptive execution and ANSI errors on.

    Resources, shuffle partitions and ``spark.checkpoint.dir`` are the cluster's to set.
    """
    return (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.ansi.enabled", "true")
        .getOrCreate()
    )


def reusable(df: DataFrame) -> DataFrame:
    """``df`` for more than one use: written once to the cluster's checkpoint folder.

    Without ``spark.checkpoint.dir`` it is computed again for every use.
    """
    if df.sparkSession.sparkContext.getCheckpointDir() is None:
        return df
    return df.checkpoint()
