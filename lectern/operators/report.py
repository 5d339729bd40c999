"""Timing report (A8 mean per group, R4 ascending order)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mean_by_group(timings: DataFrame, key: str = "threads", value: str = "seconds") -> DataFrame:
    """A8 + R4: mean of ``value`` per ``key`` with the number of runs, ascending by ``key``."""
    return (timings.where(F.col(value).isNotNull()).groupBy(key)
            .agg(F.round(F.avg(value), 6).alias("mean_seconds"), F.count(F.lit(1)).cast("long").alias("n_runs"))
            .orderBy(key))
