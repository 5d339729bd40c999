"""Served projection of search hits (P5 result columns, P6 blank description, P7 percent, P8 band)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import is_missing


def percent(sim: Column | str) -> Column:
    """Similarity as a percent with two decimals (half-up, as Spark SQL rounds)."""
    sim = F.col(sim) if isinstance(sim, str) else sim
    return F.round(sim * F.lit(100.0), 2)


def relevance_band(pct: Column | str) -> Column:
    """Above 80 green, above 50 orange, otherwise red."""
    pct = F.col(pct) if isinstance(pct, str) else pct
    return F.when(pct > 80, F.lit("green")).when(pct > 50, F.lit("orange")).otherwise(F.lit("red"))


def result_page_columns(hits: DataFrame) -> DataFrame:
    """P5 + P6 + P7 + P8 over hits carrying isbn, title, author, publish_year, description, similarity."""
    pct = percent("similarity")
    return hits.select(
        "query_id", "rank", "book_id",
        F.col("isbn").cast("string").alias("isbn"),
        "title", "author",
        F.col("publish_year").cast("int").alias("year"),
        F.when(is_missing("description", any_case=True), F.lit("")).otherwise(F.col("description")).alias("description"),
        F.lit("").alias("cover"),
        pct.alias("similarity"),
        relevance_band(pct).alias("band"),
    )
