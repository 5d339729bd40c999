"""Sinks (K1-K7). Parquet is the storage format; CSV is written only at exchange edges.

Every write goes to a new directory; callers switch to it after the write has finished, so readers never see a
half-written table (D15).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.vectors import format_vector_text
from lectern.schemas import POSTINGS_TEXT, TIMING


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """K1/K2/K6: one whole table as Parquet."""
    df.write.mode(mode).parquet(path)
    return path


def write_csv(df: DataFrame, path: str, null_value: str = "", mode: str = "errorifexists") -> str:
    """K1 (CSV option) / K4: header row, fixed column order, quoted multi-line fields."""
    (df.write.mode(mode).option("header", True).option("escape", '"').option("nullValue", null_value)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def write_postings_text(arrays: DataFrame, path: str) -> str:
    """K3: ``token, doc_ids`` with ids comma-joined (several rows per token when a list is split in blocks)."""
    return write_csv(arrays.select("token", "doc_ids"), path)


def read_postings_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(POSTINGS_TEXT).option("header", True).option("escape", '"').csv(path)


def write_vectors_text(vectors: DataFrame, path: str) -> str:
    """K2 text codec: ``id, embedding`` with the vector printed as ``[a b c]``."""
    return write_csv(vectors.select(F.col("book_id").alias("id"), format_vector_text("embedding").alias("embedding")), path)


def export_listing(books: DataFrame, path: str, columns=("id", "title", "author", "description", "isbn",
                                                         "publish_year", "genre")) -> str:
    """K4: all books as CSV with a fixed column list (an empty catalogue writes a header-only file)."""
    listing = books.select(F.col("book_id").alias("id"), *[c for c in columns if c != "id"])
    return write_csv(listing, path)


def load_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """K5: read the table at ``path`` if it exists, else build it, write it there, and read it back.

    A directory without the ``_SUCCESS`` marker is a failed earlier write and is rebuilt.
    """
    try:
        spark.read.text(path.rstrip("/") + "/_SUCCESS").limit(1).collect()
        present = True
    except AnalysisException:
        present = False
    if not present:
        write_table(build(), path, mode="overwrite")
    return spark.read.parquet(path)


def append_timings(df: DataFrame, path: str) -> str:
    """K7: append ``threads, seconds`` rows."""
    df.select(F.col("threads").cast("int"), F.col("seconds").cast("double")).write.mode("append").parquet(path)
    return path


def read_timings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TIMING).parquet(path)
