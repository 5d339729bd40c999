"""Vectors with their origin (T7, M6, D9, D19): each carries the md5 of the text it was made from and its embedder's mark.

A vector is good for a book only while both agree, so a text that changed outside any batch is found, and vectors of two
embedders are never scored against each other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import compose_text

ORIGIN = ["embedder", "text_md5"]


def embed_with_origin(books: DataFrame, embed: Callable[[DataFrame], DataFrame], embedder: str, text: Column | None = None) -> DataFrame:
    """(book_id, embedding, embedder, text_md5) of books with unique ids. ``embed`` gives (book_id, embedding) and works on the
    same text as ``text`` says (default: the composed one)."""
    text = compose_text() if text is None else text
    made = embed(books).select("book_id", F.col("embedding").cast("array<double>").alias("embedding"))
    return made.join(books.select("book_id", F.md5(text).alias("text_md5")), "book_id").select(
        "book_id", "embedding", F.lit(embedder).alias("embedder"), "text_md5")


def refresh_vectors(books: DataFrame, vectors: DataFrame, embed: Callable[[DataFrame], DataFrame], embedder: str,
                    text: Column | None = None) -> DataFrame:
    """M6: (book_id, embedding, embedder, text_md5, computed) with one row per book.

    A stored vector stays if the book's text has its md5 and it is of ``embedder``; other books are embedded, vectors without
    a book go. A vector without an origin (null) counts as stale; repeated good vectors of a book count once. Which books
    are stale is found from ids and hashes alone; vectors take part in one join on book_id.
    """
    now = books.select("book_id", F.md5(compose_text() if text is None else text).alias("text_md5"))
    good = vectors.where(F.col("embedder") == embedder).join(now, ["book_id", "text_md5"], "left_semi")
    stale = books.join(good.select("book_id"), "book_id", "left_anti")
    kept = good.select("book_id", F.col("embedding").cast("array<double>").alias("embedding"), *ORIGIN).dropDuplicates(["book_id"])
    fresh = embed_with_origin(stale, embed, embedder, text)
    return kept.withColumn("computed", F.lit(False)).unionByName(fresh.withColumn("computed", F.lit(True)))


def require_one_embedder(*tables: DataFrame) -> str | None:
    """The one mark of all vectors of ``tables``; an error where there are several, or vectors without one beside others.
    Marks are counted where they lie; at most two come back. None for empty tables."""
    marks = tables[0].select("embedder")
    for t in tables[1:]:
        marks = marks.unionByName(t.select("embedder"))
    found = [r[0] for r in marks.distinct().limit(2).collect()]
    if len(found) > 1:
        raise ValueError(f"vectors of different embedders cannot be scored against each other: {sorted(map(str, found))}")
    return found[0] if found else None
