"""Text vectors (T7 a/b/c, T8, T9), vector coverage (J9, A9) and gap-only re-embedding (M6).

T7c, the built-in embedder, is signed feature hashing: every analysed token adds +1 or -1 to one of ``dim``
buckets chosen by its md5, and the count vector is L2-normalised. The md5 of each token is taken in the JVM; the
per-row bucket count is a small numpy helper on Arrow batches, so tokens never cross a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import STOP_WORDS, compose_text, tokens

DEFAULT_DIM = 768
COUNT_ROWS = 1024  # rows counted at a time, so a batch costs its input and its vectors, and little beside
MODEL_MAX_TOKENS = 510  # T8: a 512-token model input minus its two marker tokens


def token_hash(t: Column) -> Column:
    """First 32 bits of the token's md5 as a non-negative integer."""
    return F.conv(F.substring(F.md5(t), 1, 8), 16, 10).cast("long")


def token_hashes(toks: Column) -> Column:
    return F.transform(toks, token_hash)


def _count_codes(dim: int, unit: bool = True):
    """Per row: bucket = h mod dim, sign = +1 when (h div dim) is even else -1; add, then L2-normalise if ``unit``."""
    @F.arrow_udf("array<double>")
    def count(hashes: pa.Array) -> pa.Array:
        n = len(hashes)
        lengths = pc.fill_null(pc.list_value_length(hashes), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        h, ends = hashes.flatten().to_numpy(zero_copy_only=False), np.cumsum(lengths)
        out = np.zeros((n, dim), dtype=np.float64)
        for lo in range(0, n, COUNT_ROWS):
            hi = min(n, lo + COUNT_ROWS)
            part, x = h[ends[lo] - lengths[lo]:ends[hi - 1]], out[lo:hi]
            if len(part):
                rows = np.repeat(np.arange(hi - lo), lengths[lo:hi])
                sign = np.where((part // dim) % 2 == 0, 1.0, -1.0)
                x += np.bincount(rows * dim + part % dim, weights=sign, minlength=(hi - lo) * dim).reshape(hi - lo, dim)
            if unit:
                norms = np.sqrt((x * x).sum(axis=1, keepdims=True))
                np.divide(x, norms, out=x, where=norms > 0)
        return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * dim, pa.int32()), pa.array(out.ravel()))
    return count


def hashed_vectors(df: DataFrame, id_col: str = "book_id", text: Column | None = None, dim: int = DEFAULT_DIM,
                   max_tokens: int | None = None, stop_words=STOP_WORDS, unit: bool = True) -> DataFrame:
    """T7c (+ T9): ``(book_id, embedding array<double>)`` by signed feature hashing of the analysed text.

    The whole text is used unless ``max_tokens`` is given (T8 mimics a model's input limit). ``unit=False`` leaves the counts as they are:
    cosines come out the same but for the last bits, and their dot products are whole numbers, so exact.
    """
    text = compose_text() if text is None else text
    toks = tokens(text, stop_words)
    if max_tokens is not None:
        toks = F.slice(toks, 1, max_tokens)
    hashed = df.select(F.col(id_col).alias("book_id"), token_hashes(toks).alias("h"))
    return hashed.select("book_id", _count_codes(dim, unit)("h").alias("embedding"))


def embed_with(df: DataFrame, make_model: Callable[[], Callable[[list[str]], np.ndarray]],
               id_col: str = "book_id", text: Column | None = None) -> DataFrame:
    """The caller's embedder, loaded once per task, applied to Arrow batches of composed text.

    ``make_model()`` returns a function mapping a list of texts to a (n, dim) array; rows are L2-normalised.
    """
    text = compose_text() if text is None else text
    src = df.select(F.col(id_col).alias("book_id"), text.alias("text"))

    def run(batches):
        model = make_model()
        for pdf in batches:
            vecs = np.asarray(model(pdf["text"].tolist()), dtype=np.float64)
            norms = np.linalg.norm(vecs, axis=1, keepdims=True)
            vecs = np.divide(vecs, norms, out=np.zeros_like(vecs), where=norms > 0)
            yield pd.DataFrame({"book_id": pdf["book_id"], "embedding": list(vecs)})

    return src.mapInPandas(run, "book_id long, embedding array<double>")


def coverage_gaps(books: DataFrame, vectors: DataFrame) -> DataFrame:
    """``(kind, id)`` for books without a vector ("missing") and vectors without a book ("orphan")."""
    b = books.select(F.col("book_id").alias("id"))
    v = vectors.select(F.col("book_id").alias("id"))
    return (b.join(v, "id", "left_anti").select(F.lit("missing").alias("kind"), "id")
            .unionByName(v.join(b, "id", "left_anti").select(F.lit("orphan").alias("kind"), "id")))


def coverage_counts(books: DataFrame, vectors: DataFrame) -> DataFrame:
    """Book and vector counts with the J9 gap counts beside them (one row)."""
    gaps = coverage_gaps(books, vectors)
    n_books = books.select(F.count(F.lit(1))).scalar()
    n_vectors = vectors.select(F.count(F.lit(1))).scalar()
    return gaps.agg(
        n_books.cast("long").alias("n_books"), n_vectors.cast("long").alias("n_vectors"),
        F.sum(F.when(F.col("kind") == "missing", 1).otherwise(0)).cast("long").alias("n_missing"),
        F.sum(F.when(F.col("kind") == "orphan", 1).otherwise(0)).cast("long").alias("n_orphans"))


def fill_missing_vectors(books: DataFrame, vectors: DataFrame, embed: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Keep stored vectors of live books, embed only books without one, drop orphans.

    Output: ``(book_id, embedding array<double>, computed boolean)``.
    """
    live = vectors.join(books.select("book_id"), "book_id", "left_semi")
    stored = live.select("book_id", F.col("embedding").cast("array<double>").alias("embedding"),
                         F.lit(False).alias("computed"))
    gap = books.join(vectors.select("book_id"), "book_id", "left_anti")
    fresh = embed(gap).select("book_id", F.col("embedding").cast("array<double>"), F.lit(True).alias("computed"))
    return stored.unionByName(fresh)
