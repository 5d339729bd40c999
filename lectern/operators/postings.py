"""Inverted index as DataFrames (A2, A3, A4, J2, J5, K3/S5 codec).

The canonical index is the long table ``postings(token string, book_id long)``: one row per distinct
(token, book) pair. It is built without a keyed shuffle: each catalogue row is one book, so distinct tokens of
a row are distinct pairs. Array views are cut into id blocks so no row ever holds an unbounded posting list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import STOP_WORDS, compose_text, distinct_tokens

# Largest number of ids one array-view row holds; a token's list is split by ``book_id div POSTING_BLOCK``.
POSTING_BLOCK = 4096


def build_postings(books: DataFrame, text: Column | None = None, id_col: str = "book_id",
                   stop_words=STOP_WORDS) -> DataFrame:
    """A2: distinct (token, book_id) pairs of the analysed book text (P1 by default).

    Requires ``id_col`` to be a key of ``books`` (one row per book), which the catalogue guarantees.
    """
    text = compose_text() if text is None else text
    return books.select(
        F.explode(distinct_tokens(text, stop_words)).alias("token"),
        F.col(id_col).cast("long").alias("book_id"),
    )


def postings_array(postings: DataFrame, block: int = POSTING_BLOCK) -> DataFrame:
    """A2 array view / K3: ``(token, block, doc_ids)`` with at most ``block`` sorted ids per row.

    Grouping by (token, id block) keeps every group bounded however frequent a token is; A4 holds by
    construction because a group exists only when it has an id.
    """
    return (
        postings.groupBy("token", F.floor(F.col("book_id") / F.lit(block)).cast("long").alias("block"))
        .agg(F.sort_array(F.collect_list("book_id")).alias("ids"))
        .select("token", "block", F.array_join("ids", ",").alias("doc_ids"), F.size("ids").cast("long").alias("n_docs"))
    )


def parse_postings(rows: DataFrame, token_col: str = "token", ids_col: str = "doc_ids") -> DataFrame:
    """``(token, "1,2,3")`` rows back to the long table; several rows per token are a union.

    An empty or missing id list yields one row with a null ``book_id`` so the token stays in the vocabulary.
    """
    ids = F.split(F.coalesce(F.col(ids_col).cast("string"), F.lit("")), ",").try_cast("array<bigint>")
    ids = F.array_except(ids, F.array(F.lit(None).cast("long")))  # what is no id, and repeats, are left out
    return rows.select(F.col(token_col).alias("token"), F.explode_outer(ids).alias("book_id"))


def vocabulary(postings: DataFrame) -> DataFrame:
    """A3 / M5: distinct tokens of live books with their document frequency.

    The count is combined map-side, so a token present in every book sends one row per task, not one per book.
    """
    return (postings.where(F.col("book_id").isNotNull())
            .groupBy("token").agg(F.count(F.lit(1)).cast("long").alias("n_books")))


def vocabulary_delta(removed: DataFrame, added: DataFrame) -> DataFrame:
    """M5: ``(token, delta)``, the signed change of document frequencies by the (token, book_id) pairs removed and added."""
    signed = added.select("token", F.lit(1).alias("d")).unionByName(removed.select("token", F.lit(-1).alias("d")))
    return signed.groupBy("token").agg(F.sum("d").cast("long").alias("delta")).where("delta <> 0")


def merge_vocabulary(vocab: DataFrame, delta: DataFrame) -> DataFrame:
    """M5: the vocabulary after ``vocabulary_delta``; tokens whose last book is gone vanish."""
    both = vocab.select("token", "n_books").unionByName(delta.select("token", F.col("delta").alias("n_books")))
    return both.groupBy("token").agg(F.sum("n_books").cast("long").alias("n_books")).where("n_books > 0")


def vocabulary_filter(tokens_df: DataFrame, vocab: DataFrame, token_col: str = "token") -> DataFrame:
    """Keep only tokens present in the vocabulary (exact semi-join; no false positives)."""
    v = vocab.select(F.col("token").alias(token_col)).distinct()
    return tokens_df.join(v, token_col, "left_semi")


def prune_postings(postings: DataFrame, live_books: DataFrame, id_col: str = "book_id") -> DataFrame:
    """Postings of books that still exist; empty tokens vanish with their last posting (A4)."""
    live = live_books.select(F.col(id_col).cast("long").alias("book_id"))
    return postings.join(live, "book_id", "left_semi").select("token", "book_id")
