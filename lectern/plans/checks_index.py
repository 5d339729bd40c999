"""Checked queries for text analysis and the inverted index."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions.text import tokens
from lectern.operators import lemmas as lem
from lectern.operators.postings import (POSTING_BLOCK, build_postings, parse_postings, postings_array,
                                        prune_postings, vocabulary, vocabulary_filter)
from lectern.operators.retrieval import candidate_books, query_tokens
from lectern.plans import sqltext as q
from lectern.plans.registry import register
from lectern.plans.standins import SQL_BOOKS, books_from_documents, queries_from_benchmark, spread, table
from lectern.sources.writers import read_postings_text, write_postings_text
from lectern.session import scratch_path


def catalogue(spark, sf):
    books = books_from_documents(spread(table(spark, sf, "documents")))
    return books, build_postings(books)


@register("tokenize_documents", sql=f"""
SELECT CAST(doc_id AS BIGINT) AS doc_id, array_to_string({q.tokens('text')}, ' ') AS tokens,
       CAST(len({q.tokens('text')}) AS BIGINT) AS n_tokens
FROM documents""")
def tokenize_documents(spark, sf):
    """Analysed tokens of every document, order and repeats kept."""
    d = table(spark, sf, "documents").select("doc_id", tokens("text").alias("t"))
    return d.select(F.col("doc_id").cast("long").alias("doc_id"), F.array_join("t", " ").alias("tokens"),
                    F.size("t").cast("long").alias("n_tokens"))


@register("build_postings", sql=f"WITH {q.postings_cte(SQL_BOOKS)} SELECT token, book_id FROM post")
def q_build_postings(spark, sf):
    """A2: distinct (token, book_id) pairs of the composed book text."""
    return catalogue(spark, sf)[1]


@register("postings_array", sql=f"""
WITH {q.postings_cte(SQL_BOOKS)}
SELECT token, CAST(floor(book_id / {POSTING_BLOCK}) AS BIGINT) AS block,
       string_agg(CAST(book_id AS VARCHAR), ',' ORDER BY book_id) AS doc_ids, CAST(count(*) AS BIGINT) AS n_docs
FROM post GROUP BY token, floor(book_id / {POSTING_BLOCK})""")
def q_postings_array(spark, sf):
    """A2 array view, A4, K3 text: sorted comma-joined ids per (token, id block)."""
    return postings_array(catalogue(spark, sf)[1])


@register("vocabulary", sql=f"""
WITH {q.postings_cte(SQL_BOOKS)}
SELECT token, CAST(count(*) AS BIGINT) AS n_books FROM post GROUP BY token""")
def q_vocabulary(spark, sf):
    """A3 / M5: distinct tokens of live books with document frequency."""
    return vocabulary(catalogue(spark, sf)[1])


@register("vocabulary_prefilter", sql=f"""
WITH {q.postings_cte(SQL_BOOKS)},
qt AS (SELECT DISTINCT CAST(item_id AS BIGINT) AS query_id, unnest({q.tokens('text')}) AS token FROM benchmark)
SELECT query_id, token FROM qt WHERE token IN (SELECT token FROM post)""")
def q_vocabulary_prefilter(spark, sf):
    """Query tokens that exist in the index vocabulary."""
    _, post = catalogue(spark, sf)
    qt = query_tokens(queries_from_benchmark(table(spark, sf, "benchmark")))
    return vocabulary_filter(qt, vocabulary(post))


@register("prune_postings", sql=f"""
WITH {q.postings_cte(SQL_BOOKS)},
live AS (SELECT CAST(doc_id AS BIGINT) AS book_id FROM documents
         WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL))
SELECT token, book_id FROM post WHERE book_id IN (SELECT book_id FROM live)""")
def q_prune_postings(spark, sf):
    """Postings restricted to live books (documents not labelled toxic)."""
    _, post = catalogue(spark, sf)
    docs = table(spark, sf, "documents")
    toxic = table(spark, sf, "labels").where(F.col("toxic") == 1).select("doc_id")
    live = docs.join(toxic, "doc_id", "left_anti").select(F.col("doc_id").alias("book_id"))
    return prune_postings(post, live)


@register("candidate_docs", sql=f"""
WITH {q.postings_cte(SQL_BOOKS)},
qt AS (SELECT DISTINCT CAST(item_id AS BIGINT) AS query_id, unnest({q.tokens('text')}) AS token FROM benchmark)
SELECT DISTINCT query_id, book_id FROM qt JOIN post USING (token)""")
def q_candidate_docs(spark, sf):
    """J1 + A5 + U1: OR-retrieval candidate set per benchmark query."""
    _, post = catalogue(spark, sf)
    qt = query_tokens(queries_from_benchmark(table(spark, sf, "benchmark")))
    return candidate_books(qt, post)


@register("postings_codec", sql=f"WITH {q.postings_cte(SQL_BOOKS)} SELECT token, book_id FROM post")
def q_postings_codec(spark, sf):
    """K3 then S5: postings written as (token, "id,id,...") CSV under the shared folder and read back."""
    _, post = catalogue(spark, sf)
    path = scratch_path(spark, "postings-text")
    write_postings_text(postings_array(post), path)
    return parse_postings(read_postings_text(spark, path))


@register("lemma_tokens", sql=lem.SQL_LEMMA_MAP.format(vocab=f"""
SELECT DISTINCT unnest({q.tokens('text')}) AS token FROM documents"""))
def q_lemma_tokens(spark, sf):
    """T5: noun lemma of every distinct document token, the corpus vocabulary serving as lexicon."""
    vocab = table(spark, sf, "documents").select(F.explode(tokens("text")).alias("token")).distinct()
    return lem.lemma_map(vocab, lexicon=vocab)


@register("first_piece_tokens", sql=lem.SQL_FIRST_PIECE.format(
    words=f"SELECT DISTINCT unnest({q.words('text')}) AS word FROM documents",
    pieces=f"SELECT DISTINCT unnest({q.words('text')}) AS piece FROM benchmark"))
def q_first_piece_tokens(spark, sf):
    """First word piece of every distinct document word against a piece vocabulary (benchmark words)."""
    from lectern.functions.text import words
    w = table(spark, sf, "documents").select(F.explode(words("text")).alias("word")).distinct()
    pieces = table(spark, sf, "benchmark").select(F.explode(words("text")).alias("piece")).distinct()
    return lem.first_pieces(w, pieces)
