"""End-to-end searches over tables of queries (X1 hybrid search, X3 served page).

All arguments are DataFrames; nothing is collected. One query is simply a one-row query table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.text import STOP_WORDS
from lectern.operators.joins import DEFAULT_MAX_BROADCAST_ROWS, measured_rows
from lectern.operators.lemmas import apply_lemmas
from lectern.operators.nearest import even_length, nearest_candidates
from lectern.operators.origin import ORIGIN, require_one_embedder
from lectern.operators.present import result_page_columns
from lectern.operators.retrieval import ARROW_DIM, candidate_books, hydrate, query_tokens, score_candidates, top_n
from lectern.session import materialize
from lectern.sources.versioned import read_version

# From so many (query, token) rows on, cosine searches sift blocks of queries and books, with no row per candidate pair.
BLOCKS_FROM = 20_000


def hybrid_search(queries: DataFrame, postings: DataFrame, vectors: DataFrame, books: DataFrame,
                  query_vectors: DataFrame, top_n_rows: int = 100, text_col: str = "text",
                  book_cols=("title",), metric: str = "cosine", stop_words=STOP_WORDS,
                  max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS, score_decimals: int | None = None,
                  lemmas: DataFrame | None = None, blocks_from: int = BLOCKS_FROM) -> DataFrame:
    """T6 -> J2/J1 -> A5 -> J3 -> V1 -> R1 -> J4 for every row of ``queries``.

    From ``blocks_from`` query tokens on, by cosine and on short vectors of one length, ``nearest_candidates`` does J1, A5 and V1 by
    blocks and only pairs that may be among the first ``top_n_rows`` become rows; the hits are the same.

    With ``lemmas`` (a T5 map), query tokens are lemmatised the same way the postings were built.

    ``queries``: (query_id, text); ``postings``: (token, book_id); ``vectors``: (book_id, embedding);
    ``query_vectors``: (query_id, embedding); ``books``: (book_id, ...). A query with no indexed token
    returns no rows (D5). Where both vector tables carry an ``embedder``, it must be one and the same (D19). Output:
    query_id, rank, book_id, similarity and ``book_cols``.
    """
    if "embedder" in vectors.columns and "embedder" in query_vectors.columns:
        require_one_embedder(vectors, query_vectors)
        vectors, query_vectors = vectors.drop(*ORIGIN), query_vectors.drop(*ORIGIN)
    qt = query_tokens(queries, text_col, stop_words=stop_words)
    if lemmas is not None:
        qt = apply_lemmas(qt, lemmas, "query_id")
    n_qt = measured_rows(qt)
    length = None
    if metric == "cosine" and n_qt >= blocks_from:
        vectors, query_vectors = materialize(vectors, "vectors"), materialize(query_vectors, "query-vectors")
        length = even_length(vectors, query_vectors)
    if length and length <= ARROW_DIM:
        cands = nearest_candidates(materialize(qt, "query-tokens"), postings, vectors, query_vectors, top_n_rows, length, score_decimals)
    else:
        cands = candidate_books(qt, postings, max_broadcast_rows, q_rows=n_qt)
    scored = score_candidates(cands, vectors, query_vectors, metric, max_broadcast_rows)
    top = top_n(scored, top_n_rows, ascending=(metric == "euclidean"), score_decimals=score_decimals)
    # A query with hits has at least one token row, so tokens x top_n bounds the hits.
    return hydrate(top, books, list(book_cols), bound_rows=n_qt * top_n_rows,
                   max_broadcast_rows=max_broadcast_rows)


def result_page(queries: DataFrame, postings: DataFrame, vectors: DataFrame, books: DataFrame,
                query_vectors: DataFrame, page_size: int = 10, text_col: str = "text", lemmas: DataFrame | None = None,
                score_decimals: int | None = None) -> DataFrame:
    """The first ``page_size`` hits (R2) with the served projection (P5-P8); ``lemmas`` as in ``hybrid_search``."""
    hits = hybrid_search(queries, postings, vectors, books, query_vectors, top_n_rows=page_size,
                         text_col=text_col, lemmas=lemmas, score_decimals=score_decimals,
                         book_cols=("isbn", "title", "author", "publish_year", "description"))
    return result_page_columns(hits)


def postings_of(spark: SparkSession, root: str, version: int, queries: DataFrame, text_col: str = "text", stop_words=STOP_WORDS,
                lemmas: DataFrame | None = None) -> DataFrame:
    """J1 over a stored index: the postings in the buckets of the queries' tokens. Other buckets are not opened, so the cost of a
    few queries does not grow with the vocabulary; the rows are a superset of what the search then joins."""
    qt = query_tokens(queries, text_col, stop_words=stop_words)
    qt = qt if lemmas is None else apply_lemmas(qt, lemmas, "query_id")
    return read_version(spark, root, "postings", version, keys=qt.select("token").distinct())


def search_index(spark: SparkSession, root: str, version: int, queries: DataFrame, query_vectors: DataFrame, **how) -> DataFrame:
    """X1 over a stored index (``build_index``): ``hybrid_search`` on its vectors and books and the postings of the queries' tokens."""
    words = {k: how[k] for k in ("text_col", "stop_words", "lemmas") if k in how}
    return hybrid_search(queries, postings_of(spark, root, version, queries, **words), read_version(spark, root, "vectors", version),
                         read_version(spark, root, "books", version), query_vectors, **how)
