"""Vectors with text hash and embedder mark."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lectern.operators.embed import hashed_vectors
from lectern.operators.origin import embed_with_origin, refresh_vectors, require_one_embedder
from lectern.plans.search import hybrid_search

BOOKS = "book_id long, title string, author string, description string"


def embed(df):
    return hashed_vectors(df, dim=8)


@pytest.fixture
def books(spark):
    return spark.createDataFrame([(i, f"title {i}", "a", "words here") for i in range(6)], BOOKS)


def test_only_stale_vectors_are_made_anew(spark, books):
    stored = embed_with_origin(books.where("book_id <> 5"), embed, "hashed-8")
    assert not any(r.computed for r in refresh_vectors(books.where("book_id <> 5"), stored, embed, "hashed-8").collect())
    edited = books.withColumn("title", F.when(F.col("book_id") == 1, F.lit("other")).otherwise(F.col("title"))).where("book_id <> 4")
    stored = stored.withColumn("embedder", F.when(F.col("book_id") == 2, F.lit(None)).otherwise(F.col("embedder")))
    stored = stored.withColumn("text_md5", F.when(F.col("book_id") == 3, F.lit(None)).otherwise(F.col("text_md5")))
    got = refresh_vectors(edited, stored.unionByName(stored), embed, "hashed-8")
    assert rows(got, "book_id", "computed") == [(0, False), (1, True), (2, True), (3, True), (5, True)]
    want = {r.book_id: r.embedding for r in embed(edited).collect()}
    assert {r.book_id: r.embedding for r in got.collect()} == want
    assert rows(refresh_vectors(edited, stored, embed, "another").where("not computed")) == []
    assert refresh_vectors(edited.limit(0), stored, embed, "hashed-8").count() == 0
    assert refresh_vectors(edited, stored.limit(0), embed, "hashed-8").where("computed").count() == 5


def test_no_scores_across_embedders(spark, books):
    from lectern.operators.postings import build_postings
    vectors = embed_with_origin(books, embed, "hashed-8")
    queries = spark.createDataFrame([(1, "title words")], "query_id long, text string")
    qv = hashed_vectors(queries, "query_id", F.col("text"), dim=8).withColumnRenamed("book_id", "query_id")
    search = lambda mark: hybrid_search(queries, build_postings(books), vectors, books, qv.withColumn("embedder", F.lit(mark)))
    assert search("hashed-8").count() == 6
    for mark in ("other", None):
        with pytest.raises(ValueError):
            search(mark)
    assert require_one_embedder(vectors) == "hashed-8" and require_one_embedder(vectors.limit(0)) is None
