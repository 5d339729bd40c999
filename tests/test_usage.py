"""The README's usage flow on the smoke tables: index build, search, a change batch, and the same requests as a
stream, which must end in the same catalogue as the one-shot batch."""

from pyspark.sql import functions as F

from conftest import rows
from lectern.operators.changes import apply_requests
from lectern.operators.embed import hashed_vectors
from lectern.plans.index_build import build_index
from lectern.plans.search import hybrid_search
from lectern.plans.standins import (books_from_documents, change_requests_from_events, queries_from_benchmark, table,
                                    vectors_from_embeddings)
from lectern.session import scratch_path
from lectern.sources.readers import parse_change_requests
from lectern.sources.versioned import latest_version, read_version
from lectern.streaming.changes import publish_initial, run_change_stream

SF = "/root/testdata/sf0.001"


def test_readme_flow(spark):
    books = books_from_documents(table(spark, SF, "documents"))
    idx = build_index(spark, books, scratch_path(spark, "usage"), vectors=vectors_from_embeddings(table(spark, SF, "embeddings")),
                      dim=64)
    queries = queries_from_benchmark(table(spark, SF, "benchmark"))
    qv = hashed_vectors(queries, "query_id", F.col("text"), dim=64).withColumnRenamed("book_id", "query_id")
    assert hybrid_search(queries, idx["postings"], idx["vectors"], idx["books"], qv).count() > 0

    requests = parse_change_requests(change_requests_from_events(table(spark, SF, "events")))
    batch = apply_requests(idx["books"], requests, postings=idx["postings"])
    root, inbox = scratch_path(spark, "usage-stream"), scratch_path(spark, "usage-req")
    requests.select("seq", "action", "book_data", "book_ids").write.json(inbox)  # one JSON request per line
    publish_initial(spark, root, idx["books"], idx["postings"])
    run_change_stream(spark, inbox, root, scratch_path(spark, "usage-ckpt")).awaitTermination()
    streamed = read_version(spark, root, "books", latest_version(spark, root))
    assert rows(streamed) == rows(batch.books)
