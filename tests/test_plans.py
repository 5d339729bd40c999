"""Plan shape: the properties the scale design relies on, read from ``explain()``."""

import contextlib
import io

from pyspark.sql import functions as F

from conftest import rows
from lectern.operators.joins import sized_join
from lectern.operators.postings import build_postings
from lectern.operators.retrieval import candidate_books, query_tokens, top_n
from lectern.plans.checks_search import q_hybrid_topn

SF = "/root/testdata/sf0.001"


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_hybrid_plan_limits_before_shuffle_and_prunes_columns(spark):
    p = plan(q_hybrid_topn(spark, SF))
    assert p.count("WindowGroupLimit") >= 2          # partial (map side) and final
    assert "n_chars" not in p and "lang" not in p    # unused document columns never read


def test_index_build_has_no_shuffle_on_split_input(spark):
    n = spark.sparkContext.defaultParallelism
    books = spark.range(0, 200, 1, n).select(F.col("id").alias("book_id"),
                                             F.concat(F.lit("word"), F.col("id") % 7).alias("title"),
                                             F.lit("a").alias("author"), F.lit("d").alias("description"))
    assert "Exchange" not in plan(build_postings(books), "simple")


def test_salted_lookup_equals_broadcast_lookup(spark):
    post = spark.createDataFrame([("hot", i) for i in range(50)] + [("cold", 1), ("warm", 2)], "token string, book_id long")
    q = spark.createDataFrame([(0, "hot cold"), (1, "warm nothing"), (2, "the")], "query_id long, text string")
    qt = query_tokens(q)
    assert rows(candidate_books(qt, post, max_broadcast_rows=0)) == rows(candidate_books(qt, post))
    assert "Exchange" in plan(candidate_books(qt, post, max_broadcast_rows=0), "simple")


def test_sized_join_left_salted_keeps_unmatched(spark):
    big = spark.createDataFrame([(i % 3, i) for i in range(12)], "k long, v long")
    small = spark.createDataFrame([(0, "zero"), (1, "one")], "k long, name string")
    assert rows(sized_join(big, small, ["k"], "left", max_rows=0)) == rows(big.join(small, "k", "left"))


def test_top_n_plan_uses_group_limit(spark):
    s = spark.range(100).select((F.col("id") % 5).alias("query_id"), F.col("id").alias("book_id"),
                                (F.col("id") * 0.01).alias("similarity"))
    assert "WindowGroupLimit" in plan(top_n(s, 3), "simple")


def test_salted_semi_and_anti_joins_match_plain_joins(spark):
    from lectern.operators.joins import salted_join
    big = spark.createDataFrame([(i % 4, i) for i in range(40)], "k long, v long")
    small = spark.createDataFrame([(1,), (3,), (9,)], "k long")
    for how in ("left_semi", "left_anti", "inner"):
        assert rows(salted_join(big, small, ["k"], how, salt=5)) == rows(big.join(small, "k", how)), how
