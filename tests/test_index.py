from pyspark.sql import functions as F

from conftest import rows
from lectern.operators.postings import build_postings, parse_postings, postings_array, prune_postings, vocabulary


def _books(spark):
    return spark.createDataFrame(
        [(0, "Moss Garden", "Ito", "This is all about a garden of moss and stone."),
         (1, "Herb Garden", "Vidal", "This is about thyme; thyme and sage.")],
        "book_id long, title string, author string, description string")


def test_postings_are_distinct_pairs(spark):
    p = build_postings(_books(spark))
    got = rows(p)
    assert len(got) == len(set(got))
    assert ("moss", 0) in got and ("moss", 1) not in got and ("thyme", 1) in got
    assert ("garden", 0) in got and ("garden", 1) in got
    assert not any(t in ("this", "is", "a", "about") for t, _ in got)


def test_array_view_blocks_are_bounded(spark):
    p = spark.createDataFrame([("hot", i) for i in range(10)] + [("cold", 3)], "token string, book_id long")
    arr = postings_array(p, block=4)
    got = rows(arr, "token", "block", "doc_ids", "n_docs")
    assert got == [("cold", 0, "3", 1), ("hot", 0, "0,1,2,3", 4), ("hot", 1, "4,5,6,7", 4), ("hot", 2, "8,9", 2)]


def test_parse_postings_text(spark):
    df = spark.createDataFrame([("a", "1,2,2"), ("b", ""), ("c", None), ("a", "5"), ("d", "x, 7,1e3")], "token string, doc_ids string")
    got = rows(parse_postings(df))
    assert got == sorted([("a", 1), ("a", 2), ("a", 5), ("b", None), ("c", None), ("d", 7)], key=lambda r: (r[0], r[1] or -1))
    voc = rows(vocabulary(parse_postings(df)))
    assert voc == [("a", 3), ("d", 1)]


def test_prune_to_live_books(spark):
    p = build_postings(_books(spark))
    live = spark.createDataFrame([(1,)], "book_id long")
    assert {b for _, b in rows(prune_postings(p, live))} == {1}


def test_parse_postings_keeps_order_and_leaves_out_what_is_no_id(spark):
    df = spark.createDataFrame([("a", " 3, 1,x,3,,1.5,\t2"), ("b", None), ("c", "x,"), ("d", "99999999999999999999,4")], "token string, doc_ids string")
    got = [tuple(r) for r in parse_postings(df).collect()]
    assert got == [("a", 3), ("a", 1), ("a", 2), ("b", None), ("c", None), ("d", 4)]
    plan = parse_postings(df)._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan  # the parts are cast in compiled code, not in a function per part
