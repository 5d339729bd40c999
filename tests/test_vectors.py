import math

from pyspark.sql import functions as F

from lectern.functions.vectors import cosine, euclidean, l2_normalize, parse_vector_text
from lectern.operators.embed import coverage_gaps, hashed_vectors


def test_hashed_vector_has_configured_length_and_unit_norm(spark):
    df = spark.createDataFrame([(1, "Sample book description", "", ""), (2, None, None, None)],
                               "book_id long, title string, author string, description string")
    got = {r["book_id"]: r["embedding"] for r in hashed_vectors(df, dim=768).collect()}
    assert len(got[1]) == 768 and math.isclose(sum(x * x for x in got[1]), 1.0, rel_tol=1e-9)
    # "Title", "Author", "Description" labels are words too; a book without text still has them.
    assert len(got[2]) == 768


def test_vector_text_parse(spark):
    df = spark.createDataFrame([("[ 0.1  -2e-3\n 3.5E+1 ]",), ("[]",)], "s string")
    got = [r[0] for r in df.select(parse_vector_text("s")).collect()]
    assert [round(x, 6) for x in got[0]] == [0.1, -0.002, 35.0] and got[1] == []


def test_cosine_zero_vector_and_normalize(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 2.0]), ([3.0, 4.0], [3.0, 4.0])], "a array<double>, b array<double>")
    r = df.select(cosine("a", "b").alias("c"), euclidean("a", "b").alias("e"), l2_normalize("a").alias("n")).collect()
    assert r[0]["c"] == 0.0 and r[0]["n"] == [0.0, 0.0]
    assert math.isclose(r[1]["c"], 1.0) and r[1]["e"] == 0.0 and r[1]["n"] == [0.6, 0.8]


def test_coverage_gaps(spark):
    books = spark.createDataFrame([(1,), (2,)], "book_id long")
    vecs = spark.createDataFrame([(2, [1.0]), (3, [1.0])], "book_id long, embedding array<double>")
    assert sorted(tuple(r) for r in coverage_gaps(books, vecs).collect()) == [("missing", 1), ("orphan", 3)]


def test_hashed_vectors_of_null_empty_and_many_rows(spark):
    """Batches longer than a counting slice, null and empty texts, against a plain count."""
    import hashlib
    from pyspark.sql import functions as F
    from lectern.operators.embed import COUNT_ROWS, hashed_vectors
    texts = {i: None if i % 7 == 0 else "" if i % 7 == 1 else " ".join(["turtle", "abcde"[i % 5] * 3, "car", "turtle"]) for i in range(2 * COUNT_ROWS + 3)}
    df = spark.createDataFrame(list(texts.items()), "book_id long, t string").coalesce(1)
    got = {r.book_id: list(r.embedding) for r in hashed_vectors(df, text=F.col("t"), dim=4, unit=False).collect()}
    for i, t in texts.items():
        want = [0.0] * 4
        for w in (t or "").split():
            h = int(hashlib.md5(w.encode()).hexdigest()[:8], 16)
            want[h % 4] += 1.0 if h // 4 % 2 == 0 else -1.0
        assert got[i] == want


def test_pair_score_is_the_column_form_on_odd_pairs(spark):
    """Cosine and Euclid on Arrow batches against the forms per element: nulls, unequal lengths, zero and empty vectors."""
    from lectern.functions.vectors import cosine_unit, norm, pair_score
    odd = [([1.0, 2.0], [3.0, -4.0]), ([0.0, 0.0], [1.0, 1.0]), ([1.0], [1.0, 2.0]), ([1.0, 2.0], [5.0]), (None, [1.0]), ([1.0], None),
           ([], []), ([1.0, None], [2.0, 3.0]), ([1.0, 2.0], [None, 3.0])]
    even = [([float(i), 1.0, -2.0], [0.5, float(i % 7), 3.0]) for i in range(2500)]
    for pairs in (odd, even):
        df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a array<double>, b array<double>").coalesce(1)
        df = df.withColumn("an", norm("a")).withColumn("bn", norm("b"))
        got = df.select(cosine_unit("a", "b", "an", "bn").alias("c"), pair_score("a", "b", "an", "bn").alias("c2"),
                        euclidean("a", "b").alias("e"), pair_score("a", "b", "an", "bn", "euclidean").alias("e2")).collect()
        for r in got:
            for x, y in ((r.c, r.c2), (r.e, r.e2)):
                assert (x is None) == (y is None) and (x is None or math.isclose(x, y, rel_tol=1e-12, abs_tol=1e-12)), r


def test_short_vectors_are_scored_on_arrow_batches(spark):
    from lectern.operators.retrieval import score_candidates
    pairs = spark.createDataFrame([(0, 1)], "query_id long, book_id long")
    v = spark.createDataFrame([(1, [3.0, 4.0])], "book_id long, embedding array<double>")
    got = score_candidates(pairs, v, spark.createDataFrame([(0, [3.0, 4.0])], "query_id long, embedding array<double>"))
    assert "zip_with" not in got._jdf.queryExecution().executedPlan().toString() and math.isclose(got.first().similarity, 1.0)
