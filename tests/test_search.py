import math

from pyspark.sql import functions as F

from conftest import rows
from lectern.functions.text import compose_text
from lectern.operators.embed import hashed_vectors
from lectern.operators.postings import build_postings
from lectern.operators.retrieval import top_n
from lectern.plans.search import hybrid_search, result_page


def _catalogue(spark):
    books = spark.createDataFrame(
        [(0, "Field Guide to Owls", "Ama Boateng", "Night birds and their calls, a guide.", "i-0", 1988, "nature"),
         (1, "Field Guide to Ferns", "Jun Sato", "Fronds, spores and damp places: a guide.", "i-1", 1994, "nature"),
         (2, "Clock Repair", "Ama Boateng", "Springs, gears and patience.", "i-2", None, "craft")],
        "book_id long, title string, author string, description string, isbn string, publish_year int, genre string")
    return books, build_postings(books), hashed_vectors(books, dim=32)


def _search(spark, texts, **kw):
    books, post, vec = _catalogue(spark)
    q = spark.createDataFrame(list(enumerate(texts)), "query_id long, text string")
    qv = hashed_vectors(q, "query_id", F.col("text"), dim=32).withColumnRenamed("book_id", "query_id")
    return hybrid_search(q, post, vec, books, qv, **kw)


def test_a_word_finds_only_the_books_that_have_it(spark):
    got = rows(_search(spark, ["owls", "the guide", "GEARS of Ama"]), "query_id", "book_id")
    assert got == [(0, 0), (1, 0), (1, 1), (2, 0), (2, 2)]


def test_no_valid_token_gives_no_rows(spark):
    assert _search(spark, ["the of and", "zzzz unknownword"]).count() == 0


def test_candidate_without_vector_is_dropped(spark):
    books, post, vec = _catalogue(spark)
    q = spark.createDataFrame([(0, "guide")], "query_id long, text string")
    qv = hashed_vectors(q, "query_id", F.col("text"), dim=32).withColumnRenamed("book_id", "query_id")
    got = rows(hybrid_search(q, post, vec.where("book_id = 1"), books, qv), "book_id")
    assert got == [(1,)]


def test_ties_break_by_book_id_and_topn_is_prefix(spark):
    scored = spark.createDataFrame([(0, b, s) for b, s in [(5, 0.5), (3, 0.5), (9, 0.9), (1, 0.1), (7, 0.5)]],
                                   "query_id long, book_id long, similarity double")
    full = rows(top_n(scored, 10), "rank", "book_id")
    assert full == [(1, 9), (2, 3), (3, 5), (4, 7), (5, 1)]
    assert rows(top_n(scored, 3), "rank", "book_id") == full[:3]


def test_scores_are_cosines_in_range(spark):
    r = _search(spark, ["guide to night birds and spores"]).collect()
    assert len(r) == 2 and all(-1 - 1e-9 <= x["similarity"] <= 1 + 1e-9 for x in r)


def test_result_page_projection(spark):
    books, post, vec = _catalogue(spark)
    q = spark.createDataFrame([(0, "owls guide")], "query_id long, text string")
    qv = hashed_vectors(q, "query_id", F.col("text"), dim=32).withColumnRenamed("book_id", "query_id")
    page = result_page(q, post, vec, books, qv)
    assert page.columns == ["query_id", "rank", "book_id", "isbn", "title", "author", "year", "description", "cover",
                            "similarity", "band"]
    first = page.orderBy("rank").first()
    assert first["cover"] == "" and first["band"] in ("green", "orange", "red")
    assert math.isclose(first["similarity"], round(first["similarity"], 2))


def test_lemmatised_index_and_queries_meet(spark):
    from lectern.plans.index_build import build_index
    from lectern.session import scratch_path
    books = spark.createDataFrame(
        [(0, "Stories of churches", "Ann", "boxes", "1", 1, "g"), (1, "A story", "Bob", "one church box", "2", 2, "g")],
        "book_id long, title string, author string, description string, isbn string, publish_year int, genre string")
    idx = build_index(spark, books, scratch_path(spark, "lemma-index"), dim=16, lemmatize=True)
    toks = {t for t, b in rows(idx["postings"]) if b == 0}
    assert {"story", "church", "box"} <= toks and "stories" not in toks
    q = spark.createDataFrame([(0, "churches")], "query_id long, text string")
    qv = hashed_vectors(q, "query_id", F.col("text"), dim=16).withColumnRenamed("book_id", "query_id")
    hits = hybrid_search(q, idx["postings"], idx["vectors"], idx["books"], qv, lemmas=idx["lemmas"])
    assert sorted(r["book_id"] for r in hits.collect()) == [0, 1]


def test_scores_by_blocks_equal_scores_by_pair(spark):
    from lectern.operators.retrieval import score_candidates
    n = 700
    pairs = [(q, b, q + b) for q in range(n) for b in (q % 7, q % 11)] + [(5, 99, 0), (n + 5, 1, 0)]
    cands = spark.createDataFrame(sorted(set(pairs)), "query_id long, book_id long, extra long")
    vecs = spark.createDataFrame([(b, [float(b), 1.0, -2.0]) for b in range(11)] + [(42, [0.0, 0.0, 0.0])], "book_id long, embedding array<double>")
    qv = spark.createDataFrame([(q, [1.0, float(q % 5), 0.5]) for q in range(n)], "query_id long, embedding array<double>")

    def brute(q, b):
        u, v = [1.0, q % 5, 0.5], [b, 1.0, -2.0]
        return round(sum(x * y for x, y in zip(u, v)) / (math.hypot(*u) * math.hypot(*v)), 9)
    want = sorted((q, b, e, brute(q, b)) for q, b, e in set(pairs) if b < 11 and q < n)
    for most in (1000, 0):          # broadcast query vectors, then blocks of them
        got = score_candidates(cands, vecs, qv, max_broadcast_rows=most, carry=["extra"])
        assert sorted((r.query_id, r.book_id, r.extra, round(r.similarity, 9)) for r in got.collect()) == want
        all_ = score_candidates(cands, vecs, qv, max_broadcast_rows=most, missing=0.0).collect()
        assert len(all_) == len(set(pairs)) and {(r.query_id, r.book_id) for r in all_ if r.similarity == 0.0} >= {(5, 99), (n + 5, 1)}


def test_session_search_runs_every_session_on_all_books(spark, tmp_path):
    from lectern.plans.checks_search import q_session_search
    conv = [(c, t, role, f"green turtles {c}") for c in (0, 1, 20, 39, 40) for t, role in ((0, "user"), (1, "assistant"), (2, "user"))]
    spark.createDataFrame(conv, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    docs = [(i, f"Turtles\nnumber {i}", "en", "web") for i in (1, 20, 33)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.query_id, r.book_id) for r in q_session_search(spark, str(tmp_path)).collect()}
    assert got == {(f"{c}:{t}", b) for c in (0, 1, 20, 39, 40) for t in (0, 2) for b in (1, 20, 33)}


def _many(spark, queries=60, seed=5):
    """Books with copies of vectors, a repeated id, null ids and books without a vector; queries with zero vectors, rare words and no word."""
    import random
    r = random.Random(seed)
    words = [f"w{chr(97 + k)}" for k in range(12)] + ["rare"]
    books = [(b, " ".join(r.sample(words[:12], 3)) + (" rare" if b in (7, 90) else "")) for b in range(120)] + [(5, "wa wb"), (None, "wa")]
    post = [(w, b) for b, t in books for w in t.split()] + [("wa", 500), (None, 3)]
    vec = [(b, [float(r.randint(-2, 2)) for _ in range(4)]) for b, _ in books[:-1]] + [(b + 200, [1.0, 1.0, 0.0, 0.0]) for b in range(60)]
    post += [("wb", b + 200) for b in range(59, -1, -1)]
    vec += [(300, [1.0, 1.0, 0.0, 1e-9]), (301, [2.0, 2.0, 0.0, 0.0]), (None, [1.0] * 4)]
    post += [("wb", 300), ("wb", 301)]
    asked = [(f"q{i}", " ".join(r.sample(words[:12], 2))) for i in range(queries)] + [("zero", "wa wb"), ("rare", "rare"), ("none", "unknown"), ("empty", None), ("like", "wb"), (None, "wa")]
    qvec = [(q, [0.0] * 4 if q == "zero" else [1.0, 1.0, 0.0, 0.0] if q == "like" else [float(r.randint(-2, 2)) for _ in range(4)]) for q, _ in asked] + [("q1", [1.0, 0.0, 0.0, 0.0])]
    make = spark.createDataFrame
    return (make(asked, "query_id string, text string"), make(post, "token string, book_id long"), make(vec, "book_id long, embedding array<double>"),
            make([(b, f"t{b}") for b in {b for b, _ in vec if b is not None}], "book_id long, title string"), make(qvec, "query_id string, embedding array<double>"))


def test_search_by_blocks_gives_the_hits_of_the_search_by_pairs(spark):
    q, post, vec, books, qvec = _many(spark)
    for n, decimals in ((4, 12), (3, 2)):
        how = dict(top_n_rows=n, score_decimals=decimals)
        pairs, blocks = (hybrid_search(q, post, vec, books, qvec, **how, blocks_from=k) for k in (10 ** 9, 0))
        assert blocks.columns == pairs.columns and blocks.schema["query_id"].dataType == pairs.schema["query_id"].dataType
        assert sorted(map(tuple, blocks.collect())) == sorted(map(tuple, pairs.collect())) != []


def test_blocks_hand_on_few_pairs_whichever_way_they_meet(spark, monkeypatch):
    from lectern.operators import nearest
    from lectern.operators.retrieval import candidate_books, query_tokens
    q, post, vec, _, qvec = _many(spark)
    qt = query_tokens(q)
    every = {tuple(r) for r in candidate_books(qt, post).join(vec, "book_id").select("query_id", "book_id").collect()}
    found = []
    for most, size in ((0, 7), (10 ** 9, 4096)):   # pairs of partitions and blocks of few rows, then broadcast and of many
        monkeypatch.setattr(nearest, "BOOK_BLOCK", 16 * size), monkeypatch.setattr(nearest, "QUERY_BLOCK", size)
        monkeypatch.setattr(nearest, "CHUNK", 3 if size == 7 else 512), monkeypatch.setattr(nearest, "BIT_BYTES", 100 if size == 7 else 2 ** 26)
        got = {tuple(r) for r in nearest.nearest_candidates(qt, post, vec, qvec, 3, 4, 12, most).collect()}
        assert got <= every and len(got) * 3 < len(every)
        assert {x for x in got if x[0] == "rare"} == {("rare", 7), ("rare", 90)}
        found.append({x for x in got if x[0] == "like"})
    assert all(("like", b) in f for f in found for b in (200, 201, 202))   # of books with the same vector, the first ids


def test_odd_vectors_are_told_from_even_ones(spark):
    from lectern.operators.nearest import even_length
    make = lambda *rows: spark.createDataFrame([(list(x) if x is not None else None,) for x in rows], "embedding array<double>")
    assert even_length(make((1.0, 2.0)), make((0.0, 0.0), (3.0, -1.0))) == 2
    for odd in ((1.0,), None, (1.0, None), (math.nan, 1.0), (math.inf, 1.0)):
        assert even_length(make((1.0, 2.0)), make((0.0, 0.0), odd)) is None
