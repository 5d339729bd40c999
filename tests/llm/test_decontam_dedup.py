"""Decontamination and near-duplicates against brute force, and edge rows."""

import random
import re

import pytest

from lectern.llm import prefix_decontam as decon
from lectern.llm import tensor_dedup as dedup
from tests.llm.conftest import make, prose


def item_words(t):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))


def brute_contamination(docs, items):
    out = []
    for i, t in docs:
        w, hit, names = item_words(t), set(), set()
        for item, text in items:
            v = item_words(text)
            n = min(13, len(v))
            wins = {tuple(v[k:k + n]) for k in range(len(v) - n + 1)} if n else set()
            for k in range(len(w) - n + 1) if n else ():
                if tuple(w[k:k + n]) in wins:
                    hit |= set(range(k, k + n))
                    names.add(str(item))
        out.append((i, len(w), len(hit), ",".join(sorted(names)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def as_rows(df):
    return sorted([(r.doc_id, r.n_words, r.n_hit, ",".join(r["items"]), r.contaminated) for r in df.collect()], key=str)


def test_windows_equal_brute_force(spark):
    rng = random.Random(6)
    long = [prose(k, 30, 40) for k in range(4)]
    items = [(k, t) for k, t in enumerate(long)] + [(10, long[0]), (11, "Short Étude!"), (12, "solo"), (13, None), (14, "..."), (15, long[1][:60]), (16, "a b K")]
    rows = [(k, prose(100 + k, rng.randint(0, 200), 40)) for k in range(40)]
    for k in range(60):
        w, p = prose(200 + k, rng.randint(0, 60), 500).split(), rng.choice(long).split()
        a = rng.randrange(len(p))
        rows.append((300 + k, " ".join([*w[:20], *p[a:a + rng.randint(5, 30)], *w[20:], rng.choice(["SHORT, Étude", "short étude", "Solo.", "solo-solo", "", "A-B\u212a", "a b k"])])))
    rows += [(None, long[2]), (None, None), (5000, ""), (5001, long[3] * 3), (5001, long[3] * 3)]
    docs = make(spark, [(i, t, "en", "s") for i, t in rows])
    bench = spark.createDataFrame([(*x, "t") for x in items], "item_id long, text string, seen string")
    assert as_rows(decon.contamination(docs, bench)) == brute_contamination(rows, items)
    left = {r.doc_id for r in decon.drop_contaminated(docs, bench).collect()}
    assert left == {r[0] for r in brute_contamination(rows, items) if not r[4]}


def test_decontamination_edges(spark, edge, empty):
    bench = spark.createDataFrame([(1, "the cat sat"), (None, "one")], "item_id long, text string")
    want = brute_contamination([(r.doc_id, r.text) for r in edge.collect()], [(1, "the cat sat")])
    assert as_rows(decon.contamination(edge, bench)) == want
    assert decon.contamination(empty, bench).count() == 0
    none = decon.contamination(edge, bench.limit(0)).collect()
    assert len(none) == edge.count() and not any(r.n_hit or r.contaminated for r in none)
    assert decon.drop_contaminated(edge, bench).columns == edge.columns


def sets_of(t, k=2):
    w = (t or "").encode().lower().split()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)]) if w else frozenset()


def brute_components(rows, percent=80, k=2):
    sets = [(i, sets_of(t, k)) for i, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, (_, x) in enumerate(sets):
        for b, (_, y) in enumerate(sets[:a]):
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                up[find(a)] = find(b)
    low = {}
    for a, (i, _) in enumerate(sets):
        if i is not None:
            low[find(a)] = min(low.get(find(a), i), i)
    return sorted([(i, len(x), low.get(find(a)) if x else i) for a, (i, x) in enumerate(sets)], key=str)


def edited(text, n, seed):
    rng = random.Random(seed)
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
    return " ".join(w)


@pytest.fixture(scope="module")
def copies():
    rows = [(k, prose(k, 80)) for k in range(60)]
    for k in range(20):  # near copies on both sides of the limit, and chains of them
        base = rows[k][1]
        for j in range(6):
            rows.append((1000 + 10 * k + j, edited(base, 1 + (k + j) % 8, 31 * k + j)))
            base = rows[-1][1] if k % 2 else base
    hub = prose(999, 120)
    rows += [(5000 + k, edited(hub, 5, k)) for k in range(120)]  # one large group of near copies
    rows += [(9000 + k, hub) for k in range(30)] + [(1, rows[1][1]), (None, hub), (None, "Alone Here"), (8000, None), (8001, ""), (8002, " \n"), (8003, "One"), (8004, "one"), (8005, "x" * 100_000)]
    return rows


def test_components_equal_brute_force(spark, copies):
    got = dedup.near_duplicates(make(spark, [(i, t, "en", "s") for i, t in copies])).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=str) == brute_components(copies)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_one_document_of_each_group_stays(spark, copies):
    docs = make(spark, [(i, t, "en", "s") for i, t in copies])
    left = dedup.drop_near_duplicates(docs, shingle=5)
    want = brute_components(copies, k=5)
    assert left.columns == docs.columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted({i for i, n, c in want if i == c}, key=str)


def test_pivots_do_not_lose_links(spark, copies):
    """Without pivot rounds all bucket mates go to the prefix join: the same components must come out."""
    docs = make(spark, [(i, t, "en", "s") for i, t in copies if i is not None and i >= 1000])
    one, two = (sorted((r.doc_id, r.component_id) for r in dedup.near_duplicates(docs, pivots=p).collect()) for p in (0, 3))
    assert one == two


def test_components_of_paths_stars_and_rings(spark):
    edges = [(k, k + 1) for k in range(100, 140)] + [(1, k) for k in range(2, 60)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    got = {r.node: r.root for r in dedup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 100 for k in range(100, 141)) and all(got[k] == 1 for k in range(1, 60)) and {got[200], got[201], got[202]} == {200}
    assert dedup.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_dedup_edges(spark, edge, empty):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    got = sorted([(r.doc_id, r.n_shingles, r.component_id) for r in dedup.near_duplicates(edge).collect()], key=str)
    assert got == brute_components(rows)
    assert dedup.near_duplicates(empty).count() == 0 and dedup.drop_near_duplicates(empty).count() == 0


def test_wordless_rows_under_linked_ids_in_many_partitions(spark):
    rows = [(1, "a b c d e f g h i j", "en", "s"), (2, "a b c d e f g h i j k", "en", "s"), (5, "x y z", "en", "s"), (1, "", "en", "s"), (1, None, "en", "s")]
    got = dedup.near_duplicates(make(spark, rows).repartition(5), shingle=2).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == [(1, 0, 1, True), (1, 0, 1, True), (1, 9, 1, True), (2, 10, 1, False), (5, 2, 5, True)]


def test_near_copies_without_ids_keep_one(spark):
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"
    rows = [(None, base, "en", "s"), (None, base + " more", "en", "s"), (None, base.upper(), "en", "s"), (None, "quite another text of its own words", "en", "s")]
    left = dedup.drop_near_duplicates(make(spark, rows), 2, 80).collect()
    assert len(left) == 2 and {"quite another text of its own words"} < {r.text for r in left}


def test_further_columns_with_the_operators_names_stay(spark):
    from tests.llm.conftest import CLASHES
    docs = make(spark, [(1, "a b c d e f g h", "en", "s"), (2, "a b c d e f g h", "en", "s")])
    bench = spark.createDataFrame([("i", "q r s")], "item_id string, text string")
    for out in (dedup.drop_near_duplicates(docs), decon.drop_contaminated(docs, bench)):
        assert out.columns == docs.columns and all([r[c] for c in CLASHES] == CLASHES for r in out.collect()) and out.count() >= 1
