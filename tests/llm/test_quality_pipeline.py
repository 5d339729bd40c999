"""Quality rules, the ordinal classifier and the pipeline."""

import random
import re

import numpy as np
import pytest

import corpus_pipeline
from lectern.llm import ordinal_quality as ordinal
from lectern.llm import outlier_rules as rules
from tests.llm.conftest import make, prose

BLANK = "[\x20\x09-\x0D]+"


def brute_counts(t):
    t = t or ""
    w = [x for x in re.split(BLANK, t) if x]
    lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    seen, covered = {}, set()
    for k in range(len(w) - 7):
        seen.setdefault(tuple(w[k:k + 8]), []).append(k)
    for at in seen.values():
        if len(at) > 1:
            covered |= {p for k in at for p in range(k, k + 8)}
    return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def good(seed, n=120):
    rng = random.Random(seed)
    return " ".join(rng.choice(["tree", "river", "walk", "stone", "quiet", "of", "the", "a", "lantern", "evening,", "road."]) + rng.choice(["", "s"]) for _ in range(n))


def test_counts_equal_brute_force(spark, edge):
    texts = [r.text for r in edge.collect()] + ["a b c d e f g h " * 3, "x\n" * 5, "a b c d e f g a b c d e f g", " lead\n\n lead\n lead ", "#*|<> & $%"]
    texts += [" ".join(random.Random(k).choices("abc", k=60)) for k in range(30)]
    docs = make(spark, [(k, t, "en", "s") for k, t in enumerate(texts)])
    got = {r.doc_id: tuple(r[c] for c in rules.COUNTS[:5]) for r in rules.with_statistics(docs.select("doc_id", "text")).collect()}
    assert got == {k: brute_counts(t) for k, t in enumerate(texts)}


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(k, good(k), "en", "big" if k % 3 else "small") for k in range(400)]
    rows += [(1000 + k, re.sub(r"(\w+)", r"\1###", good(k)), "en", "big") for k in range(12)]
    rows += [(2000 + k, re.sub(r"(\w+)", lambda m: m.group() + "!!!!", good(k)).upper(), "en", "small") for k in range(6)]
    rows += [(3000, "too short", "en", "big"), (3001, good(1, 30) + " " + " ".join(["again and again it says the same old thing"] * 9), "en", "big"),
             (3002, None, None, None), (3003, good(5), "xx", "rare"), (3004, good(6), None, None), (0, good(0), "en", "small")]
    return make(spark, rows)


def test_outliers_go_and_the_rest_stays(corpus):
    got = rules.judge(corpus).collect()
    assert len(got) == corpus.count()
    by = {r.doc_id: r for r in got}
    assert all(by[k].kept for k in range(400)) and by[3003].kept and by[3004].kept
    assert not any(by[k].kept for k in [*range(1000, 1012), *range(2000, 2006), 3000, 3001, 3002])
    assert {k for k in by if by[k].base_failed} == {3000, 3001, 3002}
    left = rules.keep_good(corpus)
    assert left.columns == corpus.columns and sorted(r.doc_id for r in left.collect()) == sorted(r.doc_id for r in got if r.kept)


def dense(est):
    low = np.zeros((rules.P, rules.P))
    for i in range(rules.P):
        for j in range(i + 1):
            low[i, j] = est[f"l{i}_{j}"]
    return np.array([est[f"m{i}"] for i in range(rules.P)]), low @ low.T


def squared(z, m, c):
    return np.einsum("ij,jk,ik->i", z - m, np.linalg.inv(c), z - m)


FLOORS = np.diag([f * f for _, f in rules.DIMENSIONS])


def least_determinant(z, starts, seed=0):
    """Brute force: concentration from many random small subsets, the smallest logarithm of a determinant."""
    rng, best = np.random.default_rng(seed), np.inf
    for _ in range(starts):
        core, last = z[rng.choice(len(z), 8, replace=False)], np.inf
        while True:
            m, c = core.mean(0), np.cov(core.T, bias=True) + FLOORS
            now = np.linalg.slogdet(c)[1]
            if len(core) > 8 and now > last - 1e-6:
                break
            last = now if len(core) > 8 else np.inf
            core = z[np.argsort(squared(z, m, c))[:(len(z) + 1) // 2]]
        best = min(best, last)
    return best


def test_estimates_equal_a_dense_computation(spark, corpus):
    """The half is a fixed point with a determinant no larger than that of 60 random starts; the estimate made from it is that
    of the rows within the limit."""
    from pyspark.sql import functions as F
    stats = corpus_pipeline.written(rules.with_statistics(corpus.select("doc_id", "lang", "source", "text")), "test-statistics").filter(~rules.base_failed())
    rows = stats.select(F.lit("g").alias("_g"), *[F.round(F.expr(e), 9).alias(f"z{i}") for i, (e, _) in enumerate(rules.DIMENSIONS)])
    rng = np.random.default_rng(3)
    mixed = rng.multivariate_normal(np.zeros(rules.P), np.eye(rules.P) + 0.6, 500)
    mixed[:200] = rng.normal(0, 1.2, (200, rules.P)) + np.array([5, -5, 0, 5, 0])
    mixed = spark.createDataFrame([("h", *map(float, r)) for r in np.round(mixed, 9)], rows.schema)
    rows = corpus_pipeline.written(rows.unionByName(mixed), "test-vectors")
    raw = {r["_g"]: r for r in corpus_pipeline.written(rules._scaled(rows, rules.minimum_determinant(rows)), "test-raw").collect()}
    last = {r["_g"]: r for r in rules.covariance_estimates(rows).collect()}
    for g in "gh":
        z = np.array([[r[f"z{i}"] for i in range(rules.P)] for r in rows.filter(F.col("_g") == g).collect()])
        m, c = dense(raw[g])
        d2 = squared(z, m, c)
        core = z[d2 <= np.quantile(d2, rules.KEEP)]
        assert np.abs(core.mean(0) - m).max() < 0.05 and np.abs(np.cov(core.T, bias=True) + FLOORS - c).max() < 0.05 * max(1, c.max())
        assert abs(np.linalg.slogdet(c)[1] - raw[g].lndet) < 1e-4 and raw[g].lndet < least_determinant(z, 60) + 0.05
        inside = z[d2 <= rules.REWEIGHT * raw[g].scale]
        m, c = dense(last[g])
        assert np.abs(inside.mean(0) - m).max() < 1e-3 and np.abs(np.cov(inside.T, bias=True) + FLOORS - c).max() < 1e-3


@pytest.mark.parametrize("share", [30, 40])
def test_a_group_with_much_junk_is_cleaned(spark, share):
    junk = {k for k in range(500) if k % 100 < share}
    rows = [(k, re.sub(r"(\w+)", r"\1###" if k % 2 else r"99 \1 7,5", good(k)) if k in junk else good(k), "en", "s") for k in range(500)]
    kept = {r.doc_id for r in rules.judge(make(spark, rows)).filter("kept").select("doc_id").collect()}
    assert kept == set(range(500)) - junk


def test_rules_edges(spark, edge, empty):
    got = rules.judge(edge).collect()
    assert len(got) == edge.count() and {r.doc_id for r in got if r.base_failed} >= {2, 3, 4, 5}
    assert rules.judge(empty).count() == 0 and rules.keep_good(empty).count() == 0


def rated(n, seed):
    rng, rows = random.Random(seed), []
    for k in range(n):
        g = rng.choice([0, 1, 2, 2, 2])
        w = good(seed * 100_000 + k, 60).split()
        for _ in range(4 if g == 0 else 0):
            w.insert(rng.randrange(len(w)), rng.choice(["vile", "nasty,", "Rotten"]))
        rows.append((k, " ".join(x + "$$" for x in w) if g == 1 else " ".join(w), g))
    return rows


def test_classifier_on_held_out_rows(spark):
    rows, new = rated(900, 1), rated(300, 2)
    docs = make(spark, [(k, t, "en", "s") for k, t, _ in rows])
    grades = spark.createDataFrame([(k, g) for k, _, g in rows], "doc_id long, grade int")
    sample = ordinal.rating_sample(docs, grades, 600)
    assert 450 < sample.count() < 750
    w, theta = ordinal.train(sample, 3)
    assert theta[0] < theta[1]
    got = {r.doc_id: r for r in ordinal.score(make(spark, [(k, t, "en", "s") for k, t, _ in new]), w, theta).collect()}
    right = np.mean([got[k].selected == (g == 2) for k, _, g in new])
    mean = [np.mean([got[k].expected_grade for k, _, x in new if x == g]) for g in range(3)]
    assert right > 0.95 and mean[0] < mean[1] < mean[2]


def test_loss_slope_is_the_derivative():
    theta = np.array([-0.4, 0.9])
    like = lambda f, y: np.diff(np.concatenate([[1.0], ordinal._sigmoid(f - theta), [0.0]]))[y] * -1
    for y in range(3):
        p = ordinal._sigmoid(0.3 - theta)
        up, down = (p[y - 1] if y else 1.0), (p[y] if y < 2 else 0.0)
        want = -(np.log(like(0.3 + 1e-6, y)) - np.log(like(0.3 - 1e-6, y))) / 2e-6
        assert abs(want - (up + down - 1)) < 1e-5


def test_classifier_fit_does_not_depend_on_the_order_of_rows(spark):
    rows = [(k // 2, t, "en", "s") for k, (_, t, _) in enumerate(rated(200, 3))]
    grades = spark.createDataFrame([(k, k % 3) for k in range(100)], "doc_id long, grade int")
    fits = [ordinal.train(ordinal.rating_sample(make(spark, r), grades, 200), 3) for r in (rows, rows[::-1])]
    assert fits[0][0].any() and (fits[0][0] == fits[1][0]).all() and (fits[0][1] == fits[1][1]).all()


def test_classifier_edges(spark, edge, empty):
    none = spark.createDataFrame([], "doc_id long, grade int")
    w, theta = ordinal.train(ordinal.rating_sample(edge, none), 3)
    assert not w.any() and ordinal.score(edge, w, theta).count() == edge.count() and ordinal.score(empty, w, theta).count() == 0
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, None, 1), (None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    assert {r.doc_id: r.grade for r in ordinal.grades_from_labels(labels).collect()} == {1: 1, 2: 0, 3: 2}


def test_pipeline_stages_take_effect(spark, tmp_path):
    base = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{base}/documents.parquet")
    seen, rows = [], docs
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.written(stage(spark, rows, base), f"test-{name}")
        seen.append(out.count())
        if name != "sharding":
            assert out.columns == docs.columns
            assert out.select("doc_id", "text").distinct().exceptAll(rows.select("doc_id", "text").distinct()).count() == 0
        rows = out
    assert docs.count() > seen[0] > seen[1] >= seen[2] and seen[3] == seen[4] > 0
