import random
import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
from pyspark.sql import functions as F

from lectern.llm import merkle_manifest as mm
from tests.llm.conftest import EDGE_ROWS, make


def h(s):
    return sha256(s.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(level):
    """All levels of a tree, bottom first."""
    out = [level]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][k:k + 3])) for k in range(0, len(out[-1]), 3)])
    return out


def path(levels, at):
    for row in levels[:-1]:
        run = at - at % 3
        yield "".join(row[run:at]), "".join(row[at + 1:run + 3])
        at //= 3


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        i, source, lang, n, text = r
        claim = leaf(r)
        if i is not None and text is not None and zlib.crc32(str(i).encode()) % 2 == 0:
            claim = leaf((i, source, lang, n, text.replace("\n", "")))
        groups[source].append((i is not None, i or 0, leaf(r), claim, i))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(groups[s])]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        above = list(path(top, k))
        for at, (_, _, lf, claim, i) in enumerate(sorted(groups[s])):
            steps = [*path(trees[s], at), *above]
            for a, b in steps:
                claim = h(a + claim + b)
            out.append((i, lf, trees[s][-1][0], top[-1][0], h("".join(a + b for a, b in steps)), claim, claim == top[-1][0]))
    return sorted(out, key=str)


def judged(spark, docs):
    return sorted(map(tuple, mm.proofs(mm.manifest(docs, claimed=mm.stripped_leaf())).collect()), key=str)


def test_blocks_of_a_large_source(spark):
    rng = random.Random(4)
    rows = [(k, rng.choice(["hot", "hot", "hot", "é", None, f"s{k % 30}"]), rng.choice([None, "en"]), rng.choice([None, k]), rng.choice(["a\nb", "plain", None, "", f"{k}\n\n"]))
            for k in rng.sample(range(-500, 20_000), 4200)]
    rows += [(7_000_000, "hot", "en", 1, "equal\nrows")] * 900
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert max(np.unique([str(r[1]) for r in rows], return_counts=True)[1]) > 3 * mm.BLOCK
    assert judged(spark, docs) == brute(rows)


def test_edges(spark, edge, empty):
    rows = [(i, s, la, len(t or ""), t) for i, t, la, s in EDGE_ROWS]
    assert judged(spark, edge) == brute(rows)
    assert judged(spark, empty) == []
    one = [(5, "s", None, 3, "x\ny")]
    assert judged(spark, make(spark, [(5, "x\ny", None, "s")])) == brute(one)


def test_proofs_of_a_few_leaves(spark):
    rows = [(k, "s" if k % 5 else "t", "en", 4, f"text {k}") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    made = mm.manifest(docs)
    some = mm.proofs(made, made.leaves.where(F.col("key").isin(0, 1, 2, 6, 1500, 2999))).collect()
    want = {r[0]: r for r in brute(rows)}
    assert len(some) == 6 and all((r.leaf, r.proof_sha256, r.root, r.verified) == (want[r.key][1], want[r.key][4], want[r.key][3], True) for r in some)


def test_missing_nodes_are_the_least_union():
    rng = np.random.RandomState(3)
    for _ in range(60):
        n = rng.randint(1, 60)
        at = np.unique(rng.randint(0, n, rng.randint(1, 9)))
        lack = {(lv, int(x)) for lv, xs in mm.missing(at, n) for x in xs}
        need, known, width, level = set(), set(at.tolist()), n, 0
        while width > 1:  # siblings of each leaf's path, less those that stand on another leaf's path
            need |= {(level, y) for x in known for y in range(x - x % 3, min(x - x % 3 + 3, width)) if y not in known}
            known, width, level = {x // 3 for x in known}, -(-width // 3), level + 1
        assert lack == need
