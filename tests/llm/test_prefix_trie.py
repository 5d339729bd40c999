import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np

from lectern.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string, depth string, key string, _base string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def brute(rows):
    """Nodes of the rebuilt conversations, by listing the members of every prefix."""
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, hashlib.md5(f"{len((r or '').encode())}:{r or ''}{x or ''}".encode()).hexdigest(), r or "", x or ""))
    own = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in own.items()}
    made = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        made[c] = own.get(c - int(np.fmod(c, 20)), [])[:h] + own[c][h:]
    nodes = defaultdict(list)
    for c, s in made.items():
        for d in range(len(s) + 1):
            nodes[tuple(s[:d])].append(c)
    kids = defaultdict(list)
    for p in nodes:
        if p:
            kids[p[:-1]].append(p)

    def below(p):
        yield p
        for q in kids[p]:
            yield from below(q)
    count = lambda p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
    out = []
    for p, cs in nodes.items():
        sub = list(below(p))
        ends = ",".join(map(str, sorted(c for c in cs if len(made[c]) == len(p))))
        out.append((min(cs), len(p), min(nodes[p[:-1]]) if p else None, len(cs), len(kids[p]), sum(not kids[q] for q in sub),
                    sum((len(nodes[q]) - 1) * count(q) for q in sub), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def nodes(spark, rows, **kw):
    lists = pt.turn_lists(frame(spark, rows))
    got = pt.trie(pt.rebuilt(lists), **kw).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted(map(tuple, got.collect()), key=str)


def make(seed, n, depth, words):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "assistant"]), rng.choice(words)) for c in rng.sample(range(-40, 40 + 3 * n), n) for t in range(rng.randint(1, depth))]


def test_random_conversations_in_many_shards(spark):
    few, more = ["a b", "a", "  "], [f"w{k} x" for k in range(40)]
    for seed, words, depth, shard in ((1, few, 6, 30), (2, more, 4, 25), (3, ["same words here"], 9, 12), (4, few + more, 5, 10 ** 6)):
        rows = make(seed, 60, depth, words)
        assert nodes(spark, rows, shard_turns=shard) == brute(rows)


def test_hot_prefix_copies_and_a_long_conversation(spark):
    rows = [(c, t, "user", f"t{t}") for c in range(200, 320) for t in range(3)]                          # copies
    rows += [(c, t, "user", "common start" if t == 0 else f"{c % 9} {t}") for c in range(400, 520) for t in range(4)]
    rows += [(1000, t, "user", f"step {t % 7}") for t in range(300)] + [(1003, t, "user", f"step {t % 7}") for t in range(290)]
    assert nodes(spark, rows, shard_turns=150) == brute(rows)


def test_edges(spark):
    rows = [(1, None, None, None), (1, None, None, None), (1, 0, "user", ""), (None, 0, "user", "no id"), (2, 5, "user", "é\n x"), (2, 5, "a", "é\n x"),
            (20, 0, "user", "base " * 3000), (21, 0, "user", "gone"), (22, 0, "user", "gone"), (-7, 0, "user", "gone"), (0, 1, "", "")]
    assert nodes(spark, rows) == brute(rows)
    assert nodes(spark, [(21, 0, "user", "gone")]) == brute([(21, 0, "user", "gone")])     # may be left without turns
    assert nodes(spark, []) == []


def test_range_minima_and_extents():
    rng = np.random.RandomState(5)
    for n in (1, 2, 7, 64, 200):
        a = rng.randint(0, 6, n)
        rm = pt.RangeMin(a)
        i = rng.randint(0, n, 300)
        j = np.minimum(n - 1, i + rng.randint(0, n, 300))
        assert (rm(i, j) == [a[x:y + 1].min() for x, y in zip(i, j)]).all()
        least = rng.randint(0, 7, 300)
        right, left = [], []
        for x, v in zip(i, least):
            r = l = x
            while r + 1 < n and a[r + 1] >= v:
                r += 1
            while l > 0 and a[l] >= v:
                l -= 1
            right.append(r), left.append(l)
        assert (rm.right(i, least) == right).all() and (rm.left(i, least) == left).all()
