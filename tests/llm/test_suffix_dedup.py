import random
from collections import Counter

import numpy as np

from lectern.llm import suffix_dedup as sd
from tests.llm.conftest import EDGE_ROWS, make, prose


def brute(texts, length):
    """(n_bytes, spans, kept) of each text, from the counts of all its windows."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[s:s + length] for b in data for s in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b) + 1, np.int64)
        for s in range(len(b) - length + 1):
            if seen[b[s:s + length]] > 1:
                gone[s] += 1
                gone[min(s + length, len(b))] -= 1
        hit = np.cumsum(gone)[:len(b)] > 0
        turn = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
        out.append((len(b), [(int(x), int(y)) for x, y in zip(turn[::2], turn[1::2])], bytes(np.frombuffer(b, np.uint8)[~hit])))
    return out


def removed(docs, length, **how):
    rows = sd.without_repeats(docs, length, **how).collect()
    return sorted(((r.doc_id, r.n_bytes, [(x.a, x.b) for x in r.spans], bytes(r.kept)) for r in rows), key=str)


def check(spark, rows, length, **how):
    got = removed(make(spark, [(i, t, "en", "s") for i, t in rows]), length, **how)
    assert got == sorted(((i, *x) for (i, _), x in zip(rows, brute([t for _, t in rows], length))), key=str)
    return got


def text(rng, n, letters):
    return "".join(rng.choice(letters) for _ in range(n))


def test_suffix_arrays_and_permuted_prefixes():
    rng = np.random.RandomState(1)
    for trial in range(600):
        t = rng.randint(0, rng.choice([1, 2, 3, 6, 300]), rng.randint(0, 60))
        sa = sd.suffix_array(t)
        assert sa.tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())
        got = sd.permuted_lcp(t, sa)
        for x, y in zip(sa, sa[1:]):
            k = 0
            while k < min(len(t) - x, len(t) - y) and t[x + k] == t[y + k]:
                k += 1
            assert got[y] == k
    for t in (np.zeros(5000, int), np.tile([0, 1, 0, 0, 1], 900), np.tile(rng.randint(0, 9, 700), 5)):
        assert sd.suffix_array(t).tolist() == sorted(range(len(t)), key=lambda i: t[i:].astype(np.uint8).tobytes())


def test_segments_hold_every_window_once():
    rng = random.Random(2)
    texts = [text(rng, n, "ab").encode() for n in (0, 19, 20, 21, 500, 40, 3000)]
    for w in (6, 12, 20):
        got = [(int(o), s) for part in sd.cut(texts, w, 20) for o, h, a, n, t, c in zip(*part) for s in range(a, a + n)]
        assert sorted(got) == [(k, s) for k, t in enumerate(texts) for s in range(len(t) - 19)]
        kinds = {}  # equal windows have equal hashes
        for o, h, a, n, t, c in (x for part in sd.cut(texts, w, 20) for x in zip(*part)):
            for s in range(a, a + n):
                assert kinds.setdefault(texts[o][s:s + 20], h) == h


def test_random_texts_with_large_groups(spark):
    rng = random.Random(3)
    passage = text(rng, 90, "abcdefgh")
    rows = [(k, text(rng, rng.randint(0, 60), "abcdefgh") + passage[rng.randint(0, 30):rng.randint(40, 90)] + text(rng, rng.randint(0, 60), "abcdefgh")) for k in range(250)]
    rows += [(1000 + k, text(rng, rng.randint(0, 200), "ab")) for k in range(60)] + [(2000 + k, "ab" * rng.randint(1, 80) + "é") for k in range(30)]
    rows += [(3000 + k, rows[5][1]) for k in range(20)]
    check(spark, rows, 20, grams=(6, 14, 20), group=4, shard_bytes=2000)
    check(spark, rows, 20, grams=(6, 14, 20))


def test_passages_in_documents_of_their_own_length(spark):
    a, b = prose(1, 60), prose(2, 60)
    rows = [(1, prose(10, 300) + a + prose(11, 50)), (2, prose(12, 20) + a), (3, b + " and " + b), (4, prose(13, 400)), (5, a[:199]), (6, a[20:220]), (7, None), (8, prose(14, 60_000) + a)]
    got = {r[0]: r for r in check(spark, rows, 200)}
    assert got[4][2] == [] and got[5][2] == [] and got[6][3] == b"" and len(got[3][2]) == 2


def test_edges(spark, edge, empty):
    rows = [(r[0], r[1]) for r in EDGE_ROWS]
    assert removed(edge, 200) == sorted(((i, *x) for (i, _), x in zip(rows, brute([t for _, t in rows], 200))), key=str)
    assert removed(empty, 200) == []
