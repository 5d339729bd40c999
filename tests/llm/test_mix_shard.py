"""Mixing and resharding: targets, budgets, fewest bytes moved, edge rows."""

import random
import re
import zlib

from pyspark.sql import functions as F

from lectern.llm import flow_reshard, source_mix
from lectern.session import scratch_path
from tests.llm.conftest import make, prose

WORDS = re.compile("[^\x20\x09-\x0D]+")


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        free = sum(w[s] for s in names if s not in full)
        level = (total - sum(3 * sizes[s] for s in full)) / free if free else 0
        more = {s for s in names if s not in full and level * w[s] > 3 * sizes[s]}
        if not more:
            return {s: 3.0 * sizes[s] if s in full else level * w[s] for s in names}
        full |= more


def test_targets_and_budgets(spark):
    rng = random.Random(5)
    rows = [(i, prose(i, rng.randint(0, 40)), "en", rng.choice(["b", "b", "b", "a", "é", None, "c"])) for i in range(600)]
    docs = make(spark, rows)
    got = source_mix.mix(docs, F.lit(1.0)).collect()
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len(WORDS.findall(t))
    want = brute_targets(sizes)
    for s, target in want.items():
        mine = [r for r in got if r.source == s]
        assert all(abs(r.target - target) < 1e-6 and r.source_size == sizes[s] for r in mine)
        assert abs(sum(r["size"] * r.copies for r in mine) - target) <= 40
        whole = int(target // sizes[s])
        assert {r.copies for r in mine} <= {whole, whole + 1} and max(r.copies for r in mine) <= 3
    again = source_mix.mix(docs.repartition(7), F.lit(1.0)).collect()
    assert sorted((r.doc_id, r.copies) for r in got) == sorted((r.doc_id, r.copies) for r in again)


def test_heavier_weights_are_taken_more_often(spark):
    rows = [(i, "five words are in here", "en", "a" if i < 1500 else "b") for i in range(2000)]
    docs = make(spark, rows).withColumn("w", F.when(F.col("doc_id") % 2 == 0, 4.0).when(F.col("doc_id") % 9 == 0, float("nan")).otherwise(0.25))
    got = source_mix.mix(docs, F.col("w"), weights=(1.0, 2.0)).filter("source = 'a'").groupBy((F.col("doc_id") % 2).alias("odd")).agg(F.sum("copies").alias("n"))
    n = {r.odd: r.n for r in got.collect()}
    assert n[0] > 1.5 * n[1] > 0


def test_mix_edge_rows(spark, edge, empty):
    got = source_mix.mix(edge, F.lit(None).cast("double")).collect()
    assert len(got) == edge.count() and all(r["size"] == len(WORDS.findall(r.text or "")) and 0 <= r.copies <= 3 for r in got)
    assert source_mix.mix(empty, F.lit(1.0)).count() == 0
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 1), (4, 1, None)], "doc_id long, quality int, toxic int")
    w = {r.doc_id: r["quality weight"] for r in source_mix.with_quality_weights(edge, labels).collect()}
    assert (w[1], w[4], w[3]) == (source_mix.POOR, source_mix.GOOD, source_mix.UNLABELLED)


def test_flow_moves_the_fewest_bytes():
    rng = random.Random(2)
    for _ in range(300):
        n, k = rng.randint(1, 5), rng.randint(1, 6)
        supply = [rng.randint(0, 20) for _ in range(n)]
        room = flow_reshard.equal_capacities(sum(supply) + rng.randint(0, 5), k)
        flow = flow_reshard.min_cost_flow(supply, room, lambda i, j: int(i != j))
        assert [sum(x) for x in flow] == supply and min(x for y in flow for x in y) >= 0
        assert all(sum(flow[i][j] for i in range(n)) <= room[j] for j in range(k))
        assert sum(flow[i][i] for i in range(min(n, k))) == sum(min(a, b) for a, b in zip(supply, room))


def test_flow_with_unequal_prices():
    flow = flow_reshard.min_cost_flow([3, 3], [3, 3], lambda i, j: [[2, 1], [5, 1]][i][j])
    assert flow == [[3, 0], [0, 3]]  # 0 gives way to 1, which has no cheap other place


def test_shards_are_whole_balanced_and_numbered(spark):
    rng = random.Random(4)
    rows = [(i, None if i == 7 else "copy of one text" if i % 3 == 0 else prose(i, rng.randint(0, 60)), "en", "s") for i in range(3000)]
    rows += rows[:5]
    docs = make(spark, rows)
    got = flow_reshard.resharded(spark, docs).collect()
    size = lambda t: len((t or "").encode()) + 8
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in got) == sorted((i, size(t), zlib.crc32((t or "").encode())) for i, t, _, _ in rows)
    total, largest = sum(r["size"] for r in got), max(r["size"] for r in got)
    per = {}
    for r in got:
        per.setdefault(r.shard, []).append(r)
    assert set(per) == set(range(24))
    assert all(abs(sum(r["size"] for r in v) - total / 24) <= 3 * largest for v in per.values())
    assert all(sorted(r.slot for r in v) == list(range(len(v))) for v in per.values())


def test_unaffected_shards_stay(spark):
    docs = make(spark, [(i, "x" * 92, "en", "s") for i in range(40)])
    old = F.when(F.col("doc_id") < 10, 0).when(F.col("doc_id") < 30, 1).otherwise(2)
    path = scratch_path(spark, "test-reshard")
    flow = flow_reshard.reshard(docs, old, path, capacities=[1000, 1000, 1000, 1000])
    assert flow == {(0, 0): 1000, (1, 1): 1000, (1, 3): 1000, (2, 2): 1000}
    written = flow_reshard.read_shards(spark, docs, path).groupBy("shard").count().collect()
    assert {r["shard"]: r["count"] for r in written} == {1: 10, 3: 10}


def test_rows_of_unaffected_shards_are_returned(spark):
    """Texts of one length: an old shard that holds just its new share is unaffected, and its rows must be there all the same."""
    for n in (24, 48):
        texts = [f"text {i:04d} of one length" for i in range(n)]
        old = [zlib.crc32(t.encode()) % 16 for t in texts]
        assert any(old.count(j) == n // 24 for j in range(16))
        got = flow_reshard.resharded(spark, make(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])).collect()
        assert sorted(r.doc_id for r in got) == list(range(n))
        assert sorted((r.shard, r.slot) for r in got) == [(j, k) for j in range(24) for k in range(n // 24)]
        assert all(old[r.doc_id] == r.shard for r in got if r.shard < 16 and old.count(r.shard) == n // 24)


def test_equal_texts_stay_together(spark):
    """Groups of copies up to the largest document or a hundredth of a shard are in one shard; flows hold to half a group."""
    rng = random.Random(8)
    texts = [prose(100 + i, rng.randint(1, 80)) for i in range(500)]
    picks = [t for t in texts for _ in range(rng.choice([1, 1, 2, 3]))] + ["many copies of this text"] * 700
    rows = [(i, t, "en", "s") for i, t in enumerate(picks)]
    size = lambda t: len(t.encode()) + 8
    path, old = scratch_path(spark, "test-groups"), F.pmod(F.crc32("text"), F.lit(16))
    docs = make(spark, rows)
    flow = flow_reshard.reshard(docs, old, path, old_files=False)
    got = flow_reshard.read_shards(spark, docs, path).collect()
    total = sum(size(t) for t in picks)
    whole = max(max(size(t) for t in texts), total // 24 // 100)
    groups, moved, numbers = {}, {}, {}
    for r in got:
        groups.setdefault(r.text, []).append(r.shard)
        key = (zlib.crc32(r.text.encode()) % 16, r.shard)
        moved[key] = moved.get(key, 0) + size(r.text)
        numbers.setdefault(r.shard, []).append(r.slot)
    assert sorted(r.doc_id for r in got) == list(range(len(rows)))
    assert all(len(set(v)) == 1 for t, v in groups.items() if size(t) * len(v) <= whole)
    assert len(set(groups["many copies of this text"])) > 1
    assert all(abs(moved.get(k, 0) - flow.get(k, 0)) <= whole for k in {*moved, *flow})
    assert all(sorted(v) == list(range(len(v))) for v in numbers.values())


def test_reshard_edge_rows(spark, edge, empty):
    assert flow_reshard.resharded(spark, edge).count() == edge.count()
    assert flow_reshard.resharded(spark, empty).count() == 0
