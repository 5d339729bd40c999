"""Prefix trie of conversations from sorted sequences: every shared prefix of turns as a node with its member statistics.

Distinct turn sequences are sorted over range partitions ("shards"), and the common prefixes of neighbours (LCPs) are worked out. A
sparse table answers range minima over a shard's LCPs. Each candidate prefix (a sequence and a depth beyond the LCP with its
predecessor, so that each node is named once) searches its left and right extent by itself with that table; no stack is
kept. What is asked of a node (members, least id, children, leaves, saved words) is a difference of prefix sums or a range minimum
over its interval.

A shard knows the last sequence before it and the first one after it. Nodes whose interval goes on beyond a shard are prefixes of
those neighbours; each shard gives its part of them, and the parts are added up by prefix. All of it adds: the words saved
in a subtree are the words of its members below the node's parent, less the words of the nodes that its sequences introduce.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.llm.common import bounded, runs_of, sql_crc32, table, words, written

STRIDE, HEADS = 20, 4
#: Turns in a shard, about. A shard is worked on in one task.
SHARD_TURNS = 65_536
_PART = ("depth long, pid binary, parent_pid binary, conv_id long, parent_conv_id long, n_convs long, n_children long, "
         "n_leaves long, saved_tokens long, ends string, spans boolean")


def turn_lists(conversations: DataFrame) -> DataFrame:
    """(conv_id, ts) with the turns of each conversation in order, as (turn, hex digest of role and text, words of the text).

    Ordered by turn (null first); rows of one turn by digest, and repeated rows all stay. A null role or text is empty.
    Rows without conv_id belong to no conversation. Further columns are not read.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").cast("long").alias("turn"), F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("d"),
                 F.size(words(text)).cast("long").alias("w")).alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))


def rebuilt(lists: DataFrame, stride: int = STRIDE, heads: int = HEADS) -> DataFrame:
    """(conv_id, ts): the first h turns are those of conversation c - c % stride (all if fewer, none if it is absent), the rest are c's own
    after its first h; h is crc32 of the decimal id modulo ``heads``."""
    base = F.col("conv_id") - F.col("conv_id") % stride
    first = lists.filter(F.col("conv_id") % stride == 0).select(F.col("conv_id").alias("_base"), F.slice("ts", 1, heads - 1).alias("_head"))
    both = lists.withColumn("_base", base).join(first, "_base", "left").withColumn("_h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int"))
    none = F.slice("ts", 1, 0)
    return both.select("conv_id", F.concat(F.slice(F.coalesce("_head", none), F.lit(1), F.col("_h")), F.slice("ts", F.col("_h") + 1, F.size("ts"))).alias("ts"))


def _ends(frames):
    """(kd, ends) from rows sorted by (kd, conv_id): ids run through the hash, none are kept."""
    key, h = None, None
    for f in frames:
        kds, ids = f["kd"].to_numpy(), f["conv_id"].to_numpy()
        cuts = [0, *(np.flatnonzero(kds[1:] != kds[:-1]) + 1), len(kds)] if len(kds) else []
        done = []
        for lo, hi in zip(cuts, cuts[1:]):
            if kds[lo] != key:
                if h is not None:
                    done.append((key, h.hexdigest()))
                key, h = kds[lo], hashlib.sha256()
            else:
                h.update(b",")
            h.update(",".join(map(str, ids[lo:hi].tolist())).encode())
        yield pd.DataFrame(done, columns=["kd", "ends"])
    if h is not None:
        yield pd.DataFrame([(key, h.hexdigest())], columns=["kd", "ends"])


def sequences(lists: DataFrame) -> DataFrame:
    """(kd, key, words, n, first_id, ends) per distinct sequence of ``lists(conv_id, ts)``; key is the turns' digests in a row."""
    rows = lists.select("conv_id", F.unhex(F.array_join(F.transform("ts", lambda t: t["d"]), "")).alias("key"), F.transform("ts", lambda t: t["w"]).alias("words"))
    rows = written(rows.withColumn("kd", F.md5("key")), "rebuilt")
    seqs = rows.groupBy("kd").agg(F.first("key").alias("key"), F.first("words").alias("words"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("first_id"))
    # A hash over the ids of equal sequences, in order, is one stream by its definition; it holds no list.
    ends = rows.select("kd", "conv_id").repartition("kd").sortWithinPartitions("kd", "conv_id").mapInPandas(_ends, "kd string, ends string")
    return seqs.join(ends, "kd")


class RangeMin:
    """Sparse table: least value of a[lo..hi] (inclusive, lo <= hi) for arrays of ranges."""

    def __init__(self, a: np.ndarray):
        self.levels = [a]
        while 2 ** len(self.levels) <= len(a):
            low, half = self.levels[-1], 2 ** (len(self.levels) - 1)
            self.levels.append(np.minimum(low[:-half], low[half:]))

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        k = np.frexp((hi - lo + 1).astype(float))[1] - 1
        out = np.empty(len(lo), self.levels[0].dtype)
        for j in np.unique(k):
            at = k == j
            out[at] = np.minimum(self.levels[j][lo[at]], self.levels[j][hi[at] - 2 ** j + 1])
        return out

    def right(self, i: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The last r >= i with a[i+1..r] >= least throughout."""
        r, n = i.copy(), len(self.levels[0])
        for j in range(len(self.levels) - 1, -1, -1):
            can = r + 2 ** j < n
            step = can.copy()
            step[can] = self.levels[j][r[can] + 1] >= least[can]
            r[step] += 2 ** j
        return r

    def left(self, i: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The first l <= i with a[l+1..i] >= least throughout."""
        at = i.copy()
        for j in range(len(self.levels) - 1, -1, -1):
            can = at - 2 ** j >= 0
            step = can.copy()
            step[can] = self.levels[j][at[can] - 2 ** j + 1] >= least[can]
            at[step] -= 2 ** j
        return at


def _ragged(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, place in owner) of the rows of ragged lists."""
    own = np.repeat(np.arange(len(counts)), counts)
    return own, np.arange(len(own)) - np.repeat(np.cumsum(counts) - counts, counts)


def common_prefixes(keys: list[bytes], size: int = 16) -> np.ndarray:
    """LCP, in items of ``size`` bytes, of each key with the one before it; -1 for the first."""
    lens = np.array([len(k) // size for k in keys], np.int64)
    items = np.frombuffer(b"".join(keys), np.uint64).reshape(-1, size // 8)
    offs = np.cumsum(lens) - lens
    least = np.minimum(lens[1:], lens[:-1])
    pair, at = _ragged(least)
    differ = np.flatnonzero((items[offs[:-1][pair] + at] != items[offs[1:][pair] + at]).any(axis=1))
    which, first = np.unique(pair[differ], return_index=True)
    least[which] = at[differ[first]]
    return np.concatenate([[-1], least])


def shard_nodes(f: pd.DataFrame) -> pd.DataFrame:
    """Nodes of one shard: rows sorted by key with kind 0 (neighbour before, if any), 1 (own) and 2 (neighbour after, if any)."""
    kind, keys = f["kind"].to_numpy(), f["key"].tolist()
    lcp = common_prefixes(keys)
    before, own = int((kind == 0).any()), kind == 1
    up = int(lcp[before]) if before else -1             # LCP of the first own sequence with its neighbour
    down = int(lcp[-1]) if kind[-1] == 2 else -1
    f, keys, lcp = f[own], [k for k, o in zip(keys, own) if o], lcp[own].copy()
    n = len(keys)
    lcp[0] = up
    lens = np.array([len(k) // 16 for k in keys], np.int64)
    weight, ids, ends = f["n"].to_numpy(np.int64), f["first_id"].to_numpy(np.int64), f["ends"].to_numpy(object)
    # pre[offs + d] is the number of words in the first d turns.
    offs = np.cumsum(lens + 1) - (lens + 1)
    pre = np.concatenate([np.concatenate([[0], np.cumsum(np.asarray(w, np.int64))]) for w in f["words"]])
    total = pre[offs + lens]
    nxt = np.append(lcp[1:], down)
    sums = lambda x: np.concatenate([[0], np.cumsum(x)])
    members, mass = sums(weight), sums(weight * total)
    fresh = sums(total - pre[offs + np.maximum(lcp, 0)])  # words of the nodes that a sequence introduces
    leaf = sums(nxt < lens)
    inner = np.where(np.arange(n) > 0, lcp, np.iinfo(np.int64).max)
    extent, least_id = RangeMin(inner), RangeMin(ids)
    by = np.lexsort((np.arange(n), lcp))                  # places of each LCP value, for counting children
    places = lcp[by] * (n + 1) + by

    def stats(i, lo, hi, d):
        """Over [lo, hi], the depth-d prefix of sequence i, which lies in it."""
        above = np.maximum(d - 1, 0)
        base = pre[offs[i] + above]
        head = total[lo] - pre[offs[lo] + np.maximum(lcp[lo], above)]
        count = members[hi + 1] - members[lo]
        mine = d * (n + 1)
        kids = np.searchsorted(places, mine + hi, "right") - np.searchsorted(places, mine + lo, "right")
        return {"depth": d, "conv_id": least_id(lo, hi), "n_convs": count, "n_children": kids + ((lcp[lo] <= d) & (lens[lo] > d)),
                "n_leaves": leaf[hi + 1] - leaf[lo], "ends": np.where(lens[lo] == d, ends[lo], None),
                "saved_tokens": mass[hi + 1] - mass[lo] - count * base - head - (fresh[hi + 1] - fresh[lo + 1])}

    pid = lambda i, d: hashlib.md5(keys[i][:16 * d]).digest()
    # Every candidate prefix: a sequence and each depth that it does not share with its predecessor.
    from_ = np.maximum(lcp, 0)
    i, k = _ragged(lens - from_)
    d = from_[i] + 1 + k
    hi = extent.right(i, d)
    whole = ~((hi == n - 1) & (d <= down))
    i, d, hi = i[whole], d[whole], hi[whole]
    closed = stats(i, i, hi, d)
    plo, phi = extent.left(i, d - 1), extent.right(i, d - 1)
    spans = (d == 1) | ((plo == 0) & (d - 1 <= up)) | ((phi == n - 1) & (d - 1 <= down))
    mother = least_id(plo, phi)
    closed = pd.DataFrame(closed).assign(
        pid=None, parent_pid=[pid(a, b - 1) if s else None for a, b, s in zip(i.tolist(), d.tolist(), spans.tolist())],
        parent_conv_id=pd.array(np.where(spans, 0, mother), "Int64"), spans=False)
    closed.loc[spans, "parent_conv_id"] = pd.NA
    # Prefixes that go on in a neighbouring shard, and the root: this shard's part.
    shared = int(inner[1:].min()) if n > 1 else int(lens[0])
    left = np.arange(0, max(up, 0) + 1)
    right = np.arange(min(max(up, 0), shared) + 1, max(down, 0) + 1)
    i = np.concatenate([np.zeros(len(left), np.int64), np.full(len(right), n - 1, np.int64)])
    d = np.concatenate([left, right])
    lo, hi = extent.left(i, d), extent.right(i, d)
    part = pd.DataFrame(stats(i, lo, hi, d)).assign(
        pid=[pid(a, b) for a, b in zip(i.tolist(), d.tolist())], parent_pid=[pid(a, b - 1) if b else None for a, b in zip(i.tolist(), d.tolist())],
        parent_conv_id=pd.array([None] * len(d), "Int64"), spans=True)
    return pd.concat([closed, part], ignore_index=True)[[c.split()[0] for c in _PART.split(", ")]]


def _shards(frames):
    for f in runs_of(frames, ["part"]):
        yield shard_nodes(f)


def trie(lists: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The prefix trie of ``lists(conv_id, ts)`` (see ``turn_lists``): a row per distinct prefix with conv_id (least member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256.

    A conversation's turn digests (16 bytes a turn) meet in one row, as do a shard's in one task; equal conversations become
    one weighted sequence before they are sorted. No conversations give no nodes, not even a root.
    """
    spark = lists.sparkSession
    seqs = written(sequences(lists), "sequences")
    turns = seqs.agg(F.coalesce(F.sum(F.size("words") + 1), F.lit(0))).first()[0]
    ranged = seqs.repartitionByRange(max(1, -(-turns // shard_turns)), "key").withColumn("part", F.spark_partition_id())
    ranged = written(ranged, "sorted-sequences")
    edge = ranged.groupBy("part").agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
    order = W.orderBy("part")  # one row per shard
    edge = edge.select("part", F.lag("hi").over(order).alias("before"), F.lead("lo").over(order).alias("after"))
    side = lambda kind, c: edge.select("part", F.lit(kind).alias("kind"), F.col(c).alias("key"))
    near = side(0, "before").unionByName(side(2, "after")).where("key is not null")
    own = ranged.select("part", F.lit(1).alias("kind"), "key", "words", "n", "first_id", "ends")
    rows = own.unionByName(near, allowMissingColumns=True).repartition("part").sortWithinPartitions("part", "kind", "key")
    parts = written(rows.mapInPandas(_shards, _PART), "trie-parts")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    wide = parts.where("spans").groupBy("depth", "pid").agg(F.min("conv_id").alias("conv_id"), F.first("parent_pid").alias("parent_pid"), *sums, F.max("ends").alias("ends"))
    wide = written(wide, "spanning-nodes")
    mothers = bounded(wide.select(F.col("depth").alias("_d"), F.col("pid").alias("_p"), F.col("conv_id").alias("_mother")))
    cols = ["depth", "conv_id", "parent_pid", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    all_ = parts.where("not spans").select(*cols, "parent_conv_id").unionByName(wide.select(*cols), allowMissingColumns=True)
    found = all_.join(mothers, (F.col("_d") == F.col("depth") - 1) & (F.col("_p") == F.col("parent_pid")), "left")
    none = F.sha2(F.lit(""), 256)
    return found.select("conv_id", "depth", F.coalesce("parent_conv_id", "_mother").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                        "saved_tokens", F.coalesce("ends", none).alias("ends_sha256"))


def q_op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt conversations."""
    lists = written(turn_lists(table(spark, sf_dir, "conversations")), "turn-lists")
    return trie(rebuilt(lists))


ORACLE_OP13 = f"""
WITH own AS (SELECT conv_id AS c, d, w, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, d) AS i FROM (
  SELECT conv_id, turn, md5(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS d,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS w FROM conversations WHERE conv_id IS NOT NULL)),
convs AS (SELECT c, c - c % {STRIDE} AS base, {sql_crc32('c::VARCHAR')} % {HEADS} AS h FROM (SELECT DISTINCT c FROM own)),
turns AS (SELECT c, d, w, row_number() OVER (PARTITION BY c ORDER BY p, i) AS depth FROM (
  SELECT v.c, 0 AS p, o.i, o.d, o.w FROM convs v JOIN own o ON o.c = v.base AND o.i <= v.h
  UNION ALL SELECT v.c, 1, o.i, o.d, o.w FROM convs v JOIN own o ON o.c = v.c AND o.i > v.h)),
members AS (SELECT c, 0 AS depth, '' AS k, 0 AS w FROM convs
  UNION ALL SELECT c, depth, string_agg(d, '' ORDER BY depth) OVER (PARTITION BY c ORDER BY depth), w FROM turns),
lens AS (SELECT c, max(depth) AS n FROM members GROUP BY c),
nodes AS (SELECT depth, k, min(c) AS conv_id, count(*) AS n_convs, any_value(w) AS w FROM members GROUP BY depth, k),
ends AS (SELECT k, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends FROM members JOIN lens USING (c) WHERE depth = n GROUP BY k),
kids AS (SELECT left(k, 32 * (depth - 1)) AS k, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
below AS (SELECT left(x.k, 32 * a) AS k, count(*) FILTER (kids.n IS NULL) AS n_leaves, sum((x.n_convs - 1) * x.w) AS saved
  FROM (SELECT *, unnest(range(0, depth + 1)) AS a FROM nodes) x LEFT JOIN kids ON kids.k = x.k GROUP BY 1)
SELECT m.conv_id, m.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, m.n_convs, coalesce(kids.n, 0) AS n_children, below.n_leaves,
  below.saved::BIGINT AS saved_tokens, coalesce(ends.ends, sha256('')) AS ends_sha256
FROM nodes m LEFT JOIN nodes p ON p.depth = m.depth - 1 AND p.k = left(m.k, 32 * (m.depth - 1)) LEFT JOIN kids ON kids.k = m.k
JOIN below ON below.k = m.k LEFT JOIN ends ON ends.k = m.k"""
