"""MinHash near-duplicate detection with tensored banding and exact verification.

Two small collections of ``BANDS`` bands are made from 2 * BANDS * ROWS minhashes. Every pair of a band from the first and a
band from the second is a table key, so BANDS squared tables need only the square root of the minhashes that separate
tables would. A pair of similarity s meets in some table with probability (1 - (1 - s^ROWS)^BANDS)^2; that is 0.9996 at 0.8
and one in a million less than 1 at 0.9.

Equal shingle sets form one class first (members are never compared). Inside a bucket of a table classes are not paired
off: all are compared with one pivot, links become components, and only buckets that still hold several components
go on, with another pivot each time; what ``PIVOTS`` of these leave across components is joined by an exact prefix filter. So
a large group of near copies costs a few comparisons per member, documents that share a common passage do not meet, and
no link between bucket mates is lost.
Links are confirmed on full sets of 64-bit shingle hashes.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.llm.common import aside, bounded, table, written

SHINGLE = 2
BANDS, ROWS = 12, 3
PERCENT = 80
PIVOTS = 2
MEMO_WORDS = 150_000
SLICE_CHARS = 1 << 20

_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class _WordHashes(dict):
    def __missing__(self, word):
        import xxhash
        v = self[word] = xxhash.xxh3_64_intdigest(word)
        return v


@lru_cache(maxsize=1)
def word_hashes() -> _WordHashes:
    """One table per worker process, kept over tasks."""
    return _WordHashes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _K2
    return x ^ (x >> np.uint64(29))


def shingle_sets(texts: list[str], known: dict, shingle: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text: words are runs of anything but ASCII white space with A-Z
    lower-cased; a text with fewer words than a shingle has its whole word sequence as the only one, or nothing."""
    if len(known) > MEMO_WORDS:
        known.clear()
    words = [t.encode("utf-8", "surrogatepass").lower().split() for t in texts]
    lens = [len(w) for w in words]
    flat = np.fromiter((v for w in words for v in map(known.__getitem__, w)), np.uint64, sum(lens))
    with np.errstate(over="ignore"):
        s = flat[:max(0, len(flat) - shingle + 1)] if len(flat) >= shingle else flat[:0]
        acc = _mix(s + np.uint64(shingle))
        for k in range(1, shingle):
            acc = _mix(acc * _K1 + flat[k:k + len(s)])
        out, at = [], 0
        for n in lens:
            if n >= shingle:
                out.append(np.unique(acc[at:at + n - shingle + 1]))
            elif n:
                one = np.array([n], np.uint64)
                for k in range(n):
                    one = _mix(one * _K1 + flat[at + k])
                out.append(one)
            else:
                out.append(flat[:0])
            at += n
    return out


def _slices(texts: list[str]):
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= SLICE_CHARS):
            size += len(texts[hi])
            hi += 1
        yield lo, hi
        lo = hi


def _sketch(bands: int, rows: int, shingle: int):
    def run(frames):
        import xxhash
        rng = np.random.RandomState(7)
        mult = rng.randint(0, 2 ** 63, 2 * bands * rows, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        add = rng.randint(0, 2 ** 63, 2 * bands * rows, np.int64).astype(np.uint64)
        known = word_hashes()
        for f in frames:
            texts = f["text"].tolist()
            for lo, hi in _slices(texts):
                sets = shingle_sets(texts[lo:hi], known, shingle)
                some = [x for x in sets if len(x)]
                keys = np.zeros((len(some), 2 * bands), np.uint64)
                if some:
                    flat = np.concatenate(some)
                    starts = np.concatenate([[0], np.cumsum([len(x) for x in some])[:-1]])
                    with np.errstate(over="ignore"):
                        for k in range(2 * bands * rows):
                            least = np.minimum.reduceat(flat * mult[k] + add[k], starts)
                            keys[:, k // rows] = _mix(keys[:, k // rows] * _K1 + least)
                it = iter(keys.view(np.int64).tolist())
                part = f.iloc[lo:hi]
                yield pd.DataFrame({
                    "doc_id": part["doc_id"], "text_hash": part["text_hash"], "n_shingles": [len(x) for x in sets],
                    "cid": pd.array([int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(x.tobytes())))) if len(x) else None for x in sets], "Int64"),
                    "bands": [next(it) if len(x) else [] for x in sets]})
    return run


def sketches(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, n_shingles, cid, bands) per row: cid is the hash of the whole set, null for an empty one."""
    named = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.coalesce("text", F.lit("")).alias("text"))
    out = named.mapInPandas(_sketch(bands, rows, shingle), "doc_id string, text_hash long, n_shingles long, cid long, bands array<long>")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def class_sets(docs: DataFrame, reps: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(cid, shingles) for the classes of ``reps(cid, rep)``, rep being a doc_id of the class; texts are read again and only
    those of representatives reach Python."""
    def run(frames):
        import xxhash
        known = word_hashes()
        for f in frames:
            texts = f["text"].tolist()
            for lo, hi in _slices(texts):
                sets = [x for x in shingle_sets(texts[lo:hi], known, shingle) if len(x)]
                if not sets:  # wordless texts only: Arrow cannot type a column of lists that is empty
                    continue
                yield pd.DataFrame({"cid": [int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(x.tobytes())))) for x in sets],
                                    "shingles": [x.view(np.int64) for x in sets]})
    wanted = bounded(reps.select(F.col("rep").alias("_rep")).distinct())
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.join(wanted, texts["doc_id"].eqNullSafe(F.col("_rep")), "left_semi").select("text")
    found = texts.mapInPandas(run, "cid long, shingles array<long>")
    return written(found.join(bounded(reps.select("cid")), "cid", "left_semi").dropDuplicates(["cid"]), "class-sets")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge (a, b), root being the least node reachable. Alternates large-star and
    small-star steps on the written edges until they no longer change; hubs are met by aggregates and joins, which Spark
    splits, never by collecting neighbours."""
    now = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    print_of = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    mark = print_of(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        now = written(small.distinct(), "edges")
        mark, last = print_of(now), mark
        if mark == last:
            break
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough. The side that repeats (b, the pivot) is joined last."""
    one = sets.select(F.col("cid").alias("a"), F.col("shingles").alias("_sa"))
    two = sets.select(F.col("cid").alias("b"), F.col("shingles").alias("_sb"))
    both = pairs.join(one, "a").join(two, "b").withColumn("_i", F.size(F.array_intersect("_sa", "_sb")))
    return both.filter(100 * F.col("_i") >= percent * (F.size("_sa") + F.size("_sb") - F.col("_i"))).select("a", "b")


def near_duplicates(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, shingle: int = SHINGLE, percent: int = PERCENT,
                    pivots: int = PIVOTS) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, kept) for every row of ``docs``.

    component_id is the least doc_id linked to the document, directly or over others; kept marks the document that
    carries it. Null or wordless texts have no shingles and stand alone. Rows that share doc_id and text get the same
    result; a null doc_id never names a component that has another one, and where none has an id the text of least hash stays. Only doc_id and text are read. An empty table gives an
    empty result.
    """
    seen = written(sketches(docs, bands, rows, shingle), "sketches")
    classes = seen.filter("n_shingles > 0").groupBy("cid").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    classes = written(classes, "classes")
    cell = F.explode(F.transform(F.sequence(F.lit(0), F.lit(bands * bands - 1)), lambda p: F.xxhash64(
        p, F.get("bands", (p / bands).cast("int")), F.get("bands", bands + p % bands))))
    keyed = classes.select("cid", "n", cell.alias("key"))
    full = keyed.groupBy("key").agg(F.min(F.struct("cid", "n")).alias("_p"), F.count(F.lit(1)).alias("_c")).filter("_c > 1")
    mates = written(keyed.join(full.select("key"), "key"), "bucket-mates")
    sets = class_sets(docs, written(mates.select("cid").distinct().join(classes, "cid").select("cid", "rep"), "representatives"), shingle)
    near = lambda x, y: 100 * F.least(x, y) >= percent * F.greatest(x, y)
    roots, done, live = None, None, mates.withColumn("root", F.col("cid"))
    for turn in range(pivots + 1):
        mixed = live.groupBy("key").agg(F.min(F.struct(F.xxhash64("cid", F.lit(turn)).alias("h"), "cid", "n", "root")).alias("_p"),
                                        F.min("root").alias("_lo"), F.max("root").alias("_hi")).filter("_lo < _hi")
        if turn < pivots:
            pairs = live.join(mixed.select("key", "_p"), "key").filter((F.col("root") != F.col("_p.root")) & near(F.col("n"), F.col("_p.n")))
            pairs = pairs.select(F.col("cid").alias("a"), F.col("_p.cid").alias("b")).distinct()
        else:
            pairs = _across(live.join(mixed.select("key"), "key", "left_semi").select("cid", "root").distinct(), sets, percent)
        if done is not None:
            both = done.unionByName(done.select(F.col("b").alias("a"), F.col("a").alias("b")))
            pairs = pairs.join(both, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        if pairs.isEmpty():
            # Nothing left to compare with these pivots; others may still differ, so only the last turn ends the loop.
            continue
        done = pairs if done is None else done.unionByName(pairs)
        links = written(_verified(pairs, sets, percent), "links")
        if links.isEmpty():
            continue
        if roots is None:
            roots = written(components(links), "components")
        else:  # join the components that the new links touch
            at = lambda c: F.coalesce(F.col(f"_r{c}"), F.col(c))
            up = links
            for c in ("a", "b"):
                up = up.join(roots.select(F.col("node").alias(c), F.col("root").alias(f"_r{c}")), c, "left")
            more = components(up.select(at("a").alias("a"), at("b").alias("b")))
            more = written(more.select(F.col("node").alias("_n"), F.col("root").alias("_r")), "merged")
            moved = roots.join(more, roots["root"] == F.col("_n"), "left").select("node", F.coalesce("_r", "root").alias("root"))
            fresh = more.join(roots, F.col("_n") == F.col("node"), "left_anti").select(F.col("_n").alias("node"), F.col("_r").alias("root"))
            roots = written(moved.unionByName(fresh), "components")
        live = mates.join(bounded(roots).withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
        live = written(live.select("cid", "n", "key", "root"), "live")
    at = classes.select("cid", "rep", F.col("cid").alias("root"))
    if roots is not None:
        at = classes.select("cid", "rep").join(bounded(roots).withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    least = at.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = bounded(written(at.join(least, "root").select("cid", "component_id", "root"), "named-classes"))
    out = seen.join(named, "cid", "left")
    comp = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    kept = F.col("doc_id").eqNullSafe(comp)
    if not seen.where("doc_id is null").isEmpty():
        # Of a component without any id, the text with the least hash stays.
        first = out.where("n_shingles > 0 and component_id is null").groupBy("root").agg(F.min("text_hash").alias("_first"))
        out = out.join(bounded(written(first, "components-without-id")), "root", "left")
        kept = kept & F.coalesce(F.col("text_hash") == F.col("_first"), F.lit(True))
    return out.select("doc_id", "text_hash", "n_shingles", comp.alias("component_id"), kept.alias("kept"))


def _across(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of ``nodes(cid, root)`` in different components that may be similar enough, by an exact prefix filter.

    With all shingles in one order, rarest first, two sets of the wanted similarity share one among the first
    n - ceil(s * n) + 1 of either, and from the first shared one on enough shingles must be left on both sides. Documents
    that have only a common passage in common differ in their rare shingles, so they hardly meet here.
    """
    tokens = nodes.join(sets, "cid").select("cid", "root", F.size("shingles").alias("n"), F.explode("shingles").alias("t"))
    tokens = written(tokens, "across-shingles")
    times = tokens.groupBy("t").agg(F.count(F.lit(1)).alias("_c"), (F.min("root") < F.max("root")).alias("_mixed"))
    place = F.row_number().over(W.partitionBy("cid").orderBy("_c", "t")) - 1
    first = tokens.join(times, "t").withColumn("i", place).filter((100 * (F.col("n") - F.col("i")) >= percent * F.col("n")) & F.col("_mixed"))
    first = written(first.select("t", "cid", "root", "n", "i"), "across-prefixes")
    one, two = (first.select("t", *[F.col(c).alias(c + x) for c in ("cid", "root", "n", "i")]) for x in "ab")
    left = F.least(F.col("na") - F.col("ia"), F.col("nb") - F.col("ib"))
    fits = (one["t"] == two["t"]) & (F.col("roota") < F.col("rootb")) & ((100 + percent) * left >= percent * (F.col("na") + F.col("nb")))
    return one.join(two, fits).select(F.col("cida").alias("a"), F.col("cidb").alias("b")).distinct()


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component, all columns unchanged."""
    docs, back = aside(docs)
    judged = written(near_duplicates(docs, shingle=shingle, percent=percent), "near-duplicates")
    gone = judged.filter("not kept").select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h")).distinct()
    same = docs["doc_id"].eqNullSafe(F.col("_d")) & (F.xxhash64(docs["text"]) == F.col("_h"))
    left = docs.join(bounded(written(gone, "removed")), same, "left_anti")
    repeated = judged.filter("kept and n_shingles > 0").groupBy("doc_id", "text_hash").count().filter("count > 1")
    return back(left if repeated.isEmpty() else left.dropDuplicates(["doc_id", "text"]))


def q_op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, linked from 80 % of common two-word shingles on."""
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_shingles", "component_id", "kept")
