"""Exact removal of repeated byte strings with suffix arrays.

Every byte that a string of ``LENGTH`` bytes covers which also starts anywhere else (in another document or the same) is removed.

A window of LENGTH bytes belongs to the least hash among its grams of w bytes, so equal windows belong together wherever they
are. Runs of windows with one such hash are segments; a hash that occurs once in the corpus has nothing to repeat. The distinct
segments of the others are dealt to shards by that hash, and each shard's suffix array is built by induced sorting:
suffixes are classified, leftmost-smaller (LMS) substrings are sorted, by names and recursion where names tie, and the order of
all suffixes is induced from that of the LMS suffixes by radix passes. Common prefixes are computed in text order (permuted), where they
shrink by one at most from one suffix to the next. A window is repeated if its suffix shares LENGTH bytes with a neighbour in the
suffix array, or if its segment occurs more than once.

A hash with more than ``GROUP`` distinct segments (a passage common to very many contexts) is cut anew with longer grams, in the end
of the window's own length, so a shard never gets an unbounded group.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import bounded, runs_of, table, written

LENGTH = 200
#: Bytes of a gram, by round; the last must be LENGTH.
GRAMS = (48, 140, LENGTH)
#: Distinct segments of one hash that a shard takes.
GROUP = 4_096
SHARD_BYTES = 1 << 20
PIECE = 1 << 18
_R = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_R ** k and its inverse modulo 2 ** 64 for k < n."""
    inverse = pow(_R, -1, 1 << 64)
    out = []
    for r in (_R, inverse):
        a = np.full(n, r, np.uint64)
        a[0] = 1
        out.append(np.multiply.accumulate(a))
    return out[0], out[1]


_BYTE = np.random.RandomState(12).randint(1, 2 ** 63, 256, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


# --- Suffix arrays -------------------------------------------------------------------------------------------------------

def _ranks(key: np.ndarray) -> tuple[np.ndarray, int]:
    """Dense ranks of integers from 0 and their number."""
    order = np.argsort(key)
    s = key[order]
    new = np.concatenate([[0], np.cumsum(s[1:] != s[:-1])]) if len(s) else s
    out = np.empty(len(key), np.int64)
    out[order] = new
    return out, int(new[-1]) + 1 if len(s) else 0


def _stable(order: np.ndarray, key: np.ndarray, top: int) -> np.ndarray:
    """``order`` sorted by key[order] (below ``top``), ties as they were: linear radix passes over 16 bits."""
    for shift in range(0, max(1, int(top - 1).bit_length()), 16):
        digit = ((key[order] >> shift) & 0xFFFF).astype(np.uint16)
        order = order[np.argsort(digit, kind="stable")]
    return order


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Suffix array of the integers ``t`` (from 0), a suffix that is a prefix of another one coming first.

    Suffixes are classified as smaller (S) or larger (L) than the one after them. u(i) is the text from i to the next LMS position,
    inclusive. Distinct u are named in order, which names the LMS substrings among them; the text of these names is
    solved by recursion unless they all differ. Then a suffix sorts by the name of u(i) and the rank of the LMS suffix it ends in.
    """
    n = len(t)
    if n < 2:
        return np.arange(n)
    s = np.append(t.astype(np.int64) + 1, 0)  # the end is less than all and an LMS position
    n += 1
    at = np.arange(n)
    last = np.append(s[:-1] != s[1:], True)            # last of a run of equal symbols
    stop = np.where(last, at, n)
    stop = np.minimum.accumulate(stop[::-1])[::-1]
    small = np.empty(n, bool)
    small[-1] = True
    small[:-1] = s[stop[:-1]] < s[np.minimum(stop[:-1] + 1, n - 1)]
    lms = np.zeros(n, bool)
    lms[1:] = small[1:] & ~small[:-1]
    places = np.flatnonzero(lms)
    which = np.searchsorted(places, at + 1)            # u(i) ends at places[which[i]]
    which[-1] = len(places) - 1
    symbol = 2 * s + small
    end = places[which]
    end[-1] = n - 1
    # Distinct u by a hash of their symbols, checked against the first of its kind symbol by symbol through the tails.
    pw, inv = _powers(1 << max(10, int(n).bit_length()))
    for salt in range(8):
        mixed = _mix(symbol.astype(np.uint64) * np.uint64(2) + np.uint64(2 * salt + 1)) | np.uint64(1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed * pw[:n])])
        hashed = _mix((total[end + 1] - total[:-1]) * inv[:n])
        kind, count = _ranks(hashed)
        first = np.empty(count, np.int64)
        first[kind] = at
        model, tail = first[kind], np.minimum(at + 1, n - 1)
        over, over_model = end == tail, end[model] == np.minimum(model + 1, n - 1)
        same = (symbol == symbol[model]) & (over == over_model) & np.where(over, symbol[tail] == symbol[tail[model]], kind[tail] == kind[tail[model]])
        if same[:-1].all():
            break
    else:
        raise RuntimeError("eight hashes of LMS substrings collided")
    # Order of the distinct u: by their first 2 ** k symbols, doubled until all differ. A tail is a distinct u again, or one LMS symbol.
    short = end[first] <= first + 1
    ends = np.unique(symbol[places])
    follow = np.append(np.where(short, count + np.searchsorted(ends, symbol[end[first]]), kind[tail[first]]), np.arange(count, count + len(ends)))
    rank, kinds = _ranks(np.append(symbol[first], ends))
    # A lone last symbol stands for a u that is over; nothing is a prefix of anything else, so its rank only needs to hold.
    ahead = follow.copy()
    finished = np.append(np.zeros(count, bool), np.ones(len(ends), bool))
    while True:
        rank, kinds = _ranks(rank * (kinds + 1) + np.where(finished, 0, rank[ahead] + 1))
        head = np.bincount(rank[:count], minlength=kinds)
        if head.max(initial=0) <= 1:
            break
        finished = finished | finished[ahead]
        ahead = ahead[ahead]
    name, names = _ranks(rank[:count])
    name = name[kind]
    # The LMS suffixes in order.
    lms_name, kinds = _ranks(name[places])
    if kinds == len(places):
        order = np.empty(len(places), np.int64)
        order[lms_name] = np.arange(len(places))
    else:
        order = suffix_array(lms_name)
    # Suffixes in the order of the LMS suffix that they lead to, then by the name of what comes before it.
    starts = np.concatenate([[0], places[:-1]])
    size = places - starts
    size[-1] += 1
    sizes = size[order]
    lead = np.repeat(starts[order] - (np.cumsum(sizes) - sizes), sizes) + np.arange(n)
    return _stable(lead, name, names)[1:]


def permuted_lcp(t: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """By text position, the length of the common prefix with the suffix before it in the suffix array.

    Only irreducible values (the symbols before the two suffixes differ) are found by comparing, four symbols at a time; any
    other is one less than that of the position before.
    """
    n = len(t)
    before = np.full(n, -1)
    before[sa[1:]] = sa[:-1]
    padded = np.concatenate([t.astype(np.uint16), np.full(4, 0xFFFF, np.uint16)])
    four = padded[:n].astype(np.uint64)
    for k in (1, 2, 3):
        four |= padded[k:n + k].astype(np.uint64) << np.uint64(16 * k)
    i = np.arange(n)
    fresh = np.flatnonzero((before >= 0) & ((i == 0) | (before == 0) | (t[np.maximum(i, 1) - 1] != t[np.maximum(before, 1) - 1])))
    out = np.zeros(n, np.int64)
    a, b, live, length = fresh.copy(), before[fresh], np.arange(len(fresh)), np.zeros(len(fresh), np.int64)
    while len(live):
        inside = np.maximum(a, b) < n
        live, a, b = live[inside], a[inside], b[inside]
        x = four[a] ^ four[b]
        equal = x == 0
        d = x[~equal]
        low = (d & (~d + np.uint64(1))).astype(np.float64)
        length[live[~equal]] += (np.frexp(low)[1] - 1) // 16
        live, a, b = live[equal], a[equal] + 4, b[equal] + 4
        length[live] += 4
    length = np.minimum(length, n - np.maximum(fresh, before[fresh]))
    out[fresh] = length + fresh
    out = np.maximum.accumulate(out) - i
    out[before < 0] = 0
    return np.maximum(out, 0)


def repeated_starts(t: np.ndarray, length: int) -> np.ndarray:
    """Whether the ``length`` symbols from a position also start elsewhere in ``t``."""
    sa = suffix_array(t)
    plcp = permuted_lcp(t, sa)
    out = plcp >= length
    after = sa[:-1][out[sa[1:]]]
    out[after] = True
    return out


# --- Segments ------------------------------------------------------------------------------------------------------------

def _cut(pieces: list, w: int, length: int):
    """Segments of pieces (owner, offset, bytes): arrays (owner, hash, start, windows, twice, content hash)."""
    b = np.frombuffer(b"".join(x for _, _, x in pieces), np.uint8)
    n, sizes = len(b), np.array([len(x) for _, _, x in pieces])
    begin = np.cumsum(sizes) - sizes
    pw, inv = _powers(1 << max(19, int(n).bit_length()))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[b] * pw[:n], out=total[1:])
    grams = _mix((total[w:] - total[:-w]) * inv[:n - w + 1])
    span, least, width = length - w + 1, grams, 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:n - length + 1], least[span - width:span - width + n - length + 1])
    # Window starts inside one piece, and where a run of one hash begins.
    count = sizes - length + 1
    owner = np.repeat(np.arange(len(pieces)), count)
    at = np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(len(owner))
    h = least[at]
    new = np.append(True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1]))
    if w == length:
        new[:] = True
    lead = np.flatnonzero(new)
    runs = np.diff(np.append(lead, len(at)))
    lo, h, owner = at[lead], h[lead], owner[lead]
    end = lo + runs
    view = np.lib.stride_tricks.sliding_window_view(grams, span)
    first = lo + (view[lo] == h[:, None]).argmax(axis=1)
    last = end + span - 2 - (view[end - 1][:, ::-1] == h[:, None]).argmax(axis=1)
    whole = _mix((total[end + length - 1] - total[lo]) * inv[lo])
    names, offsets = np.array([o for o, _, _ in pieces], np.int64), np.array([a for _, a, _ in pieces], np.int64)
    return names[owner], h.view(np.int64), lo - begin[owner] + offsets[owner], runs, first != last, whole.view(np.int64)


def cut(texts: list, w: int, length: int = LENGTH):
    """Segments of the texts: arrays (number of the text, hash, start, windows, twice, content hash) for each few hundred kilobytes.

    A segment is a run of consecutive windows of ``length`` bytes whose least hash among their grams of ``w`` bytes is the same (a
    window by itself where w is length); twice tells if that gram occurs more than once in it. Long texts are cut in pieces that
    overlap by a window less a byte, so no window is lost and memory is bounded."""
    held, size = [], 0
    for k, data in enumerate(texts):
        for a in range(0, len(data) - length + 1, PIECE):
            held.append((k, a, data[a:a + PIECE + length - 1]))
            size += len(held[-1][2])
            if size >= PIECE:
                yield _cut(held, w, length)
                held, size = [], 0
    if held:
        yield _cut(held, w, length)


_SPANS = "spans array<struct<a:int,b:int>>"


def _segments(w: int, length: int):
    def run(frames):
        for f in frames:
            nums, copies, keys = f["num"].tolist(), f["copies"].tolist(), f["key"].tolist()
            for owner, h, start, runs, twice, whole in cut(f["data"].tolist(), w, length):
                edges = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
                per = lambda x: np.split(x, edges[1:])  # noqa: E731, B023
                whose = owner[edges].tolist()
                yield pd.DataFrame({"num": [nums[k] for k in whose], "key": [keys[k] for k in whose], "copies": [copies[k] for k in whose], "h": per(h),
                                    "start": per(start.astype(np.int32)), "n": per((2 * runs + twice).astype(np.int32)), "c": per(whole)})
    return run


def _fetch(length: int):
    def run(frames):
        for f in frames:
            out = []
            for data, want in zip(f["data"], f["want"]):
                out += [(r["h"], r["n"], r["c"], r["m"], r["k"], data[r["start"]:r["start"] + r["n"] + length - 1]) for r in want]
            yield pd.DataFrame(out, columns=["h", "n", "c", "m", "k", "data"])
    return run


def shard_spans(data: list[bytes], windows: np.ndarray, often: np.ndarray, length: int) -> list[list[tuple[int, int]]]:
    """By segment, the byte ranges whose windows also start in another place of this shard, or all of it where ``often``."""
    stop = np.array([256], np.uint16)
    t = np.concatenate([x for d in data for x in (np.frombuffer(d, np.uint8).astype(np.uint16), stop)])
    found, out, at = repeated_starts(t, length), [], 0
    for d, n, all_ in zip(data, windows, often):
        hit = np.concatenate([[0], np.ones(n, np.int8) if all_ else found[at:at + n].astype(np.int8), [0]])
        turn = np.flatnonzero(np.diff(hit))
        out.append([(int(a), int(b) + length - 1) for a, b in zip(turn[::2], turn[1::2])])
        at += len(d) + 1
    return out


def _shards(length: int):
    def run(frames):
        for f in runs_of(frames, ["shard"]):
            spans = shard_spans(f["data"].tolist(), f["n"].to_numpy(), f["m"].to_numpy() > 1, length)
            yield pd.DataFrame({"h": f["h"], "n": f["n"], "c": f["c"], "spans": [[{"a": a, "b": b} for a, b in x] for x in spans]})[[bool(x) for x in spans]]
    return run


def repeated_spans(texts: DataFrame, length: int = LENGTH, grams=GRAMS, group: int = GROUP, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(key, copies, spans) for the texts in ``texts(key, data, copies)`` that have repeated windows; a text with several copies stands for them all.
    spans are byte ranges [a, b) and may overlap. The last of ``grams`` is ``length``."""
    w, later = grams[0], grams[1:]
    numbered = texts.where(F.octet_length("data") >= length).select(F.monotonically_increasing_id().alias("num"), "key", "data", "copies")
    segs = written(numbered.mapInPandas(_segments(w, length), "num long, key binary, copies long, h array<long>, start array<int>, n array<int>, c array<long>"), "segments")
    flat = segs.select("num", "copies", F.explode(F.arrays_zip("h", "start", "n", "c")).alias("s"))
    flat = flat.select("num", "copies", "s.h", "s.start", F.shiftright("s.n", 1).alias("n"), (F.col("s.n") % 2 == 1).alias("twice"), "s.c")
    again = flat.groupBy("h").agg(F.sum("copies").alias("_m"), F.max("twice").alias("_t")).where("_m > 1 or _t").select("h")
    found = written(flat.join(again, "h", "left_semi"), "repeated-segments")
    same = ["h", "n", "c"]
    kinds = written(found.groupBy(*same).agg(F.min(F.struct("num", "start")).alias("at"), F.sum("copies").alias("m"), F.max("twice").alias("twice")), "segment-kinds")
    groups = kinds.groupBy("h").agg(F.count(F.lit(1)).alias("k"), F.max("twice").alias("_t"))
    kinds = written(kinds.join(groups, "h").withColumn("alone", (F.col("k") == 1) & ~F.col("_t")), "segment-groups")
    # The only segment of its hash occurs as a whole as often as the hash does.
    span = lambda a, b: F.struct(a.cast("int").alias("a"), b.cast("int").alias("b"))
    spans = kinds.where("alone").select(*same, F.array(span(F.lit(0), F.col("n") + length - 1)).alias("spans"))
    if later:
        want = kinds.where("not alone").groupBy(F.col("at.num").alias("num")).agg(F.collect_list(F.struct("h", "n", "c", "m", "k", F.col("at.start").alias("start"))).alias("want"))
        want = written(want.join(segs.select("num", "key").distinct(), "num").select("key", "want"), "wanted-segments")
        data = texts.select("key", "data").join(_narrow(want, "want"), "key").mapInPandas(_fetch(length), "h long, n int, c long, m long, k long, data binary")
        data = written(data, "segment-bytes")
        few, many = data.where(F.col("k") <= group), data.where(F.col("k") > group)
        size = few.agg(F.coalesce(F.sum(F.octet_length("data")), F.lit(0))).first()[0]
        dealt = few.withColumn("shard", F.pmod(F.xxhash64("h"), F.lit(max(1, -(-size // shard_bytes))))).repartition("shard").sortWithinPartitions("shard")
        spans = spans.unionByName(dealt.mapInPandas(_shards(length), f"h long, n int, c long, {_SPANS}"))
        if not many.isEmpty():
            many = written(many.withColumn("key", F.unhex(F.sha2("data", 256))), "large-groups")
            more = repeated_spans(many.select("key", "data", F.col("m").alias("copies")), length, later, group, shard_bytes)
            spans = spans.unionByName(many.select("key", *same).join(more, "key").select(*same, "spans"))
    spans = written(spans, "segment-spans")
    hits = found.join(spans, same).select("num", "copies", F.transform("spans", lambda x: span(x["a"] + F.col("start"), x["b"] + F.col("start"))).alias("spans"))
    hits = hits.groupBy("num", "copies").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    return written(hits.join(segs.select("num", "key").distinct(), "num").select("key", "copies", "spans"), "text-spans")


def _narrow(lists: DataFrame, col: str, rows: int = 500_000, entries: int = 4_000_000) -> DataFrame:
    """Broadcast ``lists`` if its rows and the entries of its lists, as counted, are few; else shuffle."""
    n, total = lists.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size(col)), F.lit(0))).first()
    return F.broadcast(lists) if n <= rows and total <= entries else lists


def _keep(frames):
    for f in frames:
        kept, spans = [], []
        for data, found in zip(f["data"], f["spans"]):
            runs = []
            for a, b in sorted((x["a"], x["b"]) for x in found):
                if runs and a <= runs[-1][1]:
                    runs[-1][1] = max(b, runs[-1][1])
                else:
                    runs.append([a, b])
            cuts = [0, *(x for r in runs for x in r), len(data)]
            kept.append(b"".join(data[a:b] for a, b in zip(cuts[::2], cuts[1::2])))
            spans.append([{"a": a, "b": b} for a, b in runs])
        yield pd.DataFrame({"doc_id": f["doc_id"], "n_bytes": [len(x) for x in f["data"]], "spans": spans, "kept": kept})


def without_repeats(docs: DataFrame, length: int = LENGTH, **how) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) for every row of ``docs(doc_id, text)``: spans are the maximal runs of removed bytes [a, b) and kept the bytes
    left over, which need not be valid UTF-8.

    Strings are judged on the texts as they are, so all copies of a repeated string go. Equal texts are worked on once; where
    they have ``length`` bytes all of them go. A null text is empty; a null or repeated doc_id is only handed on, and further
    columns are not read. An empty table gives an empty result. Strings count as equal by 64-bit hashes where whole segments are.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("data"))
    rows = rows.withColumn("key", F.unhex(F.sha2("data", 256)))
    many = rows.where(F.octet_length("data") >= length).groupBy("key").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("_rep")).where("copies > 1")
    many = bounded(written(many, "copies"))
    known = rows.join(many, "key", "left")
    texts = known.where(F.col("copies").isNull() | F.col("doc_id").eqNullSafe(F.col("_rep"))).select("key", "data", F.coalesce("copies", F.lit(1).cast("long")).alias("copies"))
    spans = _narrow(written(repeated_spans(texts, length, **how).where("copies = 1").select("key", "spans"), "spans"), "spans")
    size = F.octet_length("data")
    none = F.array().cast("array<struct<a:int,b:int>>")
    gone = F.col("copies").isNotNull()
    rest = known.join(spans.select("key"), "key", "left_anti").select(
        "doc_id", size.cast("long").alias("n_bytes"), F.when(gone, F.array(F.struct(F.lit(0).alias("a"), size.cast("int").alias("b")))).otherwise(none).alias("spans"),
        F.when(gone, F.lit(b"")).otherwise(F.col("data")).alias("kept"))
    part = rows.join(spans, "key").select(F.col("doc_id").cast("string").alias("doc_id"), "data", "spans")
    part = part.mapInPandas(_keep, f"doc_id string, n_bytes long, {_SPANS}, kept binary").withColumn("doc_id", F.col("doc_id").cast(kind))
    return rest.unionByName(part)


def q_op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the 200-byte strings that occur more than once."""
    out = without_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["b"] - x["a"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
