"""Nearest candidates of many queries: J1, A5 and V1 up to the first n of R1, with no row per pair of query and book.

Books and queries are packed into blocks (their unit vectors as one matrix, their tokens as numbers), and a block of queries meets a block of
books as one matrix product. A pair counts only if the two share a token (J1), which is looked up in one row of bits per token of the book
block. Every book is compared with every query; a task keeps, per query, the pairs that may be among the first n.

The products are of single precision and only sift: a pair is dropped where n candidates of its query are better by more than the
products' error and the rounding of the score. So ``score_candidates`` and ``top_n`` on what is kept give the rows that they give on all candidates.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.operators.ids import sequential_ids
from lectern.operators.joins import sized_join
from lectern.session import materialize

BOOK_BLOCK = 4096
QUERY_BLOCK = 8192
CHUNK = 512  # queries of a block that are multiplied at a time
BIT_BYTES = 64 * 1024 * 1024  # a book block whose bits would be larger is taken in parts
MAX_BROADCAST_BYTES = 256 * 1024 * 1024  # of query blocks; beyond, Spark pairs the partitions of both sides


def even_length(*vectors: DataFrame) -> int | None:
    """The one length that all vectors have, None where they differ or hold anything but finite numbers of a usual size."""
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) > 1e100))
    seen = set()
    for v in vectors:
        rows, have, least, most, bad = v.agg(F.count(F.lit(1)), F.count("embedding"), F.min(F.size("embedding")), F.max(F.size("embedding")),
                                             F.coalesce(F.max(odd), F.lit(False))).first()
        if bad or rows != have:
            return None
        seen |= {x for x in (least, most) if x is not None}
    return seen.pop() if len(seen) == 1 else None


def _pack(size: int, side: str):
    """Rows (id, t, embedding) as blocks of at most ``size`` rows in order of their ids: ids, unit vectors, tokens, where each row's
    tokens end, and a number that rows with the same vector share."""
    def pack(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, size):
                part = batch.slice(lo, size)
                part = part.take(pc.sort_indices(part.column(0)))
                x = part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1).astype(np.float64)
                norms = np.sqrt((x * x).sum(axis=1, keepdims=True))
                unit = np.divide(x, norms, out=np.zeros_like(x), where=norms > 0).astype(np.float32)
                ends = np.cumsum(pc.list_value_length(part.column(1)).to_numpy(zero_copy_only=False), dtype=np.int64)
                words = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int32)
                alike = np.unique(x.view(f"V{x.shape[1] * 8}").ravel(), return_inverse=True)[1].ravel().astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(0))
                yield pa.RecordBatch.from_arrays([ids, *(pa.array([a.tobytes()], pa.binary()) for a in (unit, words, ends, alike))],
                                                 names=[f"{side}_{c}" for c in ("ids", "vec", "tok", "ends", "alike")])
    return pack


def _blocks(rows: DataFrame, size: int, side: str) -> DataFrame:
    kind = rows.dtypes[0][1]
    columns = ", ".join(f"{side}_{c} binary" for c in ("vec", "tok", "ends", "alike"))
    return rows.mapInArrow(_pack(size, side), f"{side}_ids array<{kind}>, {columns}").withColumn(f"{side}_no", F.monotonically_increasing_id())


def _sift(n: int, slack: float, length: int, vocabulary: int):
    """Worker side; everything it names is inside, so that a worker needs no copy of this module."""
    class Books:
        """A block of books: vectors, and for each token that occurs a row of bits, one per book."""

        def __init__(self, vec, tok, ends, alike):
            self.vec, self.alike, n = vec, alike, len(vec)
            used, row = np.unique(tok, return_inverse=True)
            place = np.repeat(np.arange(n), np.diff(ends, prepend=0))
            self.bits = np.zeros((len(used) + 1, -(-n // 64) * 8), np.uint8)  # the last row is for all tokens that do not occur
            np.bitwise_or.at(self.bits, (row, place >> 3), (1 << (place & 7)).astype(np.uint8))
            self.wide = self.bits.view(np.uint64)
            self.row_of = np.full(vocabulary, len(used), np.int32)
            self.row_of[used] = np.arange(len(used))

        def sharing(self, rows, places):
            """Those of ``places`` whose book has one of the tokens with these rows of bits."""
            if len(places) * 8 < self.bits.shape[1]:
                return places[((self.bits[rows[:, None], places >> 3] >> (places & 7)) & 1).any(axis=0)]
            return places[np.unpackbits(np.bitwise_or.reduce(self.wide[rows], axis=0).view(np.uint8), bitorder="little")[places] > 0]

        def first_alike(self, places):
            """``places`` without those that follow n places with the same vector: the lower ids come first."""
            group = self.alike[places]
            order = np.argsort(group, kind="stable")
            run = np.arange(len(order)) - np.searchsorted(group[order], group[order])
            return np.sort(places[order[run < n]])

    def book_parts(vec, tok, ends, alike):
        """(first place, ``Books``) of a block, in parts where its bits would be too large."""
        if len(vec) > 64 and len(np.unique(tok)) * len(vec) // 8 > BIT_BYTES:
            half = len(vec) // 2
            at = ends[half - 1]
            yield from book_parts(vec[:half], tok[:at], ends[:half], alike[:half])
            yield from ((half + k, b) for k, b in book_parts(vec[half:], tok[at:], ends[half:] - at, alike[half:]))
        else:
            yield 0, Books(vec, tok, ends, alike)

    class Kept:
        """What a task keeps for a block of queries: the n best scores of each, and the pairs that may be among its first n."""

        def __init__(self, ids):
            self.ids = ids.take(pa.array(np.arange(len(ids))))
            self.best, self.cut = np.full((len(ids), n), -np.inf, np.float32), np.full(len(ids), -np.inf, np.float32)
            self.who, self.score, self.books = [], [], []

        def meet(self, vec, tok, ends, books: Books, ids) -> None:
            rows, starts = books.row_of[tok], ends - np.diff(ends, prepend=0)
            for lo in range(0, len(vec), CHUNK):
                s = vec[lo:lo + CHUNK] @ books.vec.T
                hit = s >= (self.cut[lo:lo + CHUNK] - np.float32(slack))[:, None]
                who, where = [], []
                for r in np.flatnonzero(hit.any(axis=1)):
                    q = lo + r
                    places = books.sharing(rows[starts[q]:ends[q]], np.flatnonzero(hit[r]))
                    if not len(places):
                        continue
                    found = s[r, places]
                    top = np.concatenate((self.best[q], found))
                    self.best[q] = top = np.partition(top, len(found))[len(found):]
                    self.cut[q] = cut = top.min()
                    places = places[found >= cut - np.float32(slack)]
                    if len(places) > 2 * n:  # ties: of books that score alike whatever the query, the first ids will do
                        places = books.first_alike(places) if vec[q].any() else places[:n]
                    who.append(np.full(len(places), r)), where.append(places)
                if who:
                    who, where = np.concatenate(who), np.concatenate(where)
                    self.who.append(who + lo), self.score.append(s[who, where]), self.books.append(ids.take(pa.array(where)))

        def pairs(self):
            if not self.who:
                return
            who, score, books = np.concatenate(self.who), np.concatenate(self.score), pa.concat_arrays(self.books)
            keep = np.flatnonzero(score >= self.cut[who] - np.float32(slack))
            yield pa.RecordBatch.from_arrays([self.ids.take(pa.array(who[keep])), books.take(pa.array(keep)), pa.array(score[keep])], names=["query_id", "book_id", "s"])

    def sift(batches):
        kept, at, parts = {}, None, []
        for batch in batches:
            for i in range(batch.num_rows):
                cell = {c: batch.column(c)[i] for c in batch.schema.names}
                array = lambda c, kind: np.frombuffer(cell[c].as_buffer(), kind)
                if at != cell["b_no"].as_py():
                    at = cell["b_no"].as_py()
                    parts = list(book_parts(array("b_vec", np.float32).reshape(-1, length), array("b_tok", np.int32), array("b_ends", np.int64), array("b_alike", np.int32)))
                no = cell["q_no"].as_py()
                if no not in kept:
                    kept[no] = Kept(cell["q_ids"].values)
                for first, books in parts:
                    kept[no].meet(array("q_vec", np.float32).reshape(-1, length), array("q_tok", np.int32), array("q_ends", np.int64), books,
                                  cell["b_ids"].values.slice(first, len(books.vec)))
        for own in kept.values():
            yield from own.pairs()
    return sift


def nearest_candidates(q_tokens: DataFrame, postings: DataFrame, vectors: DataFrame, query_vectors: DataFrame, n: int, length: int,
                       score_decimals: int | None = None, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Distinct (query_id, book_id) candidates among which are the first ``n`` of each query by cosine, ties and rounded ties included.

    ``q_tokens`` (query_id, token), ``vectors`` and ``query_vectors`` (all vectors of one ``length``, see ``even_length``) should be written tables, as they are read more than once.
    """
    words = sequential_ids(q_tokens.where("token is not null").select("token").distinct(), "token", "t").select("token", "t")
    words = materialize(words, "query-words")
    vocabulary = words.count()
    numbered = lambda df, key: sized_join(df.select(key, "token"), words, ["token"], small_rows=vocabulary).where(F.col(key).isNotNull()).groupBy(key).agg(F.collect_list("t").alias("t"))
    sides = lambda df, vec, key: numbered(df, key).join(vec, key).select(key, "t", "embedding")
    tasks = 2 * vectors.sparkSession.sparkContext.defaultParallelism
    books = _blocks(sides(postings, vectors, "book_id").repartition(tasks, "book_id"), BOOK_BLOCK, "b")
    asked = materialize(_blocks(sides(q_tokens, query_vectors, "query_id"), QUERY_BLOCK, "q"), "query-blocks")
    held = asked.agg(F.coalesce(F.sum(F.octet_length("q_vec") + F.octet_length("q_tok") + F.octet_length("q_ends")), F.lit(0))).first()[0]
    both = books.crossJoin(F.broadcast(asked) if held <= max_broadcast_bytes else asked)
    # Each product is off by less than (length + 4) * 2 ** -24; pairs that the rounding may make equal are told apart later.
    slack = 2 * (length + 4) * 2.0 ** -24 + (0.0 if score_decimals is None else 10.0 ** -score_decimals)
    kinds = dict(asked.dtypes)["q_ids"][6:-1], dict(books.dtypes)["b_ids"][6:-1]
    near = both.mapInArrow(_sift(n, slack, length, vocabulary), f"query_id {kinds[0]}, book_id {kinds[1]}, s float")
    whole = Window.partitionBy("query_id").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cut: Column = F.coalesce(F.nth_value("s", n).over(whole), F.lit(float("-inf")))
    return near.withColumn("cut", cut).where(F.col("s") >= F.col("cut") - F.lit(slack)).select("query_id", "book_id").distinct()
