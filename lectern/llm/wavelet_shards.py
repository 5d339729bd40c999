"""Token-id output: every text encoded and stored as wavelet matrices, one compressed file per shard.

A shard is one range of doc_id, written by one task as one zstd Parquet file. Its rows are blocks: a wavelet matrix of
about ``block_tokens`` token ids (``width`` bit planes, the zeros per plane and a rank directory with one entry per
512 bits) and the ids and lengths of its documents. A block closes after the document that fills it, so memory holds
one block and one document whatever the shard's size. From the file alone, tokens can be read back whole
(``read_documents``), at positions (``access``), counted (``count_tokens``) and located (``find_tokens``).
"""

from __future__ import annotations

import re
import string
import unicodedata
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.llm.common import bounded, table, written
from lectern.session import scratch_path

END_ID = 2
BLOCK_TOKENS = 1 << 20
SUPER = 512
MEMO_WORDS = 600_000
_POP = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(1).astype(np.uint8)

SCHEMA = ("shard int, block int, n_tokens long, doc_ids array<long>, doc_lens array<long>, planes array<binary>, "
          "zeros array<long>, ranks array<binary>")


class WaveletMatrix:
    """Bit planes, highest bit first. Each plane holds that bit of every id in the plane's order; the next plane's
    order puts the ids with a 0 first, then those with a 1, both stably."""

    def __init__(self, n: int, planes, zeros, ranks):
        self.n, self.zeros = int(n), [int(z) for z in zeros]
        self.planes = [np.frombuffer(p, np.uint8) for p in planes]
        self.ranks = [np.frombuffer(r, "<u4") for r in ranks]

    @classmethod
    def build(cls, ids: np.ndarray, width: int) -> WaveletMatrix:
        planes, zeros, ranks, cur = [], [], [], np.asarray(ids, np.uint16 if width <= 16 else np.uint32)
        for level in range(width - 1, -1, -1):
            bit = (cur & cur.dtype.type(1 << level)) != 0
            packed = np.packbits(bit, bitorder="little")
            padded = np.zeros(-(-max(1, len(packed)) // (SUPER // 8)) * (SUPER // 8), np.uint8)
            padded[:len(packed)] = _POP[packed]
            sums = padded.reshape(-1, SUPER // 8).sum(1, dtype=np.uint32)
            planes.append(packed.tobytes())
            ranks.append(np.concatenate([[0], np.cumsum(sums)]).astype("<u4").tobytes())
            zeros.append(len(cur) - int(sums.sum()))
            cur = np.concatenate([cur.take(np.flatnonzero(~bit)), cur.take(np.flatnonzero(bit))])  # a mask of random bits is slower
        return cls(len(ids), planes, zeros, ranks)

    def rank1(self, level: int, i):
        """Ones among the first ``i`` bits of a plane; ``i`` a number or an array."""
        i = np.asarray(i, np.int64)
        flat, plane = i.reshape(-1), self.planes[level]
        out = self.ranks[level][flat // SUPER].astype(np.int64)
        byte, first = flat // 8, flat // SUPER * (SUPER // 8)
        for k in range(SUPER // 8):  # whole bytes of the superblock before i
            at = first + k
            take = at < byte
            if not take.any():
                break
            out[take] += _POP[plane[at[take]]]
        part = (flat % 8) > 0
        out[part] += _POP[plane[byte[part]] & ((1 << (flat[part] % 8)) - 1).astype(np.uint8)]
        return out.reshape(i.shape)

    def select(self, level: int, bit: int, k: np.ndarray) -> np.ndarray:
        """Positions of the ``k``-th (from 0) ``bit`` in a plane: binary search in the rank directory, then in it."""
        k = np.asarray(k, np.int64)
        n_super = len(self.ranks[level])
        ones = self.ranks[level].astype(np.int64)
        before = ones if bit else np.minimum(np.arange(n_super, dtype=np.int64) * SUPER, self.n) - ones
        sup = np.searchsorted(before, k, side="right") - 1
        lo, hi = sup * SUPER, np.minimum((sup + 1) * SUPER, self.n)
        while (lo < hi).any():
            mid = (lo + hi) // 2
            r = self.rank1(level, np.minimum(mid + 1, self.n))
            got = r if bit else np.minimum(mid + 1, self.n) - r
            go = lo < hi
            lo, hi = np.where(go & (got <= k), mid + 1, lo), np.where(go & (got > k), mid, hi)
        return lo

    def access(self, i) -> np.ndarray:
        """The ids at positions ``i``."""
        pos = np.asarray(i, np.int64)
        out = np.zeros(pos.shape, np.int64)
        for level in range(len(self.planes)):
            bit = (self.planes[level][pos // 8] >> (pos % 8).astype(np.uint8)) & 1
            r = self.rank1(level, pos)
            pos = np.where(bit == 1, self.zeros[level] + r, pos - r)
            out = out << 1 | bit
        return out

    def _range(self, symbol: int) -> tuple[int, int]:
        lo, hi = 0, self.n
        if symbol >> len(self.planes):
            return 0, 0
        for level in range(len(self.planes)):
            a, b = int(self.rank1(level, lo)), int(self.rank1(level, hi))
            bit = symbol >> (len(self.planes) - 1 - level) & 1
            lo, hi = (self.zeros[level] + a, self.zeros[level] + b) if bit else (lo - a, hi - b)
        return lo, hi

    def count(self, symbol: int) -> int:
        lo, hi = self._range(symbol)
        return hi - lo

    def find(self, symbol: int) -> np.ndarray:
        """All positions of an id, ascending."""
        lo, hi = self._range(symbol)
        pos = np.arange(lo, hi, dtype=np.int64)
        for level in range(len(self.planes) - 1, -1, -1) if len(pos) else ():
            bit = symbol >> (len(self.planes) - 1 - level) & 1
            pos = self.select(level, bit, pos - self.zeros[level] if bit else pos)
        return np.sort(pos)

    def decode(self) -> np.ndarray:
        """All ids in order: the planes are undone from the last to the first."""
        cur = np.zeros(self.n, np.uint32)
        for level in range(len(self.planes) - 1, -1, -1):
            bit = np.unpackbits(self.planes[level], count=self.n, bitorder="little").astype(bool)
            prev = np.empty_like(cur)
            prev[np.flatnonzero(~bit)] = cur[:self.zeros[level]]
            prev[np.flatnonzero(bit)] = cur[self.zeros[level]:] | np.uint32(1 << (len(self.planes) - 1 - level))
            cur = prev
        return cur


class _Pieces(dict):
    """Number of each piece of text seen so far; ``ids`` holds their token ids in a row. A word of letters goes to the tokenizer's
    model in lower case, as byte-level characters; a word that punctuation follows is the word and its tail; other printable ASCII is
    cut into its runs; anything else is encoded in full. ``plain`` says whether these short ways hold for the tokenizer."""

    # Byte-level characters: printable bytes stand for themselves, the others for code points from 256 on.
    BYTES = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in set(range(33, 127)) | set(range(161, 173)) | set(range(174, 256)))}
    RUNS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
    PROBES = ["Hello", "aBC", "word,", "na\u00efve...", "\u00c9t\u00e9.", "z.,", "whe$$$", "\u00f6\u00f6%%!", "(743)", "555-3824", "don't", "x-'s",
              "'Re,'", "a1B2", "HTTP://x.org/A?b=1", "#*_~", "7", "'ll"]

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer, self.model, self.plain = tokenizer, tokenizer.model, False
        self.added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.empty()
        full = [tokenizer.encode(w, add_special_tokens=False).ids for w in self.PROBES]
        self.plain = True
        self.plain = [self.of(self[w]).tolist() for w in self.PROBES] == full
        self.empty()

    def empty(self):
        self.clear()
        self.ids, self.first, self.length = array("I"), array("q"), array("q")

    def of(self, k: int) -> array:
        return self.ids[self.first[k]:self.first[k] + self.length[k]]

    def _model(self, word: str) -> list[int]:
        return [t.id for t in self.model.tokenize(word if word.isascii() else word.encode().decode("latin-1").translate(self.BYTES))]

    def _encoded(self, piece: str):
        """Ids of a piece that is no plain word."""
        if self.plain:
            core = piece.rstrip(string.punctuation)
            if core and len(core) < len(piece) and core.isalpha() and (core.isascii() or unicodedata.normalize("NFC", core).lower().isalpha()):
                return self.of(self[core]) + self.of(self[piece[len(core):]])
            if piece.isascii() and piece.isprintable() and not any(x in piece for x in self.added):
                runs = self.RUNS.findall(piece.lower())
                if len(runs) == 1:
                    return self._model(runs[0])
                return [i for run in runs for i in self.of(self[run])]
        return self.tokenizer.encode(piece, add_special_tokens=False).ids

    def __missing__(self, piece: str) -> int:
        if self.plain and piece.isalpha() and (piece.isascii() or unicodedata.is_normalized("NFC", piece) and "\u03a3" not in piece and "\u0130" not in piece):
            low = piece.lower()
            if low != piece and low.isalpha():
                k = self[piece] = self[low]
                return k
            ids = self._model(low)
        else:
            ids = self._encoded(piece)
        k = self[piece] = len(self.first)
        self.first.append(len(self.ids))
        self.length.append(len(ids))
        self.ids.extend(ids)
        return k

    def parted(self, pieces: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Each piece as a word and the punctuation after it, where the two are encoded apart: the word ends in a letter or digit, or is empty."""
        core = pc.ascii_rtrim(pieces, characters=string.punctuation)
        apart = pc.or_(pc.match_substring_regex(core, "[A-Za-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]$"), pc.equal(pc.binary_length(core), 0))
        for x in self.added:
            apart = pc.and_not(apart, pc.match_substring(pieces, x))
        core = pc.if_else(apart if self.plain else False, core, pieces)
        more = pc.subtract(pc.binary_length(pieces), pc.binary_length(core)).to_numpy()  # ASCII, so as many characters
        return core, pa.array([p[-k:] if k else "" for p, k in zip(pieces.to_numpy(zero_copy_only=False), more)], pieces.type)

    def codes(self, pieces: pa.Array) -> np.ndarray:
        """The number of each piece; each distinct one is looked up once."""
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False)
        return np.fromiter(map(self.__getitem__, distinct), np.int64, len(distinct))[coded.indices.to_numpy()]


class Encoder:
    """A tokenizer whose text is cut at blanks and line feeds first; each distinct piece is encoded once per worker, of
    which at most about ``MEMO_WORDS`` are remembered. Meant for tokenizers that never merge across white space."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        self.width = max(1, (tokenizer.get_vocab_size() - 1).bit_length())
        self.pieces = _Pieces(tokenizer)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and the number of ids of each text."""
        known = self.pieces
        if len(known) > MEMO_WORDS:
            known.empty()
        cut = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " "), " ")
        pieces = cut.flatten().dictionary_encode()
        sides = [known.codes(x) for x in known.parted(pieces.dictionary)]
        sizes = len(sides) * pc.list_value_length(cut).to_numpy(zero_copy_only=False).astype(np.int64)
        codes = np.stack(sides, axis=1)[pieces.indices.to_numpy()].ravel()
        ids, first, length = np.array(known.ids, np.uint32), np.array(known.first, np.int64), np.array(known.length, np.int64)
        lens = length[codes]
        ends = np.cumsum(lens)
        total = int(ends[-1]) if len(ends) else 0
        out = ids[np.repeat(first[codes] - (ends - lens), lens) + np.arange(total)]
        counts = np.diff(np.concatenate([[0], ends[np.cumsum(sizes) - 1]])) if len(texts) else np.zeros(0, np.int64)
        return out, counts


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per worker process, kept over tasks."""
    return Encoder(path)


def _block(shard, block, ids, doc_ids, doc_lens, width) -> pd.DataFrame:
    m = WaveletMatrix.build(ids, width)
    return pd.DataFrame({"shard": [shard], "block": [block], "n_tokens": [len(ids)], "doc_ids": [doc_ids],
                         "doc_lens": [doc_lens], "planes": [[p.tobytes() for p in m.planes]], "zeros": [m.zeros],
                         "ranks": [[r.tobytes() for r in m.ranks]]})


def _encode_shard(path: str, end_id: int, block_tokens: int):
    def run(frames):
        enc, shard, block = encoder(path), TaskContext.get().partitionId(), 0
        held, doc_ids, doc_lens, n = [], [], [], 0
        for f in frames:
            texts = f["text"].tolist()
            names = [None if pd.isna(x) else int(x) for x in f["doc_id"]]
            lo = 0
            while lo < len(texts):  # a slice of texts of about 8 MB at a time
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= 8 << 20):
                    size += len(texts[hi])
                    hi += 1
                ids, counts = enc.encode(texts[lo:hi])
                k = 0
                for name, c in zip(names[lo:hi], counts.tolist()):
                    held.append(ids[k:k + c])
                    held.append(np.array([end_id], np.uint32))
                    k += c
                    doc_ids.append(name)
                    doc_lens.append(c + 1)
                    n += c + 1
                    if n >= block_tokens:
                        yield _block(shard, block, np.concatenate(held), doc_ids, doc_lens, enc.width)
                        held, doc_ids, doc_lens, n, block = [], [], [], 0, block + 1
                lo = hi
        if n:
            yield _block(shard, block, np.concatenate(held), doc_ids, doc_lens, enc.width)
    return run


def write_shards(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID,
                 block_tokens: int = BLOCK_TOKENS, shards: int | None = None) -> None:
    """Encode ``docs(doc_id, text)`` in ascending doc_id order into one file per shard under ``path``.

    Texts are shuffled once, by ranges of doc_id (``shards`` of them, by default as many as the session's shuffle
    partitions); encoding follows in the same task. A null text is empty (its end id alone); a null doc_id comes first;
    rows that share a doc_id stand in the order of their texts and are all kept. Other columns are not read. An empty
    table gives an empty set of files.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ranged = rows.repartitionByRange(shards, "doc_id") if shards else rows.repartitionByRange("doc_id")
    (ranged.sortWithinPartitions("doc_id", "text").mapInPandas(_encode_shard(tokenizer_path, end_id, block_tokens), SCHEMA)
     .write.option("compression", "zstd").parquet(path))


def _starts(blocks: DataFrame) -> DataFrame:
    """Tokens before each block: sums per shard, running over the shards (one narrow row each), then in the shard."""
    sizes = blocks.select("shard", "block", "n_tokens")
    per = sizes.groupBy("shard").agg(F.sum("n_tokens").alias("_n"))
    per = per.select("shard", (F.sum("_n").over(W.orderBy("shard")) - F.col("_n")).alias("_before"))
    inner = W.partitionBy("shard").orderBy("block")
    return (sizes.withColumn("_in", F.sum("n_tokens").over(inner) - F.col("n_tokens")).join(per, "shard")
            .select("shard", "block", (F.col("_before") + F.col("_in")).alias("block_start")))


def _matrix(r) -> WaveletMatrix:
    return WaveletMatrix(r.n_tokens, r.planes, r.zeros, r.ranks)


def _digests(frames):
    for f in frames:
        for r in f.itertuples():
            buf = memoryview(_matrix(r).decode().astype("<u4").tobytes())
            ends = np.cumsum(r.doc_lens)
            lo = ends - r.doc_lens
            yield pd.DataFrame({"shard": r.shard, "block": r.block, "doc_id": pd.array(list(r.doc_ids), "Int64"), "in_block": lo,
                                "n_tokens": r.doc_lens, "ids_crc32": [zlib.crc32(buf[4 * a:4 * b]) for a, b in zip(lo, ends)]})


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per stored document, from the files: doc_id, start (ids before it), n_tokens, crc32 of its ids as little-endian
    unsigned 32-bit integers. Only narrow rows are joined; the bit planes never leave their task."""
    blocks = spark.read.schema(SCHEMA).parquet(path)
    docs = blocks.mapInPandas(_digests, "shard int, block int, doc_id long, in_block long, n_tokens long, ids_crc32 long")
    starts = written(_starts(blocks), "block-starts")
    return docs.join(bounded(starts), ["shard", "block"]).select(
        "doc_id", (F.col("block_start") + F.col("in_block")).alias("start"), "n_tokens", "ids_crc32", "shard")


def decode_documents(spark: SparkSession, path: str) -> DataFrame:
    """The stored ids themselves: (doc_id, ids)."""
    def run(frames):
        for f in frames:
            for r in f.itertuples():
                ids = np.split(_matrix(r).decode().astype(np.int64), np.cumsum(r.doc_lens)[:-1])
                yield pd.DataFrame({"doc_id": pd.array(list(r.doc_ids), "Int64"), "ids": [x.tolist() for x in ids]})
    return spark.read.schema(SCHEMA).parquet(path).mapInPandas(run, "doc_id long, ids array<long>")


def count_tokens(spark: SparkSession, path: str, ids: list[int]) -> DataFrame:
    """How often each of the given ids occurs: (token_id, occurrences), by two ranks per plane and block."""
    def run(frames):
        for f in frames:
            for r in f.itertuples():
                m = _matrix(r)
                yield pd.DataFrame({"token_id": ids, "n": [m.count(i) for i in ids]})
    found = spark.read.schema(SCHEMA).parquet(path).mapInPandas(run, "token_id long, n long")
    return found.groupBy("token_id").agg(F.sum("n").alias("occurrences"))


def find_tokens(spark: SparkSession, path: str, ids: list[int]) -> DataFrame:
    """Every occurrence of the given ids: (token_id, doc_id, offset in the document), by select."""
    def run(frames):
        for f in frames:
            for r in f.itertuples():
                m, ends = _matrix(r), np.cumsum(r.doc_lens)
                for i in ids:
                    at = m.find(i)
                    d = np.searchsorted(ends, at, side="right")
                    yield pd.DataFrame({"token_id": i, "doc_id": pd.array([r.doc_ids[x] for x in d], "Int64"),
                                        "offset": at - (ends - r.doc_lens)[d]})
    return spark.read.schema(SCHEMA).parquet(path).mapInPandas(run, "token_id long, doc_id long, offset long")


def access(spark: SparkSession, path: str, positions: list[int]) -> DataFrame:
    """The ids at the given positions of the whole token stream: (position, token_id). Blocks that hold none of them
    are dropped by their starts before a plane is read."""
    blocks = spark.read.schema(SCHEMA).parquet(path)
    starts = written(_starts(blocks), "block-starts")
    wanted = spark.createDataFrame([(int(p),) for p in positions], "position long")
    sizes = blocks.select("shard", "block", "n_tokens")
    near = starts.join(sizes, ["shard", "block"]).join(
        F.broadcast(wanted), (F.col("position") >= F.col("block_start")) & (F.col("position") < F.col("block_start") + F.col("n_tokens")))
    near = near.groupBy("shard", "block", "block_start").agg(F.collect_list("position").alias("at"))

    def run(frames):
        for f in frames:
            for r in f.itertuples():
                at = np.array(r.at, np.int64)
                yield pd.DataFrame({"position": at, "token_id": _matrix(r).access(at - r.block_start)})
    return blocks.join(F.broadcast(near), ["shard", "block"]).mapInPandas(run, "position long, token_id long")


def q_op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded into wavelet-matrix shards and read back from the files."""
    import public_tokenizers
    path = scratch_path(spark, "wavelet-shards")
    write_shards(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_documents(spark, path)
