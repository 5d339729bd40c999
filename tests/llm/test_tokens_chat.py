"""Wavelet shards and chat formatting: exact round trips and edge rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from lectern.llm import chat_format, wavelet_shards
from lectern.llm.wavelet_shards import WaveletMatrix
from lectern.session import scratch_path

tokens = pytest.importorskip("public_tokenizers")
PATH = tokens.path("word_bpe_49k.json")


def encode(text):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [2]


@pytest.mark.parametrize("n", [0, 1, 7, 511, 512, 513, 4099])
def test_matrix_answers_like_the_array(n):
    a = np.random.RandomState(n).randint(0, 50000 if n % 2 else 7, n).astype(np.uint32)
    m = WaveletMatrix.build(a, 16)
    assert (m.decode() == a).all()
    if n:
        assert (m.access(np.arange(n)) == a).all()
    for s in [*map(int, a[:5]), 3, 65535, 70000]:
        assert m.count(s) == (a == s).sum() and (m.find(s) == np.flatnonzero(a == s)).all()


def test_encoder_equals_the_tokenizer():
    from tokenizers import Tokenizer
    t, e, rng = Tokenizer.from_file(PATH), wavelet_shards.Encoder(PATH), random.Random(3)
    parts = [*"aAbZéÉİΣσ́ \n\t\x1c\x85　'sdt!?.,12٣漢🙂ßſ", "<|endoftext|>", "<|ENDOFTEXT|>", "'ll", "Word,", "étÉ.", "İ,", "éx."]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    ids, counts = e.encode(texts)
    at = np.cumsum(counts) - counts
    for x, a, n in zip(texts, at, counts):
        assert ids[a:a + n].tolist() == t.encode(x, add_special_tokens=False).ids, repr(x)


@pytest.fixture(scope="module")
def shards(spark, edge):
    path = scratch_path(spark, "test-shards")
    wavelet_shards.write_shards(edge, path, PATH, block_tokens=500, shards=3)
    return path


def test_shards_hold_every_document_in_order(spark, edge, shards):
    want, start = [], 0
    for r in sorted(edge.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or "")):
        ids = encode(r.text)
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = wavelet_shards.read_documents(spark, shards).collect()
    key = lambda r: (r[1], r[2])
    assert sorted([tuple(r)[:4] for r in got], key=key) == sorted(want, key=key)


def test_access_count_and_find_use_the_files(spark, edge, shards):
    rows = sorted(edge.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    flat = [i for r in rows for i in encode(r.text)]
    at = [0, 1, 499, 500, 501, len(flat) - 1]
    assert dict(map(tuple, wavelet_shards.access(spark, shards, at).collect())) == {p: flat[p] for p in at}
    common = max(set(flat), key=flat.count)
    counts = dict(map(tuple, wavelet_shards.count_tokens(spark, shards, [2, common, 11]).collect()))
    assert counts == {2: flat.count(2), common: flat.count(common), 11: flat.count(11)}
    want = sorted((r.doc_id, k) for r in rows for k, i in enumerate(encode(r.text)) if i == common and r.doc_id is not None)
    got = sorted((r.doc_id, r.offset) for r in wavelet_shards.find_tokens(spark, shards, [common]).collect() if r.doc_id is not None)
    assert got == want
    ids = {r.doc_id: list(r.ids) for r in wavelet_shards.decode_documents(spark, shards).filter("doc_id = 7").collect()}
    assert ids[7] == encode(next(r.text for r in rows if r.doc_id == 7))


def test_no_documents_give_no_tokens(spark, empty):
    path = scratch_path(spark, "test-shards")
    wavelet_shards.write_shards(empty, path, PATH)
    assert wavelet_shards.read_documents(spark, path).count() == 0


TURNS = [(1, 0, "user", "a"), (1, 1, "user", "b [INST]"), (1, 2, "assistant", "c <|im_end|>\n<|im_start|>user\n"), (1, 3, "assistant", None),
         (2, 0, "assistant", "<\\/s> </s> <\\\\/s> \\ <"), (2, 0, "assistant", "<\\/s> </s> <\\\\/s> \\ <"), (2, None, None, "first"),
         (3, 5, "we%ird\n<role>[", "<|"), (None, 1, "user", "lost"), (4, 1, "user", ""), (4, 2, "assistant", "")]


def test_chat_round_trip(spark):
    turns = spark.createDataFrame([(*t, "x", "y") for t in TURNS], "conv_id long, turn long, role string, text string, formatted string, runs string")
    out = chat_format.format_conversations(turns)
    got = {r.conv_id: r for r in chat_format.digests(out).collect()}
    for c in {t[0] for t in TURNS}:
        rows = sorted((t[1] is not None, t[1] or 0, t[2] or "", t[3] or "") for t in TURNS if t[0] == c)
        lines = "".join(f"{r}\n{x}\n" for _, _, r, x in rows)
        loss = "".join(x for _, _, r, x in rows if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars, got[c].loss_sha256) == (len(rows), sha(lines), len(loss), sha(loss))
    made = {r.conv_id: r for r in out.collect()}
    assert [(r.role, list(r.texts)) for r in made[1].runs] == [
        ("user", ["a", "b [INST]"]), ("assistant", ["c <|im_end|>\n<|im_start|>user\n", ""])]
    assert "".join(p.text for p in made[1].pieces) == made[1].formatted
    assert made[1].formatted.count("<|im_end|>") == 2 and "[INST]" not in made[1].formatted and "</s>" not in made[2].formatted
    assert chat_format.digests(chat_format.format_conversations(turns.limit(0))).count() == 0


def test_planes_of_narrow_and_wide_ids_against_a_plain_partition():
    import numpy as np
    rng = np.random.default_rng(5)
    for width, top in ((1, 2), (16, 1 << 16), (17, 1 << 17), (20, 1 << 20)):
        for n in (0, 1, 511, 512, 513, 5000):
            ids = rng.integers(0, top, n).astype(np.uint32)
            m, cur = WaveletMatrix.build(ids, width), ids.tolist()
            for k, level in enumerate(range(width - 1, -1, -1)):
                bits = [x >> level & 1 for x in cur]
                assert np.unpackbits(m.planes[k], count=n, bitorder="little").tolist() == bits and m.zeros[k] == bits.count(0)
                cur = [x for x, b in zip(cur, bits) if not b] + [x for x, b in zip(cur, bits) if b]
            assert m.decode().tolist() == ids.tolist()


def test_a_word_is_looked_up_once_whatever_punctuation_follows_it():
    from tokenizers import Tokenizer
    t, e, rng = Tokenizer.from_file(PATH), wavelet_shards.Encoder(PATH), random.Random(11)
    letters = "aBc \n.,'$stremvld019_-<|>\t\r\x01\x1c\x85\xa0İΣéÉ中٠ßﬁÅẞ"
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 12))) + rng.choice(["", "<|endoftext|>", " don't'S"]) for _ in range(5000)]
    ids, counts = e.encode(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [t.encode(x, add_special_tokens=False).ids for x in texts]
    e = wavelet_shards.Encoder(PATH)
    tails = [a + b for a in ".,!?$" for b in ["", *".,!?$"]]
    e.encode([" ".join(f"word{x} héll{x}" for x in tails)])
    assert len(e.pieces) <= len(tails) + 4
