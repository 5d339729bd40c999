"""Quality classifier: ordinal cumulative-link regression on graded ratings over hashed text features.

P(grade >= k) = sigmoid(w . x - theta_k): all grades share the weights ``w``, the thresholds are ordered. Features are the
distinct words of a text (A-Z lower-cased, cut at ASCII punctuation) and a few binned shape counts, hashed into ``DIM``
buckets. Training is proximal (L1) online gradient descent over a sample of rated rows that is bounded by
``SAMPLE_ROWS``, a parameter; the fitted model has a fixed size, whatever the corpus. Every document is then scored in place: expected
grade, tail probability of the top grade, and whether that reaches ``SELECT_AT``.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import bounded, table, uniform, written

DIM = 1 << 18
SAMPLE_ROWS = 20_000
EPOCHS = 4
SELECT_AT = 0.5
MEMO_WORDS = 400_000
_CUT = bytes(b if chr(b).isalnum() or b >= 128 else 32 for b in range(256))
_SHAPES = [("symbols", b"#*$%&|<>"), ("marks", b"!?"), ("upper", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ("digits", b"0123456789")]


class _Buckets(dict):
    def __missing__(self, word):
        import xxhash
        v = self[word] = xxhash.xxh3_64_intdigest(word) % DIM
        return v


@lru_cache(maxsize=1)
def buckets() -> _Buckets:
    """One table per worker process, kept over tasks."""
    return _Buckets()


def features(text: str | None, known: dict) -> np.ndarray:
    """Sorted distinct buckets of a text. Null and empty texts have the shape features only."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.lower().translate(_CUT).split()
    names = dict.fromkeys(words)
    n = max(1, len(words))
    for name, chars in _SHAPES:
        share = (len(raw) - len(raw.translate(None, chars))) / n
        names[b"\x00%s=%d" % (name.encode(), min(12, int(4 * share + 0.999)))] = None
    names[b"\x00distinct=%d" % int(10 * len(set(words)) / n)] = None
    names[b"\x00length=%d" % len(words).bit_length()] = None
    return np.unique(np.fromiter(map(known.__getitem__, names), np.int64, len(names)))


def _sigmoid(x: float) -> float:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(rows: list[np.ndarray], grades: np.ndarray, n_grades: int, epochs: int = EPOCHS, alpha: float = 0.5, l1: float = 3.0) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by follow-the-regularised-leader: rare words keep weight 0 unless they tell grades apart."""
    z, s = np.zeros(DIM), np.zeros(DIM)
    at_least = [max(1e-3, min(1 - 1e-3, float(np.mean(grades >= k)))) for k in range(1, n_grades)] if len(grades) else [0.5] * (n_grades - 1)
    theta = np.array([-np.log(p / (1 - p)) for p in at_least])
    theta += np.arange(len(theta)) * 0.05
    rate = 0.05

    def weights(zi, si):
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((1 + np.sqrt(si)) / alpha))

    for _ in range(epochs):
        for x, y in zip(rows, grades.tolist()):
            w = weights(z[x], s[x])
            f = w.sum()
            p = _sigmoid(f - theta)  # P(grade >= 1), P(grade >= 2), ...
            up, down = (p[y - 1] if y else 1.0), (p[y] if y < len(p) else 0.0)
            slope = up + down - 1  # of the loss -log P(grade), by f
            g2 = slope * slope
            sigma = (np.sqrt(s[x] + g2) - np.sqrt(s[x])) / alpha
            z[x] += slope - sigma * w
            s[x] += g2
            gap = max(up - down, 1e-6)
            if y:  # raising the threshold below the grade makes it less likely
                theta[y - 1] -= rate * min(5.0, up * (1 - up) / gap)
            if y < len(theta):
                theta[y] += rate * min(5.0, down * (1 - down) / gap)
            for k in range(1, len(theta)):
                theta[k] = max(theta[k], theta[k - 1] + 0.1)
        rate /= 2
    return weights(z, s), theta


def rating_sample(docs: DataFrame, grades: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(key, grade, hash, x) of about ``rows`` rated documents at most, chosen by a hash of doc_id. ``grades(doc_id, grade)`` has one
    row per document."""
    rated = written(grades.withColumn("_u", uniform(F.lit("rating"), F.col("doc_id").cast("string"))), "grades")
    share = min(1.0, rows / max(1, rated.count()))
    picked = rated.filter(F.col("_u") < share).withColumnRenamed("doc_id", "_d")
    found = docs.select("doc_id", "text").join(bounded(picked), F.col("doc_id") == F.col("_d")).select("_u", "grade", "text", F.xxhash64("text").alias("hash"))

    def run(frames):
        for f in frames:
            yield pd.DataFrame({"key": f["_u"], "grade": f["grade"].astype(int), "hash": f["hash"], "x": [features(t, buckets()) for t in f["text"]]})
    return found.mapInPandas(run, "key double, grade int, hash long, x array<long>")


def train(sample: DataFrame, n_grades: int) -> tuple[np.ndarray, np.ndarray]:
    """Fit in one task over the bounded sample, in the order of keys, grades and texts' hashes, so rows that share a doc_id
    come in one order too; only weights and thresholds come back."""
    def run(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(["key", "grade", "hash"], kind="stable")
        w, theta = fit([np.asarray(x, np.int64) for x in f["x"]], f["grade"].to_numpy(), n_grades)
        at = np.flatnonzero(w)
        return pd.DataFrame({"at": [at.astype("<i4").tobytes()], "w": [w[at].astype("<f4").tobytes()], "theta": [theta.tolist()]})
    got = sample.groupBy(F.lit(0).alias("_all")).applyInPandas(run, "at binary, w binary, theta array<double>").first()
    w = np.zeros(DIM, np.float32)
    if got is None:
        return w, np.arange(n_grades - 1, dtype=float)
    w[np.frombuffer(got["at"], "<i4")] = np.frombuffer(got["w"], "<f4")
    return w, np.array(got["theta"])


def score(docs: DataFrame, w: np.ndarray, theta: np.ndarray, select_at: float = SELECT_AT) -> DataFrame:
    """(doc_id, expected_grade, tail_probability, selected) for every row. Null and empty texts are scored by their shape
    features; repeated rows all stay."""
    at = np.flatnonzero(w)
    sparse, cuts = (at.astype(np.int64), w[at].astype(np.float64)), np.asarray(theta, float)

    def run(frames):
        full = np.zeros(DIM)
        full[sparse[0]] = sparse[1]
        for f in frames:
            known = buckets()
            if len(known) > MEMO_WORDS:
                known.clear()
            raw = np.array([full[features(t, known)].sum() for t in f["text"]])
            p = 1 / (1 + np.exp(-np.clip(raw[:, None] - cuts[None, :], -35, 35))) if len(raw) else np.zeros((0, len(cuts)))
            yield pd.DataFrame({"doc_id": f["doc_id"], "expected_grade": np.round(p.sum(1), 6), "tail_probability": np.round(p[:, -1] if len(raw) else [], 6),
                                "selected": p[:, -1] >= select_at if len(raw) else []})
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    out = rows.mapInPandas(run, "doc_id string, expected_grade double, tail_probability double, selected boolean")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def grade_of(quality: Column, toxic: Column) -> Column:
    """0 toxic, 1 poor, 2 good."""
    return F.when(F.coalesce(toxic, F.lit(0)) == 1, 0).when(F.coalesce(quality, F.lit(1)) == 0, 1).otherwise(2)


def grades_from_labels(labels: DataFrame) -> DataFrame:
    """One grade per labelled document; several labels count as their worst, labels without doc_id are left out."""
    return labels.filter("doc_id is not null").groupBy("doc_id").agg(F.min(grade_of(F.col("quality"), F.col("toxic"))).alias("grade"))


def q_op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a model fitted on the labels."""
    docs = table(spark, sf_dir, "documents")
    w, theta = train(rating_sample(docs, grades_from_labels(table(spark, sf_dir, "labels"))), 3)
    return score(docs, w, theta)
