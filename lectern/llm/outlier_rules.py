"""Quality rules: minimum-covariance-determinant estimates of text statistics per language and source, with Spark
expressions only.

Each text gives a vector of transformed statistics (``DIMENSIONS``). Per language and source, centre and covariance are
those of the half of the documents (``KEEP``) whose covariance has the smallest determinant: from two starts (medians with
median deviations; the same with the correlations of the rows' directions) concentration steps alternate between distances
and estimates until the determinant stops falling, the start with the smaller one counts, and the estimate is made once more
from all documents within ``REWEIGHT``. Up to nearly half of a group may be junk. All steps are aggregates over narrow rows;
order statistics come from counts in fine bins, so no group, however large, is sorted or collected. Documents beyond
``CUTOFF`` are rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.llm.common import aside, bounded, table, words, written

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8  # words; the hashes below are doubled three times, so this is fixed
KEEP = 0.5
#: Steps go on while the logarithm of a determinant falls by more than this; it is bounded below, so they end.
FALL = 1e-3
#: 97.5 % point of the chi-square distribution with five degrees of freedom.
REWEIGHT = 12.83
MIN_GROUP, MIN_POOL = 100, 30
#: Squared Mahalanobis distance, times n / (n + SHORT), beyond which a document of n words is rejected.
CUTOFF, SHORT = 30.0, 50
#: Median of the chi-square distribution with five degrees of freedom.
CHI2_MEDIAN = 4.351
BIN = 256
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_odd"]
#: Transformed statistics: (expression, smallest standard deviation).
DIMENSIONS = [
    ("ln(word_chars / n_words)", 0.08),
    ("ln(1 + 100 * n_symbols / n_words)", 0.5),
    ("ln(1 + 100 * n_odd / n_words)", 0.5),
    ("ln(1 + 100 * n_dup_lines / n_words)", 0.5),
    ("ln(1 + 100 * n_repeat_words / n_words)", 0.75),
]
P = len(DIMENSIONS)
_LOWER = [(i, j) for i in range(P) for j in range(i + 1)]
_ESTIMATE = [f"m{i}" for i in range(P)] + [f"l{i}_{j}" for i, j in _LOWER]


def _doubled(h: Column, step: int) -> Column:
    """Hashes of windows twice as long: of the entry and the one ``step`` further on."""
    return F.when(h.isNotNull(), F.transform(F.sequence(F.lit(0), F.size(h) - 1 - step),
                                             lambda i: F.xxhash64(F.get(h, i), F.get(h, i + step))))


def with_statistics(docs: DataFrame) -> DataFrame:
    """Add the counts of ``COUNTS`` to rows with ``text`` (null: empty). Everything stays in the row: windows of eight words
    are compared by 64-bit hashes, built by doubling; only a text that has a window twice sorts its windows. Write the
    result before filtering on the counts: a filter moved below them would work them out over and over."""
    text = F.coalesce("text", F.lit(""))
    df = docs.withColumn("_w", words(F.col("text"))).withColumn("n_words", F.size("_w").cast("long"))
    df = df.withColumn("word_chars", F.length(F.array_join("_w", "")).cast("long"))
    df = df.withColumn("n_symbols", (F.size(F.split(text, r"[#*$%&|<>]", -1)) - 1).cast("long"))
    df = df.withColumn("n_odd", F.length(F.regexp_replace(text, r"[\p{L}\s]+", "")).cast("long"))
    df = df.withColumn("_lines", F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    df = df.withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long")).drop("_lines")
    long = F.col("n_words") >= WINDOW
    df = df.withColumn("_h", F.when(long, F.transform("_w", lambda x: F.xxhash64(x)))).drop("_w")
    for step in (1, 2, 4):
        df = df.withColumn("_h", _doubled(F.col("_h"), step))
    h = F.col("_h")
    df = df.withColumn("_s", F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(
        F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    s = F.col("_s")
    twice = F.filter(s, lambda x, k: F.coalesce((x["h"] == F.get(s, k - 1)["h"]), F.lit(False))
                     | F.coalesce((x["h"] == F.get(s, k + 1)["h"]), F.lit(False)))
    at = F.sort_array(F.transform(twice, lambda x: x["i"]))
    covered = F.aggregate(at, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), lambda a, i: F.struct(
        (a["n"] + i + WINDOW - F.greatest(i, a["end"])).alias("n"), (i + WINDOW).alias("end")))
    df = df.withColumn("n_repeat_words", F.coalesce(F.when(s.isNotNull(), covered["n"]), F.lit(0)).cast("long"))
    return df.drop("_h", "_s")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _groups(rows: DataFrame) -> DataFrame:
    """(_lang, _source, _g): a language and source by itself if it has ``MIN_GROUP`` rows, else with the other small sources
    of its language, and if these are too few, with all such rest."""
    lang, source = (F.coalesce(F.concat(F.lit("="), c), F.lit("")) for c in ("lang", "source"))
    per = written(rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n")), "rule-groups")
    own = F.col("n") >= MIN_GROUP
    rest = per.filter(~own).groupBy(F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("_l")).agg(F.sum("n").alias("_rest"))
    per = per.join(bounded(rest), lang == F.col("_l"), "left")
    g = F.when(own, F.concat(lang, F.lit("\u0001"), source)).when(F.col("_rest") >= MIN_GROUP, lang).otherwise(F.lit("*"))
    return written(per.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), g.alias("_g")), "rule-group-names")


def _quantile_bins(counts: DataFrame, keys: list[str], shares: list[float]) -> DataFrame:
    """From (keys, bin, n): per key the first bin at which each share of the rows is reached."""
    run = F.sum("n").over(W.partitionBy(*keys).orderBy("bin"))
    all_ = F.sum("n").over(W.partitionBy(*keys))
    seen = counts.withColumn("_run", run).withColumn("_all", all_)
    return seen.groupBy(*keys).agg(*[F.min(F.when(F.col("_run") >= F.col("_all") * s, F.col("bin"))).alias(f"q{i}") for i, s in enumerate(shares)],
                                   F.first("_all").alias("_all"))


def _cholesky(cov: DataFrame, keys: list[str]) -> DataFrame:
    """From m0.. and c{i}_{j} (i >= j): the lower triangular root l{i}_{j} of the covariance, column by column, and
    ``lndet``, the logarithm of its determinant."""
    for j in range(P):
        d = F.col(f"c{j}_{j}")
        for k in range(j):
            d = d - F.col(f"l{j}_{k}") * F.col(f"l{j}_{k}")
        cov = cov.withColumn(f"l{j}_{j}", F.sqrt(F.greatest(d, F.lit(1e-12))))
        for i in range(j + 1, P):
            x = F.col(f"c{i}_{j}")
            for k in range(j):
                x = x - F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}")
            cov = cov.withColumn(f"l{i}_{j}", x / F.col(f"l{j}_{j}"))
    return cov.select(*keys, *_ESTIMATE, F.round(2 * sum((F.ln(f"l{i}_{i}") for i in range(1, P)), F.ln("l0_0")), 6).alias("lndet"))


def _distance(rows: DataFrame) -> DataFrame:
    """Add ``_d2``, the squared distance, by forward substitution; the root's columns are joined already."""
    for i in range(P):
        x = F.col(f"z{i}") - F.col(f"m{i}")
        for k in range(i):
            x = x - F.col(f"l{i}_{k}") * F.col(f"_y{k}")
        rows = rows.withColumn(f"_y{i}", x / F.col(f"l{i}_{i}"))
    d2 = sum((F.col(f"_y{i}") * F.col(f"_y{i}") for i in range(1, P)), F.col("_y0") * F.col("_y0"))
    return rows.withColumn("_d2", d2).drop(*[f"_y{i}" for i in range(P)])


def _bin_of(d2: Column) -> Column:
    return F.floor(F.log1p(d2) * BIN).cast("int")


def _starts(rows: DataFrame) -> DataFrame:
    """(_g, _start, estimate, lndet): start 0 has medians and median absolute deviations, start 1 also the correlations of the
    rows' directions from the median (spatial signs)."""
    long = rows.select("_g", F.posexplode(F.array(*[f"z{i}" for i in range(P)])).alias("k", "z"))
    counts = written(long.groupBy("_g", "k", F.floor(F.col("z") * BIN).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n")), "mcd-bins")
    mid = written(_quantile_bins(counts, ["_g", "k"], [0.5]).filter(F.col("_all") >= MIN_POOL).select("_g", "k", "q0"), "mcd-medians")
    off = counts.join(bounded(mid), ["_g", "k"]).groupBy("_g", "k", "q0", F.abs(F.col("bin") - F.col("q0")).alias("bin")).agg(F.sum("n").alias("n"))
    off = _quantile_bins(off.withColumnRenamed("q0", "mid"), ["_g", "k", "mid"], [0.5])
    floor = F.element_at(F.array(*[F.lit(f) for _, f in DIMENSIONS]), F.col("k") + 1)
    q = off.select("_g", "k", ((F.col("mid") + 0.5) / BIN).alias("m"), F.greatest(F.col("q0") / BIN * 1.4826, floor).alias("s"))
    first = q.groupBy("_g").agg(*[F.max(F.when(F.col("k") == i, F.col(c))).alias(f"{c}{i}") for c in ("m", "s") for i in range(P)])
    first = written(first, "mcd-first")
    u = [(F.col(f"z{i}") - F.col(f"m{i}")) / F.col(f"s{i}") for i in range(P)]
    norm = F.greatest(F.sqrt(sum((x * x for x in u[1:]), u[0] * u[0])), F.lit(1e-9))
    signs = rows.join(bounded(first), "_g").select("_g", *[(x / norm).alias(f"u{i}") for i, x in enumerate(u)])
    signs = signs.groupBy("_g").agg(*[F.round(F.avg(F.col(f"u{i}") * F.col(f"u{j}")), 9).alias(f"r{i}_{j}") for i, j in _LOWER])
    both = first.join(signs, "_g").select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("_start"))
    # The floor of 0.01 keeps a direction without spread from deciding alone.
    shape = lambda i, j: F.when(F.col("_start") == 0, float(i == j)).otherwise(F.col(f"r{i}_{j}") * P + (0.01 if i == j else 0.0))
    cov = both.select("_g", "_start", *[f"m{i}" for i in range(P)], *[(shape(i, j) * F.col(f"s{i}") * F.col(f"s{j}")).alias(f"c{i}_{j}") for i, j in _LOWER])
    return _cholesky(cov, ["_g", "_start"])


def _near(rows: DataFrame, est: DataFrame, keys: list[str]) -> DataFrame:
    """Each row beside each estimate of its group, with the bin of its squared distance."""
    return _distance(rows.join(bounded(est), "_g")).select(*keys, *[f"z{i}" for i in range(P)], _bin_of(F.col("_d2")).alias("bin"))


def _edges(near: DataFrame, keys: list[str], share: float) -> DataFrame:
    return _quantile_bins(near.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n")), keys, [share]).select(*keys, "q0")


def _moments(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Estimates from the given rows; the smallest standard deviations are added to the variances."""
    got = rows.groupBy(*keys).agg(*[F.round(F.avg(f"z{i}"), 9).alias(f"m{i}") for i in range(P)],
                                  *[F.round(F.covar_pop(f"z{i}", f"z{j}"), 9).alias(f"v{i}_{j}") for i, j in _LOWER])
    return _cholesky(got.select(*keys, *[f"m{i}" for i in range(P)], *[
        (F.col(f"v{i}_{j}") + (DIMENSIONS[i][1] ** 2 if i == j else 0.0)).alias(f"c{i}_{j}") for i, j in _LOWER]), keys)


def _scaled(rows: DataFrame, est: DataFrame) -> DataFrame:
    """Add ``scale``, by which squared distances are divided so that their median is at most the chi-square distribution's."""
    median = _edges(_near(rows, est, ["_g"]), ["_g"], 0.5)
    return est.join(median, "_g").withColumn("scale", F.greatest(F.lit(1.0), F.expm1((F.col("q0") + 0.5) / BIN) / CHI2_MEDIAN)).drop("q0")


def minimum_determinant(rows: DataFrame) -> DataFrame:
    """Per group ``_g`` of rows (_g, z0..): centre m, covariance root l and ``lndet`` of the ``KEEP`` share of its rows, from
    the start that ends with the smaller determinant. Groups below ``MIN_POOL`` rows get none."""
    keys = ["_g", "_start"]
    est, done = written(_starts(rows), "mcd-start"), None
    first = True
    while est.head(1):
        near = _near(rows, est, keys)
        edge = bounded(written(_edges(near, keys, KEEP), "mcd-edge"))
        step = _moments(near.join(edge, keys).filter("bin <= q0"), keys)
        # The starts are no estimates of a half, so their determinants are not compared.
        last = est.select(*keys, F.lit(None).cast("double").alias("_last") if first else F.col("lndet").alias("_last"))
        step = written(step.join(bounded(last), keys), "mcd-step")
        falls = F.col("_last").isNull() | (F.col("lndet") < F.col("_last") - FALL)
        ended = step.filter(~falls).drop("_last")
        done = ended if done is None else done.unionByName(ended)
        est, first = step.filter(falls).drop("_last"), False
    done = est.select(*keys, *_ESTIMATE, "lndet") if done is None else done
    best = done.groupBy("_g").agg(F.min_by(F.struct(*_ESTIMATE, "lndet"), F.struct("lndet", "_start")).alias("e"))
    return written(best.select("_g", "e.*"), "mcd-raw")


def covariance_estimates(rows: DataFrame) -> DataFrame:
    """Per group ``_g`` of written rows (_g, z0..): centre m and covariance root l of its rows within ``REWEIGHT`` of the
    minimum-determinant estimate, and ``scale`` for their squared distances."""
    raw = written(_scaled(rows, minimum_determinant(rows)), "mcd-scaled")
    inside = _distance(rows.join(bounded(raw), "_g")).filter(F.col("_d2") <= REWEIGHT * F.col("scale"))
    est = written(_moments(inside.select("_g", *[f"z{i}" for i in range(P)]), ["_g"]), "mcd-reweighted")
    return written(_scaled(rows, est), "mcd")


def judge(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, text_hash, counts, base_failed, distance, kept) for every row of ``docs``.

    A text fails the base rules with fewer than 20 words or if over 30 % of its words lie in repeated 8-word windows; the
    others are judged by their distance in their group. The verdict depends on lang, source and text alone, so repeated
    rows are judged alike. A null text is empty and fails; null lang or source form groups of their own; a group too
    small for an estimate, even pooled, rejects nothing; an empty table gives an empty result. Other columns are not
    read.
    """
    named = docs.select("doc_id", "lang", "source", F.xxhash64("text").alias("text_hash"), "text")
    stats = written(with_statistics(named).drop("text").withColumn("base_failed", base_failed()), "rule-statistics")
    good = stats.filter("not base_failed")
    names = bounded(_groups(good))
    z = [F.round(F.expr(e), 9).alias(f"z{i}") for i, (e, _) in enumerate(DIMENSIONS)]
    here = lambda df: df.join(names, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    est = bounded(covariance_estimates(written(here(good).select("_g", *z), "rule-vectors")))
    far = _distance(here(stats).select(stats["*"], "_g", *[F.when(~F.col("base_failed"), F.round(F.expr(e), 9)).alias(f"z{i}") for i, (e, _) in enumerate(DIMENSIONS)])
                    .join(est, "_g", "left"))
    far = far.withColumn("distance", F.col("_d2") / F.col("scale") * F.col("n_words") / (F.col("n_words") + SHORT))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= CUTOFF, F.lit(True))
    return far.withColumn("kept", kept).select("doc_id", "lang", "source", "text_hash", *COUNTS, "base_failed", "distance", "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """``docs`` without the rejected rows, all columns unchanged. Rejected rows are found again by doc_id, lang, source and
    text hash."""
    docs, back = aside(docs)
    bad = judge(docs).filter("not kept").select(*[F.col(c).alias(f"_r{i}") for i, c in enumerate(("doc_id", "lang", "source", "text_hash"))]).distinct()
    bad = written(bad, "rejected")
    same = (docs["doc_id"].eqNullSafe(F.col("_r0")) & docs["lang"].eqNullSafe(F.col("_r1"))
            & docs["source"].eqNullSafe(F.col("_r2")) & (F.xxhash64(docs["text"]) == F.col("_r3")))
    return back(docs.join(bounded(bad), same, "left_anti"))


def q_op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents judged by the base rules and the robust distances."""
    out = judge(table(spark, sf_dir, "documents"))
    return out.select("doc_id", *COUNTS[:5], "base_failed", "kept", "n_odd", "distance")
