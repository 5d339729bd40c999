"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source gets a target in words: its weight's share of all words, at most ``max_epochs`` times its own words, the
excess going to the other sources by weight. A source is taken whole ``floor(target / words)`` times (complete epochs);
the remaining budget is filled in ascending order of the exponential keys ``-ln(u) / quality weight``, up to the document
at which the running sum of words is nearest to the budget.

The order inside a source is never sorted in one task: keys are counted in ``BINS`` bins, sums over the bins show the one
bin in which the budget ends, and only that bin's rows are sorted, to find the source's last key. Documents are then
chosen by comparing their key with that last key, so texts are not shuffled at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.llm.common import aside, bounded, numbered, table, uniform, words, written

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
SEED = 17
BINS = 1 << 16
#: Quality weights of the query: labelled good and clean, labelled otherwise, without a label.
GOOD, POOR, UNLABELLED = 2.0, 0.5, 1.0


def sampling_key(seed: int, weight: Column) -> Column:
    """-ln(u) / weight with u from the seed, doc_id and text; a missing or NaN weight is 1, one below 1e-6 is 1e-6."""
    u = uniform(F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce("text", F.lit(""))))
    w = F.greatest(F.coalesce(F.nanvl(weight.cast("double"), F.lit(1.0)), F.lit(1.0)), F.lit(1e-6))
    return -F.log(u) / w


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) from rows (source, size). Sources in code-point order, null last, take the weights
    in turn. The level ``L`` at which sum(min(weight * L, cap)) equals all words is found by raising L until no further
    source reaches its cap; each step sums the table of sources, only two numbers reach the driver."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = numbered(per, "_k", F.col("source").asc_nulls_last())
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_k") % len(weights) + 1).cast("int"))
    per = written(per.select("source", "source_size", turn.alias("_w")), "sources")
    cap = F.col("source_size") * float(max_epochs)
    total = per.agg(F.sum("source_size")).first()[0] or 0
    level = -1.0
    while True:
        full = cap < F.lit(level) * F.col("_w")
        capped, free = per.agg(F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("_w")))).first()
        new = (total - (capped or 0.0)) / free if free else level
        if new <= level:
            break
        level = new
    return per.select("source", "source_size", F.least(cap, F.col("_w") * F.lit(max(level, 0.0))).alias("target"))


def mix_plan(docs: DataFrame, weight: Column, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """One row per source: source_size, target, epochs and last_key (the largest key that the budget left after the
    complete epochs still takes; null if none)."""
    key = sampling_key(seed, weight)
    rows = written(docs.select("source", F.size(words(F.col("text"))).cast("long").alias("size"), key.alias("_key")), "mix-keys")
    rows = rows.withColumn("_bin", F.floor(F.col("_key") / (1 + F.col("_key")) * BINS).cast("int"))
    per = source_targets(rows, weights, max_epochs)
    per = per.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    per = written(per.withColumn("_rest", F.col("target") - F.col("epochs") * F.col("source_size")), "targets")
    bins = rows.groupBy("source", "_bin").agg(F.sum("size").alias("_n"), F.count(F.lit(1)).alias("_rows"))
    bins = bins.withColumn("_before", F.sum("_n").over(W.partitionBy("source").orderBy("_bin")) - F.col("_n"))
    ends = per.withColumnRenamed("source", "_s")
    # The last bin that begins within the budget; the budget ends inside it, or with all of it.
    last = (bins.join(ends, bins["source"].eqNullSafe(ends["_s"])).filter("_rest > 0 and _before <= _rest")
            .groupBy("source").agg(F.max("_bin").alias("_bin"), F.max_by("_before", "_bin").alias("_before"),
                                   F.first("_rest").alias("_rest")))
    last = written(last.select(F.col("source").alias("_s"), F.col("_bin").alias("_b"), "_before", "_rest"), "mix-bins")
    near = rows.join(bounded(last), rows["source"].eqNullSafe(F.col("_s")) & (F.col("_bin") == F.col("_b")))
    near = near.groupBy("_s", "_key", "_before", "_rest").agg(F.sum("size").alias("_n"))
    run = F.col("_before") + F.sum("_n").over(W.partitionBy("_s").orderBy("_key")) - F.col("_n") / 2
    cut = near.withColumn("_mid", run).filter("_mid <= _rest").groupBy("_s").agg(F.max("_key").alias("_cut"))
    cut = written(cut, "mix-cuts")
    # No document of the last bin fits: all before it do, and keys below the bin's lower edge are taken.
    edge = F.when(F.col("_b") > 0, (F.col("_b") / BINS) / (1 - F.col("_b") / BINS))
    found = last.join(cut.withColumnRenamed("_s", "_t"), F.col("_s").eqNullSafe(F.col("_t")), "left")
    found = found.select("_s", F.coalesce("_cut", edge).alias("last_key"))
    return per.join(found, per["source"].eqNullSafe(F.col("_s")), "left").select(
        "source", "source_size", "target", "epochs", "last_key")


def mix(docs: DataFrame, weight: Column, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """``docs`` with size, source_size, target and copies (how often the mix takes the document, 0 included).

    Every row is judged. A null text has size 0; a null source is a source; rows that agree in doc_id and text share
    their key and are taken alike; an empty table gives an empty one. Columns of ``docs`` with one of these names are
    replaced. The table of sources is broadcast if its row count allows.
    """
    own = ("size", "source_size", "target", "copies", "epochs", "last_key")
    docs, back = aside(docs.withColumn("weight in the mix", weight))
    weight = F.col("weight in the mix")
    plan = written(mix_plan(docs, weight, weights, max_epochs, seed), "mix-plan").withColumnRenamed("source", "_s")
    rows = docs.withColumn("_key", sampling_key(seed, weight)).drop(*own)
    rows = rows.join(bounded(plan), rows["source"].eqNullSafe(F.col("_s")), "left")
    extra = F.when(F.col("_key") <= F.col("last_key"), 1).otherwise(0)
    return back(rows.withColumn("size", F.size(words(F.col("text"))).cast("long"))
                .withColumn("copies", (F.col("epochs") + extra).cast("long")).drop("_s", "_key", "epochs", "last_key", "weight in the mix"))


def with_quality_weights(docs: DataFrame, labels: DataFrame, name: str = "quality weight") -> DataFrame:
    """Add column ``name`` from the labels; several labels of a document count as their worst."""
    docs, back = aside(docs)
    per = labels.groupBy("doc_id").agg(F.min("quality").alias("_q"), F.max("toxic").alias("_t"))
    per = written(per.filter("doc_id is not null").withColumnRenamed("doc_id", "_d"), "label-weights")
    rows = docs.join(bounded(per), docs["doc_id"] == F.col("_d"), "left")
    w = F.when(F.col("_d").isNull(), UNLABELLED).when((F.col("_q") == 1) & (F.coalesce("_t", F.lit(0)) == 0), GOOD).otherwise(POOR)
    return back(rows.withColumn(name, w).drop("_d", "_q", "_t"))


def q_op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed; taken counts the words the mix takes from a document, repeats included."""
    docs = with_quality_weights(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), table(spark, sf_dir, "labels"))
    out = mix(docs, F.col("quality weight"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


ORACLE_OP10 = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
    (CAST(('0x' || substr(md5('{SEED}|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))), 1, 13)) AS BIGINT) + 0.5::DOUBLE)
      / {float(2 ** 52)!r}::DOUBLE AS u FROM documents
), lab AS (SELECT doc_id, min(quality) AS q, max(toxic) AS t FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
keyed AS (
  SELECT d.doc_id, source, size, -ln(u) / CASE WHEN lab.doc_id IS NULL THEN {UNLABELLED}::DOUBLE
    WHEN q = 1 AND coalesce(t, 0) = 0 THEN {GOOD}::DOUBLE ELSE {POOR}::DOUBLE END AS k
  FROM d LEFT JOIN lab ON d.doc_id = lab.doc_id
), src AS (
  SELECT source, sum(size)::BIGINT AS s, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM keyed GROUP BY source
), wei AS (
  SELECT source, s, CASE i % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM src
), lev AS (
  SELECT *, (sum(s) OVER () - coalesce(sum(3 * s) OVER (ORDER BY s / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(w) OVER (ORDER BY s / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS l,
    row_number() OVER (ORDER BY s / w, source) AS r FROM wei
), lam AS (SELECT coalesce(arg_min(l, r) FILTER (3 * s >= l * w), 0) AS l FROM lev),
tgt AS (
  SELECT source, s, least(3.0::DOUBLE * s, w * (SELECT l FROM lam)) AS target FROM wei
), ep AS (SELECT *, CASE WHEN s > 0 THEN floor(target / s)::BIGINT ELSE 0 END AS e FROM tgt),
run AS (
  SELECT doc_id, size, s, target, e, target - e * s AS rest,
    sum(size) OVER (PARTITION BY keyed.source ORDER BY k) - size / 2.0::DOUBLE AS mid
  FROM keyed JOIN ep ON keyed.source IS NOT DISTINCT FROM ep.source
)
SELECT doc_id, size, s AS source_size, target,
  CAST(size * (e + CASE WHEN rest > 0 AND mid <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM run
"""
