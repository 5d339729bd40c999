"""Benchmark decontamination as a prefix-filtered set join, with Spark expressions only.

Every benchmark item is cut into windows of ``WINDOW`` consecutive words (a shorter item is one window). A window occurs
in a document only if all of its shingles (``SHINGLE`` words) do, so it is enough to look for one: shingles are ordered by
their number of occurrences in the whole corpus, and the rarest shingle of a window is its prefix. Document positions that
hold a prefix shingle are candidates; the window must fit between the document's first and last word from there
(positional and length bounds), and is then compared word by word.

The corpus is exploded once, into narrow rows (document key, position, shingle hash) of which only those that meet a
benchmark shingle are written; counts and candidates come from that table. Texts are read a second time for the
documents that have candidates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import aside, az_lower, bounded, table, written

WINDOW = 13
SHINGLE = 3
#: A document is contaminated if at least one word in this many is hit.
SHARE = 20
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Candidates that may be broadcast (about 40 bytes each); more are joined by a shuffle.
MAX_CANDIDATES = 2_000_000


def item_words(text: Column) -> Column:
    return F.array_remove(F.split(az_lower(F.coalesce(text, F.lit(""))), BETWEEN), "")


def _loose_words(text: Column) -> Column:
    """Words in full lower case: as many as ``item_words``, equal wherever those are equal, and cheaper."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), BETWEEN), "")


def n_words(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), BETWEEN_ANY_CASE), ""))


def _shingles(w: str, k: int) -> Column:
    """Hashes of all k-word shingles of an array column, by position."""
    return F.when(F.size(w) >= k, F.transform(F.sequence(F.lit(0), F.size(w) - k), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)])))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (wid, n, seen, shingles) and their items (wid, item). Items without words or id have none."""
    items = benchmark.filter("item_id is not null").select(F.col("item_id").cast("string").alias("item"), item_words(F.col("text")).alias("w"))
    items = items.filter(F.size("w") > 0).withColumn("n", F.least(F.size("w"), F.lit(window)))
    cut = items.select("item", "n", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - F.col("n") + 1), lambda i: F.slice("w", i, F.col("n")))).alias("w"))
    cut = written(cut.select("item", "n", F.array_join("w", " ").alias("seen")).distinct(), "item-windows")
    wins = written(cut.select("n", "seen").distinct().withColumn("wid", F.monotonically_increasing_id()), "windows")
    lower = wins.withColumn("_w", F.split(F.lower("seen"), " "))
    sized = F.coalesce(_shingles("_w", SHINGLE), *[_shingles("_w", k) for k in range(SHINGLE - 1, 0, -1)])
    return lower.withColumn("shingles", sized).drop("_w"), cut.join(wins, ["n", "seen"]).select("wid", "item")


def shingle_hits(docs: DataFrame, wins: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_words, pos, shingle): every position of every document that holds a benchmark shingle."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), _loose_words(F.col("text")).alias("_w"))
    sizes = [r[0] for r in wins.select(F.least("n", F.lit(SHINGLE)).alias("k")).distinct().collect()]
    found = None
    for k in sorted(sizes) or [SHINGLE]:
        known = written(wins.filter(F.least("n", F.lit(SHINGLE)) == k).select(F.explode("shingles").alias("shingle")).distinct(), "shingles")
        at = rows.select("doc_id", "text_hash", F.size("_w").alias("n_words"), F.posexplode(_shingles("_w", k)).alias("pos", "shingle"))
        hit = at.join(bounded(known), "shingle", "left_semi").withColumn("k", F.lit(k))
        found = hit if found is None else found.unionByName(hit)
    return written(found, "shingle-hits")


def window_hits(docs: DataFrame, wins: DataFrame) -> DataFrame:
    """(doc_id, text_hash, start, n, wid): every occurrence of every window in every document."""
    wins = written(wins, "windows-shingled")
    hits = shingle_hits(docs, wins)
    rarity = hits.groupBy("k", "shingle").agg(F.count(F.lit(1)).alias("_times"))
    parts = wins.select("wid", "n", F.least("n", F.lit(SHINGLE)).alias("k"), F.posexplode("shingles").alias("off", "shingle"))
    prefix = parts.join(rarity, ["k", "shingle"]).groupBy("wid", "n", "k").agg(
        F.min(F.struct("_times", "shingle", "off")).alias("_p")).select("wid", "n", "k", "_p.shingle", "_p.off")
    prefix = written(prefix, "prefixes")
    start = F.col("pos") - F.col("off")
    cand = hits.join(bounded(prefix), ["k", "shingle"]).filter((start >= 0) & (start + F.col("n") <= F.col("n_words")))
    cand = written(cand.select("doc_id", "text_hash", start.alias("start"), "n", "wid"), "candidates")
    per = cand.groupBy(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h")).agg(F.collect_list(F.struct("start", "n", "wid")).alias("_at"))
    per = F.broadcast(per) if cand.count() <= MAX_CANDIDATES else per
    named = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    both = named.join(per, named["doc_id"].eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_h")))
    both = both.select("doc_id", "text_hash", "_at", item_words(F.col("text")).alias("_w"))
    seen = both.select("doc_id", "text_hash", F.explode(F.transform("_at", lambda c: F.struct(
        c["start"].alias("start"), c["n"].alias("n"), c["wid"].alias("wid"),
        F.array_join(F.slice("_w", c["start"] + 1, c["n"]), " ").alias("seen")))).alias("c")).select("doc_id", "text_hash", "c.*")
    exact = seen.join(bounded(wins.select("wid", "seen")), ["wid", "seen"], "left_semi")
    return written(exact.select("doc_id", "text_hash", "start", "n", "wid"), "window-hits")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE) -> DataFrame:
    """(doc_id, text_hash, n_words, n_hit, n_items, items, contaminated) for every row of ``docs``.

    n_hit counts the words inside any occurrence of a window, items lists the ids of items with an occurring window, sorted
    as strings. A null or wordless text has no words and is clean; rows that agree in doc_id and text get the same result;
    an empty corpus or benchmark gives no hits. Only doc_id, text and item_id, text are read.
    """
    wins, members = benchmark_windows(benchmark, window)
    hits = window_hits(docs, wins)
    cover = F.aggregate(F.sort_array(F.collect_set(F.struct("start", "n"))), F.struct(F.lit(0).alias("c"), F.lit(0).alias("end")),
                        lambda a, x: F.struct((a["c"] + F.greatest(x["start"] + x["n"] - F.greatest(x["start"], a["end"]), F.lit(0))).alias("c"),
                                              F.greatest(x["start"] + x["n"], a["end"]).alias("end")))["c"]
    key = ["doc_id", "text_hash"]
    named = hits.select(*key, "wid").distinct().join(bounded(written(members, "window-items")), "wid").select(*key, "item").distinct()
    items = named.groupBy(*key).agg(F.sort_array(F.collect_list("item")).alias("items"))
    per = hits.groupBy(*key).agg(cover.alias("n_hit"))
    per = per.join(items.withColumnsRenamed({"doc_id": "_d", "text_hash": "_h"}), per["doc_id"].eqNullSafe(F.col("_d")) & (per["text_hash"] == F.col("_h")), "left")
    per = written(per.select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h"), "n_hit", "items"), "contamination")
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), n_words(F.col("text")).cast("long").alias("n_words"))
    out = rows.join(bounded(per), rows["doc_id"].eqNullSafe(F.col("_d")) & (rows["text_hash"] == F.col("_h")), "left")
    hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return out.select("doc_id", "text_hash", "n_words", hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"), items.alias("items"),
                      ((hit > 0) & (hit * share >= F.col("n_words"))).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated rows, all columns unchanged."""
    docs, back = aside(docs)
    bad = contamination(docs, benchmark).filter("contaminated").select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h")).distinct()
    same = docs["doc_id"].eqNullSafe(F.col("_d")) & (F.xxhash64(docs["text"]) == F.col("_h"))
    return back(docs.join(bounded(written(bad, "contaminated")), same, "left_anti"))


def q_op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items."""
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


_SQL_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
              r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
ORACLE_OP6 = f"""
WITH i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_SQL_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
i2 AS (SELECT item, w, least(len(w), {WINDOW}) AS n FROM i WHERE len(w) > 0),
win AS (SELECT DISTINCT item, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS seen
  FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM i2)),
d AS (SELECT row_number() OVER () AS rid, doc_id, {_SQL_WORDS} AS w FROM documents),
pos AS (SELECT rid, n, s, array_to_string(list_slice(w, s, s + n - 1), ' ') AS seen
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT rid, win.n, s, item FROM pos JOIN win ON pos.seen = win.seen AND pos.n = win.n),
cov AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + n)) AS p FROM hit) GROUP BY rid),
its AS (SELECT rid, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS items FROM hit GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit > 0 AND {SHARE} * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN cov USING (rid) LEFT JOIN its USING (rid)
"""
