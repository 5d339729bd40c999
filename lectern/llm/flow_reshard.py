"""Minimum-cost-flow resharding: fewest bytes moved from old shards to new capacities, then affected files rewritten.

Law ``bytes``: new shards get nearly equal bytes. A document weighs its UTF-8 bytes plus 8. The flow network has one node
per old and per new shard (a few dozen, the shard counts are parameters); keeping bytes in their shard costs 0, moving a
byte costs 1. Its solution says how many bytes go from which old to which new shard.

Inside an old shard documents stand in the order (bucket, slice, text hash, doc_id); buckets are hash ranges of texts, and a
bucket far above the usual size is cut into slices. Bytes before a document are those of the units (bucket, slice) before it
plus those before it in its unit, so no task ever holds a shard. The flow becomes cuts of that byte order. A group of equal
texts goes where its middle byte falls, whole, so a cut is exact to half a group; only a group larger than both the largest
document and a hundredth of a new shard (at most 100 per new shard) may be cut: its documents are sliced by doc_id and go where their own middle bytes fall.
Its copies that share one doc_id, or have none, are one slice.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.llm.common import aside, bounded, table, written
from lectern.session import scratch_path

NEW_SHARDS, OLD_SHARDS = 24, 16
UNIT_BYTES = 64 << 20
UNITS = 2048
_UNIT = ["_old", "_bucket", "_slice"]


def min_cost_flow(supply: list[int], capacity: list[int], cost) -> list[list[int]]:
    """Cheapest transport of all supplies into the capacities (successive shortest paths over a bipartite network).
    ``cost(i, j)`` is the price of one unit from i to j. The sum of capacities must cover the supplies."""
    n, m = len(supply), len(capacity)
    if sum(capacity) < sum(supply):
        raise ValueError("capacities are smaller than the supplies")
    flow, left, room = [[0] * m for _ in range(n)], list(supply), list(capacity)
    for i in range(n):
        while left[i]:
            dist, back = [math.inf] * m, [None] * m  # shortest way to each new shard; back: the old shard it comes over
            reach = {i: (0, None)}
            todo = [i]
            while todo:
                a = todo.pop(0)
                base = reach[a][0]
                for j in range(m):
                    if base + cost(a, j) < dist[j]:
                        dist[j], back[j] = base + cost(a, j), a
                        for b in range(n):  # bytes of b in j may be sent elsewhere
                            if b != a and flow[b][j] and dist[j] - cost(b, j) < reach.get(b, (math.inf,))[0]:
                                reach[b] = (dist[j] - cost(b, j), j)
                                todo.append(b)
            j = min((j for j in range(m) if room[j]), key=lambda j: dist[j])
            end, path, amount = j, [], min(left[i], room[j])
            while True:
                a = back[j]
                path.append((a, j))
                if a == i:
                    break
                j = reach[a][1]
                path.append((a, j))
                amount = min(amount, flow[a][j])
            for k, (a, b) in enumerate(path):
                flow[a][b] += amount if k % 2 == 0 else -amount
            left[i] -= amount
            room[end] -= amount
    return flow


def equal_capacities(total: int, n: int) -> list[int]:
    return [total * (k + 1) // n - total * k // n for k in range(n)]


def size_of(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def reshard(docs: DataFrame, old: Column, path: str, capacities=None, new_shards: int = NEW_SHARDS,
            unit_bytes: int = UNIT_BYTES, old_files: bool = True) -> dict:
    """Write ``docs`` into new shards under ``path`` (Parquet, one folder ``shard=j`` each, with ``slot``, the row's gapless
    number in its shard) and return the flow: {(old, new): bytes}.

    ``old`` gives a row's present shard (an integer from 0; null counts as 0). Shards whose content does not change are not
    rewritten: they appear in the result as (j, j) alone and their rows are left where they are, in the old shards' files;
    with ``old_files=False`` there are none (``old`` is only a column), and every row is written. ``capacities`` (default:
    equal) must cover all bytes. A null text weighs 8 and is stored as null; repeated rows and equal doc_ids all stay;
    rows with a null doc_id are ordered first. Columns named shard or slot in ``docs`` are replaced. An empty table
    gives an empty folder.
    """
    spark = docs.sparkSession
    docs, back = aside(docs.withColumn("old shard", old.cast("int")))
    old = F.col("old shard")
    key = docs.withColumn("_old", F.coalesce(old.cast("int"), F.lit(0))).withColumn("_hash", F.xxhash64("text"))
    key = key.withColumn("_size", size_of(F.col("text"))).drop("shard", "slot")
    narrow = written(key.select("_old", "_hash", "doc_id", "_size"), "reshard-sizes")
    per_old = narrow.groupBy("_old").agg(F.sum("_size"), F.max("_size")).collect()
    totals = {r[0]: int(r[1]) for r in per_old}
    total = sum(totals.values())
    n_old = max(totals, default=-1) + 1
    caps = list(capacities) if capacities else equal_capacities(total, new_shards)
    n_new = len(caps)
    supply = [totals.get(i, 0) for i in range(n_old)]
    flow = min_cost_flow(supply, caps, lambda i, j: int(i != j))
    same = {j for j in range(min(n_old, n_new)) if flow[j][j] == supply[j] and all(not flow[i][j] for i in range(n_old) if i != j)}
    # (same shards keep their files, if there are any; the rest is rewritten)
    unit = max(1, min(unit_bytes, total // UNITS))
    buckets = max(1, math.ceil(total / max(1, n_old) / unit))
    bucket = F.pmod("_hash", F.lit(buckets)).cast("int")
    hot = narrow.withColumn("_bucket", bucket).groupBy("_old", "_bucket").agg(F.sum("_size").alias("_n")).filter(F.col("_n") > 4 * unit)
    hot = bounded(written(hot.select("_old", "_bucket", F.ceil(F.col("_n") / unit).cast("long").alias("_m")), "reshard-hot"))
    whole = max([total // n_new // 100, *(int(r[2]) for r in per_old)])
    large = narrow.groupBy("_old", "_hash").agg(F.sum("_size").alias("_n")).filter(F.col("_n") > whole)
    large = bounded(written(large.select("_old", "_hash", F.lit(True).alias("_large")), "reshard-large"))

    def sliced(df: DataFrame) -> DataFrame:
        df = df.withColumn("_bucket", bucket).join(hot, ["_old", "_bucket"], "left").join(large, ["_old", "_hash"], "left")
        at = F.when(F.col("_large"), F.xxhash64("doc_id")).otherwise(F.xxhash64("_hash"))
        return df.withColumn("_slice", F.when(F.col("_m").isNotNull(), F.pmod(at, "_m")).otherwise(0).cast("int")).drop("_m")

    units = sliced(narrow).groupBy(*_UNIT).agg(F.sum("_size").alias("_bytes"))
    units = units.withColumn("_before", F.sum("_bytes").over(W.partitionBy("_old").orderBy("_bucket", "_slice")) - F.col("_bytes"))
    cuts, at = [], [[0, []] for _ in range(n_old)]
    for i in range(n_old):
        for j in sorted(range(n_new), key=lambda j: (j != i, j)):
            if flow[i][j]:
                at[i][1].append((at[i][0], j))
                at[i][0] += flow[i][j]
        cuts.append((i, [lo for lo, _ in at[i][1]], [j for _, j in at[i][1]]))
    cuts = F.broadcast(spark.createDataFrame(cuts, "_old int, _lo array<long>, _to array<int>"))

    def target(before: Column) -> Column:
        return F.element_at("_to", F.greatest(F.size(F.filter("_lo", lambda x: x <= before)), F.lit(1)))

    # A unit is dealt to one task together with its neighbours of the same target, so a task writes few files.
    units = units.join(cuts, "_old").withColumn("_first", target(F.col("_before")))
    units = units.withColumn("_task", F.concat_ws("-", "_first", F.floor(F.col("_before") / (4 * unit)), "_old"))
    units = written(units.select(*_UNIT, "_before", "_task"), "reshard-units")
    order = [F.col("_hash"), F.col("doc_id")]

    def placed(df: DataFrame, moved: Column) -> DataFrame:
        df = sliced(df.filter(moved)).join(bounded(units), _UNIT).repartition("_task")
        unit = W.partitionBy("_task", *_UNIT)
        df = df.withColumn("_to_here", F.sum("_size").over(unit.orderBy(*order).rowsBetween(W.unboundedPreceding, 0)))
        copies = F.sum("_size").over(W.partitionBy("_task", *_UNIT, "_hash"))
        upto = F.sum("_size").over(unit.orderBy("_hash").rangeBetween(W.unboundedPreceding, W.currentRow))
        df = df.withColumn("_copies", copies).withColumn("_to_group", upto)
        middle = F.when(F.col("_large"), F.col("_to_here") - F.ceil(F.col("_size") / 2)).otherwise(F.col("_to_group") - F.ceil(F.col("_copies") / 2))
        return df.join(cuts, "_old").withColumn("shard", target(F.col("_before") + middle))

    moved = ~F.col("_old").isin(*same) if same and old_files else F.lit(True)
    counts = placed(narrow, moved).groupBy("shard", *_UNIT).agg(F.count(F.lit(1)).alias("_rows"))
    first = F.sum("_rows").over(W.partitionBy("shard").orderBy(*_UNIT)) - F.col("_rows")
    counts = bounded(written(counts.select("shard", *_UNIT, first.alias("_slot")), "reshard-slots"))
    rows = placed(key, moved)
    rank = F.row_number().over(W.partitionBy("_task", *_UNIT, "shard").orderBy(*order)) - 1
    rows = rows.withColumn("_rank", rank).join(counts, ["shard", *_UNIT]).withColumn("slot", F.col("_slot") + F.col("_rank"))
    rows = back(rows.select(*[c for c in docs.columns if c not in ("shard", "slot", "old shard")], F.col("slot").cast("long"), "shard"))
    rows.write.option("compression", "zstd").partitionBy("shard").parquet(path)
    return {(i, j): flow[i][j] for i in range(n_old) for j in range(n_new) if flow[i][j]}


def read_shards(spark: SparkSession, docs: DataFrame, path: str) -> DataFrame:
    """The written shards with the columns of ``docs``, slot and shard."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name not in ("shard", "slot"))
    return spark.read.schema(f"{schema}, slot long, shard int").parquet(path)


def resharded(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs``, held in 16 shards by the crc32 of their texts, moved into 24 shards of equal bytes; the contract's columns
    read back from the new files. The old shards are no files, so unaffected ones are written as well."""
    path = scratch_path(spark, "reshard")
    docs = docs.select("doc_id", "text")
    reshard(docs, F.pmod(F.crc32(F.coalesce("text", F.lit(""))), F.lit(OLD_SHARDS)), path, old_files=False)
    return read_shards(spark, docs, path).select(
        "doc_id", size_of(F.col("text")).alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def q_op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents moved from 16 old shards to 24 new ones."""
    return resharded(spark, table(spark, sf_dir, "documents"))
