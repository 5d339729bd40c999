"""Id assignment (R5 sequential ids, R6 next ids) and running counts per key without funnelling rows through one task.

R5 sorts by ranges: rows are range-partitioned by the ordering columns, written once with their task's number, counted
per task, and numbered inside their task; the running sum over the tasks' counts (one number per task, which the driver
tracks anyway) is added as a small literal table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.session import materialize


def sequential_ids(df: DataFrame, order, out: str = "book_id", start: int = 0) -> DataFrame:
    """``out`` = start, start+1, ... in ascending order of one or more columns (ties in any order)."""
    cols = [order] if isinstance(order, str) else list(order)
    ranged = materialize(df.repartitionByRange(*cols).withColumn("_part", F.spark_partition_id()), "ranged")
    before, offsets = start, []
    for part, n in sorted(ranged.groupBy("_part").count().collect()):
        offsets.append((part, before))
        before += n
    offsets = df.sparkSession.createDataFrame(offsets, "_part int, _before long")
    inside = Window.partitionBy("_part").orderBy(*cols)
    numbered = ranged.withColumn("_in", F.row_number().over(inside) - 1).join(F.broadcast(offsets), "_part")
    return numbered.withColumn(out, (F.col("_before") + F.col("_in")).cast("long")).drop("_part", "_in", "_before")


def next_ids(new_rows: DataFrame, existing: DataFrame, order, id_col: str = "book_id", out: str = "book_id") -> DataFrame:
    """New ids continue after the largest live id (``max + 1``, ``max + 2``, ... in the given order)."""
    top = existing.select(F.coalesce(F.max(id_col), F.lit(-1)).cast("long")).scalar()  # scalar subquery
    numbered = sequential_ids(new_rows, order, "_k")
    return numbered.withColumn(out, top + F.col("_k") + 1).drop("_k")


def running_count(df: DataFrame, key: str, order: str, when: Column, out: str) -> DataFrame:
    """``out``: how many of the key's rows up to this one (by ``order``, ties together) meet ``when``.

    Rows are ranged over tasks by (key, order) and written once; each task counts inside its range, and a key that crosses
    ranges adds the counts of its earlier ranges (one number per key and range). So no task holds a hot key. Rows of a null
    key are counted as one key.
    """
    hit = F.coalesce(when, F.lit(False)).cast("long")
    ranged = materialize(df.withColumn("_hit", hit).repartitionByRange(key, order).withColumn("_part", F.spark_partition_id()), "ranged")
    sums = ranged.groupBy(key, "_part").agg(F.sum("_hit").alias("_n"))
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(F.col(key).alias("_key"), F.col("_part").alias("_at"), F.sum("_n").over(before).alias("_before"))
    carried = carried.where(F.col("_before") > 0)  # only keys that cross ranges
    inside = Window.partitionBy("_part", key).orderBy(order)
    counted = ranged.withColumn("_in", F.sum("_hit").over(inside))
    met = counted.join(carried, (F.col("_part") == F.col("_at")) & F.col(key).eqNullSafe(F.col("_key")), "left")
    return met.withColumn(out, F.col("_in") + F.coalesce("_before", F.lit(0))).select(*df.columns, out)
