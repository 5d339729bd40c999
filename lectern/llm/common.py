"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.session import scratch_path

AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Words are runs of anything but ASCII white space (space, tab, line feed, VT, FF, carriage return).
SPACE = "[\\x20\\x09-\\x0D]+"
#: A side is broadcast up to this many rows; the sides in question hold ids, hashes or a few numbers per row.
BROADCAST_ROWS = 1_000_000


def az_lower(col: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(col, AZ, AZ.lower())


def words(col: Column) -> Column:
    """The words of a text as an array; a null text has none."""
    return F.array_remove(F.split(F.coalesce(col, F.lit("")), SPACE), "")


def written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and go on from the written copy (a lineage cut that survives
    lost executors and lets several later steps read what was computed once)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.parquet(path)


def aside(docs: DataFrame):
    """``docs`` with the columns whose names begin with an underscore, as the operators' own do, under free names; and the way back."""
    taken = {c.lower() for c in docs.columns}
    free = (n for n in (f"further column {i}" for i in range(2 * len(taken) + 1)) if n not in taken)
    names = {c: next(free) for c in docs.columns if c.startswith("_")}
    return docs.withColumnsRenamed(names), lambda df: df.withColumnsRenamed({v: k for k, v in names.items()})


def bounded(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` if its measured row count is within ``limit``, else ``df`` (a shuffle join, which AQE splits
    where a key is hot). ``df`` should be a written table, so that the count is cheap."""
    return F.broadcast(df) if df.count() <= limit else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def uniform(*cols: Column) -> Column:
    """A repeatable number in (0, 1) from the md5 of the columns' text (52 bits, so exact in a double)."""
    return (F.conv(F.substring(F.md5(F.concat_ws("|", *cols)), 1, 13), 16, 10).cast("double") + 0.5) / float(2 ** 52)


def numbered(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """Add ``name``: the row's number from 0 in the given order. Rows are ranged over tasks, numbered in each, and the
    tasks' row counts (one narrow row per task) are summed up before them; no task sees all rows."""
    from pyspark.sql import Window as W
    parts = written(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranged")
    counts = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.select("_part", (F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(W.partitionBy("_part").orderBy(*order)) - 1
    return (parts.withColumn("_in", inside).join(F.broadcast(counts), "_part")
            .withColumn(name, (F.col("_before") + F.col("_in")).cast("long")).drop("_part", "_in", "_before"))


def runs_of(frames, by: list[str]):
    """Whole groups as pandas frames from a task's stream of batches that is sorted by ``by``; only one group is held."""
    import pandas as pd
    held = []
    for f in frames:
        if not len(f):
            continue
        keys = f[by[0]] if len(by) == 1 else pd.Series(list(zip(*[f[k] for k in by])), index=f.index)
        cuts = [0, *(keys.ne(keys.shift()).to_numpy().nonzero()[0][1:]), len(f)]
        for lo, hi in zip(cuts, cuts[1:]):
            part = f.iloc[lo:hi]
            if held and [held[-1][k].iloc[-1] for k in by] != [part[k].iloc[0] for k in by]:
                yield pd.concat(held, ignore_index=True)
                held = []
            held.append(part)
    if held:
        yield pd.concat(held, ignore_index=True)


def sql_crc32(digits: str) -> str:
    """DuckDB text of the unsigned crc32 of an ASCII string."""
    step = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    values = f"list_transform(range(1, length({digits}) + 1), lambda i: ascii(substr({digits}, i, 1))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {values}), lambda c, b: {step}), 4294967295)"
