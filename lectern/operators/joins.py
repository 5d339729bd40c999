"""Join strategies with an explicit size rule.

A side is broadcast only after its row count has been measured and found under a bound; otherwise the join is
a shuffle join in which every key of the large side is spread over ``salt`` tasks, so a key that holds a third
of all rows is still split evenly (the small side is replicated ``salt`` times, once per slice).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows a broadcast side may hold. Sides in this library that are broadcast are narrow (ids, a token, a vector),
# so this keeps a broadcast well under the default 8 GB hard limit and typically under a few hundred MB.
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
DEFAULT_MAX_BROADCAST_BYTES = 512 * 1024 * 1024
DEFAULT_SALT = 32
# Bytes of strings dealt to a task whose rows repeat them: well under the 1 MB that a Parquet column's dictionary may take.
DEALT_BYTES = 256 * 1024


def measured_rows(df: DataFrame) -> int:
    """Row count of a side that is meant to be small (one cheap job over that side only)."""
    return df.count()


def broadcast_vectors_if_bounded(df: DataFrame, vec_col: str, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                                 max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> tuple[DataFrame, bool, int, int]:
    """Like ``broadcast_if_bounded`` for a side that carries a vector: rows and the longest vector are measured
    in one job, and the side is broadcast only if ``rows * (8 * longest + 64)`` bytes also fit ``max_bytes``. The longest
    length is given back last."""
    n, longest = df.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size(vec_col)), F.lit(0))).first()
    if n <= max_rows and n * (8 * max(longest, 0) + 64) <= max_bytes:
        return F.broadcast(df), True, n, max(longest, 0)
    return df, False, n, max(longest, 0)


def broadcast_if_bounded(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                         rows: int | None = None) -> tuple[DataFrame, bool, int]:
    """Return ``(df or broadcast(df), broadcast?, rows)`` after measuring the row count."""
    n = measured_rows(df) if rows is None else rows
    if n <= max_rows:
        return F.broadcast(df), True, n
    return df, False, n


def salted_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner",
                salt: int = DEFAULT_SALT, salt_cols: list[str] | None = None) -> DataFrame:
    """Shuffle join that splits every key of ``big`` over ``salt`` tasks.

    ``salt_cols`` (columns of ``big``) choose the slice of a row; by default all of ``big``'s columns.
    Works for inner, left-semi and left-anti joins with ``big`` on the left.
    """
    cols = salt_cols or big.columns
    b = big.withColumn("_slice", F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(salt)))
    s = small.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(salt - 1)).cast("array<bigint>")))
    return b.join(s, on + ["_slice"], how).drop("_slice")


def sized_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner",
               max_rows: int = DEFAULT_MAX_BROADCAST_ROWS, salt: int = DEFAULT_SALT,
               small_rows: int | None = None) -> DataFrame:
    """Broadcast ``small`` when its measured size allows, else a salted shuffle join."""
    s, is_b, _ = broadcast_if_bounded(small, max_rows, small_rows)
    if is_b:
        return big.join(s, on, how)
    return salted_join(big, small, on, how, salt)


def tasks_for(df: DataFrame, shown: Column, least: int) -> int:
    """As many tasks as leave about ``DEALT_BYTES`` of ``shown`` to each, ``least`` at least. ``df`` should be a written table."""
    return max(least, df.agg(F.ceil(F.sum(F.octet_length(shown).cast("long")) / DEALT_BYTES)).first()[0] or 0)


def all_pairs(many: DataFrame, few: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS, tasks: int = 8, shown: Column | None = None) -> DataFrame:
    """Every row of ``many`` beside every row of ``few``, without a shuffle of pairs: ``many`` is dealt over ``tasks`` tasks a core, and
    ``few`` is broadcast where its measured size allows; else Spark pairs the partitions of both. Memory does not grow with the pairs.
    ``shown``: a string column of ``many`` that the result keeps. It stands in as many pairs as ``few`` has rows, and a written file holds each
    string once only while its dictionary lasts, so a task gets no more than that."""
    f, _, _ = broadcast_if_bounded(few, max_rows)
    n = tasks * many.sparkSession.sparkContext.defaultParallelism
    return many.repartition(n if shown is None else tasks_for(many, shown, n)).crossJoin(f)
