"""Versioned, bucketed catalogue tables on shared storage (K6, D15: a batch publishes a new version whole, and writes what it changes).

Layout under ``root``: a table's rows lie in hash buckets of its key (``KEYS``), ``<table>/v=N/bucket=B``; rows of one token in the postings are
spread over slices by book besides, so a token that is in every book fills no single bucket. A version's manifest,
``_manifests/version=N``, names for each bucket the version that wrote it. A change batch writes the buckets that it touches and takes
the others over from the version before, files and all (copy-on-write). Tables without a key (``rejected``, ``issued``) hold what one
version adds, ``<table>/v=N``.

The commit log ``_commits`` has a row per published version: its number, the highest book id ever issued, the tables it has, and the
stream and batch it came from. A version counts only once its commit row exists, so a batch that fails half-way is
invisible; the next attempt overwrites its folders.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

COMMIT = "version long, max_id long, tables array<string>, stream string, batch_id long"
#: One row per bucket; the row with bucket -1 has the table's layout.
MANIFEST = "name string, bucket int, written long, buckets int, slices int, schema string"
KEYS = {"books": "book_id", "vectors": "book_id", "postings": "token", "surface_postings": "token", "vocabulary": "token",
        "surface_vocabulary": "token", "lemmas": "token"}
SLICED = {"postings": "book_id", "surface_postings": "book_id"}
#: Buckets grow with the catalogue up to a number that a manifest still lists quickly.
BOOKS_PER_BUCKET, MAX_BUCKETS, SLICES = 50_000, 4_096, 8


@dataclass
class Layout:
    buckets: int
    slices: int
    schema: StructType
    where: dict[int, int] = field(default_factory=dict)  # bucket -> the version that wrote it

    def bucket(self, name: str) -> Column:
        return bucket_of(name, self.buckets, self.slices)

    def of_keys(self, keys: DataFrame, name: str) -> list[int]:
        """The buckets that hold the keys in ``keys`` (the key column, and the slice column if that is known), at most all of them."""
        key, by = KEYS[name], SLICED.get(name)
        if by is None or by in keys.columns:
            return [r[0] for r in keys.select(self.bucket(name).alias("b")).distinct().collect()]
        firsts = [r[0] for r in keys.select(F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")).distinct().collect()]
        return [x * self.slices + s for x in firsts for s in range(self.slices)]


def bucket_of(name: str, buckets: int, slices: int) -> Column:
    first = F.pmod(F.xxhash64(KEYS[name]), F.lit(buckets))
    by = SLICED.get(name)
    return (first if by is None else first * slices + F.pmod(F.xxhash64(by), F.lit(slices))).cast("int")


def buckets_for(n_books: int) -> int:
    return max(1, min(MAX_BUCKETS, -(-n_books // BOOKS_PER_BUCKET)))


def _table(root: str, name: str, version: int | None = None) -> str:
    return f"{root.rstrip('/')}/{name}" + ("" if version is None else f"/v={version}")


class VersionWriter:
    """The tables of one version in the making; ``commit`` publishes them together."""

    def __init__(self, spark: SparkSession, root: str, version: int, buckets: int = 1, prev: int | None = None):
        self.spark, self.root, self.version, self.buckets = spark, root, version, buckets
        self.tables: dict[str, Layout] = {} if prev is None else manifest(spark, root, prev)

    def _write(self, name: str, df: DataFrame, at: Layout) -> None:
        """Write ``df``'s buckets and note which ones there are."""
        path = _table(self.root, name, self.version)
        rows = df.select([f.name for f in at.schema]).withColumn("bucket", at.bucket(name)).hint("rebalance", "bucket")
        rows.write.mode("overwrite").partitionBy("bucket").parquet(path)
        full = StructType(list(at.schema.fields)).add("bucket", IntegerType())
        for f in self.spark.read.schema(full).parquet(path).inputFiles():
            at.where[int(f.rsplit("/bucket=", 1)[1].split("/")[0])] = self.version

    def whole(self, name: str, df: DataFrame) -> DataFrame:
        """Write a table from scratch; gives it back as written."""
        at = self.tables[name] = Layout(self.buckets, SLICES if name in SLICED and self.buckets > 1 else 1, df.schema)
        self._write(name, df, at)
        return self.read(name)

    def replace(self, name: str, buckets: list[int], df: DataFrame) -> DataFrame:
        """Write ``buckets`` anew with the rows of ``df``, which all belong there; the other buckets keep their files."""
        at = self.tables[name]
        for b in buckets:
            at.where.pop(b, None)
        if buckets:
            self._write(name, df, at)
        return self.read(name)

    def read(self, name: str, buckets: list[int] | None = None) -> DataFrame:
        return _read(self.spark, self.root, name, self.tables[name], buckets)

    def log(self, name: str, df: DataFrame) -> None:
        """What this version adds to a table without a key."""
        df.write.mode("overwrite").parquet(_table(self.root, name, self.version))

    def commit(self, max_id: int | None = None, stream: str | None = None, batch_id: int | None = None) -> None:
        """Write the manifest, then the commit row; ``max_id`` is the highest book id ever issued so far."""
        rows = [(n, -1, None, at.buckets, at.slices, at.schema.json()) for n, at in self.tables.items()]
        rows += [(n, b, v, None, None, None) for n, at in self.tables.items() for b, v in sorted(at.where.items())]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.root.rstrip('/')}/_manifests/version={self.version}")
        row = [(int(self.version), None if max_id is None else int(max_id), list(self.tables), stream, batch_id)]
        self.spark.createDataFrame(row, COMMIT).write.mode("append").parquet(f"{self.root.rstrip('/')}/_commits")


def manifest(spark: SparkSession, root: str, version: int) -> dict[str, Layout]:
    """The layout of each table of a committed version (a row per bucket, ``MAX_BUCKETS`` times a few at most)."""
    rows = spark.read.schema(MANIFEST).parquet(f"{root.rstrip('/')}/_manifests/version={version}").collect()
    out = {r["name"]: Layout(r["buckets"], r["slices"], StructType.fromJson(json.loads(r["schema"]))) for r in rows if r["bucket"] < 0}
    for r in rows:
        if r["bucket"] >= 0:
            out[r["name"]].where[r["bucket"]] = r["written"]
    return out


def _read(spark: SparkSession, root: str, name: str, at: Layout, buckets: list[int] | None = None) -> DataFrame:
    base, cols = _table(root, name), [f.name for f in at.schema]
    paths = [f"{base}/v={v}/bucket={b}" for b, v in sorted(at.where.items()) if buckets is None or b in set(buckets)]
    if not paths:
        return spark.createDataFrame([], at.schema)
    full = StructType(list(at.schema.fields)).add("v", LongType()).add("bucket", IntegerType())
    return spark.read.schema(full).option("basePath", base).parquet(*paths).select(cols)


def commits(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(COMMIT).parquet(f"{root.rstrip('/')}/_commits")
    except AnalysisException:
        return None


def issued_ids_floor(spark: SparkSession, root: str) -> int | None:
    """Highest book id recorded by the committed versions (so deleted ids are never issued again)."""
    log = commits(spark, root)
    return None if log is None else log.agg(F.max("max_id")).first()[0]


def latest_version(spark: SparkSession, root: str) -> int | None:
    """Largest committed version; None when nothing is committed."""
    log = commits(spark, root)
    return None if log is None else log.agg(F.max("version")).first()[0]


def version_tables(spark: SparkSession, root: str, version: int) -> list[str]:
    """The tables a committed version has."""
    row = commits(spark, root).where(F.col("version") == version).select("tables").first()
    return list(row[0] or []) if row else []


def batch_is_committed(spark: SparkSession, root: str, stream: str, batch_id: int) -> bool:
    log = commits(spark, root)
    return log is not None and not log.where((F.col("stream") == stream) & (F.col("batch_id") == batch_id)).isEmpty()


def read_version(spark: SparkSession, root: str, name: str, version: int, keys: DataFrame | None = None) -> DataFrame:
    """A table as of a committed version. With ``keys`` (a column named as the table's key), only the buckets that can hold those keys are
    read, so that the tokens of a few queries do not scan the postings of all others (J1)."""
    if name not in KEYS:
        return spark.read.parquet(_table(root, name, version))
    at = manifest(spark, root, version)[name]
    return _read(spark, root, name, at, None if keys is None else at.of_keys(keys, name))
