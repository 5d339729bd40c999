"""Further ingests into a numbered catalogue (A1, R5, R6, D3): ids are given once and stay.

A key map ``(key_0, key_1, ..., book_id)`` remembers under which id each (title, author, year) was first taken in. It is kept
beside the catalogue and outlives edits and deletions of the books: an edited book still receives the genres of further
rows of its first key, and a deleted book whose key is landed again comes back under its own id.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.operators.catalog import KEYS, collapse_books, key_columns
from lectern.operators.ids import sequential_ids
from lectern.operators.joins import sized_join
from lectern.session import materialize


@dataclass
class Ingest:
    """The catalogue and key map after an ingest; ``changed`` holds the rows of ``books`` that it brought or altered."""

    books: DataFrame
    key_map: DataFrame
    changed: DataFrame


def _names(keys) -> list[str]:
    return [f"key_{i}" for i in range(len(keys))]


def first_key_map(books: DataFrame, keys=KEYS) -> DataFrame:
    """The key map of a freshly collapsed catalogue (``dedupe_books``)."""
    return books.select(*[c.alias(n) for c, n in zip(key_columns(keys), _names(keys))], "book_id")


def ingest(books: DataFrame, key_map: DataFrame, raw: DataFrame, pos: str = "pos", keys=KEYS, genre: str = "genre", id_floor: int = -1) -> Ingest:
    """Take the landed rows ``raw`` into ``books`` (the columns of ``dedupe_books``).

    ``raw`` is collapsed by itself first. A key that the map knows keeps its book, whose genres are appended (", ", in
    ``pos`` order) and whose rows are counted on; the book's other fields stay. New keys get the next ids in order of their
    first row, above every id in the catalogue, in the map and ``id_floor`` (the highest id ever issued elsewhere). Two
    ingests in ``pos`` order thus equal one of both. Null keys equal null; repeated rows count; an empty ``raw`` changes
    nothing. Each key is one row when the tables meet, so a key with a third of all rows is no hot key in any join.
    """
    columns, names = books.columns, _names(keys)
    fresh = collapse_books(raw, pos, keys, genre)
    same = reduce(lambda a, b: a & b, [F.col(f"_k{i}").eqNullSafe(F.col(n)) for i, n in enumerate(names)])
    found = materialize(fresh.join(key_map.withColumnRenamed("book_id", "_id"), same, "left").drop(*names), "ingest")
    known, new = found.where("_id is not null"), found.where("_id is null").drop("_id")
    tops = books.select(F.max("book_id").alias("m")).unionByName(key_map.select(F.max("book_id").alias("m")))
    top = tops.agg(F.coalesce(F.max("m"), F.lit(-1))).first()[0]  # one number
    new = materialize(sequential_ids(new, "first_pos", "book_id", start=max(top, id_floor) + 1), "ingest-new")

    more = known.select(F.col("_id").alias("book_id"), F.col(genre).alias("_genre"), F.col("n_rows").alias("_rows"),
                        F.struct(*[c for c in columns if c != "book_id"]).alias("_first"))
    at = more.join(books.withColumn("_here", F.lit(True)), "book_id", "left")
    gone = F.col("_here").isNull()
    altered = at.select(*[
        F.col("book_id") if c == "book_id"
        else F.when(gone, F.col(f"_first.{c}")).otherwise(F.concat_ws(", ", c, "_genre")).alias(c) if c == genre
        else F.when(gone, F.col("_rows")).otherwise(F.coalesce("n_rows", F.lit(0)) + F.col("_rows")).alias(c) if c == "n_rows"
        else F.when(gone, F.col(f"_first.{c}")).otherwise(F.col(c)).alias(c) for c in columns])
    changed = materialize(altered.unionByName(new.select(*columns)), "ingest-changed")
    stay = sized_join(books, changed.select("book_id"), ["book_id"], "left_anti")
    grown = key_map.unionByName(new.select(*[F.col(f"_k{i}").alias(n) for i, n in enumerate(names)], "book_id"))
    return Ingest(stay.select(*columns).unionByName(changed), grown, changed)
