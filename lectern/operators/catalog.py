"""Catalogue cleaning and shaping (A1, R5 via ids, P3, P9, P10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import is_missing
from lectern.operators.ids import sequential_ids
from lectern.operators.joins import sized_join

# Defaults of a book's six known fields when an added book does not give them.
BOOK_DEFAULTS = {"title": "", "author": "", "description": "", "isbn": "0", "publish_year": 0, "genre": ""}
BOOK_TYPES = {"title": "string", "author": "string", "description": "string", "isbn": "string",
              "publish_year": "int", "genre": "string"}

# The twenty genres the catalogue is collected for and replies may name, in their listed order.
ALLOWED_GENRES = [
    "fiction", "science", "history", "fantasy", "mystery",
    "romance", "biography", "self-help", "cookbook", "travel",
    "children", "young adult", "horror", "philosophy", "poetry",
    "classic literature", "graphic novels", "science fiction", "adventure", "true crime",
]


def _key(c: str):
    return F.when(is_missing(c), F.lit(None)).otherwise(F.col(c))


KEYS = ("title", "author", "publish_year")


def key_columns(keys=KEYS) -> list:
    """A book's key, "nan" read as null."""
    return [_key(c) for c in keys]


def collapse_books(raw: DataFrame, pos: str = "pos", keys=KEYS, genre: str = "genre") -> DataFrame:
    """A1 without ids: one row per key (``_k0``, ``_k1``, ...) with the first row's fields, the joined genres, first_pos, n_rows."""
    other = [c for c in raw.columns if c not in (pos, genre)]
    k = raw.select("*", *[c.alias(f"_k{i}") for i, c in enumerate(key_columns(keys))])
    g_str = F.when(is_missing(genre), F.lit("nan")).otherwise(F.col(genre).cast("string"))
    grouped = k.groupBy(*[f"_k{i}" for i in range(len(keys))]).agg(
        F.min_by(F.struct(*other), F.col(pos)).alias("first"),
        F.min(pos).alias("first_pos"),
        F.count(F.lit(1)).cast("long").alias("n_rows"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), g_str.alias("g")))),
                                 lambda s: s["g"]), ", ").alias(genre),
    )
    return grouped.select(*[f"_k{i}" for i in range(len(keys))], *[F.col(f"first.{c}").alias(c) for c in other], genre, "first_pos", "n_rows")


def dedupe_books(raw: DataFrame, pos: str = "pos", keys=KEYS, genre: str = "genre") -> DataFrame:
    """A1 + R5: collapse rows with equal (title, author, year), null equal to null and "nan" read as null.

    The first row in ``pos`` order survives with all its fields; ``genre`` becomes the ", "-joined genres of
    all the group's rows in ``pos`` order (repeats kept, a missing genre reads "nan"). Survivors are numbered
    0, 1, 2, ... by first appearance. Output: book_id, the raw columns (minus ``pos``), first_pos, n_rows.
    """
    flat = collapse_books(raw, pos, keys, genre).drop(*[f"_k{i}" for i in range(len(keys))])
    return sequential_ids(flat, "first_pos", "book_id")


def book_genres(raw: DataFrame, deduped: DataFrame, pos: str = "pos", keys=("title", "author", "publish_year"),
                genre: str = "genre") -> DataFrame:
    """A1 in long form: ``(book_id, pos, genre)`` for every raw row of a surviving book.

    The joined genre string of ``dedupe_books`` is one value whose size grows with its group; this table holds
    the same information one row per raw row, so a key that repeats millions of times costs no single large row.
    """
    k = raw.select(F.col(pos).alias("pos"), F.col(genre).alias("genre"),
                   *[_key(c).alias(f"_k{i}") for i, c in enumerate(keys)])
    ids = deduped.select("book_id", *[_key(c).alias(f"_k{i}") for i, c in enumerate(keys)])
    on = [k[f"_k{i}"].eqNullSafe(ids[f"_k{i}"]) for i in range(len(keys))]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return k.join(ids, cond).select("book_id", "pos", "genre")


def fill_defaults(df: DataFrame, keep=()) -> DataFrame:
    """Exactly the six known fields, a missing or null field taking its default; other columns dropped."""
    cols = []
    for name, default in BOOK_DEFAULTS.items():
        if name in df.columns:
            cols.append(F.coalesce(F.col(name).try_cast(BOOK_TYPES[name]), F.lit(default).cast(BOOK_TYPES[name])).alias(name))
        else:
            cols.append(F.lit(default).cast(BOOK_TYPES[name]).alias(name))
    return df.select(*keep, *cols)


def listing(books: DataFrame) -> DataFrame:
    """``{id, **book}`` for every book."""
    return books.select(F.col("book_id").alias("id"), "title", "author", "description", "isbn", "publish_year", "genre")


def genre_dimension(books: DataFrame, genre: str = "genre") -> DataFrame:
    """S6 derived from data: distinct genres numbered 0.. in alphabetical order."""
    distinct = books.select(F.col(genre).alias("genre")).where(F.col("genre").isNotNull()).distinct()
    coded = sequential_ids(distinct, "genre", "encoding_index")
    n = coded.select(F.count(F.lit(1))).scalar()
    return coded.select("genre", F.col("encoding_index").cast("int").alias("encoding_index"), n.cast("int").alias("n_genres"))


def genre_codes(books: DataFrame, dim: DataFrame, genre: str = "genre", id_col: str = "book_id") -> DataFrame:
    """P10: code and one-hot vector of each book's genre via a size-checked broadcast join of the dimension."""
    n = dim.select(F.max("n_genres")).scalar()
    coded = sized_join(books.select(id_col, F.col(genre).alias("genre")), dim.select("genre", "encoding_index"),
                       ["genre"], "left").withColumn("_n", n)
    return coded.select(
        id_col, "genre", "encoding_index",
        F.transform(F.sequence(F.lit(0), F.col("_n") - 1),
                    lambda i: F.when(i == F.col("encoding_index"), 1).otherwise(0)).alias("one_hot"))
