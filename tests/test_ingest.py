"""Further ingests into a numbered catalogue."""

import random

from conftest import rows
from lectern.operators.catalog import dedupe_books
from lectern.operators.ingest import first_key_map, ingest

RAW = "pos long, title string, author string, publish_year int, genre string, isbn string"
COLS = ["book_id", "title", "author", "publish_year", "genre", "isbn", "first_pos", "n_rows"]


def landed(spark, n, seed):
    rng = random.Random(seed)
    return [(p, rng.choice(["Dune", "Emma", "nan", None, "It"]), rng.choice(["A", "B", None]), rng.choice([1, None]),
             rng.choice(["fiction", "history", None]), f"i{p}") for p in range(n)]


def test_parts_equal_one_ingest(spark):
    raw = landed(spark, 120, 1)
    want = rows(dedupe_books(spark.createDataFrame(raw, RAW)), *COLS)
    for cuts in ([0, 1, 2, 60, 120], [0, 40, 40, 120]):
        parts = [spark.createDataFrame(raw[a:b], RAW) for a, b in zip(cuts, cuts[1:])]
        books = dedupe_books(parts[0])
        known = first_key_map(books)
        for part in parts[1:]:
            got = ingest(books, known, part)
            books, known = got.books, got.key_map
        assert rows(books, *COLS) == want
        keys = ["book_id", "key_0", "key_1", "key_2"]
        assert rows(known, *keys) == rows(first_key_map(dedupe_books(spark.createDataFrame(raw, RAW))), *keys)


def test_edited_deleted_and_hot_keys(spark):
    books = dedupe_books(spark.createDataFrame(
        [(0, "Dune", "H", 1, "fiction", "i0"), (1, "Emma", "A", None, None, "i1"), (2, "It", "K", 2, "horror", "i2")], RAW))
    known = first_key_map(books)
    # Book 0 got another title, book 1 was deleted, id 7 was issued and deleted since.
    books = books.replace({"Dune": "Dune (2nd)"}, subset=["title"]).where("book_id <> 1")
    more = [(10 + i, "It", "K", 2, "fiction", f"j{i}") for i in range(200)]
    more += [(300, "Dune", "H", 1, "travel", "k"), (301, "nan", None, None, "x", "new"), (302, "Emma", "A", None, "poetry", "back"),
             (303, "Dune (2nd)", "H", 1, "y", "other")]
    got = ingest(books, known, spark.createDataFrame(more, RAW), id_floor=7)
    by = {r["book_id"]: r for r in got.books.collect()}
    assert set(by) == {0, 1, 2, 8, 9} and got.books.count() == 5
    assert (by[0].title, by[0].genre, by[0].isbn, by[0].n_rows) == ("Dune (2nd)", "fiction, travel", "i0", 2)
    assert (by[1].title, by[1].genre, by[1].isbn, by[1].n_rows) == ("Emma", "poetry", "back", 1)
    assert (by[2].n_rows, by[2].genre) == (201, ", ".join(["horror"] + ["fiction"] * 200))
    assert (by[8].isbn, by[9].title) == ("new", "Dune (2nd)") and got.changed.count() == 5
    assert rows(got.key_map, "book_id") == [(0,), (1,), (2,), (8,), (9,)]


def test_empty_ingests(spark):
    none = spark.createDataFrame([], RAW)
    books = dedupe_books(spark.createDataFrame(landed(spark, 5, 2), RAW))
    got = ingest(books, first_key_map(books), none)
    assert rows(got.books, *COLS) == rows(books, *COLS) and got.changed.count() == 0
    start = dedupe_books(none)
    assert rows(ingest(start, first_key_map(start), spark.createDataFrame(landed(spark, 5, 2), RAW)).books, *COLS) == rows(books, *COLS)
