from conftest import rows
from lectern.operators.catalog import dedupe_books, fill_defaults
from lectern.operators.ids import next_ids, sequential_ids


def test_dedupe_edge_rows(spark):
    raw = spark.createDataFrame([
        (0, "Dune", "Herbert", 1965, "fiction", "i0"),
        (1, "Dune", "Herbert", 1965, "science fiction", "i1"),
        (2, "Emma", "Austen", None, "classic literature", "i2"),
        (3, "Dune", "Herbert", 1965, "fiction", "i3"),
        (4, "Emma", "Austen", None, None, "i4"),
        (5, "Dune", "Someone", 1965, "fiction", "i5"),
    ], "pos long, title string, author string, publish_year int, genre string, isbn string")
    got = rows(dedupe_books(raw), "book_id", "title", "author", "publish_year", "genre", "isbn", "n_rows")
    assert got == [(0, "Dune", "Herbert", 1965, "fiction, science fiction, fiction", "i0", 3),
                   (1, "Emma", "Austen", None, "classic literature, nan", "i2", 2),
                   (2, "Dune", "Someone", 1965, "fiction", "i5", 1)]


def test_sequential_ids_over_tasks(spark):
    df = spark.createDataFrame([(p,) for p in [3, 17, 4, 100, 101, 5, 64]], "pos long")
    got = rows(sequential_ids(df.repartition(3), "pos", "id"), "pos", "id")
    assert got == [(3, 0), (4, 1), (5, 2), (17, 3), (64, 4), (100, 5), (101, 6)]


def test_next_ids_continue_after_max(spark):
    existing = spark.createDataFrame([(0,), (1,), (2,)], "book_id long").where("book_id <> 0")
    new = spark.createDataFrame([(10,), (11,)], "ord long")
    assert rows(next_ids(new, existing, "ord"), "ord", "book_id") == [(10, 3), (11, 4)]


def test_fill_defaults(spark):
    df = spark.createDataFrame([("T", None, "x")], "title string, publish_year int, unknown string")
    got = fill_defaults(df).first().asDict()
    assert got == {"title": "T", "author": "", "description": "", "isbn": "0", "publish_year": 0, "genre": ""}


def test_book_genres_long_form(spark):
    from lectern.operators.catalog import book_genres
    raw = spark.createDataFrame([(0, "A", "x", None, "g1"), (1, "A", "x", None, "g2"), (2, "B", "y", 1, "g3")],
                                "pos long, title string, author string, publish_year int, genre string")
    d = dedupe_books(raw)
    assert rows(book_genres(raw, d)) == [(0, 0, "g1"), (0, 1, "g2"), (1, 2, "g3")]
