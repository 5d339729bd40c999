import numpy as np
from pyspark.sql import functions as F

from conftest import rows
from lectern.functions.text import words
from lectern.operators.embed import embed_with, hashed_vectors
from lectern.plans.index_build import build_index
from lectern.session import scratch_path
from lectern.sources.readers import read_catalogue_csv, read_genre_mapping, read_timing_log
from lectern.sources.writers import export_listing, load_or_build


def _books(spark):
    return spark.createDataFrame(
        [(0, "A", "x", "multi\nline, with \"quotes\"", "1", 2000, "g"), (1, "B", None, None, None, None, "h")],
        "book_id long, title string, author string, description string, isbn string, publish_year int, genre string")


def test_genre_mapping_reader(spark):
    path = scratch_path(spark, "genres")
    spark.createDataFrame([("genre_adventure", 0), ("genre_young adult", 19)], "genre string, encoding_index int") \
        .coalesce(1).write.option("header", True).csv(path)
    assert rows(read_genre_mapping(spark, path)) == [("adventure", 0), ("young adult", 19)]


def test_export_listing_round_trip(spark):
    path = scratch_path(spark, "listing")
    export_listing(_books(spark), path)
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    assert back.columns == ["id", "title", "author", "description", "isbn", "publish_year", "genre"]
    assert sorted(r["description"] or "" for r in back.collect()) == ["", 'multi\nline, with "quotes"']


def test_csv_keeps_outer_blanks_and_line_breaks(spark):
    from lectern.sources.writers import write_csv
    text = ["  lead", "trail  ", "a\nb\n", "\n", 'q"uote', "x,y"]
    path = scratch_path(spark, "blank-csv")
    write_csv(spark.createDataFrame([(t, str(k)) for k, t in enumerate(text)], "title string, key string")
              .selectExpr("title", "'a' AS author", "'1' AS publish_year", "'i' AS isbn", "key", "'g' AS genre", "'d' AS description"), path)
    got = {r["key"]: r["title"] for r in read_catalogue_csv(spark, path).collect()}
    assert got == {str(k): t for k, t in enumerate(text)}


def test_details_one_per_key_and_malformed_ones(spark):
    from lectern.sources.readers import enrich_descriptions
    books = spark.createDataFrame([("A", "k1"), ("B", "k1"), ("C", "k2"), ("D", "N/A"), ("E", "k3"), ("F", None)], "title string, key string")
    details = spark.createDataFrame([("k1", '{"description": "one"}'), ("k1", '{"description": "one"}'), ("k2", '{"description": {"value": "two"}}'),
                                     ("k3", '{"descr'), ("N/A", '{"description": "none"}'), (None, '{"description": "x"}')], "key string, json string")
    got = rows(enrich_descriptions(books, details), "title", "description")
    assert got == [("A", "one"), ("B", "one"), ("C", "two"), ("D", "N/A"), ("E", "N/A"), ("F", "N/A")]


def test_missing_catalogue_is_empty(spark):
    assert read_catalogue_csv(spark, scratch_path(spark, "absent")).count() == 0


def test_timing_log_reader(spark):
    path = scratch_path(spark, "log")
    spark.createDataFrame([("1, 5.5",), ("16, 3.25",), ("",), ("junk",), ("a, b",), ("2, x",)], "value string").coalesce(1).write.text(path)
    assert rows(read_timing_log(spark, path)) == [(1, 5.5), (16, 3.25)]


def test_load_or_build_builds_once(spark):
    path = scratch_path(spark, "lob")
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)
    load_or_build(spark, path, build)
    assert load_or_build(spark, path, build).count() == 3 and len(calls) == 1


def test_caller_model_and_truncation(spark):
    def make_model():
        return lambda texts: np.array([[len(t), t.count("a") + 1.0] for t in texts])
    got = {r["book_id"]: r["embedding"] for r in embed_with(_books(spark), make_model).collect()}
    assert all(abs(sum(x * x for x in v) - 1) < 1e-9 for v in got.values())
    long = spark.createDataFrame([(0, " ".join(f"zq{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(600)), "", "")],
                                 "book_id long, title string, author string, description string")
    text = long.first()["title"].split(" ")
    # "title", the 509 first words: 510 tokens of the composed text
    short = spark.createDataFrame([(0, " ".join(text[:509]))], "book_id long, title string")
    cut = hashed_vectors(long, dim=16, max_tokens=510).first()["embedding"]
    want = hashed_vectors(short, text=F.concat(F.lit("Title: "), F.col("title")), dim=16).first()["embedding"]
    assert np.allclose(cut, want) and not np.allclose(cut, hashed_vectors(long, dim=16).first()["embedding"])


def test_accent_stripping_is_optional(spark):
    df = spark.createDataFrame([("Crème Brûlée Ñandú",)], "t string")
    assert df.select(words("t")).first()[0] == ["crème", "brûlée", "ñandú"]
    assert df.select(words("t", accents=False)).first()[0] == ["creme", "brulee", "nandu"]


def test_build_index_writes_consistent_tables(spark):
    out = build_index(spark, _books(spark), scratch_path(spark, "index"), dim=8)
    assert out["books"].count() == 2 and out["vectors"].count() == 2
    assert rows(out["vocabulary"].select("token")) == rows(out["postings"].select("token").distinct())
