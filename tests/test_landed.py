"""Landed files with broken records: every record is a row or a reject."""

import pytest

from conftest import rows
from lectern.session import scratch_path
from lectern.sources import landed

CASES = {
    "changes": (landed.landed_changes, {
        '{"action": "add_book", "book_data": [{"title": "Fjord Pilot"}], "seq": 1}': None, '{"action": "delete_book", "book_ids": ["3"]}': None,
        '{"action": "view_books"}': None, '{"action": "delete_book", "book_ids": null}': None, '{"action": "add_b': "no json", "plain": "no json", '[1, 2]': "no object",
        '{"book_ids": ["4"]}': "no action", '{"action": 7}': "no action", '{"action": "delete_book", "book_ids": "4"}': "no list", "": None, "  ": None}),
    "searches": (landed.landed_searches, {
        '{"action": "search", "user_query": ["tides"]}': None, '{"action": "search", "user_query": []}': "no query", '{"action": "search"}': "no query",
        '{"action": "search", "user_query": "tides"}': "no query", '{"action": "view_books"}': "no search", "{}": "no search", "x": "no json", '"search"': "no object"}),
    "responses": (landed.landed_responses, {
        '{"q": "sea", "docs": [{"title": "Reef"}, {"title": "Quay"}]}': None, '{"q": "ice", "docs": []}': None, '{"q": "sea"}': "no docs",
        '{"q": "sea", "docs": {"title": "Reef"}}': "no docs", '{"q": "sea", "docs": [{"ti': "no json", "3": "no object"}),
    "timings": (landed.landed_timings, {"4, 2.5": None, "8, 1": None, "junk": "no two numbers", "a, 1.5": "no two numbers", "3,": "no two numbers", "": None}),
}
N_ROWS = {"changes": 4, "searches": 1, "responses": 2, "timings": 2}


@pytest.mark.parametrize("name", CASES)
def test_every_line_is_a_row_or_a_reject(spark, name):
    read, lines = CASES[name]
    path = scratch_path(spark, "landed-lines")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    out = read(spark, path)
    bad = {x: why for x, why in lines.items() if why}
    got = out.rejected.collect()
    assert {r.raw: r.reason for r in got} == bad and len(got) == len(bad) and {r.reader for r in got} == {name}
    assert {r.raw: r.record for r in got} == {x: k for k, x in enumerate(lines) if x in bad}
    assert all(r.file.endswith(".txt") and r.split == 0 for r in got)
    assert out.rows.count() == N_ROWS[name]
    n = {r.reason: r.n for r in out.counts.collect()}
    assert n.pop("read") == sum(1 for x, why in lines.items() if x.strip() and not why)
    assert n == {w: list(bad.values()).count(w) for w in bad.values()}


def test_records_of_a_split_file(spark):
    """A file read in parts: a part's first byte and the number in it name one record each."""
    path = scratch_path(spark, "landed-split")
    lines = [f"{i}, {i}.5" if i % 7 else f"broken {i}" for i in range(3000)]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        out = landed.landed_timings(spark, path)
        got = out.rejected.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    assert sorted(r.raw for r in got) == sorted(x for x in lines if x.startswith("broken")) and out.rows.count() + len(got) == 3000
    by = sorted(got, key=lambda r: (r.split, r.record))
    assert len({r.split for r in got}) > 5 and [r.raw for r in by] == [x for x in lines if x.startswith("broken")]
    assert len({(r.file, r.split, r.record) for r in got}) == len(got)


def test_catalogue_records(spark):
    path = scratch_path(spark, "landed-csv")
    text = ['title,author,publish_year,isbn,key,genre,description', 'Reef,Tamihana,1901,i1,k1,chart,"two\nlines, ""quoted"""',
            'short,record', 'Quay,Okafor,N/A,i2,k2,list,plain', 'too,many,1,2,3,4,5,6,7', 'Ice,,1955,i3,k3,chart,x']
    spark.createDataFrame([("\n".join(text),)], "value string").coalesce(1).write.text(path)
    out = landed.landed_catalogue(spark, path)
    assert {(r.title, r.author) for r in out.rows.collect()} == {("Reef", "Tamihana"), ("Quay", "Okafor"), ("Ice", None)}
    assert {r.title: r.description for r in out.rows.collect()}["Reef"] == 'two\nlines, "quoted"'
    assert sorted((r.record, r.reason, r.raw.strip()) for r in out.rejected.collect()) == [(1, "malformed record", text[2]), (3, "malformed record", text[4])]
    assert rows(out.counts) == [("catalogue", "malformed record", 2), ("catalogue", "read", 3)]


def test_nothing_landed(spark):
    none = scratch_path(spark, "nothing")
    for read in (landed.landed_changes, landed.landed_searches, landed.landed_responses, landed.landed_timings, landed.landed_catalogue):
        out = read(spark, none)
        assert out.rows.count() == out.rejected.count() == out.counts.count() == 0
