"""Checked queries for catalogue cleaning, shaping, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions.text import compose_text, first_line
from lectern.operators.catalog import dedupe_books, fill_defaults, genre_codes, genre_dimension, listing
from lectern.operators.ingest import first_key_map, ingest
from lectern.operators.postings import build_postings
from lectern.plans import sqltext as q
from lectern.plans.registry import register
from lectern.plans.standins import SQL_BOOKS, SQL_RAW_CATALOGUE, books_from_documents, raw_catalogue_from_part, table
from lectern.schemas import RAW_CATALOGUE
from lectern.session import materialize, scratch_path
from lectern.sources.landed import all_counts, landed_catalogue, landed_changes, landed_responses, landed_searches, landed_timings
from lectern.sources.readers import (books_from_search_responses, enrich_descriptions, read_catalogue_csv,
                                     union_ingests)
from lectern.sources.writers import load_or_build, write_csv


def _missing(x):
    return f"({x} IS NULL OR CAST({x} AS VARCHAR) = 'nan')"


SQL_DEDUPE = f"""
WITH raw AS ({SQL_RAW_CATALOGUE}),
k AS (SELECT *, CASE WHEN {_missing('title')} THEN NULL ELSE title END AS k0,
                CASE WHEN {_missing('author')} THEN NULL ELSE author END AS k1,
                CASE WHEN {_missing('publish_year')} THEN NULL ELSE publish_year END AS k2 FROM raw),
g AS (SELECT k0, k1, k2, min(pos) AS first_pos, CAST(count(*) AS BIGINT) AS n_rows,
             string_agg(CASE WHEN {_missing('genre')} THEN 'nan' ELSE genre END, ', ' ORDER BY pos) AS genre
      FROM k GROUP BY k0, k1, k2),
dd AS (SELECT CAST(row_number() OVER (ORDER BY g.first_pos) - 1 AS BIGINT) AS book_id, r.title, r.author,
              r.publish_year, r.isbn, r.description, g.genre, g.first_pos, g.n_rows
       FROM g JOIN raw r ON r.pos = g.first_pos)"""


def _deduped(spark, sf):
    return dedupe_books(raw_catalogue_from_part(table(spark, sf, "part")))


# Nullable integers are shown as text in checked outputs so both engines hand over the same values.
@register("dedupe_catalog", sql=SQL_DEDUPE + """
SELECT book_id, title, author, CAST(publish_year AS VARCHAR) AS publish_year, isbn, description, genre,
       first_pos, n_rows FROM dd""")
def q_dedupe_catalog(spark, sf):
    """A1 + R5 + S2: collapse duplicate (title, author, year) rows, join genres in file order, number survivors."""
    return _deduped(spark, sf).withColumn("publish_year", F.col("publish_year").cast("string"))


INGESTS = 3


# The same rows landed at once: later ingests keep the ids and go on with them.
@register("repeated_ingest", sql=SQL_DEDUPE + """
SELECT book_id, title, author, CAST(publish_year AS VARCHAR) AS publish_year, isbn, description, genre,
       first_pos, n_rows FROM dd""")
def q_repeated_ingest(spark, sf):
    """A1 + R5 + R6 + D3: the raw catalogue landed in ``INGESTS`` parts by position, each taken into the numbered one."""
    raw = raw_catalogue_from_part(table(spark, sf, "part"))
    lo, hi = raw.agg(F.coalesce(F.min("pos"), F.lit(0)), F.coalesce(F.max("pos"), F.lit(0))).first()
    span = (hi - lo) // INGESTS + 1
    books = dedupe_books(raw.where(F.col("pos") < lo + span))
    known = first_key_map(books)
    for i in range(1, INGESTS):
        got = ingest(books, known, raw.where((F.col("pos") >= lo + i * span) & (F.col("pos") < lo + (i + 1) * span)))
        books, known = materialize(got.books, "catalogue"), materialize(got.key_map, "key-map")
    return books.withColumn("publish_year", F.col("publish_year").cast("string"))


@register("listing", sql=SQL_DEDUPE + """
SELECT book_id AS id, title, author, description, isbn, CAST(publish_year AS VARCHAR) AS publish_year, genre
FROM dd""")
def q_listing(spark, sf):
    """The catalogue listing ``{id, **book}`` of the cleaned catalogue."""
    return listing(_deduped(spark, sf)).withColumn("publish_year", F.col("publish_year").cast("string"))


@register("compose_text", sql=f"""
WITH raw AS ({SQL_RAW_CATALOGUE}) SELECT pos, {q.compose()} AS text FROM raw""")
def q_compose_text(spark, sf):
    """P1 + P2: the indexed text of each raw catalogue row."""
    raw = raw_catalogue_from_part(table(spark, sf, "part"))
    return raw.select("pos", compose_text().alias("text"))


@register("fill_defaults", sql=f"""
WITH raw AS ({SQL_RAW_CATALOGUE})
SELECT pos, coalesce(title, '') AS title, coalesce(author, '') AS author, coalesce(description, '') AS description,
       coalesce(isbn, '0') AS isbn, coalesce(publish_year, 0) AS publish_year, coalesce(genre, '') AS genre FROM raw""")
def q_fill_defaults(spark, sf):
    """The six known fields with defaults for missing values (year 0 where unknown)."""
    return fill_defaults(raw_catalogue_from_part(table(spark, sf, "part")), keep=["pos"])


@register("genre_codes", sql="""
WITH dim AS (SELECT lang AS genre, CAST(dense_rank() OVER (ORDER BY lang) - 1 AS INTEGER) AS encoding_index
             FROM (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL)),
n AS (SELECT max(encoding_index) + 1 AS n FROM dim)
SELECT CAST(d.doc_id AS BIGINT) AS book_id, d.lang AS genre, dim.encoding_index,
       array_to_string(list_transform(range(0, n.n), lambda i: CASE WHEN i = dim.encoding_index THEN 1 ELSE 0 END), ',')
         AS one_hot
FROM documents d LEFT JOIN dim ON dim.genre = d.lang CROSS JOIN n""")
def q_genre_codes(spark, sf):
    """S6 + P10: genre dimension coded alphabetically from the data, each book's code and one-hot vector."""
    books = books_from_documents(table(spark, sf, "documents"))
    dim = genre_dimension(books)
    return genre_codes(books, dim).withColumn("one_hot", F.array_join("one_hot", ","))


def _landed_json(documents):
    """Stand-in landing: one search response per document and one detail record per work key."""
    key = F.concat(F.lit("/works/W"), F.col("doc_id").cast("string"))
    year = F.when(F.col("doc_id") % 3 == 0, F.lit(None)).otherwise(F.lit(1900) + F.col("doc_id") % 120)
    doc = F.struct(first_line("text").alias("title"), F.array("source").alias("author_name"),
                   year.cast("long").alias("first_publish_year"),
                   F.array(F.col("doc_id").cast("string"), (F.col("doc_id") + 1000000).cast("string")).alias("isbn"),
                   key.alias("key"))
    responses = documents.select(F.to_json(F.struct(F.col("lang").alias("q"), F.array(doc).alias("docs"))).alias("json"))
    as_obj = F.to_json(F.struct(key.alias("key"), F.struct(F.col("text").alias("value")).alias("description")))
    as_str = F.to_json(F.struct(key.alias("key"), F.col("text").alias("description")))
    absent = F.to_json(F.struct(key.alias("key")))
    details = documents.select(key.alias("key"), F.when(F.col("doc_id") % 10 == 0, absent)
                               .when(F.col("doc_id") % 2 == 1, as_obj).otherwise(as_str).alias("json"))
    return responses, details


@register("ingest_json", sql="""
SELECT coalesce(split_part(text, chr(10), 1), 'N/A') AS title, coalesce(source, 'N/A') AS author,
       CASE WHEN doc_id % 3 = 0 THEN 'N/A' ELSE CAST(1900 + doc_id % 120 AS VARCHAR) END AS publish_year,
       CAST(doc_id AS VARCHAR) || ', ' || CAST(doc_id + 1000000 AS VARCHAR) AS isbn,
       '/works/W' || CAST(doc_id AS VARCHAR) AS key, lang AS genre,
       CASE WHEN doc_id % 10 = 0 OR text IS NULL THEN 'N/A' ELSE text END AS description
FROM documents""")
def q_ingest_json(spark, sf):
    """S7 + S8: flatten landed search responses and enrich them with string-or-object descriptions."""
    responses, details = _landed_json(table(spark, sf, "documents"))
    return enrich_descriptions(books_from_search_responses(responses), details)


@register("union_ingest", sql=f"""
WITH raw AS ({SQL_RAW_CATALOGUE}), books AS ({SQL_BOOKS})
SELECT 'part' AS source, pos, title, author, CAST(publish_year AS VARCHAR) AS publish_year, genre FROM raw
UNION ALL
SELECT 'documents' AS source, book_id AS pos, title, author, CAST(NULL AS VARCHAR) AS publish_year, genre FROM books""")
def q_union_ingest(spark, sf):
    """S9 + U2: landed result sets appended whole, with duplicates."""
    a = raw_catalogue_from_part(table(spark, sf, "part")).select(F.lit("part").alias("source"), "pos", "title", "author", "publish_year", "genre")
    b = books_from_documents(table(spark, sf, "documents")).select(F.lit("documents").alias("source"), F.col("book_id").alias("pos"), "title", "author", "genre")
    return (union_ingests(a, b).select("source", "pos", "title", "author", "publish_year", "genre")
            .withColumn("publish_year", F.col("publish_year").cast("string")))


@register("csv_roundtrip", sql=f"""
WITH raw AS ({SQL_RAW_CATALOGUE})
SELECT title, author, CAST(publish_year AS VARCHAR) AS publish_year, isbn, 'P' || CAST(pos AS VARCHAR) AS key,
       genre, description FROM raw""")
def q_csv_roundtrip(spark, sf):
    """K1/K4 then S1 + S2: the raw catalogue written as CSV with "N/A" marks and read back typed."""
    raw = raw_catalogue_from_part(table(spark, sf, "part"))
    out = raw.select("title", "author", F.col("publish_year").cast("string").alias("publish_year"), "isbn",
                     F.concat(F.lit("P"), F.col("pos").cast("string")).alias("key"), "genre", "description")
    path = scratch_path(spark, "catalogue-csv")
    write_csv(out, path, null_value="N/A")
    back = read_catalogue_csv(spark, path)
    return back.withColumn("publish_year", F.col("publish_year").cast("int").cast("string"))


@register("load_or_build", sql=f"WITH {q.postings_cte(SQL_BOOKS)} SELECT token, book_id FROM post")
def q_load_or_build(spark, sf):
    """K5 + X4: postings built and saved on the first call, read from storage on the second."""
    path = scratch_path(spark, "postings")

    def build():
        return build_postings(books_from_documents(table(spark, sf, "documents")))

    load_or_build(spark, path, build)
    return load_or_build(spark, path, lambda: (_ for _ in ()).throw(RuntimeError("must not rebuild")))


#: Landed lines of every reader, made of the tables; some records of each are broken, by rules on their columns.
SQL_LANDED = """
WITH c AS (SELECT CASE doc_id % 7 WHEN 0 THEN 'no json' WHEN 1 THEN 'no action' WHEN 2 THEN 'no list' WHEN 3 THEN 'no object' ELSE 'read' END AS reason FROM documents),
s AS (SELECT CASE WHEN coalesce(role, '') <> 'user' THEN 'no search' WHEN text IS NULL THEN 'no query' ELSE 'read' END AS reason FROM conversations),
r AS (SELECT CASE WHEN item_id IS NULL OR length(text) % 5 = 0 THEN 'no docs' ELSE 'read' END AS reason FROM benchmark WHERE text IS NOT NULL),
t AS (SELECT CASE WHEN value IS NULL THEN 'no two numbers' ELSE 'read' END AS reason FROM events),
p AS (SELECT CASE WHEN p_partkey % 9 = 0 THEN 'malformed record' ELSE 'read' END AS reason FROM part)
SELECT reader, reason, count(*) AS n FROM (SELECT 'changes' AS reader, reason FROM c UNION ALL SELECT 'searches', reason FROM s
  UNION ALL SELECT 'responses', reason FROM r UNION ALL SELECT 'timings', reason FROM t UNION ALL SELECT 'catalogue', reason FROM p) GROUP BY reader, reason"""


@register("landed_rejects", sql=SQL_LANDED)
def q_landed_rejects(spark, sf):
    """Files with broken records, landed by Spark from the tables and read back; records and rejects by reason."""
    def land(name, df):
        path = scratch_path(spark, f"landing-{name}")
        df.write.text(path)
        return path

    n, text = F.pmod("doc_id", F.lit(7)), F.coalesce("text", F.lit(""))
    request = F.to_json(F.struct(F.lit("add_book").alias("action"), F.array(F.struct(text.alias("title"))).alias("book_data")))
    changes = (F.when(n == 0, F.substring(request, 1, 25)).when(n == 1, F.to_json(F.struct(text.alias("title"))))
               .when(n == 2, F.to_json(F.struct(F.lit("edit_book").alias("action"), text.alias("book_ids"))))
               .when(n == 3, F.to_json(F.array(text))).otherwise(request))
    asked = F.when(F.col("text").isNull(), F.array().cast("array<string>")).otherwise(F.array("text"))
    search = F.to_json(F.struct(F.when(F.col("role") == "user", "search").otherwise(F.col("role")).alias("action"), asked.alias("user_query")))
    docs = F.array(F.struct(F.col("text").alias("title")))
    broken = F.col("item_id").isNull() | (F.length("text") % 5 == 0)
    response = F.to_json(F.struct(F.col("item_id").alias("q"), F.when(~broken, docs).alias("docs")))
    timing = F.concat_ws(", ", F.coalesce(F.col("user_id").cast("int").cast("string"), F.lit("0")), F.col("value").cast("string"))
    part, half = table(spark, sf, "part"), F.col("p_partkey") % 9 == 0
    csv = scratch_path(spark, "landing-catalogue")
    book = [F.col("p_name"), F.col("p_brand"), F.col("p_size"), F.col("p_partkey"), F.col("p_partkey"), F.col("p_type"), F.col("p_name")]
    part.where(~half).select(*[c.cast("string").alias(f) for c, f in zip(book, RAW_CATALOGUE.fieldNames())]).write.option("header", True).csv(csv)
    part.where(half).select(F.col("p_name").alias("title"), F.col("p_brand").alias("author")).write.mode("append").option("header", True).csv(csv)
    return all_counts(
        landed_changes(spark, land("changes", table(spark, sf, "documents").select(changes))),
        landed_searches(spark, land("searches", table(spark, sf, "conversations").select(search))),
        landed_responses(spark, land("responses", table(spark, sf, "benchmark").where("text is not null").select(response))),
        landed_timings(spark, land("timings", table(spark, sf, "events").select(timing))),
        landed_catalogue(spark, csv))
