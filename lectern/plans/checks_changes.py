"""Checked queries for catalogue changes (S10, M1-M8, J7, J8, R6, U4) and the change stream.

Nullable ids are shown as text in checked outputs so both engines hand over the same values.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.operators.changes import apply_requests, route_requests
from lectern.operators.postings import build_postings
from lectern.plans import sqltext as q
from lectern.plans.registry import register
from lectern.plans.standins import (SQL_BOOKS, SQL_CHANGE_ROWS, books_from_documents, change_requests_from_events,
                                    table)
from lectern.schemas import BOOK_FIELDS
from lectern.session import materialize
from lectern.sources.readers import parse_change_requests


def _requests(spark, sf, kinds=None, given_ids=False):
    ev = table(spark, sf, "events")
    if kinds is not None:
        ev = ev.where(F.col("event_type").isin(kinds))
    return parse_change_requests(change_requests_from_events(ev, given_ids))


def _books(spark, sf):
    """The catalogue before the batch: a stored table, as it is between batches."""
    return materialize(books_from_documents(table(spark, sf, "documents")))


def _out(books):
    return books.select("book_id", *[F.col(f).cast("string").alias(f) if f == "publish_year" else f
                                     for f in BOOK_FIELDS])


def _sql_apply(kinds: tuple[str, ...]) -> str:
    ks = ", ".join(f"'{k}'" for k in kinds)
    return f"""
WITH books AS ({SQL_BOOKS}),
ch AS (SELECT * FROM ({SQL_CHANGE_ROWS}) WHERE action IN ({ks})),
adds AS (SELECT (SELECT max(book_id) FROM books) + row_number() OVER (ORDER BY ord) AS book_id,
                coalesce(title, '') AS title, coalesce(author, '') AS author, coalesce(description, '') AS description,
                '0' AS isbn, 0 AS publish_year, '' AS genre FROM ch WHERE action = 'add'),
tgt AS (SELECT * FROM ch WHERE action IN ('edit', 'delete') AND book_id IN (SELECT book_id FROM books)),
fd AS (SELECT book_id, min(ord) AS first_del FROM tgt WHERE action = 'delete' GROUP BY book_id),
app AS (SELECT t.* FROM tgt t LEFT JOIN fd USING (book_id) WHERE fd.first_del IS NULL OR t.ord <= fd.first_del),
ed AS (SELECT book_id, arg_max(title, ord) FILTER (WHERE title IS NOT NULL) AS title,
              arg_max(author, ord) FILTER (WHERE author IS NOT NULL) AS author,
              arg_max(description, ord) FILTER (WHERE description IS NOT NULL) AS description
       FROM app WHERE action = 'edit' GROUP BY book_id),
final AS (SELECT b.book_id, coalesce(ed.title, b.title) AS title, coalesce(ed.author, b.author) AS author,
                 coalesce(ed.description, b.description) AS description, b.isbn, b.publish_year, b.genre
          FROM books b LEFT JOIN ed USING (book_id) WHERE b.book_id NOT IN (SELECT book_id FROM fd)
          UNION ALL SELECT * FROM adds)"""


def _final_sql(kinds):
    return _sql_apply(kinds) + """
SELECT book_id, title, author, description, isbn, CAST(publish_year AS VARCHAR) AS publish_year, genre FROM final"""


@register("change_requests", sql=f"""
SELECT seq, CAST(pos AS INTEGER) AS pos, action, CAST(book_id AS VARCHAR) AS book_id, title, author, description
FROM ({SQL_CHANGE_ROWS})""")
def q_change_requests(spark, sf):
    """S10 + M7 + J8: JSON admin requests parsed, routed and paired into per-book change rows."""
    rows, _ = route_requests(_requests(spark, sf))
    return rows.select("seq", "pos", "action", F.col("book_id").cast("string").alias("book_id"), "title", "author",
                       "description")


@register("apply_adds", sql=_final_sql(("add",)))
def q_apply_adds(spark, sf):
    """M1 + R6 + P3: add requests appended with ids after the largest existing id and default fields."""
    return _out(apply_requests(_books(spark, sf), _requests(spark, sf, ["signup"])).books)


@register("apply_updates", sql=_final_sql(("edit",)))
def q_apply_updates(spark, sf):
    """M3 + P4 + J7: partial edits, the latest given value per field winning; unknown ids rejected."""
    return _out(apply_requests(_books(spark, sf), _requests(spark, sf, ["purchase"])).books)


@register("apply_deletes", sql=_final_sql(("delete",)))
def q_apply_deletes(spark, sf):
    """M4 + J7: deleted ids removed; repeated deletes of an id rejected."""
    return _out(apply_requests(_books(spark, sf), _requests(spark, sf, ["error"])).books)


@register("apply_batch", sql=_final_sql(("add", "edit", "delete")))
def q_apply_batch(spark, sf):
    """M8 + M7: the whole request feed folded per id in arrival order and applied as one batch."""
    return _out(apply_requests(_books(spark, sf), _requests(spark, sf)).books)


@register("batch_rejections", sql=_sql_apply(("add", "edit", "delete")) + """
SELECT CAST(event_id AS BIGINT) AS seq, -1 AS pos, event_type AS action, CAST(NULL AS VARCHAR) AS book_id,
       'invalid action' AS reason FROM events WHERE event_type NOT IN ('signup', 'purchase', 'error', 'view')
UNION ALL
SELECT t.seq, t.pos, t.action, CAST(t.book_id AS VARCHAR), 'after delete' AS reason FROM tgt t JOIN fd USING (book_id)
WHERE t.ord > fd.first_del
UNION ALL
SELECT seq, pos, action, CAST(book_id AS VARCHAR), 'unknown id' AS reason FROM ch
WHERE action IN ('edit', 'delete') AND book_id NOT IN (SELECT book_id FROM books)""")
def q_batch_rejections(spark, sf):
    """M7 + J7: rejected requests and rows with their reason (unknown action, unknown id, after delete)."""
    rej = apply_requests(_books(spark, sf), _requests(spark, sf)).rejected
    return rej.select("seq", F.coalesce("pos", F.lit(-1)).alias("pos"), "action",
                      F.col("book_id").cast("string").alias("book_id"), "reason")


@register("batch_postings", sql=_sql_apply(("add", "edit", "delete")) + f"""
SELECT DISTINCT unnest({q.tokens(q.compose())}) AS token, book_id FROM final""")
def q_batch_postings(spark, sf):
    """U4 + D1: postings updated incrementally for touched ids only; equals postings rebuilt from the result."""
    books = _books(spark, sf)
    out = apply_requests(books, _requests(spark, sf), postings=build_postings(books))
    return out.postings


@register("batch_vocabulary", sql=_sql_apply(("add", "edit", "delete")) + f""",
post AS (SELECT DISTINCT unnest({q.tokens(q.compose())}) AS token, book_id FROM final)
SELECT token, CAST(count(*) AS BIGINT) AS n_books FROM post GROUP BY token""")
def q_batch_vocabulary(spark, sf):
    """M5: the vocabulary after the batch, from the updated postings (no book text is read again)."""
    from lectern.operators.postings import vocabulary
    books = _books(spark, sf)
    out = apply_requests(books, _requests(spark, sf), postings=build_postings(books))
    return vocabulary(out.postings)


@register("issued_ids", sql=_sql_apply(("add",)) + """
SELECT seq, pos, (SELECT max(book_id) FROM books) + row_number() OVER (ORDER BY ord) AS book_id FROM ch""")
def q_issued_ids(spark, sf):
    """M1: the id each add request without an id was given."""
    out = apply_requests(_books(spark, sf), _requests(spark, sf, ["signup"])).issued
    return out.select("seq", F.col("pos").cast("int").alias("pos"), "book_id")


@register("apply_upserts", sql=f"""
WITH books AS ({SQL_BOOKS}), ch AS (SELECT c.*, e.user_id AS id FROM ({SQL_CHANGE_ROWS}) c JOIN events e ON e.event_id = c.seq WHERE c.action = 'add'),
last AS (SELECT CAST(id AS BIGINT) AS book_id, arg_max(coalesce(title, ''), ord) AS title, arg_max(coalesce(author, ''), ord) AS author,
  arg_max(coalesce(description, ''), ord) AS description FROM ch GROUP BY id)
SELECT book_id, title, author, description, isbn, CAST(publish_year AS VARCHAR) AS publish_year, genre FROM books
WHERE book_id NOT IN (SELECT book_id FROM last)
UNION ALL SELECT book_id, title, author, description, '0', '0', '' FROM last""")
def q_apply_upserts(spark, sf):
    """M2: adds under given ids replace the rows of those ids, the latest one winning."""
    return _out(apply_requests(_books(spark, sf), _requests(spark, sf, ["signup"], given_ids=True)).books)


STREAM_RUNS = 3


def _streamed(spark, sf):
    """The request feed lands in ``STREAM_RUNS`` seq-ordered chunks; after each one an ``availableNow`` run of the same stream
    (same checkpoint) applies the new lines. Gives the catalogue's folder."""
    from lectern.operators.embed import hashed_vectors
    from lectern.session import scratch_path
    from lectern.streaming.changes import publish_initial, run_change_stream

    books = _books(spark, sf)
    root = scratch_path(spark, "catalogue")
    publish_initial(spark, root, books, build_postings(books), hashed_vectors(books, dim=STREAM_DIM))
    reqs = change_requests_from_events(table(spark, sf, "events"))
    body = F.concat(F.lit('{"seq":'), F.col("seq").cast("string"), F.lit(","), F.substring("json", F.lit(2), F.length("json")))
    lo, hi = reqs.agg(F.min("seq"), F.max("seq")).first()
    inbox = scratch_path(spark, "requests")
    checkpoint = scratch_path(spark, "requests-checkpoint")
    span = (hi - lo) // STREAM_RUNS + 1
    for i in range(STREAM_RUNS):
        chunk = reqs.where((F.col("seq") >= lo + i * span) & (F.col("seq") < lo + (i + 1) * span))
        chunk.select(body.alias("value")).write.mode("append").text(inbox)
        run_change_stream(spark, inbox, root, checkpoint).awaitTermination()
    return root


STREAM_DIM = 16


def _stream_table(spark, sf, name):
    from lectern.sources.versioned import latest_version, read_version
    root = _streamed(spark, sf)
    return read_version(spark, root, name, latest_version(spark, root))


@register("stream_changes", sql=_final_sql(("add", "edit", "delete")))
def q_stream_changes(spark, sf):
    """M8 in foreachBatch: the books after the whole feed has streamed in equal applying it at once."""
    return _out(_stream_table(spark, sf, "books"))


@register("stream_vocabulary", sql=_sql_apply(("add", "edit", "delete")) + f""",
post AS (SELECT DISTINCT unnest({q.tokens(q.compose())}) AS token, book_id FROM final)
SELECT token, CAST(count(*) AS BIGINT) AS n_books FROM post GROUP BY token""")
def q_stream_vocabulary(spark, sf):
    """M5 in the stream: the vocabulary moves with the books."""
    return _stream_table(spark, sf, "vocabulary")


@register("stream_vectors", sql=_sql_apply(("add", "edit", "delete")) + f""",
{q.hashed_cte('f', f"SELECT book_id AS id, {q.compose()} AS txt FROM final", STREAM_DIM)}
SELECT id AS book_id, CAST(bucket AS INTEGER) AS bucket, round(v, 6) AS value FROM f_vec""")
def q_stream_vectors(spark, sf):
    """M3-M4 in the stream: vectors of changed books are made anew, those of deleted ones go."""
    vec = _stream_table(spark, sf, "vectors").select("book_id", F.posexplode("embedding").alias("bucket", "v"))
    return vec.where(F.col("v") != 0).select("book_id", "bucket", F.round("v", 6).alias("value"))
