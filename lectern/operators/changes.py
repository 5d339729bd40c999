"""Catalogue changes as batch jobs.

A change batch is a table of requests ``(seq, action, book_data[], book_ids[])``. Requests are routed by action
(M7), paired id-to-row by position (J8) and then folded per book id in ``(seq, pos)`` order (M8). Bad input never fails a
batch: a request without seq or with an unknown action, and a row with a bad id, a bad year or unknown fields, goes to
``rejected`` with its reason (a row with unknown fields is applied without them).

- an add without an id gets the next id after the largest id before the batch (R6, D2);
- an add with an id is an upsert (M2): it replaces the row and starts the id anew, so the fold runs inside
  "runs" cut by a running count of upserts, which is made over ranges of (id, place in order): the changes of one
  hot id are spread over tasks, and only one number per range and id is carried on;
- within a run the first delete ends the id; later edits and deletes of it are rejected, as are edits and
  deletes of an id that does not exist (J7);
- for each field the latest given value of the run's applied edits wins (P4).

Postings and vectors of every touched id are removed and rebuilt from the final rows (D1), so applying a batch
equals rebuilding from the final catalogue. Nothing is collected; per-id work is keyed joins and aggregates.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.operators.catalog import BOOK_DEFAULTS, BOOK_TYPES
from lectern.operators.ids import running_count, sequential_ids
from lectern.operators.lemmas import apply_lemmas
from lectern.operators.postings import build_postings
from lectern.schemas import BOOK_DATA, BOOK_FIELDS
from lectern.session import materialize


@dataclass
class Applied:
    books: DataFrame
    postings: DataFrame | None
    vectors: DataFrame | None
    rejected: DataFrame
    touched: DataFrame
    issued: DataFrame  # (seq, pos, book_id) of every add without an id
    changed: DataFrame  # the touched books that live on, and the new ones


REJECTED = ["seq", "pos", "action", "book_id", "reason"]


def order_key() -> F.Column:
    """A change row's place in arrival order."""
    return F.struct(F.col("seq").cast("long").alias("seq"), F.col("pos").cast("long").alias("pos"))


def _field(name: str, src: str) -> F.Column:
    return F.expr(f"try_cast({src}.{name} AS {BOOK_TYPES[name]})").alias(name)


def route_requests(reqs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """M7 + J8: requests to per-book change rows ``(seq, pos, ord, action, book_id, six fields)``, plus rejects.

    view_books changes nothing; add_book needs rows (and may give ids for them, M2); edit_book needs ids and rows (paired
    by position, cut to the shorter list); delete_book needs ids; anything else, and any request without ``seq``, is
    rejected. ``unknown`` (optional: per row of ``book_data`` the keys that are no book field) is reported row by row.
    """
    n_data = F.size(F.coalesce("book_data", F.array()))
    n_ids = F.size(F.coalesce("book_ids", F.array()))
    a = F.col("action")
    kind = (F.when(F.col("seq").isNull(), "reject")
            .when(a == "view_books", "view")
            .when((a == "add_book") & (n_data > 0), "add")
            .when((a == "edit_book") & (n_ids > 0) & (n_data > 0), "edit")
            .when((a == "delete_book") & (n_ids > 0), "delete")
            .otherwise("reject"))
    r = reqs if "unknown" in reqs.columns else reqs.withColumn("unknown", F.lit(None).cast("array<array<string>>"))
    r = r.withColumn("_kind", kind)
    rejected = r.where(F.col("_kind") == "reject").select(
        "seq", F.lit(None).cast("int").alias("pos"), "action", F.lit(None).cast("long").alias("book_id"),
        F.when(F.col("seq").isNull(), F.lit("missing seq"))
         .when(a.isin("add_book", "edit_book", "delete_book"), F.lit("missing data"))
         .otherwise(F.lit("invalid action")).alias("reason"))

    # One pass: every routed request becomes an array of (pos, action, id text, fields, unknown keys) items.
    none_id = F.lit(None).cast("string")
    none_data = F.lit(None).cast(BOOK_DATA.simpleString())
    extra = lambda p: F.get(F.coalesce("unknown", F.array().cast("array<array<string>>")), p)
    given = lambda p: F.get(F.coalesce("book_ids", F.array().cast("array<string>")), p)
    item = lambda p, act, i, d, u: F.struct(p.alias("pos"), F.lit(act).alias("action"), i.alias("i"), d.alias("d"),
                                            u.alias("unknown"))
    pairs = F.slice(F.arrays_zip(F.col("book_ids").alias("i"), F.col("book_data").alias("d")), 1, F.least(n_ids, n_data))
    no_keys = F.lit(None).cast("array<string>")
    items = (F.when(F.col("_kind") == "add", F.transform("book_data", lambda d, p: item(p, "add", given(p), d, extra(p))))
             .when(F.col("_kind") == "edit", F.transform(pairs, lambda x, p: item(p, "edit", F.coalesce(x["i"], F.lit("")), x["d"], extra(p))))
             .when(F.col("_kind") == "delete", F.transform("book_ids", lambda x, p: item(p, "delete", F.coalesce(x, F.lit("")), none_data, no_keys))))
    # explode_outer + a filter on the generated item: a filter on the request itself would be pushed below an
    # upstream repartition and evaluated twice.
    rows = (r.select("seq", F.explode_outer(items).alias("it")).where(F.col("it").isNotNull())
            .select(F.col("seq").cast("long").alias("seq"), F.col("it.pos").alias("pos"), F.col("it.action").alias("action"),
                    F.expr("try_cast(trim(it.i) AS bigint)").alias("book_id"), *[_field(f, "it.d") for f in BOOK_FIELDS],
                    (F.col("it.i").isNotNull() & F.expr("try_cast(trim(it.i) AS bigint)").isNull()).alias("_bad_id"),
                    (F.col("it.d.publish_year").isNotNull() & F.expr("try_cast(it.d.publish_year AS int)").isNull()).alias("_bad_year"),
                    F.array_join("it.unknown", ", ").alias("_unknown")))
    bad = F.col("_bad_id") | F.col("_bad_year")
    wrong = rows.where(bad | (F.coalesce("_unknown", F.lit("")) != ""))
    wrong = wrong.select("seq", "pos", "action", "book_id", F.when(F.col("_bad_id"), F.lit("bad id"))
                         .when(F.col("_bad_year"), F.lit("bad year"))
                         .otherwise(F.concat(F.lit("unknown field: "), "_unknown")).alias("reason"))
    rows = rows.where(~bad).drop("_bad_id", "_bad_year", "_unknown").withColumn("ord", order_key())
    return rows, rejected.unionByName(wrong)


def _defaults(src: str | None = None) -> list[F.Column]:
    out = []
    for f, d in BOOK_DEFAULTS.items():
        c = F.col(f if src is None else f"{src}.{f}")
        out.append(F.coalesce(c.cast(BOOK_TYPES[f]), F.lit(d).cast(BOOK_TYPES[f])).alias(f))
    return out


def apply_changes(books: DataFrame, changes: DataFrame, postings: DataFrame | None = None,
                  vectors: DataFrame | None = None, embed=None, text=None, id_floor: int | None = None,
                  lemmas: DataFrame | None = None) -> Applied:
    """M8 (with M1-M5): apply per-book change rows from ``route_requests`` to the catalogue tables.

    ``books``: (book_id, six fields). ``id_floor``: the highest id ever issued (new ids start above it even if
    that book was deleted). ``lemmas``: the T5 map of an index whose postings hold lemmas. Returns the next versions of
    books, postings and vectors (when given), the rejected rows with a reason, the touched ids and the ids issued.
    """
    book_ids = books.select("book_id")
    given = changes.where((F.col("action") == "add") & F.col("book_id").isNotNull()).select("book_id")
    base_max = book_ids.unionByName(given).select(F.coalesce(F.max("book_id"), F.lit(-1)).cast("long")).scalar()
    if id_floor is not None:
        base_max = F.greatest(base_max, F.lit(int(id_floor)).cast("long"))

    # Adds without an id, numbered in (seq, pos) order after the largest id before the batch (or given
    # to an upsert in it, so a fresh id never lands on an upserted one).
    fresh = changes.where((F.col("action") == "add") & F.col("book_id").isNull())
    fresh = sequential_ids(fresh.drop("book_id"), ["seq", "pos"], "_k").withColumn("book_id", base_max + 1 + F.col("_k"))
    fresh = materialize(fresh.select("seq", "pos", "book_id", *_defaults()), "fresh-books")
    new_rows = fresh.select("book_id", *BOOK_FIELDS)

    # Targeted rows: edits, deletes and upserts (adds with an id), folded per id.
    tgt = (changes.where(F.col("book_id").isNotNull())
           .withColumn("action", F.when(F.col("action") == "add", F.lit("upsert")).otherwise(F.col("action"))))
    if tgt.where(F.col("action") == "upsert").isEmpty():
        # No upserts: every row is in run 0, and the fold below is aggregates and joins only (combined map-side,
        # skew-split by AQE), with no per-id ordered pass.
        tgt = tgt.withColumn("run", F.lit(0).cast("long"))
    else:
        tgt = running_count(tgt, "book_id", "ord", F.col("action") == "upsert", "run")
    tgt = tgt.join(book_ids.withColumn("_exists", F.lit(True)), "book_id", "left")
    runs = tgt.groupBy("book_id", "run").agg(
        F.min(F.when(F.col("action") == "delete", F.col("ord"))).alias("first_del"))
    tgt = tgt.join(runs, ["book_id", "run"])
    alive = (F.col("run") > 0) | F.col("_exists").isNotNull()
    status = (F.when(F.col("action") == "upsert", F.lit("applied"))
              .when(~alive, F.lit("unknown id"))
              .when(F.col("first_del").isNotNull() & (F.col("ord") > F.col("first_del")), F.lit("after delete"))
              .otherwise(F.lit("applied")))
    # The folded rows feed the rejects, the final rows and the touched ids; written once (batch-sized).
    tgt = materialize(tgt.withColumn("status", status), "folded-changes")
    rejected = tgt.where(F.col("status") != "applied").select(
        "seq", "pos", "action", "book_id", F.col("status").alias("reason"))

    applied = tgt.where(F.col("status") == "applied")
    last_run = applied.groupBy("book_id").agg(F.max("run").alias("run"))
    last = applied.join(last_run, ["book_id", "run"])
    is_edit = F.col("action") == "edit"
    agg = last.groupBy("book_id").agg(
        F.max(F.when(F.col("action") == "delete", 1).otherwise(0)).alias("_deleted"),
        F.max(F.when(F.col("action") == "upsert", 1).otherwise(0)).alias("_upsert"),
        *[F.max_by(F.col(f), F.when(F.col("action") == "upsert", F.col("ord"))).alias(f"_u_{f}") for f in BOOK_FIELDS],
        *[F.max_by(F.col(f), F.when(is_edit & F.col(f).isNotNull(), F.col("ord"))).alias(f"_e_{f}")
          for f in BOOK_FIELDS],
    )
    old = books.select("book_id", *[F.col(f).alias(f"_b_{f}") for f in BOOK_FIELDS])
    # Only ids alive in their last run have applied rows, so every group here is a live or re-created book.
    final_touched = (agg.where(F.col("_deleted") == 0).join(old, "book_id", "left")
                     .select("book_id", *[
                         F.coalesce(F.col(f"_e_{f}"),
                                    F.when(F.col("_upsert") == 1,
                                           F.coalesce(F.col(f"_u_{f}"), F.lit(BOOK_DEFAULTS[f]).cast(BOOK_TYPES[f])))
                                    .otherwise(F.col(f"_b_{f}"))).alias(f)
                         for f in BOOK_FIELDS]))
    touched = applied.select("book_id").distinct()
    keep = books.join(touched, "book_id", "left_anti").select("book_id", *BOOK_FIELDS)
    # The changed rows feed the books, the postings and the vectors; written once (batch-sized).
    changed_rows = materialize(final_touched.unionByName(new_rows), "changed-books")
    new_books = keep.unionByName(changed_rows)

    # Fresh ids cannot be in the stored tables: only edited, deleted and upserted ids are taken out of them.
    new_post = None
    if postings is not None:
        found = build_postings(changed_rows, text)
        if lemmas is not None:
            found = apply_lemmas(found, lemmas)
        new_post = (postings.join(touched, "book_id", "left_anti").select("token", "book_id").unionByName(found))
    new_vec = None
    if vectors is not None and embed is not None:
        new_vec = (vectors.join(touched, "book_id", "left_anti").select(*vectors.columns)
                   .unionByName(embed(changed_rows), allowMissingColumns=True))
    return Applied(new_books, new_post, new_vec, rejected, touched.unionByName(new_rows.select("book_id")),
                   fresh.select("seq", "pos", "book_id"), changed_rows)


def apply_requests(books: DataFrame, requests: DataFrame, postings: DataFrame | None = None,
                   vectors: DataFrame | None = None, embed=None, text=None, id_floor: int | None = None,
                   lemmas: DataFrame | None = None) -> Applied:
    """M7 + M8: route a table of requests and apply it; request-level and row-level rejects are combined."""
    rows, rejected_requests = route_requests(requests)
    # The batch's change rows are read by several steps; writing them once (bounded by the batch size) also
    # makes a replayed batch start from the same rows.
    rows = materialize(rows, "change-rows")
    out = apply_changes(books, rows, postings, vectors, embed, text, id_floor, lemmas)
    out.rejected = rejected_requests.select(*REJECTED).unionByName(out.rejected.select(*REJECTED))
    return out
