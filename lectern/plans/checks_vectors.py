"""Checked queries for vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions.vectors import l2_normalize
from lectern.operators.embed import MODEL_MAX_TOKENS, coverage_counts, coverage_gaps, embed_with, fill_missing_vectors, hashed_vectors
from lectern.operators.origin import embed_with_origin, refresh_vectors
from lectern.plans import sqltext as q
from lectern.plans.registry import register
from lectern.plans.standins import SQL_BOOKS, books_from_documents, spread, table, vectors_from_embeddings
from lectern.session import materialize, scratch_path
from lectern.sources.readers import read_vectors_text, wide_to_vectors
from lectern.sources.writers import write_vectors_text

HASH_DIM = 64


def _long_form(vectors, id_col="book_id"):
    """Vector rows as (id, dim_index, value rounded to 6 decimals) so both engines compare numbers.

    ``posexplode_outer`` plus an explicit filter: a plain ``posexplode`` lets Catalyst infer a non-empty-array
    predicate on the vector and push it below the exchange, which would evaluate the embedder twice.
    """
    return (vectors.select(id_col, F.posexplode_outer("embedding").alias("dim_index", "x"))
            .where(F.col("dim_index").isNotNull())
            .select(id_col, F.col("dim_index").cast("long").alias("dim_index"),
                    F.round(F.col("x").cast("double"), 6).alias("value")))


SQL_HASHED = f"""
books AS ({SQL_BOOKS}),
tk AS (SELECT book_id, unnest({q.tokens(q.compose())}) AS t FROM books),
hh AS (SELECT book_id, CAST('0x' || substr(md5(t), 1, 8) AS BIGINT) AS h FROM tk),
cc AS (SELECT book_id, h % {HASH_DIM} AS bucket, CASE WHEN (h // {HASH_DIM}) % 2 = 0 THEN 1 ELSE -1 END AS s FROM hh),
cnt AS (SELECT book_id, bucket, sum(s) AS v FROM cc GROUP BY book_id, bucket),
nrm AS (SELECT book_id, sqrt(sum(v * v)) AS n FROM cnt GROUP BY book_id),
hv AS (SELECT book_id, bucket, v / n AS value FROM cnt JOIN nrm USING (book_id) WHERE v <> 0 AND n > 0)"""


@register("hashed_vectors", sql=f"""
WITH {SQL_HASHED}
SELECT book_id, CAST(bucket AS BIGINT) AS dim_index, round(value, 6) AS value FROM hv""")
def q_hashed_vectors(spark, sf):
    """T7c + T9: signed feature-hashed, unit-length vectors of each book's whole composed text (non-zero entries)."""
    books = books_from_documents(spread(table(spark, sf, "documents")))
    return _long_form(hashed_vectors(books, dim=HASH_DIM)).where(F.col("value") != 0)


_SQL_EMB_LONG = """
SELECT book_id, CAST(i AS BIGINT) AS dim_index, round({value}, 6) AS value FROM (
  SELECT CAST(vec_id AS BIGINT) AS book_id, CAST(embedding AS DOUBLE[]) AS v,
         sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS n,
         unnest(range(len(embedding))) AS i, unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings)"""


@register("l2_normalize", sql=_SQL_EMB_LONG.format(value="CASE WHEN n > 0 THEN x / n ELSE 0.0 END"))
def q_l2_normalize(spark, sf):
    """Every stored vector scaled to unit length."""
    v = vectors_from_embeddings(table(spark, sf, "embeddings"))
    return _long_form(v.select("book_id", l2_normalize("embedding").alias("embedding")))


@register("vector_codec", sql=_SQL_EMB_LONG.format(value="x"))
def q_vector_codec(spark, sf):
    """K2 then S3: vectors written in the printed ``[a b c]`` text form and parsed back."""
    v = vectors_from_embeddings(table(spark, sf, "embeddings"))
    path = scratch_path(spark, "vectors-text")
    write_vectors_text(v, path)
    return _long_form(read_vectors_text(spark, path))


@register("wide_features", sql=_SQL_EMB_LONG.format(value="x"))
def q_wide_features(spark, sf):
    """Vectors spread to feature_0..feature_{k-1} columns (k read from the data) and gathered back."""
    v = vectors_from_embeddings(table(spark, sf, "embeddings"))
    k = v.select(F.max(F.size("embedding"))).first()[0] or 0
    wide = v.select("book_id", *[F.col("embedding")[i].alias(f"feature_{i}") for i in range(k)])
    return _long_form(wide_to_vectors(wide, k))


@register("vector_coverage", sql="""
SELECT 'missing' AS kind, CAST(doc_id AS BIGINT) AS id FROM documents
WHERE doc_id NOT IN (SELECT vec_id FROM embeddings WHERE vec_id IS NOT NULL)
UNION ALL
SELECT 'orphan' AS kind, CAST(vec_id AS BIGINT) AS id FROM embeddings
WHERE vec_id NOT IN (SELECT doc_id FROM documents WHERE doc_id IS NOT NULL)""")
def q_vector_coverage(spark, sf):
    """Books without a vector and vectors without a book."""
    books = books_from_documents(table(spark, sf, "documents"))
    return coverage_gaps(books, vectors_from_embeddings(table(spark, sf, "embeddings")))


@register("vector_counts", sql="""
SELECT (SELECT CAST(count(*) AS BIGINT) FROM documents) AS n_books,
       (SELECT CAST(count(*) AS BIGINT) FROM embeddings) AS n_vectors,
       (SELECT CAST(count(*) AS BIGINT) FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)) AS n_missing,
       (SELECT CAST(count(*) AS BIGINT) FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM documents)) AS n_orphans""")
def q_vector_counts(spark, sf):
    """A9 + J9: book and vector counts with the gap counts."""
    books = books_from_documents(table(spark, sf, "documents"))
    return coverage_counts(books, vectors_from_embeddings(table(spark, sf, "embeddings")))


@register("missing_vectors_only", sql=f"""
WITH {SQL_HASHED}
SELECT CAST(vec_id AS BIGINT) AS book_id, false AS computed, round(list_sum(CAST(embedding AS DOUBLE[])), 6) + 0.0 AS value_sum
FROM embeddings WHERE vec_id IN (SELECT doc_id FROM documents)
UNION ALL
SELECT b.book_id, true AS computed, round(coalesce(s.total, 0.0), 6) + 0.0 AS value_sum
FROM books b LEFT JOIN (SELECT book_id, sum(value) AS total FROM hv GROUP BY book_id) s USING (book_id)
WHERE b.book_id NOT IN (SELECT vec_id FROM embeddings)""")
def q_missing_vectors_only(spark, sf):
    """Stored vectors kept for live books, hashed vectors computed only for books without one."""
    books = books_from_documents(table(spark, sf, "documents"))
    vec = vectors_from_embeddings(table(spark, sf, "embeddings"))
    out = fill_missing_vectors(books, vec, lambda gap: hashed_vectors(gap, dim=HASH_DIM))
    total = F.aggregate("embedding", F.lit(0.0).cast("double"), lambda a, x: a + x)
    return out.select("book_id", "computed", (F.round(total, 6) + F.lit(0.0)).alias("value_sum"))


@register("truncated_vectors", sql=f"""
WITH books AS ({SQL_BOOKS}), {q.hashed_cte('t', f"SELECT book_id AS id, {q.compose()} AS txt FROM books", HASH_DIM, MODEL_MAX_TOKENS)}
SELECT id AS book_id, CAST(bucket AS BIGINT) AS dim_index, round(v, 6) AS value FROM t_vec""")
def q_truncated_vectors(spark, sf):
    """Vectors of each book's first 510 tokens, as a model with a bounded input sees them."""
    books = books_from_documents(spread(table(spark, sf, "documents")))
    return _long_form(hashed_vectors(books, dim=HASH_DIM, max_tokens=MODEL_MAX_TOKENS)).where(F.col("value") != 0)


LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _letter_model():
    """A caller's model: how often a text has each of the letters a to z (lower case only)."""
    import numpy as np
    return lambda texts: np.array([[t.count(c) for c in LETTERS] for t in texts], dtype=float).reshape(len(texts), len(LETTERS))


def _by_letters(books):
    return embed_with(books, _letter_model)


SQL_LETTERS = f"""books AS ({SQL_BOOKS}), t AS (SELECT book_id, {q.compose()} AS txt FROM books),
n AS (SELECT book_id, i - 1 AS dim_index, CAST(length(txt) - length(replace(txt, substr('{LETTERS}', i, 1), '')) AS DOUBLE) AS c
      FROM t, range(1, {len(LETTERS) + 1}) r(i)),
lv AS (SELECT book_id, CAST(dim_index AS BIGINT) AS dim_index, round(c / sqrt(sum(c * c) OVER (PARTITION BY book_id)), 6) AS value
       FROM n QUALIFY sum(c) OVER (PARTITION BY book_id) > 0)"""


@register("embedded_by_model", sql=f"WITH {SQL_LETTERS} SELECT * FROM lv WHERE value <> 0")
def q_embedded_by_model(spark, sf):
    """T7b + T9: vectors by a caller's model, loaded once per task."""
    return _long_form(_by_letters(books_from_documents(spread(table(spark, sf, "documents"))))).where(F.col("value") != 0)


@register("refreshed_vectors", sql=f"""WITH {SQL_LETTERS}
SELECT book_id, dim_index, value, 'letters' AS embedder, md5(txt) AS text_md5, book_id % 3 <> 0 OR book_id % 4 = 0 AS computed
FROM lv JOIN t USING (book_id) WHERE value <> 0""")
def q_refreshed_vectors(spark, sf):
    """M6 + D9 + D19: of the stored vectors, a third is of another embedder, a third of earlier texts, a quarter is missing and
    some have no book; exactly those of the present text and embedder stay."""
    books = books_from_documents(spread(table(spark, sf, "documents")))
    k = F.col("book_id") % 3
    earlier = books.withColumn("title", F.when(k == 1, F.concat_ws(" ", F.lit("earlier"), "title")).otherwise(F.col("title")))
    stored = embed_with_origin(earlier, _by_letters, "letters").withColumn("embedder", F.when(k == 2, "others").otherwise(F.col("embedder")))
    stored = stored.withColumn("book_id", F.when(F.col("book_id") % 4 == 0, -1 - F.col("book_id")).otherwise(F.col("book_id")))
    out = materialize(refresh_vectors(books, materialize(stored, "stored-vectors"), _by_letters, "letters"), "refreshed-vectors")
    return _long_form(out).where(F.col("value") != 0).join(out.select("book_id", "embedder", "text_md5", "computed"), "book_id")
