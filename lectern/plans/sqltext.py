"""SQL fragments for the DuckDB oracle, written from the same fixed values the Spark code uses."""

from __future__ import annotations

from lectern.functions.text import STOP_WORDS


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_str_list(values) -> str:
    return "[" + ", ".join(sql_str(v) for v in values) + "]"


STOP_SQL = sql_str_list(STOP_WORDS)


def text_or_empty(x: str, any_case: bool = False) -> str:
    text = f"lower(CAST({x} AS VARCHAR))" if any_case else f"CAST({x} AS VARCHAR)"
    return f"(CASE WHEN {x} IS NULL OR {text} = 'nan' THEN '' ELSE CAST({x} AS VARCHAR) END)"


def compose(t: str = "title", a: str = "author", d: str = "description") -> str:
    return (f"('Title: ' || {text_or_empty(t)} || ', Author: ' || {text_or_empty(a)} "
            f"|| ', Description: ' || {text_or_empty(d)})")


def words(x: str) -> str:
    return f"regexp_extract_all(lower(coalesce({x}, '')), '(\\p{{L}}+)', 1)"


def tokens(x: str) -> str:
    return f"list_filter({words(x)}, lambda t: NOT list_contains({STOP_SQL}, t))"


def postings_cte(books_sql: str) -> str:
    """``books`` and ``post(token, book_id)`` CTE bodies over a books query."""
    return (f"books AS ({books_sql}), "
            f"post AS (SELECT DISTINCT unnest({tokens(compose())}) AS token, book_id FROM books)")


def cosine(a: str, b: str) -> str:
    a, b = f"CAST({a} AS DOUBLE[])", f"CAST({b} AS DOUBLE[])"
    aa, bb = f"list_dot_product({a}, {a})", f"list_dot_product({b}, {b})"
    return (f"(CASE WHEN sqrt({aa}) * sqrt({bb}) > 0 "
            f"THEN list_dot_product({a}, {b}) / (sqrt({aa}) * sqrt({bb})) ELSE 0.0 END)")


def euclidean(a: str, b: str) -> str:
    return f"list_distance(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[]))"


def candidates_cte(books_sql: str) -> str:
    """``books``, ``post``, ``qt`` (benchmark query tokens) and ``cand`` (distinct query/book pairs)."""
    return (postings_cte(books_sql) + ", "
            f"qt AS (SELECT DISTINCT CAST(item_id AS BIGINT) AS query_id, unnest({tokens('text')}) AS token "
            "FROM benchmark), "
            "cand AS (SELECT DISTINCT query_id, book_id FROM qt JOIN post USING (token))")


def hashed_cte(prefix: str, src_sql: str, dim: int, max_tokens: int | None = None, unit: bool = True) -> str:
    """Signed md5 feature-hashed vectors (of length 1 if ``unit``) in long form: ``{prefix}_vec(id, bucket, v)`` and
    ``{prefix}_norm(id, n)`` for ``src_sql`` rows ``(id, txt)``."""
    p = prefix
    toks = tokens("txt") if max_tokens is None else f"list_slice({tokens('txt')}, 1, {max_tokens})"
    return (f"{p}_src AS ({src_sql}), "
            f"{p}_tk AS (SELECT id, unnest({toks}) AS t FROM {p}_src), "
            f"{p}_h AS (SELECT id, CAST('0x' || substr(md5(t), 1, 8) AS BIGINT) AS h FROM {p}_tk), "
            f"{p}_c AS (SELECT id, h % {dim} AS bucket, CASE WHEN (h // {dim}) % 2 = 0 THEN 1 ELSE -1 END AS s "
            f"FROM {p}_h), "
            f"{p}_cnt AS (SELECT id, bucket, sum(s) AS c FROM {p}_c GROUP BY id, bucket), "
            f"{p}_raw AS (SELECT id, sqrt(sum(c * c)) AS rn FROM {p}_cnt GROUP BY id), "
            f"{p}_vec AS (SELECT id, bucket, c / {'rn' if unit else '1'} AS v FROM {p}_cnt JOIN {p}_raw USING (id) WHERE rn > 0 AND c <> 0), "
            f"{p}_norm AS (SELECT s.id, coalesce(sqrt(sum(x.v * x.v)), 0.0) AS n FROM {p}_src s "
            f"LEFT JOIN {p}_vec x USING (id) GROUP BY s.id)")


def filled_cte(stored_sql: str, books_sql: str, queries_sql: str, dim: int) -> str:
    """Vectors of all books in long form, ``bv_all(id, bucket, v)`` with ``bn_all(id, n)``: the stored one (``stored_sql``: id,
    embedding) or, where there is none, the hashed one of the book's text; and ``q_vec``, ``q_norm`` of the query texts."""
    return (f"st AS ({stored_sql}), {hashed_cte('b', books_sql, dim)}, {hashed_cte('q', queries_sql, dim)}, "
            "bv_all AS (SELECT id, unnest(range(0, len(embedding))) AS bucket, CAST(unnest(embedding) AS DOUBLE) AS v FROM st "
            "UNION ALL SELECT id, bucket, v FROM b_vec WHERE id NOT IN (SELECT id FROM st)), "
            "bn_all AS (SELECT s.id, coalesce(sqrt(sum(x.v * x.v)), 0.0) AS n FROM b_src s LEFT JOIN bv_all x USING (id) GROUP BY s.id)")
