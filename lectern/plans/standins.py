"""Stand-in inputs built from the driver's tables.

Each function only renames and reshapes driver columns into the schema a job expects; none of them does any of
the job's work, and no job relies on how the stand-in rows were produced. The mapping:

- ``documents`` as the catalogue: doc_id = book id, first line = title, source = author, the rest of the text =
  description, lang = genre (isbn and year are unknown, so null).
- ``embeddings`` as the vector table (vec_id = book id) and as query vectors (vec_id = query id).
- ``benchmark`` as a table of queries (item_id = query id).
- ``part`` as a raw catalogue with duplicates: name = title, brand = author, ``p_size % 5`` (0 = unknown) = year,
  type = genre, p_partkey = position in the file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.text import after_first_line, first_line


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A table of a few files, of one row group each, is read by as few tasks: deal its rows over the cores before heavy work on
    each row. A table with as many files as there are cores is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 0 < len(df.inputFiles()) < cores else df


def books_from_documents(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("long").alias("book_id"),
        first_line("text").alias("title"),
        F.col("source").alias("author"),
        after_first_line("text").alias("description"),
        F.lit(None).cast("string").alias("isbn"),
        F.lit(None).cast("int").alias("publish_year"),
        F.col("lang").alias("genre"),
    )


def vectors_from_embeddings(embeddings: DataFrame) -> DataFrame:
    return embeddings.select(F.col("vec_id").cast("long").alias("book_id"), "embedding")


def query_vectors_from_embeddings(embeddings: DataFrame) -> DataFrame:
    return embeddings.select(F.col("vec_id").cast("long").alias("query_id"), "embedding")


def queries_from_benchmark(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id").cast("long").alias("query_id"), "text")


def raw_catalogue_from_part(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").cast("long").alias("pos"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("author"),
        F.expr("nullif(p_size % 5, 0)").cast("int").alias("publish_year"),
        F.col("p_type").alias("genre"),
        F.col("p_partkey").cast("string").alias("isbn"),
        F.concat_ws(" ", F.col("p_name"), F.col("p_type")).alias("description"),
    )


# SQL text of the same stand-ins, for the DuckDB oracle.
SQL_BOOKS = (
    "SELECT CAST(doc_id AS BIGINT) AS book_id, split_part(text, chr(10), 1) AS title, source AS author, "
    "regexp_replace(text, '^[^\\n]*\\n?', '') AS description, CAST(NULL AS VARCHAR) AS isbn, "
    "CAST(NULL AS INTEGER) AS publish_year, lang AS genre FROM documents"
)
SQL_RAW_CATALOGUE = (
    "SELECT CAST(p_partkey AS BIGINT) AS pos, p_name AS title, p_brand AS author, "
    "CAST(nullif(p_size % 5, 0) AS INTEGER) AS publish_year, p_type AS genre, "
    "CAST(p_partkey AS VARCHAR) AS isbn, concat_ws(' ', p_name, p_type) AS description FROM part"
)


def change_requests_from_events(events: DataFrame, given_ids: bool = False) -> DataFrame:
    """``events`` as a feed of admin requests ``(seq, json)``: signup = add (with ``given_ids``: under the user's id), purchase = edit
    (title always, description for even k), error = delete, view = view_books, click = an unknown action; user_id =
    target id."""
    k = F.get_json_object("props", "$.k")
    uid = F.col("user_id").cast("string")
    et = F.col("event_type")
    ids = [F.array(uid).alias("book_ids")] if given_ids else []
    add = F.struct(F.lit("add_book").alias("action"), *ids, F.array(F.struct(
        F.concat(F.lit("Book "), k).alias("title"), F.concat(F.lit("User "), uid).alias("author"),
        F.concat(F.lit("Signup "), k, F.lit(" by user "), uid).alias("description"))).alias("book_data"))
    edit = F.struct(F.lit("edit_book").alias("action"), F.array(uid).alias("book_ids"), F.array(F.struct(
        F.concat(F.lit("Title "), k).alias("title"),
        F.when(k.cast("long") % 2 == 0, F.concat(F.lit("Edited "), k)).alias("description"))).alias("book_data"))
    delete = F.struct(F.lit("delete_book").alias("action"), F.array(uid).alias("book_ids"))
    view = F.struct(F.lit("view_books").alias("action"))
    other = F.struct(et.alias("action"))
    js = (F.when(et == "signup", F.to_json(add)).when(et == "purchase", F.to_json(edit))
          .when(et == "error", F.to_json(delete)).when(et == "view", F.to_json(view)).otherwise(F.to_json(other)))
    return events.select(F.col("event_id").cast("long").alias("seq"), js.alias("json"))


# The same feed as per-book change rows, in SQL.
SQL_CHANGE_ROWS = (
    "SELECT CAST(event_id AS BIGINT) AS seq, 0 AS pos, CAST(event_id AS BIGINT) AS ord, "
    "CASE event_type WHEN 'signup' THEN 'add' WHEN 'purchase' THEN 'edit' ELSE 'delete' END AS action, "
    "CASE WHEN event_type IN ('purchase', 'error') THEN CAST(user_id AS BIGINT) END AS book_id, "
    "CASE event_type WHEN 'signup' THEN 'Book ' || k WHEN 'purchase' THEN 'Title ' || k END AS title, "
    "CASE WHEN event_type = 'signup' THEN 'User ' || user_id END AS author, "
    "CASE WHEN event_type = 'signup' THEN 'Signup ' || k || ' by user ' || user_id "
    "WHEN event_type = 'purchase' AND k % 2 = 0 THEN 'Edited ' || k END AS description "
    "FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events) "
    "WHERE event_type IN ('signup', 'purchase', 'error')"
)


def _allowed_by(idx):
    from lectern.operators.catalog import ALLOWED_GENRES
    return F.element_at(F.array(*[F.lit(g) for g in ALLOWED_GENRES]), (idx % 20 + 1).cast("int"))


def replies_from_part(part: DataFrame) -> DataFrame:
    """``part`` rows as model replies ``(query_id, attempt, reply)``; ``p_size`` picks the reply's flaws."""
    s = F.col("p_size")
    title = F.when(s % 7 == 0, F.lit("1. Book title: Not provided")).otherwise(F.concat(F.lit("1. Book title: "), "p_name"))
    author = F.concat(F.when(s % 9 == 0, F.lit("2. Author name ")).otherwise(F.lit("2. Author name: ")), "p_brand")
    genres = F.when(s % 10 == 0, F.concat(F.lit("3. Genres "), F.lower("p_type"))).otherwise(
        F.concat(F.lit("3. Genres: "), F.lower("p_type"), F.lit(", "), _allowed_by(F.col("p_partkey")), F.lit(", ")))
    kw = F.when(s % 13 == 0, F.concat(F.lit("4. "), "p_name")).otherwise(
        F.concat(F.lit("4. Keywords: "), "p_name", F.lit(" "), F.lower("p_type")))
    extra = F.when(s % 11 == 0, F.lit(" книга")).otherwise(F.lit(""))
    body = F.concat_ws("\n", title, author, genres, kw)
    reply = F.when(s == 1, F.lit("  ")).otherwise(F.concat(body, extra))
    return part.select(F.col("p_partkey").cast("long").alias("query_id"), F.lit(1).alias("attempt"), reply.alias("reply"))


def replies_from_conversations(conversations: DataFrame) -> DataFrame:
    """Conversation turns as reply attempts ``(query_id = conv_id, attempt = turn + 1, reply)``: turn % 3 = 0 is
    free text, 1 a well-formed reply (title = the text's first sentence, author = role, keywords = the whole
    text), 2 the same reply with a title line that lacks ": "."""
    t = F.col("turn")
    fmt = lambda sep: F.concat(F.lit("1. Book title"), F.lit(sep), F.substring_index("text", ".", 1), F.lit("\n2. Author name: "),
                               F.col("role"), F.lit("\n3. Genres: "), _allowed_by(F.col("conv_id")),
                               F.lit("\n4. Keywords: "), F.coalesce(F.col("text"), F.lit("")))
    reply = F.when(t % 3 == 0, F.col("text")).when(t % 3 == 1, fmt(": ")).otherwise(fmt(" "))
    return conversations.select(F.col("conv_id").cast("long").alias("query_id"), (t + 1).cast("int").alias("attempt"),
                                reply.alias("reply"))


def _sql_allowed(idx: str) -> str:
    from lectern.operators.catalog import ALLOWED_GENRES
    from lectern.plans.sqltext import sql_str_list
    return f"list_extract({sql_str_list(ALLOWED_GENRES)}, CAST({idx} % 20 + 1 AS INTEGER))"


SQL_REPLIES_PART = (
    "SELECT CAST(p_partkey AS BIGINT) AS query_id, 1 AS attempt, CASE WHEN p_size = 1 THEN '  ' ELSE "
    "(CASE WHEN p_size % 7 = 0 THEN '1. Book title: Not provided' ELSE '1. Book title: ' || p_name END) || chr(10) || "
    "(CASE WHEN p_size % 9 = 0 THEN '2. Author name ' ELSE '2. Author name: ' END) || p_brand || chr(10) || "
    "(CASE WHEN p_size % 10 = 0 THEN '3. Genres ' || lower(p_type) ELSE '3. Genres: ' || lower(p_type) || ', ' || "
    f"{_sql_allowed('p_partkey')} || ', ' END) || chr(10) || "
    "(CASE WHEN p_size % 13 = 0 THEN '4. ' || p_name ELSE '4. Keywords: ' || p_name || ' ' || lower(p_type) END) || "
    "(CASE WHEN p_size % 11 = 0 THEN ' книга' ELSE '' END) END AS reply FROM part"
)


def _sql_conv_fmt(sep: str) -> str:
    return (f"'1. Book title{sep}' || split_part(text, '.', 1) || chr(10) || '2. Author name: ' || role || chr(10) "
            f"|| '3. Genres: ' || {_sql_allowed('conv_id')} || chr(10) || '4. Keywords: ' || coalesce(text, '')")


SQL_REPLIES_CONV = (
    "SELECT CAST(conv_id AS BIGINT) AS query_id, CAST(turn + 1 AS INTEGER) AS attempt, "
    f"CASE WHEN turn % 3 = 0 THEN text WHEN turn % 3 = 1 THEN {_sql_conv_fmt(': ')} ELSE {_sql_conv_fmt(' ')} END "
    "AS reply FROM conversations"
)
