"""Sources (S1-S12). Every reader has an explicit schema; JSON is parsed with Spark's own JSON functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.vectors import from_wide, parse_vector_text
from lectern.operators.postings import parse_postings
from lectern.schemas import BOOK_FIELDS, CHANGE_REQUEST, GENRES, POSTINGS_TEXT, RAW_CATALOGUE, SEARCH_REQUEST, VECTORS_TEXT

MISSING_MARK = "N/A"


def null_markers(df: DataFrame, mark: str = MISSING_MARK) -> DataFrame:
    """The landed "N/A" mark becomes null in every string column."""
    return df.select(*[F.nullif(F.col(f.name), F.lit(mark)).alias(f.name) if f.dataType.simpleString() == "string"
                       else F.col(f.name) for f in df.schema.fields])


def path_is_missing(e: Exception) -> bool:
    """Whether a read failed because there is nothing at its path (the error class differs by Spark version)."""
    return "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e)


def read_catalogue_csv(spark: SparkSession, path: str, schema=RAW_CATALOGUE) -> DataFrame:
    """S1 + S2: header CSV, quoted multi-line fields, "N/A" read as null; a missing path is an empty catalogue."""
    try:
        df = (spark.read.schema(schema).option("header", True).option("multiLine", True)
              .option("escape", '"').option("nullValue", MISSING_MARK)
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
        df.schema  # resolve now so a missing path is detected here
    except Exception as e:  # noqa: BLE001 - the Spark error class differs by version
        if path_is_missing(e):
            return spark.createDataFrame([], schema)
        raise
    return null_markers(df)


def read_vectors_text(spark: SparkSession, path: str) -> DataFrame:
    """S3: ``id, "[a b c]"`` CSV to ``(book_id, embedding array<float>)``."""
    df = spark.read.schema(VECTORS_TEXT).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return df.select(F.col("id").alias("book_id"), parse_vector_text("embedding").alias("embedding"))


def wide_to_vectors(df: DataFrame, k: int, prefix: str = "feature_", keep=("book_id",)) -> DataFrame:
    """``feature_0 .. feature_{k-1}`` columns to one ``embedding array<double>``."""
    return df.select(*keep, from_wide(prefix, k).alias("embedding"))


def read_postings(spark: SparkSession, path: str) -> DataFrame:
    """``token, doc_ids`` text rows to the long postings table."""
    rows = spark.read.schema(POSTINGS_TEXT).option("header", True).option("escape", '"').csv(path)
    return parse_postings(rows)


def read_genre_mapping(spark: SparkSession, path: str) -> DataFrame:
    """``genre_<name>, code`` CSV to ``(genre, encoding_index)``."""
    df = spark.read.schema(GENRES).option("header", True).csv(path)
    return df.select(F.regexp_replace("genre", "^genre_", "").alias("genre"), "encoding_index")


# One landed search response: ``{"q": genre, "docs": [{title, author_name[], first_publish_year, isbn[], key}]}``.
SEARCH_RESPONSE = ("q string, docs array<struct<title string, author_name array<string>, "
                   "first_publish_year bigint, isbn array<string>, key string>>")


def books_from_search_responses(responses: DataFrame, json_col: str = "json") -> DataFrame:
    """Flatten landed responses; the genre is the query; each missing field reads "N/A"."""
    r = responses.select(F.from_json(F.col(json_col), SEARCH_RESPONSE).alias("r"))
    d = r.select(F.col("r.q").alias("genre"), F.explode("r.docs").alias("d"))
    na = F.lit(MISSING_MARK)
    return d.select(
        F.coalesce(F.col("d.title"), na).alias("title"),
        F.coalesce(F.array_join("d.author_name", ", "), na).alias("author"),
        F.coalesce(F.col("d.first_publish_year").cast("string"), na).alias("publish_year"),
        F.coalesce(F.array_join("d.isbn", ", "), na).alias("isbn"),
        F.coalesce(F.col("d.key"), na).alias("key"),
        "genre",
    )


def description_from_details(details_json: Column) -> Column:
    """``description`` of a landed detail record: ``.value`` of an object, else the string, else "N/A"."""
    v = F.try_parse_json(details_json)
    kind = F.schema_of_variant(F.variant_get(v, "$.description", "variant"))
    as_obj = F.try_variant_get(v, "$.description.value", "string")
    as_str = F.try_variant_get(v, "$.description", "string")
    return (F.when(kind.startswith("OBJECT"), F.coalesce(as_obj, F.lit(MISSING_MARK)))
            .otherwise(F.coalesce(as_str, F.lit(MISSING_MARK))))


def enrich_descriptions(books: DataFrame, details: DataFrame, key_col: str = "key",
                        json_col: str = "json") -> DataFrame:
    """Left join landed details on the work key; books without a detail record read "N/A".

    A work fetched several times counts once, by its least description that is given; a malformed record gives none.
    Books without a key (the "N/A" mark) have no details and stay out of the join, so they cannot gather in one task.
    """
    det = details.select(F.col(key_col).alias("key"), F.nullif(description_from_details(F.col(json_col)), F.lit(MISSING_MARK)).alias("description"))
    det = det.where(F.col("key").isNotNull() & (F.col("key") != MISSING_MARK)).groupBy("key").agg(F.min("description").alias("description"))
    keyed = F.when(F.col("key") != MISSING_MARK, F.col("key")).otherwise(F.concat(F.lit("\u0000"), F.xxhash64(*books.columns).cast("string")))
    out = books.withColumn("_k", keyed).join(det.withColumnRenamed("key", "_k"), "_k", "left").drop("_k")
    return out.withColumn("description", F.coalesce("description", F.lit(MISSING_MARK)))


def union_ingests(*frames: DataFrame) -> DataFrame:
    """Append landed result sets (duplicates kept; columns matched by name)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def parse_change_requests(df: DataFrame, json_col: str = "json") -> DataFrame:
    """``{action, book_data[], book_ids[]}`` request bodies to typed columns.

    ``unknown`` lists, per entry of ``book_data``, the keys that are no book field (D13). A malformed body has a null
    action. ``seq`` is taken from the body where ``df`` has no such column.
    """
    body = F.col(json_col)
    keys = F.from_json(body, "book_data array<map<string,string>>")["book_data"]
    known = F.array(*[F.lit(f) for f in BOOK_FIELDS])
    out = df.withColumn("req", F.from_json(body, CHANGE_REQUEST)).select(
        "*", F.col("req.action").alias("action"), F.col("req.book_data").alias("book_data"),
        F.col("req.book_ids").alias("book_ids"),
        F.transform(keys, lambda m: F.array_sort(F.array_except(F.map_keys(m), known))).alias("unknown")).drop("req")
    return out if "seq" in df.columns else out.withColumn("seq", F.get_json_object(body, "$.seq").try_cast("long"))


def parse_search_requests(df: DataFrame, json_col: str = "json") -> DataFrame:
    """Keep requests with ``action = 'search'`` and a non-empty query list."""
    r = df.withColumn("req", F.from_json(F.col(json_col), SEARCH_REQUEST))
    return (r.where((F.col("req.action") == "search") & (F.size(F.coalesce("req.user_query", F.array())) > 0))
            .select("*", F.col("req.user_query").alias("user_query")).drop("req"))


def timing_columns(line: Column) -> list[Column]:
    """Threads and seconds of a line ``"threads, seconds"``; null where the text is no number."""
    parts = F.split(F.trim(line), ", ")
    return [F.get(parts, F.lit(0)).try_cast("double").try_cast("int").alias("threads"), F.get(parts, F.lit(1)).try_cast("double").alias("seconds")]


def read_timing_log(spark: SparkSession, path: str) -> DataFrame:
    """Text lines ``"threads, seconds"`` to two numbers; lines that are not two numbers are left out
    (``landed.landed_timings`` reports them)."""
    return spark.read.text(path).select(*timing_columns(F.col("value"))).where("threads is not null and seconds is not null")
