"""Explicit schemas of the catalogue tables and exchange formats (no schema inference anywhere)."""

from pyspark.sql import types as T

# Raw catalogue as landed (CSV with header).
RAW_CATALOGUE = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("publish_year", T.StringType()),
    T.StructField("isbn", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("genre", T.StringType()),
    T.StructField("description", T.StringType()),
])

# Stored catalogue.
BOOKS = T.StructType([
    T.StructField("book_id", T.LongType(), False),
    T.StructField("title", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("isbn", T.StringType()),
    T.StructField("publish_year", T.IntegerType()),
    T.StructField("genre", T.StringType()),
])

BOOK_FIELDS = ["title", "author", "description", "isbn", "publish_year", "genre"]

POSTINGS = T.StructType([
    T.StructField("token", T.StringType()),
    T.StructField("book_id", T.LongType()),
])

POSTINGS_TEXT = T.StructType([
    T.StructField("token", T.StringType()),
    T.StructField("doc_ids", T.StringType()),
])

VECTORS = T.StructType([
    T.StructField("book_id", T.LongType(), False),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
])

VECTORS_TEXT = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("embedding", T.StringType()),
])

GENRES = T.StructType([
    T.StructField("genre", T.StringType()),
    T.StructField("encoding_index", T.IntegerType()),
])

TIMING = T.StructType([
    T.StructField("threads", T.IntegerType()),
    T.StructField("seconds", T.DoubleType()),
])

# Fields a change request may carry for one book (all optional).
BOOK_DATA = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("isbn", T.StringType()),
    T.StructField("publish_year", T.StringType()),
    T.StructField("genre", T.StringType()),
])

CHANGE_REQUEST = T.StructType([
    T.StructField("action", T.StringType()),
    T.StructField("book_data", T.ArrayType(BOOK_DATA)),
    T.StructField("book_ids", T.ArrayType(T.StringType())),
])

SEARCH_REQUEST = T.StructType([
    T.StructField("action", T.StringType()),
    T.StructField("user_query", T.ArrayType(T.StringType())),
])
