"""Landed files read whole: every record becomes a row or a reject.

A reject is (reader, file, split, record, reason, raw): the file, the byte at which the part of it that one task read begins
(0 for a file that is not split), the record's number from 0 in that part, and the record as it was landed. ``Landed.counts``
gives rows and rejects by reason; rows plus rejects are all records of the files.

Records are read and judged in one pass and written once under the shared folder, so rows and rejects come from the same
reading even if files land meanwhile. A record's number is its place in its part, found from the part's least running id;
only rejects take that join. A path with nothing at it has no records. Blank lines of line-oriented files are no records.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.schemas import RAW_CATALOGUE
from lectern.session import materialize
from lectern.sources.readers import (books_from_search_responses, null_markers, parse_change_requests, parse_search_requests, path_is_missing,
                                     timing_columns)

REJECTS = "reader string, file string, split long, record long, reason string, raw string"


@dataclass
class Landed:
    rows: DataFrame
    rejected: DataFrame
    #: (reader, reason, n): number of good records (reason ``read``) and of rejects by reason.
    counts: DataFrame


def _parted(reader: str, judged: DataFrame) -> tuple[DataFrame, Landed]:
    """The written good records (all but the reading's own columns), and rejects and counts, of records with ``_reason`` (null: good) and ``_raw``."""
    judged = materialize(judged, f"landed-{reader}")
    name = F.lit(reader).alias("reader")
    first = judged.groupBy("_file", "_split").agg(F.min("_id").alias("_first"))
    bad = judged.where("_reason is not null").join(first, ["_file", "_split"])
    bad = bad.select(name, F.col("_file").alias("file"), F.col("_split").alias("split"), (F.col("_id") - F.col("_first")).alias("record"),
                     F.col("_reason").alias("reason"), F.col("_raw").alias("raw"))
    counts = judged.groupBy(name, F.coalesce("_reason", F.lit("read")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    good = judged.where("_reason is null")
    return good, Landed(good, bad, counts)


def _placed(df: DataFrame) -> DataFrame:
    return df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_split"),
                     F.monotonically_increasing_id().alias("_id"))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of text files with their places, numbered with the blank ones, which are then left out."""
    try:
        lines = _placed(spark.read.text(path))
    except Exception as e:  # noqa: BLE001 - the Spark error class differs by version
        if not path_is_missing(e):
            raise
        lines = spark.createDataFrame([], "value string, _file string, _split long, _id long")
    blank = F.trim(F.regexp_replace("value", "[\\r\\t]", "")) == ""
    return lines.withColumn("_raw", F.col("value")).where(~blank)


def _first_reason(*cases: tuple[Column, str]) -> Column:
    """The reason of the first case that holds; an undecided case counts as not holding."""
    out = F.lit(None).cast("string")
    for cond, reason in reversed(cases):
        out = F.when(cond, F.lit(reason)).otherwise(out)
    return out


def _kind(json: Column, path: str = "$") -> Column:
    """Type of a JSON value (OBJECT..., ARRAY..., STRING, ...); null for text that is no JSON and for absent values."""
    return F.schema_of_variant(F.try_variant_get(F.try_parse_json(json), path, "variant"))


def landed_catalogue(spark: SparkSession, path: str, schema: T.StructType = RAW_CATALOGUE) -> Landed:
    """S1 + S2: header CSV with quoted multi-line fields. A record with too few or too many fields, or with text where
    ``schema`` has a number, is a reject. "N/A" is read as null."""
    marked = T.StructType([*schema.fields, T.StructField("_raw", T.StringType())])
    try:
        df = (spark.read.schema(marked).option("header", True).option("multiLine", True).option("escape", '"').option("nullValue", "N/A")
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_raw").csv(path))
        df = _placed(df)
    except Exception as e:  # noqa: BLE001 - the Spark error class differs by version
        if not path_is_missing(e):
            raise
        more = [T.StructField("_file", T.StringType()), T.StructField("_split", T.LongType()), T.StructField("_id", T.LongType())]
        df = spark.createDataFrame([], T.StructType([*marked.fields, *more]))
    good, out = _parted("catalogue", df.withColumn("_reason", F.when(F.col("_raw").isNotNull(), "malformed record")))
    out.rows = null_markers(good.select(*[f.name for f in schema.fields]))
    return out


def landed_responses(spark: SparkSession, path: str) -> Landed:
    """One search response per line; its rows are the books of all good responses. Rejects: no JSON object, or one
    without a list ``docs`` (an empty list is a good response without books)."""
    kind, docs = _kind(F.col("value")), _kind(F.col("value"), "$.docs")
    reason = _first_reason((kind.isNull(), "no json"), (~kind.startswith("OBJECT"), "no object"),
                           (docs.isNull() | ~docs.startswith("ARRAY"), "no docs"))
    good, out = _parted("responses", _lines(spark, path).withColumn("_reason", reason))
    out.rows = books_from_search_responses(good, "value")
    return out


def landed_changes(spark: SparkSession, path: str) -> Landed:
    """One change request per line, as ``parse_change_requests`` gives them (``route_requests`` judges what they ask
    for). Rejects: no JSON object, no action, or a field of another type than the request's."""
    kind = _kind(F.col("value"))
    typed = lambda name: (lambda k: k.isNotNull() & ~k.startswith("ARRAY") & (k != "VOID"))(_kind(F.col("value"), f"$.{name}"))
    action = _kind(F.col("value"), "$.action")
    reason = _first_reason((kind.isNull(), "no json"), (~kind.startswith("OBJECT"), "no object"), (action.isNull() | (action != "STRING"), "no action"),
                           (typed("book_data") | typed("book_ids"), "no list"))
    good, out = _parted("changes", _lines(spark, path).withColumn("_reason", reason))
    out.rows = parse_change_requests(good.select(F.col("value").alias("json"))).drop("json")
    return out


def landed_searches(spark: SparkSession, path: str) -> Landed:
    """One search request per line. Rejects: no JSON object, another action than search, no queries."""
    kind, action, asked = (_kind(F.col("value"), p) for p in ("$", "$.action", "$.user_query"))
    said = F.get_json_object("value", "$.action")
    count = F.coalesce(F.json_array_length(F.get_json_object("value", "$.user_query")), F.lit(0))
    reason = _first_reason((kind.isNull(), "no json"), (~kind.startswith("OBJECT"), "no object"),
                           (action.isNull() | (said != "search"), "no search"), (asked.isNull() | ~asked.startswith("ARRAY") | (count == 0), "no query"))
    good, out = _parted("searches", _lines(spark, path).withColumn("_reason", reason))
    out.rows = parse_search_requests(good.select(F.col("value").alias("json"))).drop("json")
    return out


def landed_timings(spark: SparkSession, path: str) -> Landed:
    """Lines ``threads, seconds``. Rejects: lines that are not two numbers."""
    lines = _lines(spark, path).select("*", *timing_columns(F.col("value")))
    reason = _first_reason((F.col("threads").isNull() | F.col("seconds").isNull(), "no two numbers"))
    good, out = _parted("timings", lines.withColumn("_reason", reason))
    out.rows = good.select("threads", "seconds")
    return out


def all_rejects(*landed: Landed) -> DataFrame:
    """One table of the rejects of several readings."""
    out = landed[0].rejected
    for x in landed[1:]:
        out = out.unionByName(x.rejected)
    return out


def all_counts(*landed: Landed) -> DataFrame:
    """One table of the counts of several readings."""
    out = landed[0].counts
    for x in landed[1:]:
        out = out.unionByName(x.counts)
    return out
