"""Chat formatting with Spark expressions only: turns are collected and sorted per conversation, adjacent turns of one
role are merged into a run, and runs are concatenated into one marked-up text with its loss mask.

Template: ``<|im_start|>role\\n`` text ``<|im_end|>\\n`` per run; texts merged into one run stand apart by ``<|im_next|>``.
Control strings inside a text (``<|name|>``, ``<s>``, ``</s>``, ``[INST]``, ``[/INST]``, ``<<SYS>>``, ``<</SYS>>``) get a
backslash after their first character, and one more if they already look escaped, so no text can hold a template mark
and unescaping gives the text back exactly. Roles are percent-escaped (``%``, line feed, ``<``, ``[``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import table

START, END, NEXT = "<|im_start|>", "<|im_end|>\n", "<|im_next|>"
LOSS_ROLE = "assistant"
#: Control strings without their first character (``<`` or ``[``); none contains such a character again.
CONTROL = r"\|[A-Za-z0-9_]+\|>|/?s>|/?INST\]|/?SYS>"
_ROLE = [("%", "%25"), ("\n", "%0A"), ("<", "%3C"), ("[", "%5B")]


def escape(col: Column) -> Column:
    return F.regexp_replace(col, rf"([<\[])(\\*)({CONTROL})", r"$1\\$2$3")


def unescape(col: Column) -> Column:
    return F.regexp_replace(col, rf"([<\[])\\(\\*)({CONTROL})", r"$1$2$3")


def _role(col: Column, back: bool = False) -> Column:
    for a, b in reversed(_ROLE) if back else _ROLE:
        col = F.replace(col, F.lit(b), F.lit(a)) if back else F.replace(col, F.lit(a), F.lit(b))
    return col


def _piece(text: Column, loss: Column) -> Column:
    return F.struct(text.alias("text"), loss.alias("loss"))


def format_conversations(turns: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """(conv_id, runs, pieces, formatted) from ``turns(conv_id, turn, role, text)``.

    ``runs`` are the merged turns (role, texts). ``pieces`` cut ``formatted`` into stretches with or without loss: their
    texts in a row are ``formatted``, and ``loss`` is true for exactly the (escaped) texts of ``loss_role``. Rows are
    ordered by turn (null first), then role and text, so ties and repeated rows have one defined order and all stay. A
    null role or text is empty; rows with a null conv_id form one conversation; further columns are not read. A
    conversation is one output row, so its turns meet in one row; every step over them is linear in their number.
    """
    rows = turns.select("conv_id", F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"),
                                            F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    got = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    ts = F.col("ts")
    got = got.withColumn("starts", F.filter(
        F.sequence(F.lit(0), F.size(ts) - 1),
        lambda i: (i == 0) | (F.get(ts, i)["role"] != F.get(ts, i - 1)["role"])))
    got = got.withColumn("runs", F.transform("starts", lambda s, k: F.struct(
        F.get(ts, s)["role"].alias("role"),
        F.transform(F.slice(ts, s + 1, F.coalesce(F.get(F.col("starts"), k + 1), F.size(ts)) - s),
                    lambda x: x["text"]).alias("texts"))))
    no = F.lit(False)
    got = got.withColumn("pieces", F.flatten(F.transform("runs", lambda r: F.concat(
        F.array(_piece(F.concat(F.lit(START), _role(r["role"]), F.lit("\n")), no)),
        F.flatten(F.transform(r["texts"], lambda x, i: F.when(
            i == 0, F.array(_piece(escape(x), r["role"] == loss_role))).otherwise(
            F.array(_piece(F.lit(NEXT), no), _piece(escape(x), r["role"] == loss_role))))),
        F.array(_piece(F.lit(END), no))))))
    return got.select("conv_id", "runs", "pieces",
                      F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("formatted"))


def parse_formatted(formatted: Column) -> Column:
    """The turns (role, text) of a formatted text, each merged turn by itself again."""
    quoted = {m: m.replace("|", r"\|") for m in (END, NEXT)}
    blocks = F.split(formatted, quoted[END], -1)
    return F.flatten(F.transform(F.slice(blocks, 1, F.greatest(F.size(blocks) - 1, F.lit(0))), lambda b: F.transform(
        F.split(F.substring(b, F.instr(b, "\n") + 1, F.length(b)), quoted[NEXT], -1),
        lambda s: F.struct(_role(F.substring(F.substring_index(b, "\n", 1), F.lit(len(START) + 1), F.length(b)), back=True).alias("role"),
                           unescape(s).alias("text")))))


def digests(formatted: DataFrame) -> DataFrame:
    """The contract's columns, all read back from ``formatted`` and ``pieces``."""
    turns = formatted.select("conv_id", "formatted", "pieces", parse_formatted(F.col("formatted")).alias("turns"))
    loss = F.array_join(F.transform(F.filter("pieces", lambda p: p["loss"]), lambda p: unescape(p["text"])), "")
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    out = turns.select("conv_id", "formatted", F.size("turns").cast("long").alias("n_turns"), lines.alias("_l"), loss.alias("_m"))
    return out.select("conv_id", "n_turns", F.sha2("_l", 256).alias("turns_sha256"),
                      F.length("_m").cast("long").alias("loss_chars"), F.sha2("_m", 256).alias("loss_sha256"),
                      F.length("formatted").cast("long").alias("formatted_chars"))


def q_op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    return digests(format_conversations(rows.unionByName(more)))


ORACLE_OP4 = rf"""
WITH rows AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *, row_number() OVER w AS k, coalesce(lag(role) OVER w = role, false) AS merged
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(regexp_replace(text, '([<\[])(\\*)({CONTROL})', '\1\\\2\3', 'g'))
    + CASE WHEN merged THEN {len(NEXT)} ELSE {len(START) + 1 + len(END)}
      + length(replace(replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<', '%3C'), '[', '%5B')) END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""
