"""Vocabulary-level maps for T5 (noun lemmas) and T2 (first word piece).

Both maps are computed once per *distinct* token, not per occurrence, and then applied with an equi-join; the
token stream is never sent through Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.operators.joins import sized_join

# WordNet's noun detachment rules (suffix -> replacement), in their published order.
NOUN_RULES = [("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"),
              ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y")]


def candidates(vocab: DataFrame) -> DataFrame:
    """(token, cand, prio): the token itself (prio 0) and one rule application per matching rule."""
    t = F.col("token")
    opts = [F.struct(t.alias("cand"), F.lit(0).alias("prio"))]
    for i, (suffix, repl) in enumerate(NOUN_RULES, start=1):
        stem = F.expr(f"substring(token, 1, length(token) - {len(suffix)})")
        opts.append(F.when(t.endswith(suffix), F.struct(F.concat(stem, F.lit(repl)).alias("cand"),
                                                          F.lit(i).alias("prio"))))
    return (vocab.select("token", F.explode(F.array(*opts)).alias("c"))
            .where(F.col("c").isNotNull())
            .select("token", F.col("c.cand").alias("cand"), F.col("c.prio").alias("prio")))


def lemma_map(vocab: DataFrame, lexicon: DataFrame) -> DataFrame:
    """T5: ``(token, lemma)`` for every distinct token of ``vocab``.

    A candidate (the token or one rule application) counts only if the ``lexicon`` (column ``token``) holds it;
    the shortest counted candidate wins, earlier candidates winning ties. A token with no counted candidate is
    its own lemma. One round of rules is applied.
    """
    lex = lexicon.select(F.col("token").alias("cand")).distinct()
    hits = candidates(vocab.select("token").distinct()).join(lex, "cand", "left_semi")
    best = hits.groupBy("token").agg(
        F.min_by("cand", F.struct(F.length("cand"), F.col("prio"))).alias("lemma"))
    return (vocab.select("token").distinct().join(best, "token", "left")
            .select("token", F.coalesce("lemma", "token").alias("lemma")))


def tokens_near(words: DataFrame) -> DataFrame:
    """T5 backwards: every token that has one of ``words`` (column ``token``) as a candidate: itself, and what each rule turns into it."""
    t = F.col("token")
    opts = [t]
    for suffix, repl in NOUN_RULES:
        stem = F.expr(f"substring(token, 1, length(token) - {len(repl)})")
        opts.append(F.when(t.endswith(repl), F.concat(stem, F.lit(suffix))))
    return words.select(F.explode(F.array(*opts)).alias("token")).where("token is not null").distinct()


def apply_lemmas(pairs: DataFrame, lemmas: DataFrame, id_col: str = "book_id") -> DataFrame:
    """Map a (token, id) table through a ``(token, lemma)`` map; unknown tokens stay themselves, pairs distinct.

    Used for postings (id = book_id) and for query tokens (id = query_id), so both sides meet on lemmas.
    """
    return (pairs.join(lemmas, "token", "left")
            .select(F.coalesce("lemma", "token").alias("token"), id_col).distinct())


def first_pieces(words: DataFrame, pieces: DataFrame) -> DataFrame:
    """For each distinct word, its longest prefix found in the piece vocabulary (greedy first piece).

    Words with no prefix in the vocabulary are unknown and produce no row. The vocabulary is broadcast when its
    measured size allows (a single-letter piece matches a large share of all words, so a shuffle on the piece
    would concentrate them), otherwise joined with salting.
    """
    vocab = pieces.select("piece").distinct()
    # No prefix longer than the longest piece can match, so longer ones are not made.
    longest = vocab.select(F.coalesce(F.max(F.length("piece")), F.lit(0))).scalar()
    pref = (words.select("word").distinct().withColumn("_n", F.least(F.length("word"), longest)).where("_n > 0")
            .select("word", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("n"))
            .select("word", "n", F.expr("substring(word, 1, n)").alias("piece")))
    hits = sized_join(pref, vocab, ["piece"], "left_semi")
    return hits.groupBy("word").agg(F.max_by("piece", "n").alias("piece"))


def _sql_candidates() -> str:
    """Each token and what every matching rule makes of it, one SELECT per rule."""
    rules = [f"SELECT token, substring(token, 1, length(token) - {len(suffix)}) || '{repl}' AS cand, {i} AS prio FROM vocab WHERE ends_with(token, '{suffix}')"
             for i, (suffix, repl) in enumerate(NOUN_RULES, start=1)]
    return " UNION ALL ".join(["SELECT token, token AS cand, 0 AS prio FROM vocab", *rules])


SQL_LEMMA_MAP = (
    "WITH vocab AS ({vocab}), cand AS (" + _sql_candidates() + "), "
    "hit AS (SELECT cand.token, arg_min(cand.cand, length(cand.cand) * 100 + cand.prio) AS lemma "
    "FROM cand JOIN vocab lex ON lex.token = cand.cand GROUP BY cand.token) "
    "SELECT v.token, coalesce(h.lemma, v.token) AS lemma FROM vocab v LEFT JOIN hit h ON h.token = v.token"
)

SQL_FIRST_PIECE = (
    "WITH w AS ({words}), p AS ({pieces}), "
    "pref AS (SELECT word, n, substring(word, 1, n) AS piece FROM "
    "(SELECT word, unnest(range(1, length(word) + 1)) AS n FROM w)) "
    "SELECT word, arg_max(piece, n) AS piece FROM pref WHERE piece IN (SELECT piece FROM p) GROUP BY word"
)
