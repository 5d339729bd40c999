"""Column expressions for text analysis (T1, T3, T4, T6 as a column; P1, P2).

Everything here is a ``Column`` built from Spark's own functions, so it runs inside the JVM next to the scan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The English stop-word list the catalogue's analyser removes (the public NLTK English list,
# 179 entries, in its published order). Entries with an apostrophe can never equal a letters-only token;
# they are kept so the list reads exactly as published.
STOP_WORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves "
    "he him his himself she she's her hers herself it it's its itself they them their theirs themselves "
    "what which who whom this that that'll these those am is are was were be been being have has had "
    "having do does did doing a an the and but if or because as until while of at by for with about "
    "against between into through during before after above below to from up down in out on off over "
    "under again further then once here there when where why how all any both each few more most other "
    "some such no nor not only own same so than too very s t can will just don don't should should've "
    "now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn "
    "hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn "
    "shouldn't wasn wasn't weren weren't won won't wouldn wouldn't"
).split()

# A word is a maximal run of Unicode letters; digits, punctuation and marks separate words.
NON_WORD_PATTERN = r"[^\p{L}]+"


def _accent_table() -> tuple[str, str]:
    """Latin letters with diacritics (U+00C0-U+024F) and their base letters, derived by Unicode decomposition."""
    import unicodedata
    src, dst = [], []
    for cp in range(0xC0, 0x250):
        ch = chr(cp)
        base = unicodedata.normalize("NFD", ch)[0]
        if base != ch and base.isascii() and base.isalpha():
            src.append(ch)
            dst.append(base)
    return "".join(src), "".join(dst)


def strip_accents(text: Column) -> Column:
    """Map accented Latin letters to their base letter (one ``translate`` over a table built from Unicode)."""
    src, dst = _accent_table()
    return F.translate(text, src, dst)


def words(text: Column | str, accents: bool = True) -> Column:
    """T1 + T3: lower-case, then every maximal run of letters, in order, duplicates kept.

    Splitting on runs of non-letters and dropping the empty ends gives exactly the runs of letters, and is
    cheaper than extracting every match. ``accents=False`` strips diacritics first (as an uncased word-piece
    tokeniser does); the default keeps them.
    """
    text = F.col(text) if isinstance(text, str) else text
    text = F.lower(F.coalesce(text, F.lit("")))
    if not accents:
        text = strip_accents(text)
    return F.array_remove(F.split(text, NON_WORD_PATTERN), "")


def drop_stop_words(tokens: Column, stop_words=STOP_WORDS) -> Column:
    """T4: remove stop words; order and repeats of the rest are kept.

    ``isin`` over a literal list becomes a hash-set lookup (Catalyst's ``InSet``) once the list is long.
    """
    stop = list(stop_words)
    if not stop:
        return tokens
    return F.filter(tokens, lambda t: ~t.isin(stop))


def tokens(text: Column | str, stop_words=STOP_WORDS, accents: bool = True) -> Column:
    """T6 without lemmas: lower-cased letter runs with stop words removed, as an ordered list."""
    return drop_stop_words(words(text, accents), stop_words)


def distinct_tokens(text: Column | str, stop_words=STOP_WORDS, accents: bool = True) -> Column:
    """The set of ``tokens(text)``: one built-in ``array_except`` removes stop words and repeats together."""
    stop = list(stop_words)
    return F.array_except(words(text, accents), F.array(*[F.lit(w) for w in stop]).cast("array<string>"))


def is_missing(c: Column | str, any_case: bool = False) -> Column:
    """A value counts as missing when it is null, NaN, or prints as "nan"; a name such as "Nan" is a value. The served
    description alone is tested in any case (P6)."""
    c = F.col(c) if isinstance(c, str) else c
    s = c.cast("string")
    if not any_case:  # a float NaN prints as "NaN"
        return c.isNull() | (s == "nan") | (F.typeof(c).isin("double", "float") & (s == "NaN"))
    # The length test runs first, so a long text is never lower-cased just to be compared with "nan".
    return c.isNull() | ((F.length(s) == 3) & (F.lower(s) == F.lit("nan")))


def text_or_empty(c: Column | str, null_text: str = "", any_case: bool = False) -> Column:
    """A missing attribute contributes ``null_text`` (default empty) to composed text."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(is_missing(c, any_case), F.lit(null_text)).otherwise(c.cast("string"))


def compose_text(title="title", author="author", description="description", null_text: str = "") -> Column:
    """The text a book is indexed and embedded by: ``Title: t, Author: a, Description: d``."""
    return F.concat(
        F.lit("Title: "), text_or_empty(title, null_text),
        F.lit(", Author: "), text_or_empty(author, null_text),
        F.lit(", Description: "), text_or_empty(description, null_text),
    )


def first_line(text: Column | str) -> Column:
    """Text up to the first line break (the whole text when there is none)."""
    text = F.col(text) if isinstance(text, str) else text
    return F.substring_index(text, "\n", 1)


def after_first_line(text: Column | str) -> Column:
    """Text after the first line break (empty when there is none)."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(text, r"^[^\n]*\n?", "")
