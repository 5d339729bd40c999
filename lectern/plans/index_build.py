"""Index construction (the catalogue's start-up job): books -> postings + vectors, written as one version.

Stored vectors are kept for live books and only missing ones are embedded (M6, D9); postings are built from
the books (A2) and pruned to live books by construction (J5, D10). Everything is written under ``root`` and
read back, so later searches start from storage (K5, X4).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators.embed import DEFAULT_DIM, fill_missing_vectors, hashed_vectors
from lectern.operators.lemmas import apply_lemmas, lemma_map
from lectern.operators.postings import build_postings, vocabulary
from lectern.sources.versioned import VersionWriter, buckets_for


def build_index(spark: SparkSession, books: DataFrame, root: str, vectors: DataFrame | None = None,
                dim: int = DEFAULT_DIM, version: int = 0, lemmatize: bool = False, buckets: int | None = None) -> dict[str, DataFrame]:
    """Write books, postings, vocabulary and vectors of one catalogue version; return them read back.

    ``lemmatize=True`` adds the T5 step: a ``lemmas`` table (the corpus vocabulary as lexicon) is written and the
    postings hold lemmas; pass that table to ``hybrid_search(lemmas=...)`` so queries are mapped the same way. The postings and the
    vocabulary of the tokens as they are written are kept too, for changes. ``buckets`` is the number of hash buckets of
    each table, by default one for every 50,000 books.
    """
    embed = lambda df: hashed_vectors(df, dim=dim)
    new = VersionWriter(spark, root, version, buckets or buckets_for(books.count()))
    stored_books = new.whole("books", books)
    vecs = (embed(stored_books) if vectors is None
            else fill_missing_vectors(stored_books, vectors, embed).drop("computed"))
    raw = build_postings(stored_books)
    names = ["books", "postings", "vocabulary", "vectors"]
    if lemmatize:
        surface = new.whole("surface_postings", raw)
        vocab = new.whole("surface_vocabulary", vocabulary(surface)).select("token")
        raw = apply_lemmas(surface, new.whole("lemmas", lemma_map(vocab, vocab)))
        names += ["lemmas", "surface_postings", "surface_vocabulary"]
    new.whole("vocabulary", vocabulary(new.whole("postings", raw)))
    new.whole("vectors", vecs)
    new.commit(stored_books.agg(F.max("book_id")).first()[0])
    return {name: new.read(name) for name in names}
