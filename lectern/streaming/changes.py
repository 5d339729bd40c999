"""Change stream (M8 in ``foreachBatch``): admin requests arrive as lines of JSON; each micro-batch is applied as one
batch in ``seq`` order on top of the latest committed catalogue version and published as the next version.

The next version is the last committed one plus 1, whatever the batch's number, and its commit row names the stream and
batch. So a new stream (a fresh checkpoint) goes on from the catalogue as it is, and a replayed batch finds itself committed
and does nothing. All tables of the catalogue move together: books, postings, vocabulary, vectors and, in a lemmatised
index, lemmas, surface postings and surface vocabulary. A batch reads and writes the buckets of the books and tokens it touches; the
old and new tokens of the changed books, not the postings, tell what becomes of postings and vocabulary.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators.changes import REJECTED, apply_changes, route_requests
from lectern.operators.embed import hashed_vectors
from lectern.operators.joins import broadcast_if_bounded
from lectern.operators.lemmas import apply_lemmas, candidates, lemma_map, tokens_near
from lectern.operators.postings import build_postings, merge_vocabulary, vocabulary, vocabulary_delta
from lectern.schemas import BOOK_FIELDS
from lectern.session import materialize
from lectern.sources.readers import parse_change_requests
from lectern.sources.versioned import VersionWriter, batch_is_committed, buckets_for, issued_ids_floor, latest_version


def publish_initial(spark: SparkSession, root: str, books: DataFrame, postings: DataFrame, vectors: DataFrame | None = None,
                    buckets: int | None = None) -> None:
    """Version 0 of a catalogue that was not built by ``build_index``."""
    new = VersionWriter(spark, root, 0, buckets or buckets_for(books.count()))
    stored = new.whole("books", books)
    new.whole("vocabulary", vocabulary(new.whole("postings", postings.select("token", "book_id"))))
    if vectors is not None:
        new.whole("vectors", vectors)
    new.commit(stored.agg(F.max("book_id")).first()[0])


def _without(table: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of other books than ``ids`` (a written table). A batch's ids are few beside the catalogue: within the bound they are broadcast,
    and the stored rows are not shuffled to find them."""
    return table.join(broadcast_if_bounded(ids)[0], "book_id", "left_anti")


def _without_pairs(read, gone: DataFrame) -> DataFrame:
    """A postings table without the pairs ``gone``. Only the books that lose a pair are compared pair by pair; all others are told apart by
    their id."""
    ids = materialize(gone.select("book_id").distinct(), "books-losing-tokens")
    some, bounded, _ = broadcast_if_bounded(ids)
    if not bounded:
        return read().join(gone, ["token", "book_id"], "left_anti")
    theirs = read().join(some, "book_id", "left_semi").join(gone, ["token", "book_id"], "left_anti")
    return read().join(some, "book_id", "left_anti").unionByName(theirs)


def _move(new: VersionWriter, name: str, removed: DataFrame, added: DataFrame) -> None:
    """Take ``removed`` (token, book_id) pairs out of a postings table and put ``added`` in; pairs in both stay where they are."""
    pair = ["token", "book_id"]
    sides = removed.select(*pair, F.lit(1).alias("r"), F.lit(0).alias("a")).unionByName(added.select(*pair, F.lit(0).alias("r"), F.lit(1).alias("a")))
    counts = sides.groupBy(*pair).agg(F.sum("r").cast("int").alias("r"), F.sum("a").cast("int").alias("a"))
    # Pairs of a null id are not told to be the same, so they go and come.
    change = materialize(counts.where((F.col("r") == 0) | (F.col("a") == 0) | F.col("book_id").isNull()), f"{name}-change")
    gone, come = (change.select(*pair, F.explode(F.array_repeat(F.lit(0), F.col(x))).alias("_")).select(*pair) for x in "ra")
    touched = new.tables[name].of_keys(change, name)
    kept = _without_pairs(lambda: new.read(name, touched), gone).select(*pair)
    new.replace(name, touched, kept.unionByName(come))
    words = {"postings": "vocabulary", "surface_postings": "surface_vocabulary"}[name]
    if words in new.tables:
        delta = materialize(vocabulary_delta(gone, come), f"{words}-delta")
        touched = new.tables[words].of_keys(delta, words)
        new.replace(words, touched, merge_vocabulary(new.read(words, touched), delta))


def _move_lemmas(new: VersionWriter, before: VersionWriter, old_rows: DataFrame, new_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """T5 through a batch: surface tables move first; tokens that came or went change the lexicon, and with it the lemmas of the
    tokens that have them as candidates. The (lemma, book) pairs of the changed books, and of all books with a token whose lemma
    changes, as they were and as they are."""
    was, now = build_postings(old_rows), build_postings(new_rows)
    _move(new, "surface_postings", was, now)
    seen = materialize(was.unionByName(now).select("token").distinct(), "batch-tokens")
    known = lambda at, keys: at.read("surface_vocabulary", at.tables["surface_vocabulary"].of_keys(keys, "surface_vocabulary")).select("token").join(keys, "token", "left_semi")
    first, last = known(before, seen), known(new, seen)
    turned = first.join(last, "token", "left_anti").unionByName(last.join(first, "token", "left_anti"))
    near = materialize(tokens_near(turned), "near-tokens")
    alive = known(new, near)
    # Candidates of the tokens near a turned word lie outside ``near``, so the lexicon is read for those candidates.
    lexicon = materialize(_lexicon(new, alive), "lexicon")
    fresh = materialize(lemma_map(alive, lexicon), "fresh-lemmas")
    touched = new.tables["lemmas"].of_keys(near, "lemmas")
    new.replace("lemmas", touched, new.read("lemmas", touched).join(near, "token", "left_anti").unionByName(fresh))
    held = before.read("lemmas", touched).join(near, "token", "left_semi")
    changed = held.withColumnRenamed("lemma", "_old").join(fresh, "token", "full").where(~F.col("_old").eqNullSafe(F.col("lemma"))).select("token")
    at = new.tables["surface_postings"]
    others = new.read("surface_postings", at.of_keys(materialize(changed, "changed-lemmas"), "surface_postings")).join(changed, "token", "left_semi")
    ids = old_rows.select("book_id").unionByName(new_rows.select("book_id"))
    others = materialize(others.select("book_id").distinct().join(ids, "book_id", "left_anti"), "books-of-changed-lemmas")
    rows = new.read("books", new.tables["books"].of_keys(others, "books")).join(others, "book_id", "left_semi")
    same = materialize(build_postings(rows), "their-tokens")

    def lemmas(pairs, writer):
        tokens = pairs.select("token").distinct()
        return apply_lemmas(pairs, writer.read("lemmas", writer.tables["lemmas"].of_keys(tokens, "lemmas")))
    return lemmas(was.unionByName(same), before), lemmas(now.unionByName(same), new)


def _lexicon(new: VersionWriter, tokens: DataFrame) -> DataFrame:
    """The surface words that are candidates of ``tokens``."""
    cands = materialize(candidates(tokens).select(F.col("cand").alias("token")).distinct(), "lemma-candidates")
    at = new.tables["surface_vocabulary"]
    return new.read("surface_vocabulary", at.of_keys(cands, "surface_vocabulary")).select("token").join(cands, "token", "left_semi")


def apply_to_catalogue(spark: SparkSession, root: str, requests: DataFrame, stream: str | None = None,
                       batch_id: int | None = None, embed=None) -> int:
    """Apply a table of requests to the catalogue under ``root`` and publish the next version; returns its number.

    ``embed`` gives vectors for changed books; the default is the built-in embedder in the stored vectors' size. After the batch,
    all tables are what a rebuild from the books would give.
    """
    prev = latest_version(spark, root)
    floor = issued_ids_floor(spark, root)
    before, new = VersionWriter(spark, root, prev, prev=prev), VersionWriter(spark, root, prev + 1, prev=prev)
    routed, rejected = route_requests(requests)
    routed = materialize(routed, "change-rows")
    # Only the buckets of the ids that the batch names; ids are issued above the floor, which the commit log keeps.
    named = routed.where("book_id is not null").select("book_id").distinct()
    at = new.tables["books"]
    part = before.read("books", at.of_keys(named, "books"))
    out = apply_changes(part, routed, id_floor=-1 if floor is None else floor)
    touched = materialize(out.touched.distinct(), "touched-ids")
    old_rows = materialize(part.join(touched, "book_id", "left_semi").select("book_id", *BOOK_FIELDS), "books-before")
    ids = at.of_keys(touched, "books")
    stay = _without(before.read("books", ids), touched).select("book_id", *BOOK_FIELDS)
    new.replace("books", ids, stay.unionByName(out.changed))
    if "postings" in new.tables:
        if "lemmas" in new.tables:
            was, now = _move_lemmas(new, before, old_rows, out.changed)
        else:
            was, now = build_postings(old_rows), build_postings(out.changed)
        _move(new, "postings", was, now)
    if "vectors" in new.tables:
        if embed is None:
            dim = before.read("vectors").select(F.size("embedding")).first()
            embed = lambda df: hashed_vectors(df, dim=dim[0]) if dim else hashed_vectors(df)
        ids = new.tables["vectors"].of_keys(touched, "vectors")
        kept = _without(before.read("vectors", ids), touched)
        new.replace("vectors", ids, kept.unionByName(embed(out.changed), allowMissingColumns=True))
    rejects = rejected.select(*REJECTED).unionByName(out.rejected.select(*REJECTED))
    new.log("rejected", rejects.withColumn("batch_id", F.lit(batch_id).cast("long")))
    new.log("issued", out.issued)
    top = out.changed.agg(F.max("book_id")).first()[0]
    new.commit(max((x for x in (top, floor) if x is not None), default=None), stream, batch_id)
    return prev + 1


def batch_writer(root: str, stream_id, embed=None):
    """The ``foreachBatch`` body; ``stream_id()`` names the stream, and stays the same over restarts from its checkpoint."""
    def apply_batch(batch: DataFrame, batch_id: int) -> None:
        spark, stream = batch.sparkSession, stream_id()
        if not batch_is_committed(spark, root, stream, batch_id):
            requests = parse_change_requests(batch.withColumnRenamed("value", "json"))
            apply_to_catalogue(spark, root, requests, stream, batch_id, embed)
    return apply_batch


def run_change_stream(spark: SparkSession, requests_dir: str, root: str, checkpoint: str,
                      files_per_batch: int | None = None, embed=None):
    """Process every request file present in ``requests_dir`` (``availableNow``) and return the query handle."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    started, handle = threading.Event(), []

    def stream_id() -> str:
        started.wait()
        return str(handle[0].id)
    query = (reader.text(requests_dir).writeStream.foreachBatch(batch_writer(root, stream_id, embed))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    handle.append(query)
    started.set()
    return query
