"""Change batches and the change stream on a small catalogue of sea charts."""

import json

import pytest

from conftest import rows
from lectern.operators.changes import apply_changes, apply_requests, order_key, route_requests
from lectern.operators.embed import hashed_vectors
from lectern.operators.postings import build_postings, vocabulary
from lectern.plans.index_build import build_index
from lectern.plans.search import hybrid_search
from lectern.session import scratch_path
from lectern.sources.readers import parse_change_requests
from lectern.sources.versioned import latest_version, read_version
from lectern.streaming.changes import apply_to_catalogue, publish_initial, run_change_stream

SCHEMA = "book_id long, title string, author string, description string, isbn string, publish_year int, genre string"
CHARTS = [(4, "Northern Skerries", "Ødegaard", "depths of the skerries", "n4", 1931, "chart"),
          (5, "Gulf Tides", "Marchetti", "tides and currents", "n5", 1948, "chart"),
          (9, "Harbour Lights", "Okafor", "lamps along the quay", "n9", 1902, "list"),
          (12, "Reef Passages", "Tamihana", "narrow ways through coral", None, None, "chart")]
NEW = {"title": "Ice Edge", "author": "Lindqvist", "description": "the edge of pack ice", "publish_year": "1955"}


@pytest.fixture(scope="module")
def charts(spark):
    return spark.createDataFrame(CHARTS, SCHEMA)


def reqs(spark, *bodies, seqs=None):
    seqs = list(range(len(bodies))) if seqs is None else seqs
    text = [b if isinstance(b, str) else json.dumps(b) for b in bodies]
    return parse_change_requests(spark.createDataFrame(list(zip(seqs, text)), "seq long, json string"))


def add(*data, ids=None):
    return {"action": "add_book", "book_data": list(data), **({"book_ids": ids} if ids else {})}


def edit(ids, *data):
    return {"action": "edit_book", "book_ids": ids, "book_data": list(data)}


def drop(*ids):
    return {"action": "delete_book", "book_ids": list(ids)}


def by_id(df):
    return {r["book_id"]: r for r in df.collect()}


def test_added_rows_get_the_next_ids_and_defaults(spark, charts):
    out = apply_requests(charts, reqs(spark, add(NEW, {"title": "Soundings"}), add({"author": "Anon"})))
    got = by_id(out.books)
    assert sorted(got) == [4, 5, 9, 12, 13, 14, 15]
    assert (got[13]["title"], got[13]["publish_year"], got[13]["isbn"]) == ("Ice Edge", 1955, "0")
    assert (got[14]["title"], got[14]["author"], got[14]["publish_year"]) == ("Soundings", "", 0)
    assert rows(out.issued) == [(0, 0, 13), (0, 1, 14), (1, 0, 15)]


def test_edits_and_deletes_move_books_and_postings(spark, charts):
    out = apply_requests(charts, reqs(spark, edit(["5", "9"], {"description": "slack water"}, {"title": "Leading Marks", "publish_year": "1911"}), drop("4")),
                         postings=build_postings(charts))
    got = by_id(out.books)
    assert sorted(got) == [5, 9, 12]
    assert (got[5]["title"], got[5]["description"], got[9]["title"], got[9]["author"], got[9]["publish_year"]) == (
        "Gulf Tides", "slack water", "Leading Marks", "Okafor", 1911)
    words = {}
    for token, book in rows(out.postings):
        words.setdefault(book, set()).add(token)
    assert 4 not in words and "slack" in words[5] and "currents" not in words[5] and "lights" not in words[9]
    assert rows(out.postings) == rows(build_postings(out.books))


def test_many_adds_in_one_batch_get_distinct_ids(spark, charts):
    out = apply_requests(charts.limit(0), reqs(spark, *[add({"title": f"Sheet {k}"}) for k in range(25)]))
    assert [(r["book_id"], r["title"]) for r in out.books.orderBy("book_id").collect()] == [(k, f"Sheet {k}") for k in range(25)]


def test_fold_in_arrival_order(spark, charts):
    out = apply_requests(charts, reqs(
        spark,
        edit(["12"], {"title": "one"}), edit(["12"], {"title": "two", "genre": "atlas"}),      # 0, 1: latest wins per field
        drop("4"), edit(["4"], {"title": "late"}), drop("4"),                                    # 2-4: after the delete
        edit(["77"], {"title": "none"}), drop("78"),                                             # 5, 6: unknown
        {"action": "sail"}, add(), {"action": "edit_book", "book_ids": ["5"]},                   # 7-9: no such request
        edit(["5", "9", "12"], {"isbn": "x5"}, {"isbn": "x9"}), {"action": "view_books"}))       # 10: cut to two pairs
    got = by_id(out.books)
    assert sorted(got) == [5, 9, 12] and (got[12]["title"], got[12]["genre"], got[12]["isbn"]) == ("two", "atlas", None)
    assert (got[5]["isbn"], got[9]["isbn"]) == ("x5", "x9")
    assert rows(out.rejected, "seq", "reason") == [
        (3, "after delete"), (4, "after delete"), (5, "unknown id"), (6, "unknown id"), (7, "invalid action"),
        (8, "missing data"), (9, "missing data")]


def test_bad_input_is_rejected_and_the_rest_applied(spark, charts):
    out = apply_requests(charts, reqs(
        spark, edit(["five", "9"], {"title": "a"}, {"title": "kept"}), add({"title": "b", "publish_year": "c. 1850"}, {"title": "good"}),
        edit(["5"], {"title": "Tidal Streams", "colour": "blue", "scale": 3}), drop(None, " 12 "), '{"action": ', add(NEW),
        seqs=[0, 1, 2, 3, 4, None]))
    got = by_id(out.books)
    assert sorted(got) == [4, 5, 9, 13] and got[9]["title"] == "kept" and got[5]["title"] == "Tidal Streams" and got[13]["title"] == "good"
    assert sorted((r["seq"] if r["seq"] is not None else -1, r["reason"]) for r in out.rejected.collect()) == [
        (-1, "missing seq"), (0, "bad id"), (1, "bad year"), (2, "unknown field: colour, scale"), (3, "bad id"), (4, "invalid action")]


def test_order_holds_for_any_seq_and_pos(spark, charts):
    """Microsecond seqs and positions beyond 2^20 keep their order: the later edit wins."""
    base = 1_700_000_000_000_000
    text = [(base, 1 << 20, "edit", 5, "first"), (base + 1, 0, "edit", 5, "second"), (base, 3 << 20, "edit", 9, "far"), (base, 5, "edit", 9, "near")]
    changes = spark.createDataFrame(text, "seq long, pos int, action string, book_id long, title string")
    for f, t in [("author", "string"), ("description", "string"), ("isbn", "string"), ("publish_year", "int"), ("genre", "string")]:
        changes = changes.selectExpr("*", f"CAST(NULL AS {t}) AS {f}")
    got = by_id(apply_changes(charts, changes.withColumn("ord", order_key())).books)
    assert got[5]["title"] == "second" and got[9]["title"] == "far"


def test_adds_under_given_ids_start_the_id_anew(spark, charts):
    out = apply_requests(charts, reqs(
        spark, drop("9"), add({"title": "Buoys"}, {"title": "Wrecks"}, {"title": "Free"}, ids=["9", "40"]),
        edit(["9"], {"author": "Pilot"}), drop("40"), add({"title": "Anchorages"}, ids=["40"]), add({"title": "x"}, ids=["forty"])),
        postings=build_postings(charts))
    got = by_id(out.books)
    assert (got[9]["title"], got[9]["author"], got[9]["isbn"]) == ("Buoys", "Pilot", "0") and got[40]["title"] == "Anchorages"
    assert got[41]["title"] == "Free" and rows(out.issued, "book_id") == [(41,)]
    assert rows(out.rejected, "seq", "reason") == [(5, "bad id")] and rows(out.postings) == rows(build_postings(out.books))


def test_routing_pairs_ids_with_rows(spark):
    got, bad = route_requests(reqs(spark, edit(["1", "2", "3"], {"title": "a"}, {"title": "b"}), drop("7")))
    assert rows(got, "seq", "pos", "action", "book_id", "title") == sorted(
        [(0, 0, "edit", 1, "a"), (0, 1, "edit", 2, "b"), (1, 0, "delete", 7, None)], key=str)
    assert bad.count() == 0


def test_vectors_follow_the_batch(spark, charts):
    embed = lambda df: hashed_vectors(df, dim=8)
    out = apply_requests(charts, reqs(spark, drop("4"), edit(["5"], {"title": "Ebb"}), add(NEW)), vectors=embed(charts), embed=embed)
    got, want = ({r["book_id"]: r["embedding"] for r in df.collect()} for df in (out.vectors, embed(out.books)))
    assert set(got) == set(want) == {5, 9, 12, 13}
    assert all(max(abs(a - b) for a, b in zip(got[k], want[k])) < 1e-6 for k in got)


def test_nothing_to_change(spark, charts):
    out = apply_requests(charts, reqs(spark, {"action": "view_books"}, {"action": "dive"}))
    assert rows(out.books) == rows(charts) and rows(out.rejected, "seq", "reason") == [(1, "invalid action")]
    assert apply_requests(charts, reqs(spark, add(NEW)).limit(0)).books.count() == len(CHARTS)


def test_deleted_ids_are_not_issued_again(spark, charts):
    root = scratch_path(spark, "floor")
    publish_initial(spark, root, charts, build_postings(charts))
    apply_to_catalogue(spark, root, reqs(spark, drop("12")))
    now = apply_to_catalogue(spark, root, reqs(spark, add(NEW)))
    assert rows(read_version(spark, root, "books", now), "book_id") == [(4,), (5,), (9,), (13,)]
    assert rows(read_version(spark, root, "issued", now), "book_id") == [(13,)]


def land(spark, inbox, *bodies):
    lines = spark.createDataFrame([(json.dumps({"seq": k, **b}),) for k, b in enumerate(bodies)], "value string")
    lines.coalesce(1).write.mode("append").text(inbox)


def test_stream_on_a_built_index_keeps_all_tables_in_step(spark, charts):
    """build_index, then requests through the stream: an added chart can be found, a fresh checkpoint goes on from the last
    version, and a replayed batch changes nothing."""
    root, inbox, checkpoint = (scratch_path(spark, n) for n in ("stream-index", "stream-in", "stream-ckpt"))
    build_index(spark, charts, root, dim=16)
    land(spark, inbox, add(NEW), drop("4"))
    run_change_stream(spark, inbox, root, checkpoint).awaitTermination()
    v = latest_version(spark, root)
    t = {n: read_version(spark, root, n, v) for n in ("books", "postings", "vectors", "vocabulary")}
    assert v == 1 and rows(t["books"], "book_id") == [(5,), (9,), (12,), (13,)] == rows(t["vectors"], "book_id")
    assert rows(t["vocabulary"]) == rows(vocabulary(build_postings(t["books"])))
    q = spark.createDataFrame([(1, "pack ice")], "query_id long, text string")
    qv = hashed_vectors(q, "query_id", q["text"], dim=16).withColumnRenamed("book_id", "query_id")
    assert [r["title"] for r in hybrid_search(q, t["postings"], t["vectors"], t["books"], qv).collect()] == ["Ice Edge"]
    run_change_stream(spark, inbox, root, checkpoint).awaitTermination()  # nothing new
    assert latest_version(spark, root) == 1
    inbox2 = scratch_path(spark, "stream-in2")
    land(spark, inbox2, add({"title": "Three"}))
    run_change_stream(spark, inbox2, root, scratch_path(spark, "stream-ckpt2")).awaitTermination()  # batch 0 of another stream
    v = latest_version(spark, root)
    assert v == 2 and rows(read_version(spark, root, "books", v), "book_id", "title")[-1] == (14, "Three")


def test_replayed_batch_finds_itself_committed(spark, charts):
    from lectern.streaming.changes import batch_writer
    root = scratch_path(spark, "replay")
    publish_initial(spark, root, charts, build_postings(charts), hashed_vectors(charts, dim=8))
    write = batch_writer(root, lambda: "s1")
    lines = spark.createDataFrame([(json.dumps({"seq": 0, **add(NEW)}),)], "value string")
    write(lines, 0)
    write(lines, 0)
    assert latest_version(spark, root) == 1 and read_version(spark, root, "books", 1).count() == 5
    write(lines, 1)
    assert read_version(spark, root, "books", 2).count() == 6


def test_lemmatised_index_through_a_change(spark, charts):
    root = scratch_path(spark, "lemma-change")
    build_index(spark, charts, root, dim=8, lemmatize=True)
    v = apply_to_catalogue(spark, root, reqs(spark, add({"title": "tide tables", "description": "passage times"}), drop("4")))
    post = {t for t, b in rows(read_version(spark, root, "postings", v)) if b == 13}
    assert "tide" in post and {t for t, b in rows(read_version(spark, root, "postings", v)) if b == 4} == set()


def files(spark, root, name, version):
    from lectern.sources.versioned import _read, manifest
    found = _read(spark, root, name, manifest(spark, root, version)[name]).inputFiles()
    return {int(f.rsplit("/bucket=", 1)[1].split("/")[0]): f for f in sorted(found)}


def test_a_batch_writes_the_buckets_it_touches(spark):
    """Copy-on-write: buckets without a touched book or token keep their files, and all tables equal a rebuild."""
    from lectern.sources.versioned import manifest
    word = lambda i: "w" + "".join(chr(97 + int(d)) for d in str(i))
    books = spark.createDataFrame([(i, "name" + word(i), f"author {word(i % 5)}", f"only{word(i)} some words", "0", 0, "g") for i in range(60)], SCHEMA)
    root = scratch_path(spark, "copy-on-write")
    embed = lambda df: hashed_vectors(df, dim=8)
    publish_initial(spark, root, books, build_postings(books), embed(books), buckets=16)
    v = apply_to_catalogue(spark, root, reqs(spark, drop("7"), edit(["11"], {"title": "renamed"}), add(NEW)))
    t = {n: read_version(spark, root, n, v) for n in ("books", "postings", "vocabulary", "vectors")}
    assert t["books"].count() == 60 and rows(t["postings"]) == rows(build_postings(t["books"]))
    assert rows(t["vocabulary"]) == rows(vocabulary(build_postings(t["books"])))
    assert rows(t["vectors"], "book_id") == rows(t["books"], "book_id")
    at = manifest(spark, root, v)
    for name, keys in (("books", [7, 11, 60]), ("vectors", [7, 11, 60])):
        touched = set(at[name].of_keys(spark.createDataFrame([(k,) for k in keys], "book_id long"), name))
        old, new = files(spark, root, name, 0), files(spark, root, name, v)
        assert 0 < len(touched) <= 3 and {b for b in old if new.get(b) != old[b]} == touched & set(old)
    old, new = files(spark, root, "postings", 0), files(spark, root, "postings", v)
    same = [b for b in old if new.get(b) == old[b]]
    assert len(same) > len(old) / 2         # a few dozen (token, book) pairs move
    # A pair that stays (an unchanged word of the edited book) moves nothing.
    pair = spark.createDataFrame([("only" + word(11), 11)], "token string, book_id long")
    assert at["postings"].of_keys(pair, "postings")[0] in old


def test_reading_the_buckets_of_a_few_tokens(spark):
    from lectern.plans.search import postings_of
    word = lambda i: "w" + "".join(chr(97 + int(d)) for d in str(i))
    books = spark.createDataFrame([(i, "name" + word(i), "a", "only" + word(i), "0", 0, "g") for i in range(200)], SCHEMA)
    root = scratch_path(spark, "pruned")
    publish_initial(spark, root, books, build_postings(books), buckets=32)
    q = spark.createDataFrame([(0, f"only{word(17)} and name{word(3)}")], "query_id long, text string")
    part, whole = postings_of(spark, root, 0, q), read_version(spark, root, "postings", 0)
    assert len(part.inputFiles()) <= 2 * 8 < len(whole.inputFiles()) / 4
    mine = f"token in ('only{word(17)}', 'name{word(3)}')"
    assert len(rows(whole.where(mine))) == 2 and rows(part.where(mine)) == rows(whole.where(mine))


def test_vocabulary_deltas_read_no_postings(spark, charts):
    from lectern.operators.postings import merge_vocabulary, vocabulary_delta
    was, now = build_postings(charts.where("book_id < 9")), build_postings(charts.where("book_id > 4"))
    delta = vocabulary_delta(was, now)
    got = merge_vocabulary(vocabulary(was), delta)
    assert rows(got) == rows(vocabulary(now)) and merge_vocabulary(vocabulary(was), vocabulary_delta(was, was.limit(0))).count() == 0


def test_lemmas_equal_a_rebuild_after_every_batch(spark):
    """A word that appears makes others its inflections, in books that the batch does not name; one that goes undoes it."""
    texts = ["wolves run", "wolves hide", "churches stand", "boxes", "two men ran", "glasses", "wolf"]
    books = spark.createDataFrame([(i, t, "", "", "0", 0, "") for i, t in enumerate(texts)], SCHEMA)
    root = scratch_path(spark, "lemma-stream")
    build_index(spark, books, root, dim=8, lemmatize=True, buckets=8)
    batches = [[add({"title": "a church and a box"}), edit(["4"], {"title": "one man"})], [drop("6"), edit(["7"], {"title": "a glass"})], [add({"title": "wolf"}), drop("2")],
               [edit(["0"], {"title": "run"})]]
    for batch in batches:
        v = apply_to_catalogue(spark, root, reqs(spark, *batch))
        got = {n: read_version(spark, root, n, v) for n in ("books", "postings", "vocabulary", "lemmas")}
        want = build_index(spark, got["books"], scratch_path(spark, "lemma-rebuild"), dim=8, lemmatize=True)
        for n in ("postings", "vocabulary", "lemmas"):
            assert rows(got[n].select(*sorted(got[n].columns))) == rows(want[n].select(*sorted(want[n].columns))), n


def _folded(books, bodies):
    """The fold as a plain loop: final rows (title, author) by id and the rejects (seq, pos, reason)."""
    live, rejected, dead = {b[0]: [b[1], b[2]] for b in books}, [], set()
    for seq, body in enumerate(bodies):
        for pos, i in enumerate(int(x) for x in body["book_ids"]):
            data = body["book_data"][pos] if "book_data" in body else None
            if body["action"] == "add_book":
                live[i] = [data.get("title", ""), data.get("author", "")]
                dead.discard(i)
            elif i not in live:
                rejected.append((seq, pos, "after delete" if i in dead else "unknown id"))
            elif body["action"] == "delete_book":
                del live[i]
                dead.add(i)
            else:
                live[i] = [data.get("title", live[i][0]), data.get("author", live[i][1])]
    return live, sorted(rejected)


def test_a_hot_id_is_folded_over_many_tasks(spark, charts):
    """A third of all changes are of one id, with upserts, edits and deletes in any order."""
    import random
    rng, bodies = random.Random(11), []
    for n in range(1500):
        i = "9" if n % 3 == 0 else str(rng.choice([4, 5, 12, 40, 41, 42]))
        kind = rng.choices(["add", "edit", "drop"], [1, 6, 2])[0]
        data = {k: f"{k} {n}" for k in ("title", "author") if rng.random() < 0.6}
        bodies.append(drop(i) if kind == "drop" else edit([i], data) if kind == "edit" else add(data, ids=[i]))
    out = apply_requests(charts, reqs(spark, *bodies))
    live, rejected = _folded(CHARTS, bodies)
    assert {k: [r["title"], r["author"]] for k, r in by_id(out.books).items()} == live
    assert rows(out.rejected, "seq", "pos", "reason") == rejected and len(rejected) > 100


def test_running_count_spreads_a_hot_key(spark):
    from pyspark.sql import functions as F
    from lectern.operators.ids import running_count
    df = spark.range(6000).select(F.when(F.col("id") % 3 > 0, F.lit(7)).when(F.col("id") % 6 == 0, F.col("id")).alias("k"), (F.col("id") / 2).cast("long").alias("at"),
                                  F.when(F.col("id") % 5 > 0, F.col("id") % 4 == 1).alias("hit"))
    got = running_count(df, "k", "at", F.col("hit"), "n").collect()
    seen, want = {}, []
    for r in sorted(df.collect(), key=lambda r: r["at"]):
        seen.setdefault(r["k"], []).append(r)
    for k, rs in seen.items():
        want += [(k or -1, r["at"], sum(bool(x["hit"]) for x in rs if x["at"] <= r["at"])) for r in rs] if k != 7 else []
    assert sorted((r["k"] or -1, r["at"], r["n"]) for r in got if r["k"] != 7) == sorted(want)
    total, hot = 0, sorted((r for r in got if r["k"] == 7), key=lambda r: r["at"])
    by_at = {}
    for r in seen[7]:
        by_at[r["at"]] = by_at.get(r["at"], 0) + bool(r["hit"])
    running = {}
    for at in sorted(by_at):
        total += by_at[at]
        running[at] = total
    assert len(hot) == 4000 and all(r["n"] == running[r["at"]] for r in hot)
    # The hot key's rows lie in several ranges, so no window holds them all.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = df.repartitionByRange("k", "at").where("k = 7").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(parts) >= 4 and max(r["count"] for r in parts) < 2000


def test_stored_rows_are_not_shuffled_to_find_the_touched_books(spark, charts, tmp_path, monkeypatch):
    from lectern.plans.index_build import build_index
    from lectern.sources.versioned import VersionWriter
    from lectern.streaming.changes import apply_to_catalogue
    build_index(spark, charts, str(tmp_path / "cat"), dim=4)
    plans, replace, auto = {}, VersionWriter.replace, spark.conf.get("spark.sql.autoBroadcastJoinThreshold")

    def seen(self, name, buckets, df):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return replace(self, name, buckets, df)
    monkeypatch.setattr(VersionWriter, "replace", seen)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the batch were above it
    try:
        some = charts.first()["book_id"]
        apply_to_catalogue(spark, str(tmp_path / "cat"), reqs(spark, edit([some], {"title": "quite another"})))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)
    assert {"books", "postings", "vectors"} <= set(plans)
    for name in ("books", "postings", "vectors"):
        assert "BroadcastHashJoin" in plans[name] and "LeftAnti" in plans[name], name
