"""Sessions as a stateful stream equal the window over all entries."""

import random
import time

from conftest import rows
from lectern.operators.sessions import session_context
from lectern.streaming.sessions import ENTRY, latest_contexts, run_session_stream


def send(spark, tmp_path, entries, expire_ms=None, files=None):
    inbox = str(tmp_path / "in")
    spark.createDataFrame(entries, ENTRY).repartition(files or 1).write.mode("append").json(inbox)
    run_session_stream(spark, inbox, str(tmp_path / "out"), str(tmp_path / "check"), expire_ms, 1 if files else None).awaitTermination()
    return rows(latest_contexts(spark, str(tmp_path / "out")), "session_id", "seq", "context")


def test_late_entries_removal_reset_and_restarts(spark, tmp_path):
    assert latest_contexts(spark, str(tmp_path / "out")).count() == 0
    rng = random.Random(4)
    first = {(s, q): (s, q, rng.choice(["a", "b b", "", None, "c"]), None, rng.choice([None, False, q == 3])) for s in range(6) for q in range(8)}
    first |= {(9, q): (9, q, f"t{q}", False, False) for q in range(300)}  # a hot session
    keys = rng.sample(sorted(first), len(first))
    half = len(keys) // 2
    held = {}
    for part in (keys[:half], keys[half:]):
        held |= {k: first[k] for k in part}
        got = send(spark, tmp_path, [first[k] for k in part] + [(None, 1, "x", None, None), (1, None, "x", None, None)], files=2)
    marks = [(s, q, t, True, r) for s, q, t, _, r in rng.sample(list(first.values()), 20)] + [(2, 5, "edited", False, True)]
    got = send(spark, tmp_path, marks)
    held |= {(m[0], m[1]): m for m in marks}
    want = session_context(spark.createDataFrame(list(held.values()), ENTRY), removed="removed", reset="reset")
    assert got == rows(want, "session_id", "seq", "context")


def test_an_idle_session_is_forgotten(spark, tmp_path):
    assert send(spark, tmp_path, [(1, 0, "a", False, False), (2, 0, "x", False, False)], 1500) == [(1, 0, "a"), (2, 0, "x")]
    time.sleep(2)
    assert send(spark, tmp_path, [(1, 1, "b", False, False)], 1500) == [(1, 0, "a"), (1, 1, "b"), (2, 0, "x")]
    got = send(spark, tmp_path, [(1, 2, "c", False, False)], 60_000)
    assert (1, 2, "b. c") in got
