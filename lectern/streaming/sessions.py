"""Live search sessions (X5, S11) as a stateful stream: one keyed state per session holds its entries, so a new entry costs
its own session only, not the whole history of all sessions.

Entries ``(session_id, seq, text, removed, reset)`` land as JSON lines. An entry that comes again under its seq replaces the
earlier one: with ``removed`` it leaves every context (taking one entry out of the history), with ``reset`` the history
starts anew at it. Entries may come late. Whatever changes, the contexts from the earliest changed entry on are given out
again; ``latest_contexts`` reads the last one of each entry, which equals ``session_context`` over all entries.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lectern.operators.sessions import SEPARATOR
from lectern.sources.readers import path_is_missing

ENTRY = "session_id long, seq long, text string, removed boolean, reset boolean"
_EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
_STATE = "seqs array<long>, texts array<string>, removed array<boolean>, resets array<boolean>, seen long"
CONTEXT = "session_id long, seq long, text string, removed boolean, reset boolean, context string"


def _session_step(expire_ms: int | None):
    """One session's new entries against its state; gives the rows from the earliest new entry on."""
    def step(key, frames, state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        now = state.getCurrentProcessingTimeMs()
        held = {}
        if state.exists:
            seqs, texts, removed, resets, seen = state.get
            # A session with new entries is not timed out by the engine, however long it was idle.
            if expire_ms is None or now - seen <= expire_ms:
                held = {s: (t, r, x) for s, t, r, x in zip(seqs, texts, removed, resets)}
        came = {}
        for f in frames:
            for r in f.itertuples(index=False):
                new = (None if pd.isna(r.text) else r.text, r.removed is not None and bool(r.removed), r.reset is not None and bool(r.reset))
                old = came.get(r.seq)
                came[r.seq] = new if old is None else max(old, new, key=lambda e: (e[1], e[2], e[0] or ""))
        held.update(came)
        order, first, live, out = sorted(held), min(came), [], []
        for s in order:
            text, removed, reset = held[s]
            live = [] if reset else live
            if text is not None and not removed:
                live.append(text)
            if s >= first:
                out.append((key[0], s, text, removed, reset, SEPARATOR.join(live)))
        texts, removed, resets = (list(c) for c in zip(*[held[s] for s in order]))
        state.update(([int(s) for s in order], texts, removed, resets, now))
        if expire_ms is not None:
            state.setTimeoutDuration(expire_ms)
        yield pd.DataFrame(out, columns=["session_id", "seq", "text", "removed", "reset", "context"])
    return step


def streamed_contexts(entries: DataFrame, expire_ms: int | None = None) -> DataFrame:
    """X5 over a stream of ``ENTRY`` rows: ``CONTEXT`` rows in update mode.

    A session that gets nothing for ``expire_ms`` is forgotten; its next entry starts a new history (None: kept for good).
    Null marks count as false, a null text adds nothing, rows without session or seq belong to no session and are left
    out. Of rows with one seq in one batch a removal wins, then a reset, then the greater text. A session's entries meet
    in one task, as its contexts need all of them; sessions spread over the shuffle's partitions.
    """
    step = _session_step(expire_ms)
    timeout = GroupStateTimeout.NoTimeout if expire_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    return (entries.where("session_id is not null and seq is not null").groupBy("session_id")
            .applyInPandasWithState(step, CONTEXT, _STATE, "update", timeout))


def run_session_stream(spark: SparkSession, inbox: str, out: str, checkpoint: str, expire_ms: int | None = None,
                       files_per_batch: int | None = None):
    """Process the entry files present in ``inbox`` (``availableNow``); contexts go to ``out`` in one folder per batch, which a
    replayed batch writes over. A new run from the same ``checkpoint`` goes on with the sessions' state."""
    reader = spark.readStream.schema(ENTRY)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={batch_id}")
    stream = (streamed_contexts(reader.json(inbox), expire_ms).writeStream.foreachBatch(save).outputMode("update")
              .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    # Timeouts ask for another batch all the time; without this an availableNow run never ends. The query takes its
    # settings over when it starts.
    before = spark.conf.get(_EMPTY_BATCHES)
    spark.conf.set(_EMPTY_BATCHES, "false")
    try:
        return stream.start()
    finally:
        spark.conf.set(_EMPTY_BATCHES, before)


def latest_contexts(spark: SparkSession, out: str) -> DataFrame:
    """The last context given for each entry (``CONTEXT`` columns); none where nothing was streamed yet."""
    try:
        rows = spark.read.schema(CONTEXT + ", batch long").parquet(out)
    except Exception as e:  # noqa: BLE001 - the Spark error class differs by version
        if not path_is_missing(e):
            raise
        return spark.createDataFrame([], CONTEXT)
    last = F.max_by(F.struct("text", "removed", "reset", "context"), "batch")
    return rows.groupBy("session_id", "seq").agg(last.alias("e")).select("session_id", "seq", "e.*")
