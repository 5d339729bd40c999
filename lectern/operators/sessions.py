"""Search sessions (X5, P11): each submitted query joins the session history and the whole history is searched.

A session is a table ``(session_id, seq, text)`` with optional marks: ``removed`` (an entry taken out of the
history) and ``reset`` (the history is cleared before this entry). The context of an entry is its run's live
texts so far joined with ". " — an ordered running window per session, no collect to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEPARATOR = ". "


def join_queries(queries: Column | str, sep: str = SEPARATOR) -> Column:
    """One query string from a request's list of queries."""
    return F.array_join(F.col(queries) if isinstance(queries, str) else queries, sep)


def session_context(entries: DataFrame, session: str = "session_id", seq: str = "seq", text: str = "text",
                    removed: str | None = None, reset: str | None = None) -> DataFrame:
    """``context`` = the live history up to and including each entry, joined with ". ".

    ``removed`` (boolean) hides an entry from every context (it stays a row so positions are kept); ``reset``
    (boolean) starts a new run at that entry. The window is ordered by ``seq`` inside ``session`` (and run).
    """
    df = entries
    parts = [session]
    if reset is not None:
        runs = Window.partitionBy(session).orderBy(seq).rowsBetween(Window.unboundedPreceding, 0)
        df = df.withColumn("_run", F.sum(F.when(F.col(reset), 1).otherwise(0)).over(runs))
        parts.append("_run")
    live = F.col(text) if removed is None else F.when(~F.coalesce(F.col(removed), F.lit(False)), F.col(text))
    w = Window.partitionBy(*parts).orderBy(seq).rowsBetween(Window.unboundedPreceding, 0)
    out = df.withColumn("context", F.array_join(F.collect_list(live).over(w), SEPARATOR))
    return out.drop("_run") if reset is not None else out
