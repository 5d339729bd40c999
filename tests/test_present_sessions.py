from lectern.operators.present import percent, relevance_band
from lectern.operators.sessions import session_context


def test_percent_and_band(spark):
    df = spark.createDataFrame([(x,) for x in [0.8, 0.8001, 0.5, 0.5001, 0.00125, -0.3]], "s double")
    got = [(r[0], r[1]) for r in df.select(percent("s").alias("p"), relevance_band(percent("s"))).collect()]
    assert got == [(80.0, "orange"), (80.01, "green"), (50.0, "red"), (50.01, "orange"), (0.13, "red"), (-30.0, "red")]


def test_session_context_with_removal_and_reset(spark):
    df = spark.createDataFrame(
        [(1, 0, "a", False, False), (1, 1, "b", True, False), (1, 2, "c", False, False), (1, 3, "d", False, True),
         (1, 4, "e", False, False), (2, 0, "x", False, False)],
        "session_id long, seq long, text string, removed boolean, reset boolean")
    got = [(r["session_id"], r["seq"], r["context"]) for r in
           session_context(df, removed="removed", reset="reset").orderBy("session_id", "seq").collect()]
    assert got == [(1, 0, "a"), (1, 1, "a"), (1, 2, "a. c"), (1, 3, "d"), (1, 4, "d. e"), (2, 0, "x")]
