"""Compare each registered Spark query with its DuckDB oracle SQL (row count, column names, values).

Usage: ``python tests/oracle_compare.py [sf_dir] [name ...]``. Also used by ``tests/test_oracle.py``.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    import pandas as pd
    if v is None or v is pd.NA or v is pd.NaT:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        if v.is_integer() and abs(v) < 2 ** 53:  # pandas shows a nullable integer column as floats
            return str(int(v))
        return repr(round(v, 9))
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except (ValueError, AttributeError):
            pass
    if isinstance(v, (list, tuple)) or (hasattr(v, "tolist") and not isinstance(v, str)):
        return "[" + ",".join(_norm(x) for x in list(v)) + "]"
    return str(v)


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    out.sort()
    return cols, out


def compare(spark, con, name: str, fn, sql: str | None, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    spdf = sdf.toPandas()
    t_spark = time.time() - t0
    res = {"name": name, "spark_rows": len(spdf), "spark_sec": round(t_spark, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    t1 = time.time()
    dpdf = con.execute(sql).df()
    res["duck_sec"] = round(time.time() - t1, 2)
    res["duck_rows"] = len(dpdf)
    scols, srows = rows_of(spdf)
    dcols, drows = rows_of(dpdf)
    if scols != dcols:
        res["status"] = f"COLUMNS {scols} vs {dcols}"
    elif len(srows) != len(drows):
        res["status"] = "ROWCOUNT"
    elif srows != drows:
        diff = [(a, b) for a, b in zip(srows, drows) if a != b][:3]
        res["status"] = f"VALUES e.g. {str(diff)[:600]}"
    else:
        res["status"] = "ok"
    sty = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    res["types"] = {c: (sty.get(c), str(dpdf[c].dtype)) for c in dcols if c in sty}
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from lectern.session import local_session
    import __spark_entry__ as E
    if os.environ.get("PLAIN_SESSION"):
        from pyspark.sql import SparkSession  # the driver's kind of session: defaults only
        spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
                 .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    else:
        spark = local_session(os.environ.get("COMPARE_CORES", "8"), 8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as e:  # report and continue
            r = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(r, flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
