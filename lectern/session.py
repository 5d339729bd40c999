"""Session helpers: a local session for tests and benches, and the shared scratch folder.

On a cluster the session is built by the caller; nothing here overrides settings that are already present.
The scratch folder is always the one the cluster names in ``spark.checkpoint.dir``. A folder under the
system temp directory is created only in a local session where that setting is unset (tests, bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of this library wants. AQE re-plans joins with measured sizes and splits skewed
# shuffle partitions; the UI stays off because no server may be opened.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None, app: str = "lectern",
                  extra: dict | None = None) -> SparkSession:
    """A ``local[cores]`` session for tests and the bench."""
    n = os.cpu_count() if cores == "*" else int(cores)
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or max(2, 2 * n))
    conf["spark.default.parallelism"] = str(max(2, 2 * n))
    conf["spark.driver.memory"] = "8g"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session, then the folder set on the context. Only in a ``local`` session
    (tests, bench) with neither set is a folder created under the local temp directory; on a cluster that is an error,
    since executors would each write to their own disk.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="lectern-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def materialize(df, name: str = "table"):
    """Write ``df`` as a Parquet table under the shared checkpoint folder and continue from the written copy.

    A lineage cut for derived tables that several later steps read: they are computed once (a reliable
    ``checkpoint()`` without a cache would compute them twice) and survive the loss of an executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder for one written table."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"
