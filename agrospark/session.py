"""Session helpers.

Cluster settings (shuffle partitions, checkpoint dir, executor sizing) belong to whoever
launches the job; these helpers only fill in what is unset, which is the case in tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(cpus: int | str | None = None, app: str = "agrospark", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; on a cluster use the launcher's session."""
    cpus = cpus or os.environ.get("BENCH_CPUS") or "*"
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
    b = b.config("spark.driver.memory", os.environ.get("AGROSPARK_DRIVER_MEMORY", "16g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Where the setting is absent, the folder given to ``setCheckpointDir`` counts. With neither, a
    local master (tests) gets a private folder; on a cluster that is an error, since executors
    would not see a folder of the driver's machine.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = "file://" + tempfile.mkdtemp(prefix="agrospark-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def written(df):
    """``df`` written as Parquet to the shared checkpoint folder and read back. Unlike a checkpoint the result carries no
    partitioning or ordering of the old plan, so it can be joined with parts of itself."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/written-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df):
    """Reliable checkpoint (never localCheckpoint): survives executor loss."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
