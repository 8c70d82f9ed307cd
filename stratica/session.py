"""Session conventions shared by every job."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join partition even where that costs a later shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a Python worker is handed this much at a time: long texts and vectors make a batch of many rows large
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
    # stream state that outgrows the heap
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the semantics rely on; cluster sizing is left to the cluster."""
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A machine-local folder is only ever chosen for a local master (tests).
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    root = tempfile.mkdtemp(prefix="stratica-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, never reused; it goes when the application ends."""
    folder = f"{shared_folder(spark)}/stratica/{label}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut a lineage with a reliable checkpoint (survives executor loss)."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
