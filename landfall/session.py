"""Session settings the library is tuned for, and the shared folder its written intermediates use."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    # Call sites recorded per column expression cost several round trips to the JVM each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(app: str = "landfall", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the library's settings; on a cluster the submitter's own settings stay in force."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or one below the warehouse, which is shared too."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"


def work_path(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/landfall/{purpose}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def scratch(spark: SparkSession, purpose: str) -> Iterator[str]:
    """A work path that a job removes once its results are written elsewhere."""
    path = work_path(spark, f"scratch-{purpose}")
    try:
        yield path
    finally:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
