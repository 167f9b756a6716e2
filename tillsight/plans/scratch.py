"""Shared scratch space for staged tables and exports.

Staged data must survive the loss of any executor, so it lives in the shared
folder the cluster names in ``spark.checkpoint.dir``.  Only a local-mode
session (tests, a laptop) without that setting gets a fresh temporary folder,
which is then also registered as the checkpoint dir.  Every run takes its
own uniquely named sub-folder, which it may discard when it is done.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR_CONF = "spark.checkpoint.dir"


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None for a Spark Connect client."""
    try:
        return spark.sparkContext
    except (AttributeError, PySparkException):  # Connect sessions have no driver-side context
        return None


def checkpoint_root(spark: SparkSession) -> str:
    sc = _context(spark)
    if sc is None:
        root = spark.conf.get(CHECKPOINT_DIR_CONF, None)
        if not root:
            raise RuntimeError(f"{CHECKPOINT_DIR_CONF} is not set on the Spark server")
        return root.rstrip("/")
    root = sc.getConf().get(CHECKPOINT_DIR_CONF, None) or sc.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            f"{CHECKPOINT_DIR_CONF} is not set: staged tables need a shared folder on a cluster"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tillsight-checkpoints-"))
    return sc.getCheckpointDir().rstrip("/")


def new_run_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, never reused folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/tillsight/{purpose}-{uuid.uuid4().hex}"


def stage(spark: SparkSession, df: DataFrame, purpose: str, paths: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint root and read it back;
    ``paths`` gets the folder, for the caller to discard."""
    path = new_run_dir(spark, purpose)
    if paths is not None:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.parquet(path)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete staged folders of this run, through the file system they are on."""
    sc = _context(spark)
    if sc is None:
        return
    for path in paths:
        at = sc._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)
