"""Session settings the engine expects. Cluster settings (memory, parallelism) stay with the caller."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

#: Semantics, not tuning: UTC clocks; adaptive plans split skewed joins and merge small partitions.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def session(app: str = "corpusmill", master: str | None = None, **conf: str) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**SETTINGS, **conf}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, by ``spark.checkpoint.dir``; on a local master without it a temporary one, removed at exit."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="corpusmill-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch(spark: SparkSession) -> str:
    """A new folder below the shared one, as a path that file functions take."""
    root = shared_folder(spark)
    if "://" in root and not root.startswith("file:"):
        raise RuntimeError("named files need a shared folder that is mounted")
    at = Path(root.removeprefix("file:").replace("///", "/", 1) if root.startswith("file:") else root) / f"files-{uuid.uuid4().hex}"
    at.mkdir(parents=True)
    return str(at)
