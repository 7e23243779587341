"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Only what the results or the plans rely on; sizes of executors, memory and
# shuffle width belong to whoever submits the job.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

_fallback_root: str | None = None


def get_session(app: str = "marketlens", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or fetch) a session.  Extra settings go in ``conf`` with ``__`` written for each dot."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder with all in it; a missing one is fine."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared folder in ``spark.checkpoint.dir``.

    A machine-local folder is used only where the setting is missing and all of
    Spark runs on this machine.
    """
    global _fallback_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        _fallback_root = _fallback_root or tempfile.mkdtemp(prefix="run-", dir="/tmp")
        root = _fallback_root
    return f"{root.rstrip('/')}/marketlens/{name}-{uuid.uuid4().hex}"
