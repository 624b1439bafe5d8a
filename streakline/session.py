"""Session settings and the shared folder for tables a job writes on its way."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, app: str = "streakline", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which every executor must reach.

    Only a local session, where driver and executors are one process, may
    leave it unset; it then gets a fresh temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="streakline-")


_written: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path no other run uses, below the shared folder."""
    folder = f"{shared_folder(spark)}/streakline/{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(folder)
    return f"{folder}/{name}"


def remove_scratch(spark: SparkSession) -> int:
    """Deletes the scratch folders of this application, once nothing reads them any more; how many there were."""
    folders = _written.pop(spark.sparkContext.applicationId, [])
    for folder in folders:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return len(folders)
