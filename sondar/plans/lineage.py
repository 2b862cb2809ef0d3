"""Cutting lineage through the cluster's shared folder.

``spark.checkpoint.dir`` names a folder every executor can reach. A table that is
read more than once is written there as parquet and read back, so that a lost
executor costs one re-read and never a recomputation of the whole plan. Tables live
in a folder of their application, which is deleted when the driver ends; folders that
a killed driver left behind are deleted by a later one when they are old.
"""

from __future__ import annotations

import atexit
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Seconds after which the folder of another application counts as left behind.
LEFT_BEHIND = 7 * 86_400
_folders: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the session; a temporary one is set only on a local master where none is named."""
    conf = spark.sparkContext.getConf()
    named = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="sondar-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _delete(spark: SparkSession, path: str) -> None:
    try:
        fs, p = _fs(spark, path)
        fs.delete(p, True)
    except Exception:  # the driver is ending: there is nobody to tell, and a later one cleans up
        pass


def app_folder(spark: SparkSession) -> str:
    """The application's own folder in the shared one; it lives as long as the driver."""
    app = spark.sparkContext.applicationId
    if app not in _folders:
        base = f"{shared_dir(spark)}/sondar"
        _folders[app] = f"{base}/{app}"
        fs, p = _fs(spark, base)
        if fs.exists(p):
            for s in fs.listStatus(p):
                if s.getModificationTime() / 1000 < time.time() - LEFT_BEHIND:
                    fs.delete(s.getPath(), True)
        atexit.register(_delete, spark, _folders[app])
    return _folders[app]


def put(spark: SparkSession, name: str, content: bytes) -> str:
    """A small file in the application's folder; its path."""
    path = f"{app_folder(spark)}/{name}"
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()
    return path


def written(df: DataFrame, label: str = "t") -> DataFrame:
    """df written once to the shared folder, read back with the same schema."""
    spark = df.sparkSession
    path = f"{app_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
