"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A session for tests and benches; on a cluster the submitter configures Spark."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("recordloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


#: Folders made in this session, and the base of a local session that names none, by application id.
_MADE: dict[str, list[str]] = {}
_LOCAL_BASE: dict[str, str] = {}


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    The setting names storage that every executor can reach, and a cluster must have it.  Only with a
    ``local`` master, where driver and executors are one process, is a folder of its own made if it is unset.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    app = spark.sparkContext.applicationId
    if not base:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        if app not in _LOCAL_BASE:
            _LOCAL_BASE[app] = tempfile.mkdtemp(prefix="recordloom-")
        base = _LOCAL_BASE[app]
    folder = os.path.join(base, f"{purpose}-{uuid.uuid4().hex}")
    _MADE.setdefault(app, []).append(folder)
    return folder


def release(spark: SparkSession) -> int:
    """Delete the work folders this session has made, once no DataFrame needs them; returns their number."""
    made = _MADE.pop(spark.sparkContext.applicationId, [])
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in made:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
    return len(made)


def landed(df, purpose: str, compact: bool = False):
    """Write ``df`` once to the shared folder and read it back: a lineage cut that
    survives the loss of executors and lets several consumers share one computation.
    ``compact`` files take more CPU time and memory to write (zstd), which pays for rows with hex ids."""
    path = work_folder(df.sparkSession, purpose)
    writer = df.write.option("compression", "zstd") if compact else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
