"""Tables that a job writes on the way."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Paths that were given out, by application.
_given: dict[str, list[str]] = {}


def path(spark: SparkSession, label: str) -> str:
    """A new path in the folder that all executors share, ``spark.checkpoint.dir``; a temporary one where that is unset and Spark is one local process."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = tempfile.mkdtemp(prefix="meridian-")
        spark.sparkContext.setCheckpointDir(where)
    at = f"{where}/{label}-{uuid.uuid4().hex}"
    _given.setdefault(spark.sparkContext.applicationId, []).append(at)
    return at


def written(df: DataFrame, label: str) -> DataFrame:
    """``df``, written once and read back: its lineage ends there."""
    at = path(df.sparkSession, label)
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def clean(spark: SparkSession) -> int:
    """Delete what was written under the paths of this application, and return how many there were; results that are read from them must be written by then."""
    context = spark.sparkContext
    paths = _given.pop(context.applicationId, [])
    for at in paths:
        where = context._jvm.org.apache.hadoop.fs.Path(at)
        where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)
    return len(paths)
