"""Shared scratch space and small helpers of the corpus operators."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"
_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` of the session.

    Where the session names none and runs in one process (tests), a folder of our own is made and set; a
    cluster without that setting is an error, as a machine-local folder would be read by other machines.
    """
    named = spark.conf.get(_CONF, None)
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"{_CONF} must name a folder that all executors share")
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="lodeweave-")
        spark.sparkContext.setCheckpointDir(_OWN[app])
    return _OWN[app]


def delete(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder through Hadoop's file system interface."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def scratch(spark: SparkSession, what: str) -> str:
    """A new folder name in the shared folder; it is removed when the process ends."""
    path = f"{shared_dir(spark)}/lodeweave/{what}-{uuid.uuid4().hex}"

    def drop() -> None:
        try:
            delete(spark, path)
        except Exception:  # noqa: BLE001 - the JVM may be gone already
            pass

    atexit.register(drop)
    return path


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        out.append(n)
    return out


def written(df: DataFrame, what: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet to the shared folder and read it again."""
    path = scratch(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
