"""Written intermediate results, in the folder the cluster shares."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
#: Folders written by each application, until they are cleared.
_written: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset, one in the warehouse if all runs on
    this machine; on a cluster it must be set, as only it is known to be shared. The session is
    left as it is."""
    folder = spark.conf.get(SETTING, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {SETTING} to a folder that all executors share")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir')}/_staged"
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once and read it back.

    Cuts the lineage, survives lost executors, and gives later plans column pruning and
    file statistics. Use it where one result feeds several aggregations. The files stay until
    `clear`, as a result that is still to be computed may read them.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession, but: int = 0) -> int:
    """Delete what this application has staged, except the first `but` folders; call it when its
    results are written. Returns the number of folders."""
    paths = _written.get(spark.sparkContext.applicationId, [])
    gone, paths[but:] = paths[but:], []
    for path in gone:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return len(gone)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """What is staged inside goes at the end: the result must be written by then."""
    kept = len(_written.get(spark.sparkContext.applicationId, []))
    try:
        yield
    finally:
        clear(spark, kept)
