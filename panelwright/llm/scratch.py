"""Intermediate tables in the folder that every executor shares.

Cutting lineage means writing a table there: a lost executor then costs a re-read, not a recomputation.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINTS = "spark.checkpoint.dir"
#: Where the session names no folder and runs in one process, as local tests do.
LOCAL_CHECKPOINTS = "/tmp/checkpoints"


def scratch_root(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names. On a cluster it has to be set: a folder of one machine won't do."""
    found = spark.conf.get(CHECKPOINTS, None)
    if not found and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError(f"set {CHECKPOINTS} to a folder that the driver and all executors share")
    return (found or LOCAL_CHECKPOINTS).rstrip("/")


#: What ``materialise`` has written within each open ``cleared``, innermost last.
_open: list[list[DataFrame]] = []


def _folder(spark: SparkSession, path: str) -> tuple:
    """The Hadoop file system and path of a table's folder."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and return a reader of what was written.

    The table goes when ``discard`` gets it, or else when the driver's JVM ends. An empty ``df`` gives an empty table of
    the same schema.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/panelwright-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{name}")
    files, where = _folder(spark, path)
    files.deleteOnExit(where)
    out = spark.read.schema(df.schema).parquet(f"{path}/{name}")
    out._scratch_path = path
    for made in _open[-1:]:
        made.append(out)
    return out


@contextmanager
def cleared() -> Iterator[list[DataFrame]]:
    """At the end, delete the tables that were written within; those taken off the list that this gives stay."""
    _open.append([])
    try:
        yield _open[-1]
    finally:
        discard(*_open.pop())


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``materialise`` that nothing reads any more."""
    for table in tables:
        files, where = _folder(table.sparkSession, table._scratch_path)
        files.delete(where, True)
