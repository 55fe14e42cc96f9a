"""The session that the panel plans are tuned for, and tables that are worked out once."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "panelwright", **conf: str) -> SparkSession:
    """ANSI arithmetic, adaptive plans with skew handling, and UTC; a cluster's own settings win where given."""
    builder = SparkSession.builder.appName(app)
    defaults = {
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    for key, value in (defaults | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def kept(df: DataFrame) -> DataFrame:
    """``df`` worked out once and checkpointed, so that what follows neither repeats it nor depends on its executors.

    The folder is the one that spark.checkpoint.dir names; only a session within one process may leave it unset.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or "/tmp/checkpoints")
    held = df.persist()  # else checkpointing works it out twice
    out = held.checkpoint()
    held.unpersist()
    return out
