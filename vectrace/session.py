"""Session settings the package is written for."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: UTC so that times read alike everywhere; adaptive execution to size joins and split skew at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(name: str = "vectrace", **settings: str) -> SparkSession:
    """The running session, or a new one with SETTINGS and the given settings (dots as double underscores)."""
    builder = SparkSession.builder.appName(name)
    for key, value in (SETTINGS | {k.replace("__", "."): v for k, v in settings.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir``, which all executors share; a temporary one only where the master is local."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        top = tempfile.mkdtemp()
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder as it is, rows in their partitions, and read back."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(df.sparkSession, "checkpoints"))
    return df.checkpoint(eager=True)
