"""Session settings the operators rely on, and the folder that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rule texts quote an apostrophe by doubling it inside a single-quoted string.
    "spark.sql.legacy.consecutiveStringLiterals.enabled": "false",
}


def build_session(app_name: str = "tagquality", **extra: str) -> SparkSession:
    """A session with the settings above; master and sizing come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`.

    Where none is named, a session on one machine gets a temporary one; on a cluster that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tagquality-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder and read from there: what follows does not repeat its plan."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()
