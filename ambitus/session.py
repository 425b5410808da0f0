"""Session helpers: building a local session and cutting lineage safely."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "ambitus", cpus: int | None = None, **conf: str) -> SparkSession:
    """A local session for tests and the bench; on a cluster the session is the caller's."""
    n = cpus or os.cpu_count() or 2
    builder = SparkSession.builder.master(f"local[{n}]").appName(app)
    settings = {
        "spark.sql.shuffle.partitions": str(n), "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false",
        "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false", "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | conf
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints: the session's ``spark.checkpoint.dir``.  Where it is unset a temporary folder serves in a
    local session; on a cluster, whose executors could not read it, that is an error."""
    sc = spark.sparkContext
    own = sc.getCheckpointDir()
    if own:
        return own
    told = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not told and not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(told or tempfile.mkdtemp(prefix="ambitus-checkpoint-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """The same rows, computed once and kept in the shared checkpoint folder: later reads survive a lost executor."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
