"""Where intermediate and job tables are written."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder (`spark.checkpoint.dir`).

    Only a session in one process may go without it; it then gets a folder of its own, which goes
    when the process ends. Files in the cluster's folder stay until it is cleared after the job.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return _temporary_folder(spark.sparkContext.applicationId)


@cache
def _temporary_folder(application: str) -> str:
    folder = tempfile.mkdtemp(prefix=f"candlewick-{application}-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write `df` once as Parquet and read it back.

    Cuts lineage so that a lost executor re-reads files, and fixes the rows when later
    passes must all see the same ones.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
