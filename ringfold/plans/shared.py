"""Shared working storage: lineage is cut by tables that every executor can read."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; only where it is unset on one machine (tests), a local one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + os.path.join(tempfile.gettempdir(), "ringfold-shared")
    return folder.rstrip("/")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it again.

    A lost executor costs the tasks it ran and nothing before the table.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/ringfold-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Remove the folder that a table of cut() was read from."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/ringfold-" in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def published(spark: SparkSession, path: str, schema) -> DataFrame:
    """The newest complete version of a table that publish() wrote, or no rows if there is none."""
    found = _versions(spark, path)
    return spark.read.schema(schema).parquet(found[-1]) if found else spark.createDataFrame([], schema)


def publish(df: DataFrame, path: str) -> None:
    """Write df as the next version of a table. Readers see the old version until the new one is complete; the one before last goes."""
    spark = df.sparkSession
    have = _versions(spark, path)
    number = int(have[-1].rsplit("=", 1)[1]) + 1 if have else 0
    df.write.parquet(f"{path}/version={number:012d}")
    for old in have[:-1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(old)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _versions(spark: SparkSession, path: str) -> list[str]:
    jvm = spark._jvm
    top = jvm.org.apache.hadoop.fs.Path(path)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(top):
        return []
    names = [x.getPath().toString() for x in fs.listStatus(top)]
    return sorted(n for n in names if "/version=" in n and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{n}/_SUCCESS")))


def exists(spark: SparkSession, path: str) -> bool:
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    return top.getFileSystem(spark._jsc.hadoopConfiguration()).exists(top)
