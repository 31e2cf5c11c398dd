"""Session settings of the engine."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int | str = 8, partitions: int = 8, memory: str = "8g", app: str = "ringfold") -> SparkSession:
    """A session on one machine, for tests and the bench; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app).config("spark.driver.memory", memory).config("spark.sql.shuffle.partitions", str(partitions))
    spark = builder.config(map=SETTINGS).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
