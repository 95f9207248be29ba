"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution picks the join side to broadcast from measured sizes, splits skewed
# join partitions and merges small ones; the zone only matters where a zoned column is read.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: str = "*", app: str = "opinarium", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    settings = {
        **RECOMMENDED_CONF,
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def working_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder that every executor can reach.

    It lies under ``spark.checkpoint.dir`` or, where that is unset, under the warehouse, which
    driver and executors share as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_working"
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def removed(spark: SparkSession, folder: str) -> None:
    """Deletes a working folder that no later plan reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Computes a table once, writes it to the shared folder and reads it from there.

    Later plans see its true size, so a small one is broadcast before a large table is
    shuffled for it, and losing an executor does not bring the work back.
    """
    return stored_at(df, purpose)[0]


def stored_at(df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """The table that ``stored`` gives, and its folder."""
    path = working_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path
