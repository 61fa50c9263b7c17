"""Session options, and the shared folder that holds intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_OPTIONS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    # Hot keys: the sort-merge joins here are inner, left outer or left anti with the large table on the left, the
    # shapes whose oversized partitions are split at run time.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Revenue and predictions in equal buckets of the client are joined by (client, month) without a shuffle.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


# Bytes of one shuffle partition before run-time coalescing: small enough to sort in an executor's memory.
PARTITION_BYTES = 200 * 2**20


def shuffle_partitions(shuffle_bytes: int) -> int:
    """Partitions for the largest shuffle of a job; smaller shuffles are coalesced at run time."""
    return max(200, -(-shuffle_bytes // PARTITION_BYTES))


def build_session(
    app_name: str = "tillcast", master: str | None = None, shuffle_bytes: int | None = None, **options: str
) -> SparkSession:
    """A session with this package's options; ``shuffle_bytes`` sizes the shuffles for the data at hand."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    sized = {} if shuffle_bytes is None else {"spark.sql.shuffle.partitions": str(shuffle_partitions(shuffle_bytes))}
    for key, value in {**SESSION_OPTIONS, **sized, **options}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: what the cluster names in ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tillcast-"))
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{_own_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tillcast/{spark.sparkContext.applicationId}"


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it lies."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def clean_up(spark: SparkSession) -> None:
    """Delete every intermediate table of this application. Call it when no frame made from one is read any more."""
    delete_folder(spark, _own_dir(spark))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Used where a plan reads one derived table several times: it is computed once, later scans stay columnar with
    column pruning and row-group skipping, and a lost executor costs no recomputation of what came before.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
