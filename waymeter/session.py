"""Session settings the engine relies on, and the shared folder for checkpoints and tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

POOL = "spark.scheduler.pool"

# Timestamps are instants; every truncation and text form is defined in UTC unless a zone is given.
# Stateful streams keep the plain spark.sql.shuffle.partitions, which their checkpoint fixes at the first start.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


# Of the streaming application: its queries share the executors by pool, so a short batch of one query does not wait
# behind the tasks of another's long one. `spark.scheduler.allocation.file` may give pools weights and least shares.
STREAM_SETTINGS = {"spark.scheduler.mode": "FAIR"}

# Of the applications: batch shuffles start from many partitions, which AQE merges to the size of the data.
JOB_SETTINGS = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "2000"}


def build_session(app_name: str, settings: dict[str, str] | None = None) -> SparkSession:
    """A session with the engine's settings; `settings` wins, and so does spark-submit's master."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **JOB_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def scheduler_pool(spark: SparkSession, name: str) -> Iterator[None]:
    """Jobs started here run in the pool `name`; a stream started here runs in it for good."""
    context = spark.sparkContext
    before = context.getLocalProperty(POOL)
    context.setLocalProperty(POOL, name)
    try:
        yield
    finally:
        context.setLocalProperty(POOL, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`; a temporary one only in local mode, where it is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    created = tempfile.mkdtemp(prefix="waymeter-")
    spark.conf.set("spark.checkpoint.dir", created)
    return created


def new_run_folder(spark: SparkSession, label: str) -> str:
    """A folder no other run uses, inside the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
