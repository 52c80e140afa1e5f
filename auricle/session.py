"""Session settings and the shared folder used for checkpoints and written intermediates."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SESSION_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    STATE_STORE: ROCKSDB,
}


def build_session(app: str = "auricle", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs expect; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, whatever the session was built with.

    State with several variables or timers needs it. A started stream has its own copy of the settings.
    """
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as named by the cluster in spark.checkpoint.dir.

    Only a local-mode session without that setting gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="auricle-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """The frame written to the shared folder and read back.

    Spark then knows its real size, and decides by that whether to broadcast it.
    """
    path = run_dir(df.sparkSession, "staged")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def durable(df: DataFrame) -> DataFrame:
    """Cut lineage through a reliable checkpoint, so lost executors cannot change the rows."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
