"""Session settings and the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# RocksDB keeps keyed stream state on executor disk instead of in the JVM heap.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "tallyguard", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC timestamps and adaptive execution; ``conf`` overrides any setting.

    Memory, cores and shuffle partitions belong to the cluster, so none is set here.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Hours, weekdays and days are taken in the session zone; refuse any but UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, not {zone!r}")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new path in the session's work folder ``spark.checkpoint.dir``.

    Every executor must reach that folder, so none is made up where it is not set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Boosted trees checkpoint their running residuals; give them the shared folder."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark, "rdd"))


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder as Parquet and read it back.

    Unlike a cached or locally checkpointed frame the table outlives lost executors,
    and later reads prune its columns.
    """
    spark = df.sparkSession
    path = shared_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
