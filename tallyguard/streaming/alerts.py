"""The highest scores of every day, kept up to date by a stream.

The state is the table of alerts itself: at most ``k`` rows in the folder of each day. A
micro-batch is first reduced to its own ``k`` rows a day, in every task before any row moves, so
even a day that holds most of the stream arrives as a handful. These are merged with what the
table has for those days, no other days are read or written, and what changes is handed on:
which transactions were raised, which moved to another rank, which dropped out.

Merging is a union followed by the best ``k``, so rows may come late or in any order, and a batch
that is run again after a failure changes nothing. Changes are written before the table and
only once for a batch, so a repeated batch does not lose them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tallyguard.functions import quoted
from tallyguard.operators.scoring import alerts
from tallyguard.session import materialize
from tallyguard.sources.tables import write_table


def _folders(table: str) -> tuple[str, str]:
    return f"{table}/alerts", f"{table}/changes"


def _exists(spark: SparkSession, path: str) -> bool:
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(found)


def read_alerts(spark: SparkSession, table: str, columns: T.StructType) -> DataFrame:
    """The alerts so far; ``columns`` is the schema of the scored stream."""
    schema = T.StructType([*columns.fields, T.StructField("rank", T.IntegerType()), T.StructField("day", T.DateType())])
    path, _ = _folders(table)
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_changes(spark: SparkSession, table: str) -> DataFrame:
    """What has changed: ``batch, day, txn_id, p_fraud, old_rank, new_rank, change``."""
    schema = "day date, txn_id long, p_fraud double, old_rank int, new_rank int, change string, batch long"
    return spark.read.schema(schema).parquet(_folders(table)[1])


def merge_alerts(batch: DataFrame, number: int, table: str, k: int, threshold: float) -> None:
    """Take one micro-batch of scored transactions into the table."""
    spark = batch.sparkSession
    path, changes = _folders(table)
    # Rows of other days, a handful of days a batch, are neither read nor written.
    top = materialize(alerts(batch, k, threshold), "top")
    days = [r.day for r in top.select("day").distinct().collect()]
    if not days:
        return
    known = read_alerts(spark, table, batch.schema).where(F.col("day").isin(days))
    both = known.select(batch.columns).unionByName(top.select(batch.columns)).dropDuplicates(["txn_id"])
    merged = materialize(alerts(both, k, threshold), "merged")
    old = known.select("day", "txn_id", F.col("p_fraud").alias("old_p"), F.col("rank").alias("old_rank"))
    new = merged.select("day", "txn_id", "p_fraud", F.col("rank").alias("new_rank"))
    kind = F.when(F.col("old_rank").isNull(), "raised").when(F.col("new_rank").isNull(), "dropped").otherwise("moved")
    moved = old.join(new, ["day", "txn_id"], "full").where(~F.col("old_rank").eqNullSafe(F.col("new_rank")))
    changed = moved.select("day", "txn_id", F.coalesce("p_fraud", "old_p").alias("p_fraud"), "old_rank", "new_rank", kind.alias("change"))
    if not _exists(spark, f"{changes}/batch={number}/_SUCCESS"):
        changed.coalesce(1).write.mode("overwrite").parquet(f"{changes}/batch={number}")
    write_table(merged.select(*[quoted(c) for c in batch.columns], "rank", "day"), path, mode="overwrite")


def alerts_to_table(
    scored: DataFrame, table: str, checkpoint: str, k: int = 10, threshold: float = 0.5, **trigger: str
) -> StreamingQuery:
    """Keep ``table`` at the ``k`` highest scores of every day among those at or above ``threshold``.

    ``scored`` is a stream with ``txn_id``, ``ts`` and ``p_fraud``; a transaction has one score.
    """

    def merge(batch: DataFrame, number: int) -> None:
        merge_alerts(batch, number, table, k, threshold)

    writer = scored.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
