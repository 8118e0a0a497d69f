"""Transactions as a stream of files, scored as they land."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyguard.operators.scoring import score
from tallyguard.schema import EVENTS
from tallyguard.session import require_utc
from tallyguard.sources.tables import canonical


def read_stream(
    spark: SparkSession,
    folder: str,
    files: str = "*.parquet",
    batch_bytes: int = 16 << 30,
    **options: str,
) -> DataFrame:
    """Event files of ``folder`` as a stream of transactions.

    A micro-batch takes at most ``batch_bytes`` of files, so a backlog is worked off in
    steps of bounded size. ``maxFilesPerTrigger`` among the options takes its place.
    """
    require_utc(spark)
    limits = {} if "maxFilesPerTrigger" in options else {"maxBytesPerTrigger": str(batch_bytes)}
    settings = {"pathGlobFilter": files, **limits, **options}
    return canonical(spark.readStream.schema(EVENTS).options(**settings).parquet(folder))


def run_to_parquet(
    stream: DataFrame,
    sink: str,
    checkpoint: str,
    available_now: bool = True,
    by: str | None = None,
    **trigger: str,
) -> StreamingQuery:
    """Start writing a stream into Parquet files, each row exactly once.

    The checkpoint holds what has been read and the sink's log which files count, so a
    restart with the same two folders goes on where the last query stopped. With ``by`` the
    files lie in a folder for each value of that column.
    """
    writer = stream.writeStream.format("parquet").outputMode("append")
    if by:
        writer = writer.partitionBy(by)
    when = trigger or ({"availableNow": True} if available_now else {"processingTime": "1 minute"})
    return writer.option("checkpointLocation", checkpoint).trigger(**when).start(sink)


def score_stream(
    model: Transformer | str, source: DataFrame, sink: str, checkpoint: str, **trigger: str
) -> StreamingQuery:
    """Score transactions as they land.

    The model may use columns of the row itself, and those of ``prev_stream``. The scores lie
    in a folder for each ``day``, so that their readers can prune.
    """
    scored = score(model, source).withColumn("day", F.to_date("ts"))
    return run_to_parquet(scored, sink, checkpoint, by="day", **trigger)
