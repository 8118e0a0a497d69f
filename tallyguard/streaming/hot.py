"""Account features of a stream with hot accounts: no account has to fit into one worker.

``account_stream`` keeps an account's state in one place, so all its rows of a micro-batch meet
there. Here the state is a few tables, written anew by every micro-batch in a folder of its own:

* ``waiting``: rows that the watermark has not passed yet,
* ``recent`` and ``older``: what later rows can still see, as in ``plans.incremental``,
* ``reached``: how far the watermark has come.

A micro-batch releases the waiting rows that the watermark now passes and gives them their features
by the windows of the batch job, with the recent rows before them. There an account above
``Skew.hot_rows`` is cut into slices of time, each slice is worked on by itself, and a few totals
are carried from slice to slice; the history is merged with the moments of the older rows. All of
it stays inside the JVM.

A batch reads the state that the one before it has left and overwrites its own state and its own
rows, so running it again after a failure gives the same.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyguard.operators.history import SPANS, account_features
from tallyguard.operators.hot import Skew
from tallyguard.plans.incremental import empty_moments, read_state, with_history, write_state
from tallyguard.session import materialize
from tallyguard.streaming.features import COMPLETE

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def _state(out: str, number: int) -> str:
    return f"{out}/state/batch-{number:012d}"


def read_features(spark: SparkSession, out: str) -> DataFrame:
    """All rows that have come out, with the ``batch`` that released them."""
    return spark.read.parquet(f"{out}/features")


def take_batch(batch: DataFrame, number: int, out: str, lateness: timedelta, skew: Skew, spans: dict[str, int]) -> None:
    """Take micro-batch ``number``: release what its watermark passes, and leave the state for the next."""
    spark = batch.sparkSession
    us = F.unix_micros("ts")
    rows = materialize(batch.where(COMPLETE), "arrived")
    if number:
        path = _state(out, number - 1)
        reached = spark.read.parquet(f"{path}/reached").first().us
        recent, older = read_state(spark, path, rows.schema)
        waiting = spark.read.schema(rows.schema).parquet(f"{path}/waiting")
    else:
        reached, recent, older, waiting = 0, rows.where("false"), empty_moments(spark), rows.where("false")
    newest = rows.agg(F.max(us)).first()[0]
    now = max(reached, (newest or 0) - int(lateness.total_seconds() * 1_000_000))
    late = rows.where(us <= reached)
    pool = waiting.unionByName(rows.where(us > reached))
    both = recent.withColumn("_new", F.lit(False)).unionByName(pool.where(us <= now).withColumn("_new", F.lit(True)))
    both = materialize(both, "released")
    featured = account_features(both, spans, skew).where("_new").drop("_new")
    made = with_history(featured, older).withColumn("late", F.lit(False))
    missed = late.select(*[F.col(c) if c in late.columns else F.lit(None).cast(kind).alias(c) for c, kind in made.dtypes if c != "late"])
    made = made.unionByName(missed.withColumn("late", F.lit(True)))
    made.write.mode("overwrite").parquet(f"{out}/features/batch={number}")
    path = _state(out, number)
    pool.where(us > now).write.mode("overwrite").parquet(f"{path}/waiting")
    write_state(both.drop("_new"), older, _EPOCH + timedelta(microseconds=now), spans, path)
    spark.createDataFrame([(now,)], "us long").coalesce(1).write.mode("overwrite").parquet(f"{path}/reached")


def features_to_table(
    source: DataFrame,
    out: str,
    checkpoint: str,
    lateness: timedelta = timedelta(hours=1),
    skew: Skew = Skew(),
    spans: dict[str, int] | None = None,
    **trigger: str,
) -> StreamingQuery:
    """Write ``account_features`` of a stream of transactions to ``out``; late rows are marked.

    Rows may be out of order by ``lateness``. ``out`` and ``checkpoint`` belong together, and
    earlier states may be removed by age. Ids must not repeat.
    """

    def take(batch: DataFrame, number: int) -> None:
        take_batch(batch, number, out, lateness, skew, spans or SPANS)

    writer = source.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
