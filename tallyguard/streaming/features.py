"""Account features on a stream."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tallyguard.session import STATE_STORE

# The processor travels with the query: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bytes of files that a micro-batch may take when the rows of one account have to fit in
# the memory of one Python worker, even if all of them belong to it.
KEYED_BATCH = 256 << 20

LAST_SEEN = "us bigint, txn_id bigint, amount double"


class PreviousTransaction(StatefulProcessor):
    """Remembers the latest transaction of each account from one micro-batch to the next."""

    def __init__(self, columns: list[str]) -> None:
        self._columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._last = handle.getValueState("last", LAST_SEEN)

    def handleInputRows(
        self, key, rows: Iterator[pd.DataFrame], timerValues
    ) -> Iterator[pd.DataFrame]:
        # A key's rows may come in several unordered chunks; the source bounds the batch.
        # Names that are no Python names, such as one with a leading underscore, get lost.
        batch = pd.concat(list(rows), ignore_index=True)
        batch.columns = [*self._columns[:-2], "_us"]
        batch = batch.sort_values(["_us", "txn_id"], kind="stable", ignore_index=True)
        amount, micros = batch["amount"].shift(1), batch["_us"].shift(1).astype("Int64")
        fresh = pd.Series(True, index=batch.index)
        if self._last.exists():
            us, txn_id, last_amount = self._last.get()
            late = (batch["_us"] < us) | ((batch["_us"] == us) & (batch["txn_id"] < txn_id))
            fresh = ~late
            # Late rows come first, and their true predecessor is no longer known.
            amount[late], micros[late] = None, pd.NA
            first = int(late.sum())
            if first < len(batch):
                amount[first], micros[first] = last_amount, us
        if fresh.any():
            newest = batch.iloc[-1]
            known = None if pd.isna(newest["amount"]) else float(newest["amount"])
            self._last.update((int(newest["_us"]), int(newest["txn_id"]), known))
        gap = (batch["_us"].astype("Int64") - micros).astype("Float64") / 1e6
        yield batch.assign(prev_amount=amount, gap_seconds=gap)[self._columns]

    def close(self) -> None:
        pass


COMPLETE = "account_id IS NOT NULL AND ts IS NOT NULL AND txn_id IS NOT NULL"


def rejected_rows(df: DataFrame) -> DataFrame:
    """The rows that ``prev_stream`` does not take, for a sink of their own."""
    return df.where(f"NOT ({COMPLETE})")


def prev_stream(df: DataFrame) -> DataFrame:
    """``prev_features`` on a stream: previous amount and gap, by keyed state.

    Rows without account, time or id have no place in the order: they are left to
    ``rejected_rows`` and do not stop the query.

    State is one row per account, on executor disk. Rows must arrive in time order from
    one micro-batch to the next, inside a batch any order will do. A row that arrives
    after a later one of its account gets nulls. An account's rows of one batch meet in
    one Python worker: bound the batches with ``read_stream(..., batch_bytes=KEYED_BATCH)``.
    """
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    schema = T.StructType(
        [
            *df.schema.fields,
            T.StructField("prev_amount", T.DoubleType()),
            T.StructField("gap_seconds", T.DoubleType()),
        ]
    )
    return (
        df.where(COMPLETE)
        .withColumn("_us", F.unix_micros("ts"))
        .groupBy("account_id")
        .transformWithStateInPandas(
            PreviousTransaction(schema.names), schema, outputMode="Append", timeMode="None"
        )
    )


def velocity_stream(df: DataFrame, span: str = "1 hour", lateness: str = "1 hour") -> DataFrame:
    """Count, sum and average per account and tumbling window of length ``span``.

    A window comes out once the watermark has passed its end; rows that arrive for it
    later are dropped. Each task adds up its own rows before the shuffle, so a busy
    account reaches its window as one row per task.
    """
    amount = F.col("amount").try_cast("decimal(28,8)")
    return (
        df.withWatermark("ts", lateness)
        .groupBy("account_id", F.window("ts", span))
        .agg(F.count(amount).alias("n"), F.sum(amount).alias("_sum"))
        .select(
            "account_id",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "n",
            F.col("_sum").cast("double").alias("total"),
            F.when(F.col("n") > 0, F.col("_sum").cast("double") / F.col("n")).alias("average"),
        )
    )
