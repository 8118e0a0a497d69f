"""Ordered work on accounts that are too big for one task.

A window partitioned by account puts an account's whole history into one task. That is
right for nearly all accounts and wrong for one that holds a third of the table. Such hot
accounts are found by counting, and their rows are cut into chunks: ranges of
(account, time, id) of about equal size, each small enough for a task. An operator then
works inside the chunks and carries a few totals from one chunk to the next.

Every account above ``Skew.hot_rows`` is cut, and into as many chunks as its rows need.
Chunks are contiguous ranges, so there are at most (hot accounts + chunks) pairs of account
and chunk. Neither the list of hot accounts nor the table of totals is collected or forced
into a broadcast: the optimizer broadcasts them while they are small.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from tallyguard.session import materialize, shared_folder


# Rows that a task sorts when chunks are cut.
TASK_ROWS = 250_000


@dataclass(frozen=True)
class Skew:
    """When an account counts as hot, and how many rows a chunk of it should hold."""

    hot_rows: int = 1_000_000
    chunk_rows: int = 250_000


@dataclass(frozen=True)
class HotAccounts:
    """The hot accounts as a table with one column, and how many rows they have together."""

    table: DataFrame | None
    rows: int

    @property
    def any(self) -> bool:
        return self.table is not None

    def of(self, df: DataFrame, how: str) -> DataFrame:
        """The rows of hot accounts (``left_semi``) or of all others (``left_anti``)."""
        return df.join(self.table, F.col("account_id").eqNullSafe(F.col("_hot_account")), how)


def hot_accounts(df: DataFrame, skew: Skew) -> HotAccounts:
    """All accounts above ``hot_rows``; an account may be null.

    The count reads one column and is combined before its shuffle.
    """
    counted = df.groupBy("account_id").count().where(F.col("count") > skew.hot_rows)
    rows = counted.agg(F.sum("count")).first()[0]
    if not rows:
        return HotAccounts(None, 0)
    return HotAccounts(materialize(counted.select(F.col("account_id").alias("_hot_account")), "hot-accounts"), rows)


def split_hot(
    df: DataFrame,
    plain: Callable[[DataFrame], DataFrame],
    chunked: Callable[[DataFrame, int], DataFrame],
    skew: Skew,
    hot: HotAccounts | None = None,
) -> DataFrame:
    """``plain`` on ordinary accounts and ``chunked(rows of hot accounts, their number)``.

    ``hot`` saves the count when the accounts have been counted already, for instance in
    the table that ``df`` was cleaned from: an account too many there does no harm.
    """
    hot = hot or hot_accounts(df, skew)
    if not hot.any:
        return plain(df)
    return plain(hot.of(df, "left_anti")).unionByName(chunked(hot.of(df, "left_semi"), hot.rows))


def cut_into_chunks(df: DataFrame, order: list[str], rows: int, skew: Skew) -> DataFrame:
    """Add ``_chunk``, which numbers ranges of (account, ``order``) in their order.

    A task sorts one range of rows, which has nothing to do with how small chunks are, and counts
    them off by ``chunk_rows``: a task and a file for each chunk would cost more than its work.
    Rows alike in account and ``order`` stay together. Bounds of the tasks' ranges come from
    sampling, so a second run of the same plan may choose others. The rows are therefore
    written once, with their chunk, to the shared folder.
    """
    spark = df.sparkSession
    chunks = max(1, math.ceil(rows / skew.chunk_rows))
    tasks = min(chunks, max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / TASK_ROWS)))
    path = shared_folder(spark, "chunks")
    place = ["account_id", *order]
    # The task's number in the upper bits, the row's place in its range in the lower ones.
    sorted_ = df.repartitionByRange(tasks, *place).sortWithinPartitions(*place).withColumn("_at", F.monotonically_increasing_id())
    first = F.min("_at").over(Window.partitionBy(*place))
    cut = sorted_.withColumn("_at", first)
    ranged = cut.withColumn("_chunk", F.col("_at") - F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) % skew.chunk_rows).drop("_at")
    ranged.write.parquet(path)
    return spark.read.schema(ranged.schema).parquet(path)


def join_carry(df: DataFrame, carry: DataFrame) -> DataFrame:
    """Attach each chunk's carried totals; accounts may be null."""
    named = carry.withColumnsRenamed({"account_id": "_carry_account", "_chunk": "_carry_chunk"})
    return df.join(
        named,
        (F.col("_chunk") == F.col("_carry_chunk"))
        & F.col("account_id").eqNullSafe(F.col("_carry_account")),
        "left",
    ).drop("_carry_account", "_carry_chunk")
