"""Seeded labelled transactions of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyguard.functions import hash32, sigmoid, unit_hash

# Kinds of transaction, first second and number of seconds covered.
CHANNELS = ["atm", "card", "online", "pos", "transfer"]
START = 1704067200
SECONDS = 30 * 86400


def synth_columns(
    ids: DataFrame, accounts: int, seed: int, hot_share: float = 0.0, id_column: str = "id"
) -> DataFrame:
    """Give every id a transaction, each column a function of (seed, id) alone.

    So the rows do not depend on how ``ids`` is partitioned, and a lost task rebuilds the
    same ones. ``hot_share`` of the rows go to account 0 to rehearse skew.
    """

    def salted(tag: str) -> Column:
        return F.concat(F.lit(f"{seed}:{tag}:"), F.col(id_column).cast("string"))

    account = F.pmod(hash32(salted("account")), F.lit(accounts)) + 1
    amount = F.greatest(F.lit(0.01), F.round(-50.0 * F.ln(1.0 - unit_hash(salted("amount"))), 2))
    kinds = F.array(*map(F.lit, CHANNELS))
    return ids.select(
        F.col(id_column).cast("long").alias("txn_id"),
        F.when(unit_hash(salted("hot")) < hot_share, F.lit(0).cast("long"))
        .otherwise(account)
        .alias("account_id"),
        F.timestamp_seconds(START + F.pmod(hash32(salted("ts")), F.lit(SECONDS))).alias("ts"),
        amount.alias("amount"),
        F.get(kinds, F.pmod(hash32(salted("channel")), F.lit(len(CHANNELS))).cast("int")).alias(
            "channel"
        ),
        F.pmod(hash32(salted("device")), F.lit(100)).cast("int").alias("device_k"),
    ).withColumn(
        "is_fraud",
        (
            unit_hash(F.concat(F.lit(f"{seed}:fraud:"), F.col("txn_id").cast("string")))
            < sigmoid(-4.0 + 0.03 * F.col("amount"))
        ).cast("int"),
    )


def synth_transactions(
    spark: SparkSession, n: int, accounts: int, seed: int, hot_share: float = 0.0
) -> DataFrame:
    """``n`` synthetic transactions over ``accounts`` accounts."""
    return synth_columns(spark.range(n), accounts, seed, hot_share)
