"""Streams with hot accounts against the batch features, over batches, a restart and a repeated batch."""

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from conftest import assert_close, rows
from tallyguard.operators.history import SPANS, account_features
from tallyguard.operators.hot import Skew
from tallyguard.schema import TRANSACTIONS
from tallyguard.streaming.hot import features_to_table, read_features, take_batch

AT = datetime(2024, 1, 1, tzinfo=timezone.utc)
FORCED = Skew(hot_rows=50, chunk_rows=60)
COLUMNS = ["prev_amount", "gap_seconds", *[f"{w}_{s}" for w in ("n", "sum", "avg") for s in SPANS], "hist_n", "hist_mean", "hist_sd", "z_amount", "hour"]


def transactions(spark, n=900):
    """One account has nine rows in ten; several rows share an instant."""
    made = [
        (i, 1 if i % 10 else 2 + i % 3, AT + timedelta(minutes=i * 23 - i % 4), None if i % 50 == 7 else 1e28 if i % 90 == 3 else 5.0 + i * 7 % 31, "card", None)
        for i in range(n)
    ]
    return spark.createDataFrame([(*r[:5], 1) for r in made], TRANSACTIONS)


def land(df, folder, name):
    df.coalesce(1).write.parquet(str(folder / name))


def stream(spark, folder):
    return spark.readStream.schema(TRANSACTIONS).option("maxFilesPerTrigger", "1").parquet(f"{folder}/*")


def told(df):
    return rows(df.select("txn_id", "account_id", "ts", "amount", *COLUMNS))


def test_hot_account_over_batches_and_a_restart(spark, tmp_path):
    everything, folder = transactions(spark), tmp_path / "in"
    folder.mkdir()
    jitter = F.col("txn_id") + F.pmod(F.xxhash64("txn_id"), F.lit(40))  # some hours
    parts = [everything.where((jitter >= a) & (jitter < b)) for a, b in ((0, 300), (300, 310), (310, 700), (700, 2000))]
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    for n in (0, 1):
        land(parts[n], folder, f"f{n}")
    features_to_table(stream(spark, folder), out, log, timedelta(days=1), FORCED).awaitTermination()
    for n in (2, 3):
        land(parts[n], folder, f"f{n}")
    features_to_table(stream(spark, folder), out, log, timedelta(days=1), FORCED).awaitTermination()
    found = read_features(spark, out)
    assert found.select("batch").distinct().count() == 4 and found.where("late").count() == 0
    reached = everything.agg(F.max(F.unix_micros("ts"))).first()[0] - 86_400_000_000
    assert_close(told(found), told(account_features(everything).where(F.unix_micros("ts") <= reached)))


def test_late_rows_and_a_repeated_batch(spark, tmp_path):
    everything, out, hour = transactions(spark, 300), str(tmp_path / "out"), timedelta(hours=1)
    late = everything.where("txn_id IN (20, 21)")
    first = everything.where("txn_id < 200 AND txn_id NOT IN (20, 21)")
    second = everything.where("txn_id >= 200").unionByName(late).unionByName(everything.limit(1).withColumn("ts", F.lit(None).cast("timestamp")))
    take_batch(first, 0, out, hour, FORCED, SPANS)
    for _ in range(2):
        take_batch(second, 1, out, hour, FORCED, SPANS)
    found = read_features(spark, out)
    assert sorted(r.txn_id for r in found.where("late").collect()) == [20, 21]
    assert found.where("late AND hist_n IS NOT NULL").count() == 0
    reached = everything.agg(F.max(F.unix_micros("ts"))).first()[0] - 3_600_000_000
    on_time = everything.where("txn_id NOT IN (20, 21)")
    assert_close(told(found.where("NOT late")), told(account_features(on_time).where(F.unix_micros("ts") <= reached)))
