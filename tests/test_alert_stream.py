"""Alerts of a stream against those of a batch."""

from datetime import datetime, timedelta, timezone

import pytest

from conftest import rows
from tallyguard.operators.scoring import alerts
from tallyguard.streaming.alerts import alerts_to_table, merge_alerts, read_alerts, read_changes

AT = datetime(2024, 1, 1, tzinfo=timezone.utc)
SCHEMA = "txn_id long, account_id long, ts timestamp, p_fraud double"


def some_rows(n=400):
    # Days in any order, ties, and scores that are none.
    return [(i, i % 7, AT + timedelta(hours=(i * 37) % 120), [None, float("nan"), (i * 13 % 50) / 50, 0.98][0 if i % 41 == 0 else 1 if i % 43 == 0 else 3 if i % 29 == 0 else 2]) for i in range(n)]


def land(spark, part, folder, name):
    folder.mkdir(exist_ok=True)
    spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(str(folder / name))


def drained(spark, folder, tmp_path):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", "1").parquet(f"{folder}/*")
    alerts_to_table(stream, str(tmp_path / "table"), str(tmp_path / "log"), k=5, threshold=0.3).awaitTermination()
    return read_alerts(spark, str(tmp_path / "table"), stream.schema)


def told(df):
    return [(r["day"], r["rank"], r["txn_id"], r["p_fraud"]) for r in rows(df, "day", "rank")]


def test_stream_equals_batch_over_batches_and_a_restart(spark, tmp_path):
    data = some_rows()
    for part in range(3):
        land(spark, data[part::4], tmp_path / "in", f"f{part}")
    first = told(drained(spark, tmp_path / "in", tmp_path))
    assert first == told(alerts(spark.createDataFrame([r for i, r in enumerate(data) if i % 4 != 3], SCHEMA), 5, 0.3))
    land(spark, data[3::4], tmp_path / "in", "f3")  # later files hold rows of all the earlier days
    found = told(drained(spark, tmp_path / "in", tmp_path))
    assert found == told(alerts(spark.createDataFrame(data, SCHEMA), 5, 0.3)) != first
    # The changes, one after the other, lead to the table.
    ranks = {}
    for change in rows(read_changes(spark, str(tmp_path / "table")), "batch", "change"):
        key = (change["day"], change["txn_id"])
        assert ranks.get(key) == change["old_rank"]
        assert change["change"] == ("raised" if change["old_rank"] is None else "dropped" if change["new_rank"] is None else "moved")
        ranks[key] = change["new_rank"]
    assert {k: v for k, v in ranks.items() if v} == {(d, t): r for d, r, t, _ in found}


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    batch = spark.createDataFrame(some_rows(90), SCHEMA)
    table = str(tmp_path / "table")
    merge_alerts(batch, 0, table, 3, 0.5)
    first, changes = told(read_alerts(spark, table, batch.schema)), read_changes(spark, table).count()
    merge_alerts(batch, 0, table, 3, 0.5)
    assert told(read_alerts(spark, table, batch.schema)) == first and read_changes(spark, table).count() == changes == len(first)
    merge_alerts(batch.where("p_fraud < 0.1"), 1, table, 3, 0.5)  # nothing to alert
    assert told(read_alerts(spark, table, batch.schema)) == first


def test_no_alerts_yet(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    assert read_alerts(spark, str(tmp_path / "none"), schema).count() == 0
    with pytest.raises(Exception):
        read_changes(spark, str(tmp_path / "none")).count()
