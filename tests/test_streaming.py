from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, assert_close, rows
from tallyguard.functions import sigmoid
from tallyguard.operators.history import SPANS, account_features, plant_fraud, prev_features
from tallyguard.operators.scoring import score
from tallyguard.operators.training import train_logistic
from tallyguard.plans.job import find_best, score_stream_best, train
from tallyguard.schema import EVENTS
from tallyguard.sources.tables import canonical
from tallyguard.streaming import account_stream, prev_stream, read_stream, run_to_parquet, score_stream, velocity_stream

AT = datetime(2024, 1, 1, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.schema(EVENTS).parquet(f"{SMALL}/events.parquet")


def land(df, folder, name):
    """Put ``df`` into the folder as one file."""
    df.coalesce(1).write.parquet(str(folder.parent / f"_{name}"))
    folder.mkdir(exist_ok=True)
    (part,) = (folder.parent / f"_{name}").glob("part-*.parquet")
    (folder / f"{name}.parquet").write_bytes(part.read_bytes())


def one_file(spark, folder):
    return read_stream(spark, str(folder), maxFilesPerTrigger="1")


def run(stream, tmp_path):
    query = run_to_parquet(stream, str(tmp_path / "sink"), str(tmp_path / "log"))
    query.awaitTermination()
    return [p for p in query.recentProgress if p.numInputRows], stream.sparkSession.read.schema(
        stream.schema
    ).parquet(str(tmp_path / "sink"))


def event(i, minute, account=1, value=10.0):
    return (i, AT + timedelta(minutes=minute), account, "card", value, "{}")


def test_previous_over_batches_and_a_restart(spark, events, small, tmp_path):
    folder = tmp_path / "in"
    for part in range(2):
        land(events.where(f"event_id >= {part * 250} AND event_id < {(part + 1) * 250}"), folder, f"f{part}")
    batches, _ = run(prev_stream(one_file(spark, folder)), tmp_path)
    assert len(batches) == 2
    for part in range(2, 4):
        land(events.where(f"event_id >= {part * 250} AND event_id < {(part + 1) * 250}"), folder, f"f{part}")
    _, found = run(prev_stream(one_file(spark, folder)), tmp_path)
    assert_close(rows(found), rows(prev_features(small)))


def test_previous_of_late_and_missing(spark, tmp_path):
    folder = tmp_path / "in"
    land(spark.createDataFrame([event(2, 10, value=None), event(1, 10), event(3, 20, value=30.0)], EVENTS), folder, "f0")
    land(
        spark.createDataFrame([event(6, 30, value=60.0), event(4, 5), event(5, 20, value=50.0), event(7, 1, account=2)], EVENTS),
        folder,
        "f1",
    )
    _, found = run(prev_stream(one_file(spark, folder)), tmp_path)
    told = {r["txn_id"]: (r["prev_amount"], r["gap_seconds"]) for r in rows(found)}
    assert told == {
        1: (None, None),
        2: (10.0, 0.0),
        3: (None, 600.0),
        4: (None, None),
        5: (30.0, 0.0),
        6: (50.0, 600.0),
        7: (None, None),
    }


def test_velocity_closed_windows_and_late_rows(spark, tmp_path):
    folder = tmp_path / "in"
    land(spark.createDataFrame([event(1, 5), event(2, 50, value=20.0), event(3, 70)], EVENTS), folder, "f0")
    land(spark.createDataFrame([event(4, 55), event(5, 200)], EVENTS), folder, "f1")
    land(spark.createDataFrame([event(6, 400)], EVENTS), folder, "f2")
    land(spark.createDataFrame([event(7, 58)], EVENTS), folder, "f3")
    batches, found = run(velocity_stream(one_file(spark, folder), "1 hour", "1 hour"), tmp_path)
    assert len(batches) == 4
    told = [(r["window_start"].hour, r["n"], r["total"], r["average"]) for r in rows(found, "window_start")]
    # Event 4 is in time; event 7 comes when its window has been closed and written.
    assert told == [(0, 3, 40.0, 40.0 / 3), (1, 1, 10.0, 10.0), (3, 1, 10.0, 10.0)]


def test_velocity_equals_batch_on_closed_windows(spark, events, small, tmp_path):
    folder = tmp_path / "in"
    for part in range(3):
        land(events.where(f"event_id % 1000 >= {part * 334} AND event_id % 1000 < {(part + 1) * 334}"), folder, f"f{part}")
    _, found = run(velocity_stream(one_file(spark, folder), "6 hours", "2 hours"), tmp_path)
    mark = small.agg(F.max("ts") - F.expr("INTERVAL 2 HOURS")).first()[0]
    batch = (
        small.groupBy("account_id", F.window("ts", "6 hours"))
        .agg(F.count("amount").alias("n"), F.sum("amount").alias("total"), F.avg("amount").alias("average"))
        .select("account_id", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "n", "total", "average")
        .where(F.col("window_end") <= F.lit(mark))
    )
    order = ("account_id", "window_start")
    assert_close(rows(found, *order), rows(batch, *order))


def test_busy_accounts_are_added_up_before_the_shuffle(spark, tmp_path):
    stream = velocity_stream(read_stream(spark, SMALL, "events.parquet"))
    query = stream.writeStream.format("noop").trigger(availableNow=True)
    running = query.option("checkpointLocation", str(tmp_path / "log")).start()
    running.awaitTermination()
    text = running._jsq.explainInternal(False)
    before = text[text.index("Exchange hashpartitioning") :]
    assert "partial_sum" in before


def test_scores_equal_batch_after_a_restart(spark, events, small, tmp_path):
    fitted = train_logistic(plant_fraud(small), ["amount"], category="channel", maxIter=10)
    folder = tmp_path / "in"
    land(events.where("event_id < 400"), folder, "f0")
    land(events.where("event_id >= 400 AND event_id < 700"), folder, "f1")

    def go():
        query = score_stream(fitted.model, one_file(spark, folder), str(tmp_path / "sink"), str(tmp_path / "log"))
        query.awaitTermination()
        return spark.read.parquet(str(tmp_path / "sink"))

    assert go().count() == 700
    land(events.where("event_id >= 700"), folder, "f2")
    assert rows(go().drop("day")) == rows(score(fitted.model, small))


def test_scores_may_use_stream_features(spark, small, tmp_path):
    stream = prev_stream(read_stream(spark, SMALL, "events.parquet"))
    scored = stream.withColumn("p_fraud", sigmoid(F.coalesce("prev_amount", F.lit(0.0)) * 0.01 - 2))
    _, found = run(scored, tmp_path)
    batch = prev_features(small).withColumn("p_fraud", sigmoid(F.coalesce("prev_amount", F.lit(0.0)) * 0.01 - 2))
    assert_close(rows(found), rows(batch))


FEATURES = ["prev_amount", "gap_seconds", *[f"{w}_{s}" for w in ("n", "sum", "avg") for s in SPANS], "hist_n", "hist_mean", "hist_sd", "z_amount"]


def features(df):
    return rows(df.select("txn_id", "account_id", "ts", "amount", "channel", *FEATURES, "hour", "weekday", "is_night"))


def test_account_features_over_batches_and_a_restart(spark, events, small, tmp_path):
    """Files that overlap in time within the lateness, two before and two after a restart."""
    folder = tmp_path / "in"
    moved = events.withColumn("at", F.unix_seconds("ts") + F.pmod(F.xxhash64("event_id"), F.lit(86400)))
    cuts = [float("-inf"), *moved.approxQuantile("at", [0.25, 0.5, 0.75], 0.0), float("inf")]
    parts = [moved.where((F.col("at") >= a) & (F.col("at") < b)).drop("at") for a, b in zip(cuts, cuts[1:])]
    for n in (0, 1):
        land(parts[n], folder, f"f{n}")
    batches, first = run(account_stream(one_file(spark, folder), "1 day"), tmp_path)
    assert len(batches) == 2 and 0 < first.count() < 500
    for n in (2, 3):
        land(parts[n], folder, f"f{n}")
    _, found = run(account_stream(one_file(spark, folder), "1 day"), tmp_path)
    assert found.where("late").count() == 0
    reached = small.agg(F.max("ts")).first()[0] - timedelta(days=1)
    assert features(found) == features(account_features(small).where(F.col("ts") <= F.lit(reached)))
    assert found.count() > 900


def test_account_stream_marks_late_rows_and_forgets_old_ones(spark, tmp_path):
    folder = tmp_path / "in"
    day = 24 * 60
    land(spark.createDataFrame([event(1, 0), event(2, 1, value=None), event(3, 1, value=float("inf")), event(4, 2, value=1e28), event(5, 300)], EVENTS), folder, "f0")
    # Row 6 is behind the watermark; account 3 comes only now; rows without time or account are left out.
    gone = [(90, None, 1, "card", 1.0, "{}"), (91, AT + timedelta(minutes=400), None, "card", 1.0, "{}")]
    land(spark.createDataFrame([event(6, 10), event(7, 290), event(8, 300, value=4.0), event(9, 20 * day, account=3), *gone], EVENTS), folder, "f1")
    land(spark.createDataFrame([event(10, 20 * day + 5, value=7.0), event(11, 20 * day + 5, value=8.0), event(12, 40 * day, account=2)], EVENTS), folder, "f2")
    _, found = run(account_stream(one_file(spark, folder), "1 hour"), tmp_path)
    late = found.where("late").collect()
    assert [r.txn_id for r in late] == [6] and late[0].hist_n is None and late[0].ts == (AT + timedelta(minutes=10)).replace(tzinfo=None)
    kept = spark.read.schema(EVENTS).parquet(str(folder)).where("event_id NOT IN (6, 12, 90, 91)")
    wanted = account_features(canonical(kept))
    assert features(found.where("NOT late")) == features(wanted)


def test_best_run_scores_a_stream(spark, small, tmp_path):
    """A model of features that only the account's history gives, on either learner."""
    prepared = plant_fraud(account_features(small))
    source = lambda: read_stream(spark, SMALL, "events.parquet")
    for learner in ("logistic", "boosted2"):
        out = tmp_path / learner
        store = train(spark, prepared, str(out), logistic={"maxIter": 5}, boosted2={"trees": 2, "depth": 2}, learners=(learner,))
        score_stream_best(spark, source(), store, str(out / "sink"), str(out / "log")).awaitTermination()
        found = spark.read.parquet(str(out / "sink"))
        batch = find_best(spark, store).score(spark, prepared)
        reached = small.agg(F.max("ts")).first()[0] - timedelta(hours=1)
        assert_close(rows(found.select("txn_id", "p_fraud")), rows(batch.where(F.col("ts") <= F.lit(reached)).select("txn_id", "p_fraud")))


def test_accounts_share_the_state_of_a_group(spark, tmp_path):
    """Many accounts in few groups: amounts beyond 64 bits, null or too large, and a late row."""
    odd = {3: 1e20, 5: None, 7: 9e26, 13: 1e28}
    made = [event(i, i * 37 + i % 5, account=i % 90, value=odd.get(i % 23, 3.0 + i * 7 % 31)) for i in range(900)]
    folder = tmp_path / "in"
    order = sorted(range(900), key=lambda i: i + i * 53 % 60)  # out of order by less than two days
    for n in range(3):
        land(spark.createDataFrame([made[i] for i in order[n * 300 : n * 300 + 300]], EVENTS), folder, f"f{n}")
    late = [event(1000, 5, account=4), event(1001, 50000, account=4)]
    land(spark.createDataFrame(late, EVENTS), folder, "f3")
    batches, found = run(account_stream(one_file(spark, folder), "2 days", groups=3), tmp_path)
    # Not one timer and one state for each of the 90 accounts.
    assert max(b.stateOperators[0].numRowsTotal for b in batches) < 60
    assert [r["txn_id"] for r in rows(found.where("late"))] == [1000]
    everything = canonical(spark.createDataFrame([*made, late[1]], EVENTS))
    batch = account_features(everything).where("txn_id < 1000")
    names = ["txn_id", "account_id", "prev_amount", "gap_seconds", *[f"{w}_{s}" for w in ("n", "sum", "avg") for s in SPANS], "hist_n", "hist_mean", "hist_sd"]
    assert_close(rows(found.where("NOT late").select(names)), rows(batch.select(names)))
