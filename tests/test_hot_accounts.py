"""The chunked way gives what the plain way gives, whatever the cuts."""

from datetime import datetime, timedelta, timezone
import random
import statistics

import pytest
from pyspark.sql import functions as F

from conftest import assert_close, rows
from tallyguard.operators import history
from tallyguard.operators.hot import Skew, cut_into_chunks, hot_accounts
from tallyguard.schema import TRANSACTIONS

PLAIN = Skew(hot_rows=10**9)
SPANS = {"0s": 0, "10s": 10, "1h": 3600}


def make(spark, seed, n=400, accounts=3, instants=40):
    """One account has most rows; many share an instant; some amounts are missing."""
    draw = random.Random(seed)
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    data = []
    for i in range(n):
        account = 1 if draw.random() < 0.7 else draw.choice([None, *range(2, accounts + 2)])
        at = start + timedelta(seconds=draw.randrange(instants) * 7)
        amount = None if draw.random() < 0.05 else draw.randrange(1, 50000) / 100
        data.append((i, account, at, amount, "card", 1))
    draw.shuffle(data)
    return spark.createDataFrame(data, TRANSACTIONS).repartition(3)


@pytest.fixture(scope="module")
def busy(spark):
    return make(spark, 1, n=240).cache()


@pytest.mark.parametrize("hot_rows, chunk_rows", [(0, 40), (100, 9)])
def test_same_as_plain(busy, hot_rows, chunk_rows):
    skew = Skew(hot_rows=hot_rows, chunk_rows=chunk_rows)
    for make_features in (
        history.prev_features,
        history.history_features,
        lambda df, skew: history.velocity_features(df, SPANS, skew),
        lambda df, skew: history.account_features(df, SPANS, skew),
    ):
        assert_close(rows(make_features(busy, skew=skew)), rows(make_features(busy, skew=PLAIN)))


def test_one_instant_spread_over_many_chunks(spark):
    """All rows at two instants: every chunk continues an instant begun in another."""
    busy = make(spark, 3, n=120, instants=2)
    skew = Skew(hot_rows=20, chunk_rows=10)
    assert_close(
        rows(history.velocity_features(busy, SPANS, skew)),
        rows(history.velocity_features(busy, SPANS, PLAIN)),
    )


@pytest.mark.parametrize("skew", [PLAIN, Skew(hot_rows=60, chunk_rows=25)])
def test_against_brute_force(busy, skew):
    found = {r["txn_id"]: r for r in rows(history.account_features(busy, SPANS, skew))}
    data = rows(busy)
    for row in data:
        same = [r for r in data if r["account_id"] == row["account_id"]]
        earlier = sorted(
            (r for r in same if (r["ts"], r["txn_id"]) < (row["ts"], row["txn_id"])),
            key=lambda r: (r["ts"], r["txn_id"]),
        )
        ours = found[row["txn_id"]]
        assert ours["prev_amount"] == (earlier[-1]["amount"] if earlier else None)
        known = [r["amount"] for r in earlier if r["amount"] is not None]
        assert ours["hist_n"] == len(known)
        if known:
            assert ours["hist_mean"] == pytest.approx(statistics.fmean(known))
        if len(known) > 1:
            assert ours["hist_sd"] == pytest.approx(statistics.stdev(known), abs=1e-9)
        for name, seconds in SPANS.items():
            since = row["ts"] - timedelta(seconds=seconds)
            inside = [
                r["amount"]
                for r in same
                if since <= r["ts"] <= row["ts"] and r["amount"] is not None
            ]
            assert ours[f"n_{name}"] == len(inside)
            expected = pytest.approx(sum(inside)) if inside else None
            assert ours[f"sum_{name}"] == expected


def test_chunks_are_small_and_in_order(spark):
    busy = make(spark, 5, n=2000, instants=1500).withColumn("_us", F.unix_micros("ts"))
    chunked = cut_into_chunks(busy, ["_us", "txn_id"], 2000, Skew(chunk_rows=100))
    sizes = [r["count"] for r in chunked.groupBy("_chunk").count().collect()]
    assert sum(sizes) == 2000 and max(sizes) < 300
    pairs = chunked.select("account_id", "_chunk").distinct().count()
    assert pairs <= busy.select("account_id").distinct().count() + len(sizes)


def test_many_small_chunks_take_few_tasks(spark):
    """Not a task and a file for each chunk; rows alike in account, time and id stay together."""
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    data = [(i // 3, i % 2 if i % 9 else None, at + timedelta(minutes=i // 30), 1.0, "card", i) for i in range(1200)]
    busy = spark.createDataFrame(data, TRANSACTIONS).withColumn("_us", F.unix_micros("ts"))
    chunked = cut_into_chunks(busy, ["_us", "txn_id"], 1200, Skew(chunk_rows=4))
    assert len(chunked.inputFiles()) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = chunked.select("account_id", "_us", "txn_id", "device_k", "_chunk").collect()
    assert sorted(r.device_k for r in found) == list(range(1200))
    place = lambda r: (r.account_id is not None, r.account_id or 0, r._us, r.txn_id)
    chunks = [r._chunk for r in sorted(found, key=place)]
    assert chunks == sorted(chunks) and 250 < len(set(chunks)) <= 304
    assert len({(place(r), r._chunk) for r in found}) == len({place(r) for r in found})


def test_only_hot_accounts_are_cut(spark):
    busy = make(spark, 6)
    found = hot_accounts(busy, Skew(hot_rows=100))
    assert [r[0] for r in found.table.collect()] == [1]
    assert found.rows == busy.where("account_id = 1").count()
    assert not hot_accounts(busy, PLAIN).any
    assert hot_accounts(busy, Skew(hot_rows=0)).table.count() == 5


def test_every_hot_account_is_cut(spark):
    """There is no limit to their number."""
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    data = [(i, i % 1500, at + timedelta(minutes=i), float(i % 7), "card", 1) for i in range(6000)]
    many = spark.createDataFrame(data, TRANSACTIONS)
    found = hot_accounts(many, Skew(hot_rows=3))
    assert found.table.count() == 1500 and found.rows == 6000
    assert found.of(many, "left_anti").count() == 0
    hot = history.account_features(many, skew=Skew(hot_rows=3, chunk_rows=500))
    assert_close(rows(hot), rows(history.account_features(many, skew=PLAIN)))


def test_fine_and_huge_amounts_are_summed(spark):
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    amounts = [4e-7, 0.1234567891, 1e19, float("nan"), 1e28, 2.5]
    data = [(i, 1, at + timedelta(minutes=i), a, "card", 1) for i, a in enumerate(amounts)]
    df = spark.createDataFrame(data, TRANSACTIONS)
    for skew in (PLAIN, Skew(hot_rows=1, chunk_rows=2)):
        made = {r.txn_id: r for r in history.account_features(df, skew=skew).collect()}
        assert abs(made[0].sum_1h - 4e-7) < 1e-15 and abs(made[1].sum_1h - 0.1234571891) < 1e-15
        assert made[2].sum_1h == 1e19 and [made[i].n_1h for i in range(6)] == [1, 2, 3, 3, 3, 4]
        # What is no amount counts nowhere and has no score.
        assert [made[i].hist_n for i in range(6)] == [0, 1, 2, 3, 3, 3]
        assert made[3].z_amount is None and made[5].hist_mean == made[4].hist_mean


def test_later_rows_do_not_change_earlier_features(spark, middle):
    cut = "timestamp'2024-01-15 00:00:00'"
    for skew in (PLAIN, Skew(hot_rows=60, chunk_rows=900)):
        whole = history.account_features(middle, skew=skew).where(f"ts < {cut}")
        early = history.account_features(middle.where(f"ts < {cut}"), skew=skew)
        assert_close(rows(whole), rows(early))


def test_empty(spark, small):
    none = small.where("amount < 0")
    assert history.account_features(none).count() == 0
    assert history.plant_fraud(none).count() == 0


def test_equal_amounts_have_no_score(spark):
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    data = [(i, 1, at + timedelta(hours=i), 19.99, "card", 1) for i in range(40)]
    same = spark.createDataFrame(data, TRANSACTIONS)
    for skew in (PLAIN, Skew(hot_rows=1, chunk_rows=5)):
        scored = history.history_features(same, skew)
        assert scored.where("z_amount IS NOT NULL").count() == 0
