from datetime import datetime, timedelta, timezone

import pytest

from conftest import rows
from tallyguard.operators import tracking
from tallyguard.operators.tracking import (
    METRICS,
    PARAMS,
    RUNS,
    Run,
    best_run,
    compare_runs,
    latest_metrics,
    log_run,
    read_store,
    runs_table,
)

AT = datetime(2024, 1, 1, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def tables(spark):
    runs = [
        ("a", "fraud", AT, "m/a", None, None),
        ("b", "fraud", AT + timedelta(hours=1), "m/b", None, None),
        ("c", "fraud", AT - timedelta(hours=1), "m/c", None, None),
        ("d", "other", AT, "m/d", None, None),
        ("silent", "fraud", AT, "m/s", None, None),
    ]
    metrics = [
        ("a", "auc", 0, 0.95, AT),
        ("a", "auc", 1, 0.80, AT),
        ("b", "auc", 5, 0.90, AT),
        ("b", "auc", 1, 0.85, AT + timedelta(minutes=1)),
        ("c", "auc", 0, 0.85, AT),
        ("c", "loss", 0, 0.3, AT),
        ("d", "auc", 0, 0.10, AT),
        ("d", "auc", 1, None, AT),
        ("lost", "auc", 0, 0.99, AT),
    ]
    params = [("a", "depth", "4"), ("b", "depth", "6"), ("b", "seed", "7"), ("lost", "depth", "1")]
    return (
        spark.createDataFrame(runs, RUNS),
        spark.createDataFrame(params, PARAMS),
        spark.createDataFrame(metrics, METRICS),
    )


def test_latest(tables):
    found = {(r["run_id"], r["key"]): r["value"] for r in rows(latest_metrics(tables[2]), "run_id")}
    assert found[("a", "auc")] == 0.80 and found[("b", "auc")] == 0.85
    assert found[("d", "auc")] is None


def test_readers_start_from_runs(tables):
    found = rows(runs_table(tables[0], tables[2]), "run_id", "key")
    assert [r["run_id"] for r in found] == ["a", "b", "c", "c", "d", "silent"]
    assert found[-1]["value"] is None


def test_compare(tables):
    runs, params, metrics = tables
    found = {r["run_id"]: r for r in rows(compare_runs(runs, params, metrics, ["auc", "loss"], ["depth"]), "run_id")}
    assert set(found) == {"a", "b", "c", "d", "silent"}
    assert (found["b"]["depth"], found["b"]["auc"], found["b"]["loss"]) == ("6", 0.85, None)
    assert (found["c"]["depth"], found["c"]["auc"], found["c"]["loss"]) == (None, 0.85, 0.3)


def test_best(tables):
    runs, _, metrics = tables
    best = rows(best_run(runs, metrics, "auc"), "experiment")
    # b and c tie; c started first. The last value of d is missing.
    assert [(r["run_id"], r["auc"]) for r in best] == [("c", 0.85)]
    worst = rows(best_run(runs, metrics, "auc", largest=False), "experiment")
    assert [r["run_id"] for r in worst] == ["a"]
    assert best_run(runs, metrics, "nothing").count() == 0


def test_log_and_read(spark, tmp_path):
    store = str(tmp_path / "store")
    for number in (1, 2):
        log_run(
            spark,
            store,
            Run(
                run_id=f"r{number}",
                experiment="이상거래",
                model_path=f"models/{number}",
                params={"depth": number, "이름": "값"},
                metrics={"auc": [0.5, 0.6 + number / 10], "f1": 0.4},
                data_from=AT,
                data_to=AT + timedelta(days=1),
                started=AT + timedelta(hours=number),
            ),
        )
    log_run(spark, store, Run("bare", "이상거래", started=AT))
    tables = read_store(spark, store)
    assert tables["runs"].count() == 3
    best = best_run(tables["runs"], tables["metrics"], "auc").first()
    assert (best.run_id, best.model_path, best.auc) == ("r2", "models/2", 0.8)
    assert best.data_to - best.data_from == timedelta(days=1)
    wide = rows(compare_runs(*(tables[t] for t in ("runs", "params", "metrics")), ["auc"], ["이름"]), "run_id")
    assert [(r["run_id"], r["이름"], r["auc"]) for r in wide] == [("bare", None, None), ("r1", "값", 0.7), ("r2", "값", 0.8)]


def test_half_logged_run_is_not_seen(spark, tmp_path, monkeypatch):
    store = str(tmp_path / "store")
    log_run(spark, store, Run("whole", "e", params={"a": 1}, metrics={"m": 1.0}, started=AT))
    broken = Run("broken", "e", params={"a": 1}, metrics={"m": 2.0}, started="no time at all")
    with pytest.raises(Exception):
        log_run(spark, store, broken)
    tables = read_store(spark, store)
    assert [r.run_id for r in best_run(tables["runs"], tables["metrics"], "m").collect()] == ["whole"]


def test_a_run_logged_again_is_one_run(spark, tmp_path):
    store = str(tmp_path / "store")
    run = Run("r", "fraud", "m/r", params={"depth": 4}, metrics={"auc": [0.7, 0.8]}, started=AT)
    for _ in range(3):
        log_run(spark, store, run)
    tables = read_store(spark, store)
    assert [tables[t].count() for t in ("runs", "params", "metrics")] == [1, 1, 2]
    wide = rows(compare_runs(tables["runs"], tables["params"], tables["metrics"], ["auc"], ["depth"]), "run_id")
    assert len(wide) == 1 and wide[0]["auc"] == 0.8 and wide[0]["depth"] == "4"


def test_an_attempt_that_died_is_not_seen(spark, tmp_path):
    store = str(tmp_path / "store")
    log_run(spark, store, Run("other", "fraud", params={"depth": 1}, metrics={"auc": 0.6}, started=AT))
    run = Run("r", "fraud", params={"depth": 4}, metrics={"auc": 0.9}, started=AT)
    died = tracking._rows(spark, run, "died")
    for table in ("params", "metrics"):
        died[table].write.mode("append").parquet(f"{store}/{table}")
    tables = read_store(spark, store)
    assert {t: [r["run_id"] for r in tables[t].collect()] for t in tables} == {t: ["other"] for t in tables}
    log_run(spark, store, run)
    tables = read_store(spark, store)
    assert [tables[t].where("run_id = 'r'").count() for t in ("runs", "params", "metrics")] == [1, 1, 1]


def test_tables_from_before_attempts_are_read(spark, tables, tmp_path):
    for name, df in zip(("runs", "params", "metrics"), tables):
        df.write.parquet(str(tmp_path / name))
    found = read_store(spark, str(tmp_path))
    assert found["runs"].count() == 5 and found["params"].where("run_id = 'b'").count() == 2
    assert found["metrics"].where("run_id = 'lost'").count() == 0
