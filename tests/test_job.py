import pytest

from conftest import SMALL, assert_close, rows
from tallyguard.operators.history import account_features
from tallyguard.operators.hot import Skew
from tallyguard.operators.tracking import Run, best_run, log_run, read_store
from tallyguard.plans.job import EXPERIMENT, METRIC, prepare, run_pipeline, score_best
from tallyguard.session import shared_folder


def test_three_steps(spark, tmp_path):
    out = str(tmp_path / "job")
    found = rows(run_pipeline(spark, SMALL, out, k=3), "day", "rank")
    assert found and all(r["p_fraud"] >= 0.5 and r["rank"] <= 3 for r in found)
    tables = read_store(spark, f"{out}/runs")
    assert {r.run_id.split("-")[0] for r in tables["runs"].collect()} == {"boosted", "logistic"}
    best = best_run(tables["runs"], tables["metrics"], METRIC).first()
    assert {r["model"] for r in found} == {best.run_id.split("-")[0]}
    assert best[METRIC] > 0.6
    assert spark.read.parquet(f"{out}/prepared").count() == 1000
    # A better run of another experiment is not ours.
    log_run(spark, f"{out}/runs", Run("foreign-1", "other", model_path="/nowhere", metrics={METRIC: 0.999}))
    prepared = spark.read.parquet(f"{out}/prepared")
    again = rows(score_best(spark, prepared, f"{out}/runs", k=3), "day", "rank")
    assert again == found
    # The job runs into the same folder again: days are replaced, runs are added.
    run_pipeline(spark, SMALL, out, k=3)
    assert spark.read.parquet(f"{out}/prepared").count() == 1000
    assert read_store(spark, f"{out}/runs")["runs"].where(f"experiment = '{EXPERIMENT}'").count() == 4


def test_hot_accounts_do_not_change_the_table(spark, tmp_path):
    plain = prepare(spark, SMALL, str(tmp_path / "plain"))
    forced = prepare(spark, SMALL, str(tmp_path / "hot"), Skew(hot_rows=60, chunk_rows=200))
    assert_close(rows(plain), rows(forced))


def test_one_exchange_and_one_sort_for_all_windows(small):
    text = account_features(small)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and text.count("Sort ") == 1 and text.count("Window ") == 3


def test_shared_folder_is_the_session_s(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark, "x").startswith(root)
    assert shared_folder(spark, "x") != shared_folder(spark, "x")


def test_no_work_folder_is_made_up(spark):
    class Session:
        class sparkContext:
            @staticmethod
            def getCheckpointDir():
                return None

        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session(), "x")
