import math
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator

from conftest import rows
from tallyguard.operators.evaluation import auc, confusion, log_loss, threshold_sweep


def make(spark, pairs):
    data = [(i, y, p) for i, (y, p) in enumerate(pairs)]
    return spark.createDataFrame(data, "txn_id long, is_fraud int, p_fraud double")


def brute_auc(pairs):
    fraud = [p for y, p in pairs if y == 1]
    honest = [p for y, p in pairs if y == 0]
    won = sum((f > h) + 0.5 * (f == h) for f in fraud for h in honest)
    return won / (len(fraud) * len(honest))


def draw(seed, n=300, places=2):
    source = random.Random(seed)
    pairs = [(0, round(source.random(), places)) for _ in range(n)]
    return [(int(source.random() < p), p) for _, p in pairs]


@pytest.mark.parametrize("places", [0, 1, 2, 9])
def test_auc_against_all_pairs(spark, places):
    pairs = draw(places, places=places)
    found = auc(make(spark, pairs)).first()
    assert found.auc == pytest.approx(brute_auc(pairs), abs=1e-12)
    assert found.fraud + found.honest == len(pairs)


def test_auc_when_a_third_share_one_score(spark):
    pairs = draw(8, places=9) + [(i % 5 == 0, 0.5) for i in range(150)]
    pairs = [(int(y), p) for y, p in pairs]
    assert auc(make(spark, pairs)).first().auc == pytest.approx(brute_auc(pairs), abs=1e-12)


def test_auc_agrees_with_mllib(spark):
    df = make(spark, draw(5, n=2000, places=9))
    judge = BinaryClassificationEvaluator(rawPredictionCol="p_fraud", labelCol="is_fraud", numBins=0)
    assert auc(df).first().auc == pytest.approx(judge.evaluate(df), abs=1e-9)


def test_auc_edges(spark):
    assert auc(make(spark, [(1, 0.9), (1, 0.8), (0, 0.1)])).first().auc == 1.0
    assert auc(make(spark, [(1, 0.1), (0, 0.9)])).first().auc == 0.0
    assert auc(make(spark, [(1, 0.5), (0, 0.5)])).first().auc == 0.5
    assert auc(make(spark, [(1, 0.5), (1, 0.7)])).first().auc is None
    assert auc(make(spark, [])).first().auc is None
    assert auc(make(spark, [(1, 0.9), (0, 0.1), (1, None), (0, float("nan"))])).first().auc == 1.0


def test_auc_windows_are_split(spark):
    text = auc(make(spark, draw(1)))._jdf.queryExecution().executedPlan().toString()
    assert "p_fraud#" in text
    windows = [line for line in text.splitlines() if "Window [" in line]
    # The one over scores is partitioned by bucket; the other holds one row per bucket.
    assert len(windows) == 2 and any("[bucket#" in line.split("],")[1] for line in windows)


def test_confusion(spark):
    found = confusion(make(spark, [(1, 0.9), (1, 0.2), (0, 0.7), (0, 0.1), (1, None), (0, None)])).first()
    assert (found.tp, found.fp, found.tn, found.fn) == (1, 1, 2, 2)
    assert found.precision == 0.5 and found.recall == pytest.approx(1 / 3)
    assert found.f1 == pytest.approx(0.4)
    nothing = confusion(make(spark, [(0, 0.1)])).first()
    assert nothing.precision is None and nothing.recall is None and nothing.f1 is None


def test_sweep_agrees_with_confusion(spark):
    df = make(spark, draw(4, n=500, places=9) + [(1, 1.0), (0, 0.0)])
    for line in rows(threshold_sweep(df, 8), "bin"):
        one = confusion(df, line["threshold"]).first()
        assert [line[k] for k in ("tp", "fp", "fn", "tn")] == [one[k] for k in ("tp", "fp", "fn", "tn")]
        assert line["tpr"] == pytest.approx(one.recall)
        assert line["precision"] == one.precision


def test_sweep_of_one_class(spark):
    lines = rows(threshold_sweep(make(spark, [(0, 0.2), (0, 0.7)]), 4), "bin")
    assert [line["tpr"] for line in lines] == [None] * 4
    assert [line["fpr"] for line in lines] == [1.0, 0.5, 0.5, 0.0]


def test_log_loss(spark):
    found = log_loss(make(spark, [(1, 0.8), (0, 0.4), (1, None)])).first()
    assert found.rows == 2
    assert found.log_loss == pytest.approx(-(math.log(0.8) + math.log(0.6)) / 2)
    assert found.brier == pytest.approx((0.04 + 0.16) / 2)
    certain = log_loss(make(spark, [(1, 0.0), (0, 1.0)])).first()
    assert math.isfinite(certain.log_loss) and certain.log_loss > 30
