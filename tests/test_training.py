import pytest
from pyspark.sql import functions as F

from conftest import rows
from tallyguard.operators.evaluation import auc
from tallyguard.operators.history import account_features, plant_fraud
from tallyguard.operators.rename import korean_transactions, rename_columns
from tallyguard.operators.scoring import alerts, score, score_logistic
from tallyguard.operators.split import class_weights, split
from tallyguard.operators.training import NUMERIC, train_boosted, train_logistic
from tallyguard.session import materialize

FEW = ["amount", "prev_amount", "gap_seconds"]


@pytest.fixture(scope="module")
def prepared(middle):
    return materialize(plant_fraud(account_features(middle)))


@pytest.fixture(scope="module")
def parts(prepared):
    train, test = split(prepared)
    return class_weights(train), test


@pytest.fixture(scope="module")
def logistic(parts):
    return train_logistic(
        parts[0], NUMERIC, category="channel", weight="class_weight", key="txn_id", maxIter=30
    )


def scores(df):
    return {r.txn_id: r.p_fraud for r in df.select("txn_id", "p_fraud").collect()}


def worst_gap(left, right):
    assert left.keys() == right.keys()
    return max(abs(left[k] - right[k]) for k in left)


def test_logistic_finds_the_planted_label(parts, logistic):
    assert auc(score(logistic.model, parts[1])).first().auc > 0.75
    assert logistic.coefficients["amount"] > 0.01
    assert set(NUMERIC) < set(logistic.coefficients) and "channel=click" in logistic.coefficients


def test_boosted_finds_the_planted_label(parts):
    fitted = train_boosted(parts[0], NUMERIC, category="channel", weight="class_weight", maxIter=5)
    assert auc(score(fitted.model, parts[1])).first().auc > 0.75
    assert max(fitted.importances, key=fitted.importances.get) == "amount"
    assert sum(fitted.importances.values()) == pytest.approx(1.0)


def test_expression_equals_model(parts, logistic):
    by_model = scores(score(logistic.model, parts[1]))
    by_hand = scores(
        score_logistic(parts[1], logistic.coefficients, logistic.intercept, logistic.fill)
    )
    assert worst_gap(by_model, by_hand) < 1e-12


def test_expression_runs_in_generated_code(parts, logistic):
    scored = score_logistic(parts[1], logistic.coefficients, logistic.intercept, logistic.fill)
    text = scored._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "UDF" not in text and text.startswith("*(1) Project")


def test_expression_refuses_unknown_columns(parts):
    for name in ("nothing", "nothing=x"):
        with pytest.raises(ValueError, match="nothing"):
            score_logistic(parts[1], {name: 1.0}, 0.0)


def test_scoring_leaves_no_helpers(parts, logistic):
    assert score(logistic.model, parts[1]).columns == [*parts[1].columns, "p_fraud"]


def test_same_fit_twice(parts):
    def fit(df):
        return train_logistic(df, FEW, category="channel", key="txn_id", maxIter=10).coefficients

    assert fit(parts[0]) == fit(parts[0].repartition(5))


def test_same_trees_twice(parts):
    def fit(df):
        return train_boosted(df, FEW, key="txn_id", maxIter=2, maxDepth=3).model.stages[-1].toDebugString

    first, again = fit(parts[0]), fit(parts[0].repartition(5))
    assert first.split("\n", 1)[1] == again.split("\n", 1)[1]


def test_saved_model_scores_alike(parts, logistic, tmp_path):
    path = str(tmp_path / "model")
    logistic.model.save(path)
    assert scores(score(path, parts[1])) == scores(score(logistic.model, parts[1]))


@pytest.mark.parametrize("names", [["거래 금액", "거래.금액"], ["a`b", "직전금액"]])
def test_names_do_not_matter(parts, names):
    renaming = dict(zip(["amount", "prev_amount"], names))
    plain = train_logistic(parts[0], FEW[:2], category="channel", maxIter=10)
    odd = train_logistic(
        rename_columns(parts[0], {**renaming, "channel": "거래.유형"}), names, category="거래.유형", maxIter=10
    )
    assert list(plain.coefficients.values()) == pytest.approx(list(odd.coefficients.values()))
    renamed_test = rename_columns(parts[1], {**renaming, "channel": "거래.유형"})
    by_model = scores(score(odd.model, renamed_test))
    assert worst_gap(by_model, scores(score(plain.model, parts[1]))) < 1e-9
    by_hand = score_logistic(renamed_test, odd.coefficients, odd.intercept, odd.fill)
    assert worst_gap(by_model, scores(by_hand)) < 1e-12


def test_korean_boosted(parts):
    korean = korean_transactions(parts[0])
    fitted = train_boosted(
        korean, ["거래금액", "직전금액"], label="사기여부", category="거래유형", maxIter=2
    )
    assert set(fitted.importances) == {"거래금액", "직전금액", "거래유형"}


def test_missing_and_unseen_values(parts, logistic):
    odd = (
        parts[1]
        .limit(20)
        .withColumn("channel", F.when(F.col("txn_id") % 2 == 0, "never seen"))
        .withColumn("amount", F.when(F.col("txn_id") % 3 == 0, F.lit(float("nan"))))
        .withColumn("prev_amount", F.lit(None).cast("double"))
    )
    by_model = scores(score(logistic.model, odd))
    assert all(p is not None and 0 < p < 1 for p in by_model.values())
    by_hand = score_logistic(odd, logistic.coefficients, logistic.intercept, logistic.fill)
    assert worst_gap(by_model, scores(by_hand)) < 1e-12


def test_rows_without_label_are_left_out(parts):
    some = parts[0].withColumn("is_fraud", F.when(F.col("txn_id") % 2 == 0, F.col("is_fraud")))
    half = parts[0].where("txn_id % 2 = 0")
    a = train_logistic(some, FEW, key="txn_id", maxIter=5).coefficients
    b = train_logistic(half, FEW, key="txn_id", maxIter=5).coefficients
    assert list(a.values()) == pytest.approx(list(b.values()))


def test_alerts(parts, logistic):
    scored = score(logistic.model, parts[1])
    top = rows(alerts(scored, 3, 0.6), "day", "rank")
    data = rows(scored)
    days = {r["ts"].date() for r in data}
    assert len(days) > 20
    for day in days:
        flagged = [r for r in data if r["ts"].date() == day and r["p_fraud"] >= 0.6]
        expected = sorted(flagged, key=lambda r: (-r["p_fraud"], r["txn_id"]))[:3]
        found = [r["txn_id"] for r in top if r["day"] == day]
        assert found == [r["txn_id"] for r in expected]


def test_alerts_shuffle_only_the_best(small):
    scored = score_logistic(small, {"amount": 0.02}, -3.0)
    text = alerts(scored, 3)._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange") == 1


def test_too_many_categories_are_refused(parts):
    many = parts[0].withColumn("channel", F.col("txn_id").cast("string"))
    with pytest.raises(ValueError, match="more than 1000"):
        train_logistic(many, FEW, category="channel")


def test_trees_take_many_categories(spark, parts):
    """Bins follow the number of categories; a limit is the caller's to set."""
    for kinds in (40, 1200):
        wide = parts[0].withColumn("channel", (F.col("txn_id") % kinds).cast("string"))
        fitted = train_boosted(wide, FEW, category="channel", max_kinds=2000, maxIter=1, maxDepth=2)
        assert set(fitted.importances) == {*FEW, "channel"}


def test_own_columns_cannot_be_chosen(parts):
    with pytest.raises(ValueError, match="featuresCol"):
        train_boosted(parts[0], FEW, featuresCol="x")
    with pytest.raises(ValueError, match="labelCol"):
        train_logistic(parts[0], FEW, labelCol="x")


def test_early_stopping_sees_its_rows(parts):
    marked = parts[0].withColumn("check", F.col("txn_id") % 5 == 0)
    fitted = train_boosted(marked, FEW, validationIndicatorCol="check", maxIter=30, validationTol=0.5)
    assert fitted.model.stages[-1].getNumTrees < 30
