"""Out-of-fold values against their definition; no label may reach its own row."""

import random

import pytest
from pyspark.sql import functions as F

from tallyguard.operators.boosting import Boosting, score_boosted, train_boosted2
from tallyguard.operators.encoding import Folds, encode_target, fold_of
from tallyguard.operators.evaluation import auc

SCHEMA = "txn_id long, `상점.id` string, is_fraud int"


def some_rows(n=300, kinds=12):
    draw = random.Random(2)
    return [(i, draw.choice([None, *map(str, range(kinds))]), draw.choice([0, 1, 1, None])) for i in range(n)]


def test_values_leave_their_own_fold_out(spark):
    rows, folds = some_rows(), Folds(folds=3, smooth=4.0)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    encoded, whole = encode_target(df, "상점.id", "is_fraud", "txn_id", "worth", folds)
    fold = {r.txn_id: r.f for r in df.select("txn_id", fold_of("txn_id", folds).alias("f")).collect()}
    found = {r.txn_id: r.worth for r in encoded.collect()}
    assert set(fold.values()) == {0, 1, 2} and len(found) == len(rows)

    def worth(kind, leave):
        other = [r for r in rows if r[2] is not None and fold[r[0]] != leave]
        same = [r[2] for r in other if r[1] == kind]
        return (sum(same) + 4 * sum(r[2] for r in other) / len(other)) / (len(same) + 4)

    for i, kind, _ in rows:
        assert abs(found[i] - worth(kind, fold[i])) < 1e-12
    new = spark.createDataFrame([(1, "3", None), (2, "never", None), (3, None, None)], SCHEMA)
    told = {r.txn_id: r.worth for r in whole.apply(new, "worth").collect()}
    assert abs(told[1] - worth("3", None)) < 1e-12 and abs(told[3] - worth(None, None)) < 1e-12
    assert abs(told[2] - whole.prior) < 1e-12


def test_no_label_enters_its_own_value(spark):
    rows = some_rows()
    values = []
    for flip in (False, True):
        changed = [(i, k, 1 - y if flip and i == 7 and y is not None else y) for i, k, y in rows]
        encoded, _ = encode_target(spark.createDataFrame(changed, SCHEMA), "상점.id", "is_fraud", "txn_id")
        values.append({r.txn_id: r.encoded for r in encoded.collect()})
    assert values[0][7] == values[1][7] and values[0] != values[1]
    with pytest.raises(ValueError):
        encode_target(spark.createDataFrame(rows, SCHEMA).limit(0), "상점.id", "is_fraud", "txn_id")


def test_very_many_kinds_train(spark):
    """A name for every three rows: far more than an index on the driver may hold. Only the bad ones matter."""
    base = spark.range(200_000).select(F.col("id").alias("txn_id"), (F.col("id") % 66_000).cast("string").alias("shop"))
    bad = F.pmod(F.xxhash64("shop"), F.lit(10)) < 3
    noise = F.pmod(F.xxhash64("txn_id", F.lit(5)), F.lit(100))
    df = base.withColumn("is_fraud", F.when(bad, noise < 85).otherwise(noise < 10).cast("int"))
    encoded, whole = encode_target(df, "shop", "is_fraud", "txn_id", folds=Folds(smooth=1.0))
    model = train_boosted2(encoded, ["encoded"], settings=Boosting(trees=3, depth=2))
    assert auc(score_boosted(model, encoded)).first().auc > 0.75
    assert whole.table.count() == 66_000
    # A category that is one row's own tells nothing.
    own, _ = encode_target(df.limit(20_000), "txn_id", "is_fraud", "txn_id")
    assert own.select("encoded").distinct().count() <= 5
