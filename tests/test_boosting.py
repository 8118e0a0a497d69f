"""Second-order trees against a search over the rows themselves."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tallyguard.operators.boosting import BoostedTrees, Boosting, score_boosted, train_boosted2
from tallyguard.operators.evaluation import auc
from tallyguard.operators.history import account_features, plant_fraud
from tallyguard.operators.split import split
from tallyguard.operators.training import NUMERIC

SCHEMA = "txn_id long, `a.b` double, `금액` double, kind string, w double, is_fraud int"


def some_rows(n=120, seed=3):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        a = draw.choice([None, float("nan"), *map(float, range(6))])
        b = draw.choice([None, -1.5, 0.0, 2.0, 2.5, 1e300])
        kind = draw.choice([None, "x", "y", "z"])
        odds = (a or 0 if a == a else 3) / 6 + (kind == "y") * 0.3 - (b is None) * 0.2
        rows.append((i, a, b, kind, draw.choice([1.0, 0.5, 2.0]), int(draw.random() < odds) if i % 17 else None))
    return rows


def missing(v):
    return v is None or v != v


def grown(rows, margins, s, depth):
    """The best tree by trying every split of the rows: (feature, left rows) or a leaf value."""
    soft = lambda g: math.copysign(max(abs(g) - s.l1, 0), g)

    def sums(part):
        g = h = 0.0
        for r in part:
            p = 1 / (1 + math.exp(-margins[r[0]]))
            g, h = g + r[4] * (p - r[5]), h + r[4] * p * (1 - p)
        return g, h

    def worth(part):
        g, h = sums(part)
        return soft(g) ** 2 / (h + s.l2)

    def splits(part):
        for f in (1, 2):
            values = sorted({r[f] for r in part if not missing(r[f])})
            for v in [*values, None]:
                for side in (True, False):
                    yield f, [r for r in part if (side if missing(r[f]) else v is None or r[f] < v)]
        kinds = sorted({r[3] for r in part if r[3]}, key=lambda k: (lambda gh: gh[0] / (gh[1] + s.l2))(sums([r for r in part if r[3] == k])))
        for cut in range(1, len(kinds) + 1):
            for side in (True, False):
                yield 3, [r for r in part if (side if r[3] is None else r[3] in kinds[:cut])]

    def node(part, left):
        best = None
        for f, low in splits(part) if left else ():
            ids = {r[0] for r in low}
            high = [r for r in part if r[0] not in ids]
            if min(sums(low)[1], sums(high)[1]) < s.least or not low or not high:
                continue
            gain = (worth(low) + worth(high) - worth(part)) / 2 - s.gamma
            if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                best = gain, f, low, high
        if best is None:
            g, h = sums(part)
            value = -soft(g) / (h + s.l2) * s.rate
            for r in part:
                margins[r[0]] += 0  # margins change after the tree is whole
            return [(r[0], value) for r in part], [("leaf", round(value, 6), len(part))]
        leaves, shape = [], [("split", best[1], round(best[0], 6))]
        for side in best[2:]:
            more, below = node(side, left - 1)
            leaves += more
            shape += below
        return leaves, shape

    return node(rows, depth)


def shape(model, tree, sizes, at=0):
    node = tree[at]
    if node.feature is None:
        return [("leaf", round(node.value, 6), sizes[at])]
    return [("split", node.feature + 1, round(node.gain, 6)), *shape(model, tree, sizes, node.left), *shape(model, tree, sizes, node.right)]


@pytest.mark.parametrize("s", [Boosting(trees=3, depth=3, least=0.5), Boosting(trees=2, depth=2, l1=0.4, l2=0.3, gamma=0.2, least=2.0, rate=1.0)])
def test_splits_and_leaves_equal_a_search_over_the_rows(spark, s):
    rows = some_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    edges = [sorted({r[f] for r in rows if not missing(r[f])}) for f in (1, 2)]
    model = train_boosted2(df, ["a.b", "금액"], category="kind", weight="w", settings=s, edges=edges)
    known = [r for r in rows if r[5] is not None]
    share = sum(r[4] * r[5] for r in known) / sum(r[4] for r in known)
    margins = {r[0]: math.log(share / (1 - share)) for r in rows}
    assert len(model.trees) == s.trees
    for tree in model.trees:
        leaves, wanted = grown(known, margins, s, s.depth)
        found = [x[:2] if x[0] == "leaf" else x for x in shape(model, tree, [0] * len(tree))]
        assert found == [x[:2] if x[0] == "leaf" else x for x in wanted]
        for i, value in leaves:
            margins[i] += value
    scores = {r.txn_id: r.p_fraud for r in score_boosted(model, df).collect()}
    for r in known:
        assert abs(scores[r[0]] - 1 / (1 + math.exp(-margins[r[0]]))) < 1e-6


def test_equal_tables_give_equal_trees_and_a_saved_model_scores_alike(spark, tmp_path):
    df = spark.createDataFrame(some_rows(400, 5), SCHEMA)
    s = Boosting(trees=10, depth=3, accuracy=0.0)
    models = [train_boosted2(df.repartition(n), ["a.b", "금액"], category="kind", settings=s) for n in (1, 5)]
    assert models[0].to_json() == models[1].to_json() and len(models[0].trees) == 10
    models[0].save(spark, str(tmp_path / "m"))
    loaded = BoostedTrees.load(spark, str(tmp_path / "m"))
    assert loaded == models[0] and abs(sum(loaded.importances.values()) - 1) < 1e-9
    unseen = spark.createDataFrame([(1, 1e9, float("-inf"), "new", 1.0, None), (2, None, None, None, 1.0, 1)], SCHEMA)
    assert all(0 < r.p_fraud < 1 for r in score_boosted(loaded, unseen).collect())


def test_odd_tables(spark):
    one = spark.createDataFrame([(i, 1.0, None, "x", 1.0, i % 2) for i in range(20)], SCHEMA)
    assert train_boosted2(one, ["a.b", "금액"], category="kind").trees == []  # nothing to split by
    with pytest.raises(ValueError, match="label"):
        train_boosted2(one.limit(0), ["a.b"])
    with pytest.raises(ValueError, match="values"):
        train_boosted2(one, ["a.b"], category="txn_id", max_kinds=5)
    sure = spark.createDataFrame([(i, float(i), None, None, 1.0, 1) for i in range(20)], SCHEMA)
    assert score_boosted(train_boosted2(sure, ["a.b"], category="kind"), sure).first().p_fraud > 0.99


def test_ranks_held_out_transactions(spark, middle):
    rows, held_out = split(plant_fraud(account_features(middle)))
    model = train_boosted2(rows, NUMERIC, category="channel", settings=Boosting(trees=15))
    assert auc(score_boosted(model, held_out)).first().auc > 0.8
    assert max(model.importances, key=model.importances.get) == "amount"
    assert "Python" not in score_boosted(model, held_out)._jdf.queryExecution().executedPlan().toString()
    assert held_out.where(F.col("prev_amount").isNull()).count() > 0
