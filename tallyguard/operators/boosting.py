"""Second-order boosted trees, grown by grouped sums of gradients and hessians.

Every row has the gradient g and the hessian h of the logistic loss at its present margin. A
tree grows level by level: one grouped pass sums g and h over (node, feature, bin), and from
these few sums the split of every node follows. With G and H for a side's sums, a split gains

    (T(G_l)^2 / (H_l + l2) + T(G_r)^2 / (H_r + l2) - T(G)^2 / (H + l2)) / 2 - gamma

where T moves G by ``l1`` towards zero, and a leaf adds -T(G) / (H + l2) * rate to the margin.
Rows whose value is missing (null or NaN) have a bin of their own and go to the side that gains
more. Numbers are binned at quantiles, from a sketch over all rows; the values of a category
are put in the order of their G / H at each node, and that order is split.

At scale: a level costs one scan of the binned table, a byte or so per feature and row, and the
grouped sums are combined before their shuffle. What reaches the driver are the sums, at most
2^depth nodes x features x bins, whatever the number of rows. Sums are taken over integers, so
equal tables give equal trees however they are partitioned. Margins are written every
``REWRITE`` trees; in between the latest trees are part of the pass's expression.
"""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass, field

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyguard.functions import quoted, sigmoid
from tallyguard.operators.training import MAX_KINDS
from tallyguard.session import materialize

REWRITE = 8


@dataclass(frozen=True)
class Boosting:
    """How trees are grown; ``accuracy`` is the relative rank error of the quantiles."""

    trees: int = 20
    depth: int = 4
    rate: float = 0.3
    l2: float = 1.0
    l1: float = 0.0
    gamma: float = 0.0
    least: float = 1.0  # hessian that a side must have
    bins: int = 64
    accuracy: float = 0.001


@dataclass
class Node:
    """A split, or a leaf with its ``value``.

    Rows with less than ``below``, or of ``kinds``, go left; without either all but missing ones do.
    """

    gradient: float
    hessian: float
    feature: int | None = None
    cut: int | None = None
    below: float | None = None
    kinds: list[str] | None = None
    missing_left: bool = True
    gain: float = 0.0
    left: int | None = None
    right: int | None = None
    value: float = 0.0


@dataclass
class BoostedTrees:
    """A fitted model. Trees are lists of nodes, the root first."""

    numeric: list[str]
    category: str | None
    edges: list[list[float]]
    kinds: list[str]
    base: float
    trees: list[list[Node]] = field(default_factory=list)

    @property
    def features(self) -> list[str]:
        return [*self.numeric, *([self.category] if self.category else [])]

    @property
    def importances(self) -> dict[str, float]:
        """Each feature's share of the gain."""
        gains = dict.fromkeys(self.features, 0.0)
        for tree in self.trees:
            for node in tree:
                if node.feature is not None:
                    gains[self.features[node.feature]] += node.gain
        total = sum(gains.values())
        return {name: gain / total if total else 0.0 for name, gain in gains.items()}

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> "BoostedTrees":
        read = json.loads(text)
        return cls(**{**read, "trees": [[Node(**n) for n in tree] for tree in read["trees"]]})

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(self.to_json(),)], "value string").coalesce(1).write.text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "BoostedTrees":
        return cls.from_json(spark.read.text(path, wholetext=True).first()[0])


def _number(name: str) -> Column:
    """A feature as a number, null where it is missing."""
    return F.nanvl(F.col(quoted(name)).cast("double"), F.lit(None).cast("double"))


def _walk(tree: list[Node], goes_left, at: int = 0) -> Column:
    """The value of the leaf that a row ends in."""
    node = tree[at]
    if node.feature is None:
        return F.lit(float(node.value))
    return F.when(goes_left(node), _walk(tree, goes_left, node.left)).otherwise(_walk(tree, goes_left, node.right))


def margin(model: BoostedTrees) -> Column:
    """The sum of base and leaves as an expression over the columns of the features."""

    def goes_left(node: Node) -> Column:
        name = model.features[node.feature]
        if node.kinds is None:
            # Without an edge all numbers go left, infinity too.
            left = _number(name).isNotNull() if node.below is None else _number(name) < float(node.below)
            return F.when(_number(name).isNull(), F.lit(node.missing_left)).otherwise(left)
        kind = F.col(quoted(name)).cast("string")
        # A value that training has not seen counts as missing.
        known = F.when(kind.isin(model.kinds), kind.isin(node.kinds))
        return F.coalesce(known, F.lit(node.missing_left))

    total = F.lit(float(model.base))
    for tree in model.trees:
        total = total + _walk(tree, goes_left)
    return total


def score_boosted(model: BoostedTrees, df: DataFrame) -> DataFrame:
    """Add ``p_fraud``; an expression, on a batch or a stream, and no row moves."""
    return df.withColumn("p_fraud", sigmoid(margin(model)))


# growing


def _binned(df: DataFrame, numeric: list[str], category: str | None, label: str, weight: str | None, edges, accuracy: float, bins: int, max_kinds: int):
    """The table ``_bins, _label, _weight, _margin`` to learn from, the edges of its bins and the kinds."""
    kind = F.col(quoted(category)).cast("string") if category else F.lit(None).cast("string")
    rows = df.select(
        *[F.coalesce(_number(c), F.lit(float("nan"))).alias(f"_num_{i}") for i, c in enumerate(numeric)],
        kind.alias("_kind"),
        F.col(quoted(label)).cast("double").alias("_label"),
        (F.col(quoted(weight)).cast("double") if weight else F.lit(1.0)).alias("_weight"),
    ).where("_label IS NOT NULL AND _weight > 0")
    names = [f"_num_{i}" for i in range(len(numeric))]
    if edges is None:
        found = rows.select([F.nanvl(c, F.lit(None).cast("double")).alias(c) for c in names]).approxQuantile(
            names, [i / bins for i in range(1, bins)], accuracy
        )
        edges = found
    # Infinite values share a bin with the greatest or smallest others.
    edges = [sorted({float(x) for x in column if math.isfinite(x)}) for column in edges]
    kinds: list[str] = []
    if category:
        kinds = sorted(r[0] for r in rows.select("_kind").where("_kind IS NOT NULL").distinct().limit(max_kinds + 1).collect())
        if len(kinds) > max_kinds:
            raise ValueError(f"{category!r} has more than {max_kinds} values")
    cut = [i for i in range(len(numeric)) if edges[i]]
    if cut:
        rows = Bucketizer(
            inputCols=[names[i] for i in cut], outputCols=[f"_bin_{i}" for i in cut],
            splitsArray=[[-math.inf, *edges[i], math.inf] for i in cut], handleInvalid="keep",
        ).transform(rows)
    # A number without edges has one bin, besides that of the missing.
    columns = [F.col(f"_bin_{i}") if edges[i] else F.isnan(names[i]).cast("int") for i in range(len(numeric))]
    if category:
        columns.append(F.coalesce(F.array_position(F.lit(kinds) if kinds else F.array().cast("array<string>"), F.col("_kind")) - 1, F.lit(len(kinds))))
        columns[-1] = F.when(columns[-1] < 0, len(kinds)).otherwise(columns[-1])
    table = rows.select(F.array(*[c.cast("smallint") for c in columns]).alias("_bins"), "_label", "_weight")
    return table, edges, kinds


def _sides(node: Node, sizes: list[int], order: dict[int, list[int]], at: int) -> Column:
    """Whether a binned row goes left at a node."""
    bin_ = F.get("_bins", F.lit(node.feature))
    left = bin_.isin(order[at][: node.cut]) if node.kinds is not None else bin_ < node.cut
    return F.when(bin_ == sizes[node.feature], F.lit(node.missing_left)).otherwise(left)


def _soft(gradient, l1: float):
    return np.sign(gradient) * np.maximum(np.abs(gradient) - l1, 0)


def _best_split(g: list[np.ndarray], h: list[np.ndarray], grouped: set[int], set_: Boosting):
    """The best split from a node's sums per feature and bin, the missing ones last.

    Ties go to the first feature, then the smallest cut, then to missing rows on the left.
    Returns gain, feature, cut, missing_left, the order of the bins, and the left side's sums.
    """
    total_g, total_h = g[0].sum(), h[0].sum()
    at_rest = _soft(total_g, set_.l1) ** 2 / (total_h + set_.l2)
    best = None
    for f, (gs, hs) in enumerate(zip(g, h)):
        order = np.arange(len(gs) - 1)
        if f in grouped:
            present = np.flatnonzero(hs[:-1] > 0)
            order = present[np.argsort(gs[present] / (hs[present] + set_.l2), kind="stable")]
        left_g, left_h = np.cumsum(gs[order]), np.cumsum(hs[order])
        if not len(order):
            continue
        # One row per cut: missing ones on the left, missing ones on the right.
        lg, lh = (np.stack((left + all_[-1], left), axis=1) for left, all_ in ((left_g, gs), (left_h, hs)))
        rg, rh = total_g - lg, total_h - lh
        gains = (_soft(lg, set_.l1) ** 2 / (lh + set_.l2) + _soft(rg, set_.l1) ** 2 / (rh + set_.l2) - at_rest) / 2 - set_.gamma
        gains = np.where((lh >= set_.least) & (rh >= set_.least) & (lh > 0) & (rh > 0), gains, -np.inf)
        most = gains.max()
        if most > 0 and (best is None or most > best[0] * (1 + 1e-9)):
            cut, side = divmod(int(np.argmax(gains.ravel() >= most * (1 - 1e-9))), 2)
            best = (float(most), f, cut + 1, side == 0, order.tolist(), float(lg[cut, side]), float(lh[cut, side]))
    return best


def _grow(table: DataFrame, at_margin: Column, model: BoostedTrees, set_: Boosting, unit: float) -> tuple[list[Node], dict[int, list[int]]]:
    """One tree, a grouped pass per level; and the order of the bins at nodes that split a category."""
    sizes = [len(e) + 1 for e in model.edges] + ([len(model.kinds)] if model.category else [])
    grouped = {len(model.numeric)} if model.category else set()
    tree, order, open_ = [Node(0.0, 0.0)], {}, [0]
    p = sigmoid(at_margin)
    whole = lambda x: F.rint(x * unit).cast("long")
    rows = table.select(
        "_bins", whole(F.col("_weight") * (p - F.col("_label"))).alias("_g"), whole(F.col("_weight") * p * (1 - p)).alias("_h")
    )
    for _ in range(set_.depth):

        def node_of(at: int = 0) -> Column:
            if tree[at].feature is None:
                return F.lit(at if at in open_ else -1)
            return F.when(_sides(tree[at], sizes, order, at), node_of(tree[at].left)).otherwise(node_of(tree[at].right))

        sums = (
            rows.withColumn("_node", node_of())
            .where("_node >= 0")
            .select("_node", "_g", "_h", F.posexplode("_bins").alias("_feature", "_bin"))
            .groupBy("_node", "_feature", "_bin")
            .agg(F.sum("_g").alias("g"), F.sum("_h").alias("h"))
            .toArrow()
        )
        node, feature, bin_ = (sums.column(c).to_numpy() for c in ("_node", "_feature", "_bin"))
        g, h = (sums.column(c).to_numpy() / unit for c in ("g", "h"))
        following = []
        for at in open_:
            mine = [np.flatnonzero((node == at) & (feature == f)) for f in range(len(sizes))]
            gs, hs = [np.zeros(s + 1) for s in sizes], [np.zeros(s + 1) for s in sizes]
            for f, i in enumerate(mine):
                gs[f][bin_[i]], hs[f][bin_[i]] = g[i], h[i]
            this = tree[at]
            this.gradient, this.hessian = float(gs[0].sum()), float(hs[0].sum())
            found = _best_split(gs, hs, grouped, set_)
            if found is None:
                continue
            this.gain, this.feature, this.cut, this.missing_left, order_, left_g, left_h = found
            if this.feature in grouped:
                order[at] = order_
                this.kinds = [model.kinds[i] for i in order_[: this.cut]]
            else:
                this.below = model.edges[this.feature][this.cut - 1] if this.cut <= len(model.edges[this.feature]) else None
            this.left, this.right = len(tree), len(tree) + 1
            tree.append(Node(left_g, left_h))
            tree.append(Node(this.gradient - left_g, this.hessian - left_h))
            following += [this.left, this.right]
        open_ = following
        if not open_:
            break
    for node_ in tree:
        if node_.feature is None:
            node_.value = float(-_soft(node_.gradient, set_.l1) / (node_.hessian + set_.l2) * set_.rate) if node_.hessian + set_.l2 > 0 else 0.0
    return tree, order


def train_boosted2(
    df: DataFrame,
    numeric: list[str],
    label: str = "is_fraud",
    category: str | None = None,
    weight: str | None = None,
    settings: Boosting = Boosting(),
    edges: list[list[float]] | None = None,
    max_kinds: int = MAX_KINDS,
) -> BoostedTrees:
    """Fit second-order boosted trees to a 0/1 label; rows without one are left out.

    ``df`` should be a written table. ``edges`` gives the bins of the numbers instead of
    quantiles: a value is below the first edge that is greater than it.
    """
    table, edges, kinds = _binned(df, numeric, category, label, weight, edges, settings.accuracy, settings.bins, max_kinds)
    table = materialize(table, "binned")
    total = table.agg(F.sum("_weight").alias("w"), F.sum(F.col("_weight") * F.col("_label")).alias("y")).first()
    if not total.w:
        raise ValueError("no row has a label")
    share = min(max(total.y / total.w, 1e-6), 1 - 1e-6)
    model = BoostedTrees(list(numeric), category, edges, kinds, math.log(share / (1 - share)))
    # Sums of all rows must fit into 63 bits.
    unit = 2.0 ** min(50, 61 - math.ceil(math.log2(total.w + 1)))
    sizes = [len(e) + 1 for e in edges] + ([len(kinds)] if category else [])
    table = table.withColumn("_margin", F.lit(model.base))
    at_margin = F.col("_margin")
    for number in range(settings.trees):
        tree, order = _grow(table, at_margin, model, settings, unit)
        if tree[0].feature is None:
            break  # nothing is gained any more
        model.trees.append(tree)
        places = {id(n): i for i, n in enumerate(tree)}
        at_margin = at_margin + _walk(tree, lambda n, p=places, o=order: _sides(n, sizes, o, p[id(n)]))
        if (number + 1) % REWRITE == 0 and number + 1 < settings.trees:
            table = materialize(table.withColumn("_margin", at_margin), "margins")
            at_margin = F.col("_margin")
    return model
