"""Quality rules: rule statistics of whole texts and an isolation forest over them.

A document fails the base rules when it is too short or repeats itself. The others are
judged by an isolation forest: random splits isolate an odd document on a short path. All
documents are dealt by hash among the trees, each to as many trees as it takes for
``Forest.points`` documents a tree, so none is left out of the forest. The trees grow level by level
from counts and ranges of their nodes, which Spark adds up; nothing else reaches the driver. The score
from which a document is odd is set on all labelled rows, from counts by score. Texts are read
once, for their statistics: no text is shuffled.

Defined results: a null text has no words and fails the base rules; a null ``doc_id`` is
scored like any other row; repeated rows give repeated results; an empty table gives an
empty result; without labelled rows of both classes the score from which a document is odd
is ``Forest.default``. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyguard.llm import scan
from tallyguard.llm.work import batched, materialize, tidy

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks")
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[list(b"!?")] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[ord("A") : ord("Z") + 1] = True


@dataclass(frozen=True)
class Forest:
    trees: int = 200
    points: int = 256
    default: float = 0.62
    keep_good: float = 0.995  # share of the rows labelled good that the threshold must keep
    seed: int = 11


def slice_stats(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """The statistics of each row of a slice."""
    rows = len(bounds) - 1
    start, end, row = scan.words(data, bounds)
    n = scan.per_row(row, rows)
    solid = ~scan.SPACE[data]
    characters = np.concatenate(([0], np.cumsum(solid & ((data & 0xC0) != 0x80))))
    count = lambda table: np.diff(np.concatenate(([0], np.cumsum(table[data])))[bounds])
    code, kinds = scan.coded(data, start, end)

    # Words inside three-word windows that the text holds twice or more.
    marked = np.zeros(len(start), dtype=bool)
    if len(start) > 2:
        at = np.flatnonzero(row[2:] == row[:-2])
        order, new = scan.firsts(row[at] * len(kinds) + code[at], code[at + 1] * len(kinds) + code[at + 2])
        group = np.cumsum(new) - 1
        again = at[order[np.bincount(group)[group] > 1]] if len(at) else at
        for step in range(3):
            marked[again + step] = True

    begin, stop = scan.runs(data != 10, bounds)
    filled = np.concatenate(([0], np.cumsum(solid)))
    with_word = filled[stop] > filled[begin]
    begin, stop = begin[with_word], stop[with_word]
    owner = np.searchsorted(bounds, begin, side="right") - 1
    line_order, line_new = scan.firsts(owner, scan.coded(data, begin, stop)[0])
    return {
        "n_words": n,
        "word_chars": np.diff(characters[bounds]),
        "n_symbols": count(_SYMBOL),
        "n_dup_lines": scan.per_row(owner[line_order][~line_new], rows),
        "n_repeat_words": scan.per_row(row[marked], rows),
        "n_upper": count(_UPPER),
        "n_lines": scan.per_row(owner, rows),
        "n_marks": count(_MARK),
    }


def text_stats(column: pa.Array) -> dict[str, np.ndarray]:
    """The statistics of every text of an Arrow column."""
    data, bounds = scan.text_buffer(column)
    parts = [slice_stats(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]) for a, b in scan.slices(bounds)]
    return {name: np.concatenate([p[name] for p in parts]) if parts else np.zeros(0, dtype=np.int64) for name in STATS}


# What a rule tolerates before its statistic counts, as shares of words,
# of lines with words and of letters. Ordinary documents differ below these at random.
TOLERATED = {"n_symbols": 0.1, "n_marks": 0.1, "n_dup_lines": 0.3, "n_repeat_words": 0.2, "n_upper": 0.3}


def features(stats: dict[str, np.ndarray]) -> np.ndarray:
    """By how much each statistic exceeds what its rule tolerates, whatever the length."""
    of = {
        "n_symbols": stats["n_words"],
        "n_marks": stats["n_words"],
        "n_dup_lines": stats["n_lines"],
        "n_repeat_words": stats["n_words"],
        "n_upper": stats["word_chars"],
    }
    shares = [np.maximum(0, stats[s] / np.maximum(of[s], 1) - limit) for s, limit in TOLERATED.items()]
    word_length = stats["word_chars"] / np.maximum(stats["n_words"], 1)
    odd_words = np.maximum(0, np.maximum(3 - word_length, word_length - 10))
    return np.stack([*shares, odd_words], axis=1)


def base_failed(stats: dict[str, np.ndarray]) -> np.ndarray:
    return (stats["n_words"] < 50) | (100 * stats["n_repeat_words"] > 50 * stats["n_words"])


def _mean_path(n: np.ndarray) -> np.ndarray:
    """Expected path length of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    harmonic = np.log(np.maximum(n - 1, 1)) + np.euler_gamma
    return np.where(n > 2, 2 * harmonic - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


class IsolationForest:
    """Random trees as flat arrays: split feature (-1: leaf), split value, left child, path length.

    The roots come first; ``size`` is the mean number of points of a tree.
    """

    def __init__(self, settings: Forest, size: float = 0.0):
        self.size, self.trees = size, settings.trees if size else 0
        self.depth = max(1, int(np.ceil(np.log2(max(min(settings.points, size), 2)))))
        self.feature, self.value = np.full(self.trees, -1), np.zeros(self.trees)
        self.left, self.path = np.zeros(self.trees, dtype=np.int64), np.zeros(self.trees)

    def split(self, nodes: dict[int, tuple], depth: int, rng: np.random.Generator) -> int:
        """Split the nodes of a level, given their counts, lows and highs; returns how many nodes came up."""
        known, more = len(self.feature), 0
        for node in sorted(nodes):
            count, low, high = nodes[node]
            open_ = np.flatnonzero(high > low) if depth < self.depth else []
            if not len(open_):
                self.path[node] = depth + float(_mean_path(count))
                continue
            f = int(rng.choice(open_))
            self.feature[node], self.value[node], self.left[node] = f, rng.uniform(low[f], high[f]), known + more
            more += 2
        self.feature, self.value = np.append(self.feature, np.full(more, -1)), np.append(self.value, np.zeros(more))
        # A child that gets no point keeps the path to it.
        self.left, self.path = np.append(self.left, np.zeros(more, dtype=np.int64)), np.append(self.path, np.full(more, depth + 1.0))
        return more

    def reached(self, x: np.ndarray, node: np.ndarray) -> np.ndarray:
        """The leaf that each row of ``x`` comes to from its node."""
        rows = np.arange(len(x))
        for _ in range(self.depth):
            f = self.feature[node]
            down = self.left[node] + (x[rows, np.maximum(f, 0)] >= self.value[node])
            node = np.where(f >= 0, down, node)
        return node

    def score(self, x: np.ndarray) -> np.ndarray:
        """Between 0 and 1; near 1 for points that few splits isolate."""
        if not self.trees or not len(x):
            return np.zeros(len(x))
        points, back = np.unique(x, axis=0, return_inverse=True)  # most documents exceed nothing
        total = np.zeros(len(points))
        for tree in range(self.trees):
            total += self.path[self.reached(points, np.full(len(points), tree))]
        return (2.0 ** (-total / self.trees / max(float(_mean_path(self.size)), 1e-9)))[back.reshape(-1)]


def threshold(score: np.ndarray, good: np.ndarray, bad: np.ndarray, settings: Forest) -> float:
    """The score from which most bad rows are caught while ``keep_good`` of the good ones stay.

    ``good`` and ``bad`` count the rows of each score; scores ascend.
    """
    if not good.sum() or not bad.sum():
        return settings.default
    upto = np.cumsum(good)
    place = (upto[-1] - 1) * settings.keep_good
    low, high = (score[np.searchsorted(upto, n, side="right")] for n in (np.floor(place), np.ceil(place)))
    at_least = score >= low + (high - low) * (place - np.floor(place))
    cuts = score[at_least]
    caught = ((bad.sum() - np.cumsum(bad)) / bad.sum() + upto / upto[-1])[at_least]
    best = np.flatnonzero(caught == caught.max())
    at = int(best[len(best) // 2])
    return float((cuts[at] + cuts[min(at + 1, len(cuts) - 1)]) / 2)


def stats_of(docs: DataFrame) -> DataFrame:
    """The rule statistics of every document."""
    batched(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = text_stats(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(stats[s], pa.int64()) for s in STATS]], names=["doc_id", *STATS]
            )

    schema = "doc_id long, " + ", ".join(f"{s} long" for s in STATS)
    return tidy(docs, doc_id="long", text="string").mapInArrow(run, schema)


# Scores are compared in steps of a millionth, which bounds the counts by score.
PLACES = 6
_FEATURES = [*TOLERATED, "odd_words"]


def _stats_in(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    return {s: batch.column(s).to_numpy(zero_copy_only=False) for s in STATS}


def _nodes(points: DataFrame, forest: IsolationForest, copies: int) -> dict[int, tuple]:
    """Count, lows and highs of the points in every leaf of the forest so far."""
    width = len(_FEATURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(_stats_in(batch))
            tree = (batch.column("deal").to_numpy()[:, None] + np.arange(copies)[None, :]).reshape(-1) % forest.trees
            x = np.repeat(x, copies, axis=0)
            node = forest.reached(x, tree)
            order = np.argsort(node, kind="stable")
            node, x = node[order], x[order]
            first = np.flatnonzero(np.diff(node, prepend=-1))
            if not len(first):
                continue
            count = np.diff(np.append(first, len(node)))
            parts = [node[first], count, *np.minimum.reduceat(x, first).T, *np.maximum.reduceat(x, first).T]
            yield pa.RecordBatch.from_arrays([pa.array(p) for p in parts], names=names)

    names = ["node", "n", *[f"low_{i}" for i in range(width)], *[f"high_{i}" for i in range(width)]]
    schema = "node long, n long, " + ", ".join(f"{name} double" for name in names[2:])
    lows, highs = ([how(name).alias(name) for name in names[a:b]] for how, a, b in ((F.min, 2, 2 + width), (F.max, 2 + width, len(names))))
    found = points.mapInArrow(run, schema).groupBy("node").agg(F.sum("n").alias("n"), *lows, *highs)
    # At most trees x points rows, whatever the number of documents.
    return {r[0]: (r[1], np.array(r[2 : 2 + width]), np.array(r[2 + width :])) for r in found.collect()}


def grow(stats: DataFrame, settings: Forest) -> IsolationForest:
    """The forest over all rows of statistics that pass the base rules."""
    failed = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"
    usable = stats.where(f"NOT ({failed})")
    deal = F.pmod(F.xxhash64("doc_id", *STATS), F.lit(settings.trees))
    points = usable.select(*STATS, deal.alias("deal"))
    n = points.count()
    # To one tree each, or to more of them where that leaves a tree with few points.
    copies = min(settings.trees, -(-settings.trees * settings.points // max(n, 1)))
    forest = IsolationForest(settings, n * copies / settings.trees)
    rng = np.random.default_rng(settings.seed)
    level = 0
    for depth in range(forest.depth + 1 if forest.trees else 0):
        nodes = {node: found for node, found in _nodes(points, forest, copies).items() if node >= level}
        level = len(forest.feature)
        if not forest.split(nodes, depth, rng):
            break
    return forest


def _scored(stats: DataFrame, forest: IsolationForest) -> DataFrame:
    """The statistics with ``base_failed`` and ``oddness``."""
    names = [*stats.columns, "base_failed", "oddness"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = _stats_in(batch)
            odd = np.round(forest.score(features(known)), PLACES)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(base_failed(known)), pa.array(odd)], names=names)

    schema = ", ".join(f"{name} {kind}" for name, kind in stats.dtypes) + ", base_failed boolean, oddness double"
    return stats.mapInArrow(run, schema)


def fit(stats: DataFrame, labels: DataFrame, settings: Forest = Forest()) -> tuple[IsolationForest, float]:
    """The forest and the score above which a document is odd, from all rows of ``stats_of`` and all labels."""
    forest = grow(stats, settings)
    good = tidy(labels, doc_id="long", quality="int").where("doc_id IS NOT NULL AND quality IS NOT NULL")
    good = good.groupBy("doc_id").agg((F.min("quality") == 1).cast("long").alias("good"))
    known = _scored(stats.join(good, "doc_id"), forest).where("NOT base_failed")
    counts = known.groupBy("oddness").agg(F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad"))
    table = sorted(counts.collect())  # a million rows at most
    score, good_rows, bad_rows = (np.array([r[i] for r in table], dtype=float) for i in range(3))
    return forest, threshold(score, good_rows, bad_rows, settings)


def quality_rules(docs: DataFrame, labels: DataFrame, settings: Forest = Forest()) -> DataFrame:
    """Per document the base statistics, whether they fail it, its oddness and the verdict."""
    stats = materialize(stats_of(docs), "stats")
    batched(docs.sparkSession, 10_000)  # rows of numbers from here on
    forest, cut = fit(stats, labels, settings)
    kept = ~F.col("base_failed") & (F.col("oddness") <= cut)
    return _scored(stats, forest).select("doc_id", *STATS[:5], "base_failed", kept.alias("kept"), "oddness")
