"""Quality classifier: hierarchical empirical Bayes over documents, paths and hosts.

A document's evidence comes from a classifier with two heads, poor quality and toxicity. It
looks at the shares of ``rules.features`` and at a learned lexicon: words and beginnings of
words (4 and 5 bytes) whose presence tells bad documents from good ones. The heads are
fitted on rows whose entries were counted over the other half of the labelled rows; documents
are then judged by the lexicon of both halves. Both use a bounded sample of at most ``Fit.labelled`` labelled rows, those with the smallest hashed ids,
and a lexicon of at most ``Fit.lexicon`` entries.

The probabilities of all documents are summed by host and path (partial sums before the
shuffle, so hot hosts do no harm). How much hosts differ from the whole, and paths from their
hosts, beyond what their sizes explain, gives the strength of two priors by the method of
moments. A host's rate is shrunk towards the global rate, a path's towards its host's; sparse
sites thus take their prior. The posterior odds of a document are the odds of its path's rate,
without the document itself, times the document's likelihood ratio. It is rejected from
``Fit.cut`` on.

The host is the part of ``source`` before the first slash (after any scheme), the path the
first segment behind it. A source without a path is divided by ``lang``, as sites keep their
languages apart.

Defined results: a null text is empty; null source and lang form groups of their own; rows
without ``doc_id`` are scored; repeated rows get equal results; without labels of both kinds a
head rejects nothing; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyguard.llm import rules, scan
from tallyguard.llm.work import batched, materialize, tidy

HEADS = ("poor", "toxic")
_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True


@dataclass(frozen=True)
class Fit:
    labelled: int = 40_000
    lexicon: int = 20_000
    least: int = 4  # bad documents that must hold a lexicon entry
    surprise: float = 15.0  # likelihood ratio statistic that an entry must reach
    ridge: float = 1e-4
    cut: float = 0.5


def grams(data: np.ndarray, bounds: np.ndarray, hasher: scan.Hasher) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every word and word beginning (repeats included)."""
    start, end = scan.runs(_WORD[data], bounds)
    row = np.searchsorted(bounds, start, side="right") - 1
    sums, rows, values = hasher.sums(data), [row], []
    values.append(hasher.of(sums, start, end))
    for size in (4, 5):
        long_ = end - start > size
        rows.append(row[long_])
        values.append(scan.mix(hasher.of(sums, start[long_], start[long_] + size) + np.uint64(size)))
    return np.concatenate(rows), np.concatenate(values)


def _slices(column: pa.Array):
    data, bounds = scan.text_buffer(column)
    for a, b in scan.slices(bounds):
        yield a, b, data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]


Lexicon = dict[str, tuple[np.ndarray, np.ndarray]]


def _lexicons(rows: DataFrame, fit: Fit) -> list[Lexicon]:
    """Hashes and log likelihood ratios of each head's entries: of half 0, of half 1, of both."""
    batched(rows.sparkSession)
    names = [f"{c}{h}" for h in (0, 1) for c in ("n", *HEADS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = scan.Hasher(31, fold=True)
        for batch in batches:
            flags = [np.ones(len(batch)), *[batch.column(h).to_numpy(zero_copy_only=False).astype(float) for h in HEADS]]
            half = batch.column("half").to_numpy()
            for a, b, data, bounds in _slices(batch.column("text")):
                row, value = grams(data, bounds, hasher)
                order, new = scan.firsts(row, value)
                row, value = row[order][new], value[order][new]
                entry, place = np.unique(value, return_inverse=True)
                counts = [
                    np.bincount(place, weights=(np.nan_to_num(f[a:b]) * (half[a:b] == h))[row], minlength=len(entry)) for h in (0, 1) for f in flags
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(entry.view(np.int64)), *[pa.array(c.astype(np.int64)) for c in counts]], names=["gram", *names]
                )

    counted = rows.mapInArrow(run, "gram long, " + ", ".join(f"{n} long" for n in names))
    counted = counted.groupBy("gram").agg(*[F.sum(n).alias(n) for n in names])
    counted = materialize(counted.where(F.greatest(*[F.col(f"{h}0") + F.col(f"{h}1") for h in HEADS]) >= fit.least), "grams")
    of_half = [rows.where(F.col("half") == h).agg(F.count("*").alias("n"), *[F.count_if(F.col(c)).alias(c) for c in HEADS]).first() for h in (0, 1)]
    return [_lexicon(counted, of_half, halves, fit) for halves in ((0,), (1,), (0, 1))]


def _lexicon(counted: DataFrame, of_half: list, halves: tuple[int, ...], fit: Fit) -> Lexicon:
    total = lambda c: float(sum(of_half[h][c] for h in halves))
    column = lambda c: sum((F.col(f"{c}{h}") for h in halves[1:]), F.col(f"{c}{halves[0]}")).cast("double")
    found = {}
    for head in HEADS:
        bad, all_ = total(head), total("n")
        if not 0 < bad < all_:
            found[head] = (np.zeros(0, dtype=np.uint64), np.zeros(0))
            continue
        a, n = column(head), column("n")
        b = n - a
        ratio = F.log(((a + 0.5) / (bad + 1)) / ((b + 0.5) / (all_ - bad + 1)))
        part = lambda x, e: F.when(x > 0, x * F.log(x / e)).otherwise(0.0)
        surprise = 2 * (part(a, n * (bad / all_)) + part(b, n * (1 - bad / all_)))
        top = (
            counted.where(a >= fit.least)
            .select("gram", ratio.alias("ratio"), surprise.alias("surprise"))
            .where(f"ratio > 1.5 AND surprise >= {fit.surprise}")
            .orderBy(F.desc("surprise"), "gram")
            .limit(fit.lexicon)
            .toPandas()
        )
        gram = top["gram"].to_numpy(dtype=np.int64).view(np.uint64)
        order = np.argsort(gram)
        found[head] = (gram[order], top["ratio"].to_numpy(dtype=float)[order])
    return found


def _vectors(column: pa.Array, lexicon: dict) -> np.ndarray:
    """Rows of features: constant, rule shares, then for each head the sum and the maximum of
    the ratios of the lexicon entries that the text holds."""
    stats = rules.text_stats(column)
    shares = rules.features(stats)
    length = np.log1p(stats["n_words"])[:, None] / 10
    style = np.concatenate((shares > 0, np.minimum(shares, 1.0), length, rules.base_failed(stats)[:, None]), axis=1)
    hasher = scan.Hasher(31, fold=True)
    lexical = np.zeros((len(column), 2 * len(HEADS)))
    for a, b, data, bounds in _slices(column):
        row, value = grams(data, bounds, hasher)
        for i, head in enumerate(HEADS):
            entry, ratio = lexicon[head]
            if not len(entry) or not len(value):
                continue
            at = np.minimum(np.searchsorted(entry, value), len(entry) - 1)
            hit = np.flatnonzero(entry[at] == value)
            order, new = scan.firsts(row[hit], at[hit])
            r, k = row[hit][order][new], at[hit][order][new]
            lexical[a:b, 2 * i] = np.minimum(scan.per_row(r, b - a, ratio[k]), 30.0)
            np.maximum.at(lexical[:, 2 * i + 1], a + r, ratio[k])
    return np.concatenate((np.ones((len(column), 1)), style.astype(float), lexical / 5), axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    """Weights by Newton steps; the constant is not shrunk."""
    w = np.zeros(x.shape[1])
    shrink = np.full(x.shape[1], ridge * len(y))
    shrink[0] = 1e-9
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(shrink + 1e-9), x.T @ (y - p) - shrink * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, fit: Fit) -> tuple[dict, dict[str, np.ndarray]]:
    """The lexicon and the weights of each head (none, if its labels are all alike)."""
    known = tidy(labels, doc_id="long", quality="int", toxic="int").where("doc_id IS NOT NULL AND coalesce(quality, toxic) IS NOT NULL")
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit.labelled)
    flags = known.select("doc_id", (F.col("quality") == 0).alias("poor"), (F.col("toxic") == 1).alias("toxic"))
    half = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(2)).cast("int")
    # At most ``fit.labelled`` ids: they go to the texts.
    flags = F.broadcast(materialize(flags, "flags"))
    rows = materialize(docs.select("doc_id", "text").join(flags, "doc_id").withColumn("half", half), "labelled")
    lexicons = _lexicons(rows, fit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            half = batch.column("half").to_numpy()
            x = np.where((half == 0)[:, None], _vectors(batch.column("text"), lexicons[1]), _vectors(batch.column("text"), lexicons[0]))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("doc_id", *HEADS)] + [lists], names=["doc_id", *HEADS, "x"])

    table = rows.mapInArrow(run, "doc_id long, poor boolean, toxic boolean, x array<double>").toPandas()
    table = table.sort_values("doc_id", kind="stable")
    weights = {}
    for head in HEADS:
        seen = table[table[head].notna()]
        y = seen[head].to_numpy(dtype=float)
        if len(y) and 0 < y.sum() < len(y):
            weights[head] = _logistic(np.stack(seen["x"].to_numpy()), y, fit.ridge)
    return lexicons[2], weights


def evidence(docs: DataFrame, lexicon: dict, weights: dict[str, np.ndarray]) -> DataFrame:
    """Per document the classifier's probability that it is bad, with its site."""
    batched(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _vectors(batch.column("text"), lexicon)
            fine = np.ones(len(x))
            for w in weights.values():
                fine *= 1 / (1 + np.exp(np.clip(x @ w, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("host"), batch.column("path"), pa.array(np.clip(1 - fine, 1e-9, 1 - 1e-9))],
                names=["doc_id", "host", "path", "p_doc"],
            )

    bare = F.regexp_replace(F.coalesce("source", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    segment = F.regexp_extract(bare, r"^[^/]*/([^/?#]*)", 1)
    sited = docs.select(
        "doc_id",
        "text",
        F.substring_index(bare, "/", 1).alias("host"),
        F.when(segment != "", segment).otherwise(F.coalesce("lang", F.lit(""))).alias("path"),
    )
    return materialize(sited.mapInArrow(run, "doc_id long, host string, path string, p_doc double"), "evidence")


def _strength(groups: DataFrame, rate: Column) -> float:
    """Prior strength from how group means vary beyond what their sizes explain."""
    sums = groups.agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.pow(F.col("p") / F.col("n") - rate, 2)).alias("between"),
        F.sum(rate * (1 - rate)).alias("noise"),
        F.sum(F.col("n") * rate * (1 - rate)).alias("spread"),
    ).first()
    if not sums["n"]:
        return 1.0
    variance = max((sums["between"] - sums["noise"]) / sums["n"], 0.0)
    within = sums["spread"] / sums["n"]
    return float(np.clip(within / max(variance, 1e-9) - 1, 1.0, 1e6))


def classified(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> DataFrame:
    """``doc_id, host, path, p_doc, site_rate, p_bad, kept`` for every document."""
    docs = tidy(docs, doc_id="long", text="string", source="string", lang="string")
    lexicon, weights = train(docs, labels, fit)
    scored = evidence(docs, lexicon, weights)
    paths = materialize(scored.groupBy("host", "path").agg(F.sum("p_doc").alias("p"), F.count("*").alias("n")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    total = paths.agg(F.sum("p").alias("p"), F.sum("n").alias("n")).first()
    rate = float(np.clip((total["p"] or 0.0) / (total["n"] or 1), 1e-6, 1 - 1e-6))
    k_host = _strength(hosts, F.lit(rate))
    shrunk = hosts.select("host", ((k_host * rate + F.col("p")) / (k_host + F.col("n"))).alias("host_rate"))
    sites = paths.join(shrunk, "host")
    k_path = _strength(sites, F.col("host_rate"))
    # The document's own share leaves its path before the path speaks about the document.
    own = (k_path * F.col("host_rate") + F.col("p") - F.col("p_doc")) / (k_path + F.col("n") - 1)
    joined = scored.join(sites.select("host", "path", "p", "n", "host_rate"), ["host", "path"])
    logit = lambda p: F.log(p / (1 - p))
    odds = logit(F.col("p_doc")) - float(np.log(rate / (1 - rate))) + logit(F.col("site_rate"))
    posterior = 1 / (1 + F.exp(-odds))
    return (
        joined.withColumn("site_rate", F.least(F.greatest(own, F.lit(1e-6)), F.lit(1 - 1e-6)))
        .withColumn("p_bad", F.lit(0.0) if not weights else posterior)
        .select("doc_id", "host", "path", "p_doc", "site_rate", "p_bad", (F.col("p_bad") < fit.cut).alias("kept"))
    )
