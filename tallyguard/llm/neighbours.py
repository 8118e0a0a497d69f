"""Nearest neighbours by multi-index hashing over learned rotated binary codes.

On a bounded sample of vectors (``Index.sample``) rotations are learned: after centring, each
of ``Index.frames`` random rotations is turned step by step towards its own signs (iterative
quantization), so that the signs of the rotated vector lose little. All signs together are
the code. Every vector is indexed: its code is split into bytes, and each byte has a table
from value to vectors. Two codes within a Hamming radius r agree, in at least one of m
bytes, up to floor(r / m) bits (pigeonhole), so probing those table entries retrieves every
code within the radius. These are ranked by their inner products in double precision.

The radius is set on the sample: it holds ``Index.hold`` of the true neighbours there. In a
larger table the nearest neighbours are nearer, so it errs to the safe side. A query that
retrieves fewer than ``k`` vectors is searched once more with the largest radius, which
retrieves all.

Queries and vectors meet in blocks of at most ``Index.queries`` and ``Index.rows`` on
average, dealt by hashed id, so no vector, however often repeated, makes a block large.
Each block pair hands on its best ``k`` per query.

Defined results: vectors that are null, zero, or with null or non-finite components take no
part, nor do rows without ``vec_id``; vectors of different lengths have no inner product, so
each length is a search of its own (more than ``Index.lengths`` lengths are an error);
ties go to the smaller ``vec_id``; with repeated ids each row counts, but none with the
query's own id; fewer than ``k`` candidates are all returned; an empty table gives an empty
result. Other columns of the input are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyguard.llm.work import materialize, ship_code


@dataclass(frozen=True)
class Index:
    k: int = 20
    frames: int = 4
    turns: int = 15
    sample: int = 8192
    probes: int = 256
    hold: float = 0.97
    queries: int = 2048
    rows: int = 8192
    seed: int = 3
    lengths: int = 64


FEW = 16  # table entries that are probed one by one


class Codes:
    """Learned rotations, and the radius that finds the wanted share of neighbours."""

    def __init__(self, sample: np.ndarray, index: Index):
        rng = np.random.default_rng(index.seed)
        unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
        self.mean = unit.mean(axis=0)
        centred = unit - self.mean
        dims = sample.shape[1]
        frames = []
        for _ in range(index.frames):
            turn = np.linalg.qr(rng.normal(size=(dims, dims)))[0]
            for _ in range(index.turns):
                u, _, vt = np.linalg.svd(np.sign(centred @ turn).T @ centred)
                turn = (u @ vt).T
            frames.append(turn)
        self.frames = np.concatenate(frames, axis=1)
        self.radius = self._radius(sample, index)

    def encode(self, x: np.ndarray) -> np.ndarray:
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        return np.packbits((unit - self.mean) @ self.frames > 0, axis=1)

    def _radius(self, sample: np.ndarray, index: Index) -> int:
        queries = sample[: index.probes]
        if len(sample) <= index.k:
            return 8 * self.encode(sample[:1]).shape[1]
        scores = queries @ sample.T
        scores[np.arange(len(queries)), np.arange(len(queries))] = -np.inf
        near = np.argpartition(-scores, index.k - 1, axis=1)[:, : index.k]
        codes = self.encode(sample)
        far = np.bitwise_count(codes[: len(queries), None, :] ^ codes[near]).sum(axis=2, dtype=np.int64)
        return int(np.quantile(far, index.hold, method="higher"))


class Tables:
    """One table for each byte of the codes of a block of vectors."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = np.argsort(codes, axis=0, kind="stable")
        ordered = np.take_along_axis(codes, self.order, axis=0)
        self.starts = np.stack([np.searchsorted(ordered[:, j], np.arange(257)) for j in range(codes.shape[1])])

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code differs from ``code`` in at most ``radius`` bits."""
        share = radius // len(code)
        hit = np.zeros(len(self.codes), dtype=bool)
        values = np.arange(256, dtype=np.uint8)
        for j, byte in enumerate(code):
            probed = np.bitwise_count(values ^ byte) <= share
            if probed.sum() > FEW:
                # So many entries that reading the byte of every row costs less.
                hit |= probed[self.codes[:, j]]
                continue
            for value in np.flatnonzero(probed).tolist():
                hit[self.order[self.starts[j, value] : self.starts[j, value + 1], j]] = True
        rows = np.flatnonzero(hit)
        return rows[np.bitwise_count(self.codes[rows] ^ code).sum(axis=1, dtype=np.int64) <= radius]


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, v`` as doubles, without vectors that take no part."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    bad: Column = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    return rows.where("vec_id IS NOT NULL AND v IS NOT NULL").where(~bad).where(F.exists("v", lambda x: x != 0))


def _searched(rows: DataFrame, queries: DataFrame, codes: Codes, radius: int, index: Index, n: int, q: int) -> DataFrame:
    """The best ``k`` of every block pair: ``query_id, vec_id, score``."""
    data_parts, query_parts = max(1, math.ceil(n / index.rows)), max(1, math.ceil(q / index.queries))

    def dealt(df: DataFrame, own: int, others: int, mine: str, theirs: str) -> DataFrame:
        part = F.pmod(F.xxhash64("vec_id", F.lit(index.seed)), F.lit(own))
        return df.select("vec_id", "v", part.alias(mine), F.explode(F.expr(f"sequence(0L, {others - 1}L)")).alias(theirs))

    left = dealt(queries, query_parts, data_parts, "q", "d").groupBy("q", "d")
    right = dealt(rows, data_parts, query_parts, "d", "q").groupBy("q", "d")

    def run(some: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(some) or not len(block):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        block = block.sort_values("vec_id", kind="stable")
        ids, x = block["vec_id"].to_numpy(), np.stack(block["v"].to_numpy())
        query_ids, wanted = some["vec_id"].to_numpy(), np.stack(some["v"].to_numpy())
        tables = Tables(codes.encode(x))
        out = []
        for query_id, vector, code in zip(query_ids, wanted, codes.encode(wanted)):
            found = tables.within(code, radius)
            found = found[ids[found] != query_id]
            # Row by row, so that equal vectors have equal scores wherever they lie.
            score = np.einsum("ij,j->i", x[found], vector)
            best = np.lexsort((ids[found], -score))[: index.k]
            out.append((np.full(len(best), query_id), ids[found[best]], score[best]))
        query_id, vec_id, score = (np.concatenate(c) for c in zip(*out))
        return pd.DataFrame({"query_id": query_id, "vec_id": vec_id, "score": score})

    return left.cogroup(right).applyInPandas(run, "query_id long, vec_id long, score double")


def _of_one_length(rows: DataFrame, every: int, index: Index) -> DataFrame:
    """The best neighbours ``query_id, vec_id, score`` among vectors of equal length."""
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(index.sample).collect()
    codes = Codes(np.array([r["v"] for r in sample]), index)
    queries = rows.where(F.col("vec_id") % every == 0)
    counts = rows.agg(F.count("*").alias("n"), F.count_if(F.col("vec_id") % every == 0).alias("q")).first()
    found = materialize(_searched(rows, queries, codes, codes.radius, index, counts["n"], counts["q"]), "found")
    full = found.groupBy("query_id").count().where(F.col("count") >= index.k).select(F.col("query_id").alias("vec_id"))
    few = materialize(queries.join(full, "vec_id", "left_anti"), "few")
    left = few.count()
    if left:
        bits = 8 * codes.encode(np.array([sample[0]["v"]])).shape[1]
        again = _searched(rows, few, codes, bits, index, counts["n"], left)
        found = found.join(few.select(F.col("vec_id").alias("query_id")).distinct(), "query_id", "left_anti").unionByName(again)
    return found


def neighbours(vectors: DataFrame, every: int = 20, index: Index = Index()) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    ship_code(spark)
    rows = usable(vectors)
    lengths = sorted(r[0] for r in rows.select(F.size("v")).distinct().limit(index.lengths + 1).collect())
    if len(lengths) > index.lengths:
        raise ValueError(f"vectors of more than {index.lengths} lengths")
    found = spark.createDataFrame([], "query_id long, vec_id long, score double")
    for length in lengths:
        found = found.unionByName(_of_one_length(rows.where(F.size("v") == length), every, index))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= index.k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
