"""Best-fit packing of documents into token sequences, with certified bin counts.

Documents longer than a sequence are cut; whole pieces fill a sequence each. All other
pieces are dealt to partitions by hash and packed there by best fit in the order of
decreasing length. Dual-feasible functions give a lower bound on the sequences that a
partition needs; a partition that meets its bound is certified and stays. From the others,
the sequences with gaps give their pieces up; these are exchanged, that is dealt anew among
fewer, mixed partitions, and packed again. A new packing is taken only if it needs fewer
sequences. The rounds end when nothing is gained.

The longest group that a task gets holds about ``Sizes.items`` pieces of a few numbers each.

Defined results: a null text is empty and has the end id only; rows without ``doc_id`` and
rows that repeat one are packed as documents of their own; an empty table gives an empty
result. Other columns of the input are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyguard.llm.tokens import encoder
from tallyguard.llm.work import batched, materialize, ship_code, tidy


@dataclass(frozen=True)
class Sizes:
    capacity: int = 2048
    items: int = 16_384
    rounds: int = 4


def pieces_of(docs: DataFrame, path: str, sizes: Sizes) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and a number ``item`` of every piece."""
    batched(docs.sparkSession)
    capacity = sizes.capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(path)
        for batch in batches:
            for a, b, ids, bounds in tokens.column(batch.column("text")):
                n = np.diff(bounds)
                short = n % capacity
                count = n // capacity + (short > 0)
                row = np.repeat(np.arange(b - a), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                head = np.where(short > 0, short, capacity)[row]
                start = np.where(piece > 0, head + (piece - 1) * capacity, 0)
                length = np.where(piece > 0, capacity, head)
                raw, at = ids.astype("<u4").tobytes(), 4 * (bounds[row] + start)
                crc = [zlib.crc32(raw[x:y]) for x, y in zip(at.tolist(), (at + 4 * length).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(row + a)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    found = tidy(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")
    return materialize(found.withColumn("item", F.monotonically_increasing_id()), "pieces")


def lower_bound(length: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs: the best of several dual-feasible functions."""
    if not len(length):
        return 0
    count = np.bincount(length, minlength=capacity + 1)
    size = np.arange(capacity + 1)
    best = -(-int((count * size).sum()) // capacity)
    # For each threshold e: long items count whole, items shorter than e not at all.
    total = np.concatenate(([0], np.cumsum(count)))
    words = np.concatenate(([0], np.cumsum(count * size)))
    e = np.arange(1, capacity // 2 + 1)
    large = total[-1] - total[capacity - e + 1]
    middle = words[capacity - e + 1] - words[e]
    best = max(best, int((-(-(capacity * large + middle) // capacity)).max()))
    for k in range(1, 33):
        exact = (k + 1) * size % capacity == 0
        value = np.where(exact, size * k, (k + 1) * size // capacity * capacity)  # times k
        best = max(best, -(-int((count * value).sum()) // (capacity * k)))
    return best


def best_fit_decreasing(length: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every item."""
    bin_, offset = np.zeros(len(length), dtype=np.int64), np.zeros(len(length), dtype=np.int64)
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by what is left
    left, bins = 0, 0  # a bit for every amount that some bin has left
    for i in np.argsort(-length, kind="stable").tolist():
        size = int(length[i])
        fits = left >> size
        if fits:
            gap = size + (fits & -fits).bit_length() - 1
            b = open_[gap].pop()
            if not open_[gap]:
                left ^= 1 << gap
        else:
            gap, b = capacity, bins
            bins += 1
        bin_[i], offset[i] = b, capacity - gap
        rest = gap - size
        if rest:
            if not open_[rest]:
                left |= 1 << rest
            open_[rest].append(b)
    return bin_, offset


_PACKED = "item long, length long, part long, bin long, offset long, filled long, bins long, bound long"


def _packed(items: DataFrame, parts: int, salt: int, capacity: int) -> DataFrame:
    """Pack ``item, length`` in ``parts`` hashed partitions."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        length = group["length"].to_numpy()
        order = np.argsort(group["item"].to_numpy(), kind="stable")
        bin_, offset = np.zeros(len(order), dtype=np.int64), np.zeros(len(order), dtype=np.int64)
        bin_[order], offset[order] = best_fit_decreasing(length[order], capacity)
        filled = np.bincount(bin_, weights=length).astype(np.int64)
        return group.assign(bin=bin_, offset=offset, filled=filled[bin_], bins=len(filled), bound=lower_bound(length, capacity))

    part = F.pmod(F.xxhash64("item", F.lit(salt)), F.lit(parts)).cast("long")
    dealt = items.select("item", "length", part.alias("part"))
    return materialize(dealt.groupBy("part").applyInPandas(run, _PACKED), "packed")


def _bins(packed: DataFrame) -> int:
    return packed.select("part", "bins").distinct().agg(F.sum("bins")).first()[0] or 0


def pack_items(items: DataFrame, sizes: Sizes) -> DataFrame:
    """``item, seq_part, bin, offset, certified`` for items shorter than a sequence."""
    n = items.count()
    parts = max(1, math.ceil(n / sizes.items))
    now = _packed(items, parts, 0, sizes.capacity)
    done = None
    for turn in range(1, sizes.rounds + 1):
        final = (F.col("bins") == F.col("bound")) | (F.col("filled") == sizes.capacity)
        kept = now.where(final).select("item", F.lit(turn).alias("turn"), "part", "bin", "offset", (F.col("bins") == F.col("bound")).alias("certified"))
        done = kept if done is None else done.unionByName(kept)
        loose = now.where(~final)
        before, n = loose.select("part", "bin").distinct().count(), loose.count()
        if not n:
            return done
        again = _packed(loose.select("item", "length"), max(1, math.ceil(n / sizes.items)), turn, sizes.capacity)
        if _bins(again) >= before:
            now = loose
            break
        now = again
    rest = now.select("item", F.lit(sizes.rounds + 1).alias("turn"), "part", "bin", "offset", (F.col("bins") == F.col("bound")).alias("certified"))
    return done.unionByName(rest)


def packed_documents(docs: DataFrame, path: str, sizes: Sizes = Sizes()) -> DataFrame:
    """Every piece with its sequence and place; ``certified`` where its partition met the bound."""
    ship_code(docs.sparkSession)
    table = pieces_of(docs, path, sizes)
    full = table.where(F.col("length") == sizes.capacity).select(
        "*", F.col("item").alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(True).alias("certified")
    )
    short = table.where(F.col("length") < sizes.capacity)
    placed = pack_items(short.select("item", "length"), sizes)
    # Sequences of whole pieces keep the item's number; packed ones count down from -1, by
    # turn (3 bits), bin (20 bits) and partition.
    number = -1 - (F.shiftleft(F.col("part"), 24) + F.shiftleft(F.col("bin"), 3) + F.col("turn"))
    rest = short.join(placed.select("item", number.alias("sequence_id"), "offset", "certified"), "item")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "certified"]
    return full.select(columns).unionByName(rest.select(columns))
