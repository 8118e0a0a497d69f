"""Repeated passages by longest-previous-factor arrays over suffix-sorted contexts.

Wanted are the bytes covered by strings of ``Passage.size`` bytes that start in more than
one place, in one document or in several. Sorting the suffixes of a whole corpus in one
place is out of reach, so suffixes meet only where they can match:

1. Every window of ``size`` bytes has an anchor, the k-byte string in it with the smallest
   hash (the leftmost, if there are several). Equal windows have equal anchors at equal
   places, so windows are dealt by anchor. Neighbouring windows mostly share theirs; such a
   run of windows with the bytes they cover is a context, about one per (size - k) / 2 bytes.
2. Anchors found once are done: none of their windows repeats. Equal contexts are one class
   (grouped by hash, combined before the shuffle), however many documents hold them.
3. The classes of an anchor that has several are put into a chunk with those of other
   anchors, in the order of their first places within the chunk. There the suffixes at the
   windows are sorted by prefix doubling. The nearest suffixes in suffix order with a
   smaller position, before and after, give the longest match that starts earlier
   (longest previous factor); those with a greater position give the longest later one.
4. An anchor with more than ``Passage.hot`` classes is dealt to several chunks. For those,
   what is left over is compared between chunks by hash: first blocks of neighbouring
   windows by the bytes that they share, then single windows where a block is shared.
5. Ranges go back to all documents of a class, and per document they are united.

``Passage.words`` sets a minimum in words besides: wanted are then also all strings of that
many whole words that start in more than one place. Those of ``size`` bytes and more are
found already, since all their windows repeat. The shorter ones, few unless words are very
short, are compared one by one by their hashes (128 bits).

``Passage.least`` is for a ``size`` that most strings of ``words`` words do not reach. Windows
then have ``least`` bytes, and contexts go on for as long as a string of ``size`` bytes that
starts in them, so one sort of the suffixes judges both lengths: equal strings of ``size``
bytes begin with equal windows, which meet. What ``size`` bytes cover is as without ``least``;
of the runs that windows cover, with the shorter strings above, those that hold ``words``
whole words count as passages besides.

``keep_first`` leaves the earliest occurrence, in the order of (doc_id, hash of the text,
place), and takes all later ones; otherwise all occurrences count.

Windows in one chunk are compared by their bytes, all others by hashes of 64 bits (``scan.Hasher``).

Defined results: a null text is empty; rows without ``doc_id`` are documents that come
first; rows that repeat a ``doc_id`` are documents of their own, and equal ones are copies of
each other (with ``keep_first`` equal rows of one ``doc_id`` count as one place, and stay or go
together); texts shorter than a window have no spans unless they hold ``words`` words; an empty table gives an empty result.
Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallyguard.functions import quoted
from tallyguard.llm import scan
from tallyguard.llm.work import batched, materialize, tidy

BLOCK = 16
_PACKED = 1 << 21


@dataclass(frozen=True)
class Passage:
    size: int = 400
    anchor: int = 64
    keep_first: bool = False
    chunk: int = 256
    hot: int = 512
    words: int = 0
    least: int = 0

    @property
    def window(self) -> int:
        """Bytes of a window."""
        return self.least or self.size

    @property
    def sizes(self) -> list[int]:
        """The lengths that are judged, the window's first."""
        return [self.least, self.size] if self.least else [self.size]

    @property
    def reach(self) -> int:
        """Anchors that a window holds."""
        return self.window - self.anchor + 1

    def __post_init__(self):
        if self.least and not (self.words and self.least < self.size):
            raise ValueError("least is for passages of so many words, and below size")


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id, text, text_hash``: texts under one id, or under none, are told apart by their hash."""
    hashed = F.xxhash64(F.coalesce(F.col("text"), F.lit("")), F.octet_length(F.coalesce(F.col("text"), F.lit(""))))
    return docs.withColumn("text_hash", hashed).select("doc_id", "text", "text_hash", *more)


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    out, length = x, 1
    while 2 * length <= width:
        out = np.minimum(out[:-length], out[length:])
        length *= 2
    n = max(0, len(x) - width + 1)
    return np.minimum(out[:n], out[width - length : width - length + n])


def contexts(data: np.ndarray, bounds: np.ndarray, quick: scan.Rolling, hasher: scan.Hasher, passage: Passage):
    """Row, anchor hash, context hash, first window (in its row), windows, the anchor's place and strings of ``size`` bytes in every context."""
    n = len(data) - passage.anchor + 1
    empty = np.zeros(0, dtype=np.int64)
    if n < passage.reach or not (np.diff(bounds) >= passage.window).any():
        return empty, empty.view(np.uint64), empty.view(np.uint64), empty, empty, empty, empty
    at = np.arange(n)
    sums = quick.sums(data)
    grams = (sums[passage.anchor :] - sums[: -passage.anchor]) * quick.down[:n]
    least = sliding_minimum((grams & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64), passage.reach)
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    inside = np.zeros(len(data) + 1, dtype=np.int64)
    long_ = np.diff(bounds) >= passage.window
    inside[bounds[:-1][long_]] += 1
    inside[bounds[1:][long_] - passage.window + 1] -= 1
    inside = np.cumsum(inside)[: len(anchor)] > 0
    # A context starts where the anchor changes; rows cannot share an anchor.
    first = inside.copy()
    first[1:] &= ~inside[:-1] | (anchor[1:] != anchor[:-1])
    last = inside.copy()
    last[:-1] &= ~inside[1:] | (anchor[1:] != anchor[:-1])
    low, high = np.flatnonzero(first), np.flatnonzero(last)
    row = np.searchsorted(bounds, low, side="right") - 1
    key = scan.mix(grams[anchor[low]])
    windows, end = high - low + 1, np.minimum(high + passage.size, bounds[row + 1])
    # The end of a text may cut contexts of unlike windows to the same bytes.
    whole = scan.mix(hasher.of(hasher.sums(data), low, end) + (anchor[low] - low + (windows << 32)).astype(np.uint64))
    return row, key, whole, low - bounds[row], windows, anchor[low] - low, np.clip(end - low - passage.size + 1, 0, windows)


_SEGMENT = "doc_id long, text_hash long, key long, ctx long, low long, windows long, offset long, longs long"


def segments(docs: DataFrame, passage: Passage) -> DataFrame:
    batched(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quick, hasher = scan.Rolling(21), scan.Hasher(21)
        for batch in batches:
            data, bounds = scan.text_buffer(batch.column("text"))
            for a, b in scan.slices(bounds):
                part, at = data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]
                row, key, whole, low, windows, offset, longs = contexts(part, at, quick, hasher, passage)
                if len(row):
                    own = pa.array(row + a)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(own), batch.column("text_hash").take(own), pa.array(key.view(np.int64)),
                         pa.array(whole.view(np.int64)), pa.array(low), pa.array(windows), pa.array(offset), pa.array(longs)],
                        names=["doc_id", "text_hash", "key", "ctx", "low", "windows", "offset", "longs"],
                    )

    return docs.mapInArrow(run, _SEGMENT)


def short_strings(data: np.ndarray, bounds: np.ndarray, passage: Passage) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of all strings of ``passage.words`` whole words that are shorter than a window."""
    start, end, row = scan.words(data, bounds)
    n = max(0, len(start) - passage.words + 1)
    first, last = np.arange(n), np.arange(n) + passage.words - 1
    at = np.flatnonzero((row[first] == row[last]) & (end[last] - start[first] < passage.window))
    return row[at], start[at], end[at + passage.words - 1]


def _short_spans(docs: DataFrame, passage: Passage) -> DataFrame:
    """``doc_id, text_hash, a, b``: the repeated ones among the strings of ``short_strings``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, second = scan.Hasher(21), scan.Hasher(24)
        for batch in batches:
            data, bounds = scan.text_buffer(batch.column("text"))
            for a, b in scan.slices(bounds):
                part, at = data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]
                row, start, end = short_strings(part, at, passage)
                if len(row):
                    own = pa.array(row + a)
                    low, high = start - at[row], end - at[row]
                    # Only texts that hold some are hashed.
                    used = np.zeros(b - a, dtype=bool)
                    used[row] = True
                    part = part[np.repeat(used, np.diff(at))]
                    moved = np.cumsum(np.where(used, np.diff(at), 0)) - np.diff(at)
                    start, end = moved[row] + low, moved[row] + high
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(own), batch.column("text_hash").take(own),
                         pa.array(hasher.of(hasher.sums(part), start, end).view(np.int64)), pa.array(second.of(second.sums(part), start, end).view(np.int64)),
                         pa.array(low), pa.array(high)],
                        names=["doc_id", "text_hash", "k1", "k2", "a", "b"],
                    )

    table = materialize(docs.mapInArrow(run, "doc_id long, text_hash long, k1 long, k2 long, a long, b long"), "short")
    place = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "text_hash", "a")
    groups = table.groupBy("k1", "k2").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").drop("n")
    # Written first, so that a string that very many documents share can be split among tasks.
    near = table.join(materialize(groups, "shared"), ["k1", "k2"])
    if passage.keep_first:
        near = near.where(place != F.col("first"))
    return near.select("doc_id", "text_hash", F.array("a").alias("a"), F.array("b").alias("b"))


def suffix_ranks(data: np.ndarray, ends: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    """Ranks of all strings of each of the (growing) sizes by prefix doubling from 5 bytes on.

    ``ends`` holds for each position the end of its context; strings do not reach over it.
    Rank -1: too long for its place. Only suffixes that are not alone in their rank are sorted on.
    """
    n = len(data)
    at = np.arange(n)
    padded = np.concatenate((data, np.zeros(4, dtype=np.uint8)))
    word = np.zeros(n, dtype=np.int64)
    for i in range(5):
        word = (word << 8) | padded[i : i + n]
    # Ranks are places in the order, so that those of a group change without the others.
    rank, out, packed = np.full(n, -1, dtype=np.int64), [], n < _PACKED

    def split(live: np.ndarray, key: np.ndarray, base: np.ndarray) -> np.ndarray:
        """Rank the positions by their keys, which begin with the rank so far; those that are not alone yet."""
        if packed:  # keys of up to 42 bits, sorted with their places in one number
            both = np.sort(key << 21 | np.arange(len(live)))
            order, key = both & (_PACKED - 1), both >> 21
        else:
            order = np.argsort(key)
            key = key[order]
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(key)), dtype=bool), key[1:] != key[:-1])))
        size = np.diff(first, append=len(live))
        group = base[order[first]]
        head = np.concatenate((np.ones(min(1, len(group)), dtype=bool), group[1:] != group[:-1]))
        start = group + first - np.maximum.accumulate(np.where(head, first, 0))
        placed, alone = np.empty(len(live), dtype=np.int64), np.empty(len(live), dtype=bool)
        placed[order], alone[order] = np.repeat(start, size), np.repeat(size == 1, size)
        rank[live] = placed
        return live[~alone]

    live, length = np.flatnonzero(at + 5 <= ends), 5
    live = split(live, word[live], np.zeros(len(live), dtype=np.int64))
    for size in sizes:
        while length < size:
            longer = min(2 * length, size)
            live = live[live + longer <= ends[live]]
            base = rank[live]
            live = split(live, base * np.int64(n) + rank[live + longer - length], base)
            length = longer
        out.append(np.where(at + size <= ends, rank, -1))
    return out


def smaller_near(values: np.ndarray, run: np.ndarray) -> np.ndarray:
    """Which entries have a smaller one before or after them in their run (runs ascend)."""
    if not len(values):
        return np.zeros(0, dtype=bool)
    # Set apart so far that the smallest so far, from either side, is one of the entry's own run.
    step = run * (int(values.max()) - int(values.min()) + 1)
    ahead, behind = values - step, values + step
    return (np.minimum.accumulate(ahead) < ahead) | (np.minimum.accumulate(behind[::-1])[::-1] < behind)


def matches(order: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which suffixes have a long match that starts earlier, and which have one that starts later.

    ``order`` holds positions in suffix order; ``same[i]`` says that neighbours i and i + 1
    share a prefix of the wanted length. Suffixes outside runs of such neighbours have no
    match. Within a run any two share the prefix, so a previous or next smaller position in
    suffix order is an earlier match (the longest previous factor is long enough), and a
    greater one a later match.
    """
    run = np.concatenate(([0], np.cumsum(~same))) if len(order) else np.zeros(0, dtype=np.int64)
    return smaller_near(order, run), smaller_near(-order, run)


def _ranges(row: np.ndarray, window: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring windows: row, first, one after the last."""
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (window[1:] != window[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row)) - 1 if len(row) else first
    return row[first], window[first], window[last] + 1


_FOUND = "key long, ctx long, doc_id long, text_hash long, low long, offset long, size long, kind string, a long, b long, hash long"


def _chunk(passage: Passage):
    """The work on one chunk of contexts; rows come in any order."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("doc_id", "text_hash", "low", "key", "ctx")])
        # Rows without doc_id are the first documents; Arrow sorts them last.
        missing = table.column("doc_id").is_null().to_numpy()
        table = table.take(pa.array(np.argsort(~missing, kind="stable")))
        data, bounds = scan.text_buffer(pa.chunked_array(table.column("bytes")).combine_chunks())
        windows, hot = table.column("windows").to_numpy(), table.column("hot").to_numpy()
        rows = len(windows)
        owner = np.repeat(np.arange(rows), np.diff(bounds))
        window = np.arange(len(data)) - bounds[:-1][owner]
        kind = "earlier" if passage.keep_first else "any"
        out = {c: [] for c in ("row", "size", "kind", "a", "b", "hash")}

        def add(size: int, kind: str, row: np.ndarray, a: np.ndarray, b: np.ndarray, hashed: np.ndarray) -> None:
            for c, values in (("row", row), ("a", a), ("b", b), ("hash", hashed)):
                out[c].append(values)
            out["size"].append(np.full(len(row), size)), out["kind"].append(np.full(len(row), kind, dtype=object))

        hasher = scan.Hasher(22)
        sums = hasher.sums(data) if hot.any() else None
        for size, rank in zip(passage.sizes, suffix_ranks(data, bounds[1:][owner], passage.sizes)):
            place = np.flatnonzero((window < windows[owner]) & (rank >= 0))
            order = place[np.argsort(rank[place], kind="stable")]
            earlier, later = matches(order, rank[order][1:] == rank[order][:-1])
            flags = np.zeros((2, len(data)), dtype=bool)
            flags[0, order], flags[1, order] = earlier, earlier | later
            at = np.flatnonzero(flags[0 if passage.keep_first else 1])
            row, a, b = _ranges(owner[at], window[at])
            add(size, kind, row, a, b, np.zeros(len(row), dtype=np.int64))
            # For anchors that other chunks hold too: blocks of windows without an earlier match here.
            loose = place[hot[owner[place]] & ~flags[0, place]]
            if len(loose):
                offset = table.column("offset").to_numpy()
                # Blocks are aligned to the anchor, so that equal windows are in equal blocks.
                block = (window[loose] - offset[owner[loose]]) // BLOCK
                new = np.ones(len(loose), dtype=bool)
                new[1:] = (owner[loose][1:] != owner[loose][:-1]) | (block[1:] != block[:-1])
                first = np.flatnonzero(new)
                row, start = owner[loose[first]], block[first] * BLOCK + offset[owner[loose[first]]]
                # The bytes that all windows of a whole block share; the context always holds them.
                begin = bounds[row] + start
                core = scan.mix(hasher.of(sums, begin + BLOCK - 1, begin + size) + block[first].astype(np.uint64))
                add(size, "block", row, block[first], block[first] + 1, core.view(np.int64))
        flat = {k: np.concatenate(v) for k, v in out.items()}
        base = table.select(["key", "ctx", "doc_id", "text_hash", "low", "offset"]).take(pa.array(flat["row"]))
        for name, kind in (("size", pa.int64()), ("kind", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("hash", pa.int64())):
            base = base.append_column(name, pa.array(flat[name], kind))
        return base

    return run


def _joined(docs: DataFrame, per_text: DataFrame, how: str = "inner") -> DataFrame:
    """Columns of texts ``doc_id, text_hash, ...`` beside every row that holds the text."""
    other = per_text.withColumnsRenamed({"doc_id": "other_id", "text_hash": "other_hash"})
    same = F.col("doc_id").eqNullSafe(F.col("other_id")) & (F.col("text_hash") == F.col("other_hash"))
    return docs.join(other, same, how).drop("other_id", "other_hash")


def _with_bytes(docs: DataFrame, wanted: DataFrame, passage: Passage) -> DataFrame:
    """The bytes of the wanted contexts, cut from their texts."""
    per_text = wanted.groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("key", "ctx", "low", "windows", "offset", "kinds")).alias("cuts")
    )
    near = _joined(docs, per_text).select("doc_id", "text", "text_hash", "cuts")
    names = ["key", "ctx", "low", "windows", "offset", "kinds"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = scan.text_buffer(batch.column("text"))
            cuts = batch.column("cuts")
            for a, b in scan.slices(bounds):
                at = bounds[a : b + 1] - bounds[a]
                raw = data[bounds[a] : bounds[b]].tobytes()
                lists = cuts.slice(a, b - a)
                flat, row = lists.flatten(), np.repeat(np.arange(b - a), np.diff(lists.offsets.to_numpy()))
                low, windows = (flat.field(n).to_numpy() for n in ("low", "windows"))
                start = at[row] + low
                end = np.minimum(start + windows + passage.size - 1, at[row + 1])
                pieces = [raw[x:y] for x, y in zip(start.tolist(), end.tolist())]
                own = pa.array(row + a)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(own), batch.column("text_hash").take(own),
                     *[flat.field(n) for n in names], pa.array(pieces, pa.binary())],
                    names=["doc_id", "text_hash", *names, "bytes"],
                )

    # Equal rows give a context more than once; one is enough.
    found = near.mapInArrow(run, "doc_id long, text_hash long, " + ", ".join(f"{n} long" for n in names) + ", bytes binary")
    return materialize(found.dropDuplicates(["key", "ctx"]), "contexts")


def _between_chunks(chunked: DataFrame, found: DataFrame, passage: Passage) -> DataFrame:
    """Ranges of windows that only contexts of other chunks match, for anchors in several chunks."""
    blocks = found.where("kind = 'block'")
    same = ["key", "size", "a", "hash"]
    shared = blocks.groupBy(*same).count().where("count > 1").drop("count")
    chosen = blocks.join(shared, same, "left_semi").groupBy("key", "ctx").agg(F.collect_set(F.struct("size", "a")).alias("blocks"))
    near = chunked.join(chosen, ["key", "ctx"]).select("key", "ctx", "doc_id", "text_hash", "low", "windows", "offset", "bytes", "blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = scan.Hasher(23)
        for batch in batches:
            data, bounds = scan.text_buffer(batch.column("bytes"))
            sums = hasher.sums(data)
            windows, offset = batch.column("windows").to_numpy(), batch.column("offset").to_numpy()
            lists = batch.column("blocks")
            flat, row = lists.flatten(), np.repeat(np.arange(len(windows)), np.diff(lists.offsets.to_numpy()))
            window = (flat.field("a").to_numpy() * BLOCK + offset[row])[:, None] + np.arange(BLOCK)[None, :]
            row, size = np.repeat(row, BLOCK), np.repeat(flat.field("size").to_numpy(), BLOCK)
            window = window.ravel()
            use = (window >= 0) & (window < windows[row]) & (bounds[row] + window + size <= bounds[row + 1])
            row, window, size = row[use], window[use], size[use]
            start = bounds[row] + window
            hashed = scan.mix(hasher.of(sums, start, start + size) + (window - offset[row]).astype(np.uint64))
            base = batch.select(["key", "ctx", "doc_id", "text_hash", "low"]).take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [*base.columns, pa.array(size), pa.array(window), pa.array(hashed.view(np.int64))], names=[*base.schema.names, "size", "window", "hash"]
            )

    single = near.mapInArrow(run, "key long, ctx long, doc_id long, text_hash long, low long, size long, window long, hash long")
    place = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "text_hash", (F.col("low") + F.col("window")).alias("at"))
    single = materialize(single.withColumn("place", place).drop("doc_id", "text_hash", "low"), "windows")
    groups = single.groupBy("key", "size", "hash").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1")
    hit = single.join(groups, ["key", "size", "hash"])
    return hit.select("key", "ctx", "size", F.col("window").alias("a"), (F.col("window") + 1).alias("b"), (F.col("place") > F.col("first")).alias("earlier"))


def _merged(ranges: Column) -> Column:
    """Sorted ranges ``a, b`` of one context, those that touch or overlap made one."""
    kind = "array<struct<a: bigint, b: bigint>>"

    def add(done: Column, r: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))  # null at first
        longer = F.struct(last["a"].alias("a"), F.greatest(last["b"], r["b"]).alias("b"))
        before = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(last["b"] >= r["a"], F.concat(before, F.array(longer))).otherwise(F.concat(done, F.array(r)))

    return F.aggregate(F.sort_array(ranges), F.array().cast(kind), add)


def spans(docs: DataFrame, passage: Passage = Passage()) -> DataFrame:
    """``doc_id, text_hash, a, b``: starts and ends of covered ranges of bytes.

    With ``least`` these are the ranges that windows cover, and ``c, d`` those that strings of ``size`` bytes cover.
    A row holds those of one context, of which a text has several; ranges of a text may overlap.
    ``docs`` is ``keyed``.
    """
    batched(docs.sparkSession)
    table = materialize(segments(docs, passage), "segments")
    place = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "text_hash", "low")
    # Written first, so that rows of an anchor that very many documents hold can be split among tasks.
    often = materialize(table.groupBy("key").count().where("count > 1").select("key"), "anchors")
    table = materialize(table.join(often, "key", "left_semi"), "repeated")
    classes = table.groupBy("key", "ctx").agg(
        F.count("*").alias("n"), F.min(place).alias("first"), F.first("windows").alias("windows"), F.first("offset").alias("offset")
    )
    classes = materialize(classes, "classes")
    kinds = classes.groupBy("key").agg(F.count("*").alias("kinds"))
    classes = materialize(classes.join(kinds, "key"), "kinds")
    several = classes.where("kinds > 1").select("key", "ctx", "first.doc_id", "first.text_hash", "first.low", "windows", "offset", "kinds")
    chunked = _with_bytes(docs, several, passage)
    chunks = max(1, math.ceil(chunked.count() / passage.chunk))
    salt = F.when(F.col("kinds") > passage.hot, F.pmod(F.xxhash64("ctx"), F.ceil(F.col("kinds") / passage.hot))).otherwise(0)
    dealt = chunked.withColumns({"hot": F.col("kinds") > passage.hot, "chunk": F.pmod(F.xxhash64("key", salt), F.lit(chunks))})
    found = materialize(dealt.groupBy("chunk").applyInArrow(_chunk(passage), _FOUND), "found")

    inner = found.where("kind <> 'block'").select("key", "ctx", "size", "a", "b", (F.col("kind") == "earlier").alias("earlier"))
    between = _between_chunks(chunked, found, passage)
    both = inner.unionByName(between.where("earlier")).unionByName(between.withColumn("earlier", F.lit(False)))
    hits_of = [f"hits{n}" for n in range(len(passage.sizes))]
    wanted = both.where(F.col("earlier") == passage.keep_first).groupBy("key", "ctx").agg(
        *[_merged(F.collect_list(F.when(F.col("size") == size, F.struct("a", "b")))).alias(h) for h, size in zip(hits_of, passage.sizes)]
    )
    # A class of several documents is found elsewhere as a whole.
    ranges = classes.select("key", "ctx", "n", "first").join(wanted, ["key", "ctx"], "left").where("n > 1 OR hits0 IS NOT NULL")
    # Written first, so that both sides of the next join come from plain exchanges, and a
    # class that very many documents share can be split among tasks.
    ranges = materialize(ranges, "ranges")
    near = table.join(ranges.where("n > 1"), ["key", "ctx"])
    hits = []
    for h, count in zip(hits_of, ("windows", "longs")):
        found = F.array(F.struct(F.lit(0).cast("long").alias("a"), F.col(count).alias("b")))
        found = F.filter(found, lambda r: r["b"] > r["a"])
        if passage.keep_first:
            found = F.when(place != F.col("first"), found).otherwise(F.col(h))
        hits.append(found.alias(h))
    # A class of one context is where it was first found.
    alone = ranges.where("n = 1").select("first.doc_id", "first.text_hash", "first.low", *hits_of)
    near = near.select("doc_id", "text_hash", "low", *hits).unionByName(alone).where("hits0 IS NOT NULL")

    def placed(hits: str, side: str, more: int) -> Column:
        return F.transform(hits, lambda r: F.col("low") + r[side] + more)

    bounds = []
    for h, size, (a, b) in zip(hits_of, passage.sizes, ("ab", "cd")):
        bounds += [placed(h, "a", 0).alias(a), placed(h, "b", size - 1).alias(b)]
    long_ = near.select("doc_id", "text_hash", *bounds)
    return long_.unionByName(_short_spans(docs, passage), allowMissingColumns=True) if passage.words else long_


def _united(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Maximal runs of the covered bytes, as rows (start, end)."""
    if not len(a):
        return np.zeros((0, 2), dtype=np.int64)
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, a, 1)
    np.add.at(edge, b, -1)
    inside = np.concatenate(([False], np.cumsum(edge)[:n] > 0, [False]))
    turn = np.flatnonzero(inside[1:] != inside[:-1])
    return turn.reshape(-1, 2)


def _lists(column: pa.Array) -> list[np.ndarray]:
    """The values of every list; a null one is empty."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False))
    return np.split(column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), ends[:-1])


def _passages(text: np.ndarray, near: np.ndarray, covered: np.ndarray, words: int) -> np.ndarray:
    """The covered runs, and those of the other runs that hold so many whole words."""
    if not len(near):
        return covered
    start, end, _ = scan.words(text, np.array([0, len(text)]))
    count = np.searchsorted(end, near[:, 1], side="right") - np.searchsorted(start, near[:, 0])
    return _united(*np.concatenate((covered, near[count >= words])).T, len(text))


def _on_texts(docs: DataFrame, covered: DataFrame, passage: Passage, extra: list[str], work, names: list[str], schema: str | T.StructType) -> DataFrame:
    """Run ``work(bytes, runs, passages)`` on every text; ``extra`` columns are handed on before its results.

    The runs are those that strings of ``size`` bytes cover (and, without ``least``, of ``words`` words);
    the passages, the same without ``least``, are all that is wanted.
    """
    ends = ["a", "b", "c", "d"] if passage.least else ["a", "b"]
    flat = [F.flatten(F.collect_list(c)).alias(f"covered_{c}") for c in ends]
    joined = _joined(docs, covered.groupBy("doc_id", "text_hash").agg(*flat), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = scan.text_buffer(batch.column("text"))
            ranges = [_lists(batch.column(f"covered_{c}")) for c in ends]
            results = []
            for i in range(batch.num_rows):
                text = data[bounds[i] : bounds[i + 1]]
                near = runs = passages = _united(ranges[0][i], ranges[1][i], len(text))
                if passage.least:
                    runs = _united(ranges[2][i], ranges[3][i], len(text))
                    passages = _passages(text, near, runs, passage.words)
                results.append(work(text, runs, passages))
            columns = zip(*results) if results else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in extra], *map(pa.array, columns)], names=[*extra, *names])

    return joined.select(*dict.fromkeys([*extra, "text"]), *[f"covered_{c}" for c in ends]).mapInArrow(run, schema)


def repeated_bytes(docs: DataFrame, passage: Passage = Passage()) -> DataFrame:
    """Per document its bytes, how many strings of ``size`` bytes cover, in how many runs, and the hash of the rest.

    ``text`` is what is left as text, with ``least`` also without the passages of ``words`` words,
    and ``n_cuts`` in how many places something went: characters that are covered only in part
    stay whole in it.
    """
    docs = keyed(tidy(docs, doc_id="long", text="string"))
    covered = materialize(spans(docs, passage), "spans")

    def work(text: np.ndarray, runs: np.ndarray, passages: np.ndarray) -> tuple:
        digest, at = hashlib.sha256(), 0
        for a, b in runs.tolist():
            digest.update(text[at:a])
            at = b
        digest.update(text[at:])
        return len(text), int((runs[:, 1] - runs[:, 0]).sum()), len(runs), digest.hexdigest(), _rest(text, passages), len(passages)

    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "text", "n_cuts"]
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string, n_cuts long"
    return _on_texts(docs, covered, passage, ["doc_id"], work, names, schema)


def _characters(text: np.ndarray, runs: np.ndarray) -> list[tuple[int, int]]:
    """The runs without characters that they hold only in part."""
    out = []
    for a, b in runs.tolist():
        while a < b and (text[a] & 0xC0) == 0x80:
            a += 1
        while b > a and b < len(text) and (text[b] & 0xC0) == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def _rest(text: np.ndarray, runs: np.ndarray) -> str:
    """What the runs leave of a text."""
    kept, at = [], 0
    for a, b in _characters(text, runs):
        kept.append(text[at:a].tobytes())
        at = b
    kept.append(text[at:].tobytes())
    return b"".join(kept).decode()


def without_repeats(docs: DataFrame, passage: Passage = Passage(keep_first=True)) -> DataFrame:
    """``docs`` with the covered parts of ``text`` cut out, at whole characters; null texts stay null."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    # The other columns go along as one, so that none of their names can clash.
    row = keyed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                            F.struct(*[F.col(quoted(c)) for c in others] or [F.lit(0).alias("none")]).alias("others")), "others")
    covered = materialize(spans(row.drop("others"), passage), "spans")
    extra = ["doc_id", "text", "others"]
    schema = T.StructType([*[row.schema[c] for c in extra], T.StructField("rest", T.StringType())])
    cut = _on_texts(row, covered, passage, extra, lambda text, runs, passages: (_rest(text, passages),), ["rest"], schema)
    rest = F.when(F.col("text").isNotNull(), F.col("rest"))
    columns = {"doc_id": F.col("doc_id").cast(docs.schema["doc_id"].dataType), "text": rest}
    return cut.select(*[columns.get(c, F.col("others")[c]).alias(c) for c in docs.columns])
