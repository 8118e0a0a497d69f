"""Token ids in binary blocks, compressed by a grammar (Re-Pair).

Texts are sorted by ``doc_id`` across the cluster, encoded, and cut into blocks of whole
documents with about ``Layout.block`` ids. In each block frequent pairs of neighbouring ids
are replaced by nonterminals, again and again; a round replaces all pairs found at least
``least`` times, the most frequent first, without overlaps. A block stores its rules with
their expansion lengths and every ``stride``-th expanded position, so any document is
decoded by expanding only the symbols that cover it (``decode``).

The file format: Parquet rows of one block each (``part, seq, n_docs, n_ids, payload``),
blocks in the order (part, seq). The payload is little-endian: the header ``_HEADER``, then
doc ids (int64) and a null flag each (uint8), document starts (uint32, one more than
documents), rules (two uint32 each), expansion lengths (uint32), the symbols (uint16 or
uint32) and the expanded positions of every ``stride``-th symbol (uint32). Spark's commit
protocol writes the files, so a lost executor leaves no half file behind.

Defined results: a null text is empty and has the end id only; rows without ``doc_id`` come
first; rows that repeat a ``doc_id`` follow each other, ordered by text; an empty table
gives no blocks. Other columns of the input are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tallyguard.llm.tokens import encoder
from tallyguard.llm.work import batched, materialize, tidy

_HEADER = struct.Struct("<8sIIIIII")  # magic, documents, ids, first nonterminal, rules, symbols, symbol bytes
_MAGIC = b"REPAIR01"
TOKEN_ROWS = 2000  # rows of a batch: the more, the fewer pieces of text are looked up twice


@dataclass(frozen=True)
class Layout:
    block: int = 1 << 19
    rounds: int = 4
    least: int = 16
    pairs: int = 4096
    stride: int = 256


def _few_bits(key: np.ndarray) -> np.ndarray:
    """A number below 2^18 for each pair."""
    return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(46)


def compress(ids: np.ndarray, first: int, layout: Layout) -> tuple[np.ndarray, np.ndarray]:
    """Rules (left, right) of the nonterminals from ``first`` on, and the remaining symbols."""
    symbols, rules, next_ = ids.astype(np.int64), [], first
    for _ in range(layout.rounds):
        if len(symbols) < 2:
            break
        key = (symbols[:-1] << 32) | symbols[1:]
        order = np.sort(key)
        edge = np.flatnonzero(np.concatenate(([True], order[1:] != order[:-1])))
        count = np.diff(np.append(edge, len(order)))
        common = np.flatnonzero(count >= layout.least)
        if not len(common):
            break
        common = common[np.argsort(-count[common], kind="stable")[: layout.pairs]]
        chosen = np.sort(order[edge[common]])
        # Most pairs are none of the chosen, and a few bits tell most of those apart.
        table = np.full(1 << 18, -1, dtype=np.int32)
        table[_few_bits(chosen)] = np.arange(len(chosen))
        at = table[_few_bits(key)]
        place = np.flatnonzero(at >= 0)
        at = at[place]
        other = np.flatnonzero(chosen[at] != key[place])
        at[other] = np.minimum(np.searchsorted(chosen, key[place[other]]), len(chosen) - 1)
        right = chosen[at] == key[place]
        place, at = place[right], at[right]
        # Of places that overlap in a row, every second one from the left is taken.
        run = np.concatenate(([True], np.diff(place) != 1))
        begin = np.maximum.accumulate(np.where(run, np.arange(len(place)), 0))
        taken = (np.arange(len(place)) - begin) % 2 == 0
        place, at = place[taken], at[taken]
        used = np.bincount(at, minlength=len(chosen)) > 0
        which = (np.cumsum(used) - 1)[at]
        pairs = chosen[used]
        rules.append(np.stack((pairs >> 32, pairs & 0xFFFFFFFF), axis=1))
        keep = np.ones(len(symbols), dtype=bool)
        keep[place + 1] = False
        symbols[place] = next_ + which
        symbols = symbols[keep]
        next_ += len(pairs)
    return (np.concatenate(rules) if rules else np.zeros((0, 2), dtype=np.int64)).astype(np.uint32), symbols


def expansion_lengths(rules: np.ndarray, first: int) -> np.ndarray:
    """How many ids each nonterminal stands for."""
    lengths = np.zeros(len(rules), dtype=np.int64)
    done = 0
    while done < len(rules):
        # A rule uses only earlier nonterminals; take all whose parts are known.
        highest = rules.max(axis=1).astype(np.int64)
        end = done + int(np.argmax(np.append(highest[done:] >= first + done, True)))
        end = max(end, done + 1)
        part = rules[done:end].astype(np.int64)
        size = np.where(part >= first, lengths[np.maximum(part - first, 0)], 1)
        lengths[done:end] = size.sum(axis=1)
        done = end
    return lengths


def expand(symbols: np.ndarray, rules: np.ndarray, first: int) -> np.ndarray:
    """The ids that the symbols stand for."""
    symbols = symbols.astype(np.int64)
    while True:
        inner = symbols >= first
        if not inner.any():
            return symbols.astype(np.uint32)
        start = np.cumsum(1 + inner) - 1 - inner
        out = np.empty(len(symbols) + int(inner.sum()), dtype=np.int64)
        out[start[~inner]] = symbols[~inner]
        pair = rules[symbols[inner] - first]
        out[start[inner]], out[start[inner] + 1] = pair[:, 0], pair[:, 1]
        symbols = out


def expand_all(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, first: int) -> np.ndarray:
    """The same for many symbols: every rule is expanded once, and its ids are copied."""
    flat = expand(rules.reshape(-1), rules, first)
    symbols, lengths = symbols.astype(np.int64), lengths.astype(np.int64)
    inner = np.flatnonzero(symbols >= first)
    rule = symbols[inner] - first
    size = np.ones(len(symbols), dtype=np.int64)
    size[inner] = lengths[rule]
    stop = np.cumsum(size)
    out = np.empty(int(stop[-1]) if len(stop) else 0, dtype=np.uint32)
    out[stop - size] = symbols  # of rules, all is overwritten
    size, stop = size[inner], stop[inner]
    inside = np.cumsum(size)
    step = np.arange(int(inside[-1]) if len(inside) else 0)
    begin = (np.cumsum(lengths) - lengths)[rule]
    out[np.repeat(stop - inside, size) + step] = flat[np.repeat(begin - inside + size, size) + step]
    return out


def pack_block(doc_ids: np.ndarray, nulls: np.ndarray, starts: np.ndarray, ids: np.ndarray, first: int, layout: Layout) -> bytes:
    rules, symbols = compress(ids, first, layout)
    lengths = expansion_lengths(rules, first)
    size = np.where(symbols >= first, lengths[np.maximum(symbols - first, 0)] if len(lengths) else 1, 1)
    position = np.concatenate(([0], np.cumsum(size)))[: len(symbols) : layout.stride]
    kind = np.uint16 if first + len(rules) <= 1 << 16 else np.uint32
    head = _HEADER.pack(_MAGIC, len(doc_ids), len(ids), first, len(rules), len(symbols), np.dtype(kind).itemsize)
    arrays = (
        doc_ids.astype("<i8"), nulls.astype("u1"), starts.astype("<u4"), rules.astype("<u4"), lengths.astype("<u4"),
        symbols.astype(kind), np.append(layout.stride, position).astype("<u4"),
    )
    return head + b"".join(a.tobytes() for a in arrays)


class Block:
    """A block read back from its bytes."""

    def __init__(self, payload: bytes):
        magic, docs, ids, self.first, rules, symbols, width = _HEADER.unpack_from(payload)
        if magic != _MAGIC:
            raise ValueError("not a block of token ids")
        self.n_ids, at = ids, _HEADER.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, dtype=kind, count=n, offset=at)
            at += out.nbytes
            return out

        self.doc_ids, self.nulls, self.starts = take("<i8", docs), take("u1", docs).astype(bool), take("<u4", docs + 1)
        self.rules, self.lengths = take("<u4", 2 * rules).reshape(-1, 2), take("<u4", rules)
        self.symbols = take(f"<u{width}", symbols)
        self.stride, self.marks = int(take("<u4", 1)[0]), take("<u4", (len(payload) - at) // 4)

    def ids(self) -> np.ndarray:
        return expand_all(self.symbols, self.rules, self.lengths, self.first)

    def document(self, n: int) -> np.ndarray:
        """The ids of the n-th document, from the symbols that cover it only."""
        start, end = int(self.starts[n]), int(self.starts[n + 1])
        a = max(0, int(np.searchsorted(self.marks, start, side="right")) - 1)
        b = int(np.searchsorted(self.marks, end, side="left"))
        part = expand(self.symbols[a * self.stride : b * self.stride], self.rules, self.first)
        before = int(self.marks[a]) if len(self.marks) else 0
        return part[start - before : end - before]


def write_blocks(docs: DataFrame, path: str, layout: Layout = Layout()) -> DataFrame:
    """Encode, compress and write all documents in ascending ``doc_id``; returns the blocks read back."""
    batched(docs.sparkSession, TOKEN_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(path)
        first = tokens.tokenizer.get_vocab_size()
        part, seq = TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        n = 0

        def flush() -> pa.RecordBatch:
            nonlocal seq, held, n
            ids = np.concatenate([h[3] for h in held])
            sizes = np.concatenate([h[2] for h in held])
            doc_ids, nulls = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            payload = pack_block(doc_ids, nulls, np.concatenate(([0], np.cumsum(sizes))), ids, first, layout)
            out = pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "n_docs": pa.array([len(doc_ids)], pa.int64()),
                 "n_ids": pa.array([len(ids)], pa.int64()), "payload": pa.array([payload], pa.binary())}
            )
            seq, held, n = seq + 1, [], 0
            return out

        for batch in batches:
            column = batch.column("doc_id")
            nulls, doc_ids = column.is_null().to_numpy(zero_copy_only=False), column.fill_null(0).to_numpy()
            for a, b, ids, bounds in tokens.column(batch.column("text")):
                i = 0
                while i < b - a:  # up to the document that fills the block
                    j = min(int(np.searchsorted(bounds, bounds[i] + layout.block - n)), b - a)
                    held.append((doc_ids[a + i : a + j], nulls[a + i : a + j], np.diff(bounds[i : j + 1]), ids[bounds[i] : bounds[j]]))
                    n += int(bounds[j] - bounds[i])
                    i = j
                    if n >= layout.block:
                        yield flush()
        if held:
            yield flush()

    rows = tidy(docs, doc_id="long", text="string")
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    return materialize(ordered.mapInArrow(run, "part int, seq int, n_docs long, n_ids long, payload binary"), "token-ids")


def decode(blocks: DataFrame) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32``."""
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = parts.select("part", F.coalesce(F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("part", "seq", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("inside")).join(before, "part")
    starts = starts.select("part", "seq", (F.col("before") + F.col("inside")).alias("start"))
    batched(blocks.sparkSession, 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, payload in zip(*[batch.column(c).to_pylist() for c in ("part", "seq", "payload")]):
                block = Block(payload)
                raw, at = block.ids().astype("<u4").tobytes(), block.starts.astype(np.int64)
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                n = len(crc)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, part), pa.int32()), pa.array(np.full(n, seq), pa.int32()),
                        pa.array(block.doc_ids, pa.int64(), mask=block.nulls), pa.array(at[:-1], pa.int64()),
                        pa.array(np.diff(at), pa.int64()), pa.array(crc, pa.int64()),
                    ],
                    names=["part", "seq", "doc_id", "at", "n_tokens", "ids_crc32"],
                )

    found = blocks.select("part", "seq", "payload").mapInArrow(run, "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return found.join(starts, ["part", "seq"]).select("doc_id", (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
