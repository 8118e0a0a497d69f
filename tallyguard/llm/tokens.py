"""Token ids of whole texts, fast: every distinct piece of text is encoded once.

The byte-level vocabulary first cuts a text by a pattern and then merges within each cut,
so the ids of a text are the ids of its cuts, one after the other. ``Encoder`` finds places
where that pattern always cuts (before a space or line break between other characters,
after such a line break, before punctuation after a letter), and asks the tokenizer only for
pieces that it has not met, known by their bytes. Those are asked for in runs, put together so
that the pattern cuts between them; the ids are dealt to the pieces by the bytes they stand for. A
text with other Unicode spaces or with a special token's name is given to the tokenizer whole.
The memory of pieces is bounded; when full it is emptied.
"""

from __future__ import annotations

import os
from itertools import chain, repeat

import numpy as np
import pyarrow as pa

from tallyguard.llm import scan

END = 0  # the id that ends each document
KNOWN = 1_000_000
SLICE = 1 << 22  # bytes of texts at a time: the more, the fewer pieces are looked up twice
RUN = 1000  # pieces put together

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
_PUNCTUATION = np.zeros(256, dtype=bool)
_PUNCTUATION[[c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) != "'"]] = True

_ENCODERS: dict[str, "Encoder"] = {}


def encoder(path: str) -> "Encoder":
    """The encoder of this Python worker, which later tasks of the worker go on using."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def default_path() -> str:
    """The vocabulary file that the queries use; it stays outside the library."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _wide_spaces(data: np.ndarray) -> np.ndarray:
    """Places of spaces beyond ASCII (first byte of each)."""
    at = np.flatnonzero((data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3)))
    if not len(at):
        return at
    padded = np.concatenate((data, np.zeros(2, dtype=np.uint8)))
    a, b, c = padded[at], padded[at + 1], padded[at + 2]
    wide = (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
    wide |= (a == 0xE1) & (b == 0x9A) & (c == 0x80)
    wide |= (a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
    wide |= (a == 0xE2) & (b == 0x81) & (c == 0x9F)
    wide |= (a == 0xE3) & (b == 0x80) & (c == 0x80)
    return at[wide]


def _strings(pieces: pa.Array) -> list[bytes]:
    """As ``to_pylist``, without a scalar for each."""
    return pieces.to_numpy(zero_copy_only=False).tolist()


class Encoder:
    """Encodes Arrow text columns; one per task."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)  # a character of a token is a byte
        self.bytes_of[list(vocabulary.values())] = list(map(len, vocabulary))
        self.special = [str(t.content).encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids = np.zeros(1 << 16, dtype=np.uint32)
        self.used = 1  # entry 0 is the id that ends a document
        self.ids[0] = END
        self.start = np.zeros(1 << 15, dtype=np.int64)
        self.size = np.zeros(1 << 15, dtype=np.int64)
        self.size[0] = 1
        self.entries = 1

    def _whole(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Rows with Unicode spaces or a special token's name."""
        at = _wide_spaces(data)
        raw = data.tobytes()
        for name in self.special:
            found = raw.find(name)
            while found >= 0:
                at = np.append(at, found)
                found = raw.find(name, found + 1)
        return np.unique(np.searchsorted(bounds, at, side="right") - 1)

    def _together(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids of all pieces, and first place and number of those of each; None if a piece's end is not a token's end.

        Pieces start and end with characters other than spaces, but for one space at the start. A
        line break, a token of its own, goes before those without it.
        """
        bare = np.array([piece[0] != 32 for piece in pieces])
        parts = [b"\n" + piece if alone else piece for piece, alone in zip(pieces, bare.tolist())]
        runs = [b"".join(parts[i : i + RUN]).decode() for i in range(0, len(parts), RUN)]
        ids = np.array(list(chain.from_iterable(e.ids for e in self.tokenizer.encode_batch_fast(runs, add_special_tokens=False))), dtype=np.uint32)
        stops = np.concatenate(([0], np.cumsum(self.bytes_of[ids])))
        ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)))
        starts = np.concatenate(([0], ends[:-1])) + bare
        first, last = np.searchsorted(stops, starts), np.minimum(np.searchsorted(stops, ends), len(ids))
        fits = stops[-1] == ends[-1] and (stops[first] == starts).all() and (stops[last] == ends).all()
        return (ids, first, last - first) if fits else None

    def _learn(self, pieces: pa.Array) -> None:
        data, bounds = scan.text_buffer(pieces)
        known, head, tail = _strings(pieces), data[bounds[:-1]], data[bounds[1:] - 1]
        second = data[np.minimum(bounds[:-1] + 1, bounds[1:] - 1)]
        plain = ~scan.SPACE[tail] & ~scan.SPACE[np.where(head == 32, second, head)]
        plain[self._whole(data, bounds)] = False
        plain = np.flatnonzero(plain) if not any(set(name) & set(b" \t\n\v\f\r") for name in self.special) else np.zeros(0, dtype=np.int64)
        start, sizes = np.zeros((2, len(known)), dtype=np.int64)
        flat = np.zeros(0, dtype=np.uint32)
        together = self._together([known[i] for i in plain.tolist()]) if len(plain) else None
        if together:
            flat, start[plain], sizes[plain] = together
        others = np.setdiff1d(np.arange(len(known)), plain) if together else np.arange(len(known))
        if len(others):
            found = [e.ids for e in self.tokenizer.encode_batch_fast([known[i].decode() for i in others.tolist()], add_special_tokens=False)]
            sizes[others] = list(map(len, found))
            start[others] = len(flat) + np.cumsum(sizes[others]) - sizes[others]
            flat = np.concatenate((flat, np.array(list(chain.from_iterable(found)), dtype=np.uint32)))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        while self.entries + len(sizes) > len(self.size):
            self.start = np.concatenate((self.start, np.zeros_like(self.start)))
            self.size = np.concatenate((self.size, np.zeros_like(self.size)))
        self.ids[self.used : self.used + len(flat)] = flat
        new = slice(self.entries, self.entries + len(sizes))
        self.size[new] = sizes
        self.start[new] = self.used + start
        self.used += len(flat)
        self.entries += len(sizes)
        self.known.update(zip(known, range(new.start, new.stop)))

    def _cuts(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Starts of the pieces; every row starts with one."""
        cut = np.zeros(len(data) + 1, dtype=bool)
        if len(data) > 2:
            solid = ~scan.SPACE[data]
            between = solid[:-2] & solid[2:]
            middle = data[1:-1]
            line = between & (middle == 10)
            cut[1:-2] |= between & (middle == 32) | line
            cut[2:-1] |= line
            cut[1:-1] |= _LETTER[data[:-1]] & _PUNCTUATION[data[1:]]
        for row in self._whole(data, bounds):
            cut[bounds[row] : bounds[row + 1]] = False
        cut[bounds[:-1][bounds[:-1] < bounds[1:]]] = True
        cut[len(data)] = False
        return np.flatnonzero(cut)

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows, each with the end id, and the bounds of the rows among them."""
        rows = len(bounds) - 1
        start = self._cuts(data, bounds)
        pieces = np.diff(np.searchsorted(start, bounds))
        row = np.repeat(np.arange(rows), pieces)
        # The pieces are all of the data, one after the other.
        ends = np.append(start, len(data)).astype(np.int64)
        found = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        place, found = found.indices.to_numpy(), found.dictionary
        if len(self.known) > KNOWN:
            self._forget()
        entry = np.fromiter(map(self.known.get, _strings(found), repeat(-1)), dtype=np.int64, count=len(found))
        new = np.flatnonzero(entry < 0)
        if len(new):
            entry[new] = self.entries + np.arange(len(new))
            self._learn(found.take(pa.array(new)))
        entries = np.zeros(len(start) + rows, dtype=np.int64)
        entries[np.arange(len(start)) + row] = entry[place]
        size = self.size[entries]
        stop = np.cumsum(size)
        ids = self.ids[np.repeat(self.start[entries] - stop + size, size) + np.arange(int(stop[-1]) if len(stop) else 0)]
        last = np.cumsum(pieces + 1) - 1
        return ids, np.concatenate(([0], stop[last])) if rows else np.zeros(1, dtype=np.int64)

    def column(self, column: pa.Array):
        """Slice by slice: first row, row after the last, ids, bounds of the rows."""
        data, bounds = scan.text_buffer(column)
        for a, b in scan.slices(bounds, SLICE):
            yield a, b, *self.encode(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a])
