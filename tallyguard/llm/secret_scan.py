"""Secrets in texts: fixed patterns, and strings that look drawn at random.

The patterns (assignments to a secret's name, access keys, long hexadecimal numbers) are
taken as they are. Other strings of ``SHORTEST`` and more characters of base64's alphabets are
put to a battery of randomness tests in the alphabet of the encoding that they seem to have:

* chi-squared: are all symbols equally frequent? (by Wilson and Hilferty's cube root),
* runs: do symbols of the alphabet's halves alternate as often as chance would have it?
  (Wald and Wolfowitz),
* serial correlation of neighbouring symbols.

Each gives a standard normal deviate for a random string, and the sum of their squares is the
string's distance from randomness. Short strings pass for random more easily than long ones, so
what a distance is worth is judged by length: the null distribution of every encoding and length
class is that of ordinary text, all text of the corpus outside of candidates and patterns, seen
through the encoding's alphabet and cut into windows of that length. Within each class the
procedure of Benjamini and Hochberg then finds the largest distance at which the expected share
of ordinary strings among those found is still at most ``alpha``. Null and candidates meet as
counts per class and distance, 4,608 at most, summed over all documents.

Spans are in code points, their ends exclusive. Pattern spans are whole matches, leftmost and
not overlapping within their kind; a tested string that touches one of them is left out.

Defined results: a null text is empty, and has no spans; repeated rows are scanned each, and
each of their strings counts as one; strings of digits alone are ordinary; an empty table gives
an empty result. Texts are scanned whole. Other columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyguard.llm import scan
from tallyguard.llm.work import batched, materialize, tidy

# The kinds of spans in their order, and the patterns of the first three.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(rb"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ASSIGN_VALUE = 8
ACCESS = re.compile(rb"AKIA[A-Z0-9]{12,}")
HEX = 32
_NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

# Length classes by their shortest strings; the last has no upper end.
CLASSES = np.array([16, 24, 32, 48, 64, 96, 128, 192, 256])
SHORTEST = int(CLASSES[0])
BINS = 128


def _symbols(*characters: str) -> np.ndarray:
    """The place of each byte in an alphabet, -1 outside of it; further texts name other bytes for the first's."""
    table = np.full(256, -1, dtype=np.int64)
    for text in characters:
        table[np.frombuffer(text.encode(), dtype=np.uint8)] = np.arange(len(text))
    return table


_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
# Encodings, tightest first, with their number of symbols. A string has the first that holds it all.
ENCODINGS = (
    (16, _symbols(_DIGITS + "abcdef")),
    (32, _symbols(_UPPER + "234567")),
    (36, _symbols(_LOWER + _DIGITS)),
    (64, _symbols(_UPPER + _LOWER + _DIGITS + "+/", _UPPER + _LOWER + _DIGITS + "-_")),
)
_HEX, _TOKEN = ENCODINGS[0][1] >= 0, ENCODINGS[3][1] >= 0
_DIGIT = _symbols(_DIGITS) >= 0
CELLS = len(ENCODINGS) * len(CLASSES)

# A document's windows have the lengths of all classes in turn, from a class that its size names.
_TURN = int(CLASSES.sum())
_OFFSETS = np.array([[CLASSES[np.arange(first, first + (c - first) % len(CLASSES)) % len(CLASSES)].sum() for c in range(len(CLASSES))]
                     for first in range(len(CLASSES))])


def deviates(n, k: int, squares, runs, upper, product) -> np.ndarray:
    """Deviates of the three tests, a row each, for strings of ``n`` symbols out of ``k``.

    ``squares`` sums the squared counts of the symbols, ``upper`` counts those of the upper half,
    ``runs`` the runs of either half, and ``product`` sums 2s - k + 1 of neighbours, multiplied.
    """
    n = np.asarray(n, dtype=np.float64)
    freedom, spread = k - 1, 2 / (9 * (k - 1))
    uniform = (np.cbrt(np.maximum(squares * k / n - n, 0) / freedom) - (1 - spread)) / np.sqrt(spread)
    both = 2 * upper * (n - upper)
    variance = both * (both - n) / (n * n * (n - 1))
    # All symbols in one half: as far off as a string of that length can be.
    alternate = np.where(variance > 0, (runs - 1 - both / n) / np.sqrt(np.where(variance > 0, variance, 1)), -np.sqrt(n))
    serial = product / ((k * k - 1) / 3 * np.sqrt(n - 1))
    return np.stack((uniform, alternate, serial))


def battery(symbol: np.ndarray, start: np.ndarray, k: int) -> np.ndarray:
    """The deviates of strings laid end to end; each is as long as the next ``start`` says, 2 at least."""
    n = np.diff(np.append(start, len(symbol)))
    counts = np.bincount(np.repeat(np.arange(len(n)), n) * k + symbol, minlength=len(n) * k).reshape(len(n), k)
    within = np.ones(len(symbol), dtype=bool)
    within[start] = False  # the first symbol of a string has no neighbour before it
    high = symbol >= k // 2
    turn, product = np.zeros(len(symbol), dtype=np.int64), np.zeros(len(symbol), dtype=np.int64)
    turn[1:] = (high[1:] != high[:-1]) & within[1:]
    centred = 2 * symbol - (k - 1)
    product[1:] = np.where(within[1:], centred[1:] * centred[:-1], 0)
    upper = np.add.reduceat(high.astype(np.int64), start)
    return deviates(n, k, (counts * counts).sum(axis=1), 1 + np.add.reduceat(turn, start), upper, np.add.reduceat(product, start))


def _windows(symbol: np.ndarray, first: np.ndarray, length: int, k: int) -> np.ndarray:
    """The deviates of windows of one length."""
    grid = symbol[first[:, None] + np.arange(length)]  # one byte a symbol
    rows = np.arange(len(first))[:, None] * k
    counts = np.bincount((rows + grid).ravel(), minlength=len(first) * k).reshape(len(first), k)
    high = grid >= k // 2
    runs = 1 + np.count_nonzero(high[:, 1:] != high[:, :-1], axis=1)
    centred = (2 * grid - (k - 1)).astype(np.float32)  # sums of these stay exact below 2^24
    product = np.einsum("ij,ij->i", centred[:, 1:], centred[:, :-1])
    return deviates(length, k, (counts * counts).sum(axis=1), runs, np.count_nonzero(high, axis=1), product)


def distance(deviate: np.ndarray) -> np.ndarray:
    """The class of distance from randomness of each string, 0 for the nearest."""
    uniform, alternate, serial = deviate
    # Symbols may be more even than chance has it; that is no sign of ordinary text.
    total = np.maximum(uniform, 0) ** 2 + alternate**2 + serial**2
    return np.minimum(np.floor(8 * np.log2(1 + total)), BINS - 1).astype(np.int64)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of the ranges, one range after the other."""
    stop = np.cumsum(size)
    return np.repeat(start - stop + size, size) + np.arange(int(stop[-1]) if len(stop) else 0)


def _patterns(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and kind of all pattern spans."""
    raw, lowered = data.tobytes(), scan.LOWER[data].tobytes()
    start, end = scan.runs(_HEX[data], bounds)
    long_ = end - start >= HEX
    found = [(a, b, 2) for a, b in zip(start[long_].tolist(), end[long_].tolist())]
    for names, source, kind in ((_NAMES, lowered, 0), ((b"AKIA",), raw, 1)):
        hits = []
        for name in names:
            at = source.find(name)
            while at >= 0:
                hits.append(at)
                at = source.find(name, at + len(name))
        for row in np.unique(np.searchsorted(bounds, hits, side="right") - 1).tolist() if hits else ():
            a, b = int(bounds[row]), int(bounds[row + 1])
            for match in (ASSIGN, ACCESS)[kind].finditer(raw, a, b):
                if kind or len(match[2]) >= ASSIGN_VALUE:
                    found.append((match.start(), match.end(), kind))
    found.sort()
    return tuple(np.array([f[i] for f in found], dtype=np.int64) for i in range(3))


def _candidates(data: np.ndarray, bounds: np.ndarray, base: np.ndarray):
    """Start, end, encoding and length class of the strings to test; ``base`` marks the patterns' bytes."""
    start, end = scan.runs(_TOKEN[data], bounds)
    use = end - start >= SHORTEST
    start, end = start[use], end[use]
    encoding = np.zeros(len(start), dtype=np.int64)
    if len(start):
        size = end - start
        place, first = _ranges(start, size), np.cumsum(size) - size
        text = data[place]

        def every(mask: np.ndarray) -> np.ndarray:
            return np.logical_and.reduceat(mask, first)

        held = np.stack([every(table[text] >= 0) for _, table in ENCODINGS])
        use = every(~base[place]) & ~every(_DIGIT[text])
        start, end, encoding = start[use], end[use], held.argmax(axis=0)[use]
    return start, end, encoding, np.searchsorted(CLASSES, end - start, side="right") - 1


def _null(data: np.ndarray, bounds: np.ndarray, taken: np.ndarray) -> np.ndarray:
    """How many windows of ordinary text lie in each cell and distance."""
    counts = np.zeros((CELLS, BINS), dtype=np.int64)
    for e, (k, table) in enumerate(ENCODINGS):
        symbol = table.astype(np.int8)[data]
        keep = (symbol >= 0) & ~taken
        at = np.concatenate(([0], np.cumsum(keep)))[bounds]
        symbol = symbol[keep]
        size = np.diff(at)
        offset = _OFFSETS[size % len(CLASSES)]
        for c, length in enumerate(CLASSES.tolist()):
            windows = np.maximum(size - offset[:, c] - length + _TURN, 0) // _TURN
            first = np.repeat(at[:-1] + offset[:, c], windows) + _ranges(np.zeros(len(size), dtype=np.int64), windows) * _TURN
            if len(first):
                counts[e * len(CLASSES) + c] = np.bincount(distance(_windows(symbol, first, length, k)), minlength=BINS)
    return counts


_SCANNED = (
    "doc_id long, base array<struct<start: long, kind: int, end: long>>,"
    " tested array<struct<start: long, end: long, cell: int, far: int>>, ordinary array<struct<cell: int, far: int, n: long>>"
)


def _listed(bounds: np.ndarray, **columns: np.ndarray) -> pa.Array:
    kinds = {"kind": pa.int32(), "cell": pa.int32(), "far": pa.int32()}
    fields = [pa.array(v, kinds.get(c, pa.int64())) for c, v in columns.items()]
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays(fields, names=list(columns)))


def scanned(docs: DataFrame) -> DataFrame:
    """Per document its pattern spans and tested strings; ``ordinary`` holds counts of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data_, bounds_ = scan.text_buffer(batch.column("text"))
            for a, b in scan.slices(bounds_):
                data, bounds = data_[bounds_[a] : bounds_[b]], bounds_[a : b + 1] - bounds_[a]
                start, end, kind = _patterns(data, bounds)
                edge = np.zeros(len(data) + 1, dtype=np.int64)
                np.add.at(edge, start, 1)
                np.add.at(edge, end, -1)
                base = np.cumsum(edge)[:-1] > 0
                low, high, encoding, size = _candidates(data, bounds, base)
                place = _ranges(low, high - low)
                taken = base.copy()
                taken[place] = True
                cell, far = encoding * len(CLASSES) + size, np.zeros(len(low), dtype=np.int64)
                for e, (k, table) in enumerate(ENCODINGS):
                    mine = np.flatnonzero(encoding == e)
                    if len(mine):
                        length = high[mine] - low[mine]
                        far[mine] = distance(battery(table[data[_ranges(low[mine], length)]], np.cumsum(length) - length, k))
                counts = _null(data, bounds, taken)
                cells, fars = np.nonzero(counts)
                # Places in characters of their document: bytes that go on a character do not count.
                point = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
                ordinary = np.full(b - a + 1, len(cells))
                ordinary[0] = 0

                def placed(at: np.ndarray, first: np.ndarray) -> np.ndarray:
                    return point[at] - point[bounds[np.searchsorted(bounds, first, side="right") - 1]]

                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a),
                     _listed(np.searchsorted(start, bounds), start=placed(start, start), kind=kind, end=placed(end, start)),
                     _listed(np.searchsorted(low, bounds), start=placed(low, low), end=placed(high, low), cell=cell, far=far),
                     _listed(ordinary, cell=cells, far=fars, n=counts[cells, fars])],
                    names=["doc_id", "base", "tested", "ordinary"],
                )

    batched(docs.sparkSession)
    return docs.mapInArrow(run, _SCANNED)


def bounds_of_distance(found: DataFrame, alpha: float) -> list[int]:
    """For each cell the largest distance at which tested strings are discoveries, -1 if none is."""
    null = found.select(F.explode("ordinary").alias("o")).select("o.cell", "o.far", "o.n", F.lit(0).cast("long").alias("tested"))
    tested = found.select(F.explode("tested").alias("t")).select("t.cell", "t.far", F.lit(0).cast("long").alias("n"), F.lit(1).cast("long").alias("tested"))
    cells = null.unionByName(tested).groupBy("cell", "far").agg(F.sum("n").alias("n"), F.sum("tested").alias("tested"))
    nearer, cell = Window.partitionBy("cell").orderBy("far"), Window.partitionBy("cell")
    p = (F.sum("n").over(nearer) + 1) / (F.sum("n").over(cell) + 1)
    expected = p * F.sum("tested").over(cell)
    judged = cells.withColumn("found", (expected <= alpha * F.sum("tested").over(nearer)) & (F.sum("tested").over(nearer) > 0))
    out = [-1] * CELLS
    for row in judged.where("found").groupBy("cell").agg(F.max("far").alias("far")).collect():  # a row per cell at most
        out[row.cell] = row.far
    return out


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secrets(docs: DataFrame, alpha: float = 0.01) -> DataFrame:
    """Per document the pattern spans counted and hashed, and all spans with those of random strings."""
    found = materialize(scanned(tidy(docs, doc_id="long", text="string")), "scanned")
    far = F.array(*[F.lit(b) for b in bounds_of_distance(found, alpha)])
    random = F.transform(
        F.filter("tested", lambda t: t["far"] <= F.get(far, t["cell"])),
        lambda t: F.struct(t["start"].alias("start"), F.lit(len(KINDS) - 1).alias("kind"), t["end"].alias("end")),
    )

    def number(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    every = F.array_sort(F.concat("base", random))
    return found.select(
        "doc_id", number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"),
        F.sha2(_written(F.array_sort("base")), 256).alias("base_sha256"), _written(every).alias("spans"),
        F.size(random).cast("long").alias("n_random"),
    )
