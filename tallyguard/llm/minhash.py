"""Near-duplicate documents: one-permutation MinHash, banded buckets and star edges.

Each text becomes the set of its distinct two-word (``Shape.words``) shingles; A-Z count as
a-z. One hash of every shingle fills ``bands * rows`` bins with minima (one permutation);
empty bins copy a filled one that a fixed probe sequence finds (optimal densification), so
small sets are compared as well as large ones. ``rows`` bins make a band, and documents
with an equal band share a bucket. A bucket of n documents gives n - 1 candidate edges, a
star around its smallest document, and never all pairs. Edges are confirmed on full sets.

A star may miss a link between two leaves that are both unlike the centre. So the centres
leave their buckets, and while a bucket still holds documents of several components new
stars are laid in it around members drawn by hash: about ``STARS`` in the second round and
sixteen times as many in each later one. When no such bucket is left every pair of a bucket that could join two
components has been compared, or is joined already. Equal sets are one class from the
start, represented by its smallest document, so copies never make edges.

Families of documents that are alike, but not enough, would fill the later rounds with
pairs. So every set also has ``BITS`` parity bits: each shingle flips one of them. Two sets
differ in at least as many shingles as bits, which bounds their similarity from above; pairs
whose bound is too low are dropped inside the join. This filter never drops a link.

What may be lost: a pair at the threshold shares no bucket with probability
(1 - 0.8^rows)^bands, 1.2e-7 with the defaults.

Defined results: a null text, or one without words, has an empty set, links with nothing
and stays; fewer words than a shingle needs make one shingle; a row without ``doc_id`` has
no component and stays; rows that repeat a ``doc_id`` share its component; an empty table
gives an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyguard.llm import scan
from tallyguard.llm.graph import components
from tallyguard.llm.work import batched, materialize, tidy

STARS = 16
BITS = 2048
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


@dataclass(frozen=True)
class Shape:
    words: int = 5
    percent: int = 80
    bands: int = 40
    rows: int = 5

    @property
    def bins(self) -> int:
        return self.bands * self.rows


def shingle_sets(data: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every distinct shingle, ordered by row and hash."""
    start, end, row = scan.words(data, bounds)
    code, kinds = scan.coded(scan.LOWER[data], start, end)
    word = scan.string_hashes(kinds)[code]
    at = np.flatnonzero(row[k - 1 :] == row[: len(row) - k + 1]) if len(row) >= k else np.zeros(0, dtype=np.int64)
    whole = np.zeros(len(at), dtype=np.uint64)
    for step in range(k):
        whole = scan.mix(whole + word[at + step])
    owner = row[at]
    # Rows with fewer words than k: all of them as one shingle.
    n = scan.per_row(row, len(bounds) - 1)
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        first = np.searchsorted(row, short)
        value = np.zeros(len(short), dtype=np.uint64)
        for step in range(k - 1):
            has = step < n[short]
            value[has] = scan.mix(value[has] + word[first[has] + step])
        owner, whole = np.concatenate((owner, short)), np.concatenate((whole, value))
    order, new = scan.firsts(owner, whole)
    return owner[order][new], whole[order][new]


@lru_cache(maxsize=4)
def probes(bins: int) -> np.ndarray:
    """Round by round, the bin that each bin would copy from if it were empty.

    The last rounds walk over all bins, so every empty bin of a non-empty set finds one.
    """
    drawn = scan.seeded(1000, 8 * bins * bins).reshape(-1, bins) % np.uint64(bins)
    walk = (np.arange(bins)[None, :] + np.arange(1, bins)[:, None]) % bins
    return np.concatenate((drawn.astype(np.int64), walk))


def sketch(row: np.ndarray, value: np.ndarray, rows: int, bins: int) -> np.ndarray:
    """A row of densified bin minima for each set; sets must be non-empty to be of use."""
    minima = np.full(rows * bins, EMPTY)
    if len(row):
        bin_ = (((value >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)).astype(np.int64)
        cell = row * bins + bin_
        order = np.lexsort((value, cell))
        first = np.ones(len(order), dtype=bool)
        first[1:] = cell[order][1:] != cell[order][:-1]
        minima[cell[order][first]] = value[order][first]
    minima = minima.reshape(rows, bins)
    filled = minima != EMPTY
    r, b = np.nonzero(~filled & filled.any(1)[:, None])
    for target in probes(bins):
        if not len(r):
            break
        source = target[b]
        found = filled[r, source]
        minima[r[found], b[found]] = minima[r[found], source[found]]
        r, b = r[~found], b[~found]
    return minima


def band_keys(minima: np.ndarray, shape: Shape) -> np.ndarray:
    keys = np.zeros((len(minima), shape.bands), dtype=np.uint64)
    keys += scan.seeded(5, shape.bands)
    for r in range(shape.rows):
        keys = scan.mix(keys + minima[:, r :: shape.rows])
    return keys


def parity_bits(row: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
    """Words of ``BITS`` bits per set; each shingle flips one bit."""
    bit = row * BITS + (scan.mix(value ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(BITS)).astype(np.int64)
    odd = np.bincount(bit, minlength=rows * BITS) & 1
    return np.packbits(odd.astype(bool).reshape(rows, BITS), axis=1).view(np.int64)


FOLD = 8  # words of the bits folded onto each other, for a first, cheaper bound


def _may_link(shape: Shape) -> str:
    """SQL: the sizes of ``a`` and ``b``, and the bounds that their parity bits give, allow a link."""

    def bound(column: str, words: int) -> str:
        apart = " + ".join(f"bit_count({column}_a[{i}] ^ {column}_b[{i}])" for i in range(words))
        # Similarity is at most (n + m - d) / (n + m + d) for sets that differ in d shingles.
        return f"{100 + shape.percent} * ({apart}) <= {100 - shape.percent} * (n_a + n_b)"

    sizes = f"100 * least(n_a, n_b) >= {shape.percent} * greatest(n_a, n_b)"
    return f"{sizes} AND {bound('fold', FOLD)} AND {bound('bits', BITS // 64)}"


def sketches(docs: DataFrame, shape: Shape) -> DataFrame:
    """Per document: size of its set, two keys that identify the set, and its band keys."""
    batched(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = scan.text_buffer(batch.column("text"))
            for a, b in scan.slices(bounds):
                row, value = shingle_sets(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], shape.words)
                size = scan.per_row(row, b - a)
                keys = band_keys(sketch(row, value, b - a, shape.bins), shape)
                ends = np.concatenate(([0], np.cumsum(size)))
                total = lambda v: np.diff(np.concatenate((np.zeros(1, np.uint64), np.cumsum(v, dtype=np.uint64)))[ends]).view(np.int64)
                lists = np.where(size > 0, shape.bands, 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        pa.array(size, pa.int64()),
                        pa.array(total(scan.mix(value))),
                        pa.array(total(scan.mix(value ^ np.uint64(0x5BD1E995)))),
                        pa.ListArray.from_arrays(
                            pa.array(np.concatenate(([0], np.cumsum(lists))), pa.int32()), pa.array(keys[size > 0].view(np.int64).ravel())
                        ),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(b - a + 1) * (BITS // 64), pa.int32()), pa.array(parity_bits(row, value, b - a).ravel())
                        ),
                    ],
                    names=["doc_id", "n", "k1", "k2", "bands", "bits"],
                )

    return tidy(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, n long, k1 long, k2 long, bands array<long>, bits array<long>")


def full_sets(docs: DataFrame, k: int) -> DataFrame:
    """Per document its whole set as shingle hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = scan.text_buffer(batch.column("text"))
            for a, b in scan.slices(bounds):
                row, value = shingle_sets(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], k)
                ends = np.concatenate(([0], np.cumsum(scan.per_row(row, b - a))))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(value.view(np.int64)))],
                    names=["doc_id", "items"],
                )

    return docs.mapInArrow(run, "doc_id long, items array<long>")


def confirm(docs: DataFrame, pairs: DataFrame, shape: Shape) -> DataFrame:
    """Those of ``pairs(a, b)`` whose full sets are similar enough."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    sets = materialize(full_sets(docs.join(needed, "doc_id", "left_semi"), shape.words), "sets")
    left = sets.select(F.col("doc_id").alias("b"), F.col("items").alias("of_b"))
    right = sets.select(F.col("doc_id").alias("a"), F.col("items").alias("of_a"))
    both = pairs.join(left, "b").join(right, "a")
    common = both.select("a", "b", F.size("of_a").alias("n"), F.size("of_b").alias("m"), F.size(F.array_intersect("of_a", "of_b")).alias("c"))
    return common.where(F.expr(f"100L * c >= {shape.percent}L * (n + m - c)")).select("a", "b").distinct()


def _pairs(members: DataFrame, bits: DataFrame, found: DataFrame | None, shape: Shape) -> DataFrame:
    """Pairs of a star's centre and another member of its bucket that may be linked."""
    centres = members.where("centre").select("band", F.col("doc_id").alias("a"))
    other = members.select("band", F.col("doc_id").alias("b"), "centre")
    apart = "a <> b AND NOT (centre AND b < a)"
    ends = lambda name: bits.select(F.col("doc_id").alias(name), F.col("n").alias(f"n_{name}"), F.col("bits").alias(f"bits_{name}"), F.col("fold").alias(f"fold_{name}"))
    may_link = _may_link(shape)
    if found is None:
        stars = centres.join(other, "band").where(apart).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        return stars.join(ends("b"), "b").join(ends("a"), "a").where(may_link).select("a", "b")
    label = lambda name: found.select(F.col("v").alias(name), F.col("c").alias(f"c_{name}"))
    full = lambda df, name: (
        df.join(ends(name), name).join(label(name), name, "left").withColumn(f"c_{name}", F.coalesce(f"c_{name}", name))
    )
    near = full(centres, "a").join(full(other, "b"), "band").where(f"{apart} AND c_a <> c_b AND {may_link}")
    return near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def links_of(docs: DataFrame, entries: DataFrame, bits: DataFrame, shape: Shape) -> DataFrame:
    """Component of every representative that has a confirmed link: ``v, c``."""
    found, links, stars = None, None, 1
    while True:
        sizes = entries.groupBy("band").agg(F.min("doc_id").alias("low"), F.count("*").alias("size")).where("size > 1")
        drawn = F.pmod(F.xxhash64("doc_id", F.lit(stars)), F.col("size")) < (stars if stars > 1 else 0)
        members = entries.join(sizes, "band").withColumn("centre", (F.col("doc_id") == F.col("low")) | drawn).drop("low", "size")
        if stars > 1:
            members = materialize(members, "members")
        new = materialize(confirm(docs, materialize(_pairs(members, bits, found, shape), "pairs"), shape), "confirmed")
        if links is None or new.limit(1).count():
            links = new if links is None else links.unionByName(new)
            found = components(links)
        # Centres leave; buckets whose rest is of one component are done.
        rest = members.where("NOT centre").drop("centre")
        labelled = rest.join(found.select(F.col("v").alias("doc_id"), "c"), "doc_id", "left").select("band", F.coalesce("c", "doc_id").alias("c"))
        mixed = labelled.groupBy("band").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high").select("band")
        entries = materialize(rest.join(mixed, "band", "left_semi"), "entries")
        if not entries.limit(1).count():
            return found
        stars = STARS * stars


def near_duplicates(docs: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``."""
    docs = tidy(docs, doc_id="long", text="string")
    table = materialize(sketches(docs, shape), "sketches")
    classes = table.where("doc_id IS NOT NULL AND n > 0").groupBy("k1", "k2", "n").agg(F.min("doc_id").alias("rep"))
    classes = materialize(classes, "classes")
    by_rep = table.join(classes.select(F.col("rep").alias("doc_id"), "k1", "k2", "n"), ["doc_id", "k1", "k2", "n"], "left_semi")
    entries = by_rep.select("doc_id", F.explode("bands").alias("band"))
    shared = entries.groupBy("band").count().where("count > 1").select("band")
    entries = materialize(entries.join(shared, "band", "left_semi").distinct(), "entries")
    fold = F.array(*[F.expr(" ^ ".join(f"bits[{i}]" for i in range(j, BITS // 64, FOLD))) for j in range(FOLD)])
    bits = by_rep.select("doc_id", "n", "bits", fold.alias("fold")).dropDuplicates(["doc_id"])
    found = links_of(docs, entries, materialize(bits, "bits"), shape)
    grouped = classes.join(found.withColumnRenamed("v", "rep"), "rep", "left").select("k1", "k2", "n", F.coalesce("c", "rep").alias("component"))
    return (
        table.drop("bands", "bits")
        .join(grouped, ["k1", "k2", "n"], "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")))
        .select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
    )
