"""Language of whole texts: a bidirectional gated recurrent network over bytes.

A text is read as windows of ``Net.window`` bytes, all of them. In each window one network
runs forwards and one backwards; from both states every position gets a label, and the
label probabilities of all positions are averaged into those of the document. The network
is trained here, in numpy, by backpropagation through time with Adam, on a bounded sample:
about ``Net.docs`` documents of each language, drawn by hashed id, and ``Net.windows``
windows of each. Training and prediction use the text alone. Every language found is learned;
with more than 64 of them the documents of each are fewer, so that their sum stays bounded.
More than ``Net.languages`` are refused by an error, since then ``lang`` hardly holds languages.

Held out from training are documents with crc32(doc_id as text) mod 5 = 0.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so is every
text if nothing can be learned from; a null ``doc_id`` is never held out and never learned
from; repeated rows get equal results; ties go to the language that sorts first; an empty
table gives an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyguard.llm import scan
from tallyguard.llm.work import batched, tidy


@dataclass(frozen=True)
class Net:
    hidden: int = 8
    window: int = 64
    docs: int = 500
    windows: int = 4
    steps: int = 400
    batch: int = 256
    rate: float = 0.02
    seed: int = 5
    languages: int = 1000


# Up to this number of languages they share no memory: neither the sample nor what is worked on at once gets smaller.
FULL = 64


class BiGru:
    """Gates from a table per byte and the last state: update z, reset r, candidate n."""

    def __init__(self, languages: list[str], net: Net):
        rng = np.random.default_rng(net.seed)
        h, k = net.hidden, len(languages)
        self.languages, self.net = languages, net
        self.weights = {}
        for d in "fb":
            self.weights[f"w{d}"] = rng.normal(0, 0.3, (3 * h, 256)).astype(np.float32)
            self.weights[f"u{d}"] = rng.normal(0, 0.5 / np.sqrt(h), (3 * h, h)).astype(np.float32)
            self.weights[f"v{d}"] = rng.normal(0, 0.5 / np.sqrt(h), (k, h)).astype(np.float32)
        self.weights["c"] = np.zeros((k, 1), dtype=np.float32)

    def at_once(self, size: int = 2048) -> int:
        """Windows to work on at once: ``size``, or fewer if each needs room for many languages."""
        return max(1, size * FULL // max(FULL, len(self.languages)))

    def _run(self, d: str, x: np.ndarray, valid: np.ndarray, keep: list | None) -> np.ndarray:
        """What one direction adds to the logits, (time, languages, windows)."""
        h, steps = self.net.hidden, len(x)
        w, u, v = (self.weights[n + d].copy() for n in "wuv")
        # The sigmoid of the gates and the tanh of the candidate are piecewise linear:
        # clip(x / 4 + 1/2, 0, 1) and clip(x, -1, 1). They cost a tenth of the smooth ones.
        w[: 2 * h] = w[: 2 * h] / 4 + 0.5
        u[: 2 * h] /= 4
        x = x.astype(np.intp)
        state = np.zeros((h, x.shape[1]), dtype=w.dtype)
        out = np.empty((steps, len(v), x.shape[1]), dtype=np.float32)
        padded = not valid.all()
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            g = np.take(w, x[t], axis=1, mode="clip", out=np.empty((3 * h, x.shape[1]), dtype=w.dtype))
            a = u @ state
            gates = g[: 2 * h]
            gates += a[: 2 * h]
            np.clip(gates, 0, 1, out=gates)
            z, r = gates[:h], gates[h:]
            n = g[2 * h :]
            n += r * a[2 * h :]
            np.clip(n, -1, 1, out=n)
            new = n + z * (state - n)
            if padded:
                new *= valid[t]
            if keep is not None:
                keep.append((t, state, z, r, n, a[2 * h :]))
            state = new
            out[t] = v @ state
        return out

    def probabilities(self, x: np.ndarray, valid: np.ndarray) -> np.ndarray:
        """Label probabilities of every position, (time, languages, windows)."""
        p = self._run("f", x, valid, None)
        p += self._run("b", x, valid, None)
        p += self.weights["c"]
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        return p

    def gradients(self, x: np.ndarray, valid: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy over positions and its gradients, through time."""
        h, kept = self.net.hidden, {"f": [], "b": []}
        p = self._run("f", x, valid, kept["f"]) + self._run("b", x, valid, kept["b"]) + self.weights["c"]
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        column = np.arange(x.shape[1])
        total = max(float(valid.sum()), 1.0)
        loss = -float((np.log(p[:, label, column] + 1e-9) * valid[:, 0]).sum()) / total
        p[:, label, column] -= 1
        p *= valid / total
        grads = {name: np.zeros_like(value) for name, value in self.weights.items()}
        grads["c"] = p.sum(axis=(0, 2))[:, None]
        for d in "fb":
            u, v = self.weights[f"u{d}"], self.weights[f"v{d}"]
            back = np.zeros((h, x.shape[1]), dtype=np.float32)
            into = np.zeros((len(x), 3 * h, x.shape[1]), dtype=np.float32)
            for t, before, z, r, n, a in reversed(kept[d]):
                state = (n + z * (before - n)) * valid[t]
                grads[f"v{d}"] += p[t] @ state.T
                ds = (back + v.T @ p[t]) * valid[t]
                dn = ds * (1 - z) * (np.abs(n) < 1)
                dz = ds * (before - n) * ((z > 0) & (z < 1)) / 4
                dr = dn * a * ((r > 0) & (r < 1)) / 4
                into[t] = np.concatenate((dz, dr, dn))
                da = np.concatenate((dz, dr, dn * r))
                grads[f"u{d}"] += da @ before.T
                back = ds * z + u.T @ da
            flat = into.transpose(1, 0, 2).reshape(3 * h, -1)
            where = x.ravel().astype(np.int64)
            for i in range(3 * h):
                grads[f"w{d}"][i] = np.bincount(where, weights=flat[i], minlength=256)
        return loss, grads

    def train(self, x: np.ndarray, valid: np.ndarray, label: np.ndarray) -> list[float]:
        net, rng, losses = self.net, np.random.default_rng(self.net.seed + 1), []
        first = {n: np.zeros_like(v) for n, v in self.weights.items()}
        second = {n: np.zeros_like(v) for n, v in self.weights.items()}
        for step in range(1, net.steps + 1):
            pick = rng.integers(0, x.shape[1], net.batch)
            loss, grads = self.gradients(x[:, pick], valid[:, :, pick], label[pick])
            losses.append(loss)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            rate = net.rate * min(1.0, 2 * (1 - step / (net.steps + 1)))
            for n, g in grads.items():
                g = g * min(1.0, 1.0 / max(norm, 1e-9))
                first[n] += 0.1 * (g - first[n])
                second[n] += 0.01 * (g * g - second[n])
                self.weights[n] -= rate * (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.99**step)) + 1e-8)
            self.weights = {n: v.astype(np.float32) for n, v in self.weights.items()}
        return losses


def windows_of(data: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows as (time, windows), their lengths, and the row of each."""
    size = np.diff(bounds)
    count = -(-size // width)
    row = np.repeat(np.arange(len(size)), count)
    within = (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)) * width
    start = bounds[row] + within
    length = np.minimum(width, size[row] - within)
    padded = np.concatenate((data, np.zeros(width, dtype=np.uint8)))
    return padded[start[None, :] + np.arange(width)[:, None]], length, row


def document_sums(model: BiGru, data: np.ndarray, bounds: np.ndarray, size: int = 2048) -> np.ndarray:
    """Per row the label probabilities summed over its positions."""
    size = model.at_once(size)
    x, length, row = windows_of(data, bounds, model.net.window)
    total = np.zeros((len(bounds) - 1, len(model.languages)))
    time = np.arange(model.net.window)[:, None, None]
    for a in range(0, len(row), size):
        part = slice(a, a + size)
        valid = (time < length[None, None, part]).astype(np.float32)
        p = model.probabilities(x[:, part], valid)
        if not valid.all():
            p *= valid
        summed = p.sum(axis=0)
        for k in range(len(model.languages)):
            total[:, k] += np.bincount(row[part], weights=summed[k], minlength=len(total))
    return total


def fit(docs: DataFrame, net: Net = Net()) -> BiGru | None:
    """Learn from documents that are not held out and have a language; None if there are none.

    ValueError: there are more than ``net.languages`` languages.
    """
    known = docs.where("lang IS NOT NULL AND doc_id IS NOT NULL AND text IS NOT NULL AND NOT held_out")
    counts = known.groupBy("lang").count().limit(net.languages + 1).collect()
    if not counts:
        return None
    if len(counts) > net.languages:
        raise ValueError(f"lang has more than {net.languages} values; raise Net.languages to learn them all")
    each = net.docs * min(1.0, FULL / len(counts))
    share = F.create_map(*[F.lit(v) for row in counts for v in (row["lang"], min(1.0, each / row["count"]))])
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(net.seed)), F.lit(1_000_000_007)) / 1_000_000_007.0
    starts = F.expr(f"transform(sequence(0, {net.windows - 1}), i -> cast(pmod(xxhash64(doc_id, i), greatest(1, length(text) - {net.window} + 1)) as int))")
    cut = F.transform(starts, lambda s: F.substring(F.col("text"), s + 1, F.lit(net.window)))
    sample = (
        known.where(drawn <= F.element_at(share, F.col("lang")))
        .select("doc_id", "lang", cut.alias("cuts"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "lang", "cuts")
        .limit(2 * net.docs * min(FULL, len(counts)))
        .toPandas()
    )
    languages = sorted({row["lang"] for row in counts})
    pieces = [(c, lang) for cuts, lang in zip(sample["cuts"], sample["lang"]) for c in cuts if c]
    data, bounds = scan.text_buffer(pa.array([c for c, _ in pieces], pa.string()))
    first = np.minimum(bounds[1:], bounds[:-1] + net.window)
    length = first - bounds[:-1]
    padded = np.concatenate((data, np.zeros(net.window, dtype=np.uint8)))
    x = padded[bounds[:-1][None, :] + np.arange(net.window)[:, None]]
    valid = (np.arange(net.window)[:, None, None] < length[None, None, :]).astype(np.float32)
    model = BiGru(languages, net)
    model.train(x, valid, np.searchsorted(languages, [lang for _, lang in pieces]))
    return model


def _prepared(docs: DataFrame) -> DataFrame:
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return tidy(docs, doc_id="long", text="string", lang="string").withColumns({"held_out": held, "letters": letters})


def languages(docs: DataFrame, net: Net = Net()) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document."""
    rows = _prepared(docs)
    batched(docs.sparkSession)
    model = fit(rows, net)
    if model is None:
        return rows.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(model.languages, dtype=object)
        for batch in batches:
            data, bounds = scan.text_buffer(batch.column("text"))
            letters = batch.column("letters").to_numpy(zero_copy_only=False)
            for a, b in scan.slices(bounds):
                total = document_sums(model, data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a])
                p = total / np.maximum(total.sum(axis=1, keepdims=True), 1e-12)
                best, known = p.argmax(axis=1), letters[a:b]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a), batch.column("held_out").slice(a, b - a),
                        pa.array(np.where(known, names[best], "und"), pa.string()),
                        pa.array(np.where(known, np.clip(p[np.arange(len(p)), best], 0, 1), 0.0)),
                    ],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    return rows.select("doc_id", "text", "held_out", "letters").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def position_labels(docs: DataFrame, model: BiGru) -> DataFrame:
    """``doc_id, a, b, lang``: runs of bytes with one label, for all positions of all texts."""
    batched(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = scan.text_buffer(batch.column("text"))
            for a, b in scan.slices(bounds):
                part, at = data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]
                x, length, _ = windows_of(part, at, model.net.window)
                valid = np.arange(model.net.window)[:, None] < length[None, :]
                label, step = np.zeros(x.shape, dtype=np.int64), model.at_once()
                for w in range(0, x.shape[1], step):
                    cut = slice(w, w + step)
                    label[:, cut] = model.probabilities(x[:, cut], valid[:, None, cut].astype(np.float32)).argmax(axis=1)
                label = label.T[valid.T]
                row = np.repeat(np.arange(b - a), np.diff(at))
                new = np.ones(len(label), dtype=bool)
                new[1:] = (label[1:] != label[:-1]) | (row[1:] != row[:-1])
                first = np.flatnonzero(new)
                last = np.append(first[1:], len(label)) if len(first) else first
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(row[first] + a)), pa.array(first - at[row[first]]), pa.array(last - at[row[first]]),
                     pa.array(np.array(model.languages, dtype=object)[label[first]], pa.string())],
                    names=["doc_id", "a", "b", "lang"],
                )

    return tidy(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, a long, b long, lang string")
