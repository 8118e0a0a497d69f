"""All features of an account on a stream, equal to the batch ones row by row.

Rows may come in any order within the lateness. Accounts are dealt by hash into groups, and a
group keeps three things from one micro-batch to the next:

* the rows that wait: a row is released once the watermark has passed its time, for only then
  are all rows before it, and all of its instant, known to be there. An event-time timer at the
  earliest waiting row brings the group back for that, also when no new row of it comes;
* the recent rows of the longest span, for trailing counts and sums. A timer drops them when
  the watermark has left them behind, so that an idle account costs nothing but one row;
* of each account the latest row, and the count, sum and moments of all before, for the history.

Reading and writing state costs a few messages a group, whatever the number of its accounts, and
a group's rows are worked on as columns; by account, both cost more than the work itself.
Released rows are worked on in the order (time, id), like the batch windows, and with the same
integers behind the trailing sums. Rows behind the watermark come out at once, marked ``late``
and without features: their place in the order has been given away.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tallyguard.operators.history import LARGEST, NO_SPREAD, REST, SPANS, calendar_features
from tallyguard.session import STATE_STORE
from tallyguard.streaming.features import COMPLETE

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PREVIOUS = ["prev_amount", "gap_seconds"]
HISTORY = ["hist_n", "hist_mean", "hist_sd", "z_amount"]

# Rows are kept as one Arrow stream for a group, not row by row.
_ROWS = "rows binary"
_RECENT = ["account_id", "_us", "amount"]
_PAST = ["account_id", "us", "amount", "n", "total", "mean", "m2"]
_GROUP = "_group"


def _packed(frame: pd.DataFrame) -> tuple[bytes]:
    batch = pa.RecordBatch.from_pandas(frame, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return (sink.getvalue().to_pybytes(),)


def _unpacked(row: tuple) -> pd.DataFrame:
    return pa.ipc.open_stream(pa.py_buffer(bytes(row[0]))).read_pandas()


def _counted(amount: np.ndarray, largest: float) -> np.ndarray:
    """Which amounts are amounts: not those that are null, NaN, infinite or too large."""
    return np.abs(amount) < largest  # false for NaN


def _between(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Exact sums of ``values[start:end]``, as floats; the values are whole numbers."""
    if not len(start):
        return np.zeros(0)
    # Sums that fit into 64 bits come out right from running sums that wrap around.
    fits = float(np.abs(values).max(initial=0)) * float((end - start).max()) < 2.0**62
    kind = np.int64 if fits else object
    listed = values.astype(np.int64) if fits else np.array([int(v) for v in values.tolist()], dtype=object)
    running = np.concatenate((np.zeros(1, dtype=kind), np.cumsum(listed, dtype=kind)))
    return (running[end] - running[start]).astype(np.float64)


def trailing(
    seen: tuple[np.ndarray, np.ndarray, np.ndarray], code: np.ndarray, us: np.ndarray, spans: dict[str, int], limits: tuple[float, int]
) -> dict[str, np.ndarray]:
    """Count, sum and average of an account's amounts in the spans up to each time.

    ``seen`` holds account, time and amount of all rows; accounts are numbers from 0 on.
    """
    largest, rest = limits
    instants = np.unique(seen[1])
    width = len(instants) + 1
    place = seen[0] * width + np.searchsorted(instants, seen[1])
    order = np.argsort(place, kind="stable")
    place, amount = place[order], seen[2][order]
    use = _counted(amount, largest)
    amount = np.where(use, amount, 0.0)
    whole = np.rint(amount)
    part = np.rint((amount - whole) * float(rest))
    counts = np.concatenate(([0], np.cumsum(use)))

    def at(time: np.ndarray, side: str) -> np.ndarray:
        """Where an account's rows from ``time`` on start, or those after it."""
        return np.searchsorted(place, code * width + np.searchsorted(instants, time, side=side), side="left")

    end = at(us, "right")
    out: dict[str, np.ndarray] = {}
    for span, seconds in spans.items():
        start = at(us - seconds * 1_000_000, "left")
        n = counts[end] - counts[start]
        total = _between(whole, start, end) + _between(part, start, end) / float(rest)
        out[f"n_{span}"] = n
        out[f"sum_{span}"] = np.where(n > 0, total, np.nan)
        out[f"avg_{span}"] = np.where(n > 0, total / np.maximum(n, 1), np.nan)
    return out


class AccountHistory(StatefulProcessor):
    """Holds the rows of a group of accounts back until they are in order, then gives them their features."""

    def __init__(self, columns: list[str], types: dict[str, str], given: list[str], spans: dict[str, int]) -> None:
        self._columns, self._types, self._given, self._spans = columns, types, given, spans
        self._limits, self._no_spread = (LARGEST, REST), NO_SPREAD
        self._longest = max(spans.values()) * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._waiting = handle.getListState("waiting", _ROWS)
        self._recent = handle.getValueState("recent", _ROWS)
        self._past = handle.getValueState("past", _ROWS)
        self._timer = handle.getValueState("timer", "at bigint")

    def _wake(self, at: int) -> None:
        """One timer a group, at the earliest time that is wanted."""
        if self._timer.exists():
            (known,) = self._timer.get()
            if known <= at:
                return
            self._handle.deleteTimer(known)
        self._handle.registerTimer(at)
        self._timer.update((at,))

    def _typed(self, frame: pd.DataFrame) -> pd.DataFrame:
        """Columns in order; whole numbers that may be missing stay whole."""
        for name in self._columns:
            if self._types[name] in ("bigint", "int"):
                frame[name] = frame[name].astype("Int64" if self._types[name] == "bigint" else "Int32")
        return frame[self._columns]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        reached = timerValues.getCurrentWatermarkInMs() * 1000
        late, fresh = [], []
        for part in rows:
            part.columns = self._given  # names that are no Python names get lost on the way
            part = part.drop(columns=_GROUP)
            behind = part["_us"] <= reached
            late += [part[behind]] if behind.any() else []
            fresh += [part[~behind]] if not behind.all() else []
        if fresh:
            arrived = pd.concat(fresh, ignore_index=True)
            self._waiting.appendValue(_packed(arrived))
            self._wake(-(-int(arrived["_us"].min()) // 1000))
        if late:
            made = pd.concat(late, ignore_index=True).assign(late=True)
            yield self._typed(made.assign(**{c: None for c in self._columns if c not in made.columns}))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._timer.clear()
        reached = timerValues.getCurrentWatermarkInMs() * 1000
        parts = [_unpacked(row) for row in self._waiting.get()] if self._waiting.exists() else []
        waiting = pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(columns=["_us"], dtype=np.int64)
        recent = _unpacked(self._recent.get()) if self._recent.exists() else None
        passed = waiting["_us"] <= reached
        still = waiting[~passed]
        if passed.any():
            made, recent = self._featured(waiting[passed], recent)
            yield made
            if len(still):
                self._waiting.put([_packed(still)])
            else:
                self._waiting.clear()
        # Later rows are behind the watermark by less than the longest span.
        if recent is not None:
            recent = recent[recent["_us"] > reached - self._longest]
        if recent is not None and len(recent):
            self._recent.update(_packed(recent))
        else:
            self._recent.clear()
        if len(still):
            self._wake(-(-int(still["_us"].min()) // 1000))
        elif recent is not None and len(recent):
            self._wake((int(recent["_us"].max()) + self._longest) // 1000 + 1)

    def _featured(self, ready: pd.DataFrame, recent: pd.DataFrame | None) -> tuple[pd.DataFrame, pd.DataFrame]:
        known = ready[_RECENT] if recent is None else pd.concat((recent, ready[_RECENT]), ignore_index=True)
        codes, accounts = pd.factorize(known["account_id"])
        code = codes[len(known) - len(ready) :]
        rows = ready.assign(_code=code).sort_values(["_code", "_us", "txn_id"], kind="stable", ignore_index=True)
        code = rows.pop("_code").to_numpy()
        us = rows["_us"].to_numpy(dtype=np.int64)
        amount = rows["amount"].to_numpy(dtype=np.float64)  # null as NaN: neither is an amount
        seen = (codes, known["_us"].to_numpy(dtype=np.int64), known["amount"].to_numpy(dtype=np.float64))
        made = self._history(code, us, amount, accounts) | trailing(seen, code, us, self._spans, self._limits)
        return self._typed(rows.assign(late=False, **made)), known[_counted(seen[2], self._limits[0])]

    def _history(self, code: np.ndarray, us: np.ndarray, amount: np.ndarray, accounts: pd.Index) -> dict[str, np.ndarray]:
        """Previous and history columns of rows that are sorted by account, time and id."""
        stored = _unpacked(self._past.get()) if self._past.exists() else pd.DataFrame(columns=_PAST)
        past = {row[0]: row[1:] for row in zip(*(stored[c].tolist() for c in _PAST))}
        first = np.flatnonzero(np.diff(code, prepend=-1))
        previous, gap = np.roll(amount, 1), (us - np.roll(us, 1)) / 1e6
        counts, means, spreads = (np.full(len(us), np.nan) for _ in range(3))
        values, is_amount = amount.tolist(), _counted(amount, self._limits[0]).tolist()
        for start, end in zip(first.tolist(), [*first[1:].tolist(), len(us)]):
            account = accounts[code[start]]
            if account in past:
                last_us, previous[start], n, total, mean, m2 = past[account]
                gap[start] = (us[start] - last_us) / 1e6
            else:
                previous[start], gap[start], n, total, mean, m2 = math.nan, math.nan, 0, 0.0, 0.0, 0.0
            for i in range(start, end):
                counts[i] = n
                if n:
                    means[i] = total / n
                    if n > 1:
                        spreads[i] = math.sqrt(m2 / (n - 1))
                if is_amount[i]:
                    value = values[i]
                    n += 1
                    total += value
                    off = value - mean
                    mean += off / n
                    m2 += off * (off - off / n)
            past[account] = (int(us[end - 1]), values[end - 1], n, total, mean, m2)
        self._past.update(_packed(pd.DataFrame([(account, *row) for account, row in past.items()], columns=_PAST)))
        scored = np.array(is_amount) & (spreads > self._no_spread)  # false for NaN
        score = np.divide(amount - means, spreads, out=np.full(len(us), np.nan), where=scored)
        found = (previous, gap, counts.astype(np.int64), means, spreads, score)
        return dict(zip([*PREVIOUS, *HISTORY], found))

    def close(self) -> None:
        pass


def account_stream(df: DataFrame, lateness: str = "1 hour", spans: dict[str, int] | None = None, groups: int = 1024) -> DataFrame:
    """``account_features`` on a stream of transactions, and ``late``.

    Rows may be out of order by ``lateness``. A row comes out when the watermark, the latest time
    seen less the lateness, has passed it; a row behind the watermark comes out at once, with
    ``late`` true and without features. A NaN amount comes out as null, which is as little of an
    amount. Ids must not repeat. Rows without account, time or id are left to
    ``rejected_rows``. The rows of a group of accounts meet in one Python worker, so bound
    the batches with ``read_stream(..., batch_bytes=KEYED_BATCH)``.

    ``groups`` is the number of groups that all accounts are dealt into: a group that has
    rows to release reads and writes the state of all its accounts, so take more of them for many
    millions of accounts. It belongs to the checkpoint and cannot change in it.
    """
    spans = spans or SPANS
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    names = [c for c in df.columns if c != "ts"]
    # The state function sees late rows as well, since it does not see the watermark's column.
    timed = df.where(COMPLETE).withWatermark("ts", lateness).select(*names, F.unix_micros("ts").alias("_us"))
    rows = timed.withColumn(_GROUP, F.pmod(F.xxhash64("account_id"), F.lit(groups)))
    velocity = [f"{what}_{s}" for what in ("n", "sum", "avg") for s in spans]
    whole = {"hist_n", *(f"n_{s}" for s in spans)}
    added = [T.StructField(c, T.LongType() if c in whole else T.DoubleType()) for c in [*PREVIOUS, *velocity, *HISTORY]]
    schema = T.StructType([*timed.schema.fields, *added, T.StructField("late", T.BooleanType())])
    types = {f.name: f.dataType.simpleString() for f in schema}
    processor = AccountHistory(schema.names, types, rows.columns, spans)
    found = rows.groupBy(_GROUP).transformWithStateInPandas(processor, schema, outputMode="Append", timeMode="EventTime")
    rebuilt = found.withColumn("ts", F.timestamp_micros("_us")).drop("_us")
    return calendar_features(rebuilt).select(*df.columns, *[f.name for f in added], "hour", "weekday", "is_night", "late")
