"""Features of a transaction drawn from its account's earlier transactions.

All windows are partitioned by account and ordered by time and id, so that they share one
exchange and one sort. Accounts too big for one task take the chunked way (see ``hot``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyguard.functions import quoted, sigmoid, unit_hash
from tallyguard.operators.hot import (
    HotAccounts,
    Skew,
    cut_into_chunks,
    join_carry,
    split_hot,
)

SPANS = {"1h": 3600, "1d": 86400, "7d": 7 * 86400}

# A trailing sum is a difference of two running sums and must come out the same whatever
# the order and the partitioning. Amounts are therefore summed as integers: whole units,
# and the rest in units of 2^-52, which is exact for amounts of one and more. Smaller ones
# are rounded to 2^-52 (2e-16). Amounts from LARGEST on, like NaN and infinity, are no
# amounts: no feature but ``prev_amount`` sees them. With smaller ones, sums of up to 10^11
# rows fit into decimals of 38 digits.
REST = 1 << 52
LARGEST = 1e27
WHOLE, PART = "decimal(28,0)", "decimal(20,0)"

# Money has two places; a spread below this is rounding noise around equal amounts.
NO_SPREAD = 1e-9


def _by_account() -> Window:
    return Window.partitionBy("account_id").orderBy("_us", "txn_id")


def _in_chunk(df: DataFrame) -> Window:
    """Like ``_by_account``, inside one chunk, on the order that ``df`` is sorted by."""
    time = "_instant" if "_instant" in df.columns else "_us"
    return Window.partitionBy("account_id", "_chunk").orderBy(time, "txn_id")


def _cut(hot: DataFrame, rows: int, skew: Skew) -> DataFrame:
    return cut_into_chunks(hot, ["_us", "txn_id"], rows, skew)


def _timed(df: DataFrame) -> DataFrame:
    """Windows order and measure time in whole microseconds."""
    return df.withColumn("_us", F.unix_micros("ts"))


def _untimed(df: DataFrame) -> DataFrame:
    """Rebuild ``ts`` after the exchange, so that the exchange moves the time only once."""
    return df.withColumn("ts", F.timestamp_micros("_us")).drop("_us")


# previous transaction


def _with_previous(df: DataFrame, amount: Column, us: Column) -> DataFrame:
    gap = (F.col("_us") - us) / 1e6
    return df.withColumns({"prev_amount": amount, "gap_seconds": gap})


def _prev_plain(df: DataFrame) -> DataFrame:
    order = _by_account()
    return _with_previous(df, F.lag("amount").over(order), F.lag("_us").over(order))


def _prev_chunked(work: DataFrame, base: DataFrame) -> DataFrame:
    seen = F.struct("amount", "_us")
    last = base.groupBy("account_id", "_chunk").agg(
        F.max_by(seen, F.struct("_us", "txn_id")).alias("_last")
    )
    carry = last.select(
        "account_id",
        "_chunk",
        F.lag("_last").over(Window.partitionBy("account_id").orderBy("_chunk")).alias("_carried"),
    )
    inside = work.withColumn("_inside", F.lag(seen).over(_in_chunk(work)))
    joined = join_carry(inside, carry).withColumn(
        "_previous", F.coalesce("_inside", "_carried")
    )
    return _with_previous(joined, F.col("_previous.amount"), F.col("_previous._us")).drop(
        "_inside", "_carried", "_previous"
    )


def prev_features(df: DataFrame, skew: Skew = Skew()) -> DataFrame:
    """Add ``prev_amount`` and ``gap_seconds``, null on an account's first transaction."""

    def chunked(hot: DataFrame, rows: int) -> DataFrame:
        cut = _cut(hot, rows, skew)
        return _prev_chunked(cut, cut).drop("_chunk")

    return _untimed(split_hot(_timed(df), _prev_plain, chunked, skew))


# trailing spans


def _amount() -> Column:
    """The amount, null where it is none."""
    return F.when(F.abs(F.col("amount")) < LARGEST, F.col("amount"))


def _in_units(df: DataFrame) -> DataFrame:
    """Add ``_whole`` and ``_rest``, null where there is no finite amount."""
    amount = _amount()
    return df.withColumn("_whole", F.rint(amount).cast(WHOLE)).withColumn(
        "_rest", F.rint((amount - F.rint(amount)) * float(REST)).cast("bigint").cast(PART)
    )


def _money(whole: Column, rest: Column) -> Column:
    return whole.cast("double") + rest.cast("double") / float(REST)


def _named_spans(df: DataFrame, totals: dict[str, tuple[Column, Column, Column]]) -> DataFrame:
    """Name the totals of each span: (count, whole units, rest)."""
    columns = {}
    for span, (count, whole, rest) in totals.items():
        columns[f"n_{span}"] = count
        columns[f"sum_{span}"] = F.when(count > 0, _money(whole, rest))
        columns[f"avg_{span}"] = F.when(count > 0, _money(whole, rest) / count)
    return df.withColumns({name: columns[name] for name in _span_columns(totals)})


def _velocity_plain(df: DataFrame, spans: dict[str, int]) -> DataFrame:
    """Trailing total = running total now less running total just before the span.

    Both frames start at the account's first row and only grow, so the work is linear. A
    frame that slides at both ends is recomputed for every row.
    """
    timeline = Window.partitionBy("account_id").orderBy("_us")
    upper = {"now": Window.currentRow} | {
        span: -(seconds * 1_000_000 + 1) for span, seconds in spans.items()
    }
    kinds = {"n": F.count("_whole"), "whole": F.sum("_whole"), "rest": F.sum("_rest")}
    work = _in_units(df).withColumns(
        {
            f"_{what}_{name}": F.coalesce(
                total.over(timeline.rangeBetween(Window.unboundedPreceding, bound)), F.lit(0)
            )
            for name, bound in upper.items()
            for what, total in kinds.items()
        }
    )
    totals = {
        span: tuple(F.col(f"_{what}_now") - F.col(quoted(f"_{what}_{span}")) for what in kinds)
        for span in spans
    }
    result = _named_spans(work, totals)
    return result.select([quoted(c) for c in df.columns + _span_columns(spans)])


def _span_columns(spans: dict[str, int]) -> list[str]:
    return [f"{what}_{s}" for what in ("n", "sum", "avg") for s in spans]


def _moves(hot: DataFrame, rows: int, spans: dict[str, int], skew: Skew) -> DataFrame:
    """The comings and goings of hot accounts, cut into chunks.

    Every row arrives at its time and leaves each span when it expires. ``_leaves`` is 0
    for an arrival and the number of the span otherwise. ``_instant`` sorts by time and
    puts arrivals first: what expires exactly now is still inside the span.
    """
    nothing = F.lit(None).cast(hot.schema)
    arrival = F.struct(
        (F.col("_us") * 2).alias("_instant"),
        F.lit(0).alias("_leaves"),
        F.struct(*[quoted(c) for c in hot.columns]).alias("_row"),
    )
    departures = [
        F.struct(
            ((F.col("_us") + seconds * 1_000_000) * 2 + 1).alias("_instant"),
            F.lit(i).alias("_leaves"),
            nothing.alias("_row"),
        )
        for i, seconds in enumerate(spans.values(), start=1)
    ]
    moves = _in_units(hot).select(
        "account_id", "txn_id", "_whole", "_rest", F.inline(F.array(arrival, *departures))
    )
    return cut_into_chunks(moves, ["_instant", "txn_id"], rows * (1 + len(spans)), skew)


def _totals(spans: dict[str, int]) -> dict[str, Column]:
    """For each span (1, 2, ...) what has arrived less what has left."""
    found = {}
    for i, _ in enumerate(spans, start=1):

        def net(amount: Column) -> Column:
            leaves = F.col("_leaves")
            return F.sum(F.when(leaves == 0, amount).when(leaves == i, -amount))

        one = F.when(F.col("_whole").isNotNull(), F.lit(1).cast("bigint"))
        parts = {"n": one, "whole": F.col("_whole"), "rest": F.col("_rest")}
        found |= {f"{what}_{i}": net(amount) for what, amount in parts.items()}
    return found


def _velocity_chunked(moves: DataFrame, spans: dict[str, int]) -> DataFrame:
    """Arrivals with their trailing totals, still in their chunks and sorted.

    A trailing total is what has arrived less what has left: before the chunk, inside it
    up to the end of the row's instant, and in the rest of that instant when it runs on
    into the following chunks.
    """
    totals = _totals(spans)
    place = ["account_id", "_chunk", "_instant", "txn_id"]
    # Default frame: all rows up to and including those of the same instant.
    running = Window.partitionBy("account_id", "_chunk").orderBy("_instant")
    local = (
        moves.repartition("account_id", "_chunk")
        .sortWithinPartitions(*place)
        .withColumns({name: total.over(running) for name, total in totals.items()})
        .where("_leaves = 0")
    )
    work = join_carry(local, _instant_carry(moves, totals))

    def at(name: str) -> Column:
        rest = F.when(F.col("_instant") == F.col("_last"), F.col(f"_following.{name}"))
        inside, before, after = (
            F.coalesce(part, F.lit(0)) for part in (F.col(name), F.col(f"_before.{name}"), rest)
        )
        return inside + before + after

    named = {
        span: tuple(at(f"{what}_{i}") for what in ("n", "whole", "rest"))
        for i, span in enumerate(spans, start=1)
    }
    return _named_spans(work, named).select(
        "_chunk", "_instant", "_row.*", *map(quoted, _span_columns(spans))
    )


def _instant_carry(moves: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """Per account and chunk: the totals ``_before`` it, its ``_last`` instant, and the
    totals of that instant's rows in the ``_following`` chunks, when it runs on into them."""
    place = ["account_id", "_chunk"]
    named = [total.alias(name) for name, total in totals.items()]
    edges = moves.groupBy(*place).agg(
        F.min("_instant").alias("_first"), F.max("_instant").alias("_last"), *named
    )
    # What happens at the first instant of each chunk.
    first = edges.select(*place, "_first")
    opening = (
        join_carry(moves, first)
        .where(F.col("_instant") == F.col("_first"))
        .groupBy(*place)
        .agg(F.struct(*named).alias("_opening"))
    )
    account = Window.partitionBy("account_id").orderBy("_chunk")
    earlier = account.rowsBetween(Window.unboundedPreceding, -1)
    same_instant = Window.partitionBy("account_id", "_first").orderBy(F.desc("_chunk"))

    def summed(prefix: str, window: Window) -> Column:
        return F.struct(*[F.sum(f"{prefix}{name}").over(window).alias(name) for name in totals])

    following = F.lead(F.struct("_first", "_run_on")).over(account)
    return (
        join_carry(edges, opening)
        .withColumn("_before", summed("", earlier))
        .withColumn("_run_on", summed("_opening.", same_instant))
        .withColumn("_next", following)
        .select(
            *place,
            "_before",
            "_last",
            F.when(F.col("_next._first") == F.col("_last"), F.col("_next._run_on")).alias(
                "_following"
            ),
        )
    )


def velocity_features(
    df: DataFrame, spans: dict[str, int] | None = None, skew: Skew = Skew()
) -> DataFrame:
    """Count, sum and average of amounts in trailing spans, this transaction included.

    A span of s seconds holds what the account did from ``ts - s`` to ``ts``, both ends
    and all transactions of the same instant included. ``spans`` maps names to seconds.
    """
    spans = spans or SPANS

    def chunked(hot: DataFrame, rows: int) -> DataFrame:
        moves = _moves(hot, rows, spans, skew)
        return _velocity_chunked(moves, spans).drop("_chunk", "_instant")

    return _untimed(
        split_hot(_timed(df), lambda part: _velocity_plain(part, spans), chunked, skew)
    )


# whole history


def _with_score(df: DataFrame, n: Column, mean: Column, sd: Column) -> DataFrame:
    amount = _amount()
    return df.withColumns({"hist_n": n, "hist_mean": mean, "hist_sd": sd}).withColumn(
        "z_amount",
        F.when(
            F.col("hist_sd") > NO_SPREAD, (amount - F.col("hist_mean")) / F.col("hist_sd")
        ),
    )


def calendar_features(df: DataFrame) -> DataFrame:
    """Add ``hour``, ``weekday`` (1 = Sunday) and ``is_night`` (before six)."""
    hour = F.hour("ts")
    return df.withColumns(
        {"hour": hour, "weekday": F.dayofweek("ts"), "is_night": (hour < 6).cast("int")}
    )


def _history_plain(df: DataFrame) -> DataFrame:
    earlier = _by_account().rowsBetween(Window.unboundedPreceding, -1)
    amount = _amount()
    return _with_score(
        df,
        F.count(amount).over(earlier),
        F.avg(amount).over(earlier),
        F.stddev_samp(amount).over(earlier),
    )


def _history_chunked(work: DataFrame, base: DataFrame) -> DataFrame:
    """Merge the moments before the chunk with those inside it.

    The carried sums are taken about the account's mean so that no digits cancel.
    """
    account = Window.partitionBy("account_id")
    before = account.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    moments = base.groupBy("account_id", "_chunk").agg(
        F.count(_amount()).alias("n"),
        F.avg(_amount()).alias("mean"),
        F.var_pop(_amount()).alias("var"),
    )
    centre = F.sum(F.col("n") * F.col("mean")).over(account) / F.sum("n").over(account)
    off = F.col("mean") - F.col("centre")
    carry = (
        moments.withColumn("centre", F.when(F.sum("n").over(account) > 0, centre))
        .select(
            "account_id",
            "_chunk",
            "centre",
            F.sum("n").over(before).alias("_n0"),
            F.sum(F.col("n") * off).over(before).alias("shift"),
            F.sum(F.col("n") * (F.col("var") + off * off)).over(before).alias("squares"),
        )
        .withColumn("_off0", F.when(F.col("_n0") > 0, F.col("shift") / F.col("_n0")))
        .select(
            "account_id",
            "_chunk",
            "_n0",
            (F.col("centre") + F.col("_off0")).alias("_mean0"),
            (F.col("squares") - F.col("shift") * F.col("_off0")).alias("_m20"),
        )
    )
    earlier = _in_chunk(work).rowsBetween(Window.unboundedPreceding, -1)
    inside = work.withColumns(
        {
            "_n1": F.count(_amount()).over(earlier),
            "_mean1": F.avg(_amount()).over(earlier),
            "_m21": F.var_pop(_amount()).over(earlier) * F.count(_amount()).over(earlier),
        }
    )
    zero = F.lit(0.0)
    joined = join_carry(inside, carry)
    n0, n1 = F.coalesce("_n0", F.lit(0)), F.col("_n1")
    mean0, mean1 = F.coalesce("_mean0", "_mean1"), F.coalesce("_mean1", "_mean0")
    n = n0 + n1
    gap = mean1 - mean0
    mean = F.when(n > 0, mean0 + gap * n1 / n)
    m2 = F.coalesce("_m20", zero) + F.coalesce("_m21", zero) + gap * gap * n0 * n1 / n
    spread = F.when(n > 1, F.sqrt(F.greatest(m2, zero) / (n - 1)))
    columns = work.columns + ["hist_n", "hist_mean", "hist_sd", "z_amount"]
    return _with_score(joined, n, mean, spread).select([quoted(c) for c in columns])


def history_features(df: DataFrame, skew: Skew = Skew()) -> DataFrame:
    """How far an amount lies from the account's strictly earlier ones, and the calendar.

    ``hist_n``, ``hist_mean``, ``hist_sd`` and ``z_amount`` see earlier transactions only.
    """

    def chunked(hot: DataFrame, rows: int) -> DataFrame:
        cut = _cut(hot, rows, skew)
        return _history_chunked(cut, cut).drop("_chunk")

    scored = split_hot(_timed(df), _history_plain, chunked, skew)
    return calendar_features(_untimed(scored))


# all of them together


def account_features(
    df: DataFrame,
    spans: dict[str, int] | None = None,
    skew: Skew = Skew(),
    hot: HotAccounts | None = None,
) -> DataFrame:
    """Previous, trailing and history features at once: one count of the accounts, one
    exchange and one sort for all windows of ordinary accounts, and likewise for the
    chunks of hot ones."""
    spans = spans or SPANS

    def plain(part: DataFrame) -> DataFrame:
        return _history_plain(_velocity_plain(_prev_plain(part), spans))

    def chunked(hot: DataFrame, rows: int) -> DataFrame:
        moves = _moves(hot, rows, spans, skew)
        base = moves.where("_leaves = 0").select("_chunk", "_row.*")
        work = _prev_chunked(_velocity_chunked(moves, spans), base)
        return _history_chunked(work, base).drop("_chunk", "_instant")

    return calendar_features(_untimed(split_hot(_timed(df), plain, chunked, skew, hot)))


def plant_fraud(
    df: DataFrame,
    base: float = -4.0,
    per_amount: float = 0.03,
    per_prev: float = 0.002,
    skew: Skew = Skew(),
) -> DataFrame:
    """Add ``is_fraud``: a planted label, more likely with bigger amounts now and before.

    The draw hashes the key, so the label of a transaction never changes between runs.
    ``prev_amount`` is used when present and computed for the purpose otherwise.
    """
    known = df if "prev_amount" in df.columns else prev_features(df, skew)
    z = (
        F.lit(base)
        + per_amount * F.col("amount")
        + per_prev * F.coalesce(F.col("prev_amount"), F.lit(0.0))
    )
    draw = unit_hash(F.col("txn_id").cast("string"))
    labelled = known.withColumn("is_fraud", F.when(draw < sigmoid(z), 1).otherwise(0))
    return labelled.select(*[quoted(name) for name in df.columns], "is_fraud")
