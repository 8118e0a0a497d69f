"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

Every source gets a target number of words: its share of all words by weight, at most
``most`` times its size; the excess is shared anew among the others. Document rates are
those nearest to one (least relative entropy) that meet the targets: r = min(most,
exp(l * c)) with one multiplier l per source and c the document's size over the source's
mean size. The multipliers solve the convex dual by Newton steps, safeguarded by brackets;
each step is one grouped sum over the whole table of (source, size) counts.

Rates become copies. A cell, that is all documents of one source and size, gets a whole
number of copies by rounding running sums of rates in the order of size. What then misses
the target is mended from the largest fitting size down, so a source ends within about one
of its smallest documents of its target. Copies of a cell are dealt evenly to its documents
in the order of hashed ids; their numbers come from a range-sorted numbering, so neither a
source nor a cell is ever gathered in one task. Reruns give the same rows.

Defined results: a null text has size 0; null sources form one source, which comes last; a
row without ``doc_id`` is a document as any other; repeated rows are separate documents; an
empty table gives an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyguard.llm.work import materialize, numbered

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    weights: tuple[int, ...] = (5, 2, 1)
    most: int = 3
    tolerance: float = 1e-10
    steps: int = 60


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, size`` and the source as a key without nulls (``no_source, source``)."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").isNull().alias("no_source"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )


def targets(cells: DataFrame, mix: Mix) -> DataFrame:
    """Per source its size, mean document size and target."""
    sources = cells.groupBy("no_source", "source").agg(
        F.sum(F.col("size") * F.col("docs")).alias("source_size"), F.sum("docs").alias("n_docs")
    )
    ranked = numbered(sources, "no_source", "source", name="rank")
    weights = F.array(*[F.lit(w) for w in mix.weights])
    weighted = materialize(
        ranked.withColumn("weight", F.element_at(weights, (F.col("rank") % len(mix.weights) + 1).cast("int"))).withColumn(
            "limit", F.col("source_size") * mix.most
        ),
        "sources",
    )
    capped: Column = F.lit(False)
    n_capped = 0
    while True:
        row = weighted.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(capped, F.col("limit")).otherwise(0)).alias("stopped"),
            F.sum(F.when(capped, 0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        rest, open_ = (row["all"] or 0) - (row["stopped"] or 0), row["open"] or 0
        share = F.lit(float(rest)) * F.col("weight") / F.lit(float(max(open_, 1)))
        # A source once stopped stays so: shares of the others only grow.
        capped = share >= F.col("limit")
        now = weighted.where(capped).count()
        if now == n_capped:
            break
        n_capped = now
    mean = F.greatest(F.col("source_size") / F.col("n_docs"), F.lit(1e-9))
    return weighted.select(
        "no_source", "source", "source_size", F.when(capped, F.col("limit").cast("double")).otherwise(share).alias("target"), capped.alias("full"), mean.alias("mean")
    )


def multipliers(cells: DataFrame, sources: DataFrame, mix: Mix) -> DataFrame:
    """Newton steps on the dual; adds the multiplier ``l`` to every source."""
    top = math.log(mix.most)
    state = sources.select("*", F.lit(0.0).alias("l"), F.lit(-1e3).alias("low"), F.lit(1e3).alias("high"), F.col("full").alias("done"))
    state = materialize(state, "duals")
    for _ in range(mix.steps):
        tilt = F.col("l") * F.col("size") / F.col("mean")
        mass = F.col("size") * F.col("docs") * F.exp(F.least(tilt, F.lit(top)))
        slope = F.when(tilt < top, mass * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = (
            cells.join(state.where("NOT done").select("no_source", "source", "mean", "l"), ["no_source", "source"])
            .groupBy("no_source", "source")
            .agg(F.sum(mass).alias("mass"), F.sum(slope).alias("slope"))
        )
        gap = F.col("mass") - F.col("target")
        met = F.col("done") | F.coalesce(F.abs(gap) <= mix.tolerance * F.col("target"), F.lit(True)) | (F.col("high") - F.col("low") < 1e-14)
        low = F.when(gap < 0, F.col("l")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("l")).otherwise(F.col("high"))
        newton = F.col("l") - F.when(F.col("slope") > 0, gap / F.col("slope"))
        inside = (newton > low) & (newton < high)
        step = F.when(inside, newton).otherwise((low + high) / 2)
        moved = state.join(sums, ["no_source", "source"], "left").select(
            *sources.columns,
            F.when(met, F.col("l")).otherwise(step).alias("l"),
            F.when(met, F.col("low")).otherwise(low).alias("low"),
            F.when(met, F.col("high")).otherwise(high).alias("high"),
            met.alias("done"),
        )
        state = materialize(moved, "duals")
        if not state.where("NOT done").limit(1).count():
            break
    return state.select(*sources.columns, "l")


def cell_copies(cells: DataFrame, duals: DataFrame, mix: Mix) -> DataFrame:
    """For each (source, size) the number of copies of its documents together."""
    rate = F.when(F.col("full"), F.lit(float(mix.most))).otherwise(
        F.exp(F.least(F.col("l") * F.col("size") / F.col("mean"), F.lit(math.log(mix.most))))
    )
    by_size = Window.partitionBy("no_source", "source").orderBy("size").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("docs") * F.col("rate")).over(by_size)
    rounded = (
        cells.join(duals, ["no_source", "source"])
        .withColumn("rate", rate)
        .withColumn("end", end)
        .withColumn("n", F.floor(F.col("end") + 0.5) - F.floor(F.col("end") - F.col("docs") * F.col("rate") + 0.5))
        .withColumn("n", F.when(F.col("full"), F.col("docs") * mix.most).otherwise(F.least(F.greatest("n", F.lit(0)), F.col("docs") * mix.most)))
    )
    rounded = materialize(rounded.select("no_source", "source", "source_size", "target", "size", "docs", "n"), "cells")
    short = (F.first("target") - F.sum(F.col("n") * F.col("size"))).alias("short")
    # One entry per distinct size of the source, the largest size first.
    sizes = F.sort_array(F.collect_list(F.struct("size", "docs", "n")), asc=False).alias("sizes")
    gaps = rounded.where("size > 0").groupBy("no_source", "source").agg(short, sizes)
    fix = F.expr(
        f"""aggregate(sizes,
              named_struct('left', cast(round(abs(short)) as bigint), 'fixes', cast(array() as array<struct<size:bigint,by:bigint>>)),
              (a, x) -> named_struct(
                'left', a.left - x.size * least(a.left div x.size, if(short > 0, {mix.most} * x.docs - x.n, x.n)),
                'fixes', if(least(a.left div x.size, if(short > 0, {mix.most} * x.docs - x.n, x.n)) > 0,
                  concat(a.fixes, array(named_struct('size', x.size, 'by',
                    least(a.left div x.size, if(short > 0, {mix.most} * x.docs - x.n, x.n)) * if(short > 0, 1L, -1L)))),
                  a.fixes)),
              a -> a.fixes)"""
    )
    fixes = gaps.select("no_source", "source", F.explode(fix).alias("f")).select("no_source", "source", "f.size", "f.by")
    return rounded.join(fixes, ["no_source", "source", "size"], "left").withColumn("n", F.col("n") + F.coalesce("by", F.lit(0))).drop("by")


def mixture(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies`` for every document."""
    rows = sized(docs).withColumn("drawn", F.xxhash64("doc_id"))
    table = numbered(rows, "no_source", "source", "size", "drawn", "doc_id")
    cells = materialize(
        table.groupBy("no_source", "source", "size").agg(F.count("*").alias("docs"), F.min("no").alias("first")), "cells"
    )
    duals = multipliers(cells.drop("first"), targets(cells, mix), mix)
    dealt = cell_copies(cells.drop("first"), duals, mix).join(cells.drop("docs"), ["no_source", "source", "size"])
    exact = F.expr(
        "cast((no - first + 1) * cast(n as decimal(19,0)) div docs as bigint) - cast((no - first) * cast(n as decimal(19,0)) div docs as bigint)"
    )
    return table.join(dealt, ["no_source", "source", "size"]).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * exact).alias("taken"), exact.alias("copies")
    )
