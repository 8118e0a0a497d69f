"""How well scores tell fraud from the rest.

A score that is null, NaN or infinite is no score: ``confusion`` does not flag its row, and
the others leave the row out.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyguard.functions import usable_score
from tallyguard.session import materialize

SMALLEST = 1e-15


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole)


def _counts(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    return {
        "precision": precision,
        "recall": recall,
        "f1": _ratio(2 * tp, 2 * tp + fp + fn),
    }


def confusion(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row of counts and rates. A row without a score is not flagged."""
    flagged = usable_score() & (F.col("p_fraud") >= threshold)
    fraud = F.col("is_fraud") == 1
    honest = F.col("is_fraud") == 0
    counted = scored.agg(
        F.count_if(flagged & fraud).alias("tp"),
        F.count_if(flagged & honest).alias("fp"),
        F.count_if(~flagged & honest).alias("tn"),
        F.count_if(~flagged & fraud).alias("fn"),
    )
    return counted.withColumns(_counts(F.col("tp"), F.col("fp"), F.col("fn")))


def threshold_sweep(scored: DataFrame, bins: int = 100) -> DataFrame:
    """Counts and rates when everything from a score bin upwards is flagged.

    ``tpr`` over ``fpr`` is the ROC curve, ``precision`` over ``tpr`` the other one. Rows
    are reduced to ``bins`` before the running sum, so that window holds ``bins`` rows.
    """
    p = F.col("p_fraud")
    threshold = lambda bin_: bin_ / F.lit(float(bins))
    near = F.floor(p * bins)
    # The product may be rounded over a bin's edge; the emitted threshold decides.
    exact = F.when(threshold(near) > p, near - 1).when(threshold(near + 1) <= p, near + 1).otherwise(near)
    counted = (
        scored.where(usable_score() & F.col("is_fraud").isin(0, 1))
        .withColumn("bin", F.greatest(F.lit(0), F.least(exact, F.lit(bins - 1))))
        .groupBy("bin")
        .agg(
            F.count_if(F.col("is_fraud") == 1).alias("fraud"),
            F.count_if(F.col("is_fraud") == 0).alias("honest"),
        )
    )
    # Every bin has a line, also where no score lies.
    every = scored.sparkSession.range(bins).select(F.col("id").alias("bin"))
    binned = every.join(counted, "bin", "left").fillna(0, ["fraud", "honest"])
    downwards = Window.orderBy(F.desc("bin"))
    everything = Window.partitionBy()
    swept = binned.select(
        "bin",
        threshold(F.col("bin")).alias("threshold"),
        F.sum("fraud").over(downwards).alias("tp"),
        F.sum("honest").over(downwards).alias("fp"),
        F.sum("fraud").over(everything).alias("_fraud"),
        F.sum("honest").over(everything).alias("_honest"),
    )
    tp, fp = F.col("tp"), F.col("fp")
    fn = F.col("_fraud") - tp
    return swept.select(
        "bin",
        "threshold",
        tp,
        fp,
        fn.alias("fn"),
        (F.col("_honest") - fp).alias("tn"),
        _ratio(tp, F.col("_fraud")).alias("tpr"),
        _ratio(fp, F.col("_honest")).alias("fpr"),
        _ratio(tp, tp + fp).alias("precision"),
    )


def auc(scored: DataFrame) -> DataFrame:
    """The exact area under the ROC curve in one row: tied scores count half.

    It is the share of (fraud, honest) pairs in the right order. Rows are first reduced to
    one per distinct score. Approximate quantiles then cut the scores into as many buckets
    as there are shuffle partitions; pairs are counted inside each bucket in parallel, and
    only one row per bucket meets in the final running sum. The quantiles decide where the
    cuts lie, not what comes out.
    """
    usable = scored.where(
        usable_score() & F.col("is_fraud").isin(0, 1)
    )
    buckets = max(2, int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shares = [i / buckets for i in range(1, buckets)]
    by_score = usable.groupBy("p_fraud").agg(
        F.count_if(F.col("is_fraud") == 1).alias("fraud"),
        F.count_if(F.col("is_fraud") == 0).alias("honest"),
    )
    # Written once: the rows are scored for the counts only, and cut from these.
    by_score = materialize(by_score, "by-score")
    cuts = sorted(set(by_score.approxQuantile("p_fraud", shares, 1 / (4 * buckets)))) or [0.5]
    bucketed = Bucketizer(
        splits=[-float("inf"), *cuts, float("inf")], inputCol="p_fraud", outputCol="bucket"
    ).transform(by_score)
    lower = Window.partitionBy("bucket").orderBy("p_fraud").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # Twice the number of pairs in order, as an exact integer.
    honest_below = 2 * F.coalesce(F.sum("honest").over(lower), F.lit(0)) + F.col("honest")
    inside = (
        bucketed.withColumn("pairs", _wide(F.col("fraud")) * _narrow(honest_below))
        .groupBy("bucket")
        .agg(*[F.sum(name).alias(name) for name in ("pairs", "fraud", "honest")])
    )
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = 2 * F.coalesce(F.sum("honest").over(earlier), F.lit(0))
    across = inside.withColumn("across", _wide(F.col("fraud")) * _narrow(carried))
    total = across.agg(*[F.sum(n).alias(n) for n in ("pairs", "across", "fraud", "honest")])
    in_order = F.col("pairs").cast("double") + F.col("across").cast("double")
    all_pairs = 2.0 * F.col("fraud") * F.col("honest")
    return total.select(
        "fraud", "honest", F.when(all_pairs > 0, in_order / all_pairs).alias("auc")
    )


def _wide(count: Column) -> Column:
    return count.cast("decimal(18,0)")


def _narrow(count: Column) -> Column:
    return count.cast("decimal(19,0)")


def log_loss(scored: DataFrame) -> DataFrame:
    """Mean log-loss and Brier score in one row; certainty is clipped to stay finite."""
    p = F.greatest(F.lit(SMALLEST), F.least(F.lit(1 - SMALLEST), F.col("p_fraud")))
    y = F.col("is_fraud")
    usable = scored.where(usable_score() & y.isin(0, 1))
    return usable.agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(-(y * F.ln(p) + (1 - y) * F.ln(1 - p))).alias("log_loss"),
        F.avg((F.col("p_fraud") - y) * (F.col("p_fraud") - y)).alias("brier"),
    )
