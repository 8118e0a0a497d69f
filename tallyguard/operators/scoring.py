"""Scoring transactions with a fitted model or with a plain expression, and alerts."""

from __future__ import annotations

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyguard.functions import quoted, sigmoid, usable_score
from tallyguard.operators.training import drop_helpers


def score(model: Transformer | str, df: DataFrame) -> DataFrame:
    """Add ``p_fraud``. ``model`` is a fitted model or the path of a saved one.

    Works on a batch and on a stream; no row moves.
    """
    if isinstance(model, str):
        model = PipelineModel.load(model)
    scored = model.transform(df)
    if "probability" not in scored.columns:
        return scored
    scored = scored.withColumn("p_fraud", vector_to_array("probability")[1])
    return drop_helpers(scored, "features", "rawPrediction", "probability", "prediction")


def _term(name: str, fill: dict[str, float], columns: list[str]) -> Column:
    if name in columns:
        value = F.col(quoted(name)).cast("double")
        # The imputer replaces NaN as well as null.
        return F.coalesce(F.nanvl(value, F.lit(None)), F.lit(float(fill.get(name, 0.0))))
    column, found, kind = name.partition("=")
    if not found or column not in columns:
        raise ValueError(f"no column for coefficient {name!r}")
    return F.when(F.col(quoted(column)) == kind, 1.0).otherwise(0.0)


def score_logistic(
    df: DataFrame,
    coefficients: dict[str, float],
    intercept: float,
    fill: dict[str, float] | None = None,
) -> DataFrame:
    """Add ``p_fraud`` as a column expression: no model object, and part of any SQL plan.

    A missing number counts as ``fill[name]``, or as zero.
    """
    z = F.lit(float(intercept))
    for name, weight in coefficients.items():
        z = z + float(weight) * _term(name, fill or {}, df.columns)
    return df.withColumn("p_fraud", sigmoid(z))


def alerts(scored: DataFrame, k: int = 10, threshold: float = 0.5) -> DataFrame:
    """The ``k`` highest scores of every day among those at or above ``threshold``.

    A score that is null, NaN or infinite raises no alert.

    Spark keeps the best ``k`` of each task's rows before the shuffle, so even a day that
    holds most rows reaches its window as a handful.
    """
    ranking = Window.partitionBy("day").orderBy(F.desc("p_fraud"), "txn_id")
    return (
        scored.where(usable_score() & (F.col("p_fraud") >= threshold))
        .withColumn("day", F.to_date("ts"))
        .withColumn("rank", F.row_number().over(ranking))
        .where(F.col("rank") <= k)
    )
