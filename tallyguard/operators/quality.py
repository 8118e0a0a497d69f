"""Cleaning transactions and reporting on their quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tallyguard.functions import quoted

DEFAULTS = {"channel": "unknown", "device_k": -1}


def clean_transactions(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    """Drop unusable rows, keep the latest row of every ``txn_id``, fill defaults.

    A row is unusable without key, account, time or a finite amount above zero. The filter
    comes first so that it reaches the scan and an unusable copy cannot hide a usable one.
    Rows that tie on time are decided by all other columns. The window keeps one row per
    key before the shuffle as well, so many copies of one key do not meet in one task.
    """
    defaults = DEFAULTS if defaults is None else defaults
    usable = df.where(
        F.col("txn_id").isNotNull()
        & F.col("account_id").isNotNull()
        & F.col("ts").isNotNull()
        & (F.col("amount") > 0)
        & (F.col("amount") < float("inf"))
    )
    rest = sorted(set(df.columns) - {"txn_id", "ts"})
    order = [F.col(quoted(name)).desc_nulls_last() for name in ["ts", *rest]]
    newest_first = Window.partitionBy("txn_id").orderBy(*order)
    latest = (
        usable.withColumn("_rank", F.row_number().over(newest_first))
        .where("_rank = 1")
        .drop("_rank")
    )
    present = {name: value for name, value in defaults.items() if name in df.columns}
    return latest.fillna(present) if present else latest


def as_text(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return column.cast("string")


def quality_report(df: DataFrame, exact: bool = True) -> DataFrame:
    """Per column: rows, nulls, distinct values, smallest and largest value as text.

    Sketches (``exact=False``) are part of the one aggregation that answers for all
    columns, and move a few kilobytes per task whatever the size of the table. Exact
    distinct counts shuffle every distinct value, and run apart from the extremes: text
    has no fixed width, and with its extremes in the same aggregation Spark would sort
    all values instead of hashing them.
    """
    rows = F.count(F.lit(1)).alias("rows")
    measures, lines, counts, count_lines = [rows], [], [], []
    for i, field in enumerate(df.schema):
        column, name = F.col(quoted(field.name)), F.lit(field.name).alias("column")
        measures += [
            F.count(column).alias(f"filled_{i}"),
            F.min(column).alias(f"min_{i}"),
            F.max(column).alias(f"max_{i}"),
        ]
        line = [
            name,
            F.col("rows"),
            (F.col("rows") - F.col(f"filled_{i}")).alias("nulls"),
            as_text(F.col(f"min_{i}"), field.dataType).alias("min"),
            as_text(F.col(f"max_{i}"), field.dataType).alias("max"),
        ]
        if exact:
            counts.append(F.count_distinct(column).alias(f"distinct_{i}"))
            count_lines.append(F.struct(name, F.col(f"distinct_{i}").alias("distinct")))
        else:
            measures.append(F.approx_count_distinct(column).alias(f"approx_{i}"))
            line.append(F.col(f"approx_{i}").alias("approx_distinct"))
        lines.append(F.struct(*line))
    report = df.agg(*measures).select(F.inline(F.array(*lines)))
    if not exact:
        return report
    return report.join(df.agg(*counts).select(F.inline(F.array(*count_lines))), "column")
