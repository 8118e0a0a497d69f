"""Runs, parameters and metrics in append-only Parquet tables.

Parquet has no transaction across tables, so logging a run is an attempt with an id of its own:
parameters and metrics are written first, then the row in ``runs``, a single file, which commits
the attempt. Readers start from the commits and take one attempt of every run, the first
committed. An attempt that died half-way is therefore not seen, and a run that a retry logs
again is still one run.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("experiment", T.StringType()),
        T.StructField("started", T.TimestampType()),
        T.StructField("model_path", T.StringType()),
        T.StructField("data_from", T.TimestampType()),
        T.StructField("data_to", T.TimestampType()),
    ]
)
PARAMS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)
METRICS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("step", T.LongType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("logged", T.TimestampType()),
    ]
)
TABLES = {"runs": RUNS, "params": PARAMS, "metrics": METRICS}

# What the tables hold besides; rows from before attempts were told apart have null.
ATTEMPT = T.StructField("attempt", T.StringType())
COMMITTED = T.StructField("committed", T.TimestampType())


@dataclass
class Run:
    """One training run. A metric is a number, or a list of numbers, one per step."""

    run_id: str
    experiment: str
    model_path: str | None = None
    params: dict = field(default_factory=dict)
    metrics: dict = field(default_factory=dict)
    data_from: datetime | None = None
    data_to: datetime | None = None
    started: datetime = field(default_factory=lambda: datetime.now(timezone.utc))


def _rows(spark: SparkSession, run: Run, attempt: str) -> dict[str, DataFrame]:
    """The rows of an attempt, in the order in which they must be written."""
    texts = T.MapType(T.StringType(), T.StringType())
    with_map = T.StructType([RUNS["run_id"], T.StructField("params", texts)])
    params = {key: str(value) for key, value in run.params.items()}
    rows = {
        "params": spark.createDataFrame([(run.run_id, params)], with_map).select(
            "run_id", F.explode("params")
        ),
        "metrics": spark.createDataFrame(
            [
                (run.run_id, key, step, float(value), run.started)
                for key, values in run.metrics.items()
                for step, value in enumerate(values if isinstance(values, list) else [values])
            ],
            METRICS,
        ),
        "runs": spark.createDataFrame(
            [(run.run_id, run.experiment, run.started, run.model_path, run.data_from, run.data_to)],
            RUNS,
        ).withColumn("committed", F.lit(datetime.now(timezone.utc))),
    }
    return {table: df.withColumn("attempt", F.lit(attempt)) for table, df in rows.items()}


def log_run(spark: SparkSession, store: str, run: Run) -> None:
    """Append a run to the store. Logging a ``run_id`` again changes nothing for readers."""
    for table, df in _rows(spark, run, uuid.uuid4().hex).items():
        df.coalesce(1).write.mode("append").parquet(f"{store}/{table}")


def read_store(spark: SparkSession, store: str) -> dict[str, DataFrame]:
    """The three tables of a store: of every run the attempt that was committed first."""

    def read(table: str, *more: T.StructField) -> DataFrame:
        return spark.read.schema(T.StructType([*TABLES[table].fields, *more])).parquet(f"{store}/{table}")

    order = F.struct(F.coalesce("committed", F.lit(0).cast("timestamp")), F.coalesce("attempt", F.lit("")))
    everything = F.struct(*[f.name for f in RUNS], "attempt")
    runs = read("runs", ATTEMPT, COMMITTED).groupBy("run_id").agg(F.min_by(everything, order).alias("_run")).select("_run.*")
    chosen = runs.select(F.col("run_id").alias("_id"), F.col("attempt").alias("_attempt"))

    def of_chosen(table: str) -> DataFrame:
        rows = read(table, ATTEMPT)
        same = (F.col("run_id") == F.col("_id")) & F.col("attempt").eqNullSafe(F.col("_attempt"))
        return rows.join(chosen, same, "left_semi").drop("attempt")

    return {"runs": runs.drop("attempt"), "params": of_chosen("params"), "metrics": of_chosen("metrics")}


def latest_metrics(metrics: DataFrame) -> DataFrame:
    """The last value of every (run, metric): by time logged, then by step.

    A maximum is combined before the shuffle, so a metric logged at very many steps
    costs one row per task.
    """
    newest = F.max(F.struct("logged", "step", "value"))
    return metrics.groupBy("run_id", "key").agg(newest.alias("_newest")).select(
        "run_id", "key", F.col("_newest.value").alias("value")
    )


def runs_table(runs: DataFrame, metrics: DataFrame) -> DataFrame:
    """One row per run and metric with its last value; a run without metrics has one row."""
    return runs.join(latest_metrics(metrics), "run_id", "left")


def compare_runs(
    runs: DataFrame,
    params: DataFrame,
    metrics: DataFrame,
    metric_keys: list[str],
    param_keys: list[str],
) -> DataFrame:
    """One row per run: the named parameters and the last values of the named metrics."""
    measured = (
        latest_metrics(metrics.where(F.col("key").isin(metric_keys)))
        .groupBy("run_id")
        .pivot("key", metric_keys)
        .agg(F.first("value"))
    )
    chosen = (
        params.where(F.col("key").isin(param_keys))
        .groupBy("run_id")
        .pivot("key", param_keys)
        .agg(F.max("value"))
    )
    return runs.join(chosen, "run_id", "left").join(measured, "run_id", "left")


def best_run(runs: DataFrame, metrics: DataFrame, metric: str, largest: bool = True) -> DataFrame:
    """The best run of each experiment by the last value of ``metric``.

    Ties go to the run that started first, then to the smaller id.
    """
    value = F.col("value")
    measured = latest_metrics(metrics.where(F.col("key") == metric)).where(
        value.isNotNull() & ~F.isnan(value)
    )
    ranking = Window.partitionBy("experiment").orderBy(
        value.desc() if largest else value.asc(), "started", "run_id"
    )
    return (
        runs.join(measured, "run_id")
        .withColumn("_rank", F.row_number().over(ranking))
        .where("_rank = 1")
        .drop("_rank", "key")
        .withColumnRenamed("value", metric)
    )
