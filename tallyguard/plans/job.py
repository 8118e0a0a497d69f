"""Prepare, train and score: the three steps of the fraud job."""

from __future__ import annotations

import uuid
from dataclasses import asdict, dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyguard.operators.boosting import BoostedTrees, Boosting, score_boosted, train_boosted2
from tallyguard.operators.evaluation import auc, confusion, log_loss
from tallyguard.operators.history import account_features, plant_fraud
from tallyguard.operators.hot import Skew, hot_accounts
from tallyguard.operators.quality import DEFAULTS, clean_transactions
from tallyguard.operators.rename import korean_transactions
from tallyguard.operators.scoring import alerts, score
from tallyguard.operators.split import class_weights, split
from tallyguard.operators.tracking import Run, best_run, log_run, read_store
from tallyguard.operators.training import NUMERIC, Trained, train_boosted, train_logistic
from tallyguard.schema import KOREAN
from tallyguard.session import materialize
from tallyguard.sources.tables import load_transactions, write_table
from tallyguard.streaming.account import account_stream
from tallyguard.streaming.scoring import run_to_parquet

EXPERIMENT = "fraud"
METRIC = "auc"


def prepare(spark: SparkSession, folder: str, out: str, skew: Skew = Skew()) -> DataFrame:
    """Load, clean, add features and the planted label; write the table by day.

    A later run into the same ``out`` replaces the days that it prepares and keeps others.

    Accounts are counted in the raw table, which reads one column of it. Only when some
    are hot, and several branches read the clean rows, are these written first.
    """
    raw = load_transactions(spark, folder)
    hot = hot_accounts(raw, skew)
    clean = clean_transactions(raw)
    if hot.any:
        clean = materialize(clean, "clean")
    featured = account_features(clean, skew=skew, hot=hot)
    return write_table(plant_fraud(featured), f"{out}/prepared", mode="overwrite")


def _assess(scored: DataFrame) -> dict[str, float]:
    """The metrics of a run; every frame collected here is a single row.

    The two columns that all of them read are written first, so rows are scored once.
    """
    scored = materialize(scored.select("is_fraud", "p_fraud"), "scored")
    rows = [confusion(scored).first(), auc(scored).first(), log_loss(scored).first()]
    merged = {k: v for row in rows for k, v in row.asDict().items() if v is not None}
    wanted = ("auc", "precision", "recall", "f1", "log_loss", "brier")
    return {name: merged[name] for name in wanted if name in merged}


def train(
    spark: SparkSession,
    prepared: DataFrame,
    out: str,
    boosted: dict | None = None,
    logistic: dict | None = None,
    boosted2: dict | None = None,
    learners: tuple[str, ...] = ("boosted", "logistic"),
) -> str:
    """Train the classifiers on the training part, measure them on the rest, log the runs.

    ``learners`` names them: MLlib's trees, logistic regression, and ``boosted2``, the
    second-order trees; each takes its settings by the argument of its name.

    Logistic regression sees the table under its Korean names. The columns to train on are
    written once, since the stages of both classifiers read them about ten times. Returns
    the store's path.
    """
    train_rows, test_rows = split(prepared)
    columns = ["txn_id", *NUMERIC, "channel", "is_fraud", "class_weight"]
    weighted = materialize(class_weights(train_rows).select(columns), "training")
    extent = prepared.agg(F.min("ts").alias("data_from"), F.max("ts").alias("data_to")).first()
    numeric = [KOREAN.get(name, name) for name in NUMERIC]

    def boosted_run() -> tuple[Trained, DataFrame, dict]:
        settings = {"maxIter": 20, "maxDepth": 4, **(boosted or {})}
        fitted = train_boosted(
            weighted, NUMERIC, category="channel", weight="class_weight", key="txn_id", **settings
        )
        return fitted, score(fitted.model, test_rows), settings

    def logistic_run() -> tuple[Trained, DataFrame, dict]:
        settings = {"maxIter": 50, **(logistic or {})}
        fitted = train_logistic(
            korean_transactions(weighted),
            numeric,
            label=KOREAN["is_fraud"],
            category=KOREAN["channel"],
            weight="class_weight",
            key=KOREAN["txn_id"],
            **settings,
        )
        scored = score(fitted.model, korean_transactions(test_rows))
        return fitted, scored.withColumnRenamed(KOREAN["is_fraud"], "is_fraud"), settings

    def boosted2_run() -> tuple[BoostedTrees, DataFrame, dict]:
        chosen = Boosting(**(boosted2 or {}))
        fitted = train_boosted2(weighted, NUMERIC, category="channel", weight="class_weight", settings=chosen)
        return fitted, score_boosted(fitted, test_rows), asdict(chosen)

    store = f"{out}/runs"
    fits = {"boosted": ("en", boosted_run), "logistic": ("ko", logistic_run), "boosted2": ("en", boosted2_run)}
    for learner in learners:
        names, fit = fits[learner]
        started = datetime.now(timezone.utc)
        fitted, scored, settings = fit()
        run_id = f"{learner}-{uuid.uuid4().hex[:12]}"
        path = f"{out}/models/{run_id}"
        if isinstance(fitted, BoostedTrees):
            fitted.save(spark, path)
        else:
            fitted.model.save(path)
        run = Run(
            run_id=run_id,
            experiment=EXPERIMENT,
            model_path=path,
            params={"learner": learner, "names": names, **settings},
            metrics=_assess(scored),
            data_from=extent.data_from,
            data_to=extent.data_to,
            started=started,
        )
        log_run(spark, store, run)
    return store


@dataclass(frozen=True)
class BestRun:
    """The run that scores: its id, where its model lies, which learner and names it has."""

    run_id: str
    model_path: str
    learner: str
    names: str

    def score(self, spark: SparkSession, df: DataFrame) -> DataFrame:
        """Add ``p_fraud`` to a batch or a stream of prepared transactions."""
        if self.learner == "boosted2":
            return score_boosted(BoostedTrees.load(spark, self.model_path), df)
        if self.names != "ko":
            return score(self.model_path, df)
        # Keep the canonical columns beside the Korean ones that the model reads.
        korean = {KOREAN[c]: F.col(c) for c in df.columns if c in KOREAN}
        return score(self.model_path, df.withColumns(korean)).drop(*korean)


def find_best(spark: SparkSession, store: str) -> BestRun:
    tables = read_store(spark, store)
    best = best_run(tables["runs"].where(F.col("experiment") == EXPERIMENT), tables["metrics"], METRIC).first()
    params = tables["params"].where((F.col("run_id") == best.run_id) & F.col("key").isin("names", "learner"))
    known = {row.key: row.value for row in params.collect()}  # two rows
    return BestRun(best.run_id, best.model_path, known["learner"], known["names"])


def score_best(spark: SparkSession, prepared: DataFrame, store: str, k: int = 10) -> DataFrame:
    """Score all transactions with the best run's model and return the alerts."""
    best = find_best(spark, store)
    columns = ["txn_id", "account_id", "ts", "amount", "channel", "is_fraud", "p_fraud"]
    scored = best.score(spark, prepared)
    return alerts(scored.select(columns), k).withColumn("model", F.lit(best.run_id.split("-")[0]))


def score_stream_best(
    spark: SparkSession, source: DataFrame, store: str, sink: str, checkpoint: str, lateness: str = "1 hour", **trigger: str
) -> StreamingQuery:
    """Score a stream of transactions with the best run's model, whatever features it needs.

    The features come from ``account_stream``, equal to those the model was trained on. Rows that
    are no transactions for ``clean_transactions`` are left out, channels and devices filled as
    there; ids must not repeat. A late row is written without a score.
    """
    usable = source.where("account_id IS NOT NULL AND amount > 0 AND amount < double('inf')").fillna(DEFAULTS)
    scored = find_best(spark, store).score(spark, account_stream(usable, lateness))
    scored = scored.withColumn("p_fraud", F.when(~F.col("late"), F.col("p_fraud"))).withColumn("day", F.to_date("ts"))
    return run_to_parquet(scored, sink, checkpoint, by="day", **trigger)


def run_pipeline(
    spark: SparkSession, folder: str, out: str, k: int = 10, skew: Skew = Skew()
) -> DataFrame:
    """All three steps; tables, runs and models go to ``out``, which all executors share."""
    prepared = prepare(spark, folder, out, skew)
    return score_best(spark, prepared, train(spark, prepared, out), k)
