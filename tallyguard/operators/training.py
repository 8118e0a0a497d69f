"""Feature stages and the two classifiers, on Spark MLlib."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import (
    Imputer,
    OneHotEncoder,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.sql import DataFrame, functions as F

from tallyguard.functions import quoted
from tallyguard.session import ensure_checkpoint_dir, materialize

# The index of categories is built on the driver, so a category column may have at most
# ``max_kinds`` values, counted exactly; this is the default of that parameter.
MAX_KINDS = 1000

# Parameters that the functions here set themselves.
FIXED = ("featuresCol", "labelCol", "weightCol")

NUMERIC = [
    "amount",
    "prev_amount",
    "gap_seconds",
    "n_1h",
    "sum_1h",
    "n_1d",
    "sum_1d",
    "n_7d",
    "sum_7d",
    "z_amount",
    "hour",
    "weekday",
    "is_night",
]


@dataclass
class Trained:
    """A fitted model and what it says about its features.

    ``importances`` belong to boosted trees. ``coefficients``, ``intercept`` and ``fill``
    belong to logistic regression, apply to unscaled features, and are what
    ``score_logistic`` takes; ``channel=click`` stands for one category.
    """

    model: PipelineModel
    importances: dict[str, float] = field(default_factory=dict)
    coefficients: dict[str, float] = field(default_factory=dict)
    intercept: float = 0.0
    fill: dict[str, float] = field(default_factory=dict)


def feature_stages(
    numeric: list[str], category: str | None = None, one_hot: bool = True, scale: bool = True
) -> list:
    """Stages that turn columns into the vector ``features``.

    Missing numbers get the column's mean; categories are indexed by frequency and one-hot
    encoded; all is scaled to unit deviation. The first stage copies the columns under
    plain names, because later stages do not take dots in names.
    """
    copies = [f"CAST({quoted(c)} AS DOUBLE) AS _num_{i}" for i, c in enumerate(numeric)]
    if category:
        copies.append(f"CAST({quoted(category)} AS STRING) AS _category")
    names = [f"_num_{i}" for i in range(len(numeric))]
    filled = [f"_filled_{i}" for i in range(len(numeric))]
    stages: list = [
        SQLTransformer(statement=f"SELECT *, {', '.join(copies)} FROM __THIS__"),
        Imputer(inputCols=names, outputCols=filled, strategy="mean"),
    ]
    parts = list(filled)
    if category:
        stages.append(
            StringIndexer(inputCol="_category", outputCol="_index", handleInvalid="keep")
        )
        if one_hot:
            stages.append(OneHotEncoder(inputCols=["_index"], outputCols=["_kinds"]))
        parts.append("_kinds" if one_hot else "_index")
    assembled = "_assembled" if scale else "features"
    stages.append(VectorAssembler(inputCols=parts, outputCol=assembled))
    if scale:
        stages.append(StandardScaler(inputCol=assembled, outputCol="features", withMean=False))
    return stages


def drop_helpers(df: DataFrame, *also: str) -> DataFrame:
    """Drop the columns that ``feature_stages`` added."""
    added = ("_num_", "_filled_", "_category", "_index", "_kinds", "_assembled")
    return df.drop(*[c for c in df.columns if c.startswith(added)], *also)


def _stage(model: PipelineModel, name: str):
    found = [stage for stage in model.stages if type(stage).__name__ == name]
    return found[0] if found else None


def _training_rows(
    df: DataFrame,
    numeric: list[str],
    category: str | None,
    label: str,
    weight: str | None,
    key: str | None,
    params: dict,
    max_kinds: int,
) -> tuple[DataFrame, int]:
    """Only the columns the fit needs; with ``key``, in an order that never changes. And
    how many values the category has.

    Sums of floats depend on the order of rows, so equal fits need equal partitions. The
    ordered rows are written, for the stages and the learner read them several times.
    """
    taken = [name for name in FIXED if name in params]
    if taken:
        raise ValueError(f"{', '.join(taken)} cannot be chosen; use label and weight")
    named = [category, key, params.get("validationIndicatorCol")]
    columns = list(dict.fromkeys([*numeric, *filter(None, named)]))
    rows = df.select(
        *[quoted(c) for c in columns],
        F.col(quoted(label)).cast("double").alias("_label"),
        (F.col(quoted(weight)) if weight else F.lit(1.0)).alias("_weight"),
    ).where("_label IS NOT NULL")
    if key:
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rows = rows.repartition(parts, quoted(key)).sortWithinPartitions(quoted(key))
        rows = materialize(rows, "training")
    kinds = 0
    if category:
        kinds = rows.select(quoted(category)).distinct().count()
        if kinds > max_kinds:
            raise ValueError(f"{category!r} has {kinds} values, more than {max_kinds}")
    return rows, kinds


def train_boosted(
    df: DataFrame,
    numeric: list[str],
    label: str = "is_fraud",
    category: str | None = None,
    weight: str | None = None,
    key: str | None = None,
    max_kinds: int = MAX_KINDS,
    **params,
) -> Trained:
    """Fit gradient-boosted trees. ``params`` are those of ``GBTClassifier``.

    ``df`` should be a written table, not a long computation: every stage reads it again.
    The learner keeps its own compact copy of the features, spilling to disk.
    """
    ensure_checkpoint_dir(df.sparkSession)
    rows, kinds = _training_rows(df, numeric, category, label, weight, key, params, max_kinds)
    # Trees need a bin for every category, and one for those unseen.
    bins = max(32, kinds + 2)
    learner = GBTClassifier(
        featuresCol="features",
        labelCol="_label",
        weightCol="_weight",
        **{"seed": 7, "checkpointInterval": 10, "maxBins": bins, **params},
    )
    stages = feature_stages(numeric, category, one_hot=False, scale=False)
    model = Pipeline(stages=[*stages, learner]).fit(rows)
    names = [*numeric, *([category] if category else [])]
    shares = model.stages[-1].featureImportances.toArray()
    return Trained(model, importances={n: float(v) for n, v in zip(names, shares)})


def train_logistic(
    df: DataFrame,
    numeric: list[str],
    label: str = "is_fraud",
    category: str | None = None,
    weight: str | None = None,
    key: str | None = None,
    max_kinds: int = MAX_KINDS,
    **params,
) -> Trained:
    """Fit logistic regression, on columns of any name.

    ``params`` are those of ``LogisticRegression``. As for trees, ``df`` should be a
    written table.
    """
    rows, _ = _training_rows(df, numeric, category, label, weight, key, params, max_kinds)
    learner = LogisticRegression(
        featuresCol="features",
        labelCol="_label",
        weightCol="_weight",
        standardization=False,
        **params,
    )
    model = Pipeline(stages=[*feature_stages(numeric, category), learner]).fit(rows)
    fitted, scaler = model.stages[-1], _stage(model, "StandardScalerModel")
    names = list(numeric)
    if category:
        names += [f"{category}={kind}" for kind in _stage(model, "StringIndexerModel").labels]
    pairs = zip(names, fitted.coefficients.toArray(), scaler.std.toArray())
    means = _stage(model, "ImputerModel").surrogateDF.first()
    return Trained(
        model,
        # The scaler leaves a feature without spread at zero.
        coefficients={n: float(c / s) if s else 0.0 for n, c, s in pairs},
        intercept=float(fitted.intercept),
        fill={n: float(means[f"_num_{i}"]) for i, n in enumerate(numeric)},
    )
