"""Categories with any number of values as numbers: out-of-fold target encoding.

A row's value is the mean label of its category, drawn towards the mean of all rows by
``smooth`` rows' worth of it, and both means leave out the row's own fold. So no row's label
enters its own value, and a category that is nothing but a name for one row tells nothing.
Folds are dealt by a hash of the key and do not change between runs.

The counts stay a table that is joined, with a row for every category and fold at most; no index
of the categories is ever on the driver. They are sums over integers, so they do not depend on
the partitioning, and are combined before their shuffle. A category that holds a large part of
the rows is split by the adaptive join, as the counts beside it are a written table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tallyguard.functions import hash32, quoted
from tallyguard.session import materialize


@dataclass(frozen=True)
class Folds:
    """How categories are encoded."""

    folds: int = 5
    smooth: float = 20.0
    salt: str = "fold"


@dataclass(frozen=True)
class TargetEncoding:
    """What the categories of a whole table are worth: ``_kind, _worth``, and the value of any other."""

    table: DataFrame
    prior: float
    category: str

    def apply(self, df: DataFrame, name: str) -> DataFrame:
        """Add ``name`` to rows that training has not seen; unseen categories get the prior."""
        kind = F.col(quoted(self.category)).cast("string")
        joined = df.join(self.table, kind.eqNullSafe(F.col("_kind")), "left")
        return joined.withColumn(name, F.coalesce("_worth", F.lit(self.prior))).drop("_kind", "_worth")


def fold_of(key: str, folds: Folds) -> Column:
    return (hash32(F.concat_ws(":", F.lit(folds.salt), F.col(quoted(key)).cast("string"))) % folds.folds).cast("int")


def _worth(y: Column, n: Column, prior: Column, folds: Folds) -> Column:
    return (y + folds.smooth * prior) / (n + folds.smooth)


def encode_target(
    df: DataFrame, category: str, label: str, key: str, name: str = "encoded", folds: Folds = Folds()
) -> tuple[DataFrame, TargetEncoding]:
    """``df`` with the out-of-fold value of its category, and the encoding for other rows.

    Rows without a label get a value but count in none. Nulls are a category of their own.
    """
    kind = F.col(quoted(category)).cast("string")
    rows = df.withColumns({"_kind": kind, "_fold": fold_of(key, folds)})
    known = rows.where(F.col(quoted(label)).isNotNull())
    sums = known.groupBy("_kind", "_fold").agg(F.count("*").alias("_n"), F.sum(F.col(quoted(label)).cast("long")).alias("_y"))
    sums = materialize(sums, "folds")
    per_fold = {r["_fold"]: (r["n"], r["y"]) for r in sums.groupBy("_fold").agg(F.sum("_n").alias("n"), F.sum("_y").alias("y")).collect()}
    n, y = (sum(v[i] for v in per_fold.values()) for i in range(2))
    if not n:
        raise ValueError("no row has a label")

    def prior(fold: int) -> float:
        """The share of all other folds; of half, if there are none."""
        own_n, own_y = per_fold.get(fold, (0, 0))
        return (y - own_y) / (n - own_n) if n > own_n else 0.5

    priors = F.get(F.array(*[F.lit(prior(f)) for f in range(folds.folds)]), F.col("_fold"))
    whole = materialize(sums.groupBy("_kind").agg(F.sum("_n").alias("_all_n"), F.sum("_y").alias("_all_y")), "kinds")
    everything, own = whole.withColumnRenamed("_kind", "_k"), sums.withColumnsRenamed({"_kind": "_k", "_fold": "_f"})
    joined = rows.join(everything, F.col("_kind").eqNullSafe(F.col("_k")), "left").drop("_k")
    joined = joined.join(own, F.col("_kind").eqNullSafe(F.col("_k")) & (F.col("_fold") == F.col("_f")), "left")
    other = {c: F.coalesce(f"_all_{c}", F.lit(0)) - F.coalesce(f"_{c}", F.lit(0)) for c in ("n", "y")}
    encoded = joined.withColumn(name, _worth(other["y"], other["n"], priors, folds)).select(*[F.col(quoted(c)) for c in df.columns], quoted(name))
    share = y / n
    table = whole.select("_kind", _worth(F.col("_all_y"), F.col("_all_n"), F.lit(share), folds).alias("_worth"))
    return encoded, TargetEncoding(table, share, category)
