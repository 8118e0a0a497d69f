"""The first step of the job, period by period: a new period reads its own rows and a state.

The state at the end of a period holds, per account, what later transactions can still see:

* ``recent``: the rows of the longest trailing span before the end, and the account's latest
  row, however old it is;
* ``older``: count, mean and squared deviations of the amounts of all other rows.

Features of a new period are those of the recent and the new rows together, by the same windows,
exchange and hot-account split as in a full run; only the history is then merged with the
moments of the older rows. So a period costs its own rows and one span of rows before, whatever
the age of the table, and gives what a full run gives.

States lie in a folder for each period's end. A period can be run again: it reads the state of
its start and overwrites its own days and its own state.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tallyguard.operators.history import LARGEST, NO_SPREAD, SPANS, account_features, plant_fraud
from tallyguard.operators.hot import Skew
from tallyguard.operators.quality import clean_transactions
from tallyguard.session import materialize
from tallyguard.sources.tables import load_transactions, write_table

_OLDER = "account_id long, n long, mean double, m2 double"


def state_folder(out: str, end: datetime) -> str:
    """Where the state of all transactions before ``end`` lies."""
    return f"{out}/state/{end.astimezone(timezone.utc):%Y%m%dT%H%M%SZ}"


def empty_moments(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], _OLDER)


def read_state(spark: SparkSession, path: str, columns: T.StructType) -> tuple[DataFrame, DataFrame]:
    """The ``recent`` rows, which have the given columns, and the moments of the ``older`` ones."""
    return spark.read.schema(columns).parquet(f"{path}/recent"), spark.read.schema(_OLDER).parquet(f"{path}/older")


def _merged(n: Column, mean: Column, m2: Column, more_n: Column, more_mean: Column, more_m2: Column) -> tuple[Column, Column, Column]:
    """Moments of two sets of rows together; means of empty sets are null."""
    total = n + more_n
    low, high = F.coalesce(mean, more_mean), F.coalesce(more_mean, mean)
    off = high - low
    return total, F.when(total > 0, low + off * more_n / total), m2 + more_m2 + F.coalesce(off * off * n * more_n / total, F.lit(0.0))


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def with_history(featured: DataFrame, older: DataFrame) -> DataFrame:
    """History columns of rows that have seen recent rows only, with the older ones merged in."""
    named = older.select(F.col("account_id").alias("_account"), F.col("n").alias("_n"), F.col("mean").alias("_mean"), F.col("m2").alias("_m2"))
    joined = featured.join(named, F.col("account_id").eqNullSafe(F.col("_account")), "left")
    seen = F.when(F.col("hist_n") > 1, F.col("hist_sd") * F.col("hist_sd") * (F.col("hist_n") - 1)).otherwise(0.0)
    n, mean, m2 = _merged(_zero("_n"), F.col("_mean"), F.coalesce("_m2", F.lit(0.0)), F.col("hist_n"), F.col("hist_mean"), seen)
    amount = F.when(F.abs(F.col("amount")) < LARGEST, F.col("amount"))
    merged = joined.withColumns({"_all": n, "_avg": mean, "_sd": F.when(n > 1, F.sqrt(F.greatest(m2, F.lit(0.0)) / (n - 1)))})
    scored = F.when(F.col("_sd") > NO_SPREAD, (amount - F.col("_avg")) / F.col("_sd"))
    return merged.withColumns({"hist_n": F.col("_all"), "hist_mean": F.col("_avg"), "hist_sd": F.col("_sd"), "z_amount": scored}).select(featured.columns)


def write_state(rows: DataFrame, older: DataFrame, end: datetime, spans: dict[str, int], path: str) -> None:
    """The state at ``end``; ``rows`` are the recent rows before it and the period's own."""
    edge = F.lit(end - timedelta(seconds=max(spans.values())))
    last = Window.partitionBy("account_id").orderBy(F.desc("ts"), F.desc("txn_id"))
    # One row per account is kept by the partial ranking, so a busy account does not gather.
    newest = rows.withColumn("_rank", F.row_number().over(last)).where("_rank = 1").drop("_rank").where(F.col("ts") < edge)
    recent = rows.where(F.col("ts") >= edge)
    recent.unionByName(newest).write.mode("overwrite").parquet(f"{path}/recent")

    amount = F.when(F.abs(F.col("amount")) < LARGEST, F.col("amount"))
    gone = rows.where(F.col("ts") < edge).join(
        newest.select(F.col("account_id").alias("_account"), F.col("txn_id").alias("_txn")),
        F.col("account_id").eqNullSafe(F.col("_account")) & (F.col("txn_id") == F.col("_txn")), "left_anti",
    )
    left = gone.groupBy("account_id").agg(F.count(amount).alias("_n"), F.avg(amount).alias("_mean"), F.coalesce(F.var_pop(amount) * F.count(amount), F.lit(0.0)).alias("_m2"))
    both = older.join(left.withColumnRenamed("account_id", "_account"), F.col("account_id").eqNullSafe(F.col("_account")), "full")
    n, mean, m2 = _merged(_zero("n"), F.col("mean"), F.coalesce("m2", F.lit(0.0)), _zero("_n"), F.col("_mean"), F.coalesce("_m2", F.lit(0.0)))
    account = F.coalesce("account_id", "_account")
    both.select(account.alias("account_id"), n.alias("n"), mean.alias("mean"), m2.alias("m2")).write.mode("overwrite").parquet(f"{path}/older")


def prepare_period(
    spark: SparkSession,
    folder: str,
    out: str,
    start: datetime | None,
    end: datetime,
    skew: Skew = Skew(),
    spans: dict[str, int] | None = None,
) -> DataFrame:
    """Prepare the transactions from ``start`` up to ``end`` and write their days and the state at ``end``.

    ``start`` is where the last period ended; its state is read. ``None`` starts a new table,
    with all transactions before ``end``. Both should be midnights in UTC, since days are
    written as a whole. Returns the period's rows as ``prepare`` returns those of a full run.
    """
    spans = spans or SPANS
    rows = load_transactions(spark, folder).where(F.col("ts") < F.lit(end))
    if start is not None:
        rows = rows.where(F.col("ts") >= F.lit(start))
    new = clean_transactions(rows)
    if start is None:
        recent, older = new.where("false"), empty_moments(spark)
    else:
        recent, older = read_state(spark, state_folder(out, start), new.schema)
    # The new rows are read twice: for their features and for the state.
    both = materialize(recent.withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True))), "period")
    featured = account_features(both, spans, skew).where("_new").drop("_new")
    labelled = plant_fraud(with_history(featured, older))
    written = write_table(labelled, f"{out}/prepared", mode="overwrite")
    write_state(both.drop("_new"), older, end, spans, state_folder(out, end))
    period = written.where(F.col("ts") < F.lit(end))
    return period if start is None else period.where(F.col("ts") >= F.lit(start))
