"""Small helpers of the Spark jobs in this package."""

from __future__ import annotations

import os
import tempfile
import zipfile

import tallyguard
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyguard.functions import quoted
from tallyguard.session import materialize

__all__ = ["materialize", "read", "tidy", "renamed_apart", "batched", "numbered", "ship_code", "spread", "without"]

# Rows of an Arrow batch that carry texts: with texts of 4 kB that is 2 MB.
TEXT_ROWS = 500


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def ship_code(spark: SparkSession) -> None:
    """Send this library to the executors, whose Python may not have it installed."""
    context = spark.sparkContext
    if getattr(context, "_tallyguard_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(tallyguard.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="code-"), "tallyguard.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(top)))
    context.addPyFile(archive)
    context._tallyguard_shipped = True


def batched(spark: SparkSession, rows: int = TEXT_ROWS) -> None:
    """Prepare the session for Python tasks: the code they need, and bounded Arrow batches."""
    ship_code(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def tidy(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, cast to their types; extra columns of any name fall away."""
    return df.select(*[F.col(f"`{name}`").cast(kind).alias(name) for name, kind in columns.items()])


def renamed_apart(df: DataFrame, taken: list[str]) -> str:
    """A column name that neither the frame nor the list has."""
    name = "_n"
    while name.lower() in {c.lower() for c in [*df.columns, *taken]}:
        name += "_"
    return name


def spread(key: Column, parts: int) -> Column:
    """A number from 0 to parts - 1 that depends on the key alone."""
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


# Ids up to this number, 16 MB as a hashed relation, go to every executor.
FEW_IDS = 1_000_000


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without the rows whose ``doc_id`` is among ``ids``; rows without one stay.

    A counted, small set of ids is broadcast, so that no text moves. A larger one is joined
    by a shuffle.
    """
    ids = materialize(ids.select("doc_id").where("doc_id IS NOT NULL").distinct(), "ids")
    small = ids.count() <= FEW_IDS
    return docs.join(F.broadcast(ids) if small else ids, "doc_id", "left_anti").select(*map(quoted, docs.columns))


def numbered(df: DataFrame, *order: str, name: str = "no") -> DataFrame:
    """Number all rows from 0 in the given order, without bringing them into one task.

    The rows are cut by range and sorted within their parts, so ``order`` should tell rows
    apart: equal ones land in one part, in any order. Only a count per part is summed up.
    """
    sorted_ = df.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)
    parts = materialize(sorted_.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    parts = parts.withColumns({"_part": F.shiftright("_at", 33), "_at": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))})
    counts = parts.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("_part", before.alias("_before"))  # one row per part
    return parts.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_before") + F.col("_at")).drop("_part", "_at", "_before")
