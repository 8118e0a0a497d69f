"""Splitting rows into train and test, and weighting the classes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallyguard.functions import hash32, quoted

PARTS = 10_000


def split(
    df: DataFrame, test_share: float = 0.2, salt: str = "split:", key: str = "txn_id"
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows, told apart by a salted hash of the key (see ``with_part``)."""
    parts = with_part(df, test_share, salt, key)
    return (
        parts.where("part = 'train'").drop("part"),
        parts.where("part = 'test'").drop("part"),
    )


def with_part(
    df: DataFrame, test_share: float = 0.2, salt: str = "split:", key: str = "txn_id"
) -> DataFrame:
    """Add ``part``, train or test.

    The part depends on nothing but the key: it moves no data and does not change when
    rows are added, reordered or repartitioned.
    """
    slot = F.pmod(hash32(F.concat(F.lit(salt), F.col(quoted(key)).cast("string"))), F.lit(PARTS))
    is_test = slot >= round((1 - test_share) * PARTS)
    return df.withColumn("part", F.when(is_test, "test").otherwise("train"))


def class_weights(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Add ``class_weight``, which gives both classes the same total weight.

    Rows without a label of 0 or 1 get no weight. The table of class sizes therefore has
    two rows at most, whatever the data, and is broadcast.
    """
    column = F.col(quoted(label))
    both = Window.partitionBy()
    rows, classes = F.sum("_size").over(both), F.count("_size").over(both)
    sizes = (
        df.where(column.isin(0, 1))
        .groupBy(column.alias("_class"))
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_class", (rows / (classes * F.col("_size"))).alias("class_weight"))
    )
    return df.join(F.broadcast(sizes), column == F.col("_class"), "left").drop("_class")
