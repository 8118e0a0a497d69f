"""Reading transactions from Parquet and writing tables by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyguard.functions import quoted
from tallyguard.schema import EVENTS, check_schema
from tallyguard.session import require_utc

PROPS = {"device_k": ("$.k", "int")}


def parse_props(
    df: DataFrame, fields: dict[str, tuple[str, str]] | None = None, source: str = "props"
) -> DataFrame:
    """Add typed columns from JSON text: ``{column: (JSON path, type)}``.

    Bad JSON, a missing path and a value of another type all give null.
    """
    text = F.col(quoted(source))
    return df.withColumns(
        {
            name: F.get_json_object(text, path).try_cast(kind)
            for name, (path, kind) in (fields or PROPS).items()
        }
    )


def canonical(events: DataFrame) -> DataFrame:
    """Project the event table, batch or stream, to the canonical transaction columns."""
    return parse_props(events).select(
        F.col("event_id").alias("txn_id"),
        F.col("user_id").alias("account_id"),
        "ts",
        F.col("value").alias("amount"),
        F.col("event_type").alias("channel"),
        "device_k",
    )


def load_transactions(
    spark: SparkSession, folder: str, table: str = "events", names: dict[str, str] | None = None
) -> DataFrame:
    """Read ``folder/table.parquet`` as transactions, after checking its schema.

    ``names`` says under which names, in any script, the table keeps the columns of
    ``EVENTS``: ``{"event_id": "거래번호", ...}``. Columns not named keep theirs.

    The read schema names ``ts`` as a timestamp outright: a cast of the column would keep
    time filters from reaching the scan.
    """
    require_utc(spark)
    path = f"{folder.rstrip('/')}/{table}.parquet"
    unknown = set(names or {}) - set(EVENTS.names)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    own = {name: (names or {}).get(name, name) for name in EVENTS.names}
    expected = T.StructType([T.StructField(own[f.name], f.dataType, f.nullable) for f in EVENTS])
    check_schema(spark.read.parquet(path).schema, expected)
    table_ = spark.read.schema(expected).parquet(path)
    return canonical(table_.select([F.col(quoted(own[name])).alias(name) for name in own]))


def write_table(
    df: DataFrame, path: str, by: str = "day", ts: str = "ts", mode: str = "errorifexists"
) -> DataFrame:
    """Write ``df`` as Parquet partitioned by day and read it back.

    The rebalance step gathers each day's rows so that days do not end up as many tiny
    files, and adaptive execution splits a day that is too big for one task.
    """
    if by not in df.columns:
        df = df.withColumn(by, F.to_date(F.col(quoted(ts))))
    # An overwrite replaces only the days that are written.
    writer = df.hint("rebalance", quoted(by)).write.mode(mode).partitionBy(by)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    columns = [field for field in df.schema if field.name != by] + [df.schema[by]]
    schema = type(df.schema)(columns)
    return df.sparkSession.read.schema(schema).parquet(path)
