"""The canonical transaction columns, their Korean names, and schema checks."""

from __future__ import annotations

from pyspark.sql import types as T

# The table on disk. Its timestamps carry no zone and are read as UTC instants.
EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

TRANSACTIONS = T.StructType(
    [
        T.StructField("txn_id", T.LongType()),
        T.StructField("account_id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("channel", T.StringType()),
        T.StructField("device_k", T.IntegerType()),
    ]
)

# Korean column names.
KOREAN = {
    "txn_id": "거래번호",
    "account_id": "계좌번호",
    "ts": "거래일시",
    "amount": "거래금액",
    "channel": "거래유형",
    "prev_amount": "직전금액",
    "gap_seconds": "경과초",
    "is_fraud": "사기여부",
}


class SchemaMismatch(ValueError):
    """A table does not have the columns or types it must have."""


def check_schema(found: T.StructType, wanted: T.StructType) -> None:
    """Refuse a missing column or another type; a zone-less timestamp passes for a timestamp."""
    types = {field.name: field.dataType for field in found}
    problems = []
    for field in wanted:
        actual = types.get(field.name)
        zoneless = isinstance(field.dataType, T.TimestampType) and isinstance(
            actual, T.TimestampNTZType
        )
        if actual is None:
            problems.append(f"{field.name}: missing")
        elif actual != field.dataType and not zoneless:
            problems.append(
                f"{field.name}: {actual.simpleString()}, not {field.dataType.simpleString()}"
            )
    if problems:
        raise SchemaMismatch("; ".join(problems))
