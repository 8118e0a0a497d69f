"""The online path: the same transactions, features and scores on streams."""

from tallyguard.streaming.account import account_stream
from tallyguard.streaming.alerts import alerts_to_table, read_alerts, read_changes
from tallyguard.streaming.features import KEYED_BATCH, prev_stream, rejected_rows, velocity_stream
from tallyguard.streaming.scoring import read_stream, run_to_parquet, score_stream

__all__ = [
    "KEYED_BATCH",
    "account_stream",
    "alerts_to_table",
    "prev_stream",
    "read_alerts",
    "read_changes",
    "read_stream",
    "rejected_rows",
    "run_to_parquet",
    "score_stream",
    "velocity_stream",
]
