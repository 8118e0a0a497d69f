"""Where transactions come from and where tables go."""

from tallyguard.sources.synthetic import synth_columns, synth_transactions
from tallyguard.sources.tables import canonical, load_transactions, parse_props, write_table

__all__ = [
    "canonical",
    "load_transactions",
    "parse_props",
    "synth_columns",
    "synth_transactions",
    "write_table",
]
