"""Column expressions shared by the operators."""

from tallyguard.functions.columns import hash32, quoted, sigmoid, unit_hash, usable_score

__all__ = ["hash32", "quoted", "sigmoid", "unit_hash", "usable_score"]
