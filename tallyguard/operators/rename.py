"""Canonical and Korean column names, in both directions."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyguard.schema import KOREAN


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename columns all at once; refuse unknown columns and names that would collide.

    Names are taken literally, so spaces and dots need no quoting.
    """
    unknown = [name for name in mapping if name not in df.columns]
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    renamed = [mapping.get(name, name) for name in df.columns]
    twice = sorted({name for name in renamed if renamed.count(name) > 1})
    if twice:
        raise ValueError(f"names used twice: {twice}")
    return df.toDF(*renamed)


def korean_transactions(df: DataFrame) -> DataFrame:
    """Give the canonical columns that ``df`` has their Korean names."""
    return rename_columns(df, {k: v for k, v in KOREAN.items() if k in df.columns})


def canonical_transactions(df: DataFrame) -> DataFrame:
    """Turn Korean names back into canonical ones."""
    return rename_columns(df, {v: k for k, v in KOREAN.items() if v in df.columns})
