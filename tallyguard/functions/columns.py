"""Small column expressions; all of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def quoted(name: str) -> str:
    """``name`` as one back-quoted identifier, whatever its script, spaces or dots."""
    return "`" + name.replace("`", "``") + "`"


def usable_score(name: str = "p_fraud") -> Column:
    """True for scores that are numbers; null, NaN and infinity are no scores. Never null."""
    return F.coalesce(F.abs(F.col(quoted(name))) < float("inf"), F.lit(False))


def hash32(text: Column) -> Column:
    """The first 32 bits of the MD5 of ``text`` as a bigint; other SQL engines agree on it."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def unit_hash(text: Column) -> Column:
    """``hash32`` scaled to [0, 1)."""
    return hash32(text) / F.lit(4294967296.0)


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
