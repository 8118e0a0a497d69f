"""Periods, one after the other, against a full run."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, assert_close, rows
from tallyguard.operators.hot import Skew
from tallyguard.operators.history import SPANS
from tallyguard.plans.incremental import prepare_period, state_folder
from tallyguard.plans.job import prepare


@pytest.fixture(scope="module")
def full(spark, tmp_path_factory):
    return rows(prepare(spark, SMALL, str(tmp_path_factory.mktemp("full"))))


def ends(small, *days):
    low, high = small.agg(F.to_date(F.min("ts")), F.to_date(F.max("ts"))).first()
    first = datetime(low.year, low.month, low.day, tzinfo=timezone.utc)
    return [first + timedelta(days=d) for d in days], datetime(high.year, high.month, high.day, tzinfo=timezone.utc) + timedelta(days=1)


@pytest.mark.parametrize("skew", [Skew(), Skew(hot_rows=20, chunk_rows=50)])
def test_periods_equal_a_full_run(spark, small, full, tmp_path, skew):
    """A short period, an empty one, a long one; and one that is run twice."""
    marks, last = ends(small, 9, 10, 10, 12)
    out, start = str(tmp_path), None
    for end in [marks[0], marks[1], marks[3], last]:
        prepare_period(spark, SMALL, out, start, end, skew)
        start = end
    again = prepare_period(spark, SMALL, out, marks[3], last, skew)
    assert 0 < again.count() < len(full)
    assert_close(rows(spark.read.parquet(f"{out}/prepared").select(list(full[0]))), full)


def test_a_period_reads_its_state_and_its_own_rows(spark, small, tmp_path):
    marks, last = ends(small, 15, 16)
    prepare_period(spark, SMALL, str(tmp_path), None, marks[0])
    recent = spark.read.parquet(f"{state_folder(str(tmp_path), marks[0])}/recent")
    older = spark.read.parquet(f"{state_folder(str(tmp_path), marks[0])}/older")
    before = small.where(F.col("ts") < F.lit(marks[0]))
    edge = marks[0] - timedelta(seconds=max(SPANS.values()))
    accounts = before.select("account_id").distinct().count()
    assert before.where(F.col("ts") >= F.lit(edge)).count() <= recent.count() <= before.where(F.col("ts") >= F.lit(edge)).count() + accounts
    assert recent.count() + older.agg(F.sum("n")).first()[0] == before.count()
    made = prepare_period(spark, SMALL, str(tmp_path), marks[0], marks[1])
    assert made.count() == small.where((F.col("ts") >= F.lit(marks[0])) & (F.col("ts") < F.lit(marks[1]))).count()
