"""Reports out of sketches against reports out of rows."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tallyguard.operators.quality import quality_report
from tallyguard.operators.sketches import day_sketches, report_of_days, write_sketches

AT = datetime(2024, 1, 1, tzinfo=timezone.utc)
SCHEMA = "txn_id long, ts timestamp, amount double, `카드.종류` string, n int"
EXACT = ("column", "rows", "nulls", "min", "max")


def days_of(df, first=None, last=None):
    day = F.to_date("ts")
    return df.where(F.lit(True) if first is None else day >= F.lit(first)).where(F.lit(True) if last is None else day <= F.lit(last))


@pytest.fixture(scope="module")
def stored(spark, middle, tmp_path_factory):
    return write_sketches(middle, str(tmp_path_factory.mktemp("sketches") / "days"))


@pytest.mark.parametrize("first,last", [(None, None), (3, 9), (12, 12), (400, 500)])
def test_any_range_of_days(middle, stored, first, last):
    start = middle.agg(F.to_date(F.min("ts"))).first()[0]
    span = [None if d is None else start + timedelta(days=d) for d in (first, last)]
    found = {r["column"]: r for r in rows(report_of_days(stored, middle.schema, *span), "column")}
    part = days_of(middle, *span)
    for line in rows(quality_report(part), "column"):
        mine = found[line["column"]]
        assert [mine[c] for c in EXACT] == [line[c] for c in EXACT]
        assert abs(mine["approx_distinct"] - line["distinct"]) <= max(1, 0.06 * line["distinct"])
    n = part.count()
    for q in (25, 50, 75, 99):
        value = found["amount"][f"q_{q}"]
        if n:
            below, upto = part.where(F.col("amount") < value).count() / n, part.where(F.col("amount") <= value).count() / n
            assert below - 0.03 <= q / 100 <= upto + 0.03
        else:
            assert value is None
    assert found["channel"]["q_50"] is None


def test_a_report_reads_sketches_only_and_days_are_replaced(spark, middle, tmp_path):
    path = str(tmp_path / "days")
    half = middle.where("txn_id % 2 = 0")
    write_sketches(half, path)
    first = middle.agg(F.to_date(F.min("ts"))).first()[0]
    stored = write_sketches(days_of(middle, first, first), path)
    whole = days_of(middle, first, first).count() + half.where(F.to_date("ts") > F.lit(first)).count()
    report = report_of_days(stored, middle.schema)
    assert {r.rows for r in report.collect()} == {whole}
    plan = report_of_days(stored, middle.schema, first, first)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "events.parquet" not in plan


def test_odd_values(spark):
    data = [(1, AT, 1.0, "a", None), (2, AT, float("nan"), None, None), (2, AT, None, "a", 3), (None, AT + timedelta(days=1), float("inf"), "", 3), (4, None, 2.0, "b", 3)]
    df = spark.createDataFrame(data, SCHEMA)
    sketched = day_sketches(df)
    assert sketched.count() == 3
    found = {r["column"]: r for r in rows(report_of_days(sketched, df.schema), "column")}
    assert found["amount"]["rows"] == 5 and found["amount"]["nulls"] == 1 and found["amount"]["q_50"] in (1.0, 2.0)
    assert found["카드.종류"]["approx_distinct"] == 3 and found["n"]["nulls"] == 2 and found["n"]["approx_distinct"] == 1
    nothing = rows(report_of_days(day_sketches(df.limit(0)), df.schema), "column")
    assert [(r["rows"], r["approx_distinct"], r["min"]) for r in nothing] == [(0, 0, None)] * 5
