from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, rows
from tallyguard.operators.quality import clean_transactions, quality_report
from tallyguard.operators.rename import (
    canonical_transactions,
    korean_transactions,
    rename_columns,
)
from tallyguard.operators.split import class_weights, split, with_part
from tallyguard.schema import EVENTS, TRANSACTIONS, SchemaMismatch, check_schema
from tallyguard.sources import (
    load_transactions,
    parse_props,
    synth_transactions,
    write_table,
)

AT = datetime(2024, 1, 1, 12, tzinfo=timezone.utc)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_load_refuses_another_table(spark):
    with pytest.raises(SchemaMismatch, match="event_id: missing"):
        load_transactions(spark, SMALL, "orders")


def test_load_refuses_another_type(spark):
    wrong = spark.sql("SELECT 1 AS event_id").schema
    with pytest.raises(SchemaMismatch, match="event_id: int, not bigint"):
        check_schema(wrong, EVENTS)


def test_load_refuses_another_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Seoul")
    try:
        with pytest.raises(ValueError, match="UTC"):
            load_transactions(spark, SMALL)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_filters_and_columns_reach_the_scan(small):
    text = plan(small.where("ts >= '2024-01-20' AND amount > 3").select("txn_id"))
    assert "GreaterThanOrEqual(ts," in text and "GreaterThan(value,3.0)" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp,value:double>" in text


def test_cleaning_filter_reaches_the_scan(small):
    assert "GreaterThan(value,0.0)" in plan(clean_transactions(small))


def test_duplicates_are_reduced_before_the_shuffle(small):
    text = plan(clean_transactions(small))
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange") == 1


def test_bad_transactions(spark):
    nan, inf = float("nan"), float("inf")
    bad = [
        (None, 1, AT, 5.0, "card", 1),
        (1, None, AT, 5.0, "card", 1),
        (2, 1, None, 5.0, "card", 1),
        (3, 1, AT, None, "card", 1),
        (4, 1, AT, nan, "card", 1),
        (5, 1, AT, inf, "card", 1),
        (6, 1, AT, -2.0, "card", 1),
        (7, 1, AT, 0.0, "card", 1),
        (8, 1, AT, 5.0, None, None),
        (9, 1, AT, 5.0, "card", 1),
        (9, 1, AT + timedelta(hours=1), 6.0, "card", 1),
        (9, 1, AT + timedelta(hours=2), -1.0, "card", 1),
    ]
    cleaned = rows(clean_transactions(spark.createDataFrame(bad, TRANSACTIONS)))
    assert [(r["txn_id"], r["amount"], r["channel"], r["device_k"]) for r in cleaned] == [
        (8, 5.0, "unknown", -1),
        (9, 6.0, "card", 1),
    ]


def test_parse_props(spark):
    texts = ['{"k": 7}', '{"k": "x"}', "{k", None, '{"other": 1}', '{"k": 99999999999}']
    df = spark.createDataFrame([(t,) for t in texts], "props string")
    assert [r.device_k for r in parse_props(df).collect()] == [7, None, None, None, None, None]


def test_parse_props_from_a_named_column(spark):
    df = spark.createDataFrame([('{"a": {"b": 2.5}}',)], "`속성.값` string")
    assert parse_props(df, {"b": ("$.a.b", "double")}, "속성.값").first().b == 2.5


def test_quality_report(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (3, "b")], "`값.수` int, name string")
    exact = rows(quality_report(df), "column")
    assert exact[0] == {"column": "name", "rows": 3, "nulls": 1, "distinct": 2, "min": "a", "max": "b"}
    assert exact[1]["distinct"] == 2
    assert rows(quality_report(df, exact=False), "column")[1]["approx_distinct"] == 2
    empty = rows(quality_report(df.where("false")), "column")
    assert empty[0]["rows"] == 0 and empty[0]["min"] is None


def test_approximate_report_moves_no_values(small):
    text = plan(quality_report(small, exact=False))
    assert "Expand" not in text and text.count("Exchange SinglePartition") == 1


def test_approximate_report_is_near(middle):
    exact = rows(quality_report(middle), "column")
    near = rows(quality_report(middle, exact=False), "column")
    for a, b in zip(exact, near):
        assert abs(a["distinct"] - b["approx_distinct"]) <= 0.15 * a["distinct"]


def test_rename(small):
    korean = korean_transactions(small)
    assert korean.columns == ["거래번호", "계좌번호", "거래일시", "거래금액", "거래유형", "device_k"]
    assert rows(canonical_transactions(korean)) == rows(small)
    odd = rename_columns(small, {"amount": "거래 금액", "ts": "거래.일시"})
    assert odd.select("`거래 금액`", "`거래.일시`").count() == small.count()
    swapped = rename_columns(small, {"amount": "ts", "ts": "amount"})
    assert dict(swapped.dtypes)["amount"] == "timestamp"


def test_rename_refuses(small):
    with pytest.raises(ValueError, match="no such columns"):
        rename_columns(small, {"nothing": "x"})
    with pytest.raises(ValueError, match="used twice"):
        rename_columns(small, {"amount": "ts"})


def test_write_by_day(spark, small, tmp_path):
    table = write_table(small, str(tmp_path / "t"))
    back = table.drop("day")
    assert rows(back.select(small.columns)) == rows(small)
    one = table.where("day = date'2024-01-05'")
    assert "PartitionFilters: [isnotnull(day" in plan(one)
    assert one.count() == small.where("to_date(ts) = '2024-01-05'").count()
    with pytest.raises(Exception, match="already exists"):
        write_table(small, str(tmp_path / "t"))
    files = len(list((tmp_path / "t").glob("day=*/*.parquet")))
    assert files == small.select(F.to_date("ts")).distinct().count()


def test_write_korean_names(spark, small, tmp_path):
    table = write_table(korean_transactions(small), str(tmp_path / "t"), ts="거래일시")
    assert rows(canonical_transactions(table.drop("day"))) == rows(small)


def test_synthetic_rows_depend_on_seed_and_id_alone(spark):
    once = synth_transactions(spark, 1000, 20, seed=3)
    again = synth_transactions(spark, 3000, 20, seed=3).repartition(7).where("txn_id < 1000")
    assert rows(once) == rows(again)
    assert rows(once) != rows(synth_transactions(spark, 1000, 20, seed=4))
    assert once.agg(F.max("account_id")).first()[0] <= 20
    assert 0 < once.where("is_fraud = 1").count() < 1000
    hot = synth_transactions(spark, 3000, 20, seed=3, hot_share=0.33)
    assert 800 < hot.where("account_id = 0").count() < 1200


def test_split_is_stable(middle):
    train, test = split(middle)
    assert train.count() + test.count() == middle.count()
    assert 0.18 < test.count() / middle.count() < 0.22
    shuffled = split(middle.repartition(13))[1]
    assert rows(shuffled.select("txn_id")) == rows(test.select("txn_id"))
    assert "Exchange" not in plan(with_part(middle))
    other = split(middle, salt="other:")[1]
    assert rows(other.select("txn_id")) != rows(test.select("txn_id"))


def test_class_weights(spark):
    df = spark.createDataFrame([(i, 1 if i < 2 else 0) for i in range(10)] + [(10, None)], "id long, is_fraud int")
    weights = {r["id"]: r["class_weight"] for r in rows(class_weights(df), "id")}
    assert weights[0] == pytest.approx(2.5) and weights[5] == pytest.approx(0.625)
    assert weights[10] is None
    single = class_weights(df.where("is_fraud = 1")).first()
    assert single.class_weight == 1.0
