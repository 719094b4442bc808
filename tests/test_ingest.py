import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Row

from clickstats.operators.ingest import ingest_access_log, ingest_behavior
from conftest import lines_df


def test_behavior_good_lines(spark):
    df = lines_df(spark, ["42,1001,7,pv,1704067200", "1,2,3,buy,1704067201,extra,fields"])
    rows = ingest_behavior(df).rows.select("user_id", "item_id", "category_id", "behavior", "ts_sec",
                                           "event_ms").collect()
    assert rows == [Row(user_id=42, item_id=1001, category_id=7, behavior="pv", ts_sec=1704067200,
                        event_ms=1704067200000),
                    Row(user_id=1, item_id=2, category_id=3, behavior="buy", ts_sec=1704067201,
                        event_ms=1704067201000)]
    assert dict(ingest_behavior(df).rows.dtypes)["event_time"] == "timestamp"


def test_behavior_rejects_with_reasons(spark):
    bad = {
        "1,2,3,pv": "timestamp missing",
        "7x,2,3,pv,5": "user_id not an integer",
        "7, 7 ,3,pv,5": "item_id not an integer",
        "bad": "user_id not an integer",
        "1,2,99999999999,pv,5": "category_id not an integer",
        "1,2,3,pv,": "timestamp missing",          # trailing empty field dropped, as String.split does
        "1,2,3,,5": None,                          # inner empty behavior is a value
        "+1,-2,3,pv,5": None,
        "1,2\n,3,pv,5": "item_id not an integer",   # a newline inside a field is not whitespace to skip
        "": "user_id not an integer",
    }
    out = ingest_behavior(lines_df(spark, list(bad)), on_bad="reject")
    got = {r.value: r.reason for r in out.rejects.collect()}
    assert got == {k: v for k, v in bad.items() if v}
    assert sorted(r.user_id for r in out.rows.collect()) == [1, 1]


def test_behavior_fail_mode_raises(spark):
    df = lines_df(spark, ["1,2,3,pv,5", "1,2,3,pv"])
    with pytest.raises(PySparkException, match="malformed line"):
        ingest_behavior(df, on_bad="fail").rows.select("item_id").collect()


def test_access_log_parse_and_rejects(spark):
    good = "10.0.0.42 42 - 01/01/2024:00:00:07 +0000 GET /item/69"
    bad = {
        "10.0.0.1 1 - 31/02/2015:00:00:00 +0000 GET /a": "time not a date",
        "10.0.0.1 1 - 01/01/2024:00:00:07x +0000 GET /a": "time not a date",
        "10.0.0.1 1 - 1/01/2024:00:00:07 +0000 GET /a": "time not a date",
        "10.0.0.1 1 - 01/01/2024:00:00:07": "method missing",
        "10.0.0.1 1 - 01/01/2024:00:00:07 +0000 GET ": "url missing",
        "bad": "time missing",
    }
    out = ingest_access_log(lines_df(spark, [good, *bad]), on_bad="reject")
    rows = out.rows.select("ip", "user_id", "event_ms", "method", "url").collect()
    assert rows == [Row(ip="10.0.0.42", user_id="42", event_ms=1704067207000, method="GET", url="/item/69")]
    assert {r.value: r.reason for r in out.rejects.collect()} == bad


def test_access_log_time_zone_argument(spark):
    df = lines_df(spark, ["h u - 01/01/2024:00:00:00 +0800 GET /x"])
    utc = ingest_access_log(df).rows.first().event_ms
    shanghai = ingest_access_log(df, tz="Asia/Shanghai").rows.first().event_ms
    assert utc == 1704067200000 and utc - shanghai == 8 * 3600 * 1000


def test_carried_columns_pass_through(spark):
    df = lines_df(spark, ["1,2,3,pv,5", "bad"], batch_id=7)
    out = ingest_behavior(df, on_bad="reject")
    assert out.rows.first().batch_id == 7 and out.rejects.first().batch_id == 7


def test_fail_mode_not_skipped_by_a_later_filter(spark):
    from clickstats.plans.jobs import hot_items, is_page_view
    df = lines_df(spark, ["1,2,3,pv,5", "1,2,3"])   # second line lacks behavior and timestamp
    with pytest.raises(PySparkException, match="malformed line"):
        ingest_behavior(df, on_bad="fail").rows.where(is_page_view()).collect()
    with pytest.raises(PySparkException, match="malformed line"):
        hot_items(ingest_behavior(df, on_bad="fail").rows).collect()


def test_output_columns(spark):
    from clickstats.operators.ingest import ACCESS_LOG_COLUMNS, BEHAVIOR_COLUMNS
    assert ingest_behavior(lines_df(spark, ["1,2,3,pv,5"])).rows.columns == BEHAVIOR_COLUMNS
    assert ingest_access_log(lines_df(spark, ["a b - c d e f"])).rows.columns == ACCESS_LOG_COLUMNS
    assert ingest_access_log(lines_df(spark, ["x"]), on_bad="reject").rejects.columns == ["value", "reason"]
