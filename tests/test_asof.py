from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.functions.dates import as_date
from tidemark.operators.asof import collapse, latest_per, latest_vintage
from tidemark.sources import warehouse as wh
from tidemark.sources.registry import natural_key

KEY = ["symbol", "trade_date"]
SCHEMA = "symbol string, trade_date string, close double, knowledge_date string, _vintage_id string"


def table(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumn("trade_date", F.to_date("trade_date")).withColumn("knowledge_date", F.to_date("knowledge_date"))


def closes(df):
    return sorted((r.symbol, r.close) for r in df.collect())


def test_same_day_rerun_keeps_the_later_write(spark):
    t = table(spark, [("R", "2026-08-21", 1400.0, "2026-08-22", "20260822T090000_000001"), ("R", "2026-08-21", 1410.0, "2026-08-22", "20260822T170000_000002")])
    assert closes(collapse(t, KEY)) == [("R", 1410.0)]
    assert all(closes(collapse(t.repartition(4), KEY)) == [("R", 1410.0)] for _ in range(3))


def test_backfill_of_two_days_keeps_both(spark):
    t = table(spark, [("R", "2026-08-20", 1390.0, "2026-08-26", "a"), ("R", "2026-08-21", 1395.0, "2026-08-26", "a")])
    assert collapse(t, KEY).count() == 2


def test_revision_is_hidden_before_it_was_known(spark):
    t = table(spark, [("R", "2026-08-20", 1400.0, "2026-08-22", "a"), ("R", "2026-08-20", 1405.0, "2026-08-28", "b"), ("T", "2026-08-20", 9.0, "2026-08-28", "b")])
    assert closes(collapse(t, KEY, "2026-08-25")) == [("R", 1400.0)]
    assert closes(collapse(t, KEY)) == [("R", 1405.0), ("T", 9.0)]
    assert collapse(t, KEY, date(2026, 8, 21)).count() == 0


def test_filter_applies_after_the_collapse(spark):
    t = table(spark, [("R", "2026-08-20", 1400.0, "2026-08-22", "a"), ("R", "2026-08-20", 5.0, "2026-08-28", "b")])
    assert collapse(t, KEY, where="close > 1000").count() == 0


def test_backfill_does_not_displace_the_newer_observation(spark):
    df = spark.createDataFrame([("R", "2026-09-03", 1.11, "2026-09-03", "a"), ("R", "2026-06-30", 0.77, "2026-09-04", "b")],
                               "symbol string, as_of_date string, beta double, knowledge_date string, _vintage_id string")
    assert [r.beta for r in latest_per(df, ["symbol", "as_of_date"], ["symbol"]).collect()] == [1.11]
    with pytest.raises(ValueError):
        latest_per(df, ["symbol", "as_of_date"], ["beta"])


def test_latest_vintage_keeps_every_row_of_the_newest_scrape(spark):
    df = spark.createDataFrame([("u", 1, "d1", "a"), ("u", 2, "d2", "b"), ("u", 3, "d2", "c"), ("u", 3, "d2", "c"), (None, 9, "d1", "a")],
                               "doc string, v int, knowledge_date string, _vintage_id string")
    assert sorted(r.v for r in latest_vintage(df, ["doc"]).collect()) == [3, 3, 9]


def test_as_of_argument_is_validated():
    assert as_date("2026-08-31") == date(2026, 8, 31)
    for bad in ("31-08-2026", "soon", 5, datetime(2026, 8, 31)):
        with pytest.raises(ValueError):
            as_date(bad)


def test_undeclared_view_is_refused():
    with pytest.raises(KeyError, match="zzz_unknown"):
        natural_key("zzz_unknown")
    assert natural_key("noaa_oni") == ["season", "year"]


def test_write_read_and_views(spark, tmp_path):
    root = str(tmp_path)
    base = spark.createDataFrame([("R", "2026-08-20", 1400.0)], "symbol string, trade_date string, close double")
    wh.write_table(base, root, "zzz", "px-daily", datetime(2026, 8, 22, 9, tzinfo=timezone.utc))
    wh.write_table(base.withColumn("volume", F.lit(5)).withColumn("close", F.lit(1405.0)), root, "zzz", "px-daily", datetime(2026, 8, 28, 9, tzinfo=timezone.utc))
    assert base.columns == ["symbol", "trade_date", "close"]
    t = wh.read_table(spark, root, "zzz", "px-daily")
    assert {(r.close, r.volume) for r in t.collect()} == {(1400.0, None), (1405.0, 5)}
    assert [r.close for r in collapse(t, KEY, "2026-08-25").collect()] == [1400.0]
    plan = collapse(t, KEY, "2026-08-25")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(knowledge_date" in plan
    assert wh.register_views(spark, root) == ["zzz_px_daily"]
    assert wh.read_only_sql(spark, "SELECT count(*) AS n FROM zzz_px_daily").first().n == 2
    row = wh.registered(spark).where("view = 'zzz_px_daily'").first()
    assert row.point_in_time is False and row.natural_key is None
    with pytest.raises(ValueError):
        wh.read_only_sql(spark, "DROP TABLE zzz_px_daily")
    for action in ("TRUNCATE TABLE zzz_px_daily", "SET spark.sql.ansi.enabled = false", "REFRESH TABLE zzz_px_daily", "CACHE TABLE zzz_px_daily", "CLEAR CACHE",
                   "MERGE INTO t USING s ON t.a = s.a WHEN MATCHED THEN DELETE", "INSERT INTO t VALUES (1)", "WITH s AS (SELECT 1) INSERT INTO t SELECT * FROM s",
                   "FROM zzz_px_daily INSERT INTO t SELECT *", "CREATE VIEW v AS SELECT 1", "ADD JAR 'x.jar'", "USE other", "UPDATE t SET a = 1", "DELETE FROM t",
                   "SELECT TRANSFORM (a) USING 'cat' FROM t", "WITH x AS (SELECT TRANSFORM (a) USING 'cat' FROM t) SELECT * FROM x"):
        with pytest.raises(ValueError, match="read-only"):
            wh.read_only_sql(spark, action)
    assert wh.read_only_sql(spark, "SELECT ' drop table; insert ' AS x, 1 AS update_count").first().x == " drop table; insert "
    assert wh.read_only_sql(spark, "WITH x AS (SELECT symbol FROM zzz_px_daily) SELECT * FROM x", 1).count() == 1
    assert wh.read_only_sql(spark, "SHOW VIEWS").count() >= 1


def test_declared_schema_fills_missing_columns(spark, tmp_path):
    from pyspark.sql import types as T

    wh.write_table(spark.createDataFrame([(1,)], "a int"), str(tmp_path), "s", "d")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    row = wh.read_table(spark, str(tmp_path), "s", "d", schema).first()
    assert row.a == 1 and row.b is None and row._vintage_id


def test_hot_key_is_cut_before_the_shuffle(spark):
    t = table(spark, [("HOT", "2026-08-20", float(i), "2026-08-22", f"{i:06d}") for i in range(3000)] + [("B", "2026-08-20", 1.0, "2026-08-22", "1")])
    out = collapse(t, KEY)
    assert closes(out) == [("B", 1.0), ("HOT", 2999.0)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
