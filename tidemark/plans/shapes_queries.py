"""Landed-file shapes. Each query writes the rows of a table in the format of a feed and
parses them back with the feed's parser; the SQL states the result from the table itself."""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tidemark.operators.facts import scaled_holdings
from tidemark.plans.bindings import events, table
from tidemark.plans.registry import query
from tidemark.sources import archive as ar
from tidemark.sources import cells as ce
from tidemark.sources import files as fi
from tidemark.sources import grids as gr
from tidemark.sources import markets as mk
from tidemark.sources import regulators as rg
from tidemark.sources import world as wo
from tidemark.session import shared_folder

S = lambda c: F.col(c).cast("string")


def with_extra(lines, *extra):
    """Lines with header or banner lines added, as each file carries them."""
    spark = lines.sparkSession
    return lines.unionByName(spark.createDataFrame([("f0", x) for x in extra], "path string, line string"))


# -- delimited text -------------------------------------------------------------------

@query("shape_price_file", "SELECT 'S' || l_suppkey AS \"SYMBOL\", l_extendedprice AS \"CLOSE_PRICE\", l_quantity AS \"TTL_QTY\", CAST(l_shipdate AS DATE) AS d FROM lineitem")
def shape_price_file(spark, sf):
    li = table(spark, sf, "lineitem").select(F.lit("f0").alias("path"), F.concat_ws(", ", F.concat(F.lit("S"), S("l_suppkey")), S("l_extendedprice"), S("l_quantity"),
                                                                                    F.date_format("l_shipdate", "dd-MMM-yyyy")).alias("line"))
    rows = mk.price_file(with_extra(li, "SYMBOL, CLOSE_PRICE, TTL_QTY, DATE1"), [" SYMBOL", " CLOSE_PRICE ", "TTL_QTY ", "DATE1"], ["CLOSE_PRICE", "TTL_QTY"], ["SYMBOL"])
    from tidemark.functions.dates import DAY_MON_YEAR, parse
    return rows.select("SYMBOL", "CLOSE_PRICE", "TTL_QTY", parse("DATE1", DAY_MON_YEAR).alias("d"))


@query("shape_bannered_csv", "SELECT c_name AS \"Client Type\", c_nationkey::VARCHAR AS \"Total Long Contracts\", DATE '2026-08-20' AS trade_date FROM customer")
def shape_bannered_csv(spark, sf):
    c = table(spark, sf, "customer").select(F.lit("f0").alias("path"), F.concat_ws(",", "c_name", S("c_nationkey")).alias("line"))
    lines = with_extra(c, "Participant wise open interest as on Aug 20 2026", "Client Type,Total Long Contracts      ")
    return fi.bannered_csv(lines, ["Client Type", "Total Long Contracts      "], "2026-08-20").drop("path")


@query("shape_filing_index", "SELECT c_custkey AS cik, c_name AS entity_idx, c_mktsegment AS form, DATE '2025-07-01' + CAST(c_nationkey AS INTEGER) AS filed, '0001-25-' || c_custkey AS accn FROM customer")
def shape_filing_index(spark, sf):
    c = table(spark, sf, "customer").select(F.lit("f0").alias("path"), F.concat_ws("|", S("c_custkey"), "c_name", "c_mktsegment", F.date_add(F.lit("2025-07-01").cast("date"), F.col("c_nationkey")).cast("string"),
                                                                                  F.concat(F.lit("edgar/data/1/0001-25-"), S("c_custkey"), F.lit(".txt"))).alias("line"))
    return rg.filing_index(with_extra(c, "Description: Master Index", "CIK|Company Name|Form Type|Date Filed|Filename", "-----"))


@query("shape_daily_events", """SELECT CAST(event_id AS VARCHAR) AS "GlobalEventID", CAST(ts AS DATE) AS event_date, CAST(ts AS DATE) + 1 AS ingested_date, CAST(user_id % 4 + 1 AS BIGINT) AS "QuadClass",
  ['verbal_cooperation', 'material_cooperation', 'verbal_conflict', 'material_conflict'][user_id % 4 + 1] AS quad_class_label, value AS "AvgTone" FROM events
  WHERE (event_type = 'click' OR user_id % 5 = 0) AND user_id % 8 >= 2""")
def shape_daily_events(spark, sf):
    e = events(spark, sf)
    val = {"GlobalEventID": S("event_id"), "SQLDATE": F.date_format("ts", "yyyyMMdd"), "DATEADDED": F.date_format(F.date_add(F.to_date("ts"), 1), "yyyyMMdd"),
           "Actor1CountryCode": F.when(F.col("event_type") == "click", "IRN").otherwise("FRA"), "ActionGeo_CountryCode": F.when(F.col("user_id") % 5 == 0, "IZ").otherwise("FR"),
           "EventRootCode": (F.col("user_id") % 8 + 12).cast("string"), "QuadClass": (F.col("user_id") % 4 + 1).cast("string"), "AvgTone": S("value"), "NumMentions": F.lit("x")}
    line = F.concat_ws("\t", *[val.get(c, F.lit("")) for c in wo.GDELT_COLUMNS])
    lines = with_extra(e.select(F.lit("f").alias("path"), line.alias("line")), "broken\tline")
    return wo.daily_events(lines, conflict_only=True).select("GlobalEventID", "event_date", "ingested_date", "QuadClass", "quad_class_label", "AvgTone")


@query("shape_ocean_index", """SELECT ['DJF','JFM','FMA','MAM','AMJ','MJJ','JJA','JAS','ASO','SON','OND','NDJ'][month(o_orderdate)] AS season, year(o_orderdate) AS year, round(avg(o_totalprice) / 10000 - 25, 2) AS anomaly_c,
  CAST(month(o_orderdate) AS INTEGER) AS centre_month, year(o_orderdate) || '-' || lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS period,
  CASE WHEN round(avg(o_totalprice) / 10000 - 25, 2) >= 0.5 THEN 'el_nino' WHEN round(avg(o_totalprice) / 10000 - 25, 2) <= -0.5 THEN 'la_nina' ELSE 'neutral' END AS phase FROM orders GROUP BY month(o_orderdate), year(o_orderdate)""")
def shape_ocean_index(spark, sf):
    o = table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m")).agg(F.round(F.avg("o_totalprice") / 10000 - 25, 2).alias("a"))
    name = F.element_at(F.array(*[F.lit(n) for n in wo.SEASON_CENTRE]), F.col("m"))
    lines = o.select(F.lit("f").alias("path"), F.concat_ws("   ", F.concat(F.lit(" "), name), S("y"), F.lit("26.50"), S("a")).alias("line"))
    return wo.ocean_index(with_extra(lines, " SEAS  YR   TOTAL   ANOM")).drop("sst_c").withColumn("year", F.col("year"))


@query("shape_fire_detections", "SELECT p_retailprice AS latitude, CASE WHEN p_size > 10 THEN CAST(p_size AS DOUBLE) END AS confidence, p_type AS satellite, 'box' AS area, 'viirs' AS source_sensor FROM part")
def shape_fire_detections(spark, sf):
    rows = table(spark, sf, "part").select(S("p_retailprice").alias("latitude"), F.when(F.col("p_size") > 10, S("p_size")).otherwise("n").alias("confidence"), F.col("p_type").alias("satellite"))
    return wo.fire_detections(rows, "box", "viirs")


@query("shape_bullion_rates", """SELECT CAST(o_orderdate AS DATE) AS rate_date, CASE WHEN o_orderkey % 2 = 0 THEN 'AM' ELSE 'PM' END AS session, p AS metal_purity, v AS rate_inr_per_10g, CASE p WHEN '999' THEN 'gold' ELSE 'silver' END AS metal
  FROM (SELECT o_orderdate, o_orderkey, '999' AS p, o_totalprice AS v FROM orders UNION ALL SELECT o_orderdate, o_orderkey, 'Silver 999', CAST(o_custkey AS DOUBLE) FROM orders WHERE o_custkey % 3 <> 0)""")
def shape_bullion_rates(spark, sf):
    wide = table(spark, sf, "orders").select(F.date_format("o_orderdate", "dd/MM/yyyy").alias("rate_date"), F.when(F.col("o_orderkey") % 2 == 0, "am").otherwise("pm").alias("session"),
                                             F.col("o_totalprice").alias("999"), F.when(F.col("o_custkey") % 3 != 0, S("o_custkey")).otherwise("-").alias("Silver 999"))
    return mk.bullion_rates(wide, ["999", "Silver 999"])


# -- JSON -----------------------------------------------------------------------------

def doc(df, content, *keep):
    return df.select(F.lit("f").alias("path"), *keep, content.alias("content"))


@query("shape_json_records", "SELECT * FROM (SELECT o_orderkey AS id, o_orderpriority AS name, 'a' AS kind FROM orders UNION ALL SELECT c_custkey, c_name, 'b' FROM customer)")
def shape_json_records(spark, sf):
    o = doc(table(spark, sf, "orders"), F.to_json(F.array(F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name")))))
    c = doc(table(spark, sf, "customer"), F.to_json(F.struct(F.array(F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))).alias("Table"))))
    return fi.union_sources({"a": fi.json_records(o, "id: bigint, name: string"), "b": fi.json_records(c, "id: bigint, name: string", "Table")}, "kind").drop("path")


@query("shape_results_summary", """SELECT CAST(o_orderkey AS VARCHAR) AS scripcode, 'Revenue' AS concept, period, value FROM (SELECT o_orderkey, 'Jun-26' AS period, o_totalprice AS value FROM orders
  UNION ALL SELECT o_orderkey, 'Mar-26', CAST(o_custkey AS DOUBLE) FROM orders UNION ALL SELECT o_orderkey, 'FY25', NULL FROM orders)""")
def shape_results_summary(spark, sf):
    inner = F.to_json(F.struct(F.lit("Jun-26").alias("col2"), F.lit("Mar-26").alias("col3"), F.lit("FY25").alias("col4"), F.array(F.struct(
        F.lit("Revenue").alias("title"), F.format_number("o_totalprice", 2).alias("v1"), F.format_number("o_custkey", 0).alias("v2"), F.lit("--").alias("v3"))).alias("resultinCr")))
    o = table(spark, sf, "orders").select(S("o_orderkey").alias("scripcode"), F.to_json(F.array(inner)).alias("content"))
    return mk.results_summary(o)


@query("shape_parallel_arrays", "SELECT CAST(o_custkey AS VARCHAR) AS cik, unnest(['a' || o_orderkey, 'b' || o_orderkey]) AS \"accessionNumber\", unnest([o_orderpriority, o_orderstatus]) AS form FROM orders")
def shape_parallel_arrays(spark, sf):
    o = table(spark, sf, "orders")
    recent = F.struct(F.array(F.concat(F.lit("a"), S("o_orderkey")), F.concat(F.lit("b"), S("o_orderkey"))).alias("accessionNumber"), F.array("o_orderpriority", "o_orderstatus").alias("form"))
    return rg.parallel_arrays(doc(o, F.to_json(F.struct(S("o_custkey").alias("cik"), F.struct(recent.alias("recent")).alias("filings")))), ["accessionNumber", "form"])


@query("shape_ticker_map", "SELECT c_custkey AS cik_str, 'T' || c_custkey AS ticker, c_name AS title, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik_padded FROM customer")
def shape_ticker_map(spark, sf):
    c = table(spark, sf, "customer")
    one = F.struct(F.col("c_custkey").alias("cik_str"), F.concat(F.lit("T"), S("c_custkey")).alias("ticker"), F.col("c_name").alias("title"))
    return rg.ticker_map(doc(c, F.to_json(F.create_map(S("c_custkey"), one))))


@query("shape_company_facts", """SELECT o_custkey AS cik, 'E' || o_custkey AS entity, taxonomy, concept, unit, start, "end", value, filed, accn FROM (
    SELECT *, 'us-gaap' AS taxonomy, 'Assets' AS concept, 'USD' AS unit, NULL::DATE AS start, CAST(o_orderdate AS DATE) AS "end", o_totalprice AS value, CAST(o_orderdate AS DATE) + 30 AS filed, 'a' || o_orderkey AS accn FROM orders
    UNION ALL SELECT *, 'us-gaap', 'Assets', 'USD', CAST(o_orderdate AS DATE) - 90, CAST(o_orderdate AS DATE), o_totalprice / 2, CAST(o_orderdate AS DATE) + 60, 'b' || o_orderkey FROM orders
    UNION ALL SELECT *, 'ecd', 'Pay', 'shares', NULL, CAST(o_orderdate AS DATE), CAST(o_custkey AS DOUBLE), CAST(o_orderdate AS DATE) + 30, 'c' || o_orderkey FROM orders)""")
def shape_company_facts(spark, sf):
    o = table(spark, sf, "orders")
    end = F.to_date("o_orderdate")

    def point(accn, val, filed, start=None):
        fields = [end.cast("string").alias("end"), val.cast("double").alias("val"), F.date_add(end, filed).cast("string").alias("filed"), F.concat(F.lit(accn), S("o_orderkey")).alias("accn"),
                  F.lit(None).cast("string").alias("start") if start is None else start.cast("string").alias("start")]
        return F.struct(*fields)

    assets = F.struct(F.lit("Assets").alias("label"), F.create_map(F.lit("USD"), F.array(point("a", F.col("o_totalprice"), 30), point("b", F.col("o_totalprice") / 2, 60, F.date_sub(end, 90)))).alias("units"))
    pay = F.struct(F.lit("Pay").alias("label"), F.create_map(F.lit("shares"), F.array(point("c", F.col("o_custkey"), 30))).alias("units"))
    facts = F.create_map(F.lit("us-gaap"), F.create_map(F.lit("Assets"), assets), F.lit("ecd"), F.create_map(F.lit("Pay"), pay))
    d = doc(o, F.to_json(F.struct(F.lpad(S("o_custkey"), 10, "0").alias("cik"), F.concat(F.lit("E"), S("o_custkey")).alias("entityName"), facts.alias("facts"))))
    return rg.company_facts(d).select("cik", "entity", "taxonomy", "concept", "unit", "start", "end", "value", "filed", "accn")


@query("shape_concept_frames", "SELECT 'us-gaap' AS taxonomy, 'Assets' AS concept, 'CY2025Q2I' AS period, 'USD' AS unit, 'a' || o_orderkey AS accn, o_custkey AS cik, o_orderstatus AS entity, CAST(o_orderdate AS DATE) AS \"end\", o_totalprice AS value FROM orders")
def shape_concept_frames(spark, sf):
    o = table(spark, sf, "orders")
    rec = F.struct(F.concat(F.lit("a"), S("o_orderkey")).alias("accn"), F.col("o_custkey").alias("cik"), F.col("o_orderstatus").alias("entityName"), F.to_date("o_orderdate").cast("string").alias("end"), F.col("o_totalprice").alias("val"))
    return rg.concept_frames(doc(o, F.to_json(F.struct(F.lit("us-gaap").alias("taxonomy"), F.lit("Assets").alias("tag"), F.lit("CY2025Q2I").alias("ccp"), F.lit("USD").alias("uom"), F.array(rec).alias("data")))))


@query("shape_chokepoint_pages", "SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS portname, CAST(o_custkey AS DOUBLE) AS n_total, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS capacity FROM orders")
def shape_chokepoint_pages(spark, sf):
    o = table(spark, sf, "orders")
    ms = (F.unix_date(F.to_date("o_orderdate")).cast("bigint") * 86400000).cast("string")
    a = F.struct(F.when(F.col("o_orderkey") % 2 == 0, ms).otherwise(F.to_date("o_orderdate").cast("string")).alias("date"), F.col("o_orderpriority").alias("portname"), F.col("o_custkey").alias("n_total"),
                 F.when(F.col("o_orderkey") % 5 != 0, S("o_totalprice")).otherwise("n/a").alias("capacity"), F.lit("1").alias("ObjectId"))
    return wo.chokepoint_pages(doc(o, F.to_json(F.struct(F.array(F.struct(a.alias("attributes"))).alias("features")))), ["ObjectId", "date", "portname", "n_total", "capacity"])


@query("shape_aircraft_states", "SELECT 'i' || c_custkey AS icao24, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS callsign, c_acctbal AS longitude, CASE WHEN c_custkey % 3 = 0 THEN '7' END AS category, 'jam' AS box FROM customer")
def shape_aircraft_states(spark, sf):
    c = table(spark, sf, "customer")
    head = [F.concat(F.lit("i"), S("c_custkey")), F.when(F.col("c_custkey") % 2 == 0, F.concat("c_name", F.lit("  "))).otherwise("  "), F.lit("IN"), F.lit("1"), F.lit("2"), S("c_acctbal")]
    full = F.array(*head, *[F.lit("0")] * 11, F.lit("7"))
    vec = F.when(F.col("c_custkey") % 3 == 0, full).otherwise(F.array(*head))
    d = doc(c, F.to_json(F.struct(F.lit(1700000000).alias("time"), F.array(vec).alias("states"))), F.lit("jam").alias("box"))
    return wo.aircraft_states(d).select("icao24", "callsign", "longitude", "category", "box")


@query("shape_settlements", """SELECT 'P' || o_orderkey AS product, m AS month, m = 'Total' AS is_total, CASE m WHEN 'AUG 26' THEN 0 WHEN 'OCT 26' THEN 1 END AS contract_order, CASE m WHEN 'AUG 26' THEN o_totalprice WHEN 'OCT 26' THEN CAST(-o_custkey AS DOUBLE) END AS settle_num
  FROM orders, (VALUES ('AUG 26'), ('Total'), ('OCT 26')) v(m)""")
def shape_settlements(spark, sf):
    o = table(spark, sf, "orders")
    row = lambda m, s: F.struct(F.lit(m).alias("month"), s.alias("settle"))
    d = doc(o, F.to_json(F.struct(F.lit("08/20/2026").alias("tradeDate"), F.array(row("AUG 26", F.concat(F.format_number("o_totalprice", 2), F.lit("A"))), row("Total", F.lit("UNCH")),
                                                                                 row("OCT 26", F.concat(F.lit("-"), S("o_custkey")))).alias("settlements"))),
            F.concat(F.lit("P"), S("o_orderkey")).alias("product"), F.to_date("o_orderdate").alias("trade_date_requested"))
    return mk.settlements(d).select("product", "month", "is_total", F.col("contract_order").cast("int").alias("contract_order"), "settle_num")


@query("shape_commodity_bars", "SELECT CAST(o_orderdate AS DATE) AS trade_date, o_orderpriority AS \"Symbol\", o_totalprice AS \"Close\" FROM orders WHERE o_orderkey % 4 <> 0")
def shape_commodity_bars(spark, sf):
    o = table(spark, sf, "orders")
    r = F.struct(F.date_format("o_orderdate", "MM/dd/yyyy").alias("Date"), F.concat("o_orderpriority", F.lit("   ")).alias("Symbol"), F.col("o_totalprice").alias("Close"))
    return mk.commodity_bars(doc(o, F.to_json(F.struct((F.col("o_orderkey") % 4 != 0).alias("IsSuccess"), F.lit("m").alias("Message"), F.array(r).alias("Data"))))).select("trade_date", "Symbol", "Close")


@query("shape_keyed_activity", "SELECT unnest(['N|A', 'N|B']) AS segment, o_custkey AS total, CAST(o_orderdate AS DATE) + 1 AS trade_date, '1D' AS interval FROM orders")
def shape_keyed_activity(spark, sf):
    o = table(spark, sf, "orders")
    stamp = F.unix_date(F.to_date("o_orderdate")).cast("bigint") * 86400000 + 20 * 3600000     # 20:00 UTC is the next day in India
    rec = F.array(F.struct(stamp.alias("time_stamp"), F.col("o_custkey").alias("total")))
    return mk.keyed_activity(doc(o, F.to_json(F.struct(F.lit("success").alias("status"), F.create_map(F.lit("N|A"), rec, F.lit("N|B"), rec).alias("data")))), "total: bigint", "1D").drop("time_stamp")


@query("shape_option_chain", """SELECT 'P' || p_partkey AS symbol, p_retailprice AS strike_price, leg AS option_type, CAST(p_size AS BIGINT) AS open_interest, CASE leg WHEN 'CE' THEN 950.0::DOUBLE ELSE 951.0::DOUBLE END AS underlying_value
  FROM part, (VALUES ('CE'), ('PE')) v(leg) WHERE leg = 'CE' OR p_partkey % 3 <> 0""")
def shape_option_chain(spark, sf):
    p = table(spark, sf, "part")
    leg = lambda extra: F.struct(F.lit("20-08-2026").alias("expiryDate"), F.col("p_size").alias("openInterest"), *extra)
    e = F.struct(F.col("p_retailprice").alias("strikePrice"), leg([]).alias("CE"), F.when(F.col("p_partkey") % 3 != 0, leg([F.lit(951.0).alias("underlyingValue")])).alias("PE"))
    d = doc(p, F.to_json(F.struct(F.struct(F.lit(950.0).alias("underlyingValue"), F.array(e).alias("data")).alias("records"))), F.concat(F.lit("P"), S("p_partkey")).alias("symbol"), F.lit("2026-08-01").alias("fetched_at_utc"))
    return mk.option_chain(d).select("symbol", "strike_price", "option_type", "open_interest", "underlying_value")


@query("shape_key_indicators", "SELECT CAST(o_orderdate AS DATE) AS as_of, o_orderpriority AS indicator, o_totalprice AS value, 'INR' AS \"currencyDesc\" FROM orders")
def shape_key_indicators(spark, sf):
    o = table(spark, sf, "orders")
    r = F.struct(F.col("o_orderpriority").alias("name"), F.col("o_totalprice").alias("rate"), (F.unix_date(F.to_date("o_orderdate")).cast("bigint") * 86400000 - 19800000).alias("timeDate"), F.lit("INR").alias("currencyDesc"))
    return mk.key_indicators(doc(o, F.to_json(F.struct(F.struct(F.array(r).alias("result")).alias("body")))))


@query("shape_forex_reserves", "SELECT CAST(o_orderdate AS DATE) AS week_ended, o_orderstatus AS component_code, o_totalprice AS amount_usd, '2026-27' AS fiscal_year, 'Weekly' AS frequency FROM orders")
def shape_forex_reserves(spark, sf):
    o = table(spark, sf, "orders")
    r = F.struct((F.unix_date(F.to_date("o_orderdate")).cast("bigint") * 86400000 - 19800000).alias("timeDate"), F.col("o_orderstatus").alias("fxReservesCode"), F.col("o_totalprice").alias("amount"), F.lit(" 2026-27 ").alias("timeFisYear"))
    return mk.forex_reserves(doc(o, F.to_json(F.struct(F.struct(F.array(r).alias("result")).alias("body"))))).select("week_ended", "component_code", "amount_usd", "fiscal_year", "frequency")


@query("shape_report_catalog", "SELECT unnest(['R' || c_custkey, 'Q' || c_custkey]) AS report_id, c_name AS report_name, c_mktsegment AS menu FROM customer")
def shape_report_catalog(spark, sf):
    c = table(spark, sf, "customer")
    sub = lambda k: F.struct(F.array(F.struct(F.concat(F.lit(k), S("c_custkey")).alias("reportId"), F.col("c_name").alias("reportName"))).alias("subs"))
    d = doc(c, F.to_json(F.struct(F.struct(F.array(sub("R"), sub("Q")).alias("reports")).alias("body"))), F.lit("Statistics").alias("function"), F.lit("D").alias("department"), F.col("c_mktsegment").alias("menu"))
    return mk.report_catalog(d).select("report_id", "report_name", "menu")


@query("shape_economy_reports", "SELECT 'R' || c_custkey AS report_id, c_name AS report_name, c_mktsegment AS section FROM customer")
def shape_economy_reports(spark, sf):
    c = table(spark, sf, "customer")
    r = F.struct(F.concat(F.lit("R"), S("c_custkey")).alias("reportId"), F.col("c_name").alias("economyWatchSubheader"))
    return mk.economy_reports(doc(c, F.to_json(F.struct(F.struct(F.array(r).alias("subSelection")).alias("body"))), F.col("c_mktsegment").alias("section")))


@query("shape_rating_listing", "SELECT CAST(o_orderkey AS VARCHAR) AS action_id, CAST(o_orderdate AS DATE) AS rating_date, o_orderpriority AS heading, 'https://host/docs/a%20b' || o_orderkey || '.html' AS document_url FROM orders")
def shape_rating_listing(spark, sf):
    o = table(spark, sf, "orders")
    r = F.struct(F.date_format("o_orderdate", "MMM d, yyyy").alias("ratingDate"), F.date_format("o_orderdate", "MMM d, yyyy").alias("transDate"), F.col("o_orderpriority").alias("heading"),
                 F.concat(F.lit("a b"), S("o_orderkey"), F.lit(".html")).alias("ratingFileName"), S("o_orderkey").alias("prId"))
    return mk.rating_listing(doc(o, F.to_json(F.struct(F.array(r).alias("docs")))), "https://host/docs/").select("action_id", "rating_date", "heading", "document_url")


# -- XML ------------------------------------------------------------------------------

def xml(*parts):
    return F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])


def schedules(spark, sf):
    """A passive schedule per customer, every second one namespaced and with other capitals."""
    c = table(spark, sf, "customer")
    odd = F.col("c_custkey") % 2 == 1
    tag = F.when(odd, "issuerCIK").otherwise("issuerCik")
    person = lambda n, kinds: xml("<coverPageHeaderReportingPersonDetails><reportingPersonName>", n, F.concat("c_name", F.lit("  LP")), "</reportingPersonName><reportingPersonBeneficiallyOwnedNumberOfShares><soleVotingPower>1,",
                                  F.lpad(S("c_nationkey"), 3, "0"), "</soleVotingPower></reportingPersonBeneficiallyOwnedNumberOfShares><classPercent>5.5</classPercent>", kinds, "</coverPageHeaderReportingPersonDetails>")
    body = xml(F.when(odd, "<edgarSubmission xmlns=\"http://x/13g\">").otherwise("<edgarSubmission>"), "<headerData><submissionType>SCHEDULE 13G</submissionType></headerData><formData><coverPageHeader>",
               "<securitiesClassTitle>Common</securitiesClassTitle><issuerInfo><", tag, ">", S("c_custkey"), "</", tag, "><issuerName>Acme ", S("c_nationkey"), "</issuerName></issuerInfo></coverPageHeader>",
               person("A ", "<typeOfReportingPerson>IA</typeOfReportingPerson><typeOfReportingPerson>HC</typeOfReportingPerson>"), person("B ", "<typeOfReportingPerson>IN</typeOfReportingPerson>"),
               "<items><item4>It  holds</item4></items></formData></edgarSubmission>")
    broken = F.when(F.col("c_custkey") % 50 == 7, F.lit("<edgarSubmission><headerData>")).otherwise(body)
    return c.select(F.concat(F.lit("f"), S("c_custkey")).alias("path"), F.concat(F.lit("a"), S("c_custkey")).alias("accn"), broken.alias("content"))


@query("shape_passive_persons", """SELECT 'a' || c_custkey AS accn, CAST(c_custkey AS VARCHAR) AS issuer_cik, 'Acme ' || c_nationkey AS issuer_name, k || c_name || ' LP' AS person_name, CAST(1000 + c_nationkey AS DOUBLE) AS sole_voting, 5.5::DOUBLE AS percent_of_class,
  CASE k WHEN 'A ' THEN 'IA|HC' ELSE 'IN' END AS person_type FROM customer, (VALUES ('A '), ('B ')) v(k) WHERE c_custkey % 50 <> 7""")
def shape_passive_persons(spark, sf):
    return rg.passive_persons(schedules(spark, sf)).select("accn", "issuer_cik", "issuer_name", "person_name", "sole_voting", "percent_of_class", "person_type")


@query("shape_reparse_archive", """SELECT 'a' || c_custkey AS accn, DATE '2025-01-01' + CAST(c_nationkey AS INTEGER) AS filed, 'Common' AS security_class, 'It holds' AS item4_ownership, 'ok' AS state FROM customer WHERE c_custkey % 50 <> 7
  UNION ALL SELECT 'f' || c_custkey, NULL, NULL, NULL, 'not parseable' FROM customer WHERE c_custkey % 50 = 7""")
def shape_reparse_archive(spark, sf):
    index = table(spark, sf, "customer").select(F.concat(F.lit("a"), S("c_custkey")).alias("accn"), F.date_add(F.lit("2025-01-01").cast("date"), F.col("c_nationkey")).alias("filed"))
    ok, bad = ar.reparse(schedules(spark, sf), rg.passive_filings, index, F.col("issuer_cik").isNotNull())
    return ok.select("accn", "filed", "security_class", "item4_ownership", F.lit("ok").alias("state")).unionByName(bad.select(
        F.col("path").alias("accn"), F.lit(None).cast("date").alias("filed"), F.lit(None).cast("string").alias("security_class"), F.lit(None).cast("string").alias("item4_ownership"), F.col("reason").alias("state")))


def actives(spark, sf):
    c = table(spark, sf, "customer")
    body = xml("<p:edgarSubmission xmlns:p=\"http://x/13d\"><p:headerData><p:submissionType>SCHEDULE 13D/A</p:submissionType></p:headerData><p:formData><p:coverPageHeader><p:dateOfEvent>01/02/2025</p:dateOfEvent>",
               "<p:issuerInfo><p:issuerCIK>", S("c_custkey"), "</p:issuerCIK><p:issuerName>Acme</p:issuerName></p:issuerInfo></p:coverPageHeader><p:reportingPersons><p:reportingPersonInfo><p:reportingPersonCIK>", S("c_nationkey"),
               "</p:reportingPersonCIK><p:reportingPersonName>", F.col("c_name"), "</p:reportingPersonName><p:aggregateAmountOwned>1,234</p:aggregateAmountOwned></p:reportingPersonInfo></p:reportingPersons>",
               "<p:items1To7><p:item4>We may nominate   directors</p:item4></p:items1To7></p:formData></p:edgarSubmission>")
    return c.select(F.lit("f").alias("path"), F.concat(F.lit("a"), S("c_custkey")).alias("accn"), body.alias("content"))


@query("shape_active_persons", "SELECT 'a' || c_custkey AS accn, CAST(c_custkey AS VARCHAR) AS issuer_cik, CAST(c_nationkey AS VARCHAR) AS person_cik, c_name AS person_name, 1234.0::DOUBLE AS aggregate_owned FROM customer")
def shape_active_persons(spark, sf):
    return rg.active_persons(actives(spark, sf)).select("accn", "issuer_cik", "person_cik", "person_name", "aggregate_owned")


@query("shape_active_filings", "SELECT 'a' || c_custkey AS accn, 'SCHEDULE 13D/A' AS form, '01/02/2025' AS date_of_event, 'We may nominate directors' AS item4_purpose FROM customer")
def shape_active_filings(spark, sf):
    return rg.active_filings(actives(spark, sf)).select("accn", "form", "date_of_event", "item4_purpose")


@query("shape_information_table", """SELECT o_custkey AS cik, o_orderkey AS accn, k AS cusip, CASE k WHEN 'x' THEN o_totalprice ELSE 5.0::DOUBLE END AS value_reported, CASE k WHEN 'x' THEN 1000.0::DOUBLE ELSE 10.0::DOUBLE END AS shares_or_principal,
  CASE WHEN (o_totalprice / 1000 + 0.5) / 2 < 1 THEN 'thousands' ELSE 'dollars' END AS value_scale FROM orders, (VALUES ('x'), ('y')) v(k)""")
def shape_information_table(spark, sf):
    o = table(spark, sf, "orders")
    row = lambda ns, cusip, val, sh: xml(f"<{ns}infoTable><{ns}cusip>{cusip}</{ns}cusip><{ns}value>", val, f"</{ns}value><{ns}shrsOrPrnAmt><{ns}sshPrnamt>{sh}</{ns}sshPrnamt></{ns}shrsOrPrnAmt></{ns}infoTable>")
    plain = xml("<informationTable>", row("", "x", S("o_totalprice"), 1000), row("", "y", F.lit("5"), 10), "</informationTable>")
    spaced = xml("<n:informationTable xmlns:n=\"http://t\">", row("n:", "x", S("o_totalprice"), 1000), row("n:", "y", F.lit("5"), 10), "</n:informationTable>")
    d = o.select(F.lit("f").alias("path"), F.col("o_custkey").alias("cik"), F.col("o_orderkey").alias("accn"), F.when(F.col("o_orderkey") % 2 == 0, plain).otherwise(spaced).alias("content"))
    return scaled_holdings(rg.information_table(d)).select("cik", "accn", "cusip", "value_reported", "shares_or_principal", "value_scale")


@query("shape_fund_holdings", "SELECT 'a' || p_partkey AS accn, p_name AS name, 'US' || p_partkey AS isin, p_retailprice AS value_usd, 'EC' AS asset_category FROM part")
def shape_fund_holdings(spark, sf):
    p = table(spark, sf, "part")
    body = xml("<edgarSubmission xmlns=\"http://n\"><formData><invstOrSecs><invstOrSec><name>", F.col("p_name"), "</name><identifiers><isin value=\"US", S("p_partkey"), "\"/></identifiers><valUSD>", S("p_retailprice"),
               "</valUSD><assetCat>EC</assetCat></invstOrSec></invstOrSecs></formData></edgarSubmission>")
    return rg.fund_holdings(p.select(F.lit("f").alias("path"), F.concat(F.lit("a"), S("p_partkey")).alias("accn"), body.alias("content"))).select("accn", "name", "isin", "value_usd", "asset_category")


@query("shape_disaster_alerts", "SELECT 'Alert ' || event_id AS title, event_type, 'Orange' AS alert_level, value AS lat, CASE WHEN event_id % 2 = 0 THEN CAST(user_id AS DOUBLE) END AS lon FROM events")
def shape_disaster_alerts(spark, sf):
    e = events(spark, sf)
    body = xml("<rss xmlns:gdacs=\"http://g\" xmlns:geo=\"http://w\"><channel><item><title> Alert ", S("event_id"), "</title><gdacs:eventtype>", F.col("event_type"), "</gdacs:eventtype><gdacs:alertlevel>Orange</gdacs:alertlevel><geo:Point><geo:lat>1</geo:lat></geo:Point><geo:lat>",
               S("value"), "</geo:lat><geo:long>", F.when(F.col("event_id") % 2 == 0, S("user_id")).otherwise("?"), "</geo:long></item></channel></rss>")
    return wo.disaster_alerts(doc(e, body)).select("title", "event_type", "alert_level", "lat", "lon")


@query("shape_instance_facts", """SELECT 'u' || o_orderkey AS source_url, concept, context_id, period_start, period_end, instant, has_dimensions, unit, value, said FROM orders, (VALUES ('Revenue', 'D', true), ('Assets', 'I', true), ('Name', 'D', false), ('Segment', 'X', true)) f(concept, context_id, num),
  LATERAL (SELECT CASE context_id WHEN 'D' THEN '2024-04-01' WHEN 'X' THEN '2024-10-01' END AS period_start, CASE context_id WHEN 'I' THEN '2024-12-31' ELSE '2024-12-31' END AS period_end, context_id = 'I' AS instant, context_id = 'X' AS has_dimensions,
    CASE WHEN num THEN 'INR/shares' END AS unit, CASE WHEN num THEN o_totalprice END AS value, CASE WHEN NOT num THEN 'Co <' || o_custkey || '> & Sons &amp;' END AS said)""")
def shape_instance_facts(spark, sf):
    o = table(spark, sf, "orders")
    ctx = ("<xbrli:context id=\"D\"><xbrli:entity><xbrli:identifier>T</xbrli:identifier></xbrli:entity><xbrli:period><xbrli:startDate>2024-10-01</xbrli:startDate><xbrli:endDate>2024-12-30</xbrli:endDate></xbrli:period></xbrli:context>"
           "<xbrli:context id=\"I\"><xbrli:period><xbrli:instant>2024-12-31</xbrli:instant></xbrli:period></xbrli:context>"
           "<xbrli:context id=\"X\"><xbrli:period><xbrli:startDate>2024-10-01</xbrli:startDate><xbrli:endDate>2024-12-31</xbrli:endDate></xbrli:period><xbrli:scenario><d:explicitMember xmlns:d=\"http://d\" dimension=\"Axis\">M</d:explicitMember></xbrli:scenario></xbrli:context>"
           "<xbrli:unit id=\"U\"><xbrli:measure>iso4217:INR</xbrli:measure><xbrli:measure>xbrli:shares</xbrli:measure></xbrli:unit>"
           "<f:DateOfStartOfReportingPeriod contextRef=\"D\">2024-04-01</f:DateOfStartOfReportingPeriod><f:DateOfEndOfReportingPeriod contextRef=\"D\">2024-12-31</f:DateOfEndOfReportingPeriod>")
    num = lambda n, c: xml(f"<f:{n} contextRef=\"{c}\" unitRef=\"U\" decimals=\"2\">", S("o_totalprice"), f"</f:{n}>")
    body = xml("<xbrli:xbrl xmlns:xbrli=\"http://i\" xmlns:f=\"http://f\">", ctx, num("Revenue", "D"), num("Assets", "I"), "<f:Name contextRef=\"D\"><!-- <f:Fake contextRef=\"D\"> --><![CDATA[Co <]]>", S("o_custkey"), "&gt; <![CDATA[& Sons &amp;]]></f:Name>", num("Segment", "X"), "</xbrli:xbrl>")
    typed = F.when(F.col("o_orderkey") % 2 == 0, "<!DOCTYPE xbrl SYSTEM 'a.dtd' [ <!ELEMENT x ANY> ]>").otherwise("")
    facts = rg.reported_period(rg.instance_facts(o.select(F.concat(F.lit("u"), S("o_orderkey")).alias("path"), F.concat(typed, body).alias("content"))))
    return facts.where("concept NOT LIKE 'DateOf%'").select("source_url", "concept", "context_id", "period_start", "period_end", "instant", "has_dimensions", "unit", "value",
                                                            F.when(F.col("unit").isNull(), F.col("value_text")).alias("said"))


@query("shape_instance_rejects", """SELECT 'u' || o_orderkey AS source_url, CASE o_orderkey % 3 WHEN 0 THEN 'entities declared' ELSE 'not well formed' END AS reason FROM orders WHERE o_orderkey % 3 < 2""")
def shape_instance_rejects(spark, sf):
    k = F.col("o_orderkey")
    body = F.when(k % 3 == 0, "<!DOCTYPE a [<!ENTITY b 'c'>]><a/>").when(k % 3 == 1, F.concat(F.lit("<a><b>"), S("o_custkey"), F.lit("</a>"))).otherwise("<x xmlns='http://i'/>")
    return rg.instance_rejects(table(spark, sf, "orders").select(F.concat(F.lit("u"), S("o_orderkey")).alias("path"), body.alias("content")))


@query("shape_facts_with_filing", "SELECT 'u' || o_orderkey AS source_url, o_custkey AS value, c_name AS symbol FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_custkey % 2 = 0")
def shape_facts_with_filing(spark, sf):
    facts = table(spark, sf, "orders").select(F.concat(F.lit("u"), S("o_orderkey")).alias("fact_url"), F.concat(F.lit("c"), S("o_custkey")).alias("source_url"), F.col("o_custkey").alias("value"))
    idx = table(spark, sf, "customer").where("c_custkey % 2 = 0").select(F.concat(F.lit("c"), S("c_custkey")).alias("xbrl"), F.col("c_name").alias("symbol"))
    return rg.with_filing(facts, idx.unionByName(idx)).select(F.col("fact_url").alias("source_url"), "value", "symbol")


# -- grids ----------------------------------------------------------------------------

def packed(values):
    """A binary column of little-endian float32 values."""
    @F.pandas_udf("binary")
    def pack(v: pd.Series) -> pd.Series:
        return v.map(lambda a: np.asarray(a, dtype="<f4").tobytes())

    return pack(values)


def grids(spark, sf):
    """Each embedding written as an 8 x n float32 grid."""
    return table(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("path"), packed("embedding").alias("content"), F.size("embedding").alias("n"))


def width(spark, sf):
    return table(spark, sf, "embeddings").select(F.size("embedding").alias("n")).first()["n"] // 8


GRID = """g AS (SELECT CAST(vec_id AS VARCHAR) AS path, i, CAST(embedding[i + 1] AS DOUBLE) AS value, len(embedding) // 8 AS w FROM embeddings, (SELECT unnest(range(4096)) AS i) WHERE i < len(embedding)),
  c AS (SELECT path, 10.0::DOUBLE + (i // w) AS lat, 70.0::DOUBLE + (i % w) AS lon, value FROM g WHERE value <> -999)"""


@query("shape_grid_cells", f"WITH {GRID} SELECT path, lat, lon, round(value, 6) AS value FROM c")
def shape_grid_cells(spark, sf):
    return wo.grid_cells(grids(spark, sf), width(spark, sf), 8, 1, 70.0, 10.0, 1.0).select("path", "lat", "lon", F.round("value", 6).alias("value"))


BOXES = {"all": (60.0, 100.0, 0.0, 40.0), "south": (70.0, 73.0, 8.0, 12.0), "edge": (72.0, 74.0, 13.0, 17.0)}


@query("shape_regional_means", f"""WITH {GRID}, b(region, w, e, s, n) AS (VALUES {', '.join(f"('{k}', {', '.join(map(str, v))})" for k, v in BOXES.items())})
  SELECT path, region, round(sum(value * cos(radians(lat))) / sum(cos(radians(lat))), 6) AS mean, count(*) AS valid_cells FROM c, b WHERE lon BETWEEN w AND e AND lat BETWEEN s AND n GROUP BY 1, 2""")
def shape_regional_means(spark, sf):
    cells = wo.grid_cells(grids(spark, sf), width(spark, sf), 8, 1, 70.0, 10.0, 1.0)
    return wo.regional_means(cells, BOXES, by=("path",)).withColumn("mean", F.round("mean", 6))


def order_grids(spark, sf):
    """A folder with one 6 x 4 grid per order date: orders per cell of their customers, missing where there are none."""
    per_cell = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("date"), F.pmod("o_custkey", F.lit(24)).cast("int").alias("i")).agg(F.count(F.lit(1)).cast("float").alias("v"))
    by_day = per_cell.groupBy("date").agg(F.map_from_entries(F.collect_list(F.struct("i", "v"))).alias("m"))
    values = F.transform(F.sequence(F.lit(0), F.lit(23)), lambda i: F.coalesce(F.try_element_at(F.col("m"), i), F.lit(-999.0).cast("float")))
    folder = f"{shared_folder(spark)}/grids/orders-{uuid.uuid4().hex}"
    gr.write_grids(by_day.select("date", packed(values).alias("content")), folder, ORDER_LAYOUT)
    return gr.read_grids(spark, folder, ORDER_LAYOUT)


ORDER_LAYOUT = gr.Layout(6, 4, 1, 70.0, 10.0, 1.0)
ORDER_GRID = """oc AS (SELECT CAST(o_orderdate AS DATE) AS date, o_custkey % 24 AS i, CAST(count(*) AS DOUBLE) AS value FROM orders GROUP BY ALL),
  og AS (SELECT date, CAST(10 + i // 6 AS DOUBLE) AS lat, CAST(70 + i % 6 AS DOUBLE) AS lon, value FROM oc)"""


@query("shape_grid_days", f"WITH {ORDER_GRID} SELECT date, lat, lon, value FROM og")
def shape_grid_days(spark, sf):
    return order_grids(spark, sf).select("date", "lat", "lon", "value")


@query("shape_grid_season", f"""WITH {ORDER_GRID} SELECT date, round(sum(value * cos(radians(lat))) / sum(cos(radians(lat))), 6) AS mean, count(*) AS valid_cells
  FROM og WHERE date BETWEEN DATE '1995-06-01' AND DATE '1995-09-30' GROUP BY 1""")
def shape_grid_season(spark, sf):
    """Daily means of one season; the scan opens the files of its days only."""
    season = order_grids(spark, sf).where("date BETWEEN DATE '1995-06-01' AND DATE '1995-09-30'")
    return wo.regional_means(season, {"all": (0.0, 180.0, -90.0, 90.0)}).select("date", F.round("mean", 6).alias("mean"), "valid_cells")


# -- cell tables ----------------------------------------------------------------------

def table_cells(spark, sf):
    """One printed table per customer order: two header levels, an index row, a unit row and
    data rows for price and a ratio."""
    o = table(spark, sf, "orders")
    row = lambda r, *v: [F.struct(F.lit(r).alias("r"), F.lit(i).alias("c"), (x if not isinstance(x, str) else F.lit(x)).alias("text")) for i, x in enumerate(v)]
    cells = F.array(*row(0, "Item", "2025", "2025"), *row(1, "", "Jul. 25", "Aug. 25"), *row(2, "1", "1", "2"), *row(3, "(Per cent)", "(Per cent)", "(Per cent)"),
                    *row(4, "Amount  due", F.format_number("o_totalprice", 2), "-"), *row(5, "Cash ratio", F.concat(F.lit("("), S("o_custkey"), F.lit(")")), S("o_custkey")), *row(6, "Note", "Note", "Note"))
    return o.select(F.col("o_orderkey").cast("string").alias("doc"), F.lit(0).alias("table_no"), F.inline(cells))


TIDY = """td AS (SELECT CAST(o_orderkey AS VARCHAR) AS doc, 0 AS table_no, 'Amount due' AS row_label, '2025 / Jul. 25' AS series, o_totalprice AS value_num, o_custkey FROM orders
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 0, 'Cash ratio', '2025 / Jul. 25', CAST(-o_custkey AS DOUBLE) + 0, o_custkey FROM orders UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 0, 'Cash ratio', '2025 / Aug. 25', CAST(o_custkey AS DOUBLE), o_custkey FROM orders)"""


@query("shape_tidy_tables", f"WITH {TIDY} SELECT doc, table_no, row_label, series, value_num FROM td")
def shape_tidy_tables(spark, sf):
    return ce.tidy_tables(table_cells(spark, sf)).drop("value", "table_title").withColumn("value_num", F.col("value_num") + 0.0)


@query("shape_ratio_rows", f"WITH {TIDY} SELECT doc, series, value_num FROM td WHERE row_label = 'Cash ratio'")
def shape_ratio_rows(spark, sf):
    return ce.ratio_rows(ce.tidy_tables(table_cells(spark, sf))).select("doc", "series", (F.col("value_num") + 0.0).alias("value_num"))


@query("shape_release_tables", f"WITH {TIDY} SELECT td.doc, row_label, value_num, 'Money Market Operations ' || o_orderpriority AS release_title FROM td JOIN orders ON doc = CAST(o_orderkey AS VARCHAR) WHERE o_orderkey % 2 = 0")
def shape_release_tables(spark, sf):
    rel = table(spark, sf, "orders").select(S("o_orderkey").alias("prid"), F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("Money Market Operations "), "o_orderpriority")).otherwise("Other").alias("title"))
    return ce.release_tables(table_cells(spark, sf), rel, "money market").select("doc", "row_label", (F.col("value_num") + 0.0).alias("value_num"), "release_title")


def listing(spark, sf):
    o = table(spark, sf, "orders")
    link = lambda k, t: xml("<a class='link2' href=BS_PressReleaseDisplay.aspx?prid=", F.concat(S("o_orderkey"), F.lit(k)), ">", t, "</a>")
    body = xml("<td class=\"tableheader\" colspan=2><b>", F.date_format("o_orderdate", "MMM dd, yyyy"), "</b></td>", link("1", F.lit("Weekly   Statistical Supplement")),
               "<a href='https://rbidocs.rbi.org.in/rdocs/PressRelease/PDFs/P", S("o_orderkey"), ".PDF'>x</a>", link("2", F.col("o_orderpriority")))
    return o.select(F.concat(F.lit("p"), S("o_orderkey")).alias("path"), body.alias("content"))


@query("shape_press_releases", """SELECT 'p' || o_orderkey AS path, CAST(o_orderkey AS VARCHAR) || k AS prid, strftime(o_orderdate, '%b %d, %Y') AS release_date, CASE k WHEN '1' THEN 'Weekly Statistical Supplement' ELSE o_orderpriority END AS title,
  CASE k WHEN '1' THEN 'https://rbidocs.rbi.org.in/rdocs/PressRelease/PDFs/P' || o_orderkey || '.PDF' END AS pdf_url FROM orders, (VALUES ('1'), ('2')) v(k)""")
def shape_press_releases(spark, sf):
    return ce.press_releases(listing(spark, sf)).drop("position")


@query("shape_newest_release", "SELECT 'p' || o_orderkey AS path, CAST(o_orderkey AS VARCHAR) || '2' AS prid, o_orderpriority AS title FROM orders WHERE o_orderpriority LIKE '%URG%'")
def shape_newest_release(spark, sf):
    return ce.newest_release(ce.press_releases(listing(spark, sf)), "urg")


@query("shape_policy_rates", "SELECT 'p' || o_orderkey AS path, k AS rate_name, CASE k WHEN 'Policy Repo Rate' THEN o_totalprice ELSE CAST(o_custkey AS DOUBLE) END AS rate_pct FROM orders, (VALUES ('Policy Repo Rate'), ('Bank Rate')) v(k)")
def shape_policy_rates(spark, sf):
    o = table(spark, sf, "orders")
    row = lambda k, v: xml("<tr><th> ", k, "</th>\n<td class=x> : ", v, "%</td></tr>")
    body = xml("<th>Other</th><td>: 1%</td><a>Policy&nbsp; Rates</a><table>", row("Policy&nbsp;Repo  Rate", S("o_totalprice")), row("Bank Rate", S("o_custkey")), "</table></div><th>Later</th><td>: 2%</td>")
    return ce.policy_rates(o.select(F.concat(F.lit("p"), S("o_orderkey")).alias("path"), body.alias("content"))).select("path", "rate_name", "rate_pct")


@query("shape_facilities", "SELECT c_custkey AS company_id, c_name AS company_name, c_mktsegment AS lender, 'Cash Credit' AS facility, c_acctbal AS amount_inr_crore FROM customer")
def shape_facilities(spark, sf):
    c = table(spark, sf, "customer")
    row = lambda r, *v: [F.struct(F.lit(r).alias("r"), F.lit(i).alias("c"), (x if not isinstance(x, str) else F.lit(x)).alias("text")) for i, x in enumerate(v)]
    cells = c.select(F.col("c_custkey").alias("company_id"), F.col("c_name").alias("company_name"), F.inline(F.array(*row(0, "Lender", "Facility", "Amount"), *row(1, F.col("c_mktsegment"), "Cash Credit", S("c_acctbal")))))
    return ce.facilities(cells)


@query("shape_widest_table", "SELECT CAST(c_custkey AS VARCHAR) AS doc, CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END AS table_no, count(*) AS cells FROM customer, range(3) GROUP BY 1, 2")
def shape_widest_table(spark, sf):
    c = table(spark, sf, "customer")
    t = lambda no, w: F.transform(F.sequence(F.lit(0), w - 1), lambda i: F.struct(F.lit(no).alias("table_no"), F.lit(0).alias("r"), i.cast("int").alias("c"), F.lit("x").alias("text")))
    w0 = F.when(F.col("c_custkey") % 2 == 0, F.lit(2)).otherwise(F.lit(3))
    cells = c.select(S("c_custkey").alias("doc"), F.inline(F.concat(t(0, w0), t(1, F.lit(3)))))
    return ce.widest_table(cells).groupBy("doc", "table_no").agg(F.count(F.lit(1)).alias("cells"))


@query("shape_sheet_facts", """SELECT CAST(c_custkey AS VARCHAR) AS doc, statement, period_type, concept, DATE '2025-03-31' AS period_end, v * c_nationkey AS value FROM customer, (VALUES ('income_statement', 'annual', 'Sales', 1.0::DOUBLE),
  ('balance_sheet', 'annual', 'Reserves', 2.0::DOUBLE), ('balance_sheet', 'annual', 'Total Equity and Liabilities', 3.0::DOUBLE), ('balance_sheet', 'annual', 'Total Assets', 4.0::DOUBLE), ('balance_sheet', 'annual', 'Reserves_2', 5.0::DOUBLE)) f(statement, period_type, concept, v)""")
def shape_sheet_facts(spark, sf):
    c = table(spark, sf, "customer")
    n = lambda k: (F.col("c_nationkey") * k).cast("string")
    row = lambda r, *v: [F.struct(F.lit(r).alias("r"), F.lit(i).alias("c"), (x if not isinstance(x, str) else F.lit(x)).alias("text")) for i, x in enumerate(v)]
    cells = F.array(*row(0, "META", "x"), *row(2, "PROFIT & LOSS"), *row(3, "Report Date", "2025-03-31"), *row(4, "Sales", n(1.0)), *row(5, "", ""), *row(6, "PRICE:", "17"), *row(8, "BALANCE SHEET"), *row(9, "Report Date", "2025-03-31"),
                    *row(10, "Reserves", n(2.0)), *row(11, "Total", n(3.0)), *row(12, "Total", n(4.0)), *row(13, "Reserves", n(5.0)), *row(15, "Stray", n(9.0)))
    return ce.sheet_facts(c.select(S("c_custkey").alias("doc"), F.inline(cells)))


# -- archive --------------------------------------------------------------------------

def sidecars(spark, sf):
    d = table(spark, sf, "documents")
    stamp = F.concat(F.lit("2026-08-"), F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0"), F.lit("T10:00:00.000123+00:00"))
    side = F.struct(F.col("source"), F.col("lang").alias("dataset"), stamp.alias("fetched_at_utc"), F.sha2(F.trim(F.col("text")), 256).alias("sha256"), F.octet_length("text").cast("bigint").alias("bytes"), (F.col("doc_id") % 5).cast("string").alias("day"))
    return d.select(F.concat(F.lit("raw/f"), S("doc_id"), F.lit(".meta.json")).alias("path"), F.when(F.col("doc_id") % 97 == 3, "{broken").otherwise(F.to_json(side)).alias("content"))


MAN = """man AS (SELECT 'raw/f' || doc_id AS path, source, lang AS dataset, CAST('2026-08-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') || ' 10:00:00.000123' AS TIMESTAMP) AS fetched_at_utc, sha256(trim(text, ' ')) AS sha256,
  CAST(strlen(text) AS BIGINT) AS bytes, CAST(doc_id % 5 AS VARCHAR) AS day FROM documents WHERE doc_id % 97 <> 3)"""


@query("archive_manifest", f"WITH {MAN} SELECT path, source, dataset, CAST(fetched_at_utc AS DATE) AS fetched, bytes FROM man")
def archive_manifest(spark, sf):
    return ar.manifest(sidecars(spark, sf)).select("path", "source", "dataset", F.to_date("fetched_at_utc").alias("fetched"), "bytes")


@query("archive_latest_raw", f"WITH {MAN} SELECT source, dataset, arg_max(path, (fetched_at_utc, path)) AS path FROM man GROUP BY 1, 2")
def archive_latest_raw(spark, sf):
    return ar.latest_raw(ar.manifest(sidecars(spark, sf))).drop("fetched_at_utc")


@query("archive_find_raw", f"WITH {MAN} SELECT path, bytes FROM man WHERE (source, dataset) = (SELECT min((source, dataset)) FROM man WHERE day = '2') AND day = '2' ORDER BY fetched_at_utc DESC, path DESC LIMIT 1")
def archive_find_raw(spark, sf):
    m = ar.manifest(sidecars(spark, sf), "day string")
    first = m.where("day = '2' AND source IS NOT NULL").agg(F.min(F.struct("source", "dataset")).alias("s")).first()["s"]
    return ar.find_raw(m, first["source"], first["dataset"], day=2).select("path", "bytes")


@query("archive_integrity", f"""WITH {MAN} SELECT 'raw/f' || doc_id AS path, sha256(text) AS actual_sha256, CASE WHEN man.sha256 IS NULL THEN 'no_sidecar' WHEN man.sha256 <> sha256(text) THEN 'hash_mismatch' ELSE 'ok' END AS state
  FROM documents LEFT JOIN man ON path = 'raw/f' || doc_id""")
def archive_integrity(spark, sf):
    f = table(spark, sf, "documents").select(F.concat(F.lit("raw/f"), S("doc_id")).alias("path"), F.encode("text", "UTF-8").alias("content"))
    return ar.integrity(f, ar.manifest(sidecars(spark, sf))).select("path", "actual_sha256", "state")


@query("archive_not_archived", "SELECT l_orderkey AS accn, l_suppkey AS cik FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def archive_not_archived(spark, sf):
    found = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("accn"), F.col("l_suppkey").alias("cik"))
    return ar.not_archived(found, table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("accn")), ["accn"])


@query("archive_missing_years", "SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS year FROM lineitem WHERE year(l_shipdate) NOT IN (SELECT year(o_orderdate) + 1 FROM orders)")
def archive_missing_years(spark, sf):
    have = table(spark, sf, "orders").select((F.year("o_orderdate") + 1).alias("year"))
    return ar.missing_periods(table(spark, sf, "lineitem").select(F.year("l_shipdate").alias("year")), have, "year")


@query("archive_missing_days", "SELECT CAST(d AS DATE) AS date FROM generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY) t(d) WHERE CAST(d AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderstatus = 'F')")
def archive_missing_days(spark, sf):
    return ar.missing_days("1995-01-01", "2001-12-31", table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.to_date("o_orderdate").alias("date")))


@query("archive_sidecar_rejects", "SELECT 'raw/f' || doc_id AS path, 'not JSON' AS reason FROM documents WHERE doc_id % 97 = 3")
def archive_sidecar_rejects(spark, sf):
    return ar.sidecar_rejects(sidecars(spark, sf))


@query("archive_integrity_with_rejects", f"""WITH {MAN} SELECT 'raw/f' || doc_id AS path, CASE WHEN doc_id % 97 = 3 THEN 'unreadable_sidecar' WHEN man.sha256 <> sha256(text) THEN 'hash_mismatch' ELSE 'ok' END AS state
  FROM documents LEFT JOIN man ON path = 'raw/f' || doc_id""")
def archive_integrity_with_rejects(spark, sf):
    f = table(spark, sf, "documents").select(F.concat(F.lit("raw/f"), S("doc_id")).alias("path"), F.encode("text", "UTF-8").alias("content"))
    s = sidecars(spark, sf)
    return ar.integrity(f, ar.manifest(s), ar.sidecar_rejects(s)).select("path", "state")


@query("archive_day_range", """SELECT CAST(d AS DATE) AS date, CASE WHEN f > 0 THEN 'landed' WHEN n > 0 THEN 'failed' ELSE 'missing' END AS state, coalesce(n, 0) AS rows
  FROM generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY) t(d)
  LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS od, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS f FROM orders GROUP BY 1) ON od = CAST(d AS DATE)""")
def archive_day_range(spark, sf):
    landed = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date"), "o_orderstatus")
    return ar.day_range("1995-01-01", "2001-12-31", landed, status=F.col("o_orderstatus") == "F")


@query("shape_failed_answers", "SELECT 'o' || o_orderkey AS path, 'refused' AS reason, 'm' AS message FROM orders WHERE o_orderkey % 4 = 0")
def shape_failed_answers(spark, sf):
    flag = F.struct((F.col("o_orderkey") % 4 != 0).alias("IsSuccess"), F.lit("m").alias("Message"), F.array().cast("array<string>").alias("Data"))
    docs = table(spark, sf, "orders").select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("path"), F.to_json(flag).alias("content"))
    return mk.failed_answers(docs)
