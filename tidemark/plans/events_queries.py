"""Event screens on events, orders and lineitems."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import events as ev
from tidemark.operators import insider as ins
from tidemark.plans.bindings import INSIDERS, events, insider_buys, table
from tidemark.plans.registry import query


@query("filing_frequency", """SELECT user_id AS symbol, count(*) AS filing_count, CAST((SELECT max(ts) FROM events) AS DATE) AS as_of_date, 10 AS window_days
  FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 10 DAY GROUP BY user_id""")
def filing_frequency(spark, sf):
    return ev.filing_frequency(events(spark, sf), "user_id", "ts", 10)


def deals(spark, sf):
    e = events(spark, sf).select(F.col("user_id").alias("symbol"), F.to_date("ts").alias("deal_date"), "event_type", F.lit(1).alias("quantity"),
                                 F.col("value").alias("price"))
    bulk = e.where("event_type = 'purchase'").withColumn("side", F.lit("BUY")).drop("event_type")
    block = e.where("event_type = 'error'").withColumn("side", F.lit("sell")).drop("event_type")
    return ev.daily_net_notional(bulk, block, None)


@query("deal_anomaly", """WITH d AS (SELECT user_id AS symbol, CAST(ts AS DATE) AS deal_date,
    sum(CASE event_type WHEN 'purchase' THEN value ELSE -value END) AS n FROM events WHERE event_type IN ('purchase', 'error') GROUP BY 1, 2),
  t AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY deal_date DESC) <= 20)
  SELECT symbol, max(deal_date) AS deal_date, round(arg_max(n, deal_date), 4) AS net_notional,
  round(CASE WHEN stddev_samp(n) = 0 THEN 0 ELSE (arg_max(n, deal_date) - avg(n)) / stddev_samp(n) END, 6) AS notional_zscore,
  count(*) AS n_obs, max(deal_date) AS as_of_date FROM t GROUP BY symbol""")
def deal_anomaly(spark, sf):
    return ev.deal_anomaly(deals(spark, sf), 20).withColumn("net_notional", F.round("net_notional", 4)) \
        .withColumn("notional_zscore", F.round("notional_zscore", 6))


def positions(spark, sf):
    o = table(spark, sf, "orders").where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    return o.groupBy(F.to_date("o_orderdate").alias("trade_date"), F.when(F.col("o_orderpriority") == "1-URGENT", "FII").otherwise("DII").alias("client_type")) \
        .agg(F.count_if(F.col("o_orderstatus") == "O").alias("total_long"), F.count_if(F.col("o_orderstatus") == "F").alias("total_short"))


@query("client_divergence", """WITH p AS (SELECT CAST(o_orderdate AS DATE) AS trade_date, CASE o_orderpriority WHEN '1-URGENT' THEN 'FII' ELSE 'DII' END AS c,
    count(*) FILTER (o_orderstatus = 'O') - count(*) FILTER (o_orderstatus = 'F') AS net FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY 1, 2),
  w AS (SELECT trade_date, max(net) FILTER (c = 'FII') AS f, max(net) FILTER (c = 'DII') AS d FROM p GROUP BY 1)
  SELECT trade_date, f AS fii_net_contracts, d AS dii_net_contracts, CAST(coalesce(sign(f), 0) AS INTEGER) AS fii_direction,
  CAST(coalesce(sign(d), 0) AS INTEGER) AS dii_direction, coalesce(sign(f), 0) <> coalesce(sign(d), 0) AS divergence_flag FROM w""")
def client_divergence(spark, sf):
    return ev.client_divergence(positions(spark, sf))


@query("holding_change", """WITH r AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS quarter_end, o_totalprice AS holding,
    lag(o_totalprice) OVER w AS prev_holding FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey)),
  l AS (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) = 1)
  SELECT r.o_custkey AS symbol, quarter_end, holding, prev_holding, round(holding - prev_holding, 2) AS change_pct_points
  FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY quarter_end DESC, ok DESC) AS rn FROM
    (SELECT o_custkey, o_orderkey AS ok, CAST(o_orderdate AS DATE) AS quarter_end, o_totalprice AS holding,
     lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey) AS prev_holding FROM orders)) r
  WHERE rn = 1 AND prev_holding IS NOT NULL""")
def holding_change(spark, sf):
    h = table(spark, sf, "orders").select(F.col("o_custkey").alias("symbol"), F.to_date("o_orderdate").alias("quarter_end"),
                                          F.col("o_totalprice").alias("holding"), "o_orderkey")
    return ev.holding_change(h, ties=["o_orderkey"]).withColumn("change_pct_points", F.round("change_pct_points", 2))


METRICS = {"long": ("AO", "N|R", "a"), "short": ("AF", "N|R", "b"), "call": ("RO", "N|A", "a"), "put": ("RF", "N|A", "b")}


def two_sources(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("d", F.to_date(F.date_trunc("month", "l_shipdate")))
    c = F.concat("l_returnflag", "l_linestatus")
    wide = li.groupBy(F.col("d").alias("trade_date")).agg(*[F.sum(F.when(c == x, F.col("l_quantity"))).alias(x) for x in ("AO", "AF", "RO", "RF")])
    seg = li.where("l_returnflag <> 'N'").withColumn("segment", F.concat(F.lit("N|"), F.when(F.col("l_returnflag") == "A", "R").otherwise("A")))
    long = seg.groupBy(F.col("d").alias("trade_date"), "segment").agg(
        F.sum(F.when(F.col("l_linestatus") == "O", F.col("l_quantity"))).alias("a"),
        F.sum(F.when((F.col("l_linestatus") == "F") & (F.col("l_linenumber") < 7), F.col("l_quantity"))).alias("b"))
    return wide, long


DIVERGENCE = """dv AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS trade_date,
    CASE l_returnflag || l_linestatus WHEN 'AO' THEN 'long' WHEN 'AF' THEN 'short' WHEN 'RO' THEN 'call' WHEN 'RF' THEN 'put' END AS metric,
    sum(l_quantity) AS nse_value, sum(CASE WHEN l_linestatus = 'O' OR l_linenumber < 7 THEN l_quantity END) AS upstox_value
  FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1, 2),
  div AS (SELECT *, abs(nse_value - upstox_value) AS abs_diff,
    round(abs(nse_value - upstox_value) / greatest(abs(nse_value), abs(upstox_value), 1) * 100, 6) AS pct_diff,
    abs(nse_value - upstox_value) / greatest(abs(nse_value), abs(upstox_value), 1) * 100 > 1 AS diverges FROM dv WHERE upstox_value IS NOT NULL)"""


@query("source_divergence", f"WITH {DIVERGENCE} SELECT * FROM div")
def source_divergence(spark, sf):
    return ev.source_divergence(*two_sources(spark, sf), METRICS).withColumn("pct_diff", F.round("pct_diff", 6))


@query("material_events", """WITH ann AS (SELECT event_id // 2 AS NEWSID, user_id AS SCRIP_CD, event_type AS subcatname, props AS headline, ts AS news_dt
    FROM events QUALIFY row_number() OVER (PARTITION BY event_id // 2 ORDER BY CAST(ts AS DATE) DESC, event_id DESC) = 1),
  sec AS (SELECT CAST(c_custkey AS VARCHAR) AS SCRIP_CD, 'IN' || c_custkey AS ISIN_NUMBER, c_name AS Scrip_Name FROM customer)
  SELECT NEWSID, CAST(ann.SCRIP_CD AS VARCHAR) AS SCRIP_CD, 'Company ' || ann.SCRIP_CD AS company_name, subcatname, headline, news_dt, ISIN_NUMBER, Scrip_Name,
  CAST((SELECT max(news_dt) FROM ann) AS DATE) AS as_of_date FROM ann LEFT JOIN sec ON CAST(ann.SCRIP_CD AS VARCHAR) = sec.SCRIP_CD
  WHERE news_dt >= (SELECT max(news_dt) FROM ann) - INTERVAL 7 DAY AND subcatname IN ('error', 'signup')""")
def material_events(spark, sf):
    ann = events(spark, sf).select(
        F.expr("event_id div 2").alias("NEWSID"), F.col("user_id").alias("SCRIP_CD"), F.concat(F.lit("Company "), F.col("user_id").cast("string")).alias("company_name"),
        F.col("event_type").alias("subcatname"), F.col("props").alias("headline"), F.col("ts").alias("news_dt"),
        F.to_date("ts").alias("knowledge_date"), F.col("event_id").alias("_vintage_id"))
    master = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("SCRIP_CD"), F.concat(F.lit("IN"), F.col("c_custkey").cast("string")).alias("ISIN_NUMBER"),
        F.col("c_name").alias("Scrip_Name"), F.lit("2024-01-01").cast("date").alias("knowledge_date"), F.lit(0).alias("_vintage_id"))
    return ev.material_events(ann, master, subcategories=("error", "signup"))


@query("insider_transactions", """WITH o AS (SELECT l_orderkey, min(l_suppkey) AS cik, count(*) AS n FROM lineitem GROUP BY 1)
  SELECT CAST(l.l_orderkey AS VARCHAR) AS accn, o_custkey AS issuer_cik, o.cik AS owner_cik, o.n AS n_owners_on_filing,
  l_quantity AS shares, l_extendedprice AS price_per_share, round(l_quantity * l_extendedprice, 2) AS value_usd,
  CAST(l_shipdate AS DATE) AS trans_date, CAST(o_orderdate AS DATE) AS filed, CAST(CAST(o_orderdate AS DATE) - CAST(l_shipdate AS DATE) AS INTEGER) AS days_to_file,
  CASE l_returnflag WHEN 'A' THEN 'grant/award' ELSE 'unknown' END AS trans_desc, l_linestatus = 'O' AS is_common_stock, false AS is_open_market_buy,
  CASE o.cik % 4 WHEN 0 THEN 'officer' WHEN 1 THEN 'director' WHEN 2 THEN 'tenpercentowner' ELSE 'other' END AS role, o_orderstatus = 'P' AS plan_10b5_1
  FROM lineitem l LEFT JOIN orders ON l.l_orderkey = o_orderkey LEFT JOIN o ON o.l_orderkey = l.l_orderkey""")
def insider_transactions(spark, sf):
    li, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    acc = F.col("l_orderkey").cast("string").alias("ACCESSION_NUMBER")
    s = lambda c: F.col(c).cast("string")
    trans = li.select(acc, F.when(F.col("l_linestatus") == "O", "Common Stock").otherwise("Common and Preferred").alias("SECURITY_TITLE"),
                      F.col("l_returnflag").alias("TRANS_CODE"), F.lit("A").alias("TRANS_ACQUIRED_DISP_CD"), s("l_quantity").alias("TRANS_SHARES"),
                      s("l_extendedprice").alias("TRANS_PRICEPERSHARE"), F.lit(None).cast("string").alias("SHRS_OWND_FOLWNG_TRANS"),
                      F.lit("D").alias("DIRECT_INDIRECT_OWNERSHIP"), s("l_linenumber").alias("NONDERIV_TRANS_SK"),
                      F.upper(F.date_format("l_shipdate", "dd-MMM-yyyy")).alias("TRANS_DATE"))
    subs = o.select(s("o_orderkey").alias("ACCESSION_NUMBER"), F.lit("4").alias("DOCUMENT_TYPE"), s("o_custkey").alias("ISSUERCIK"),
                    F.lit("x").alias("ISSUERNAME"), F.lit("y").alias("ISSUERTRADINGSYMBOL"), F.upper(F.date_format("o_orderdate", "dd-MMM-yyyy")).alias("FILING_DATE"),
                    F.when(F.col("o_orderstatus") == "P", "1").otherwise("0").alias("AFF10B5ONE"))
    kind = F.element_at(F.array(F.lit("Officer,Director"), F.lit("Director"), F.lit("TenPercentOwner"), F.lit("Other")), (F.col("l_suppkey") % 4 + 1).cast("int"))
    own = li.select(acc, F.lpad(s("l_suppkey"), 10, "0").alias("RPTOWNERCIK"), F.lit("n").alias("RPTOWNERNAME"), kind.alias("RPTOWNER_RELATIONSHIP"),
                    F.lit("t").alias("RPTOWNER_TITLE"))
    return ins.insider_transactions(trans, subs, own, "2024Q1").select(
        "accn", "issuer_cik", "owner_cik", "n_owners_on_filing", "shares", "price_per_share", F.round("value_usd", 2).alias("value_usd"), "trans_date", "filed",
        "days_to_file", "trans_desc", "is_common_stock", "is_open_market_buy", "role", "plan_10b5_1")


CLUSTERS = f"""{INSIDERS}, b AS (SELECT * FROM ins WHERE is_open_market_buy AND value_usd >= 2000 AND is_common_stock
    QUALIFY row_number() OVER (PARTITION BY issuer_cik, trans_date, shares, price_per_share ORDER BY filed, accn) = 1),
  anchor AS (SELECT DISTINCT issuer_cik, trans_date FROM b),
  win AS (SELECT a.issuer_cik, a.trans_date AS window_start, count(DISTINCT owner_cik) AS n_insiders, count(*) AS n_transactions, sum(value_usd) AS total_value_usd,
    count(DISTINCT owner_cik) FILTER (role = 'officer') AS n_officers, count(DISTINCT owner_cik) FILTER (role = 'director') AS n_directors, min(filed) AS first_filed
    FROM anchor a JOIN b ON a.issuer_cik = b.issuer_cik AND b.trans_date BETWEEN a.trans_date AND a.trans_date + 5 GROUP BY 1, 2),
  clu AS (SELECT issuer_cik, 'Issuer ' || issuer_cik AS issuer_name, 'T' || issuer_cik AS ticker, window_start, window_start + 5 AS window_end, n_insiders, n_transactions,
    round(total_value_usd, 2) AS total_value_usd, n_officers, n_directors, first_filed, 5 AS window_days, 3 AS min_insiders
    FROM win WHERE n_insiders >= 3 QUALIFY row_number() OVER (PARTITION BY issuer_cik ORDER BY window_start) = 1)"""


@query("cluster_buys", f"WITH {CLUSTERS} SELECT * FROM clu")
def cluster_buys(spark, sf):
    return ins.cluster_buys(insider_buys(spark, sf), window_days=5, min_insiders=3, min_value=2000.0).withColumn(
        "total_value_usd", F.round("total_value_usd", 2))
