"""The driver's tables in the shapes the operators take, each with its SQL twin.

Every binding reads a whole table. The SQL text is a CTE body used by the checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import materialise

PROXY = "S1"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# -- P: monthly prices per supplier ------------------------------------------------

def prices(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return (
        li.groupBy(F.col("l_suppkey"), F.to_date(F.date_trunc("month", "l_shipdate")).alias("trade_date"))
        .agg(F.sum("l_extendedprice").alias("v"), F.sum("l_quantity").alias("volume"))
        .select(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("symbol"),
                F.concat(F.lit("I"), F.col("l_suppkey").cast("string")).alias("isin"),
                F.lit("EQ").alias("series"), "trade_date",
                (F.col("v") / F.col("volume")).alias("close"), "volume")
    )


def stored_prices(spark: SparkSession, sf: str) -> DataFrame:
    """The price panel computed once, for queries that read it in several branches. It has a
    row per (symbol, month), however many trades feed it."""
    return materialise(prices(spark, sf))


PRICES = """px AS (
  SELECT 'S' || l_suppkey AS symbol, 'I' || l_suppkey AS isin, 'EQ' AS series,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS trade_date,
         sum(l_extendedprice) / sum(l_quantity) AS close, sum(l_quantity) AS volume
  FROM lineitem GROUP BY l_suppkey, CAST(date_trunc('month', l_shipdate) AS DATE))"""
RETURNS = PRICES + """, ret AS (
  SELECT *, ln(close / lag(close) OVER (PARTITION BY symbol ORDER BY trade_date)) AS log_return FROM px)"""
UNIVERSE = """uni AS (
  SELECT symbol, isin, trade_date, close, volume, close * volume AS turnover FROM px
  WHERE trade_date = (SELECT max(trade_date) FROM px))"""


def market_caps(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        F.concat(F.lit("I"), F.col("s_suppkey").cast("string")).alias("isin"),
        F.col("s_acctbal").cast("string").alias("market_cap"))


MARKET_CAPS = "caps AS (SELECT 'I' || s_suppkey AS isin, s_acctbal AS market_cap FROM supplier)"


def industries(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation")
    region = table(spark, sf, "region")
    return (
        table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("symbol"),
                F.col("r_name").alias("industry"))
    )


INDUSTRIES = """ind AS (SELECT 'S' || s_suppkey AS symbol, r_name AS industry
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


# -- V: vintages of orders ---------------------------------------------------------

VKEY = ("o_custkey", "o_orderpriority")


def vintages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_custkey", "o_orderpriority", F.to_date("o_orderdate").alias("knowledge_date"),
        F.col("o_orderkey").alias("_vintage_id"), F.col("o_totalprice").alias("value"), "o_orderstatus")


VINTAGES = """vin AS (SELECT o_custkey, o_orderpriority, CAST(o_orderdate AS DATE) AS knowledge_date,
  o_orderkey AS _vintage_id, o_totalprice AS value, o_orderstatus FROM orders)"""


# -- T: daily transits per corridor ------------------------------------------------

def transits(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.groupBy(F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("portname")).agg(
        F.count(F.lit(1)).cast("double").alias("n_total"),
        F.count_if(F.col("o_orderstatus") == "O").cast("double").alias("n_cargo"),
        F.count_if(F.col("o_orderstatus") == "F").cast("double").alias("n_tanker"),
        F.round(F.sum("o_totalprice"), 2).alias("capacity"))


TRANSITS = """tr AS (SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS portname,
  CAST(count(*) AS DOUBLE) AS n_total,
  CAST(count(*) FILTER (o_orderstatus = 'O') AS DOUBLE) AS n_cargo,
  CAST(count(*) FILTER (o_orderstatus = 'F') AS DOUBLE) AS n_tanker,
  round(sum(o_totalprice), 2) AS capacity FROM orders GROUP BY 1, 2)"""

SUBSTITUTES = {"1-URGENT": "2-HIGH", "3-MEDIUM": "2-HIGH", "4-NOT SPECIFIED": None, "5-LOW": "1-URGENT"}


# -- E: events ---------------------------------------------------------------------

def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events")


def insider_buys(spark: SparkSession, sf: str) -> DataFrame:
    """Events as insider transactions: twenty owners to an issuer, one owner per user."""
    e = events(spark, sf)
    role = F.when(F.col("user_id") % 3 == 0, "officer").when(F.col("user_id") % 3 == 1, "director").otherwise("other")
    shares = F.floor(F.col("value")).cast("double")
    return e.select(
        F.expr("user_id div 20").alias("issuer_cik"),
        F.concat(F.lit("Issuer "), F.expr("user_id div 20").cast("string")).alias("issuer_name"),
        F.concat(F.lit("T"), F.expr("user_id div 20").cast("string")).alias("ticker"),
        F.col("user_id").alias("owner_cik"), role.alias("role"),
        F.to_date("ts").alias("trans_date"), F.date_add(F.to_date("ts"), 2).alias("filed"),
        F.col("event_id").cast("string").alias("accn"), shares.alias("shares"),
        F.lit(100.0).alias("price_per_share"), (shares * 100.0).alias("value_usd"),
        (F.col("event_type") == "purchase").alias("is_open_market_buy"),
        (F.col("user_id") % 7 != 0).alias("is_common_stock"))


INSIDERS = """ins AS (SELECT user_id // 20 AS issuer_cik, 'Issuer ' || (user_id // 20) AS issuer_name,
  'T' || (user_id // 20) AS ticker, user_id AS owner_cik,
  CASE user_id % 3 WHEN 0 THEN 'officer' WHEN 1 THEN 'director' ELSE 'other' END AS role,
  CAST(ts AS DATE) AS trans_date, CAST(ts AS DATE) + 2 AS filed, CAST(event_id AS VARCHAR) AS accn,
  floor(value) AS shares, 100.0::DOUBLE AS price_per_share, floor(value) * 100.0::DOUBLE AS value_usd,
  event_type = 'purchase' AS is_open_market_buy, user_id % 7 <> 0 AS is_common_stock FROM events)"""


# -- F: long facts -----------------------------------------------------------------

def facts(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    month = F.to_date(F.date_trunc("month", "l_shipdate"))
    return li.select(
        F.col("l_suppkey").alias("cik"), F.concat(F.lit("Entity "), F.col("l_suppkey").cast("string")).alias("entity"),
        F.when(F.col("l_returnflag") == "N", "us-gaap").otherwise("ecd").alias("taxonomy"),
        F.concat("l_returnflag", "l_linestatus").alias("concept"), F.lit("USD").alias("unit"),
        F.when(F.col("l_linestatus") == "O", month).alias("start"), F.last_day(F.col("l_shipdate").cast("date")).alias("end"),
        F.col("l_quantity").alias("value"), F.col("l_extendedprice").alias("price"),
        F.to_date("l_shipdate").alias("filed"),
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"),
                 F.lit("-"), F.col("l_partkey").cast("string")).alias("accn"),
        F.when(F.col("l_linestatus") == "O", "10-Q").otherwise("10-K").alias("form"))


FACTS = """fx AS (SELECT l_suppkey AS cik, 'Entity ' || l_suppkey AS entity,
  CASE WHEN l_returnflag = 'N' THEN 'us-gaap' ELSE 'ecd' END AS taxonomy,
  l_returnflag || l_linestatus AS concept, 'USD' AS unit,
  CASE WHEN l_linestatus = 'O' THEN CAST(date_trunc('month', l_shipdate) AS DATE) END AS start,
  last_day(CAST(l_shipdate AS DATE)) AS "end", l_quantity AS value, l_extendedprice AS price,
  CAST(l_shipdate AS DATE) AS filed, l_orderkey || '-' || l_linenumber || '-' || l_partkey AS accn,
  CASE WHEN l_linestatus = 'O' THEN '10-Q' ELSE '10-K' END AS form FROM lineitem)"""


# -- O: options --------------------------------------------------------------------

SPOT, RATE = 950.0, 0.0525


def options(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").select(
        F.col("p_partkey"), F.col("p_retailprice").alias("strike"),
        (F.col("p_size") / 365.0).alias("t"), (F.lit(0.10) + (F.col("p_partkey") % 40) / 100.0).alias("sigma"))
    return p.select("p_partkey", "strike", "t", "sigma", F.lit(SPOT).alias("spot"), F.lit(RATE).alias("rate"),
                    F.explode(F.array(F.lit("C"), F.lit("P"))).alias("right"))


OPTIONS = f"""opt AS (SELECT p_partkey, p_retailprice AS strike, p_size / 365.0::DOUBLE AS t,
  0.10::DOUBLE + (p_partkey % 40) / 100.0::DOUBLE AS sigma, {SPOT}::DOUBLE AS spot, {RATE}::DOUBLE AS rate,
  unnest(['C', 'P']) AS "right" FROM part)"""


# -- R: rainfall -------------------------------------------------------------------

def rainfall(spark: SparkSession, sf: str, primary: bool | None = None) -> DataFrame:
    """Daily regional totals. ``primary`` picks one of two instruments by return flag."""
    li = table(spark, sf, "lineitem")
    if primary is not None:
        li = li.where((F.col("l_returnflag") == "N") if primary else (F.col("l_returnflag") != "N"))
    s = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")) \
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("s_suppkey", "r_name")
    # Summed per supplier before the region is attached: the join then carries one row
    # per (supplier, day) and no region's share of the raw rows matters.
    daily = li.groupBy("l_suppkey", F.to_date("l_shipdate").alias("date")).agg(F.sum("l_quantity").alias("q"))
    return daily.join(s, F.col("l_suppkey") == F.col("s_suppkey")) \
        .groupBy("date", F.col("r_name").alias("region")).agg(F.sum("q").alias("rain_mm_per_day"))


def stored_rainfall(spark: SparkSession, sf: str, primary: bool | None = None) -> DataFrame:
    """Daily regional totals computed once: a row per (day, region)."""
    return materialise(rainfall(spark, sf, primary))


def rainfall_sql(name: str, condition: str = "true") -> str:
    return f"""{name} AS (SELECT CAST(l_shipdate AS DATE) AS date, r_name AS region, sum(l_quantity) AS rain_mm_per_day
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey WHERE {condition} GROUP BY 1, 2)"""
