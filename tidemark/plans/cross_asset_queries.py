"""Commodity and macro legs built from orders and lineitems."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import cross_asset as ca
from tidemark.operators.prices import level_change
from tidemark.plans.bindings import PRICES, PROXY, prices, table
from tidemark.plans.registry import query


def legs(spark, sf):
    """One price series per order priority: the mean order value of each month."""
    o = table(spark, sf, "orders")
    return o.groupBy(F.col("o_orderpriority").alias("leg"), F.to_date(F.date_trunc("month", "o_orderdate")).alias("trade_date")) \
        .agg(F.avg("o_totalprice").alias("value"))


LEGS = """legs AS (SELECT o_orderpriority AS leg, CAST(date_trunc('month', o_orderdate) AS DATE) AS trade_date,
  avg(o_totalprice) AS value FROM orders GROUP BY 1, 2)"""
CHANGES = """chg AS (SELECT leg, trade_date, CASE WHEN leg = '5-LOW' THEN value - lag(value) OVER w ELSE ln(value / lag(value) OVER w) END AS change
    FROM legs WINDOW w AS (PARTITION BY leg ORDER BY trade_date)),
  tl AS (SELECT * FROM chg WHERE change IS NOT NULL QUALIFY row_number() OVER (PARTITION BY leg ORDER BY trade_date DESC) <= 60)"""


def proxy_closes(spark, sf):
    return prices(spark, sf).where(F.col("symbol") == PROXY).select("trade_date", "close")


@query("equity_commodity_correlation", f"""WITH {PRICES}, {LEGS}, {CHANGES},
  eq0 AS (SELECT trade_date, ln(close / lag(close) OVER (ORDER BY trade_date)) AS e FROM px WHERE symbol = '{PROXY}'),
  eq AS (SELECT * FROM eq0 WHERE e IS NOT NULL ORDER BY trade_date DESC LIMIT 60)
  SELECT '{PROXY}' AS asset_a, leg AS asset_b, round(corr(e, change), 6) AS correlation, count(*) AS n_obs, 60 AS window_days,
  max(trade_date) AS as_of_date FROM tl JOIN eq USING (trade_date) GROUP BY leg HAVING count(*) >= 10""")
def equity_commodity_correlation(spark, sf):
    return ca.equity_commodity_correlation(proxy_closes(spark, sf), legs(spark, sf), PROXY, diff_legs=["5-LOW"]) \
        .withColumn("correlation", F.round("correlation", 6))


def daily_orders(spark, sf, status):
    o = table(spark, sf, "orders").where(F.col("o_orderstatus") == status)
    return o.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.avg("o_totalprice").alias("value"))


@query("monthly_last", """WITH d AS (SELECT o_orderstatus AS status, CAST(o_orderdate AS DATE) AS day, max(o_totalprice) AS value FROM orders GROUP BY 1, 2)
  SELECT status, last_day(day) AS month_end, arg_max(value, day) AS value FROM d GROUP BY 1, 2""")
def monthly_last(spark, sf):
    d = table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("status"), F.to_date("o_orderdate").alias("day")) \
        .agg(F.max("o_totalprice").alias("value"))
    return ca.monthly_last(d, ["status"], "day", "value")


def _leg_sql(status: str, change: str) -> str:
    return f"""SELECT '{status}' AS leg, m, {change} AS c FROM (SELECT last_day(day) AS m, arg_max(v, day) AS v FROM
      (SELECT CAST(o_orderdate AS DATE) AS day, avg(o_totalprice) AS v FROM orders WHERE o_orderstatus = '{status}' GROUP BY 1) GROUP BY 1)
      WINDOW w AS (ORDER BY m)"""


@query("equity_macro_correlation", f"""WITH {PRICES},
  e AS (SELECT last_day(trade_date) AS m, ln(close / lag(close) OVER (ORDER BY trade_date)) AS e FROM px WHERE symbol = '{PROXY}'),
  l AS ({_leg_sql('O', '(v - lag(v) OVER w) * 100')} UNION ALL {_leg_sql('F', 'v / lag(v) OVER w - 1')} UNION ALL {_leg_sql('P', 'ln(v / lag(v) OVER w)')})
  SELECT '{PROXY}' AS equity_symbol, leg AS macro_series, round(corr(e, c), 6) AS correlation, count(*) AS n_obs, max(m) AS as_of_date
  FROM l JOIN e USING (m) WHERE c IS NOT NULL AND e IS NOT NULL GROUP BY leg HAVING count(*) >= 6""")
def equity_macro_correlation(spark, sf):
    macro = {s: (daily_orders(spark, sf, s), kind) for s, kind in (("O", "bps"), ("F", "pct"), ("P", "log"))}
    return ca.equity_macro_correlation(proxy_closes(spark, sf), macro, PROXY).withColumn("correlation", F.round("correlation", 6))


def curve(spark, sf):
    """Daily futures curve: one contract per line number, ordered by it."""
    li = table(spark, sf, "lineitem")
    return li.groupBy(F.to_date("l_shipdate").alias("trade_date_requested"), F.col("l_linenumber").alias("contract_order")) \
        .agg(F.max("l_extendedprice").alias("settle_num")) \
        .withColumn("month", F.concat(F.lit("M"), F.col("contract_order").cast("string"))).withColumn("is_total", F.col("contract_order") == 7)


CURVE = """crv AS (SELECT CAST(l_shipdate AS DATE) AS d, l_linenumber AS k, max(l_extendedprice) AS s FROM lineitem GROUP BY 1, 2)"""


@query("front_month_by_order", f"""WITH {CURVE} SELECT d AS trade_date_requested, arg_min(s, k) AS settle, 'M' || min(k) AS contract
  FROM crv WHERE k <> 7 GROUP BY d""")
def front_month_by_order(spark, sf):
    return ca.front_by_order(curve(spark, sf))


@query("front_month_by_expiry", """WITH q AS (SELECT CAST(o_orderdate AS DATE) AS trade_date, o_orderkey,
    strftime(CAST(o_orderdate AS DATE) + CAST(30 * (o_custkey % 6) + 10 AS INTEGER), '%d%b%Y') AS ExpiryDate, o_totalprice AS close FROM orders)
  SELECT trade_date, upper(ExpiryDate) AS ExpiryDate, close FROM q
  QUALIFY row_number() OVER (PARTITION BY trade_date ORDER BY strptime(ExpiryDate, '%d%b%Y'), o_orderkey) = 1""")
def front_month_by_expiry(spark, sf):
    q = table(spark, sf, "orders").select(
        F.to_date("o_orderdate").alias("trade_date"), "o_orderkey",
        F.upper(F.date_format(F.date_add(F.to_date("o_orderdate"), (F.col("o_custkey") % 6 * 30 + 10).cast("int")), "ddMMMyyyy")).alias("ExpiryDate"),
        F.col("o_totalprice").alias("close"))
    return ca.front_by_expiry(q, ties=["o_orderkey"]).select("trade_date", "ExpiryDate", "close")


@query("reference_rate", """SELECT CAST(o_orderdate AS DATE) AS rate_date, o_totalprice AS usdinr FROM orders WHERE lower(o_orderpriority) LIKE '%urg%'""")
def reference_rate(spark, sf):
    ind = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("indicator"), F.to_date("o_orderdate").alias("as_of"),
                                            F.col("o_totalprice").alias("value"))
    return ca.reference_rate(ind, "urg")


@query("gold_premium", f"""WITH {CURVE}, front AS (SELECT d, arg_min(s, k) AS oz, 'M' || min(k) AS contract FROM crv WHERE k <> 7 GROUP BY d),
  ib AS (SELECT CAST(o_orderdate AS DATE) AS d, o_orderpriority AS session, max(o_totalprice) AS p FROM orders GROUP BY 1, 2),
  fx AS (SELECT CAST(o_orderdate AS DATE) AS d, max(o_custkey) / 10.0::DOUBLE AS r FROM orders GROUP BY 1),
  j AS (SELECT ib.d, session, p, oz, contract, r, oz * r / 31.1034768::DOUBLE * 10 AS inr FROM ib JOIN front USING (d) JOIN fx ON fx.d = ib.d)
  SELECT d AS rate_date, session, p AS ibja_999, oz AS comex_usd_per_oz, contract AS comex_contract, r AS usdinr,
  round(inr, 4) AS comex_inr_per_10g, round(p - inr * 1.06::DOUBLE * 1.03::DOUBLE, 4) AS premium_inr_per_10g,
  round((p - inr * 1.06::DOUBLE * 1.03::DOUBLE) / (inr * 1.06::DOUBLE * 1.03::DOUBLE) * 100, 6) AS premium_pct FROM j""")
def gold_premium(spark, sf):
    o = table(spark, sf, "orders")
    day = F.to_date("o_orderdate").alias("rate_date")
    ibja = o.groupBy(day, F.col("o_orderpriority").alias("session")).agg(F.max("o_totalprice").alias("ibja_999"))
    fx = o.groupBy(day).agg((F.max("o_custkey") / 10.0).alias("usdinr"))
    return ca.gold_premium(ibja, curve(spark, sf), fx).select(
        "rate_date", "session", "ibja_999", "comex_usd_per_oz", "comex_contract", "usdinr", F.round("comex_inr_per_10g", 4).alias("comex_inr_per_10g"),
        F.round("premium_inr_per_10g", 4).alias("premium_inr_per_10g"), F.round("premium_pct", 6).alias("premium_pct"))


@query("week_on_week_change", """WITH w AS (SELECT o_orderpriority AS component, CAST(date_trunc('week', o_orderdate) AS DATE) AS week, round(sum(o_totalprice), 2) AS amount
    FROM orders GROUP BY 1, 2) SELECT component, week, amount, lag(amount) OVER x AS previous_amount, round(amount - lag(amount) OVER x, 2) AS change
  FROM w WINDOW x AS (PARTITION BY component ORDER BY week)""")
def week_on_week_change(spark, sf):
    w = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("component"), F.to_date(F.date_trunc("week", "o_orderdate")).alias("week")) \
        .agg(F.round(F.sum("o_totalprice"), 2).alias("amount"))
    return level_change(w, ["component"], "week", "amount").withColumn("change", F.round("change", 2))
