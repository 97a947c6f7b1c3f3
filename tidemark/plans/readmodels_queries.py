"""Screen shapes over the bindings."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import correlation as corr
from tidemark.operators import digest as dg
from tidemark.operators import filings as fl
from tidemark.operators import readmodels as rm
from tidemark.operators import supply_chain as sc
from tidemark.operators.insider import cluster_buys
from tidemark.operators import prices as px
from tidemark.operators import monsoon as mo
from tidemark.plans.bindings import (INDUSTRIES, PRICES, RETURNS, SUBSTITUTES, UNIVERSE, events, industries, insider_buys, prices, stored_prices, stored_rainfall, table, transits)
from tidemark.plans.cross_asset_queries import CURVE, curve
from tidemark.plans.events_queries import CLUSTERS, DIVERGENCE, METRICS, two_sources
from tidemark.plans.facts_queries import LINES, PAYTSR, SFACTS, _canon_sql, _label_sql, ITEM, pay, statement_rows
from tidemark.plans.filings_queries import HEADING, ITEMS, RATINGS, filings, headings
from tidemark.plans.prices_queries import FACTORS, PAIRS, factors, pairs, WATCHED
from tidemark.plans.rainfall_queries import MAIN, NORMALS, OTHER, PROGRESS, YEARS, _sums
from tidemark.plans.registry import query
from tidemark.plans.transits_queries import BREAKS, DEVIATION, REGIME, REROUTE, dated, shifted
from tidemark.operators.events import source_divergence
from tidemark.operators.asof import latest_per


def bars(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("symbol"), F.to_date("l_shipdate").alias("trade_date"),
                     F.round("l_extendedprice", 2).alias("close"), F.col("l_quantity").alias("volume"), F.col("l_orderkey").alias("known"), "l_linenumber", "l_partkey", "l_returnflag")


@query("price_history", """WITH b AS (SELECT CAST(l_shipdate AS DATE) AS trade_date, l_extendedprice AS close, l_quantity AS volume, l_orderkey, l_linenumber, l_partkey, l_returnflag FROM lineitem WHERE l_suppkey = 7),
  p AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY trade_date ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC) = 1),
  d AS (SELECT * FROM b WHERE l_returnflag = 'N' QUALIFY row_number() OVER (PARTITION BY trade_date ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC) = 1)
  SELECT 'S7' AS symbol, trade_date, p.close, p.volume, d.volume AS delivered_qty, round(d.volume / 50 * 100, 4) AS delivered_pct FROM p LEFT JOIN d USING (trade_date)""")
def price_history(spark, sf):
    b = bars(spark, sf)
    d = b.where("l_returnflag = 'N'").withColumn("delivered_qty", F.col("volume")).withColumn("delivered_pct", F.round(F.col("volume") / 50 * 100, 4))
    return rm.price_history(b.drop("l_returnflag"), d, "S7", known="known", order=("l_linenumber", "l_partkey"))


@query("signal_stack", f"""WITH {FACTORS} SELECT symbol, 'Factor composite' AS signal, round(composite_score, 6) AS value, 'momentum_zscore' AS context_name, as_of_date FROM fm
  UNION ALL SELECT symbol, 'Low volatility', round(low_vol_score, 6), 'realized_vol', as_of_date FROM lowvol""")
def signal_stack(spark, sf):
    known = lambda df: df.withColumn("knowledge_date", F.col("as_of_date")).withColumn("_vintage_id", F.lit(1))
    tables = {"derived_factor_model": known(factors(spark, sf)), "derived_low_vol_factor": known(px.low_vol_factor(stored_prices(spark, sf)))}
    return rm.signal_stack(tables).withColumn("value", F.round("value", 6)).drop("context_value")


@query("event_tape", """SELECT ts, kind, headline, detail FROM (SELECT ts, 'insider' AS kind, 'user ' || user_id AS headline, props AS detail FROM events WHERE event_type = 'signup'
    UNION ALL SELECT ts, 'bulk deal', 'user ' || user_id || ' BUY', 'qty 1' FROM events WHERE event_type = 'purchase'
    UNION ALL SELECT o_orderdate, 'announcement', o_orderpriority, CAST(o_orderkey AS VARCHAR) FROM orders) ORDER BY ts DESC, kind, headline, detail LIMIT 2000""")
def event_tape(spark, sf):
    e = events(spark, sf)
    user = F.concat(F.lit("user "), F.col("user_id").cast("string"))
    a = e.where("event_type = 'signup'").select("ts", F.lit("insider").alias("kind"), user.alias("headline"), F.col("props").alias("detail"))
    b = e.where("event_type = 'purchase'").select("ts", F.lit("bulk deal").alias("kind"), F.concat(user, F.lit(" BUY")).alias("headline"), F.lit("qty 1").alias("detail"))
    c = table(spark, sf, "orders").select(F.col("o_orderdate").alias("ts"), F.lit("announcement").alias("kind"), F.col("o_orderpriority").alias("headline"),
                                          F.col("o_orderkey").cast("string").alias("detail"))
    return rm.event_tape([a, b, c], 2000)


@query("statement_for_symbol", f"""WITH {SFACTS.replace('FROM lineitem)', "FROM lineitem WHERE l_suppkey = 7 QUALIFY dense_rank() OVER (PARTITION BY l_orderkey ORDER BY CAST(l_shipdate AS DATE) DESC, l_linenumber DESC) = 1)")}
  SELECT symbol, period_end, item, round(value / 10000000, 2) AS value, CAST({ITEM} AS INTEGER) AS position, {_label_sql(True)} AS period FROM ({_canon_sql('CAST(period_end - period_start AS INTEGER) <= 100')})""")
def statement_for_symbol(spark, sf):
    stamped = statement_rows(spark, sf).withColumn("knowledge_date", F.col("filed")).withColumnRenamed("line", "_vintage_id")
    return rm.statement_for(stamped, 7, "income", document="doc", newest_by=("filed", "doc"), lines=LINES)


@query("universe_members", f"""WITH {PRICES}, {INDUSTRIES} SELECT DISTINCT px.symbol, isin, i.industry, CASE WHEN i.industry IS NOT NULL THEN 'TOP' END AS index_membership
  FROM px LEFT JOIN (SELECT * FROM ind WHERE industry IN ('ASIA', 'EUROPE')) i ON i.symbol = px.symbol""")
def universe_members(spark, sf):
    members = industries(spark, sf).where(F.col("industry").isin("ASIA", "EUROPE")).withColumn("index_membership", F.lit("TOP"))
    return rm.universe_members(prices(spark, sf), members)


@query("watchlist_rank", f"""WITH {FACTORS} SELECT symbol, round(composite_score, 6) AS composite_score, CASE WHEN symbol IN {WATCHED} THEN 'watchlist' END AS tier FROM fm
  ORDER BY abs(fm.composite_score) DESC, symbol LIMIT 30""")
def watchlist_rank(spark, sf):
    f = factors(spark, sf)
    digest = dg.two_tiers(f, 0, WATCHED).select("symbol", "tier")
    return rm.watchlist_rank(f, digest, 30).select("symbol", F.round("composite_score", 6).alias("composite_score"), "tier")


@query("correlation_subset", f"""WITH {RETURNS}, {PAIRS} SELECT symbol_a, symbol_b, round(correlation, 6) AS correlation, n_obs FROM pairs
  WHERE symbol_a IN ('S1', 'S2', 'S3', 'S10', 'S44') AND symbol_b IN ('S1', 'S2', 'S3', 'S10', 'S44')""")
def correlation_subset(spark, sf):
    symbols = ["s1", "S2", "S3", "S10", "S44"]
    wanted = spark.createDataFrame([(s.upper(),) for s in symbols], "symbol string")
    stored = pairs(spark, sf, only=wanted).withColumn("knowledge_date", F.col("as_of_date")).withColumn("_vintage_id", F.lit(1))
    return corr.correlation_subset(stored, symbols).drop("as_of_date").withColumn("correlation", F.round("correlation", 6))


@query("macro_snapshot", f"""WITH {DEVIATION}, ki AS (SELECT o_orderpriority AS indicator, CAST(o_orderdate AS DATE) AS as_of, o_orderkey, o_totalprice AS value FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) = 1)
  SELECT 'policy' AS "group", indicator AS label, value, 'INR' AS unit, CAST(as_of AS VARCHAR) AS as_of FROM ki
  UNION ALL SELECT 'chokepoint', portname || ' (' || metric || ')', zscore, 'z', CAST(as_of AS VARCHAR) FROM dev WHERE abs(zscore) >= 0.05""")
def macro_snapshot(spark, sf):
    ki = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("indicator"), F.to_date("o_orderdate").alias("as_of"), F.lit("INR").alias("unit"),
                                           F.col("o_totalprice").alias("value"), F.to_date("o_orderdate").alias("knowledge_date"), F.col("o_orderkey").alias("_vintage_id"))
    newest = latest_per(ki, ["indicator", "as_of"], ["indicator"])
    return rm.macro_snapshot(newest, None, sc.deviation(transits(spark, sf)), stress=0.05)


@query("participants", """WITH w AS (SELECT CAST(o_orderdate AS DATE) AS trade_date, o_orderpriority AS client_type, count(*) FILTER (o_orderstatus = 'O') AS a, count(*) FILTER (o_orderstatus = 'F') AS b FROM orders GROUP BY 1, 2)
  SELECT trade_date, client_type, 'total' AS book, side, CAST(contracts AS DOUBLE) AS contracts FROM (SELECT trade_date, client_type, 'long' AS side, a AS contracts FROM w UNION ALL SELECT trade_date, client_type, 'short', b FROM w)""")
def participants(spark, sf):
    w = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("trade_date"), F.col("o_orderpriority").alias("Client Type")).agg(
        F.count_if(F.col("o_orderstatus") == "O").alias("Total Long Contracts"), F.count_if(F.col("o_orderstatus") == "F").alias("Total Short Contracts"))
    return rm.participants(w, limit=None, books={k: v for k, v in rm.BOOKS.items() if k.startswith("Total")})


def cash(spark, sf):
    o = table(spark, sf, "orders")
    return o.groupBy(F.col("o_orderpriority").alias("category"), F.upper(F.date_format("o_orderdate", "dd-MMM-yyyy")).alias("date")).agg(
        F.max("o_totalprice").cast("string").alias("buyValue"), F.when(F.min("o_custkey") > 100, F.min("o_custkey").cast("string")).otherwise("-").alias("sellValue"),
        F.max("o_custkey").cast("string").alias("netValue"))


CASHFLOW = """cf AS (SELECT o_orderpriority AS category, CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS buy_value,
  CASE WHEN min(o_custkey) > 100 THEN CAST(min(o_custkey) AS DOUBLE) END AS sell_value, CAST(max(o_custkey) AS DOUBLE) AS net_value FROM orders GROUP BY 1, 2)"""


@query("cash_flows", f"WITH {CASHFLOW} SELECT * FROM cf ORDER BY date DESC, category LIMIT 120")
def cash_flows(spark, sf):
    return rm.cash_flows(cash(spark, sf), 120)


@query("latest_cash_flows", f"WITH {CASHFLOW} SELECT * FROM cf QUALIFY row_number() OVER (PARTITION BY category ORDER BY date DESC, net_value DESC) = 1")
def latest_cash_flows(spark, sf):
    return rm.latest_cash_flows(cash(spark, sf))


@query("latest_divergence", f"WITH {DIVERGENCE} SELECT * FROM div QUALIFY row_number() OVER (PARTITION BY metric ORDER BY trade_date DESC) = 1")
def latest_divergence(spark, sf):
    return rm.latest_divergence(source_divergence(*two_sources(spark, sf), METRICS)).withColumn("pct_diff", F.round("pct_diff", 6))


@query("regimes_board", f"WITH {REROUTE}, {REGIME} SELECT portname, regime_start, regime_mean, z_vs_regime, vs_baseline_pct, substitute, absorbed_pct, interpretation FROM reg LEFT JOIN rr ON corridor = portname")
def regimes_board(spark, sf):
    cur = sc.current_regime(shifted(spark, sf), dated(spark))
    return rm.regimes(cur, sc.reroute_balance(sc.deviation(transits(spark, sf)), SUBSTITUTES)).select(
        "portname", "regime_start", "regime_mean", "z_vs_regime", "vs_baseline_pct", "substitute", "absorbed_pct", "interpretation")


@query("top_breaks", f"WITH RECURSIVE {BREAKS} SELECT * FROM breaks ORDER BY abs(change_per_day) DESC, portname, break_date LIMIT 40")
def top_breaks(spark, sf):
    return rm.top_breaks(sc.regime_breaks(shifted(spark, sf)), 40)


@query("transit_series", """SELECT CAST(o_orderdate AS DATE) AS date, CAST(count(*) AS DOUBLE) AS n_total FROM orders WHERE o_orderpriority = '2-HIGH' GROUP BY 1 ORDER BY 1 LIMIT 4000""")
def transit_series(spark, sf):
    return rm.transit_series(transits(spark, sf), "2-HIGH").select("date", "n_total")


@query("monsoon_board", f"""WITH {MAIN}, {OTHER}, {PROGRESS}, lt AS (SELECT max(date) AS d FROM (SELECT date FROM p UNION ALL SELECT date FROM s) WHERE month(date) BETWEEN 6 AND 9),
  {_sums('ps', 'p, lt', '(month(date) < month(d) OR (month(date) = month(d) AND day(date) <= day(d)))')}, {NORMALS}
  SELECT nm.region, round_even((o.cumulative_mm - normal_mm) / normal_mm * 100, 1) AS departure_pct, 'imd' AS basis, g.cumulative_mm, g.coverage_pct
  FROM nm, lt JOIN ps o ON o.year = year(d) JOIN prog g ON g.region = o.region WHERE o.region = nm.region""")
def monsoon_board(spark, sf):
    s = stored_rainfall(spark, sf, False)
    dep = mo.departure(stored_rainfall(spark, sf, True), s, YEARS, climatology=(1995, 1999)).select("region", "departure_pct", "basis")
    return dep.join(mo.progress(s).select("region", "cumulative_mm", "coverage_pct"), "region", "left")


def feeds(spark, sf):
    a = fl.rating_actions(headings(spark, sf)).withColumn("category", F.lit("x"))
    b = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("action_id"), F.col("s_name").alias("company_name"), F.lit("2000-05-05").cast("date").alias("rating_date"),
                                            F.lit("h").alias("heading"), F.lit(None).cast("string").alias("action_type"), F.lit("file").alias("category"))
    return {"ONE": a, "TWO": b}


BOARD = f"""{RATINGS}, ac AS (SELECT 'ONE' AS agency, CAST(action_id AS VARCHAR) AS action_id, company_name, rating_date, h AS heading, {HEADING} AS action_type, 'x' AS category FROM rd
  UNION ALL SELECT 'TWO', CAST(s_suppkey AS VARCHAR), s_name, DATE '2000-05-05', 'h', NULL, 'file' FROM supplier)"""


@query("rating_board", f"WITH {BOARD} SELECT * FROM ac WHERE contains(lower(company_name), 'r#0000000') ORDER BY rating_date DESC, agency, action_id LIMIT 300")
def rating_board(spark, sf):
    return rm.rating_board(feeds(spark, sf), "R#0000000", 300)


@query("listing_split", f"""WITH {BOARD}, l AS (SELECT upper(c_name) AS k FROM customer WHERE c_custkey % 3 = 0)
  SELECT action_type, CASE WHEN upper(company_name) IN (SELECT k FROM l) THEN 'Public (listed)' ELSE 'Private/unlisted' END AS listing_status, count(*) AS n FROM ac GROUP BY 1, 2""")
def listing_split(spark, sf):
    listed = fl.listed_names((table(spark, sf, "customer").where("c_custkey % 3 = 0"), "c_name"))
    return rm.listing_split(fl.tag_listing(rm.rating_board(feeds(spark, sf), limit=None), "company_name", listed))


@query("company_names", f"WITH {PRICES} SELECT DISTINCT symbol, s_name AS name FROM px JOIN supplier ON isin = 'I' || s_suppkey")
def company_names(spark, sf):
    master = table(spark, sf, "supplier").select(F.concat(F.lit("I"), F.col("s_suppkey").cast("string")).alias("isin"), F.col("s_name").alias("name"))
    return rm.company_names(prices(spark, sf), master)


@query("curve_of_day", f"WITH {CURVE} SELECT 'M' || k AS month, s AS settle_num FROM crv WHERE k <> 7 AND d = (SELECT max(d) FROM crv)")
def curve_of_day(spark, sf):
    return rm.curve_of_day(curve(spark, sf)).select("month", "settle_num")


@query("board_event_items", f"WITH {ITEMS} SELECT cik, accn, item, filed FROM items WHERE is_red_flag ORDER BY filed DESC, cik, accn, item LIMIT 100")
def board_event_items(spark, sf):
    return rm.board(fl.event_items(filings(spark, sf)), [F.desc("filed"), "cik", "accn", "item"], 100, "is_red_flag").select("cik", "accn", "item", "filed")


@query("board_clusters", f"WITH {CLUSTERS} SELECT issuer_cik, n_insiders, total_value_usd FROM clu ORDER BY total_value_usd DESC, issuer_cik LIMIT 10")
def board_clusters(spark, sf):
    c = cluster_buys(insider_buys(spark, sf), window_days=5, min_insiders=3, min_value=2000.0).withColumn("total_value_usd", F.round("total_value_usd", 2))
    return rm.board(c, [F.desc("total_value_usd"), "issuer_cik"], 10).select("issuer_cik", "n_insiders", "total_value_usd")


@query("board_pay", f"WITH {PAYTSR} SELECT cik, fiscal_year, pay_premium FROM pay WHERE pay_up_performance_down ORDER BY pay_premium DESC, cik, fiscal_year LIMIT 50")
def board_pay(spark, sf):
    return rm.board(pay(spark, sf).withColumn("pay_premium", F.round("pay_premium", 6)), [F.desc("pay_premium"), "cik", "fiscal_year"], 50,
                    "pay_up_performance_down").select("cik", "fiscal_year", "pay_premium")
