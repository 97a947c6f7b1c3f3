"""Returns, factors and correlations on monthly supplier prices."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from tidemark.operators import correlation as corr
from tidemark.operators import digest as dg
from tidemark.operators import prices as px
from tidemark.operators.outliers import multivariate_outliers
from tidemark.plans.bindings import (INDUSTRIES, MARKET_CAPS, PRICES, PROXY, RETURNS, UNIVERSE, industries, market_caps,
                                     prices, stored_prices, table)
from tidemark.plans.registry import query

R6 = 6


def rounded(name, digits=R6):
    """``F.round`` of a double without a decimal for each row, for queries with a row per pair; an exact half of the last digit may differ."""
    c, scale = F.col(name), float(10 ** digits)
    whole = F.floor(F.abs(c) * scale + 0.5) / scale
    return F.when(F.abs(c) * scale < 2.0 ** 52, F.when(c < 0, F.lit(0.0) - whole).otherwise(whole)).otherwise(F.round(c, digits)).alias(name)


@query("equity_universe", f"""WITH {PRICES}, {UNIVERSE} SELECT symbol, isin, trade_date, round(close, 8) AS close, volume,
  round(turnover, 2) AS turnover FROM uni WHERE turnover >= 10000""")
def equity_universe(spark, sf):
    return px.equity_universe(prices(spark, sf), min_turnover=10000.0).select(
        "symbol", "isin", "trade_date", F.round("close", 8).alias("close"), "volume", F.round("turnover", 2).alias("turnover"))


@query("price_panel", f"""WITH {PRICES} SELECT symbol, trade_date, round(close, 6) AS close FROM px
  WHERE trade_date <= DATE '1998-12-31'""")
def price_panel(spark, sf):
    return px.price_panel(prices(spark, sf), as_of="1998-12-31").select("symbol", "trade_date", F.round("close", R6).alias("close"))


@query("price_panel_vintages", """WITH raw AS (SELECT l_suppkey AS symbol, CAST(l_shipdate AS DATE) AS trade_date,
    l_extendedprice / l_quantity AS close, l_orderkey AS knowledge_order, l_linenumber, l_partkey, l_extendedprice FROM lineitem)
  SELECT symbol, trade_date, round(close, 8) AS close FROM raw
  QUALIFY row_number() OVER (PARTITION BY symbol, trade_date
    ORDER BY knowledge_order DESC, l_linenumber DESC, l_partkey DESC, l_extendedprice DESC) = 1""")
def price_panel_vintages(spark, sf):
    raw = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("symbol"), F.to_date("l_shipdate").alias("trade_date"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("close"),
        F.col("l_orderkey").alias("knowledge_order"), "l_linenumber", "l_partkey", "l_extendedprice")
    return px.price_panel(raw, vintages=True, known="knowledge_order",
                          order=("l_linenumber", "l_partkey", "l_extendedprice")).select(
        "symbol", "trade_date", F.round("close", 8).alias("close"))


@query("log_returns", f"WITH {RETURNS} SELECT symbol, trade_date, round(log_return, 6) AS log_return FROM ret")
def log_returns(spark, sf):
    return px.log_returns(prices(spark, sf)).select("symbol", "trade_date", F.round("log_return", R6).alias("log_return"))


@query("realized_vol", f"""WITH {RETURNS} SELECT symbol, trade_date,
  round(CASE WHEN count(log_return) OVER w = 20 THEN stddev_samp(log_return) OVER w END * sqrt(252), 6) AS realized_vol
  FROM ret WINDOW w AS (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""")
def realized_vol(spark, sf):
    return px.realized_vol(px.log_returns(prices(spark, sf))).select(
        "symbol", "trade_date", F.round("realized_vol", R6).alias("realized_vol"))


@query("sharpe_ratio", f"""WITH {RETURNS} SELECT symbol, trade_date, round(CASE WHEN count(log_return) OVER w = 60 THEN
  (avg(log_return) OVER w * 252 - 0.0525) / (stddev_samp(log_return) OVER w * sqrt(252)) END, 6) AS sharpe
  FROM ret WINDOW w AS (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)""")
def sharpe_ratio(spark, sf):
    return px.sharpe_ratio(px.log_returns(prices(spark, sf)), 0.0525).select(
        "symbol", "trade_date", F.round("sharpe", R6).alias("sharpe"))


MARKET = f"""mkt AS (SELECT trade_date, log_return AS m FROM ret WHERE symbol = '{PROXY}' AND log_return IS NOT NULL
  ORDER BY trade_date DESC LIMIT 60)"""
BETAS = f"""beta AS (SELECT symbol, max(ret.trade_date) AS as_of_date, regr_slope(log_return, m) AS beta,
  regr_intercept(log_return, m) AS alpha, regr_r2(log_return, m) AS r_squared, count(*) AS n_obs
  FROM ret JOIN mkt ON ret.trade_date = mkt.trade_date
  WHERE symbol <> '{PROXY}' AND log_return IS NOT NULL GROUP BY symbol HAVING count(*) >= 20)"""


@query("capm_beta", f"""WITH {RETURNS}, {MARKET}, {BETAS} SELECT symbol, as_of_date, round(beta, 6) AS beta,
  round(alpha, 6) AS alpha, round(r_squared, 6) AS r_squared, n_obs, '{PROXY}' AS market_proxy FROM beta""")
def capm_beta(spark, sf):
    return betas(spark, sf).select("symbol", "as_of_date", *[F.round(c, R6).alias(c) for c in ("beta", "alpha", "r_squared")],
                                   "n_obs", "market_proxy")


def betas(spark, sf, panel=None):
    return px.compute_betas(stored_prices(spark, sf) if panel is None else panel, PROXY, window_days=60)


def pairs(spark, sf, panel=None, only=None, **how):
    return corr.rolling_correlation(stored_prices(spark, sf) if panel is None else panel, 60, 20, only=only, **how)


PAIRS = """dts AS (SELECT DISTINCT trade_date FROM px ORDER BY trade_date DESC LIMIT 60),
  tail AS (SELECT ret.symbol, ret.trade_date, log_return FROM ret JOIN dts USING (trade_date) WHERE log_return IS NOT NULL),
  cnt AS (SELECT symbol, count(*) AS n FROM tail GROUP BY symbol HAVING count(*) >= 20),
  pairs AS (SELECT a.symbol AS symbol_a, b.symbol AS symbol_b, corr(a.log_return, b.log_return) AS correlation,
    min(least(ca.n, cb.n)) AS n_obs FROM tail a JOIN tail b ON a.trade_date = b.trade_date AND a.symbol < b.symbol
    JOIN cnt ca ON ca.symbol = a.symbol JOIN cnt cb ON cb.symbol = b.symbol GROUP BY 1, 2 HAVING count(*) >= 20)"""


@query("rolling_correlation", f"""WITH {RETURNS}, {PAIRS} SELECT symbol_a, symbol_b, round(correlation, 6) AS correlation,
  n_obs, (SELECT max(trade_date) FROM dts) AS as_of_date FROM pairs""")
def rolling_correlation(spark, sf):
    return pairs(spark, sf).select("symbol_a", "symbol_b", rounded("correlation"), "n_obs", "as_of_date")


TOP = """top AS (SELECT symbol FROM uni ORDER BY turnover DESC, symbol LIMIT 15)"""


@query("correlation_matrix", f"""WITH {RETURNS}, {UNIVERSE}, {PAIRS}, {TOP}
  SELECT a.symbol AS symbol_a, b.symbol AS symbol_b, CASE WHEN a.symbol = b.symbol THEN 1.0::DOUBLE ELSE round(p.correlation, 6) END AS correlation
  FROM top a CROSS JOIN top b LEFT JOIN pairs p ON p.symbol_a = least(a.symbol, b.symbol) AND p.symbol_b = greatest(a.symbol, b.symbol)""")
def correlation_matrix(spark, sf):
    panel = stored_prices(spark, sf)
    top = px.top_turnover(px.equity_universe(panel), 15)
    return corr.symmetric_matrix(pairs(spark, sf, panel, top), top).withColumn("correlation", F.round("correlation", R6))


SECTORS = """sec AS (SELECT ia.industry AS industry_a, ib.industry AS industry_b, avg(correlation) AS correlation
  FROM pairs JOIN ind ia ON ia.symbol = symbol_a JOIN ind ib ON ib.symbol = symbol_b GROUP BY 1, 2)"""


@query("sector_correlation", f"""WITH {RETURNS}, {PAIRS}, {INDUSTRIES}, {SECTORS}
  SELECT industry_a, industry_b, round(correlation, 6) AS correlation FROM sec""")
def sector_correlation(spark, sf):
    return corr.rolling_sector_correlation(stored_prices(spark, sf), industries(spark, sf)).withColumn("correlation", F.round("correlation", R6))


@query("sector_correlation_mirrored", f"""WITH {RETURNS}, {PAIRS}, {INDUSTRIES}, {SECTORS}
  SELECT coalesce(a.industry_a, b.industry_b) AS industry_a, coalesce(a.industry_b, b.industry_a) AS industry_b,
  round(coalesce(a.correlation, b.correlation), 6) AS correlation
  FROM sec a FULL JOIN sec b ON a.industry_a = b.industry_b AND a.industry_b = b.industry_a""")
def sector_correlation_mirrored(spark, sf):
    return corr.mirror_fill(corr.rolling_sector_correlation(stored_prices(spark, sf), industries(spark, sf))).withColumn(
        "correlation", F.round("correlation", R6))


@query("pairs_screen")
def pairs_screen(spark, sf):
    panel = stored_prices(spark, sf)
    return corr.pairs_screen(panel, partial(pairs, spark, sf, panel, at_least=0.3), corr_threshold=0.3)


COINT = """lv AS (SELECT symbol, trade_date, close FROM px JOIN dts USING (trade_date) WHERE close IS NOT NULL),
  jt AS (SELECT p.symbol_a, p.symbol_b, p.correlation, a.trade_date, a.close AS y, b.close AS x FROM pairs p JOIN lv a ON a.symbol = p.symbol_a
    JOIN lv b ON b.symbol = p.symbol_b AND b.trade_date = a.trade_date WHERE abs(p.correlation) >= 0.3),
  ft AS (SELECT *, y - avg(y) OVER w - covar_pop(y, x) OVER w / var_pop(x) OVER w * (x - avg(x) OVER w) AS e, count(*) OVER w AS n_obs FROM jt WINDOW w AS (PARTITION BY symbol_a, symbol_b)),
  df AS (SELECT *, lag(e) OVER w AS l, e - lag(e) OVER w AS d FROM ft WINDOW w AS (PARTITION BY symbol_a, symbol_b ORDER BY trade_date)),
  dl AS (SELECT *, lag(d) OVER (PARTITION BY symbol_a, symbol_b ORDER BY trade_date) AS g FROM df),
  sm AS (SELECT symbol_a, symbol_b, correlation, n_obs, count(*) AS n, sum(l * l) AS ll, sum(g * g) AS gg, sum(l * g) AS lg, sum(l * d) AS ld, sum(g * d) AS gd, sum(d * d) AS dd
    FROM dl WHERE g IS NOT NULL AND n_obs >= 20 GROUP BY ALL),
  so AS (SELECT *, ll * gg - lg * lg AS det, (ld * gg - gd * lg) / (ll * gg - lg * lg) AS b, (gd * ll - ld * lg) / (ll * gg - lg * lg) AS c FROM sm)"""


@query("pairs_statistic", f"""WITH {RETURNS}, {PAIRS}, {COINT} SELECT symbol_a, symbol_b, round(correlation, 6) AS correlation,
  round(b / sqrt((dd - b * ld - c * gd) / (n - 2) * gg / det), 5) AS statistic, n_obs, (SELECT max(trade_date) FROM dts) AS as_of_date FROM so""")
def pairs_statistic(spark, sf):
    panel = stored_prices(spark, sf)
    return corr.pairs_screen(panel, partial(pairs, spark, sf, panel, at_least=0.3), corr_threshold=0.3, lags=1).select(
        "symbol_a", "symbol_b", rounded("correlation"), rounded("statistic", 5), "n_obs", "as_of_date")


MOMENTUM = """ends AS (SELECT max(trade_date) AS hi, min(trade_date) AS lo FROM
    (SELECT DISTINCT trade_date FROM px ORDER BY trade_date DESC LIMIT 21)),
  tr AS (SELECT l.symbol, l.close / f.close - 1 AS trailing_return, l.trade_date AS as_of_date
    FROM px l JOIN px f ON l.symbol = f.symbol, ends WHERE l.trade_date = hi AND f.trade_date = lo),
  mom AS (SELECT symbol, trailing_return, (trailing_return - avg(trailing_return) OVER ()) / stddev_samp(trailing_return) OVER ()
    AS momentum_zscore, as_of_date FROM tr)"""


@query("momentum_zscore", f"""WITH {PRICES}, {MOMENTUM} SELECT symbol, round(trailing_return, 6) AS trailing_return,
  round(momentum_zscore, 6) AS momentum_zscore, as_of_date, 20 AS lookback_days FROM mom""")
def momentum_zscore(spark, sf):
    return px.momentum_zscore(stored_prices(spark, sf)).select(
        "symbol", F.round("trailing_return", R6).alias("trailing_return"),
        F.round("momentum_zscore", R6).alias("momentum_zscore"), "as_of_date", "lookback_days")


@query("variance_ratio", f"""WITH {RETURNS}, tail AS (SELECT symbol, trade_date, log_return FROM ret WHERE log_return IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY trade_date DESC) <= 60),
  l AS (SELECT *, CASE WHEN count(*) OVER w = 5 THEN sum(log_return) OVER w END AS lagged FROM tail
    WINDOW w AS (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)),
  g AS (SELECT symbol, count(*) AS n, var_samp(log_return) AS v1, var_samp(lagged) AS vl FROM l GROUP BY symbol)
  SELECT symbol, (SELECT max(trade_date) FROM px p WHERE p.symbol = g.symbol) AS as_of_date, round(vl / (5 * v1), 6) AS variance_ratio,
  round((vl / (5 * v1) - 1) / sqrt(2.0 * 9 * 4 / (3.0 * 5 * n)), 6) AS z_stat, 5 AS lag, n AS n_obs FROM g WHERE n >= 20 AND v1 > 0""")
def variance_ratio(spark, sf):
    return px.variance_ratio(prices(spark, sf)).withColumn("variance_ratio", F.round("variance_ratio", R6)) \
        .withColumn("z_stat", F.round("z_stat", R6))


SIZE = """sz AS (SELECT symbol, uni.isin, trade_date AS as_of_date, market_cap,
    CASE WHEN market_cap > 0 THEN ln(market_cap) END AS lnm FROM uni LEFT JOIN caps ON uni.isin = caps.isin),
  size AS (SELECT *, -(lnm - avg(lnm) OVER ()) / stddev_samp(lnm) OVER () AS size_score FROM sz)"""


def size(spark, sf, panel=None):
    panel = stored_prices(spark, sf) if panel is None else panel
    return px.size_factor(px.equity_universe(panel), market_caps(spark, sf))


@query("size_factor", f"""WITH {PRICES}, {UNIVERSE}, {MARKET_CAPS}, {SIZE} SELECT symbol, isin, as_of_date,
  market_cap AS market_cap_inr_cr, round(size_score, 6) AS size_score FROM size""")
def size_factor(spark, sf):
    return size(spark, sf).withColumn("size_score", F.round("size_score", R6))


LOWVOL = """v AS (SELECT symbol, trade_date, CASE WHEN count(log_return) OVER w = 20 THEN stddev_samp(log_return) OVER w END * sqrt(252) AS rv
    FROM ret WINDOW w AS (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)),
  lv0 AS (SELECT symbol, max(trade_date) AS as_of_date, arg_max(rv, trade_date) FILTER (rv IS NOT NULL) AS realized_vol FROM v GROUP BY symbol),
  lowvol AS (SELECT *, -(realized_vol - avg(realized_vol) OVER ()) / stddev_samp(realized_vol) OVER () AS low_vol_score
    FROM lv0 WHERE realized_vol IS NOT NULL)"""


@query("low_vol_factor", f"""WITH {RETURNS}, {LOWVOL} SELECT symbol, as_of_date, round(realized_vol, 6) AS realized_vol,
  round(low_vol_score, 6) AS low_vol_score FROM lowvol""")
def low_vol_factor(spark, sf):
    return px.low_vol_factor(stored_prices(spark, sf)).withColumn("realized_vol", F.round("realized_vol", R6)) \
        .withColumn("low_vol_score", F.round("low_vol_score", R6))


FACTORS = f"""{RETURNS}, {UNIVERSE}, {MARKET_CAPS}, {MOMENTUM}, {SIZE}, {LOWVOL},
  fm AS (SELECT mom.symbol, momentum_zscore, mom.as_of_date, size_score, low_vol_score,
    greatest(least(0.4 * coalesce(momentum_zscore, 0) + 0.3 * coalesce(size_score, 0) + 0.3 * coalesce(low_vol_score, 0), 1.0), -1.0) AS composite_score
    FROM mom LEFT JOIN size USING (symbol) LEFT JOIN lowvol USING (symbol))"""


def factors(spark, sf):
    p = stored_prices(spark, sf)
    return px.factor_model(px.momentum_zscore(p), size(spark, sf, p), px.low_vol_factor(p))


@query("factor_model", f"""WITH {FACTORS} SELECT symbol, round(momentum_zscore, 6) AS momentum_zscore, as_of_date,
  round(size_score, 6) AS size_score, round(low_vol_score, 6) AS low_vol_score, round(composite_score, 6) AS composite_score FROM fm""")
def factor_model(spark, sf):
    return factors(spark, sf).select("symbol", "as_of_date", *[F.round(c, R6).alias(c) for c in (
        "momentum_zscore", "size_score", "low_vol_score", "composite_score")])


DIGEST = f"""{RETURNS}, {MARKET}, {BETAS}, {MOMENTUM}, dj AS (SELECT beta.symbol, beta, alpha, momentum_zscore, mom.as_of_date FROM beta JOIN mom USING (symbol)),
  dig AS (SELECT *, greatest(least(0.4 * coalesce(momentum_zscore, 0) + 0.3 * (beta - avg(beta) OVER ()) / stddev_samp(beta) OVER (), 1.0), -1.0) AS composite_score FROM dj)"""
WATCHED = ("S1", "S2", "S3", "S4", "S5")


def scored(spark, sf):
    p = stored_prices(spark, sf)
    return dg.composite_score(betas(spark, sf, p), px.momentum_zscore(p))


@query("digest_composite", f"""WITH {DIGEST} SELECT symbol, round(beta, 6) AS beta, round(momentum_zscore, 6) AS momentum_zscore,
  as_of_date, round(composite_score, 6) AS composite_score FROM dig""")
def digest_composite(spark, sf):
    return scored(spark, sf).select("symbol", F.round("beta", R6).alias("beta"), F.round("momentum_zscore", R6).alias("momentum_zscore"),
                                    "as_of_date", F.round("composite_score", R6).alias("composite_score"))


@query("two_tier_shortlist", f"""WITH {DIGEST}, w AS (SELECT symbol, round(composite_score, 6) AS composite_score, 'watchlist' AS tier FROM dig
    WHERE symbol IN {WATCHED}),
  b AS (SELECT symbol, round(composite_score, 6) AS composite_score, 'broad_scan' AS tier FROM dig WHERE symbol NOT IN {WATCHED}
    ORDER BY abs(dig.composite_score) DESC, symbol LIMIT 10) SELECT * FROM w UNION ALL SELECT * FROM b""")
def two_tier_shortlist(spark, sf):
    return dg.two_tiers(scored(spark, sf), 10, WATCHED).select("symbol", F.round("composite_score", R6).alias("composite_score"), "tier")


@query("top_movers", f"""WITH {FACTORS}, u AS (SELECT symbol, composite_score, 'bullish' AS side FROM fm WHERE composite_score > 0
    ORDER BY composite_score DESC, symbol LIMIT 5),
  d AS (SELECT symbol, composite_score, 'bearish' AS side FROM fm WHERE composite_score < 0 ORDER BY composite_score, symbol LIMIT 5)
  SELECT symbol, round(composite_score, 6) AS composite_score, side FROM (SELECT * FROM u UNION ALL SELECT * FROM d)""")
def top_movers(spark, sf):
    return px.top_movers(factors(spark, sf), 5, name="symbol").select("symbol", F.round("composite_score", R6).alias("composite_score"), "side")


@query("top_turnover", f"""WITH {PRICES}, {UNIVERSE} SELECT symbol, round(turnover, 2) AS turnover FROM uni
  ORDER BY uni.turnover DESC, symbol LIMIT 15""")
def top_turnover(spark, sf):
    return px.top_turnover(px.equity_universe(prices(spark, sf)), 15).select("symbol", F.round("turnover", 2).alias("turnover"))


@query("focus_first", f"""WITH {PRICES}, {UNIVERSE} SELECT DISTINCT symbol, CASE WHEN symbol IN {WATCHED} THEN 0 ELSE 1 END AS tier,
  CASE WHEN symbol IN {WATCHED} THEN CAST(list_position({list(WATCHED)}, symbol) AS INTEGER) END AS position FROM uni""")
def focus_first(spark, sf):
    return px.focus_first(px.equity_universe(prices(spark, sf)), WATCHED)


@query("flag_text", """SELECT doc_id, CASE WHEN length(text) > 120 THEN rtrim(left(text, 117), ' ') || '...' ELSE text END AS flag FROM documents""")
def flag_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", dg.flag_text("text").alias("flag"))


@query("top_signals", """SELECT conv_id, turn, array_to_string(string_split(text, ' ')[1:5], '|') AS signals FROM conversations""")
def top_signals(spark, sf):
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", F.array_join(dg.top_signals(F.split("text", " ")), "|").alias("signals"))


@query("multivariate_outliers")
def outliers(spark, sf):
    p = stored_prices(spark, sf)
    feats = betas(spark, sf, p).select("symbol", "beta").join(px.momentum_zscore(p).select("symbol", "momentum_zscore", "as_of_date"), "symbol")
    vr = px.variance_ratio(p).select("symbol", F.col("variance_ratio").alias("notional_zscore"))
    feats = feats.join(vr, "symbol", "left").withColumn("change_pct_points", F.lit(None).cast("double"))
    return multivariate_outliers(feats)
