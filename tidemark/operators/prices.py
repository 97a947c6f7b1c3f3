"""Price panel, returns and cross-sectional price factors.

A price panel holds one row per (symbol, date), so every per-symbol window below is
bounded by the number of trading dates, however many trades or vintages fed the panel.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import as_date
from tidemark.functions.scalar import clip, require_rows, to_double, zscore_columns
from tidemark.operators.asof import collapse, tail_by_date, tail_per

TRADING_DAYS = 252

# Weights of the factor model.
FACTOR_WEIGHTS = {"momentum_zscore": 0.4, "size_score": 0.3, "low_vol_score": 0.3}


def price_panel(prices: DataFrame, key: Sequence[str] = ("symbol", "trade_date"),
                as_of: str | date | None = None, vintages: bool = False,
                known: str = "knowledge_date", order: Sequence[str] = ("_vintage_id",)) -> DataFrame:
    """One close per (symbol, date), on dates up to ``as_of``.

    ``vintages=True`` collapses a raw vintage table first, so a rerun cannot decide which
    of two closes is used.
    """
    bound = as_date(as_of)
    if vintages:
        prices = collapse(prices, key, known=known, order=order)
    return prices if bound is None else prices.where(F.col(key[-1]) <= F.lit(bound))


def equity_universe(prices: DataFrame, as_of: str | date | None = None, min_turnover: float | None = None,
                    series: str = "EQ", strict: bool = False) -> DataFrame:
    """Main-board symbols of one date: the given date exactly, or the newest."""
    day = as_date(as_of)
    when = F.lit(day) if day is not None else prices.agg(F.max("trade_date").alias("d")).scalar()
    out = (
        prices.where((F.col("trade_date") == when) & (F.col("series") == series))
        .groupBy("symbol", "isin", "trade_date")
        .agg(F.max(F.struct("close", "volume")).alias("q"))
        .select("symbol", "isin", "trade_date", "q.close", "q.volume",
                (F.col("q.close") * F.col("q.volume")).alias("turnover"))
    )
    if min_turnover is not None:
        out = out.where(F.col("turnover") >= min_turnover)
    return require_rows(out, 1, "equity_universe: no rows for that date and series") if strict else out


def in_universe(panel: DataFrame, universe: DataFrame | None) -> DataFrame:
    return panel if universe is None else panel.join(universe.select("symbol").distinct(), "symbol", "left_semi")


def log_returns(panel: DataFrame, price: str = "close", symbol: str = "symbol",
                day: str = "trade_date", out: str = "log_return") -> DataFrame:
    """ln(P_t / P_t-1) per symbol."""
    prev = F.lag(price).over(Window.partitionBy(symbol).orderBy(day))
    return panel.withColumn(out, F.log(F.try_divide(F.col(price), prev)))


def _full_window(value: Column, func: Column, w, n: int) -> Column:
    return F.when(F.count(value).over(w) == n, func.over(w))


def realized_vol(returns: DataFrame, window: int = 20, annualize: bool = True, value: str = "log_return",
                 out: str = "realized_vol", symbol: str = "symbol", day: str = "trade_date") -> DataFrame:
    """Rolling deviation of returns; NULL until the window is full."""
    w = Window.partitionBy(symbol).orderBy(day).rowsBetween(-(window - 1), 0)
    scale = TRADING_DAYS ** 0.5 if annualize else 1.0
    return returns.withColumn(out, _full_window(F.col(value), F.stddev_samp(value), w, window) * scale)


def sharpe_ratio(returns: DataFrame, rf_annual: float, window: int = 60, value: str = "log_return",
                 out: str = "sharpe", symbol: str = "symbol", day: str = "trade_date") -> DataFrame:
    """Rolling annualised (mean - rf) / deviation; ``rf_annual`` is a fraction."""
    w = Window.partitionBy(symbol).orderBy(day).rowsBetween(-(window - 1), 0)
    mean = _full_window(F.col(value), F.avg(value), w, window) * TRADING_DAYS
    vol = _full_window(F.col(value), F.stddev_samp(value), w, window) * TRADING_DAYS ** 0.5
    return returns.withColumn(out, F.try_divide(mean - F.lit(rf_annual), vol))


def compute_betas(panel: DataFrame, proxy: str, window_days: int = 252, min_obs: int = 20,
                  universe: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """Least-squares beta, alpha and r-squared against the proxy's last market dates.

    The proxy side is at most ``window_days`` rows, so the join is a broadcast whatever
    the size of the panel, and the regression is one partially aggregated group by.
    """
    returns = log_returns(in_universe(panel, universe)).where("log_return IS NOT NULL")
    market = (
        returns.where(F.col("symbol") == proxy)
        .select("trade_date", F.col("log_return").alias("market_return"))
        .orderBy(F.desc("trade_date")).limit(window_days)
    )
    if strict:
        require_rows(market, min_obs, f"compute_betas: too few {proxy} returns; collect more daily prices")
    y, x = "log_return", "market_return"
    fit = (
        returns.where(F.col("symbol") != proxy)
        .join(F.broadcast(market), "trade_date")
        .groupBy("symbol")
        .agg(
            F.max("trade_date").alias("as_of_date"),
            F.regr_slope(y, x).alias("beta"),
            F.regr_intercept(y, x).alias("alpha"),
            F.when(F.var_samp(y) == 0, F.lit(0.0)).otherwise(F.regr_r2(y, x)).alias("r_squared"),
            F.count(F.lit(1)).alias("n_obs"),
        )
        .where(F.col("n_obs") >= min_obs)
        .withColumn("market_proxy", F.lit(proxy))
    )
    return require_rows(fit, 1, "compute_betas: no symbol overlaps the proxy enough") if strict else fit


def momentum_zscore(panel: DataFrame, lookback_days: int = 20, universe: DataFrame | None = None,
                    strict: bool = False) -> DataFrame:
    """Return over exactly ``lookback_days`` panel dates, scored across symbols."""
    panel = in_universe(panel, universe)
    dates = panel.select("trade_date").distinct().orderBy(F.desc("trade_date")).limit(lookback_days + 1)
    if strict:
        require_rows(dates, lookback_days + 1, "momentum_zscore: not enough trading dates yet")
    ends = dates.agg(F.max("trade_date").alias("hi"), F.min("trade_date").alias("lo"), F.count(F.lit(1)).alias("n"))
    ends = ends.where(F.col("n") == lookback_days + 1)
    hi, lo = ends.select("hi").scalar(), ends.select("lo").scalar()
    d = F.col("trade_date")
    two = (
        panel.where((d == hi) | (d == lo))
        .groupBy("symbol")
        .agg(F.max(F.when(d == hi, F.col("close"))).alias("last"), F.max(F.when(d == lo, F.col("close"))).alias("first"),
             F.max("trade_date").alias("as_of_date"))
        .select("symbol", (F.try_divide(F.col("last"), F.col("first")) - 1.0).alias("trailing_return"), "as_of_date")
        .where("trailing_return IS NOT NULL")
    )
    out = zscore_columns(two, "trailing_return", "momentum_zscore")
    return out.withColumn("lookback_days", F.lit(lookback_days))


def variance_ratio(panel: DataFrame, lag: int = 5, window_days: int = 60, min_obs: int = 20,
                   universe: DataFrame | None = None) -> DataFrame:
    """Lo-MacKinlay variance ratio and its homoskedastic z per symbol."""
    returns = log_returns(in_universe(panel, universe))
    newest = returns.groupBy("symbol").agg(F.max("trade_date").alias("as_of_date"))
    tail = tail_per(returns.where("log_return IS NOT NULL"), ["symbol"], ["trade_date"], window_days)
    w = Window.partitionBy("symbol").orderBy("trade_date").rowsBetween(-(lag - 1), 0)
    summed = tail.withColumn("lagged", _full_window(F.col("log_return"), F.sum("log_return"), w, lag))
    n = F.col("n_obs")
    se = F.sqrt(F.lit(2.0 * (2 * lag - 1) * (lag - 1)) / (F.lit(3.0 * lag) * n))
    return (
        summed.groupBy("symbol")
        .agg(F.count(F.lit(1)).alias("n_obs"), F.var_samp("log_return").alias("v1"), F.var_samp("lagged").alias("vl"))
        .where((n >= max(min_obs, 4 * lag)) & (F.col("v1") > 0))
        .withColumn("variance_ratio", F.col("vl") / (F.lit(float(lag)) * F.col("v1")))
        .withColumn("z_stat", F.try_divide(F.col("variance_ratio") - 1.0, se))
        .join(newest, "symbol")
        .select("symbol", "as_of_date", "variance_ratio", "z_stat", F.lit(lag).alias("lag"), "n_obs")
    )


def size_factor(universe: DataFrame, market_caps: DataFrame, strict: bool = False, min_symbols: int = 2) -> DataFrame:
    """Minus the z-score of ln(market cap): smaller is higher. Symbols without a positive
    market cap keep their row with NULL scores. ``market_caps`` has isin, market_cap (text)."""
    caps = market_caps.select("isin", to_double("market_cap").alias("market_cap_inr_cr"))
    df = universe.select("symbol", "isin", F.col("trade_date").alias("as_of_date")).join(caps, "isin", "left")
    df = df.withColumn("_ln", F.when(F.col("market_cap_inr_cr") > 0, F.log("market_cap_inr_cr")))
    if strict:
        require_rows(df.where("_ln IS NOT NULL"), min_symbols, "size_factor: too few symbols with a market cap")
    return zscore_columns(df, "_ln", "size_score", sign=-1.0).select(
        "symbol", "isin", "as_of_date", "market_cap_inr_cr", "size_score")


def low_vol_factor(panel: DataFrame, window_days: int = 20, universe: DataFrame | None = None) -> DataFrame:
    """Minus the z-score of the last full-window realised volatility: calmer is higher."""
    vol = realized_vol(log_returns(in_universe(panel, universe)), window_days)
    last = (
        vol.groupBy("symbol")
        .agg(F.max("trade_date").alias("as_of_date"),
             F.max_by("realized_vol", F.when(F.col("realized_vol").isNotNull(), F.col("trade_date"))).alias("realized_vol"))
        .where("realized_vol IS NOT NULL")
    )
    return zscore_columns(last, "realized_vol", "low_vol_score", sign=-1.0)


def factor_model(momentum: DataFrame, size: DataFrame, low_vol: DataFrame,
                 weights: dict[str, float] | None = None) -> DataFrame:
    """Weighted composite of three factors, a missing one counting as neutral, in [-1, 1]."""
    weights = weights or FACTOR_WEIGHTS
    df = (
        momentum.select("symbol", "momentum_zscore", "as_of_date")
        .join(size.select("symbol", "size_score"), "symbol", "left")
        .join(low_vol.select("symbol", "low_vol_score"), "symbol", "left")
    )
    raw = sum((F.lit(w) * F.coalesce(F.col(c), F.lit(0.0)) for c, w in weights.items()), F.lit(0.0))
    return df.withColumn("composite_score", clip(raw, -1.0, 1.0))


def top_turnover(universe: DataFrame, n: int = 15) -> DataFrame:
    return universe.orderBy(F.desc("turnover"), "symbol").limit(n)


def focus_first(universe: DataFrame, focus: Sequence[str]) -> DataFrame:
    """Symbols with a sort position: the focus list in its own order, then the rest by name."""
    at = F.array_position(F.array(*[F.lit(s) for s in focus]), F.col("symbol"))
    return universe.select("symbol").distinct().withColumn("tier", F.when(at > 0, 0).otherwise(1)) \
        .withColumn("position", F.when(at > 0, at.cast("int")))


def top_movers(scored: DataFrame, n: int, score: str = "composite_score", name: str = "instrument") -> DataFrame:
    """Highest ``n`` positive and lowest ``n`` negative scores."""
    up = scored.where(F.col(score) > 0).orderBy(F.desc(score), name).limit(n).withColumn("side", F.lit("bullish"))
    down = scored.where(F.col(score) < 0).orderBy(F.asc(score), name).limit(n).withColumn("side", F.lit("bearish"))
    return up.unionByName(down)


def level_change(levels: DataFrame, group: Sequence[str], day: str, value: str, out: str = "change") -> DataFrame:
    """Change against the previous observation of each series."""
    prev = F.lag(value).over(Window.partitionBy(*group).orderBy(day))
    return levels.withColumn(f"previous_{value}", prev).withColumn(out, F.col(value) - prev)


def panel_tail(panel: DataFrame, window_days: int, day: str = "trade_date") -> DataFrame:
    return tail_by_date(panel, day, window_days)
