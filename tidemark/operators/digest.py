"""Composite score, two-tier shortlist and the digest rows built from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import clip, col, zscore_columns

# Weights, lengths and the hand-kept watch list.
DIGEST_WEIGHTS = {"momentum_zscore": 0.4, "beta_z": 0.3, "event_zscore": 0.3}
FLAG_CHARS, MAX_SIGNALS = 120, 5
WATCHLIST = (
    "RELIANCE", "HDFCBANK", "ICICIBANK", "TCS", "INFY", "BHARTIARTL",
    "ITC", "LT", "KOTAKBANK", "AXISBANK", "SBIN", "HINDUNILVR",
    "BAJFINANCE", "ASIANPAINT", "MARUTI", "SUNPHARMA", "TITAN", "ULTRACEMCO",
    "WIPRO", "NESTLEIND", "ADANIENT", "ONGC", "NTPC", "POWERGRID",
    "M&M", "TATASTEEL", "JSWSTEEL", "HCLTECH", "TECHM",
)


def composite_score(betas: DataFrame, momentum: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """Weighted sum of momentum, cross-sectional beta and event scores, in [-1, 1]."""
    df = betas.select("symbol", "beta", "alpha").join(
        momentum.select("symbol", "momentum_zscore", "as_of_date"), "symbol")
    if events is not None:
        df = df.join(events.select("symbol", F.col("notional_zscore").alias("event_zscore")), "symbol", "left")
    else:
        df = df.withColumn("event_zscore", F.lit(0.0))
    df = df.withColumn("event_zscore", F.coalesce("event_zscore", F.lit(0.0)))
    df = zscore_columns(df, "beta", "beta_z")
    raw = sum((F.lit(w) * F.coalesce(F.col(c), F.lit(0.0)) for c, w in DIGEST_WEIGHTS.items()), F.lit(0.0))
    return df.withColumn("composite_score", clip(raw, -1.0, 1.0))


def two_tiers(scored: DataFrame, shortlist: int, watchlist: Sequence[str] = WATCHLIST) -> DataFrame:
    """Every watch-list row, and the ``shortlist`` strongest of the others."""
    watched = F.col("symbol").isin(*watchlist)
    first = scored.where(watched).withColumn("tier", F.lit("watchlist"))
    rest = scored.where(~watched).orderBy(F.abs("composite_score").desc(), "symbol").limit(shortlist)
    return first.unionByName(rest.withColumn("tier", F.lit("broad_scan")))


def flag_text(flag: str | Column, chars: int = FLAG_CHARS) -> Column:
    """At most ``chars`` characters, a cut marked with three dots."""
    t = F.coalesce(col(flag), F.lit(""))
    return F.when(F.length(t) > chars, F.concat(F.rtrim(F.substring(t, 1, chars - 3)), F.lit("..."))).otherwise(t)


def top_signals(signals: str | Column, n: int = MAX_SIGNALS) -> Column:
    return F.slice(F.coalesce(col(signals), F.array().cast("array<string>")), 1, n)
