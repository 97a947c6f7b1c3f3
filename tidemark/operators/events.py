"""Event counts, deal anomalies, positioning and announcement screens."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import ratio, to_double
from tidemark.operators.asof import collapse, tail_per

# Announcement classes that count as material.
MATERIAL_SUBCATEGORIES = (
    "Change in Management",
    "Change in Directorate",
    "Resignation of Director",
    "Resignation of Statutory Auditors",
    "Appointment of Statutory Auditor/s",
    "Credit Rating",
    "Scheme of Arrangement",
)

# Metric -> (column of the exchange file, segment and column of the second source).
POSITION_METRICS = {
    "index_futures_long": ("Future Index Long", "NSE_FO|INDEX_FUTURES", "total_long_contracts"),
    "index_futures_short": ("Future Index Short", "NSE_FO|INDEX_FUTURES", "total_short_contracts"),
    "stock_futures_long": ("Future Stock Long", "NSE_FO|STOCK_FUTURES", "total_long_contracts"),
    "stock_futures_short": ("Future Stock Short", "NSE_FO|STOCK_FUTURES", "total_short_contracts"),
    "index_options_call_long": ("Option Index Call Long", "NSE_FO|INDEX_OPTIONS", "total_call_long_contracts"),
    "index_options_put_long": ("Option Index Put Long", "NSE_FO|INDEX_OPTIONS", "total_put_long_contracts"),
    "index_options_call_short": ("Option Index Call Short", "NSE_FO|INDEX_OPTIONS", "total_call_short_contracts"),
    "index_options_put_short": ("Option Index Put Short", "NSE_FO|INDEX_OPTIONS", "total_put_short_contracts"),
    "stock_options_call_long": ("Option Stock Call Long", "NSE_FO|STOCK_OPTIONS", "total_call_long_contracts"),
    "stock_options_put_long": ("Option Stock Put Long", "NSE_FO|STOCK_OPTIONS", "total_put_long_contracts"),
    "stock_options_call_short": ("Option Stock Call Short", "NSE_FO|STOCK_OPTIONS", "total_call_short_contracts"),
    "stock_options_put_short": ("Option Stock Put Short", "NSE_FO|STOCK_OPTIONS", "total_put_short_contracts"),
}


def trailing(df: DataFrame, ts: str, days: int) -> DataFrame:
    """Rows within ``days`` of the newest timestamp, inclusive."""
    newest = df.agg(F.max(ts).alias("m")).scalar()
    return df.where(F.col(ts) >= newest - F.expr(f"INTERVAL {int(days)} DAYS"))


def filing_frequency(filings: DataFrame, symbol: str, ts: str, window_days: int = 30) -> DataFrame:
    """Filings per symbol in the window ending at the newest filing. ``ts`` is parsed already."""
    known = filings.where(F.col(ts).isNotNull())
    return trailing(known, ts, window_days).groupBy(F.col(symbol).alias("symbol")).agg(
        F.count(F.lit(1)).alias("filing_count")
    ).withColumn("as_of_date", F.to_date(known.agg(F.max(ts).alias("m")).scalar())).withColumn("window_days", F.lit(window_days))


def daily_net_notional(*sources: DataFrame | None) -> DataFrame:
    """Buy minus sell notional per (symbol, day) over the deal feeds that exist.

    Each source: symbol, deal_date, side (BUY or SELL in any case), quantity, price.
    """
    frames = [s for s in sources if s is not None]
    if not frames:
        raise ValueError("daily_net_notional needs at least one deal feed")
    deals = frames[0]
    for f in frames[1:]:
        deals = deals.unionByName(f, allowMissingColumns=True)
    sign = F.when(F.upper("side") == "BUY", 1.0).when(F.upper("side") == "SELL", -1.0).otherwise(0.0)
    return deals.where("deal_date IS NOT NULL").groupBy("symbol", "deal_date").agg(
        F.sum(to_double("quantity") * to_double("price") * sign).alias("net_notional"))


def deal_anomaly(daily: DataFrame, window_days: int = 60) -> DataFrame:
    """Newest day of each symbol against its own last ``window_days`` days of deals.

    A flat history scores 0; a single day has no deviation and scores NULL.
    """
    tail = tail_per(daily, ["symbol"], ["deal_date"], window_days)
    stats = tail.groupBy("symbol").agg(
        F.max("deal_date").alias("deal_date"), F.max_by("net_notional", "deal_date").alias("net_notional"),
        F.avg("net_notional").alias("mu"), F.stddev_samp("net_notional").alias("sd"), F.count(F.lit(1)).alias("n_obs"))
    z = F.when(F.col("sd") == 0, F.lit(0.0)).otherwise(ratio(F.col("net_notional") - F.col("mu"), F.col("sd")))
    return stats.select("symbol", "deal_date", "net_notional", z.alias("notional_zscore"), "n_obs", F.col("deal_date").alias("as_of_date"))


def client_divergence(positions: DataFrame, first: str = "FII", second: str = "DII") -> DataFrame:
    """Net contracts of two client types by date and whether their signs differ.

    A zero against a long or short counts as different. ``positions``: trade_date,
    client_type, total_long, total_short.
    """
    wide = (
        positions.where(F.col("client_type").isin(first, second))
        .withColumn("net", F.col("total_long") - F.col("total_short"))
        .groupBy("trade_date").pivot("client_type", [first, second]).agg(F.max("net"))
    )
    a, b = f"{first.lower()}_net_contracts", f"{second.lower()}_net_contracts"
    # A missing side has no sign; comparisons against it give direction 0.
    sign = lambda c: F.coalesce(F.signum(F.col(c)).cast("int"), F.lit(0))
    return wide.withColumnsRenamed({first: a, second: b}).select(
        "trade_date", a, b, sign(a).alias(f"{first.lower()}_direction"), sign(b).alias(f"{second.lower()}_direction"),
        (sign(a) != sign(b)).alias("divergence_flag"))


def holding_change(holdings: DataFrame, symbol: str = "symbol", quarter: str = "quarter_end", value: str = "holding",
                   ties: Sequence[str] = ()) -> DataFrame:
    """Change of the newest observation of each symbol against the one before it.

    Only the two newest rows per symbol are needed, and no more than those leave a map task.
    """
    known = holdings.where(F.col(value).isNotNull() & F.col(quarter).isNotNull())
    two = tail_per(known, [symbol], [quarter, *ties], 2)
    when = F.struct(F.col(quarter), *[F.col(t) for t in ties])
    g = two.groupBy(symbol).agg(F.count(F.lit(1)).alias("n"), F.max(quarter).alias(quarter),
                                F.max_by(value, when).alias(value), F.min_by(value, when).alias(f"prev_{value}"))
    return g.where("n = 2").drop("n").withColumn("change_pct_points", F.col(value) - F.col(f"prev_{value}"))


def source_divergence(first: DataFrame, second: DataFrame, metrics: Mapping[str, tuple[str, str, str]] | None = None,
                      threshold_pct: float = 1.0) -> DataFrame:
    """Two readings of the same number per (date, metric), and where they differ.

    ``first`` is wide: trade_date and one column per metric. ``second`` is one row per
    (trade_date, segment) with its own columns.
    """
    metrics = metrics or POSITION_METRICS
    cols = {m: c for m, (c, _, _) in metrics.items()}
    a = first.select("trade_date", *[F.col(f"`{c}`").cast("double").alias(m) for m, c in cols.items()]).unpivot(
        "trade_date", list(cols), "metric", "nse_value").where("nse_value IS NOT NULL")
    fields = sorted({c for _, _, c in metrics.values()})
    b = second.select("trade_date", "segment", *[F.col(c).cast("double").alias(c) for c in fields]).unpivot(
        ["trade_date", "segment"], fields, "field", "upstox_value").where("upstox_value IS NOT NULL")
    names = F.create_map(*[x for m, (_, seg, f) in metrics.items() for x in (F.lit(f"{seg}\t{f}"), F.lit(m))])
    b = b.withColumn("metric", F.try_element_at(names, F.concat_ws("\t", "segment", "field"))).where("metric IS NOT NULL")
    diff = F.abs(F.col("nse_value") - F.col("upstox_value"))
    pct = diff / F.greatest(F.abs("nse_value"), F.abs("upstox_value"), F.lit(1.0)) * 100
    return a.join(b.select("trade_date", "metric", "upstox_value"), ["trade_date", "metric"]).select(
        "trade_date", "metric", "nse_value", "upstox_value", diff.alias("abs_diff"), pct.alias("pct_diff"),
        (pct > threshold_pct).alias("diverges"))


def material_events(announcements: DataFrame, master: DataFrame, window_days: int = 7,
                    subcategories: Sequence[str] = MATERIAL_SUBCATEGORIES, known: str = "knowledge_date",
                    order: Sequence[str] = ("_vintage_id",)) -> DataFrame:
    """Material announcements of the trailing window with their security.

    Both inputs are collapsed to one row per key first, so a rerun cannot multiply the
    events. ``announcements``: NEWSID, SCRIP_CD, company_name, subcatname, headline, news_dt.
    ``master``: SCRIP_CD, ISIN_NUMBER, Scrip_Name. The code is text on one side only.
    """
    ann = collapse(announcements, ["NEWSID"], known=known, order=order).where("news_dt IS NOT NULL")
    newest = ann.agg(F.max("news_dt").alias("m"))
    keep = ann.where((F.col("news_dt") >= newest.scalar() - F.expr(f"INTERVAL {int(window_days)} DAYS"))
                     & F.col("subcatname").isin(*subcategories))
    sec = collapse(master, ["ISIN_NUMBER"], known=known, order=order).select(
        F.col("SCRIP_CD").cast("string").alias("SCRIP_CD"), "ISIN_NUMBER", "Scrip_Name")
    return keep.select("NEWSID", F.col("SCRIP_CD").cast("string").alias("SCRIP_CD"), "company_name", "subcatname", "headline", "news_dt") \
        .join(sec, "SCRIP_CD", "left").withColumn("as_of_date", F.to_date(newest.scalar()))
