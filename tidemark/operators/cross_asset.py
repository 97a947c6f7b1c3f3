"""Correlation of an equity proxy with commodity and macro series, and the gold premium."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import DAYMONYEAR, parse
from tidemark.functions.scalar import ratio, require_rows

# Grams per troy ounce and the levies the premium assumes.
TROY_OZ_GRAMS = 31.1034768
IMPORT_DUTY_PCT, GST_PCT = 6.0, 3.0


def front_by_expiry(quotes: DataFrame, day: str = "trade_date", expiry: str = "ExpiryDate",
                    fmt: str = DAYMONYEAR, ties: Sequence[str] = ()) -> DataFrame:
    """Nearest expiry of each date; contracts are ordered by parsed date, never by price."""
    w = Window.partitionBy(day).orderBy(parse(expiry, fmt).asc_nulls_last(), *ties)
    return quotes.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def front_by_order(settlements: DataFrame, day: str = "trade_date_requested") -> DataFrame:
    """Front month by position on the curve, aggregates and unpriced rows excluded."""
    usable = settlements.where(~F.col("is_total") & F.col("settle_num").isNotNull() & F.col("contract_order").isNotNull())
    return usable.groupBy(day).agg(F.min_by("settle_num", "contract_order").alias("settle"),
                                   F.min_by("month", "contract_order").alias("contract"))


def leg_changes(legs: DataFrame, diff_legs: Sequence[str] = (), leg: str = "leg", day: str = "trade_date",
                value: str = "value") -> DataFrame:
    """Log return of price legs, plain difference of the legs that are already spreads."""
    prev = F.lag(value).over(Window.partitionBy(leg).orderBy(day))
    change = F.log(ratio(F.col(value), prev))
    if diff_legs:
        change = F.when(F.col(leg).isin(*diff_legs), F.col(value) - prev).otherwise(change)
    return legs.withColumn("change", change).where("change IS NOT NULL").select(leg, day, "change")


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation that is NULL on a constant series, where corr() would fail."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_samp(a, b), F.stddev_samp(a) * F.stddev_samp(b))


def equity_commodity_correlation(equity: DataFrame, legs: DataFrame, proxy: str, window_days: int = 60, min_obs: int = 10,
                                 diff_legs: Sequence[str] = (), strict: bool = False) -> DataFrame:
    """Correlation of the proxy's log returns with the change of every commodity leg.

    Both sides are cut to their own last observations and matched on date; a leg with too
    few matches is left out, and with ``strict`` it raises that every leg is. ``equity`` has trade_date, close; ``legs`` has leg, trade_date, value.
    """
    eq = leg_changes(equity.select(F.lit(proxy).alias("leg"), "trade_date", F.col("close").alias("value")))
    eq = eq.orderBy(F.desc("trade_date")).limit(window_days).select("trade_date", F.col("change").alias("e"))
    w = Window.partitionBy("leg").orderBy(F.desc("trade_date"))
    tail = leg_changes(legs, diff_legs).withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= window_days)
    out = (
        tail.join(F.broadcast(eq), "trade_date")     # at most window_days rows
        .groupBy("leg")
        .agg(safe_corr(F.col("e"), F.col("change")).alias("correlation"), F.count(F.lit(1)).alias("n_obs"),
             F.max("trade_date").alias("as_of_date"))
        .where((F.col("n_obs") >= min_obs) & F.col("correlation").isNotNull())
        .select(F.lit(proxy).alias("asset_a"), F.col("leg").alias("asset_b"), "correlation", "n_obs",
                F.lit(window_days).alias("window_days"), "as_of_date")
    )
    return require_rows(out, 1, f"equity_commodity_correlation: no leg has {min_obs} days in common with {proxy}") if strict else out


def monthly_last(series: DataFrame, group: Sequence[str], day: str, value: str) -> DataFrame:
    """Last non-null observation of each calendar month, dated on the month's last day.

    Months without an observation have no row, so a change taken afterwards spans the gap.
    """
    return (
        series.where(F.col(value).isNotNull())
        .groupBy(*group, F.last_day(day).alias("month_end"))
        .agg(F.max_by(value, day).alias(value))
    )


def monthly_change(monthly: DataFrame, group: Sequence[str], value: str, kind: str) -> DataFrame:
    """``kind``: log, pct or bps (difference times 100)."""
    prev = F.lag(value).over(Window.partitionBy(*group).orderBy("month_end"))
    change = {
        "log": F.log(ratio(F.col(value), prev)),
        "pct": ratio(F.col(value), prev) - 1.0,
        "bps": (F.col(value) - prev) * 100.0,
    }[kind]
    return monthly.withColumn("change", change).where("change IS NOT NULL").select(*group, "month_end", "change")


def equity_macro_correlation(equity: DataFrame, macro: dict[str, tuple[DataFrame, str]], proxy: str,
                             min_months: int = 6) -> DataFrame:
    """Correlation of month-end changes. ``macro`` maps a name to (frame of day, value; kind)."""
    eq = monthly_change(monthly_last(equity.select(F.lit(proxy).alias("leg"), F.col("trade_date").alias("day"),
                                                   F.col("close").alias("value")), ["leg"], "day", "value"),
                        ["leg"], "value", "log").select("month_end", F.col("change").alias("e"))
    legs = None
    for name, (frame, kind) in macro.items():
        one = monthly_change(monthly_last(frame.select(F.lit(name).alias("leg"), "day", "value"), ["leg"], "day", "value"),
                             ["leg"], "value", kind)
        legs = one if legs is None else legs.unionByName(one)
    return (
        legs.join(eq, "month_end")
        .groupBy("leg")
        .agg(safe_corr(F.col("e"), F.col("change")).alias("correlation"), F.count(F.lit(1)).alias("n_obs"),
             F.max("month_end").alias("as_of_date"))
        .where((F.col("n_obs") >= min_months) & F.col("correlation").isNotNull())
        .select(F.lit(proxy).alias("equity_symbol"), F.col("leg").alias("macro_series"), "correlation", "n_obs", "as_of_date")
    )


def reference_rate(indicators: DataFrame, phrase: str = "exchange rate") -> DataFrame:
    """Series of the indicators whose name contains ``phrase`` in any case."""
    return indicators.where(F.contains(F.lower("indicator"), F.lit(phrase.lower()))).select(
        F.col("as_of").alias("rate_date"), F.col("value").alias("usdinr"))


def gold_premium(ibja: DataFrame, settlements: DataFrame, usdinr: DataFrame,
                 import_duty_pct: float = IMPORT_DUTY_PCT, gst_pct: float = GST_PCT) -> DataFrame:
    """Domestic price over landed cost, on dates where all three legs exist.

    ``ibja`` rate_date, session, ibja_999; ``settlements`` as front_by_order takes them;
    ``usdinr`` rate_date, usdinr. Inputs are already collapsed to one row per key.
    """
    comex = front_by_order(settlements).select(F.col("trade_date_requested").alias("rate_date"),
                                               F.col("settle").alias("comex_usd_per_oz"), F.col("contract").alias("comex_contract"))
    df = ibja.join(comex, "rate_date").join(usdinr, "rate_date")
    per_10g = F.col("comex_usd_per_oz") * F.col("usdinr") / TROY_OZ_GRAMS * 10.0
    landed = F.col("comex_inr_per_10g") * (1 + import_duty_pct / 100) * (1 + gst_pct / 100)
    return (
        df.withColumn("comex_inr_per_10g", per_10g)
        .withColumn("landed_inr_per_10g", landed)
        .withColumn("premium_inr_per_10g", F.col("ibja_999") - F.col("landed_inr_per_10g"))
        .withColumn("premium_pct", ratio(F.col("premium_inr_per_10g"), F.col("landed_inr_per_10g")) * 100)
        .withColumn("import_duty_pct", F.lit(import_duty_pct)).withColumn("gst_pct", F.lit(gst_pct))
    )
