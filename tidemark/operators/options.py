"""Option chains: implied volatility, Greeks of a snapshot, and the strike ladder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import options as bs
from tidemark.functions.dates import DAY_MONTH_YEAR, parse

# Bracket of the volatility search.
LOW_VOL, HIGH_VOL, STEPS = 1e-4, 5.0, 60


@F.pandas_udf(T.DoubleType())
def implied_vol(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
    """Volatility reproducing a price: (price, spot, strike, years, rate, right).

    Vectorised bisection over each Arrow batch. NULL where no volatility in the bracket
    reaches the price, or where there is no time left.
    """
    for price, s, k, t, r, right in batches:
        p, s, k, t, r = (x.to_numpy(dtype=float) for x in (price, s, k, t, r))
        side = np.where(right.to_numpy() == "C", 1.0, -1.0)
        live = np.isfinite(p) & (t > 0)
        with np.errstate(all="ignore"):
            safe_t = np.where(live, t, 1.0)
            low, high = np.full(len(p), LOW_VOL), np.full(len(p), HIGH_VOL)
            reachable = live & (bs.price_array(s, k, safe_t, r, low, side) <= p) & (bs.price_array(s, k, safe_t, r, high, side) >= p)
            for _ in range(STEPS):
                mid = (low + high) / 2.0
                above = bs.price_array(s, k, safe_t, r, mid, side) > p
                high = np.where(above, mid, high)
                low = np.where(above, low, mid)
        out = pd.Series((low + high) / 2.0)
        yield out.where(pd.Series(reachable))


def risk_free_rate(indicators: DataFrame, name: str = "Policy Repo Rate") -> Column:
    """Latest value of the policy rate as a fraction, usable in any other frame."""
    return indicators.where(F.col("indicator") == name).agg((F.max_by("value", "as_of") / 100.0).alias("r")).scalar()


def latest_snapshot(chain: DataFrame, stamp: str = "fetched_at_utc") -> DataFrame:
    return chain.where(F.col(stamp) == chain.agg(F.max(stamp).alias("m")).scalar())


def chain_greeks(chain: DataFrame, rate: Column | float, stamp: str = "fetched_at_utc") -> DataFrame:
    """Greeks at the exchange's volatility, the volatility solved from the last price, and
    their difference, for contracts with time left.

    ``chain``: symbol, strike_price, option_type (CE/PE), expiry_date (dd-MM-yyyy text),
    implied_volatility_nse (percent), last_price, underlying_value, fetched_at_utc.
    """
    r = rate if isinstance(rate, Column) else F.lit(float(rate))
    seconds = F.unix_timestamp(parse("expiry_date", DAY_MONTH_YEAR).cast("timestamp")) - F.unix_timestamp(F.col(stamp).cast("timestamp"))
    df = (
        chain.withColumn("risk_free_rate", r)
        .withColumn("t_years", seconds / (365.0 * 24 * 3600)).where("t_years > 0")
        .withColumn("_right", F.when(F.col("option_type") == "CE", "C").otherwise("P"))
        .withColumn("_v", F.coalesce(F.col("implied_volatility_nse"), F.lit(0.0)) / 100.0)
    )
    names = ("underlying_value", "strike_price", "t_years", "risk_free_rate", "_v", "_right")
    df = bs.with_price(bs.with_greeks(df, *names, prefix="nse_"), *names, out="_p")
    solved = implied_vol("last_price", *names[:4], "_right") * 100.0
    df = df.withColumn("implied_volatility_solved", F.when(F.col("last_price") != 0, solved))
    return df.select(
        "symbol", "strike_price", "option_type", "expiry_date", F.to_date(F.col(stamp)).alias("as_of_date"),
        "underlying_value", "risk_free_rate", *[f"nse_{n}" for n in bs.GREEKS],
        F.when(F.col("_v") > 0, F.col("_p")).alias("theoretical_price_at_nse_iv"),
        "implied_volatility_solved",
        (F.col("implied_volatility_solved") - F.coalesce("implied_volatility_nse", F.lit(0.0))).alias("iv_divergence_vs_nse"))


CONTRACT = ("symbol", "expiry_date", "strike_price", "option_type")


def ladder(chain: DataFrame, greeks: DataFrame | None = None) -> DataFrame:
    """One row per (symbol, expiry, strike), calls left and puts right."""
    df = chain if greeks is None else chain.join(greeks.select(*CONTRACT, "nse_delta"), list(CONTRACT), "left")
    fields = [("open_interest", "oi"), ("change_in_oi", "oi_chg"), ("last_price", "ltp"), ("implied_volatility_nse", "iv")]
    if greeks is not None:
        fields.append(("nse_delta", "delta"))
    sides = [F.max(F.when(F.col("option_type") == leg, F.col(c))).alias(f"{side}_{short}")
             for leg, side in (("CE", "call"), ("PE", "put")) for c, short in fields]
    return df.groupBy("symbol", "expiry_date", "strike_price").agg(F.max("underlying_value").alias("underlying"), *sides)


def nearest_strikes(rungs: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` strikes of each symbol and expiry nearest to spot."""
    from pyspark.sql import Window

    w = Window.partitionBy("symbol", "expiry_date").orderBy(F.abs(F.col("strike_price") - F.col("underlying")), "strike_price")
    return rungs.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
