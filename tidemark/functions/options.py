"""Black-Scholes-Merton price and Greeks as columns.

The steps are separate projections (d1 and d2, then the distribution at each), so every
intermediate value is computed once and the generated code stays small.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Coefficients of the double-precision normal distribution of Hart (1968).
NUM = (3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383,
       112.079291497871, 221.213596169931, 220.206867912376)
DEN = (8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461,
       296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752)
FLAT = 7.07106781186547          # beyond this the tail is under 1e-12 and taken as 0


def _horner(x, coefficients):
    acc = coefficients[0]
    for c in coefficients[1:]:
        acc = acc * x + c
    return acc


def norm_cdf(x: Column) -> Column:
    """Standard normal distribution."""
    a = F.abs(x)
    tail = F.when(a >= FLAT, F.lit(0.0)).otherwise(
        F.exp(-a * a / 2.0) * _horner(a, [F.lit(c) for c in NUM]) / _horner(a, [F.lit(c) for c in DEN]))
    return F.when(x > 0, 1.0 - tail).otherwise(tail)


def norm_pdf(x: Column) -> Column:
    return F.exp(-x * x / 2.0) / math.sqrt(2 * math.pi)


def _prepare(df: DataFrame, s, k, t, r, v, right, q: float) -> DataFrame:
    """Adds _side (1 call, -1 put), _d1, _d2, _n1, _n2 with the side applied."""
    S, K, T, R, V = (F.col(c) for c in (s, k, t, r, v))
    root = V * F.sqrt(F.greatest(T, F.lit(0.0)))
    df = df.withColumn("_side", F.when(F.col(right) == "C", F.lit(1.0)).otherwise(F.lit(-1.0)))
    df = df.withColumn("_d1", F.try_divide(F.log(S / K) + (R - q + V * V * 0.5) * T, root))
    df = df.withColumn("_d2", F.col("_d1") - root)
    df = df.withColumn("_s1", F.col("_side") * F.col("_d1")).withColumn("_s2", F.col("_side") * F.col("_d2"))
    return df.withColumn("_n1", norm_cdf(F.col("_s1"))).withColumn("_n2", norm_cdf(F.col("_s2")))


_TEMP = ("_side", "_d1", "_d2", "_s1", "_s2", "_n1", "_n2")


def with_price(df: DataFrame, s: str, k: str, t: str, r: str, v: str, right: str, out: str = "price", q: float = 0.0) -> DataFrame:
    """Adds the price; the intrinsic value once time or volatility has run out. ``right`` holds C or P."""
    S, K, T, R, V, side = (F.col(c) for c in (s, k, t, r, v, "_side"))
    value = side * (S * F.exp(-q * T) * F.col("_n1") - K * F.exp(-R * T) * F.col("_n2"))
    spent = F.greatest(F.lit(0.0), side * (S - K))
    return _prepare(df, s, k, t, r, v, right, q).withColumn(out, F.when((T <= 0) | (V <= 0), spent).otherwise(value)).drop(*_TEMP)


GREEKS = ("delta", "gamma", "vega", "theta", "rho")


def with_greeks(df: DataFrame, s: str, k: str, t: str, r: str, v: str, right: str, prefix: str = "", q: float = 0.0) -> DataFrame:
    """Adds delta, gamma, vega per point, theta per day, rho per point; NULL without time or volatility."""
    S, K, T, R, V, side, n1, n2 = (F.col(c) for c in (s, k, t, r, v, "_side", "_n1", "_n2"))
    grow, disc, root = F.exp(-q * T), F.exp(-R * T), F.sqrt(F.greatest(T, F.lit(0.0)))
    density = norm_pdf(F.col("_d1"))
    decay = F.try_divide(-S * grow * density * V, root * 2.0)
    values = {
        "delta": side * grow * n1,
        "gamma": F.try_divide(grow * density, S * V * root),
        "vega": S * grow * density * root / 100.0,
        "theta": (decay - side * R * K * disc * n2 + side * q * S * grow * n1) / 365.0,
        "rho": side * K * T * disc * n2 / 100.0,
    }
    alive = (T > 0) & (V > 0)
    df = _prepare(df, s, k, t, r, v, right, q)
    return df.select("*", *[F.when(alive, c).alias(prefix + n) for n, c in values.items()]).drop(*_TEMP)


# -- the same price on arrays, for the volatility solver ------------------------------

def norm_cdf_array(x: np.ndarray) -> np.ndarray:
    a = np.abs(x)
    with np.errstate(all="ignore"):
        tail = np.where(a >= FLAT, 0.0, np.exp(-a * a / 2.0) * _horner(a, NUM) / _horner(a, DEN))
    return np.where(x > 0, 1.0 - tail, tail)


def price_array(s, k, t, r, v, side, q=0.0) -> np.ndarray:
    root = v * np.sqrt(t)
    d1 = (np.log(s / k) + (r - q + v * v * 0.5) * t) / root
    return side * (s * np.exp(-q * t) * norm_cdf_array(side * d1) - k * np.exp(-r * t) * norm_cdf_array(side * (d1 - root)))
