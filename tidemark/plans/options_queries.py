"""Option pricing on parts: retail price as strike, size as days to expiry."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import options as bs
from tidemark.operators import options as op
from tidemark.plans.bindings import OPTIONS, options
from tidemark.plans.registry import query


def _poly(x: str, coefficients) -> str:
    acc = f"{coefficients[0]!r}::DOUBLE"
    for c in coefficients[1:]:
        acc = f"({acc} * {x} + {c!r}::DOUBLE)"
    return acc


def cdf_sql(x: str) -> str:
    """The normal distribution of the column expression, in SQL."""
    a, e = f"abs({x})", f"exp(-({x}) * ({x}) / 2)"
    tail = f"CASE WHEN {a} >= {bs.FLAT} THEN 0.0::DOUBLE ELSE {e} * {_poly(a, bs.NUM)} / {_poly(a, bs.DEN)} END"
    return f"(CASE WHEN {x} > 0 THEN 1 - ({tail}) ELSE ({tail}) END)"


D12 = """d AS (SELECT *, (ln(spot / strike) + (rate + 0.5::DOUBLE * sigma * sigma) * t) / (sigma * sqrt(t)) AS d1,
    (ln(spot / strike) + (rate + 0.5::DOUBLE * sigma * sigma) * t) / (sigma * sqrt(t)) - sigma * sqrt(t) AS d2 FROM opt)"""
PRICED = f"""{OPTIONS}, {D12}, n AS (SELECT *, {cdf_sql('d1')} AS n1, {cdf_sql('d2')} AS n2, {cdf_sql('-d1')} AS m1, {cdf_sql('-d2')} AS m2,
    exp(-d1 * d1 / 2) / sqrt(2 * pi()) AS pdf, exp(-rate * t) AS disc FROM d),
  bsm AS (SELECT *, CASE "right" WHEN 'C' THEN spot * n1 - strike * disc * n2 ELSE strike * disc * m2 - spot * m1 END AS price FROM n)"""

ARGS = ("spot", "strike", "t", "rate", "sigma", "right")


@query("option_price", f"""WITH {PRICED} SELECT p_partkey, "right", round(price, 6) + 0 AS price FROM bsm""")
def option_price(spark, sf):
    return bs.with_price(options(spark, sf), *ARGS).select("p_partkey", "right", F.round("price", 6).alias("price"))


@query("option_greeks", f"""WITH {PRICED} SELECT p_partkey, "right",
  round(CASE "right" WHEN 'C' THEN n1 ELSE -m1 END, 6) + 0 AS delta, round(pdf / (spot * sigma * sqrt(t)), 6) AS gamma,
  round(spot * pdf * sqrt(t) / 100, 6) AS vega,
  round((-spot * pdf * sigma / (2 * sqrt(t)) - CASE "right" WHEN 'C' THEN rate * strike * disc * n2 ELSE -rate * strike * disc * m2 END) / 365, 6) + 0 AS theta,
  round(CASE "right" WHEN 'C' THEN strike * t * disc * n2 ELSE -strike * t * disc * m2 END / 100, 6) + 0 AS rho FROM bsm""")
def option_greeks(spark, sf):
    return bs.with_greeks(options(spark, sf), *ARGS).select("p_partkey", "right", *[F.round(n, 6).alias(n) for n in bs.GREEKS])


_P = """CASE "right" WHEN 'C' THEN spot * {n1} - strike * exp(-rate * t) * {n2} ELSE strike * exp(-rate * t) * {m2} - spot * {m1} END"""


def _price_sql(v: str) -> str:
    d1 = f"((ln(spot / strike) + (rate + 0.5::DOUBLE * {v} * {v}) * t) / ({v} * sqrt(t)))"
    d2 = f"({d1} - {v} * sqrt(t))"
    return "(" + _P.format(n1=cdf_sql(d1), n2=cdf_sql(d2), m1=cdf_sql(f"(-{d1})"), m2=cdf_sql(f"(-{d2})")) + ")"


@query("implied_vol", f"""WITH RECURSIVE {PRICED}, q AS (SELECT p_partkey, "right", spot, strike, t, rate, round(price, 2) AS last FROM bsm),
  ok AS (SELECT * FROM q WHERE {_price_sql('0.0001::DOUBLE')} <= last AND {_price_sql('5.0::DOUBLE')} >= last),
  it AS (SELECT *, 0.0001::DOUBLE AS lo, 5.0::DOUBLE AS hi, 0 AS i FROM ok
    UNION ALL SELECT p_partkey, "right", spot, strike, t, rate, last,
      CASE WHEN {_price_sql('((lo + hi) / 2)')} > last THEN lo ELSE (lo + hi) / 2 END,
      CASE WHEN {_price_sql('((lo + hi) / 2)')} > last THEN (lo + hi) / 2 ELSE hi END, i + 1 FROM it WHERE i < 60)
  SELECT q.p_partkey, q."right", round((lo + hi) / 2, 4) AS implied_vol FROM q LEFT JOIN it ON it.p_partkey = q.p_partkey
    AND it."right" = q."right" AND it.i = 60""")
def implied_vol(spark, sf):
    q = bs.with_price(options(spark, sf), *ARGS).withColumn("last", F.round("price", 2))
    return q.select("p_partkey", "right", F.round(op.implied_vol("last", "spot", "strike", "t", "rate", "right"), 4).alias("implied_vol"))


def chain(spark, sf):
    """Two snapshots; the later one is the one that is read."""
    o = bs.with_price(options(spark, sf), *ARGS).withColumn("last_price", F.round("price", 2))
    days = F.round(F.col("t") * 365).cast("int")
    base = o.select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("symbol"), F.col("strike").alias("strike_price"),
        F.when(F.col("right") == "C", "CE").otherwise("PE").alias("option_type"),
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), days), "dd-MM-yyyy").alias("expiry_date"),
        (F.col("p_partkey") % 977).alias("open_interest"), (F.col("p_partkey") % 53 - 26).alias("change_in_oi"),
        F.round(F.col("sigma") * 100, 4).alias("implied_volatility_nse"), "last_price", F.col("spot").alias("underlying_value"))
    return base.withColumn("fetched_at_utc", F.explode(F.array(F.lit("2023-12-31").cast("date").cast("timestamp_ntz"),
                                                               F.lit("2024-01-01").cast("date").cast("timestamp_ntz"))))


@query("chain_greeks", f"""WITH {PRICED} SELECT 'P' || p_partkey AS symbol, CASE "right" WHEN 'C' THEN 'CE' ELSE 'PE' END AS option_type,
  strftime(DATE '2024-01-01' + CAST(round(t * 365) AS INTEGER), '%d-%m-%Y') AS expiry_date, DATE '2024-01-01' AS as_of_date,
  round(CASE "right" WHEN 'C' THEN n1 ELSE -m1 END, 4) + 0 AS nse_delta, round(spot * pdf * sqrt(t) / 100, 4) AS nse_vega,
  round(price, 4) + 0 AS theoretical_price_at_nse_iv FROM bsm""")
def chain_greeks(spark, sf):
    rates = spark.createDataFrame([("Policy Repo Rate", "2023-06-01", 6.5), ("Policy Repo Rate", "2023-12-01", 5.25)],
                                  "indicator string, as_of string, value double")
    g = op.chain_greeks(op.latest_snapshot(chain(spark, sf)), op.risk_free_rate(rates))
    return g.select("symbol", "option_type", "expiry_date", "as_of_date", *[F.round(c, 4).alias(c) for c in (
        "nse_delta", "nse_vega", "theoretical_price_at_nse_iv")])


LADDER = f"""{PRICED}, lad AS (SELECT 'P' || p_partkey AS symbol, strftime(DATE '2024-01-01' + CAST(round(t * 365) AS INTEGER), '%d-%m-%Y') AS expiry_date,
  strike AS strike_price, max(spot) AS underlying, max(p_partkey % 977) AS call_oi, max(p_partkey % 53 - 26) AS call_oi_chg,
  max(CASE "right" WHEN 'C' THEN round(price, 2) END) AS call_ltp, max(round(sigma * 100, 4)) AS call_iv,
  max(p_partkey % 977) AS put_oi, max(p_partkey % 53 - 26) AS put_oi_chg, max(CASE "right" WHEN 'P' THEN round(price, 2) END) AS put_ltp,
  max(round(sigma * 100, 4)) AS put_iv,
  max(CASE "right" WHEN 'C' THEN round(n1, 4) + 0 END) AS call_delta, max(CASE "right" WHEN 'P' THEN round(-m1, 4) + 0 END) AS put_delta FROM bsm GROUP BY 1, 2, 3)"""


@query("option_ladder", f"WITH {LADDER} SELECT * FROM lad")
def option_ladder(spark, sf):
    return rungs(spark, sf)


def rungs(spark, sf):
    newest = op.latest_snapshot(chain(spark, sf))
    greeks = op.chain_greeks(newest, F.lit(0.0525)).withColumn("nse_delta", F.round("nse_delta", 4) + 0)
    return op.ladder(newest, greeks)


@query("nearest_strikes", f"""WITH {LADDER} SELECT * FROM lad
  QUALIFY row_number() OVER (PARTITION BY symbol, expiry_date ORDER BY abs(strike_price - underlying), strike_price) <= 20""")
def nearest_strikes(spark, sf):
    return op.nearest_strikes(rungs(spark, sf), 20)
