"""Rainfall analytics on daily shipped quantity per region; two instruments by return flag."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import monsoon as mo
from tidemark.plans.bindings import rainfall, rainfall_sql, stored_rainfall, table
from tidemark.plans.registry import query

MAIN, OTHER = rainfall_sql("p", "l_returnflag = 'N'"), rainfall_sql("s", "l_returnflag <> 'N'")
YEARS = (1996, 1997, 1998)


def _sums(name: str, src: str, bound: str = "(month(date) < 9 OR day(date) <= 30)") -> str:
    return f"""{name} AS (SELECT CAST(year(date) AS INTEGER) AS year, region, sum(rain_mm_per_day) AS cumulative_mm, count(*) AS days FROM {src}
      WHERE month(date) BETWEEN 6 AND 9 AND {bound} GROUP BY 1, 2)"""


@query("season_sums", f"WITH {MAIN}, {_sums('ss', 'p', '(month(date) < 8 OR (month(date) = 8 AND day(date) <= 15))')} SELECT * FROM ss")
def season_sums(spark, sf):
    return mo.season_sums(rainfall(spark, sf, True), 8, 15)


NORMALS = """nm AS (SELECT region, round_even(avg(cumulative_mm), 1) AS normal_mm, round_even(stddev_samp(cumulative_mm), 1) AS normal_sd, count(*) AS n_years, '1995-1999' AS climatology
  FROM ps WHERE year BETWEEN 1995 AND 1999 GROUP BY region)"""


@query("rainfall_normals", f"WITH {MAIN}, {_sums('ps', 'p')}, {NORMALS} SELECT * FROM nm")
def rainfall_normals(spark, sf):
    return mo.normals(mo.season_sums(rainfall(spark, sf, True)), 1995, 1999)


BIAS = f"""bi AS (SELECT a.region, a.year, a.cumulative_mm AS a, b.cumulative_mm AS b FROM sss a JOIN ps b USING (year, region) WHERE a.year IN {YEARS} AND a.days >= 0.9 * b.days),
  bias AS (SELECT region, round_even(avg(a), 1) AS cpc_mm, round_even(avg(b), 1) AS imd_mm, count(DISTINCT year) AS n_years, round_even(avg(a) / avg(b), 4) AS ratio,
    (SELECT string_agg(y, ',' ORDER BY y) FROM (SELECT DISTINCT CAST(year AS VARCHAR) AS y FROM bi)) AS overlap_years FROM bi GROUP BY region)"""


@query("instrument_bias", f"WITH {MAIN}, {OTHER}, {_sums('ps', 'p')}, {_sums('sss', 's')}, {BIAS} SELECT * FROM bias")
def instrument_bias(spark, sf):
    return mo.instrument_bias(mo.season_sums(stored_rainfall(spark, sf, False)), mo.season_sums(stored_rainfall(spark, sf, True)), YEARS)


@query("season_departure", f"""WITH {MAIN}, {OTHER}, lt AS (SELECT max(date) AS d FROM (SELECT date FROM p UNION ALL SELECT date FROM s) WHERE month(date) BETWEEN 6 AND 9),
  {_sums('ps', 'p, lt', '(month(date) < month(d) OR (month(date) = month(d) AND day(date) <= day(d)))')}, {NORMALS}
  SELECT CAST(year(d) AS INTEGER) AS season_year, nm.region, d AS as_of, round_even(o.cumulative_mm, 1) AS observed_mm, normal_mm,
  round_even((o.cumulative_mm - normal_mm) / normal_mm * 100, 1) AS departure_pct, round_even((o.cumulative_mm - normal_mm) / normal_sd, 2) AS sigma, 'imd' AS basis,
  1.0::DOUBLE AS cpc_imd_ratio, o.days AS days_observed, climatology FROM nm, lt JOIN ps o ON o.year = year(d) WHERE o.region = nm.region""")
def season_departure(spark, sf):
    return mo.departure(stored_rainfall(spark, sf, True), stored_rainfall(spark, sf, False), YEARS, climatology=(1995, 1999))


CORRECTED = f"""WITH {rainfall_sql('p', "l_returnflag = 'N' AND l_shipdate < DATE '2001-01-01'")}, {OTHER},
  lt AS (SELECT max(date) AS d FROM (SELECT date FROM p UNION ALL SELECT date FROM s) WHERE month(date) BETWEEN 6 AND 9),
  {_sums('ps', 'p, lt', '(month(date) < month(d) OR (month(date) = month(d) AND day(date) <= day(d)))')},
  {_sums('sss', 's, lt', '(month(date) < month(d) OR (month(date) = month(d) AND day(date) <= day(d)))')}, {NORMALS}, {BIAS}
  SELECT CAST(year(d) AS INTEGER) AS season_year, nm.region, round_even(o.cumulative_mm / ratio, 1) AS observed_mm, normal_mm,
  round_even((o.cumulative_mm / ratio - normal_mm) / normal_mm * 100, 1) AS departure_pct, 'cpc_bias_corrected_to_imd' AS basis, ratio AS cpc_imd_ratio, o.days AS days_observed
  FROM nm, lt JOIN sss o ON o.year = year(d) JOIN bias b ON b.region = o.region WHERE o.region = nm.region"""


@query("season_departure_corrected", CORRECTED)
def season_departure_corrected(spark, sf):
    p = stored_rainfall(spark, sf, True).where("date < DATE '2001-01-01'")
    return mo.departure(p, stored_rainfall(spark, sf, False), YEARS, climatology=(1995, 1999)).select(
        "season_year", "region", "observed_mm", "normal_mm", "departure_pct", "basis", "cpc_imd_ratio", "days_observed")


PROGRESS = """lp AS (SELECT max(date) AS d FROM s WHERE month(date) BETWEEN 6 AND 9),
  prog AS (SELECT CAST(year(d) AS INTEGER) AS season_year, region, d AS as_of, round_even(sum(rain_mm_per_day), 1) AS cumulative_mm, round_even(avg(rain_mm_per_day), 3) AS mean_mm_per_day,
    count(*) AS days_observed, CAST(d - make_date(year(d), 6, 1) + 1 AS INTEGER) AS season_days_elapsed, round_even(100.0::DOUBLE * count(*) / (d - make_date(year(d), 6, 1) + 1), 1) AS coverage_pct
    FROM s, lp WHERE month(date) BETWEEN 6 AND 9 AND year(date) = year(d) GROUP BY region, d)"""


@query("season_progress", f"WITH {OTHER}, {PROGRESS} SELECT * FROM prog")
def season_progress(spark, sf):
    return mo.progress(rainfall(spark, sf, False))


def oni(spark, sf):
    """Monthly anomaly: deviation of mean order value from 2.5e5, in units of 1e4."""
    names = ("DJF", "JFM", "FMA", "MAM", "AMJ", "MJJ", "JJA", "JAS", "ASO", "SON", "OND", "NDJ")
    o = table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("m")).agg(
        F.round((F.avg("o_totalprice") - 250000) / 10000, 2).alias("anomaly_c"))
    phase = F.when(F.col("anomaly_c") >= 0.5, "el_nino").when(F.col("anomaly_c") <= -0.5, "la_nina").otherwise("neutral")
    return o.select(F.element_at(F.array(*[F.lit(n) for n in names]), F.col("m")).alias("season"), "year", "anomaly_c",
                    F.concat_ws("-", F.col("year").cast("string"), F.lpad(F.col("m").cast("string"), 2, "0")).alias("period"), phase.alias("phase"))


ONI = """oni AS (SELECT ['DJF','JFM','FMA','MAM','AMJ','MJJ','JJA','JAS','ASO','SON','OND','NDJ'][month(o_orderdate)] AS season, CAST(year(o_orderdate) AS INTEGER) AS year,
    round((avg(o_totalprice) - 250000) / 10000, 2) AS anomaly_c, year(o_orderdate) || '-' || lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS period FROM orders GROUP BY ALL),
  onp AS (SELECT *, CASE WHEN anomaly_c >= 0.5 THEN 'el_nino' WHEN anomaly_c <= -0.5 THEN 'la_nina' ELSE 'neutral' END AS phase FROM oni),
  six AS (SELECT * FROM onp ORDER BY year DESC, period DESC LIMIT 6),
  ens AS (SELECT l.season AS as_of_season, l.year AS as_of_year, l.period, l.anomaly_c, l.phase, round_even(l.anomaly_c - f.anomaly_c, 2) AS anomaly_change_6_seasons,
    CASE WHEN l.anomaly_c - f.anomaly_c > 0.25 THEN 'strengthening' WHEN l.anomaly_c - f.anomaly_c < -0.25 THEN 'decaying' ELSE 'stable' END AS trajectory,
    l.season IN ('AMJ', 'MJJ') AS is_leading_monsoon_season, (SELECT count(*) - 1 FROM onp s WHERE s.season = l.season) AS prior_years_same_season,
    (SELECT round_even(count(*) FILTER (phase = 'el_nino') / count(*), 3) FROM onp s WHERE s.season = l.season) AS prior_el_nino_share,
    (SELECT round_even(count(*) FILTER (phase = 'la_nina') / count(*), 3) FROM onp s WHERE s.season = l.season) AS prior_la_nina_share
    FROM six l, six f WHERE l.period = (SELECT max(period) FROM six) AND f.period = (SELECT min(period) FROM six))"""


@query("enso_state", f"WITH {ONI} SELECT * FROM ens")
def enso_state(spark, sf):
    return mo.enso_state(oni(spark, sf))
