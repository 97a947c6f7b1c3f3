"""Seasonal rainfall against normal, and the state of the Pacific oscillation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import ratio

# Fixed values.
MONSOON_MONTHS = (6, 7, 8, 9)
LEADING_SEASONS = ("AMJ", "MJJ")
CLIMATOLOGY = (1991, 2020)
MIN_COVERAGE = 0.9


def enso_state(oni: DataFrame) -> DataFrame:
    """One row: newest season, its phase, the change over six seasons and base rates of the
    same season. ``oni``: season, year, anomaly_c, period, phase, one row per (season, year)."""
    at = F.struct("year", "period")
    last = oni.orderBy(F.desc("year"), F.desc("period")).limit(6).agg(
        F.max(F.struct("year", "period", "season", "anomaly_c", "phase")).alias("l"),
        F.min_by("anomaly_c", at).alias("oldest")).select("l.*", "oldest")
    last = last.withColumnRenamed("season", "as_of_season")
    same = oni.groupBy(F.col("season").alias("as_of_season")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("phase") == "el_nino").alias("nino"), F.count_if(F.col("phase") == "la_nina").alias("nina"))
    change = F.col("anomaly_c") - F.col("oldest")
    return last.join(same, "as_of_season").select(
        "as_of_season", F.col("year").alias("as_of_year"), "period", "anomaly_c", "phase",
        F.bround(change, 2).alias("anomaly_change_6_seasons"),
        F.when(change > 0.25, "strengthening").when(change < -0.25, "decaying").otherwise("stable").alias("trajectory"),
        F.col("as_of_season").isin(*LEADING_SEASONS).alias("is_leading_monsoon_season"), (F.col("n") - 1).alias("prior_years_same_season"),
        F.bround(F.col("nino") / F.col("n"), 3).alias("prior_el_nino_share"), F.bround(F.col("nina") / F.col("n"), 3).alias("prior_la_nina_share"))


def season_sums(rain: DataFrame, upto_month: Column | int = 9, upto_day: Column | int = 30) -> DataFrame:
    """Total and number of days per (year, region) from 1 June to the same calendar day of
    every year. ``rain`` has one row per (date, region)."""
    um = F.lit(upto_month) if isinstance(upto_month, int) else upto_month
    ud = F.lit(upto_day) if isinstance(upto_day, int) else upto_day
    m, d = F.month("date"), F.dayofmonth("date")
    inside = m.isin(*MONSOON_MONTHS) & ((m < um) | ((m == um) & (d <= ud)))
    return rain.where(inside).groupBy(F.year("date").alias("year"), "region").agg(
        F.sum("rain_mm_per_day").alias("cumulative_mm"), F.count(F.lit(1)).alias("days"))


def normals(sums: DataFrame, first: int = CLIMATOLOGY[0], last: int = CLIMATOLOGY[1]) -> DataFrame:
    """Mean and deviation of the season totals over the climatology years."""
    return sums.where(F.col("year").between(first, last)).groupBy("region").agg(
        F.bround(F.avg("cumulative_mm"), 1).alias("normal_mm"), F.bround(F.stddev_samp("cumulative_mm"), 1).alias("normal_sd"),
        F.count(F.lit(1)).alias("n_years")).withColumn("climatology", F.lit(f"{first}-{last}"))


def instrument_bias(secondary: DataFrame, primary: DataFrame, years: Sequence[int], min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """Ratio of two instruments' season totals over years where both exist and the secondary
    one observed enough of the days. Inputs are ``season_sums``."""
    a = secondary.select("year", "region", F.col("cumulative_mm").alias("a"), F.col("days").alias("da"))
    b = primary.select("year", "region", F.col("cumulative_mm").alias("b"), F.col("days").alias("db"))
    both = a.join(b, ["year", "region"]).where(F.col("year").isin(*years) & (F.col("da") >= min_coverage * F.col("db")))
    used = both.agg(F.array_join(F.array_sort(F.collect_set(F.col("year").cast("string"))), ",").alias("y")).scalar()   # at most len(years) values
    return both.groupBy("region").agg(F.avg("a").alias("ma"), F.avg("b").alias("mb"), F.count_distinct("year").alias("n_years")).select(
        "region", F.bround("ma", 1).alias("cpc_mm"), F.bround("mb", 1).alias("imd_mm"), "n_years",
        F.bround(ratio(F.col("ma"), F.col("mb")), 4).alias("ratio"), used.alias("overlap_years"))


def newest_season_day(*rain: DataFrame) -> DataFrame:
    """One row: the newest observed day inside a season over all instruments."""
    days = None
    for r in rain:
        one = r.where(F.month("date").isin(*MONSOON_MONTHS)).agg(F.max("date").alias("d"))
        days = one if days is None else days.unionByName(one)
    return days.agg(F.max("d").alias("latest"))


def departure(primary: DataFrame, secondary: DataFrame, overlap_years: Sequence[int], season_year: int | None = None,
              climatology: tuple[int, int] = CLIMATOLOGY) -> DataFrame:
    """Season to date against the primary instrument's normal, per region.

    The observation is the primary instrument's where it exists. Otherwise it is the
    secondary's, divided by the measured ratio of the two when the primary has nothing for
    the season at all; without a ratio it is shown uncorrected and no departure is given.
    The normal is cut to the same calendar day.
    """
    day = newest_season_day(primary, secondary)
    latest = day.scalar()
    with_day = lambda df: df.withColumn("_latest", latest)
    sums = {}
    for name, df in (("p", primary), ("s", secondary)):
        d = with_day(df)
        sums[name] = season_sums(d, F.month("_latest"), F.dayofmonth("_latest"))
    year = F.year(latest) if season_year is None else F.lit(season_year)
    norm = normals(sums["p"], *climatology)
    obs_p = sums["p"].where(F.col("year") == year).select("region", F.col("cumulative_mm").alias("_p"), F.col("days").alias("_pd"))
    obs_s = sums["s"].where(F.col("year") == year).select("region", F.col("cumulative_mm").alias("_s"), F.col("days").alias("_sd"))
    primary_rows = obs_p.agg(F.count(F.lit(1)).alias("n")).scalar()
    bias = instrument_bias(sums["s"], sums["p"], overlap_years).select("region", F.when(primary_rows == 0, F.col("ratio")).alias("_r"))
    df = norm.join(obs_p, "region", "left").join(obs_s, "region", "left").join(bias, "region", "left")
    has_p, has_s, has_r = F.col("_p").isNotNull(), F.col("_s").isNotNull(), F.coalesce(F.col("_r") != 0, F.lit(False))
    basis = F.when(has_p, "imd").when(has_r, "cpc_bias_corrected_to_imd").otherwise("cpc_uncorrected")
    seen = F.when(has_p, F.col("_p")).when(has_r, ratio(F.col("_s"), F.col("_r"))).otherwise(F.col("_s"))
    gap = seen - F.col("normal_mm")
    comparable = basis != "cpc_uncorrected"
    return df.where(has_p | has_s).select(
        year.alias("season_year"), "region", latest.alias("as_of"), F.bround(seen, 1).alias("observed_mm"), "normal_mm",
        F.bround(F.when(comparable, ratio(gap, F.col("normal_mm")) * 100), 1).alias("departure_pct"),
        F.bround(F.when(comparable & (F.col("normal_sd") > 0), ratio(gap, F.col("normal_sd"))), 2).alias("sigma"), basis.alias("basis"),
        F.when(has_p, F.lit(1.0)).when(has_r, F.bround("_r", 4)).alias("cpc_imd_ratio"),
        F.when(has_p, F.col("_pd")).otherwise(F.col("_sd")).alias("days_observed"), "climatology")


def progress(rain: DataFrame, season_year: int | None = None) -> DataFrame:
    """Season to date per region with the share of elapsed days that were observed."""
    season = rain.where(F.month("date").isin(*MONSOON_MONTHS))
    newest = season.agg(F.max(F.year("date")).alias("y")).scalar() if season_year is None else F.lit(season_year)
    cur = season.where(F.year("date") == newest)
    latest = cur.agg(F.max("date").alias("d")).scalar()
    g = cur.groupBy("region").agg(F.sum("rain_mm_per_day").alias("t"), F.avg("rain_mm_per_day").alias("m"), F.count(F.lit(1)).alias("days_observed"))
    g = g.withColumn("as_of", latest)
    elapsed = F.date_diff("as_of", F.make_date(F.year("as_of"), F.lit(6), F.lit(1))) + 1
    return g.select(F.year("as_of").alias("season_year"), "region", "as_of", F.bround("t", 1).alias("cumulative_mm"), F.bround("m", 3).alias("mean_mm_per_day"),
                    "days_observed", elapsed.alias("season_days_elapsed"), F.bround(100.0 * F.col("days_observed") / elapsed, 1).alias("coverage_pct"))
