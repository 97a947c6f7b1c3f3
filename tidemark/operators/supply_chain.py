"""Transit counts per corridor: deviations, rerouting, structural breaks, current regime.

The panel has one row per (date, corridor). Every step is an aggregation, a join or a window; no series is gathered.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import ratio
from tidemark.operators.asof import collapse, known_by
from tidemark.session import materialise

# Windows, thresholds and known substitute routes.
BASELINE_DAYS, RECENT_DAYS, MIN_BASELINE_OBS = 90, 14, 30
METRICS = ("n_total", "n_tanker", "n_cargo", "capacity")
SUBSTITUTE_ROUTE = {
    "Bab el-Mandeb Strait": "Cape of Good Hope",
    "Suez Canal": "Cape of Good Hope",
    "Strait of Hormuz": None,
    "Panama Canal": "Magellan Strait",
}
MIN_SEGMENT_DAYS, BREAK_T = 45, 8.0
HARMONICS, MIN_SEASONAL_YEARS, YEAR_DAYS = 2, 2.0, 365.25


def transit_panel(rows: DataFrame, as_of=None, vintages: bool = True, key: Sequence[str] = ("portname", "date")) -> DataFrame:
    """One row per (date, corridor) from raw vintages, on dates up to ``as_of``."""
    panel = collapse(rows, key) if vintages else rows
    return known_by(panel, as_of, "date")


def deviation(panel: DataFrame, baseline_days: int = BASELINE_DAYS, recent_days: int = RECENT_DAYS,
              metrics: Sequence[str] = METRICS, min_baseline: int = MIN_BASELINE_OBS) -> DataFrame:
    """Recent mean of each metric against the baseline window that ends where it begins.

    The windows hang on the newest date of the whole panel and never overlap. A flat
    baseline gives a NULL score. All statistics are conditional aggregates over one pass.
    """
    latest = panel.agg(F.max("date").alias("m")).scalar()
    df = panel.withColumn("_latest", latest)
    df = df.where(F.col("date") > F.date_sub("_latest", recent_days + baseline_days))
    recent = F.col("date") > F.date_sub("_latest", recent_days)
    long = df.withColumn("_recent", recent).select("portname", "_latest", "_recent", *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        ["portname", "_latest", "_recent"], list(metrics), "metric", "v")
    old, new = F.when(~F.col("_recent"), F.col("v")), F.when(F.col("_recent"), F.col("v"))
    g = long.groupBy("portname", "metric", "_latest").agg(
        F.count_if(~F.col("_recent")).alias("n_old"), F.count_if("_recent").alias("n_new"),
        F.avg(old).alias("bm"), F.stddev_samp(old).alias("bs"), F.avg(new).alias("rm"))
    z = F.when(F.col("bs") > 0, (F.col("rm") - F.col("bm")) / F.nullif(F.col("bs"), F.lit(0.0)))
    return g.where((F.col("n_old") >= min_baseline) & (F.col("n_new") > 0)).select(
        F.col("_latest").alias("as_of"), "portname", "metric", F.bround("rm", 2).alias("recent_mean"), F.bround("bm", 2).alias("baseline_mean"),
        F.bround("bs", 2).alias("baseline_std"), F.bround(z, 2).alias("zscore"),
        F.bround(ratio(F.col("rm") - F.col("bm"), F.col("bm")) * 100, 1).alias("pct_change"),
        F.lit(recent_days).alias("recent_days"), F.lit(baseline_days).alias("baseline_days"))


def reroute_balance(scores: DataFrame, substitutes: Mapping[str, str | None] | None = None) -> DataFrame:
    """Did the traffic a corridor lost reappear on its substitute?

    Works on the rounded means of ``deviation``. The absorbed share exists only for a
    falling corridor; a corridor without any substitute is its own answer.
    """
    routes = SUBSTITUTE_ROUTE if substitutes is None else substitutes
    totals = scores.where(F.col("metric") == "n_total").select("as_of", "portname", (F.col("recent_mean") - F.col("baseline_mean")).alias("change"))
    pairs = totals.sparkSession.createDataFrame(list(routes.items()), "corridor string, substitute string")
    s = totals.select(F.col("portname").alias("substitute"), F.col("change").alias("_s"))
    df = pairs.join(totals.withColumnRenamed("portname", "corridor"), "corridor").join(s, "substitute", "left")
    c, sc = F.col("change"), F.col("_s")
    absorbed = F.bround(F.when(c < 0, -100.0 * sc / F.nullif(c, F.lit(0.0))), 1)
    kind = (
        F.when(F.col("substitute").isNull(), "no_substitute_route").when(c >= 0, "corridor_not_falling")
        .when(absorbed >= 60, "rerouted").when(absorbed >= 25, "partially_rerouted").otherwise("traffic_destroyed")
    )
    return df.select("as_of", "corridor", "substitute", F.bround(c, 2).alias("corridor_change_per_day"),
                     F.bround(sc, 2).alias("substitute_change_per_day"), absorbed.alias("absorbed_pct"), kind.alias("interpretation"))


# -- structural breaks ----------------------------------------------------------------

#: Days of a corridor whose running sums are one window; sums of whole blocks are added before them.
BLOCK_DAYS = 512


def season_terms(day: Column, harmonics: int = HARMONICS) -> list[Column]:
    """A constant, and the sines and cosines of an annual cycle."""
    phase = F.dayofyear(day) * F.lit(2 * math.pi / YEAR_DAYS)
    return [F.lit(1.0), *[F.sin(phase * k) for k in range(1, harmonics + 1)], *[F.cos(phase * k) for k in range(1, harmonics + 1)]]


def solved(sums: DataFrame, width: int) -> DataFrame:
    """Columns c0, c1, ... of the normal equations in a{i}_{j} (i <= j) and b{i}, by elimination, one step per projection.

    A term that the others determine gets no weight.
    """
    usable = lambda k: F.abs(F.col(f"a{k}_{k}")) > F.lit(1e-9) * F.col("n_ok")
    for k in range(width):
        factor = {i: F.when(usable(k), F.col(f"a{k}_{i}") / F.col(f"a{k}_{k}")).otherwise(0.0) for i in range(k + 1, width)}
        sums = sums.withColumns({**{f"a{i}_{j}": F.col(f"a{i}_{j}") - factor[i] * F.col(f"a{k}_{j}") for i in factor for j in range(i, width)},
                                 **{f"b{i}": F.col(f"b{i}") - factor[i] * F.col(f"b{k}") for i in factor}})
    for k in reversed(range(width)):
        rest = F.col(f"b{k}")
        for j in range(k + 1, width):
            rest = rest - F.col(f"a{k}_{j}") * F.col(f"c{j}")
        sums = sums.withColumn(f"c{k}", F.when(usable(k), rest / F.col(f"a{k}_{k}")).otherwise(0.0))
    return sums


def remove_season(panel: DataFrame, metric: str, harmonics: int = HARMONICS) -> DataFrame:
    """(portname, date, v, r): residuals of an annual harmonic fit; only centred when the span cannot identify one. Missing values have residual 0.

    A low-order fit cannot represent a level shift, so breaks survive it. The fit needs sums only: one aggregation per corridor, and a join of its
    few coefficients back to the days.
    """
    v = F.col(metric).cast("double")
    days = panel.select("portname", "date", F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v).alias("v"))
    terms = season_terms(F.col("date"), harmonics)
    width = len(terms)
    here = lambda x: F.sum(F.when(F.col("v").isNotNull(), x))
    sums = days.groupBy("portname").agg(
        F.count("v").alias("n_ok"), F.avg("v").alias("mean"), F.datediff(F.max("date"), F.min("date")).alias("span"),
        *[here(terms[i] * terms[j]).alias(f"a{i}_{j}") for i in range(width) for j in range(i, width)], *[here(terms[i] * F.col("v")).alias(f"b{i}") for i in range(width)])
    long = (F.col("span") / YEAR_DAYS >= MIN_SEASONAL_YEARS) & (F.col("n_ok") > width)
    fits = solved(sums, width).select(F.col("portname").alias("p"), "mean", long.alias("long"), *[f"c{k}" for k in range(width)])
    fit = F.col("c0") * terms[0]
    for k in range(1, width):
        fit = fit + F.col(f"c{k}") * terms[k]
    level = F.when(F.col("long"), fit).otherwise(F.col("mean"))
    return days.join(fits, days["portname"] == fits["p"]).select("portname", "date", "v", F.coalesce(F.col("v") - level, F.lit(0.0)).alias("r"))


def running(residuals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(portname, date, pos, total, square) of every day, with the sums before it, and (portname, hi, total, square) of whole series.

    In two levels: inside a block of days, and over the sums of blocks. So a long series is many tasks.
    """
    blocks = residuals.withColumn("block", F.floor(F.unix_date("date") / BLOCK_DAYS))
    sums = [F.count(F.lit(1)).alias("n"), F.sum("r").alias("s"), F.sum(F.col("r") * F.col("r")).alias("q")]
    per = blocks.groupBy("portname", "block").agg(*sums)
    earlier = Window.partitionBy("portname").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda x: F.coalesce(F.sum(x).over(earlier), F.lit(0))
    offsets = per.select(F.col("portname").alias("p"), F.col("block").alias("k"), zero("n").alias("n0"), zero("s").alias("s0"), zero("q").alias("q0"))
    inside = Window.partitionBy("portname", "block").orderBy("date")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    own = blocks.select("portname", "date", "block", F.row_number().over(inside).alias("i"), F.coalesce(F.sum("r").over(before), F.lit(0.0)).alias("s"),
                        F.coalesce(F.sum(F.col("r") * F.col("r")).over(before), F.lit(0.0)).alias("q"))
    days = own.join(offsets, (own["portname"] == offsets["p"]) & (own["block"] == offsets["k"])).select(
        "portname", "date", (F.col("n0") + F.col("i") - 1).alias("pos"), (F.col("s0") + F.col("s")).alias("total"), (F.col("q0") + F.col("q")).alias("square"))
    return days, per.groupBy("portname").agg(F.sum("n").alias("hi"), F.sum("s").alias("total"), F.sum("q").alias("square"))


def shift_t() -> Column:
    """Welch t of a mean shift at ``pos`` of [lo, hi), from the running sums at the three."""
    def part(n: Column, s: Column, q: Column) -> tuple[Column, Column]:
        mean = s / n
        return mean, F.greatest((q - n * mean * mean) / (n - 1), F.lit(1e-12)) / n
    c = F.col
    m1, v1 = part(c("pos") - c("lo"), c("total") - c("total_lo"), c("square") - c("square_lo"))
    m2, v2 = part(c("hi") - c("pos"), c("total_hi") - c("total"), c("square_hi") - c("square"))
    return F.abs(m1 - m2) / F.sqrt(v1 + v2)


def split_dates(panel: DataFrame, metric: str, min_segment_days: int, threshold: float) -> DataFrame:
    """(portname, break_date, t_stat) of every shift, by binary segmentation.

    Every round scores all places of all open segments at once, keeps the best of each, and opens the halves of those with a shift, until none has
    one. A round is a join with the few open segments and one aggregation; nothing is gathered.
    """
    days, ends = running(materialise(remove_season(panel, metric)))
    days = materialise(days)
    low = {"lo": F.lit(0).cast("long"), "total_lo": F.lit(0.0), "square_lo": F.lit(0.0)}
    whole = materialise(ends.select("portname", "hi", F.col("total").alias("total_hi"), F.col("square").alias("square_hi")).withColumns(low))
    bounds = ["lo", "total_lo", "square_lo", "hi", "total_hi", "square_hi"]
    open_segments, rounds = whole, []
    while True:
        places = days.join(open_segments, "portname").where((F.col("pos") >= F.col("lo") + min_segment_days) & (F.col("pos") <= F.col("hi") - min_segment_days))
        scored = places.withColumn("t", shift_t())
        best = scored.groupBy("portname", *bounds).agg(F.max(F.struct("t", (-F.col("pos")).alias("back"), "pos", "total", "square", "date")).alias("at"))
        found = materialise(best.where(F.col("at.t") >= threshold))
        if found.isEmpty():
            break
        rounds.append(found.select("portname", "at.pos", "at.total", "at.square", "at.date"))
        at = [F.col("at.pos"), F.col("at.total"), F.col("at.square")]
        open_segments = found.select("portname", *bounds[:3], *[x.alias(n) for x, n in zip(at, bounds[3:])]).unionByName(
            found.select("portname", *[x.alias(n) for x, n in zip(at, bounds[:3])], *bounds[3:]))
    if not rounds:
        return days.where("false").select("portname", F.col("date").alias("break_date"), F.lit(0.0).alias("t_stat"))
    splits = reduce(DataFrame.unionByName, rounds).join(whole, "portname")
    order = Window.partitionBy("portname").orderBy("pos")
    near = {f"{n}_{side}": F.coalesce(move(n).over(order), F.col(f"{n}_{side}")) for side, move in (("lo", F.lag), ("hi", F.lead)) for n in ("total", "square")}
    sides = splits.withColumns({**near, "lo": F.coalesce(F.lag("pos").over(order), F.col("lo")), "hi": F.coalesce(F.lead("pos").over(order), F.col("hi"))})
    return sides.select("portname", F.col("date").alias("break_date"), shift_t().alias("t_stat"))


def regime_breaks(panel: DataFrame, metric: str = "n_total", min_segment_days: int = MIN_SEGMENT_DAYS,
                  threshold: float = BREAK_T) -> DataFrame:
    """Dated level shifts of each corridor, with raw means of the segments either side.

    A day belongs to the segment that its newest break on or before it opens, so the means are one
    running count of breaks and one aggregation.
    """
    splits = split_dates(panel, metric, min_segment_days, threshold)
    days = panel.select("portname", "date", F.col(metric).cast("double").alias("v"))
    in_order = Window.partitionBy("portname").orderBy("date")
    marked = days.join(splits.withColumnRenamed("break_date", "date"), ["portname", "date"], "left")
    marked = marked.withColumn("segment", F.count("t_stat").over(in_order))
    segments = marked.groupBy("portname", "segment").agg(
        F.min("date").alias("break_date"), F.max("t_stat").alias("t_stat"), F.avg("v").alias("mean"), F.count(F.lit(1)).cast("int").alias("days"))
    by_segment = Window.partitionBy("portname").orderBy("segment")
    both = segments.withColumns({"before": F.lag("mean").over(by_segment), "days_before": F.lag("days").over(by_segment)})
    change = F.col("mean") - F.col("before")
    return both.where("segment > 0").select(
        "portname", "break_date", F.lit(metric).alias("metric"), F.bround("before", 2).alias("mean_before"), F.bround("mean", 2).alias("mean_after"),
        F.bround(change, 2).alias("change_per_day"), F.bround(F.when(F.col("before") != 0, change / F.col("before") * 100), 1).alias("pct_change"),
        F.bround("t_stat", 1).alias("t_stat"), "days_before", F.col("days").alias("days_after"))


def current_regime(panel: DataFrame, breaks: DataFrame, metric: str = "n_total", recent_days: int = RECENT_DAYS) -> DataFrame:
    """Each corridor against its current regime, the regime before, and the world before any
    break. A corridor without breaks is in its original regime. The newest date is its own."""
    b = breaks.groupBy("portname").agg(F.max("break_date").alias("last"), F.min("break_date").alias("first"),
                                       F.max_by("mean_before", "break_date").alias("prev"))
    ends = panel.groupBy("portname").agg(F.max("date").alias("latest"), F.min("date").alias("start"))
    bounds = ends.join(b, "portname", "left").withColumn("regime_start", F.coalesce("last", "start"))
    df = panel.select("portname", "date", F.col(metric).cast("double").alias("v")).join(bounds, "portname")
    inside = F.col("date") >= F.col("regime_start")
    recent = F.col("date") > F.date_sub("latest", recent_days)
    base = F.col("first").isNull() | (F.col("date") < F.col("first"))
    val = F.col("v")
    g = df.groupBy("portname", "latest", "regime_start", "prev").agg(
        F.count_if(inside).alias("n"), F.avg(F.when(inside, val)).alias("rm"), F.stddev_samp(F.when(inside, val)).alias("rs"),
        F.count_if(recent).alias("n_recent"), F.avg(F.when(recent, val)).alias("cm"), F.avg(F.when(base, val)).alias("bm"))
    pct = lambda a, c: F.bround(ratio(a - c, c) * 100, 1)
    return g.where("n > 0 AND n_recent > 0").select(
        F.col("latest").alias("as_of"), "portname", F.lit(metric).alias("metric"), "regime_start", F.col("n").alias("days_in_regime"),
        F.bround("rm", 2).alias("regime_mean"), F.bround("cm", 2).alias("recent_mean"),
        F.bround(F.when(F.col("rs") > 0, (F.col("cm") - F.col("rm")) / F.nullif(F.col("rs"), F.lit(0.0))), 2).alias("z_vs_regime"),
        F.bround("prev", 2).alias("previous_regime_mean"), pct(F.col("rm"), F.col("prev")).alias("regime_vs_previous_pct"),
        F.bround("bm", 2).alias("baseline_mean"), pct(F.col("rm"), F.col("bm")).alias("vs_baseline_pct"))
