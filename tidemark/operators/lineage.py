"""Where a computed view comes from, down to the archived files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import materialise

# Inputs of each computed view, in order.
EVENT_INPUTS = ("nse_bulk_deals", "nse_block_deals", "nse_insider_trading", "nse_participant_oi", "nse_shareholding_pattern")
UPSTREAM = {
    "derived_capm_beta": ("nse_bhavcopy",),
    "derived_correlation": ("nse_bhavcopy",),
    "derived_pairs_candidates": ("nse_bhavcopy",),
    "derived_momentum_zscore": ("nse_bhavcopy",),
    "derived_variance_ratio": ("nse_bhavcopy",),
    "derived_corporate_events": ("bse_announcements", "bse_scrip_master"),
    "derived_fii_source_divergence": ("nse_participant_oi", "upstox_fii_activity"),
    "derived_option_greeks": ("nse_optchain", "rbi_key_indicators"),
    "derived_factor_model": ("derived_momentum_zscore", "derived_size_factor", "derived_low_vol_factor"),
    "derived_size_factor": ("bse_scrip_master", "nse_bhavcopy"),
    "derived_low_vol_factor": ("nse_bhavcopy",),
    "derived_digest": ("derived_capm_beta", "derived_momentum_zscore", "derived_bulk_block_anomaly"),
    "derived_multivariate_outliers": ("derived_capm_beta", "derived_momentum_zscore", "derived_bulk_block_anomaly", "derived_promoter_holding_change"),
    "derived_india_gold_premium": ("ibja_rates", "cme_settlements", "mcx_bhavcopy"),
    "analytics_chokepoint_zscore": ("portwatch_chokepoints",),
    "analytics_current_regime": ("portwatch_chokepoints",),
    "analytics_regime_breaks": ("portwatch_chokepoints",),
    "analytics_reroute_balance": ("portwatch_chokepoints",),
    "analytics_monsoon_departure": ("cpc_india_rainfall", "imd_gridded_rainfall"),
    "analytics_monsoon_progress": ("cpc_india_rainfall",),
    "analytics_imd_normals": ("imd_gridded_rainfall",),
    "analytics_enso_state": ("noaa_oni",),
    "derived_bulk_block_anomaly": EVENT_INPUTS,
    "derived_fii_dii_divergence": EVENT_INPUTS,
    "derived_insider_filing_frequency": EVENT_INPUTS,
    "derived_promoter_holding_change": EVENT_INPUTS,
}
APPROXIMATE = ("derived_bulk_block_anomaly", "derived_fii_dii_divergence", "derived_insider_filing_frequency", "derived_promoter_holding_change")
RAW_DATASETS = {
    "care_rating_actions": ("care/rating_rationale_listing",),
    "screener_financial_facts": ("screener/export",),
    "rbi_forex_reserves": ("rbi/dbie_foreignExchangeReserves",),
    "rbi_key_indicators": ("rbi/nsdp_policy_rates", "rbi/policy_rates"),
    "rbi_money_market_operations": ("rbi/press_release",),
    "rbi_press_release_index": ("rbi/press_release_index",),
    "sec_13f_holdings": ("sec/13f_information_table",),
    "sec_13f_notices": ("sec/13f_information_table",),
    "sec_13d_filings": ("sec/13d",),
    "sec_13d_persons": ("sec/13d",),
    "sec_13g_filings": ("sec/13g",),
    "sec_13g_persons": ("sec/13g",),
    "sec_8k_items": ("sec/filing_index",),
    "sec_insider_transactions": ("sec/insider_bulk",),
    "sec_us_fundamentals": ("sec/companyfacts", "sec/companyfacts_bulk"),
    "sec_companyfacts_restatements": ("sec/companyfacts", "sec/companyfacts_bulk"),
    "sec_sp500_constituents": ("sec/ticker_map",),
}
COMPUTED_PREFIXES = ("derived_", "analytics_")


def edges(spark: SparkSession, upstream: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    rows = [(v, i, u) for v, ups in (UPSTREAM if upstream is None else upstream).items() for i, u in enumerate(ups)]
    return spark.createDataFrame(rows, "view string, ordinal int, upstream string")


def raw_links(spark: SparkSession, views: Sequence[str] = ()) -> DataFrame:
    """(view, raw_dataset): declared links first, else the dataset of the same name."""
    rows = [(v, r) for v, rs in RAW_DATASETS.items() for r in rs]
    for v in views:
        source, _, dataset = v.partition("_")
        if v not in RAW_DATASETS and not v.startswith(COMPUTED_PREFIXES):
            rows.append((v, f"{source}/{dataset}"))
    return spark.createDataFrame(rows, "view string, raw_dataset string")


STEP = 5  # characters of one step of a visit: the edge's number in four digits and a dot


def first_visits(edge: DataFrame, root: str, max_depth: int | None = None) -> DataFrame:
    """(view, visit, path) of every view reached from ``root``: its first visit in depth-first order.

    That visit is the smallest path in the order of edge numbers, and a smallest path is made of smallest paths. So a frontier of views
    whose visit is new or became smaller goes on from round to round, and everything that is not is left out by a join with the visits
    known; a view holds one visit however many paths lead to it. The edges are dealt and sorted by view once, a round deals its frontier to them.
    """
    edge = materialise(edge.select("view", "ordinal", "upstream").repartition("view").sortWithinPartitions("view")).hint("merge")
    known = frontier = edge.sparkSession.createDataFrame([(root, "", root)], "view string, visit string, path string")
    while True:
        onward = frontier if max_depth is None else frontier.where(F.length("visit") <= STEP * max_depth)
        step = onward.join(edge, "view").select(
            F.col("upstream").alias("view"), F.struct(below().alias("visit"), F.concat_ws(" > ", "path", "upstream").alias("path")).alias("way"))
        found = step.groupBy("view").agg(F.min("way").alias("way")).select("view", "way.*")
        before = known.select(F.col("view").alias("seen"), F.col("visit").alias("before"))
        frontier = materialise(found.join(before, found["view"] == before["seen"], "left")
                               .where(F.col("before").isNull() | (F.col("visit") < F.col("before"))).select("view", "visit", "path"))
        if frontier.isEmpty():
            return known
        known = materialise(known.join(frontier.select("view"), "view", "left_anti").unionByName(frontier))


def below() -> Column:
    """The visit of an edge's far end."""
    return F.concat("visit", F.lpad(F.col("ordinal").cast("string"), STEP - 1, "0"), F.lit("."))


def trace(edge: DataFrame, root: str, max_depth: int | None = None, approximate: Sequence[str] = APPROXIMATE) -> DataFrame:
    """Every node reached from ``root`` in depth-first order, one row per visit.

    A view met again is marked repeated and not opened again. With a ``max_depth`` a node deeper than it is marked truncated and not opened.
    """
    firsts = first_visits(edge, root, max_depth)
    if max_depth is not None:
        # a view may have been reached through a visit that was given up later for an earlier one too deep to go on
        above = F.transform(F.sequence(F.lit(1), (F.length("visit") / STEP).cast("int")), lambda i: F.substr(F.col("visit"), F.lit(1), i * STEP))
        lost = firsts.where("visit <> ''").select("view", F.explode(above).alias("above")).join(firsts.select(F.col("visit").alias("above")), "above", "left_anti")
        firsts = materialise(firsts.join(lost.select("view").distinct(), "view", "left_anti"))
    opened = firsts if max_depth is None else firsts.where(F.length("visit") <= STEP * max_depth)
    visits = opened.join(edge.hint("merge"), "view").select(F.col("upstream").alias("view"), below().alias("visit"), F.concat_ws(" > ", "path", "upstream").alias("path"))
    visits = firsts.where("visit = ''").unionByName(visits)
    first = firsts.select(F.col("view").alias("v"), F.col("visit").alias("first"))
    depth = (F.length("visit") / STEP).cast("int")
    computed = F.lit(False)
    for p in COMPUTED_PREFIXES:
        computed = computed | F.startswith(F.col("view"), F.lit(p))
    truncated = F.lit(False) if max_depth is None else depth > max_depth
    return visits.join(first, visits["view"] == first["v"]).select(
        "view", depth.alias("depth"), "visit", "path", computed.alias("computed"), F.col("view").isin(*approximate).alias("approximate"),
        (F.col("visit") > F.col("first")).alias("repeated"), truncated.alias("truncated"))


def raw_files_behind(traced: DataFrame, links: DataFrame, manifest: DataFrame) -> DataFrame:
    """Archived files behind each traced view. ``manifest``: source, dataset, path, bytes, fetched_at_utc, sha256."""
    m = manifest.withColumn("raw_dataset", F.concat_ws("/", "source", "dataset"))
    return traced.where("NOT repeated").select("view").join(links, "view").join(m, "raw_dataset").select(
        "view", "raw_dataset", "path", "bytes", "fetched_at_utc", "sha256")


def vintages_of(table: DataFrame, view: str, vintage: str = "_vintage_id") -> DataFrame:
    """Stored vintages of a view with their rows, newest last in name order."""
    return table.groupBy(F.col(vintage).alias("vintage")).agg(F.count(F.lit(1)).alias("rows")).withColumn("view", F.lit(view))
