"""Long reported facts: restatements, panels, pay against performance, holdings scale.

Every reduction groups by the whole key of a fact and is a partial aggregate or a bounded
rank, so one company or concept holding a third of all facts is spread over the map tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import any_true, lookup, ratio

# Fixed values.
CORE_TAXONOMIES = ("us-gaap", "dei")
FACT_KEY = ("taxonomy", "concept", "unit", "start", "end")
SCALE_POWERS = (3, 6, 9)
SCALE_TOLERANCE = 0.03
PAY_CONCEPTS = {
    "PeoTotalCompAmt": "CEO total compensation (as disclosed)",
    "PeoActuallyPaidCompAmt": "CEO compensation actually paid (equity marked to market)",
    "NonPeoNeoAvgTotalCompAmt": "Other named executives, average total compensation",
    "NonPeoNeoAvgCompActuallyPaidAmt": "Other named executives, average actually paid",
    "TotalShareholderRtnAmt": "Company total shareholder return (indexed)",
    "PeerGroupTotalShareholderRtnAmt": "Peer group total shareholder return (indexed)",
    "CoSelectedMeasureAmt": "Company-selected performance measure",
}
FUNDAMENTAL_FIELDS = {
    "revenue": (False, "USD", (("us-gaap", "Revenues"),
                               ("us-gaap", "RevenueFromContractWithCustomerExcludingAssessedTax"),
                               ("us-gaap", "RevenueFromContractWithCustomerIncludingAssessedTax"))),
    "net_income": (False, "USD", (("us-gaap", "NetIncomeLoss"), ("us-gaap", "ProfitLoss"))),
    "assets": (True, "USD", (("us-gaap", "Assets"),)),
    "equity": (True, "USD", (("us-gaap", "StockholdersEquity"),
                             ("us-gaap", "StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest"))),
    "shares_outstanding": (True, "shares", (("dei", "EntityCommonStockSharesOutstanding"),
                                            ("us-gaap", "CommonStockSharesOutstanding"),
                                            ("us-gaap", "CommonStockSharesIssued"))),
}


def restatements(facts: DataFrame, min_pct_change: float = 0.0, per: Sequence[str] = ("cik", "entity"),
                 exclude_scale_changes: bool = False) -> DataFrame:
    """Facts later reported with another value for the same concept and period.

    First and latest versions by filing date (accession breaks ties), the change between
    them, and whether the change looks like a switch of reporting scale: a ratio within a
    few percent of 10^3, 10^6 or 10^9. With the company in ``per`` the whole universe is
    one group by. NULL parts of the key (instants have no start) group together.
    """
    key = [*per, *FACT_KEY]
    known = facts.where("value IS NOT NULL AND filed IS NOT NULL")
    version = F.struct("filed", "accn", "value")
    # Versions are counted on distinct values: first per (key, value), then per key.
    by_value = known.groupBy(*key, "value").agg(F.min(version).alias("lo"), F.max(version).alias("hi"))
    g = by_value.groupBy(*key).agg(F.count(F.lit(1)).alias("n_versions"), F.min("lo").alias("first"), F.max("hi").alias("latest"))
    first, latest = F.col("first.value"), F.col("latest.value")
    change = latest - first
    rate = F.abs(ratio(latest, first))
    magnitude = F.abs(F.log10(F.when(rate > 0, rate)))
    scale = F.coalesce(any_true(F.abs(magnitude - p) < SCALE_TOLERANCE for p in SCALE_POWERS), F.lit(False))
    out = g.where("n_versions > 1").select(
        *key, first.alias("first_value"), F.col("first.filed").alias("first_filed"), F.col("first.accn").alias("first_accn"),
        latest.alias("latest_value"), F.col("latest.filed").alias("latest_filed"), F.col("latest.accn").alias("latest_accn"),
        "n_versions", change.alias("abs_change"), (ratio(change, F.abs(first)) * 100).alias("pct_change"), rate.alias("value_ratio"),
        scale.alias("looks_like_scale_change"))
    if min_pct_change:
        out = out.where(F.abs("pct_change") >= min_pct_change)
    return out.where("NOT looks_like_scale_change") if exclude_scale_changes else out


def concept_panel(facts: DataFrame, concepts: Sequence[tuple[str, str]]) -> DataFrame:
    """Facts of the chosen (taxonomy, concept) pairs; the filter reaches the scan."""
    wanted = [(F.col("taxonomy") == t) & (F.col("concept") == c) for t, c in concepts]
    return facts.where(any_true(wanted))


def non_core_taxonomies(facts: DataFrame, core: Sequence[str] = CORE_TAXONOMIES) -> DataFrame:
    """Concepts reported outside the two taxonomies almost everyone uses, with fact counts."""
    return facts.where(~F.col("taxonomy").isin(*core)).groupBy("cik", "entity", "taxonomy", "concept").agg(F.count(F.lit(1)).alias("n_facts"))


def fundamentals_panel(facts: DataFrame, filing_dates: DataFrame, universe: DataFrame | None = None,
                       fields: Mapping[str, tuple] | None = None) -> DataFrame:
    """One value per (company, field, period): the first alias the company uses wins.

    ``facts``: cik, entity, taxonomy, concept, unit, end, value, accn, period (without the
    instant suffix). ``filing_dates``: accn, filed, form. A row without a filing date stays
    and says so.
    """
    fields = fields or FUNDAMENTAL_FIELDS
    alias = {}
    for name, (instant, unit, concepts) in fields.items():
        for i, (tax, concept) in enumerate(concepts):
            alias[f"{tax}\t{concept}\t{unit}"] = f"{name}\t{i}\t{'I' if instant else ''}"
    hit = F.split(lookup(alias, F.concat_ws("\t", "taxonomy", "concept", "unit")), "\t")
    df = facts.withColumn("_hit", hit).where("_hit IS NOT NULL").select(
        "*", F.col("_hit")[0].alias("field"), F.col("_hit")[1].cast("int").alias("_rank"), F.col("_hit")[2].alias("_suffix"))
    if universe is not None:
        df = df.join(universe.select(F.col("cik").cast("bigint").alias("cik")).distinct(), "cik", "left_semi")
    w = Window.partitionBy("cik", "field", "period").orderBy("_rank", F.desc("accn"))
    best = df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
    dates = filing_dates.groupBy("accn").agg(F.min(F.struct("filed", "form")).alias("d")).select("accn", "d.filed", "d.form")
    return best.select("cik", "entity", "field", "value", F.concat("period", "_suffix").alias("period"), "end", "concept", "taxonomy", "accn") \
        .join(dates, "accn", "left").withColumn("filed_source", F.when(F.col("filed").isNotNull(), "submissions").otherwise("unmatched"))


def pay_versus_performance(facts: DataFrame, concepts: Mapping[str, str] | None = None, taxonomy: str = "ecd") -> DataFrame:
    """Long panel of pay and shareholder-return facts per (company, fiscal year, concept)."""
    concepts = concepts or PAY_CONCEPTS
    return facts.where((F.col("taxonomy") == taxonomy) & F.col("concept").isin(*concepts)).select(
        "cik", "entity", F.year("end").cast("string").alias("fiscal_year"), "concept", lookup(concepts, "concept").alias("meaning"),
        "value", "unit", "start", "end", "form", "filed", "accn")


def pay_vs_tsr(pvp: DataFrame, tsr: str = "TotalShareholderRtnAmt", peer: str = "PeerGroupTotalShareholderRtnAmt",
               paid: str = "PeoActuallyPaidCompAmt", total: str = "PeoTotalCompAmt") -> DataFrame:
    """One row per (company, year): pay premium, return against peers, and whether pay went
    up while the return lagged. The first reported value of a concept is used."""
    first = lambda c: F.min_by("value", F.when((F.col("concept") == c) & F.col("value").isNotNull(), F.struct("filed", "accn")))
    wide = pvp.groupBy("cik", "entity", "fiscal_year").agg(
        first(total).alias("ceo_pay_disclosed"), first(paid).alias("ceo_pay_actually_paid"),
        first(tsr).alias("company_tsr"), first(peer).alias("peer_tsr"))
    premium = ratio(F.col("ceo_pay_actually_paid"), F.col("ceo_pay_disclosed"))
    gap = F.col("company_tsr") - F.col("peer_tsr")
    return wide.select("cik", "entity", "fiscal_year", "ceo_pay_disclosed", "ceo_pay_actually_paid", premium.alias("pay_premium"),
                       "company_tsr", "peer_tsr", gap.alias("tsr_vs_peer"),
                       F.coalesce((premium > 1) & (gap < 0), F.lit(False)).alias("pay_up_performance_down"))


def value_scale(holdings: DataFrame, filing: str = "accn", value: str = "value_reported", shares: str = "shares_or_principal") -> DataFrame:
    """Whether each filing reports dollars or thousands: a portfolio whose median implied
    price is under 1 is in thousands.

    The median itself is not needed, only its side of 1. That follows from how many prices
    are under 1 and, when they are exactly half, from the largest under and the smallest
    not under 1, so a filing of any size is a handful of running numbers.
    """
    implied = F.when((F.col(shares) > 0) & F.col(value).isNotNull(), F.col(value) / F.nullif(F.col(shares), F.lit(0)))
    under = F.when(implied < 1.0, implied)
    g = holdings.groupBy(filing).agg(F.count(implied).alias("n"), F.count(under).alias("u"), F.max(under).alias("lo"), F.min(F.when(implied >= 1.0, implied)).alias("hi"))
    thousands = (F.col("u") * 2 > F.col("n")) | ((F.col("u") * 2 == F.col("n")) & ((F.col("lo") + F.col("hi")) / 2.0 < 1.0))
    scale = F.when(F.col("n") == 0, "unknown").when(thousands, "thousands").otherwise("dollars")
    return g.select(filing, scale.alias("value_scale"), F.when(scale == "thousands", 1000.0).otherwise(1.0).alias("_factor"))


def scaled_holdings(holdings: DataFrame, filing: str = "accn", value: str = "value_reported", shares: str = "shares_or_principal") -> DataFrame:
    # A row per filing, so it grows with the table; what is parsed from documents is estimated too small and must not be broadcast.
    scale = value_scale(holdings, filing, value, shares).hint("merge")
    return holdings.join(scale, filing).withColumn("value_usd", F.col(value) * F.col("_factor")).drop("_factor")


def holdings_summary(filings: DataFrame, holdings: DataFrame, filers: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(holdings with filer name and type, notices without holdings, counts by scale)."""
    names = filers.select("cik", "filer_name", "filer_type")
    reports = scaled_holdings(holdings).join(names, "cik", "left")
    notices = filings.where("NOT holdings_report").join(names, "cik", "left")
    counts = reports.groupBy("value_scale").agg(F.count(F.lit(1)).alias("rows"), F.sum("value_usd").alias("value_usd"))
    return reports, notices, counts
