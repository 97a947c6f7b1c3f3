"""Insider transactions and clusters of open-market buying."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import DAY_MON_YEAR, parse
from tidemark.functions.scalar import lookup, to_double

# Transaction codes.
TRANSACTION_CODES = {
    "P": "open-market purchase",
    "S": "open-market sale",
    "A": "grant/award",
    "D": "disposition to issuer",
    "F": "tax withholding",
    "M": "option exercise",
    "G": "gift",
    "C": "conversion",
    "X": "option expiration/exercise",
    "J": "other acquisition/disposition",
    "V": "voluntary early report",
}
OPEN_MARKET_BUY = ("P",)
ROLES = ("officer", "director", "tenpercentowner")     # most informative first


def role(relationship: str | Column) -> Column:
    text = F.lower(F.coalesce(F.col(relationship) if isinstance(relationship, str) else relationship, F.lit("")))
    out = None
    for name in ROLES:
        hit = F.contains(text, F.lit(name))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("other")


def insider_transactions(trans: DataFrame, submissions: DataFrame, owners: DataFrame, quarter: str) -> DataFrame:
    """One row per reported transaction, with its filing and one owner.

    A filing can list several owners. They are reduced to the lowest CIK and a count before
    the join, so no trade is multiplied; both right sides have one row per accession. The
    count is a partial aggregate and the choice is cut to one row per filing in each task before the shuffle, so a filing agent
    with very many rows does not gather in one task.
    """
    key = "ACCESSION_NUMBER"
    facts = ("RPTOWNERCIK", "RPTOWNERNAME", "RPTOWNER_RELATIONSHIP", "RPTOWNER_TITLE")
    first = lambda df, by: (df.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(*by)))
                            .where("_rn = 1").select(key, *by))
    counts = owners.groupBy(key).agg(F.count(F.lit(1)).alias("n_owners_on_filing"))
    primary = first(owners, facts).join(counts, key)
    subs = first(submissions, ("DOCUMENT_TYPE", "ISSUERCIK", "ISSUERNAME", "ISSUERTRADINGSYMBOL", "FILING_DATE", "AFF10B5ONE"))
    df = trans.where(F.col(key).isNotNull()).join(subs, key, "left").join(primary, key, "left")
    shares, price = to_double("TRANS_SHARES"), to_double("TRANS_PRICEPERSHARE")
    traded, filed = parse("TRANS_DATE", DAY_MON_YEAR), parse("FILING_DATE", DAY_MON_YEAR)
    title = F.lower(F.coalesce("SECURITY_TITLE", F.lit("")))
    return df.select(
        F.col(key).alias("accn"), F.col("DOCUMENT_TYPE").alias("form_type"), F.col("ISSUERCIK").try_cast("bigint").alias("issuer_cik"),
        F.col("ISSUERNAME").alias("issuer_name"), F.col("ISSUERTRADINGSYMBOL").alias("ticker"),
        F.col("RPTOWNERCIK").try_cast("bigint").alias("owner_cik"), F.col("RPTOWNERNAME").alias("owner_name"),
        F.col("RPTOWNER_RELATIONSHIP").alias("relationship"), F.col("RPTOWNER_TITLE").alias("owner_title"),
        F.col("SECURITY_TITLE").alias("security_title"), F.col("TRANS_CODE").alias("trans_code"),
        F.col("TRANS_ACQUIRED_DISP_CD").alias("acquired_disposed"), shares.alias("shares"), price.alias("price_per_share"),
        to_double("SHRS_OWND_FOLWNG_TRANS").alias("shares_owned_after"), F.col("DIRECT_INDIRECT_OWNERSHIP").alias("direct_indirect"),
        "n_owners_on_filing", F.col("NONDERIV_TRANS_SK").alias("trans_sk"), traded.alias("trans_date"), filed.alias("filed"),
        F.date_diff(filed, traded).alias("days_to_file"), (shares * price).alias("value_usd"),
        F.coalesce(lookup(TRANSACTION_CODES, "TRANS_CODE"), F.lit("unknown")).alias("trans_desc"),
        (F.contains(title, F.lit("common")) & ~F.contains(title, F.lit("preferred"))).alias("is_common_stock"),
        F.coalesce(F.col("TRANS_CODE").isin(*OPEN_MARKET_BUY), F.lit(False)).alias("is_open_market_buy"),
        F.coalesce(F.col("TRANS_CODE") == "S", F.lit(False)).alias("is_sale"),
        F.coalesce(F.col("AFF10B5ONE").isin("1", "true", "TRUE"), F.lit(False)).alias("plan_10b5_1"),
        role("RPTOWNER_RELATIONSHIP").alias("role"), F.lit(quarter).alias("quarter"))


def economic_trades(buys: DataFrame, first_by: Sequence[str] = ("filed", "accn")) -> DataFrame:
    """One row per (issuer, date, size, price): related filers report the same trade twice.

    The row kept is the first filed.
    """
    key = ["issuer_cik", "trans_date", "shares", "price_per_share"]
    w = Window.partitionBy(*key).orderBy(*[F.asc_nulls_last(c) for c in first_by])
    return buys.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def _covering(days: DataFrame, window_days: int, name: str) -> DataFrame:
    """Distinct people per issuer inside [d, d + window] for each day d, as step changes.

    A person who traded on day p is inside the windows that start on p - window .. p. Each
    trade day covers the part of that span its previous trade day does not, so the spans of
    one person never overlap and adding +1 at the start and -1 after the end counts people,
    not trades. ``days`` has distinct (issuer_cik, owner_cik, trans_date).
    """
    w = Window.partitionBy("issuer_cik", "owner_cik").orderBy("trans_date")
    prev = F.lag("trans_date").over(w)
    lo = F.greatest(F.date_sub("trans_date", window_days), F.coalesce(F.date_add(prev, 1), F.date_sub("trans_date", window_days)))
    spans = days.withColumn("_lo", lo)
    steps = spans.select("issuer_cik", F.explode(F.array(
        F.struct(F.col("_lo").alias("day"), F.lit(1).alias("step")),
        F.struct(F.date_add("trans_date", 1).alias("day"), F.lit(-1).alias("step")))).alias("x"))
    return steps.groupBy("issuer_cik", F.col("x.day").alias("day")).agg(F.sum("x.step").alias(name))


def cluster_buys(tx: DataFrame, window_days: int = 30, min_insiders: int = 2, min_value: float = 50_000.0,
                 common_stock_only: bool = True) -> DataFrame:
    """Earliest window per issuer in which several different insiders bought.

    Every trade day of an issuer is the start of a window of ``window_days``. Trades are
    first reduced to one row per (issuer, day) and people to step changes per (issuer, day),
    so an issuer with a third of all trades costs its number of calendar days, and no trade
    is ever paired with another.
    """
    buys = tx.where(F.col("is_open_market_buy") & (F.col("value_usd") >= min_value))
    if common_stock_only and "is_common_stock" in tx.columns:
        buys = buys.where("is_common_stock")
    buys = economic_trades(buys).where("trans_date IS NOT NULL AND issuer_cik IS NOT NULL")

    daily = buys.groupBy("issuer_cik", F.col("trans_date").alias("day")).agg(
        F.count(F.lit(1)).alias("n_tx"), F.sum("value_usd").alias("value"), F.min("filed").alias("first_filed"),
        F.min(F.struct("filed", "accn", "issuer_name", "ticker")).alias("who"))
    people = buys.where("owner_cik IS NOT NULL").groupBy("issuer_cik", "owner_cik", "trans_date").agg(
        F.max((F.col("role") == "officer").cast("int")).alias("officer"),
        F.max((F.col("role") == "director").cast("int")).alias("director"))
    steps = None
    for name, part in (("insiders", people), ("officers", people.where("officer = 1")), ("directors", people.where("director = 1"))):
        one = _covering(part.select("issuer_cik", "owner_cik", "trans_date"), window_days, name)
        steps = one if steps is None else steps.unionByName(one, allowMissingColumns=True)
    steps = steps.groupBy("issuer_cik", "day").agg(*[F.sum(F.coalesce(n, F.lit(0))).alias(n) for n in ("insiders", "officers", "directors")])

    by_day = Window.partitionBy("issuer_cik").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy("issuer_cik").orderBy(F.unix_date("day")).rangeBetween(0, window_days)
    line = steps.join(daily, ["issuer_cik", "day"], "full").select(
        "issuer_cik", "day", "who", "n_tx",
        *[F.sum(F.coalesce(n, F.lit(0))).over(by_day).alias(n) for n in ("insiders", "officers", "directors")],
        F.sum("n_tx").over(ahead).alias("n_transactions"), F.sum("value").over(ahead).alias("total_value_usd"),
        F.min("first_filed").over(ahead).alias("first_filed"))
    hits = line.where(F.col("n_tx").isNotNull() & (F.col("insiders") >= min_insiders))
    w = Window.partitionBy("issuer_cik").orderBy("day")
    return (
        hits.withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
        .select("issuer_cik", "who.issuer_name", "who.ticker", F.col("day").alias("window_start"),
                F.date_add("day", window_days).alias("window_end"), F.col("insiders").alias("n_insiders"), "n_transactions",
                "total_value_usd", F.col("officers").alias("n_officers"), F.col("directors").alias("n_directors"), "first_filed",
                F.lit(window_days).alias("window_days"), F.lit(min_insiders).alias("min_insiders"))
    )
