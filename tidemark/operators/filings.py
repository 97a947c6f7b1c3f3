"""Regulatory filings: event items, ownership schedules, ratings, name matching."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import names
from tidemark.functions.classify import action_class, purpose_flags
from tidemark.functions.dates import previous_quarter
from tidemark.functions.scalar import any_true, lookup

# Event item codes with description and tier.
ITEM_CODES = {
    "1.01": ("Entry into a Material Definitive Agreement", "high"),
    "1.02": ("Termination of a Material Definitive Agreement", "high"),
    "1.03": ("Bankruptcy or Receivership", "critical"),
    "1.04": ("Mine Safety - Reporting of Shutdowns", "low"),
    "1.05": ("Material Cybersecurity Incident", "critical"),
    "2.01": ("Completion of Acquisition or Disposition of Assets", "high"),
    "2.02": ("Results of Operations and Financial Condition", "high"),
    "2.03": ("Creation of a Direct Financial Obligation", "medium"),
    "2.04": ("Triggering Events That Accelerate a Financial Obligation", "critical"),
    "2.05": ("Costs Associated with Exit or Disposal Activities", "medium"),
    "2.06": ("Material Impairments", "critical"),
    "3.01": ("Notice of Delisting or Failure to Satisfy a Listing Rule", "critical"),
    "3.02": ("Unregistered Sales of Equity Securities", "medium"),
    "3.03": ("Material Modification to Rights of Security Holders", "medium"),
    "4.01": ("Changes in Registrant's Certifying Accountant", "critical"),
    "4.02": ("Non-Reliance on Previously Issued Financial Statements", "critical"),
    "5.01": ("Changes in Control of Registrant", "critical"),
    "5.02": ("Departure or Election of Directors or Officers", "high"),
    "5.03": ("Amendments to Articles or Bylaws; Change in Fiscal Year", "low"),
    "5.04": ("Temporary Suspension of Trading Under Employee Benefit Plans", "medium"),
    "5.05": ("Amendment to Code of Ethics", "low"),
    "5.06": ("Change in Shell Company Status", "medium"),
    "5.07": ("Submission of Matters to a Vote of Security Holders", "low"),
    "5.08": ("Shareholder Director Nominations", "medium"),
    "6.01": ("ABS Informational and Computational Material", "low"),
    "6.02": ("Change of Servicer or Trustee", "low"),
    "6.03": ("Change in Credit Enhancement or Other External Support", "medium"),
    "6.04": ("Failure to Make a Required Distribution", "critical"),
    "6.05": ("Securities Act Updating Disclosure", "low"),
    "7.01": ("Regulation FD Disclosure", "low"),
    "8.01": ("Other Events", "low"),
    "9.01": ("Financial Statements and Exhibits", "low"),
}
RED_FLAG_ITEMS = ("1.03", "2.04", "2.06", "3.01", "4.01", "4.02", "6.04")
PROXY_FORMS = ("DEF 14A", "DEFA14A", "DEFR14A", "PRE 14A", "PREC14A", "DEFC14A")
ACTIVE_FORMS = ("SCHEDULE 13D", "SCHEDULE 13D/A")
PASSIVE_FORMS = ("SCHEDULE 13G", "SCHEDULE 13G/A")
ARCHIVES = "https://www.sec.gov/Archives/edgar/data"


def document_url(cik: str, accn: str, document: str) -> Column:
    folder = F.replace(F.col(accn), F.lit("-"), F.lit(""))
    return F.when(F.coalesce(F.col(document), F.lit("")) != "",
                  F.concat_ws("/", F.lit(ARCHIVES), F.col(cik).cast("bigint").cast("string"), folder, F.col(document)))


def event_items(filings: DataFrame, since: str | None = None) -> DataFrame:
    """One row per (filing, item). The disclosure gap is only measured on original filings;
    an amendment repeats the old event date, so its gap is reported separately.

    ``filings``: cik, accn, form, items (comma list), report_date, filed, primary_document.
    """
    df = filings if since is None else filings.where(F.col("filed") >= F.lit(since).cast("date"))
    df = df.withColumn("item", F.explode(F.split(F.coalesce("items", F.lit("")), ","))).withColumn("item", F.trim("item")).where("item <> ''")
    gap = F.date_diff("filed", "report_date")
    amended = F.endswith(F.col("form"), F.lit("/A"))
    return df.select(
        "cik", "accn", "form", "item",
        F.coalesce(lookup({k: v[0] for k, v in ITEM_CODES.items()}, "item"), F.lit("Unknown item")).alias("item_description"),
        F.coalesce(lookup({k: v[1] for k, v in ITEM_CODES.items()}, "item"), F.lit("unknown")).alias("tier"),
        F.col("item").isin(*RED_FLAG_ITEMS).alias("is_red_flag"), amended.alias("is_amendment"), "report_date", "filed",
        F.when(~amended, gap).alias("days_to_file"), F.when(amended, gap).alias("amendment_lag_days"), "primary_document",
        document_url("cik", "accn", "primary_document").alias("document_url"))


def red_flags(items: DataFrame, since: str | None = None) -> DataFrame:
    out = items.where("is_red_flag")
    return out if since is None else out.where(F.col("filed") >= F.lit(since).cast("date"))


def proxy_filings(submissions: DataFrame) -> DataFrame:
    return submissions.where(F.col("form").isin(*PROXY_FORMS)).select(
        "cik", "accn", "form", "filed", "report_date", "primary_document", document_url("cik", "accn", "primary_document").alias("document_url"))


def discover(index: DataFrame, forms: Sequence[str], ciks: DataFrame | None = None, keep_order: Sequence[str] = ("filed", "cik")) -> DataFrame:
    """Distinct filings of some forms. A filing is indexed once per associated company.

    The company filter acts on accessions before duplicates are removed, because either
    associated company may be the one of interest. The first row in ``keep_order`` is kept.
    """
    hits = index.where(F.col("form").isin(*forms))
    if ciks is not None:
        wanted = hits.join(ciks.select("cik").distinct(), "cik", "left_semi").select("accn").distinct()
        hits = hits.join(wanted, "accn", "left_semi")
    w = Window.partitionBy("accn").orderBy(*keep_order)
    return hits.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn") \
        .withColumn("amendment", F.endswith(F.col("form"), F.lit("/A")))


def holdings_filings(index: DataFrame, ciks: DataFrame) -> DataFrame:
    """Institutional holdings reports and notices of the tracked filers."""
    return index.where(F.startswith(F.col("form"), F.lit("13F"))).join(ciks.select("cik").distinct(), "cik", "left_semi") \
        .withColumn("holdings_report", F.startswith(F.col("form"), F.lit("13F-HR"))).withColumn("amendment", F.endswith(F.col("form"), F.lit("/A")))


def with_purpose(filings: DataFrame, item4: str = "item4_purpose") -> DataFrame:
    flags = purpose_flags(item4)
    return filings.select("*", *[c.alias(n) for n, c in flags.items()])


def purpose_summary(filings: DataFrame) -> DataFrame:
    """Counts over one ingest: filings, amendments and each purpose flag."""
    from tidemark.functions.classify import PURPOSE_PATTERNS

    return filings.agg(F.count(F.lit(1)).alias("found"), F.count_if("amendment").alias("amendments"),
                       *[F.count_if(n).alias(n) for n in PURPOSE_PATTERNS],
                       F.count_if(any_true(F.col(n) for n in PURPOSE_PATTERNS)).alias("any_flag"))


def transitions(passive: DataFrame, active: DataFrame) -> DataFrame:
    """Holders that filed passively on an issuer and later filed actively on it.

    Passive person blocks carry no id, so the match is on issuer and normalised name. Both
    sides are reduced to one row per (issuer, spelling) before the join.
    """
    g = passive.where("issuer_cik IS NOT NULL AND person_name IS NOT NULL").groupBy("issuer_cik", "issuer_name", "person_name").agg(
        F.min("filed").alias("first_13g"), F.max("filed").alias("last_13g"), F.count(F.lit(1)).alias("n_13g"))
    d = active.where("issuer_cik IS NOT NULL AND person_name IS NOT NULL").groupBy("issuer_cik", "person_name").agg(
        F.min("filed").alias("first_13d"), F.count(F.lit(1)).alias("n_13d"))
    g = g.withColumn("_key", names.filer_key("person_name")).withColumnRenamed("person_name", "person_name_13g")
    d = d.withColumn("_key", names.filer_key("person_name")).withColumnRenamed("person_name", "person_name_13d")
    return g.join(d, ["issuer_cik", "_key"]).where("first_13d > first_13g").select(
        "issuer_cik", "issuer_name", "person_name_13g", "person_name_13d", "first_13g", "last_13g", "n_13g", "first_13d", "n_13d",
        F.date_diff("first_13d", "first_13g").alias("days_passive_first"))


def listed_names(*sources: tuple[DataFrame, str] | None) -> DataFrame:
    """Distinct normalised names seen in any listing source; a missing source is skipped."""
    parts = [df.select(names.listed_key(c).alias("listed_key")) for df, c in (s for s in sources if s is not None)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where("listed_key IS NOT NULL").distinct()


def tag_listing(df: DataFrame, name: str, listed: DataFrame) -> DataFrame:
    """Adds listing_status by normalised name."""
    known = listed.select("listed_key", F.lit(True).alias("_listed"))
    return df.withColumn("listed_key", names.listed_key(name)).join(known, "listed_key", "left").withColumn(
        "listing_status", F.when(F.col("_listed"), "Public (listed)").otherwise("Private/unlisted")).drop("_listed", "listed_key")


def match_constituents(holdings: DataFrame, tickers: DataFrame) -> DataFrame:
    """Registrant of each holding by name: exact key, then word-order free, then space free.

    The first key that hits decides and is recorded; unmatched holdings stay. ``holdings``
    has name; ``tickers`` has title, cik_padded, ticker, cik_str. The lowest cik wins a key.
    """
    methods = {
        "k_exact": lambda k: k,
        "k_sorted": names.sorted_tokens,
        "k_nospace": names.no_spaces,
    }

    def keyed(df, col_):
        base = df.withColumn("_k", names.issuer_key(col_))
        return base.select("*", *[fn(F.col("_k")).alias(n) for n, fn in methods.items()]).drop("_k")

    h, t = keyed(holdings, "name"), keyed(tickers, "title")
    hits = {f: [] for f in ("cik", "ticker", "edgar_title", "match_method")}
    for n in methods:
        best = t.groupBy(n).agg(F.min(F.struct("cik_str", "cik_padded", "ticker", "title")).alias(f"_{n}"))
        h = h.join(best, n, "left")
        m = F.col(f"_{n}")
        hits["cik"].append(m["cik_padded"])
        hits["ticker"].append(m["ticker"])
        hits["edgar_title"].append(m["title"])
        hits["match_method"].append(F.when(m.isNotNull(), n))
    found = [F.coalesce(*[F.when(hits["match_method"][i].isNotNull() & ~any_true(hits["match_method"][j].isNotNull() for j in range(i)), c)
                          for i, c in enumerate(cols)]).alias(f) for f, cols in hits.items()]
    return h.select(*holdings.columns, *found)


def rating_actions(listing: DataFrame, days_back: int | None = None, as_of: str | None = None) -> DataFrame:
    """Rating listing rows: one per action id, dated, classified, optionally a trailing window.

    ``listing``: action_id, company_name, rating_date (date), heading, document_url.
    """
    w = Window.partitionBy("action_id").orderBy(F.desc_nulls_last("rating_date"), "heading")
    out = listing.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn").withColumn("action_type", action_class("heading"))
    if days_back is not None:
        end = F.lit(as_of).cast("date") if as_of else out.agg(F.max("rating_date").alias("m")).scalar()
        out = out.where(F.col("rating_date") >= F.date_sub(end, days_back))
    return out


def company_contains(df: DataFrame, phrase: str, name: str = "company_name") -> DataFrame:
    """Case-insensitive substring search; % and _ are ordinary characters."""
    return df.where(F.contains(F.lower(name), F.lit(phrase.lower())))


def latest_reported_quarter(dates: DataFrame, day: str) -> DataFrame:
    """(year, quarter) before the newest date of the table."""
    return dates.agg(F.max(day).alias("d")).select(previous_quarter("d").alias("q")).select("q.*")
