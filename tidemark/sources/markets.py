"""Exchange, commodity and central-bank files as typed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import UK_SLASHED, US_SLASHED, ist_date, parse
from tidemark.functions.scalar import digits_only, no_commas, to_double
from tidemark.sources.files import csv_rows

# Fixed values.
BULLION_GOLD = ("999", "995", "916", "750", "585")
SETTLEMENT_NUMBERS = ("open", "high", "low", "settle", "change", "volume", "openInterest")


def price_file(lines: DataFrame, header: Sequence[str], numeric: Sequence[str], required: Sequence[str] = (), dataset: str = "price file") -> DataFrame:
    """Headered exchange CSV with trimmed names and typed numbers."""
    rows = csv_rows(lines, header, required=required, dataset=dataset)
    return rows.select(*[to_double(f"`{c}`").alias(c) if c in numeric else F.col(f"`{c}`") for c in rows.columns])


def results_summary(docs: DataFrame) -> DataFrame:
    """Headline results: JSON inside a JSON string, three value columns melted to periods.
    ``docs``: scripcode, content."""
    ddl = "struct<col2: string, col3: string, col4: string, resultinCr: array<struct<title: string, v1: string, v2: string, v3: string>>>"
    inner = F.from_json("content", "array<string>")[0]
    d = docs.withColumn("_d", F.from_json(inner, ddl)).select("scripcode", "_d.col2", "_d.col3", "_d.col4", F.explode("_d.resultinCr").alias("r"))
    cells = F.array(*[F.struct(F.col(period).alias("period"), F.col(f"r.{v}").alias("v")) for v, period in (("v1", "col2"), ("v2", "col3"), ("v3", "col4"))])
    return d.select("scripcode", F.col("r.title").alias("concept"), F.explode(cells).alias("c")).select(
        "scripcode", "concept", F.col("c.period").alias("period"), no_commas("c.v").alias("value"))


def settlements(docs: DataFrame) -> DataFrame:
    """Settlement rows in curve order. ``docs``: product, trade_date_requested, content.

    The Total row is an aggregate of the curve and has no place in the order; the order of
    the others is their position, never their price. The window runs over one document.
    """
    text = ", ".join(f"{c}: string" for c in SETTLEMENT_NUMBERS)
    d = docs.withColumn("_d", F.from_json("content", f"struct<tradeDate: string, settlements: array<struct<month: string, {text}>>>"))
    rows = d.select("product", "trade_date_requested", F.col("_d.tradeDate").alias("trade_date_served"), F.posexplode("_d.settlements").alias("_p", "s"))
    total = F.lower(F.trim(F.col("s.month"))) == "total"
    w = Window.partitionBy("product", "trade_date_requested").orderBy("_p")
    order = F.sum(F.when(~total, 1).otherwise(0)).over(w) - 1
    return rows.select("product", "trade_date_requested", "trade_date_served", F.col("s.month").alias("month"), total.alias("is_total"),
                       F.when(~total, order).alias("contract_order"), *[F.col(f"s.{c}").alias(c) for c in SETTLEMENT_NUMBERS],
                       *[digits_only(f"s.{c}").alias(f"{c}_num") for c in SETTLEMENT_NUMBERS])


def answers(docs: DataFrame, record: str, flag: str, at: str) -> DataFrame:
    return docs.withColumn("_d", F.from_json("content", f"struct<`{flag}`: boolean, Message: string, `{at}`: array<struct<{record}>>>"))


def checked_records(docs: DataFrame, record: str, flag: str = "IsSuccess", at: str = "Data", strict: bool = False) -> DataFrame:
    """Rows of documents whose own success flag is set. The host answers 200 for anything.

    A failed answer is in ``failed_answers``; with ``strict`` it raises when it is read.
    """
    d = answers(docs, record, flag, at)
    good = F.coalesce(F.col(f"_d.{flag}"), F.lit(False))
    if strict:
        told = F.concat(F.lit("failed answer in "), "path", F.lit(": "), F.coalesce("_d.Message", F.lit("no message")))
        good = F.when(good, True).otherwise(F.raise_error(told).cast("boolean"))
    return d.where(good).select("path", F.explode(F.col(f"_d.{at}")).alias("_r")).select("path", "_r.*")


def failed_answers(docs: DataFrame, flag: str = "IsSuccess", at: str = "Data") -> DataFrame:
    """(path, reason, message) of documents that hold no successful answer: not JSON, no flag, or a flag that says no."""
    d = answers(docs, "_none: string", flag, at)
    is_json = F.try_parse_json("content").isNotNull()
    reason = F.when(~F.coalesce(is_json, F.lit(False)), "not JSON").when(F.col(f"_d.{flag}").isNull(), "no flag").when(~F.col(f"_d.{flag}"), "refused")
    return d.select("path", reason.alias("reason"), F.col("_d.Message").alias("message")).where("reason IS NOT NULL")


def commodity_bars(docs: DataFrame, strict: bool = False) -> DataFrame:
    """Bars of successful answers; others are in ``failed_answers``, or raise with ``strict``."""
    rows = checked_records(docs, "Date: string, Symbol: string, ExpiryDate: string, InstrumentName: string, StrikePrice: double, OptionType: string, Close: double, Volume: double",
                           strict=strict)
    return rows.withColumn("trade_date", parse("Date", US_SLASHED)).withColumn("Symbol", F.trim("Symbol"))


def bullion_rates(wide: DataFrame, purities: Sequence[str]) -> DataFrame:
    """Purity columns melted, one row per (date, session, purity). ``wide``: rate_date text, session."""
    long = wide.select("rate_date", "session", *[F.col(f"`{p}`").cast("string").alias(p) for p in purities]).unpivot(
        ["rate_date", "session"], list(purities), "metal_purity", "_v")
    metal = F.when(F.col("metal_purity").isin(*BULLION_GOLD), "gold").otherwise(F.lower(F.substring_index("metal_purity", " ", 1)))
    return long.select(parse("rate_date", UK_SLASHED).alias("rate_date"), F.upper("session").alias("session"), "metal_purity",
                       to_double("_v").alias("rate_inr_per_10g"), metal.alias("metal")).where("rate_inr_per_10g IS NOT NULL")


def keyed_activity(docs: DataFrame, record: str, interval: str) -> DataFrame:
    """Records keyed by segment, with the trading date in India of their epoch stamp."""
    d = F.from_json("content", f"struct<status: string, data: map<string, array<struct<time_stamp: bigint, {record}>>>>")
    rows = docs.select(d.alias("d")).where("d.status = 'success'").select(F.explode("d.data").alias("segment", "e")).select("segment", F.explode("e").alias("r"))
    return rows.select("segment", "r.*", ist_date("r.time_stamp").alias("trade_date"), F.lit(interval).alias("interval"))


LEG = ("expiryDate: string, openInterest: bigint, changeinOpenInterest: bigint, totalTradedVolume: bigint, impliedVolatility: double, lastPrice: double, "
       "change: double, buyPrice1: double, buyQuantity1: bigint, sellPrice1: double, sellQuantity1: bigint, underlyingValue: double")


def option_chain(docs: DataFrame) -> DataFrame:
    """One row per (strike, CE or PE); a missing leg is skipped. ``docs``: symbol, fetched_at_utc, content."""
    d = F.from_json("content", f"struct<records: struct<underlyingValue: double, data: array<struct<strikePrice: double, CE: struct<{LEG}>, PE: struct<{LEG}>>>>>")
    rows = docs.select("symbol", "fetched_at_utc", d["records"].alias("r")).select("symbol", "fetched_at_utc", F.col("r.underlyingValue").alias("_u"), F.explode("r.data").alias("e"))
    legs = F.array(*[F.struct(F.lit(leg).alias("option_type"), F.col(f"e.{leg}").alias("l")) for leg in ("CE", "PE")])
    x = rows.select("symbol", "fetched_at_utc", "_u", F.col("e.strikePrice").alias("strike_price"), F.explode(legs).alias("x")).where("x.l IS NOT NULL")
    names = {"expiry_date": "expiryDate", "open_interest": "openInterest", "change_in_oi": "changeinOpenInterest", "total_traded_volume": "totalTradedVolume",
             "implied_volatility_nse": "impliedVolatility", "last_price": "lastPrice", "price_change": "change", "bid_price": "buyPrice1", "bid_qty": "buyQuantity1",
             "ask_price": "sellPrice1", "ask_qty": "sellQuantity1"}
    return x.select("symbol", "strike_price", F.col("x.option_type").alias("option_type"), *[F.col(f"x.l.{src}").alias(out) for out, src in names.items()],
                    F.coalesce("x.l.underlyingValue", "_u").alias("underlying_value"), "fetched_at_utc")


# -- central bank gateway ----------------------------------------------------------------

def key_indicators(docs: DataFrame) -> DataFrame:
    d = F.from_json("content", "struct<body: struct<result: array<struct<name: string, rate: double, timeDate: bigint, currencyDesc: string>>>>")
    return docs.select(F.explode(d["body"]["result"]).alias("r")).select(ist_date("r.timeDate").alias("as_of"), F.col("r.name").alias("indicator"),
                                                                         F.col("r.rate").alias("value"), "r.currencyDesc")


def forex_reserves(docs: DataFrame, frequency: str = "Weekly") -> DataFrame:
    """One row per (week, component) over the documents of all components."""
    d = F.from_json("content", "struct<body: struct<result: array<struct<timeDate: bigint, fxReservesCode: string, fxReservesDescription: string, amount: double, "
                               "currencyCode: string, unit: string, unitDescription: string, timeFisYear: string>>>>")
    return docs.select(F.explode(d["body"]["result"]).alias("r")).select(
        ist_date("r.timeDate").alias("week_ended"), F.col("r.fxReservesCode").alias("component_code"), F.col("r.fxReservesDescription").alias("component"),
        F.col("r.amount").alias("amount_usd"), F.col("r.currencyCode").alias("currency"), "r.unit", "r.unitDescription",
        F.trim("r.timeFisYear").alias("fiscal_year"), F.lit(frequency).alias("frequency"))


def report_catalog(docs: DataFrame) -> DataFrame:
    """Reports behind each screen. ``docs``: function, department, menu, content."""
    d = F.from_json("content", "struct<body: struct<reports: array<struct<subs: array<struct<reportId: string, reportName: string, reportFreq: string, fromdate: string, todate: string>>>>>>")
    subs = F.flatten(d["body"]["reports"]["subs"])
    return docs.select("function", "department", "menu", F.explode(subs).alias("s")).select(
        F.col("s.reportId").alias("report_id"), F.col("s.reportName").alias("report_name"), F.col("s.reportFreq").alias("frequency"),
        F.col("s.fromdate").alias("from_date"), F.col("s.todate").alias("to_date"), "function", "department", "menu")


def economy_reports(docs: DataFrame) -> DataFrame:
    d = F.from_json("content", "struct<body: struct<subSelection: array<struct<reportId: string, economyWatchSubheader: string>>>>")
    return docs.select("section", F.explode(d["body"]["subSelection"]).alias("r")).select(
        F.col("r.reportId").alias("report_id"), F.col("r.economyWatchSubheader").alias("report_name"), "section")


def rating_listing(docs: DataFrame, base_url: str) -> DataFrame:
    """Rating listing pages: one row per action with its date and document address."""
    from tidemark.functions.dates import MONTH_DAY_YEAR

    d = F.from_json("content", "struct<docs: array<struct<companyCode: string, companyName: string, industryName: string, ratingDate: string, transDate: string, heading: string, "
                               "ratingFileName: string, prId: string>>>")
    r = docs.select(F.explode(d["docs"]).alias("r")).select("r.*")
    quoted = F.replace(F.url_encode("ratingFileName"), F.lit("+"), F.lit("%20"))
    return r.select(F.col("prId").alias("action_id"), F.col("companyCode").alias("company_code"), F.col("companyName").alias("company_name"),
                    F.col("industryName").alias("industry_name"), parse("ratingDate", MONTH_DAY_YEAR).alias("rating_date"), parse("transDate", MONTH_DAY_YEAR).alias("trans_date"),
                    "heading", F.concat(F.lit(base_url), quoted).alias("document_url"))
