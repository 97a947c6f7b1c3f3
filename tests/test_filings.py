from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates, names, options as bs
from tidemark.functions.classify import action_class, purpose_flags
from tidemark.operators import facts as fa
from tidemark.operators import filings as fl
from tidemark.operators import options as op
from tidemark.operators import statements as st


def col(spark, values, expr, kind="string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], f"x {kind}").select(expr).collect()]


def test_date_dialects(spark):
    d = date(2026, 8, 18)
    for text, fmt in (("18-AUG-2026", dates.DAY_MON_YEAR), ("18Aug2026", dates.DAYMONYEAR), ("08/18/2026", dates.US_SLASHED), ("18/08/2026", dates.UK_SLASHED),
                      ("Aug 18, 2026", dates.MONTH_DAY_YEAR), ("18-08-2026", dates.DAY_MONTH_YEAR), ("20260818", dates.COMPACT)):
        assert col(spark, [text, "junk", None], dates.parse("x", fmt)) == [d, None, None], fmt
    assert col(spark, ["2026-08-18", "1787011200000"], dates.iso_or_epoch("x")) == [d, d]
    assert col(spark, [1787077800000], dates.ist_date("x"), "long") == [date(2026, 8, 19)]
    assert col(spark, ["45520"], dates.days_since_1900_end("x")) == [date(1900, 12, 31) + timedelta(45520)]


def test_fiscal_labels(spark):
    days = [date(2025, 3, 31), date(2024, 4, 1), date(2024, 12, 31), date(2024, 9, 30)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert [r[0] for r in df.select(dates.fiscal_quarter_label("d")).collect()] == ["Q4 FY24-25", "Q1 FY24-25", "Q3 FY24-25", "Q2 FY24-25"]
    assert [r[0] for r in df.select(dates.fiscal_year_label("d")).collect()] == ["FY24-25"] * 4
    assert [tuple(r[0]) for r in df.select(dates.previous_quarter("d")).collect()] == [(2024, 4), (2024, 1), (2024, 3), (2024, 2)]


def test_name_keys(spark):
    a, b = col(spark, ["Elliott Investment Management L.P.", "ELLIOTT INVESTMENT MANAGEMENT LP"], names.filer_key("x"))
    assert a == b == "ELLIOTT INVESTMENT"
    k = col(spark, ["Air Products and Chemicals", "AIR PRODUCTS & CHEMICALS INC /DE/", "Clorox Co/The", "CLOROX CO /DE/", "Lowe's Cos Inc", "LOWES COMPANIES INC", "Amazon.com Inc"], names.issuer_key("x"))
    assert k[0] == k[1] and k[2] == k[3] == "CLOROX" and k[4] == k[5] == "LOWES" and k[6] == "AMAZON"
    assert col(spark, ["The Foo & Bar Ltd. (Erstwhile Baz)", " "], names.listed_key("x")) == ["FOO AND BAR LTD", None]


def test_passive_to_active_transition(spark):
    g = spark.createDataFrame([("1", "Iss", "X LP", date(2023, 1, 1)), ("1", "Iss", "X LP", date(2024, 1, 1)), ("1", "Iss", "Y", date(2025, 1, 1)), ("2", "Z", "X LP", date(2023, 1, 1))], "issuer_cik string, issuer_name string, person_name string, filed date")
    d = spark.createDataFrame([("1", "X, L.P.", date(2025, 6, 1)), ("1", "Y", date(2024, 1, 1))], "issuer_cik string, person_name string, filed date")
    r = fl.transitions(g, d).collect()
    assert len(r) == 1 and (r[0].n_13g, r[0].days_passive_first, r[0].last_13g) == (2, 882, date(2024, 1, 1))


def test_headline_classes(spark):
    heads = ["Rating downgraded; issuer non-cooperating", "Continues on 'Watch Developing'", "Ratings Reaffirmed", "Upgraded", "Migrated", "Withdrawn", "Assigned", "Outlook", None]
    assert col(spark, heads, action_class("x")) == ["issuer_not_cooperating", "watch", "reaffirmed", "upgrade", "migrated", "withdrawn", "assigned", "other", "other"]
    f = purpose_flags("x")
    assert col(spark, ["We may NOMINATE directors", None], f["board_representation"]) == [True, False]
    assert col(spark, ["take-private offer"], f["seeks_sale_or_merger"]) == [True]


def test_event_items_and_amendments(spark):
    df = spark.createDataFrame([(1, "0-1-2", "8-K", "2.02, 9.01,", date(2026, 1, 1), date(2026, 1, 4), "a.htm"), (1, "0-1-3", "8-K/A", "4.02", date(2025, 1, 1), date(2026, 1, 1), None), (2, "x", "8-K", None, None, date(2026, 1, 1), "b"), (2, "y", "8-K", "7.77", None, date(2026, 1, 1), "")],
                               "cik long, accn string, form string, items string, report_date date, filed date, primary_document string")
    r = {(x.accn, x.item): x for x in fl.event_items(df).collect()}
    assert set(r) == {("0-1-2", "2.02"), ("0-1-2", "9.01"), ("0-1-3", "4.02"), ("y", "7.77")}
    a = r["0-1-3", "4.02"]
    assert a.is_red_flag and a.days_to_file is None and a.amendment_lag_days == 365 and a.document_url is None and a.tier == "critical"
    assert r["0-1-2", "2.02"].days_to_file == 3 and r["0-1-2", "2.02"].document_url.endswith("/1/012/a.htm") and r["y", "7.77"].tier == "unknown"
    assert fl.red_flags(fl.event_items(df), "2026-02-01").count() == 0


def test_company_filter_acts_before_duplicates_go(spark):
    ix = spark.createDataFrame([(5, "SCHEDULE 13D", date(2026, 1, 1), "a"), (9, "SCHEDULE 13D", date(2026, 1, 1), "a"), (7, "10-K", date(2026, 1, 1), "b")], "cik long, form string, filed date, accn string")
    r = fl.discover(ix, fl.ACTIVE_FORMS, spark.createDataFrame([(9,)], "cik long")).collect()
    assert [(x.accn, x.cik) for x in r] == [("a", 5)]


def test_constituents_match_in_order_of_strictness(spark):
    h = spark.createDataFrame([("W R Berkley Corp",), ("ExxonMobil",), ("Nobody",), ("Alphabet Inc",)], "name string")
    t = spark.createDataFrame([("BERKLEY W R CORP", "0001", "WRB", 1), ("EXXON MOBIL CORP", "0002", "XOM", 2), ("ALPHABET INC.", "0004", "GOOG", 4), ("Alphabet Inc", "0003", "GOOGL", 3)], "title string, cik_padded string, ticker string, cik_str long")
    r = {x.name: (x.cik, x.match_method) for x in fl.match_constituents(h, t).collect()}
    assert r == {"W R Berkley Corp": ("0001", "k_sorted"), "ExxonMobil": ("0002", "k_nospace"), "Nobody": (None, None), "Alphabet Inc": ("0003", "k_exact")}


FACT = "cik long, entity string, taxonomy string, concept string, unit string, start date, end date, value double, filed date, accn string"


def fact(concept, value, filed, accn="a", start=None, cik=1):
    return (cik, "E", "us-gaap", concept, "USD", start, date(2024, 12, 31), value, filed, accn)


def test_restatements(spark):
    a, b, c = date(2025, 1, 1), date(2025, 6, 1), date(2026, 1, 1)
    df = spark.createDataFrame([fact("Assets", 100.0, a, "x"), fact("Assets", 110.0, b, "y"), fact("Same", 5.0, a), fact("Same", 5.0, b), fact("Debt", 7511760.0, a), fact("Debt", 7511760000.0, b),
                                fact("Cash", 3.4, a), fact("Cash", 3449100000.0, b), fact("Back", 1.0, a), fact("Back", 2.0, b), fact("Back", 1.0, c), fact("Zero", 0.0, a), fact("Zero", 4.0, b), fact("Null", None, a), fact("Null", 2.0, b)], FACT)
    r = {x.concept: x for x in fa.restatements(df).collect()}
    assert set(r) == {"Assets", "Debt", "Cash", "Back", "Zero"}
    x = r["Assets"]
    assert (x.first_value, x.latest_value, x.n_versions, x.abs_change) == (100.0, 110.0, 2, 10.0) and x.pct_change == pytest.approx(10) and (x.first_accn, x.latest_accn) == ("x", "y")
    assert r["Debt"].looks_like_scale_change and r["Cash"].looks_like_scale_change and not x.looks_like_scale_change
    assert r["Back"].pct_change == 0 and r["Back"].n_versions == 2 and r["Zero"].pct_change is None
    assert {y.concept for y in fa.restatements(df, 1.0, exclude_scale_changes=True).collect()} == {"Assets"}


def test_value_scale_by_median(spark):
    rows = [("k", 5.0, 10.0), ("k", 6.0, 10.0), ("k", 900.0, 10.0), ("d", 50.0, 10.0), ("e", 4.0, 10.0), ("e", 15.0, 10.0), ("f", 4.0, 10.0), ("f", 17.0, 10.0), ("n", 4.0, 0.0)]
    df = spark.createDataFrame(rows, "accn string, value_reported double, shares_or_principal double")
    assert {x.accn: x.value_scale for x in fa.value_scale(df).collect()} == {"k": "thousands", "d": "dollars", "e": "thousands", "f": "dollars", "n": "unknown"}


def test_scales_of_filings_are_not_broadcast(spark):
    df = spark.createDataFrame([("k", 0.5, 1.0), ("d", 30.0, 1.0)], "accn string, value_reported double, shares_or_principal double")
    scaled = fa.scaled_holdings(df)
    assert "Broadcast" not in scaled._jdf.queryExecution().executedPlan().toString()
    assert {x.accn: x.value_usd for x in scaled.collect()} == {"k": 500.0, "d": 30.0}


def test_first_alias_wins_and_missing_dates_stay(spark):
    f = spark.createDataFrame([(1, "E", "us-gaap", "Revenues", "USD", date(2025, 6, 30), 5.0, "a", "CY2025Q2"), (1, "E", "us-gaap", "RevenueFromContractWithCustomerExcludingAssessedTax", "USD", date(2025, 6, 30), 6.0, "b", "CY2025Q2"),
                               (2, "F", "us-gaap", "RevenueFromContractWithCustomerExcludingAssessedTax", "USD", date(2025, 6, 30), 7.0, "c", "CY2025Q2"), (2, "F", "us-gaap", "Assets", "USD", date(2025, 6, 30), 8.0, "c", "CY2025Q2")],
                              "cik long, entity string, taxonomy string, concept string, unit string, end date, value double, accn string, period string")
    d = spark.createDataFrame([("a", date(2025, 8, 1), "10-Q")], "accn string, filed date, form string")
    r = {(x.cik, x.field): (x.value, x.period, x.filed_source) for x in fa.fundamentals_panel(f, d).collect()}
    assert r == {(1, "revenue"): (5.0, "CY2025Q2", "submissions"), (2, "revenue"): (7.0, "CY2025Q2", "unmatched"), (2, "assets"): (8.0, "CY2025Q2I", "unmatched")}


def test_pay_against_performance(spark):
    e, f = date(2024, 12, 31), date(2025, 3, 1)
    rows = [(1, "E", "ecd", c, "USD", None, e, v, "DEF 14A", f, "a") for c, v in (("PeoTotalCompAmt", 10.0), ("PeoActuallyPaidCompAmt", 30.0), ("TotalShareholderRtnAmt", 90.0), ("PeerGroupTotalShareholderRtnAmt", 120.0))]
    rows += [(2, "F", "ecd", "PeoTotalCompAmt", "USD", None, e, 0.0, "DEF 14A", f, "b"), (2, "F", "ecd", "PeoActuallyPaidCompAmt", "USD", None, e, 5.0, "DEF 14A", f, "b")]
    df = spark.createDataFrame(rows, "cik long, entity string, taxonomy string, concept string, unit string, start date, end date, value double, form string, filed date, accn string")
    r = {x.cik: x for x in fa.pay_vs_tsr(fa.pay_versus_performance(df)).collect()}
    assert (r[1].pay_premium, r[1].tsr_vs_peer, r[1].pay_up_performance_down) == (3.0, -30.0, True)
    assert (r[2].pay_premium, r[2].pay_up_performance_down) == (None, False)


SF = "symbol string, concept string, period_start date, period_end date, value double, has_dimensions boolean, filed date"


def test_statement_merge_and_balance_check(spark):
    m, s = date(2025, 3, 31), date(2024, 9, 30)
    f = spark.createDataFrame([("A", "Assets", None, m, 5e9, False, m), ("A", "EquityAndLiabilities", None, m, 5e9, False, m), ("A", "Assets", None, s, 4e9, False, m), ("A", "Assets", None, m, 9e9, True, m)], SF)
    sc = spark.createDataFrame([("A", "balance_sheet", "annual", "Total Assets", m, 1.0), ("A", "balance_sheet", "annual", "Borrowings", m, 77.0), ("A", "balance_sheet", "annual", "Total Assets", date(2024, 3, 31), 300.0)],
                               "symbol string, statement string, period_type string, concept string, period_end date, value double")
    r = {(x.item, x.period): x.value for x in st.statement("balance", f, sc).collect()}
    assert r == {("Total Assets", "FY24-25"): 500.0, ("Total Equity and Liabilities", "FY24-25"): 500.0, ("Borrowings", "FY24-25"): 77.0, ("Total Assets", "FY23-24"): 300.0, (st.BALANCE_CHECK, "FY24-25"): 0.0}
    wide = st.statement_table(st.statement("balance", f, sc), ["FY24-25", "FY23-24"]).where("item = 'Total Assets'").first()
    assert (wide["FY24-25"], wide["FY23-24"]) == (500.0, 300.0)


def test_quarters_only_and_per_share(spark):
    q, y = date(2025, 3, 31), date(2024, 4, 1)
    f = spark.createDataFrame([("A", "RevenueFromOperations", date(2025, 1, 1), q, 2e7, False, q), ("A", "RevenueFromOperations", y, q, 8e7, False, q),
                               ("A", "BasicEarningsLossPerShareFromContinuingAndDiscontinuedOperations", date(2025, 1, 1), q, 12.5, False, q)], SF)
    r = {x.item: (x.value, x.period) for x in st.statement("income", f).collect()}
    assert r == {"Revenue": (2.0, "Q4 FY24-25"), "EPS (Basic)": (12.5, "Q4 FY24-25")}
    p = st.wide_panel(f.withColumn("context_id", F.lit("c")), ["RevenueFromOperations"], ("symbol", "period_start", "period_end"))
    assert p.count() == 2


def options(spark, rows):
    return spark.createDataFrame([tuple(map(lambda v: v if isinstance(v, str) else float(v), r)) for r in rows], "s double, k double, t double, r double, v double, side string")


ARGS = ("s", "k", "t", "r", "v", "side")


def test_textbook_price_parity_and_intrinsic(spark):
    df = options(spark, [(100, 100, 1, 0.05, 0.2, "C"), (100, 100, 1, 0.05, 0.2, "P"), (110, 100, 0, 0.05, 0.2, "C"), (90, 100, 0, 0.05, 0.2, "P"), (90, 100, 0, 0.05, 0.2, "C")])
    p = [x.price for x in bs.with_price(df, *ARGS).collect()]
    assert p[0] == pytest.approx(10.4506, abs=1e-4) and p[0] - p[1] == pytest.approx(100 - 100 * 2.718281828459045 ** -0.05, abs=1e-6)
    assert p[2:] == [10.0, 10.0, 0.0]
    g = bs.with_greeks(df, *ARGS).collect()
    assert g[0].delta - g[1].delta == pytest.approx(1, abs=1e-9) and g[0].vega == pytest.approx(0.37524, abs=1e-4) and g[2].delta is None


def test_implied_vol_round_trip(spark):
    df = options(spark, [(100, k, 0.5, 0.05, v, side) for k in (90, 100, 115) for v in (0.1, 0.35, 1.2) for side in "CP"])
    out = bs.with_price(df, *ARGS).select("v", op.implied_vol("price", "s", "k", "t", "r", "side").alias("iv")).collect()
    assert all(abs(x.iv - x.v) < 1e-4 for x in out)
    bad = options(spark, [(100, 90, 0.5, 0.05, 0.2, "C"), (100, 90, 0.0, 0.05, 0.2, "C")]).withColumn("price", F.lit(1.0))
    assert [x[0] for x in bad.select(op.implied_vol("price", "s", "k", "t", "r", "side")).collect()] == [None, None]
