"""Fact panels, restatements and statements on lineitems."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.dates import fiscal_quarter_label, fiscal_year_label
from tidemark.operators import facts as fa
from tidemark.operators import statements as st
from tidemark.plans.bindings import FACTS, facts, table
from tidemark.plans.registry import query

RESTATED = f"""{FACTS}, v AS (SELECT *, first_value(value) OVER w AS fv, first_value(filed) OVER w AS ff, first_value(accn) OVER w AS fa,
    last_value(value) OVER w AS lv, last_value(filed) OVER w AS lf, last_value(accn) OVER w AS la FROM fx
    WINDOW w AS (PARTITION BY cik, taxonomy, concept, unit, start, "end" ORDER BY filed, accn, value ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
  rs AS (SELECT cik, entity, taxonomy, concept, unit, start, "end", any_value(fv) AS first_value, any_value(ff) AS first_filed, any_value(fa) AS first_accn,
    any_value(lv) AS latest_value, any_value(lf) AS latest_filed, any_value(la) AS latest_accn, count(DISTINCT value) AS n_versions
    FROM v GROUP BY cik, entity, taxonomy, concept, unit, start, "end" HAVING count(DISTINCT value) > 1),
  rx AS (SELECT *, latest_value - first_value AS abs_change, round((latest_value - first_value) / abs(first_value) * 100, 6) AS pct_change,
    round(abs(latest_value / first_value), 6) AS value_ratio,
    abs(abs(log10(abs(latest_value / first_value))) - 3) < 0.03 OR abs(abs(log10(abs(latest_value / first_value))) - 6) < 0.03 OR abs(abs(log10(abs(latest_value / first_value))) - 9) < 0.03
    AS looks_like_scale_change FROM rs)"""


@query("restatements", f"WITH {RESTATED} SELECT * FROM rx")
def restatements(spark, sf):
    return fa.restatements(facts(spark, sf)).withColumn("pct_change", F.round("pct_change", 6)).withColumn("value_ratio", F.round("value_ratio", 6))


@query("universe_restatements", f"WITH {RESTATED} SELECT cik, concept, \"end\", latest_accn, n_versions FROM rx WHERE abs(pct_change) >= 50 AND NOT looks_like_scale_change")
def universe_restatements(spark, sf):
    return fa.restatements(facts(spark, sf), 50.0, exclude_scale_changes=True).select("cik", "concept", "end", "latest_accn", "n_versions")


@query("fact_concept_panel", f"""WITH {FACTS} SELECT cik, taxonomy, concept, "end", value, filed, accn FROM fx WHERE (taxonomy, concept) IN (('us-gaap', 'NO'), ('ecd', 'AF'))""")
def fact_concept_panel(spark, sf):
    return fa.concept_panel(facts(spark, sf), [("us-gaap", "NO"), ("ecd", "AF"), ("us-gaap", "AF")]).select("cik", "taxonomy", "concept", "end", "value", "filed", "accn")


@query("non_core_taxonomies", f"WITH {FACTS} SELECT cik, entity, taxonomy, concept, count(*) AS n_facts FROM fx WHERE taxonomy <> 'us-gaap' GROUP BY 1, 2, 3, 4")
def non_core_taxonomies(spark, sf):
    return fa.non_core_taxonomies(facts(spark, sf))


FIELDS = {"income": (False, "USD", (("us-gaap", "NO"), ("ecd", "AO"))), "assets": (True, "USD", (("us-gaap", "NF"), ("ecd", "RF"), ("ecd", "AF")))}


@query("fundamentals_panel", f"""WITH {FACTS}, a AS (SELECT *, 'CY' || year("end") || 'Q' || quarter("end") AS period, CASE concept WHEN 'NO' THEN 'income' WHEN 'AO' THEN 'income' ELSE 'assets' END AS field,
    CASE concept WHEN 'NO' THEN 0 WHEN 'AO' THEN 1 WHEN 'NF' THEN 0 WHEN 'RF' THEN 1 ELSE 2 END AS r FROM fx WHERE concept IN ('NO', 'AO', 'NF', 'RF', 'AF')),
  b AS (SELECT * FROM a WHERE cik IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) QUALIFY row_number() OVER (PARTITION BY cik, field, period ORDER BY r, accn DESC) = 1)
  SELECT cik, field, period || CASE field WHEN 'assets' THEN 'I' ELSE '' END AS period, concept, accn,
  CASE WHEN CAST(split_part(accn, '-', 2) AS INTEGER) < 5 THEN filed END AS filed, CASE WHEN CAST(split_part(accn, '-', 2) AS INTEGER) < 5 THEN 'submissions' ELSE 'unmatched' END AS filed_source FROM b""")
def fundamentals_panel(spark, sf):
    f = facts(spark, sf).withColumn("period", F.concat(F.lit("CY"), F.year("end").cast("string"), F.lit("Q"), F.quarter("end").cast("string")))
    dates = facts(spark, sf).where(F.split("accn", "-")[1].cast("int") < 5).select("accn", "filed", "form")
    uni = table(spark, sf, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("cik"))
    return fa.fundamentals_panel(f, dates, uni, FIELDS).select("cik", "field", "period", "concept", "accn", "filed", "filed_source")


PAY = {"AO": "paid", "AF": "total", "RO": "return", "RF": "peer"}


@query("pay_versus_performance", f"""WITH {FACTS} SELECT cik, CAST(year("end") AS VARCHAR) AS fiscal_year, concept,
  CASE concept WHEN 'AO' THEN 'paid' WHEN 'AF' THEN 'total' WHEN 'RO' THEN 'return' ELSE 'peer' END AS meaning, value, accn FROM fx WHERE taxonomy = 'ecd'""")
def pay_versus_performance(spark, sf):
    return fa.pay_versus_performance(facts(spark, sf), PAY).select("cik", "fiscal_year", "concept", "meaning", "value", "accn")


PAYTSR = f"""{FACTS}, w AS (SELECT cik, entity, CAST(year("end") AS VARCHAR) AS fiscal_year, arg_min(value, (filed, accn)) FILTER (concept = 'AF') AS ceo_pay_disclosed,
    arg_min(value, (filed, accn)) FILTER (concept = 'AO') AS ceo_pay_actually_paid, arg_min(value, (filed, accn)) FILTER (concept = 'RO') AS company_tsr,
    arg_min(value, (filed, accn)) FILTER (concept = 'RF') AS peer_tsr FROM fx WHERE taxonomy = 'ecd' GROUP BY 1, 2, 3),
  pay AS (SELECT *, round(ceo_pay_actually_paid / ceo_pay_disclosed, 6) AS pay_premium, company_tsr - peer_tsr AS tsr_vs_peer,
    coalesce(ceo_pay_actually_paid / ceo_pay_disclosed > 1 AND company_tsr - peer_tsr < 0, false) AS pay_up_performance_down FROM w)"""


def pay(spark, sf):
    return fa.pay_vs_tsr(fa.pay_versus_performance(facts(spark, sf), PAY), "RO", "RF", "AO", "AF")


@query("pay_vs_tsr", f"WITH {PAYTSR} SELECT * FROM pay")
def pay_vs_tsr(spark, sf):
    return pay(spark, sf).withColumn("pay_premium", F.round("pay_premium", 6))


def holdings(spark, sf):
    return table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("cik"), F.col("l_orderkey").alias("accn"), F.col("l_linenumber").alias("line"),
        (F.col("l_quantity") * F.when(F.col("l_orderkey") % 3 == 0, 0.001).otherwise(20.0)).alias("value_reported"),
        F.when(F.col("l_orderkey") % 11 == 0, 0.0).otherwise(F.col("l_quantity") + F.col("l_linenumber")).alias("shares_or_principal"))


SCALE = """h AS (SELECT l_suppkey AS cik, l_orderkey AS accn, l_linenumber AS line, l_quantity * CASE WHEN l_orderkey % 3 = 0 THEN 0.001::DOUBLE ELSE 20.0::DOUBLE END AS value_reported,
    CASE WHEN l_orderkey % 11 = 0 THEN 0.0::DOUBLE ELSE l_quantity + l_linenumber END AS shares FROM lineitem),
  m AS (SELECT accn, median(value_reported / shares) FILTER (shares > 0) AS m FROM h GROUP BY accn),
  sc AS (SELECT h.*, CASE WHEN m IS NULL THEN 'unknown' WHEN m < 1 THEN 'thousands' ELSE 'dollars' END AS value_scale,
    round(value_reported * CASE WHEN m < 1 THEN 1000 ELSE 1 END, 4) AS value_usd FROM h JOIN m USING (accn))"""


@query("holdings_value_scale", f"WITH {SCALE} SELECT accn, value_scale, count(*) AS n, round(sum(value_usd), 4) AS value_usd FROM sc GROUP BY 1, 2")
def holdings_value_scale(spark, sf):
    return fa.scaled_holdings(holdings(spark, sf)).groupBy("accn", "value_scale").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(F.round("value_usd", 4)), 4).alias("value_usd"))


@query("holdings_ingest_summary", f"""WITH {SCALE} SELECT value_scale, count(*) AS rows, round(sum(value_usd), 2) AS value_usd FROM sc GROUP BY 1""")
def holdings_ingest_summary(spark, sf):
    filings = table(spark, sf, "orders").select(F.col("o_orderkey").alias("accn"), F.col("o_custkey").alias("cik"), (F.col("o_orderstatus") != "P").alias("holdings_report"))
    filers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("cik"), F.col("s_name").alias("filer_name"), F.lit("manager").alias("filer_type"))
    _, _, counts = fa.holdings_summary(filings, holdings(spark, sf), filers)
    return counts.withColumn("value_usd", F.round("value_usd", 2))


@query("holdings_notices", """SELECT o_orderkey AS accn, o_custkey AS cik, s_name AS filer_name FROM orders LEFT JOIN supplier ON s_suppkey = o_custkey WHERE o_orderstatus = 'P'""")
def holdings_notices(spark, sf):
    filings = table(spark, sf, "orders").select(F.col("o_orderkey").alias("accn"), F.col("o_custkey").alias("cik"), (F.col("o_orderstatus") != "P").alias("holdings_report"))
    filers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("cik"), F.col("s_name").alias("filer_name"), F.lit("manager").alias("filer_type"))
    return fa.holdings_summary(filings, holdings(spark, sf), filers)[1].select("accn", "cik", "filer_name")


# -- statements --------------------------------------------------------------------

LINES = (("Total Assets", "NO", "N"), ("Total Equity and Liabilities", "AO", "A"), ("Reserves", "RF", "R"), ("Per share", "NF", None))


def statement_rows(spark, sf):
    """Monthly, half-yearly and instant facts per supplier, one document per order."""
    li = table(spark, sf, "lineitem")
    end = F.last_day(F.col("l_shipdate").cast("date"))
    back = F.when(F.col("l_linenumber") % 3 == 0, 1).when(F.col("l_linenumber") % 3 == 1, 9)
    return li.select(F.col("l_suppkey").alias("symbol"), F.concat("l_returnflag", "l_linestatus").alias("concept"), end.alias("period_end"),
                     F.when(back.isNotNull(), F.add_months(F.date_trunc("month", "l_shipdate").cast("date"), -back)).alias("period_start"),
                     (F.col("l_extendedprice") * 141421.35).alias("value"), F.to_date("l_shipdate").alias("filed"), F.col("l_orderkey").alias("doc"),
                     (F.col("l_linenumber") == 7).alias("has_dimensions"), "l_partkey", F.col("l_linenumber").alias("line"))


def statement_facts(spark, sf):
    return statement_rows(spark, sf).drop("line")


SFACTS = """sf AS (SELECT l_suppkey AS symbol, l_returnflag || l_linestatus AS concept, last_day(CAST(l_shipdate AS DATE)) AS period_end,
  CASE l_linenumber % 3 WHEN 0 THEN CAST(date_trunc('month', l_shipdate) - INTERVAL 1 MONTH AS DATE) WHEN 1 THEN CAST(date_trunc('month', l_shipdate) - INTERVAL 9 MONTH AS DATE) END AS period_start,
  l_extendedprice * 141421.35::DOUBLE AS value, CAST(l_shipdate AS DATE) AS filed, l_orderkey AS doc, l_linenumber = 7 AS has_dimensions, l_partkey FROM lineitem)"""


def screener(spark, sf):
    o = table(spark, sf, "orders")
    return o.select((F.col("o_custkey") % 100).alias("symbol"), F.last_day(F.col("o_orderdate").cast("date")).alias("period_end"),
                    F.when(F.col("o_orderstatus") == "O", "N").when(F.col("o_orderstatus") == "F", "A").otherwise("R").alias("concept"),
                    F.col("o_totalprice").alias("value"), F.when(F.col("o_orderkey") % 2 == 0, "balance_sheet").otherwise("income_statement").alias("statement"),
                    F.when(F.col("o_orderkey") % 2 == 0, "annual").otherwise("quarterly").alias("period_type"))


def _canon_sql(condition: str) -> str:
    return f"""SELECT symbol, period_end, CASE concept WHEN 'NO' THEN 'Total Assets' WHEN 'AO' THEN 'Total Equity and Liabilities' WHEN 'RF' THEN 'Reserves' ELSE 'Per share' END AS item,
    arg_max(value, (filed, doc, value)) AS value FROM sf WHERE concept IN ('NO', 'AO', 'RF', 'NF') AND NOT has_dimensions AND {condition} GROUP BY 1, 2, 3"""


FULL = "(CAST(period_end - period_start AS INTEGER) > 200 OR (period_start IS NULL AND month(period_end) = 3))"
ITEM = "CASE item WHEN 'Total Assets' THEN 0 WHEN 'Total Equity and Liabilities' THEN 1 WHEN 'Reserves' THEN 2 ELSE 3 END"


def _screen_sql(statement: str) -> str:
    mod = 0 if statement == "balance_sheet" else 1
    return f"""SELECT o_custkey % 100 AS symbol, last_day(CAST(o_orderdate AS DATE)) AS period_end,
    CASE o_orderstatus WHEN 'O' THEN 'Total Assets' WHEN 'F' THEN 'Total Equity and Liabilities' ELSE 'Reserves' END AS item, max(o_totalprice) AS value
    FROM orders WHERE o_orderkey % 2 = {mod} GROUP BY 1, 2, 3"""


def _label_sql(quarter: bool) -> str:
    y = "(CASE WHEN month(period_end) >= 4 THEN year(period_end) ELSE year(period_end) - 1 END)"
    fy = f"'FY' || substr(CAST({y} AS VARCHAR), 3) || '-' || substr(CAST({y} + 1 AS VARCHAR), 3)"
    return f"'Q' || CAST(((month(period_end) + 8) % 12) // 3 + 1 AS INTEGER) || ' ' || {fy}" if quarter else fy


@query("statement_canonical", f"WITH {SFACTS} SELECT symbol, period_end, item, round(value / 10000000, 6) AS value FROM ({_canon_sql('CAST(period_end - period_start AS INTEGER) <= 100')})")
def statement_canonical(spark, sf):
    return st.canonical_facts(statement_facts(spark, sf), LINES, (), "quarters", newest_by=("filed", "doc")).withColumn("value", F.round("value", 6))


@query("statement_secondary", _screen_sql("balance_sheet"))
def statement_secondary(spark, sf):
    return st.canonical_screener(screener(spark, sf), LINES, "balance_sheet", "annual")


@query("statement_per_share", f"""WITH {SFACTS} SELECT symbol, period_end, item, round(CASE item WHEN 'Per share' THEN value ELSE value / 10000000 END, 4) AS value FROM ({_canon_sql(FULL)})""")
def statement_per_share(spark, sf):
    return st.canonical_facts(statement_facts(spark, sf), LINES, ("Per share",), "full_year", newest_by=("filed", "doc")).withColumn("value", F.round("value", 4))


def _merged(facts_sql: str, screen_sql: str, quarter: bool) -> str:
    return f"""{SFACTS}, x AS ({facts_sql}), s AS ({screen_sql}), mg AS (SELECT coalesce(x.symbol, s.symbol) AS symbol, coalesce(x.period_end, s.period_end) AS period_end,
    coalesce(x.item, s.item) AS item, coalesce(x.value / 10000000, s.value) AS value FROM x FULL JOIN s ON x.symbol = s.symbol AND x.period_end = s.period_end AND x.item = s.item),
    st AS (SELECT symbol, period_end, item, round(value, 2) AS value, CAST({ITEM} AS INTEGER) AS position, {_label_sql(quarter)} AS period FROM mg)"""


@query("statement_income", f"WITH {_merged(_canon_sql('CAST(period_end - period_start AS INTEGER) <= 100'), _screen_sql('income_statement'), True)} SELECT * FROM st")
def statement_income(spark, sf):
    return st.statement("income", statement_facts(spark, sf), screener(spark, sf), newest_by=("filed", "doc"), lines=LINES)


BALANCED = f"""{_merged(_canon_sql(FULL), _screen_sql('balance_sheet'), False)}, chk AS (SELECT symbol, period_end, '{st.BALANCE_CHECK}' AS item,
  round(max(value) FILTER (item = 'Total Assets') - max(value) FILTER (item = 'Total Equity and Liabilities'), 2) AS value, {len(st.BALANCE)} AS position, period FROM st GROUP BY symbol, period_end, period),
  bal AS (SELECT * FROM st UNION ALL SELECT * FROM chk WHERE value IS NOT NULL)"""


@query("statement_balance", f"WITH {BALANCED} SELECT * FROM bal")
def statement_balance(spark, sf):
    return st.statement("balance", statement_facts(spark, sf), screener(spark, sf), newest_by=("filed", "doc"), lines=LINES).withColumn("value", F.round("value", 2))


@query("statement_cash", f"WITH {SFACTS} SELECT symbol, period_end, item, round(value / 10000000, 2) AS value, CAST({ITEM} AS INTEGER) AS position, {_label_sql(False)} AS period FROM ({_canon_sql(FULL)})")
def statement_cash(spark, sf):
    return st.statement("cash", statement_facts(spark, sf), newest_by=("filed", "doc"), lines=LINES)


@query("wide_concept_panel", f"""WITH {SFACTS} SELECT symbol, period_start, period_end, arg_min(value, (doc, l_partkey)) FILTER (concept = 'NO') AS "NO",
  arg_min(value, (doc, l_partkey)) FILTER (concept = 'AF') AS "AF" FROM sf WHERE concept IN ('NO', 'AF') AND NOT has_dimensions GROUP BY 1, 2, 3""")
def wide_concept_panel(spark, sf):
    return st.wide_panel(statement_facts(spark, sf), ["NO", "AF"], first_by=("doc", "l_partkey"))


TABLE_PERIODS = ("FY24-25", "FY98-99", "FY97-98", "FY96-97", "FY95-96")


@query("statement_table", f"""WITH {SFACTS}, st AS (SELECT symbol, item, round(value / 10000000, 2) AS value, CAST({ITEM} AS INTEGER) AS position, {_label_sql(False)} AS period FROM ({_canon_sql(FULL)}))
  SELECT symbol, position, item, item || ' (Rs Cr)' AS label,
  {', '.join(f"max(CASE period WHEN '{p}' THEN value END) AS \"{p}\"" for p in TABLE_PERIODS)} FROM st GROUP BY ALL""")
def statement_table(spark, sf):
    return st.statement_table(statement_cash(spark, sf), TABLE_PERIODS)


@query("fiscal_labels", f"""SELECT DISTINCT last_day(CAST(o_orderdate AS DATE)) AS period_end, {_label_sql(True).replace('period_end', 'last_day(CAST(o_orderdate AS DATE))')} AS quarter,
  {_label_sql(False).replace('period_end', 'last_day(CAST(o_orderdate AS DATE))')} AS year FROM orders""")
def fiscal_labels(spark, sf):
    d = table(spark, sf, "orders").select(F.last_day(F.col("o_orderdate").cast("date")).alias("period_end")).distinct()
    return d.select("period_end", fiscal_quarter_label("period_end").alias("quarter"), fiscal_year_label("period_end").alias("year"))
