"""Filing screens on orders, customers, suppliers and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import names
from tidemark.functions.classify import ACTION_PATTERNS, PURPOSE_PATTERNS, action_class
from tidemark.functions.dates import completed_frame
from tidemark.operators import filings as fl
from tidemark.plans.bindings import table
from tidemark.plans.registry import query

CODES = list(fl.ITEM_CODES)


def filings(spark, sf):
    o = table(spark, sf, "orders")
    code = lambda e: F.element_at(F.array(*[F.lit(c) for c in CODES]), (e % len(CODES) + 1).cast("int"))
    return o.select(
        F.col("o_custkey").alias("cik"), F.concat_ws("-", F.lpad(F.col("o_orderkey").cast("string"), 10, "0"), F.lit("24"), F.lit("000001")).alias("accn"),
        F.when(F.col("o_orderstatus") == "P", "8-K/A").otherwise("8-K").alias("form"),
        F.when(F.col("o_orderkey") % 10 == 0, F.lit(None)).when(F.col("o_orderkey") % 3 == 0, code(F.col("o_custkey")))
        .otherwise(F.concat(code(F.col("o_custkey")), F.lit(", ,"), code(F.col("o_orderkey")))).alias("items"),
        F.date_sub(F.to_date("o_orderdate"), (F.col("o_custkey") % 9).cast("int")).alias("report_date"), F.to_date("o_orderdate").alias("filed"),
        F.when(F.col("o_orderkey") % 4 != 0, F.concat(F.lit("d"), F.col("o_orderkey").cast("string"), F.lit(".htm"))).alias("primary_document"))


_VALUES = ", ".join("('%s', '%s', '%s', %d)" % (c, d.replace("'", "''"), t, i) for i, (c, (d, t)) in enumerate(fl.ITEM_CODES.items()))
ITEMS = f"""codes(code, item_description, tier, pos) AS (VALUES {_VALUES}),
  f AS (SELECT o_custkey AS cik, lpad(CAST(o_orderkey AS VARCHAR), 10, '0') || '-24-000001' AS accn, CASE o_orderstatus WHEN 'P' THEN '8-K/A' ELSE '8-K' END AS form,
    CASE WHEN o_orderkey % 10 = 0 THEN [] WHEN o_orderkey % 3 = 0 THEN [o_custkey % {len(CODES)}] ELSE [o_custkey % {len(CODES)}, o_orderkey % {len(CODES)}] END AS ps,
    CAST(o_orderdate AS DATE) - CAST(o_custkey % 9 AS INTEGER) AS report_date, CAST(o_orderdate AS DATE) AS filed, CAST(o_custkey % 9 AS INTEGER) AS gap,
    CASE WHEN o_orderkey % 4 <> 0 THEN 'd' || o_orderkey || '.htm' END AS primary_document FROM orders),
  e AS (SELECT *, unnest(ps) AS p FROM f),
  items AS (SELECT cik, accn, form, code AS item, item_description, tier, code IN {fl.RED_FLAG_ITEMS} AS is_red_flag, form LIKE '%/A' AS is_amendment, report_date, filed,
    CASE WHEN form = '8-K' THEN gap END AS days_to_file, CASE WHEN form <> '8-K' THEN gap END AS amendment_lag_days, primary_document,
    '{fl.ARCHIVES}/' || cik || '/' || replace(accn, '-', '') || '/' || primary_document AS document_url FROM e JOIN codes ON p = pos)"""


@query("event_items", f"WITH {ITEMS} SELECT * FROM items")
def event_items(spark, sf):
    return fl.event_items(filings(spark, sf))


@query("red_flags", f"WITH {ITEMS} SELECT cik, accn, item, filed FROM items WHERE is_red_flag AND filed >= DATE '1999-01-01'")
def red_flags(spark, sf):
    return fl.red_flags(fl.event_items(filings(spark, sf)), "1999-01-01").select("cik", "accn", "item", "filed")


@query("proxy_filings", f"""SELECT o_custkey AS cik, CAST(o_orderkey AS VARCHAR) AS accn, CASE o_orderpriority WHEN '1-URGENT' THEN 'DEF 14A' ELSE 'PRE 14A' END AS form,
  CAST(o_orderdate AS DATE) AS filed, '{fl.ARCHIVES}/' || o_custkey || '/' || o_orderkey || '/p.htm' AS document_url
  FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def proxy_filings(spark, sf):
    s = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("cik"), F.col("o_orderkey").cast("string").alias("accn"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "DEF 14A").when(F.col("o_orderpriority") == "2-HIGH", "PRE 14A").otherwise("10-K").alias("form"),
        F.to_date("o_orderdate").alias("filed"), F.to_date("o_orderdate").alias("report_date"), F.lit("p.htm").alias("primary_document"))
    return fl.proxy_filings(s).select("cik", "accn", "form", "filed", "document_url")


def index(spark, sf):
    """Each lineitem indexed under its supplier: an order appears once per supplier."""
    li = table(spark, sf, "lineitem")
    return li.select(F.col("l_suppkey").alias("cik"), F.when(F.col("l_returnflag") == "A", "SCHEDULE 13D/A").when(F.col("l_returnflag") == "R", "SCHEDULE 13D")
                     .otherwise("10-K").alias("form"), F.to_date("l_shipdate").alias("filed"), F.col("l_orderkey").alias("accn"))


DISCOVER = """ix AS (SELECT l_suppkey AS cik, CASE l_returnflag WHEN 'A' THEN 'SCHEDULE 13D/A' WHEN 'R' THEN 'SCHEDULE 13D' ELSE '10-K' END AS form,
  CAST(l_shipdate AS DATE) AS filed, l_orderkey AS accn FROM lineitem)"""


@query("discover_filings", f"""WITH {DISCOVER}, h AS (SELECT * FROM ix WHERE form LIKE 'SCHEDULE 13D%'),
  k AS (SELECT DISTINCT accn FROM h WHERE cik IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000))
  SELECT accn, cik, filed, form, form LIKE '%/A' AS amendment FROM h WHERE accn IN (SELECT accn FROM k)
  QUALIFY row_number() OVER (PARTITION BY accn ORDER BY filed, cik, form) = 1""")
def discover_filings(spark, sf):
    ciks = table(spark, sf, "supplier").where("s_acctbal > 5000").select(F.col("s_suppkey").alias("cik"))
    return fl.discover(index(spark, sf), fl.ACTIVE_FORMS, ciks, ("filed", "cik", "form")).select("accn", "cik", "filed", "form", "amendment")


@query("holdings_filings", """SELECT o_custkey AS cik, o_orderkey AS accn, '13F-' || CASE o_orderstatus WHEN 'F' THEN 'HR' WHEN 'O' THEN 'HR/A' ELSE 'NT' END AS form,
  o_orderstatus <> 'P' AS holdings_report, o_orderstatus = 'O' AS amendment FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def holdings_filings(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("cik"), F.col("o_orderkey").alias("accn"), F.concat(
        F.lit("13F-"), F.when(F.col("o_orderstatus") == "F", "HR").when(F.col("o_orderstatus") == "O", "HR/A").otherwise("NT")).alias("form"))
    return fl.holdings_filings(o, table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("cik")))


def _re2(p: str) -> str:
    return p.replace("'", "''")


PURPOSES = ", ".join(f"regexp_matches(lower(text), '{_re2(p)}') AS {n}" for n, p in PURPOSE_PATTERNS.items())
# The documents are invented words, so every third one carries a phrase of a real filing.
PHRASES = ("we may nominate a director candidate", "engage in discussions with management", "seek a special dividend and a buyback",
           "we oppose the inadequate offer", "acquire control of the issuer by merger")


def purposes(spark, sf):
    d = table(spark, sf, "documents")
    phrase = F.element_at(F.array(*[F.lit(p) for p in PHRASES]), (F.col("doc_id") % len(PHRASES) + 1).cast("int"))
    text = F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit(" "), F.initcap(phrase))).otherwise(F.col("text"))
    return d.select("doc_id", text.alias("item4_purpose"), (F.col("source") == "web").alias("amendment"))


TEXTS = f"""tx AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text || ' ' || {list(PHRASES)}[CAST(doc_id % {len(PHRASES)} + 1 AS INTEGER)] ELSE text END AS text, source FROM documents)"""


@query("purpose_flags", f"WITH {TEXTS} SELECT doc_id, {PURPOSES} FROM tx")
def purpose_flags(spark, sf):
    return fl.with_purpose(purposes(spark, sf)).drop("item4_purpose", "amendment")


@query("purpose_summary", f"""WITH {TEXTS}, p AS (SELECT doc_id, source, {PURPOSES} FROM tx)
  SELECT count(*) AS found, count(*) FILTER (source = 'web') AS amendments, {', '.join(f'count(*) FILTER ({n}) AS {n}' for n in PURPOSE_PATTERNS)},
  count(*) FILTER ({' OR '.join(PURPOSE_PATTERNS)}) AS any_flag FROM p""")
def purpose_summary(spark, sf):
    return fl.purpose_summary(fl.with_purpose(purposes(spark, sf)))


HEADS = ("Rating reaffirmed", "Downgraded and placed on 'Watch Developing'", "Upgraded", "Continues on Watch", "Ratings migrated", "Withdrawn", "Assigned",
         "Issuer Non-Cooperating; downgraded", "Outlook noted")
HEADING = "CASE " + " ".join(f"WHEN regexp_matches(lower(h), '{_re2(p)}') THEN '{n}'" for n, p in ACTION_PATTERNS) + " ELSE 'other' END"


def headings(spark, sf):
    head = F.element_at(F.array(*[F.lit(h) for h in HEADS]), (F.col("c_custkey") % len(HEADS) + 1).cast("int"))
    c = table(spark, sf, "customer").withColumn("heading", head)
    return table(spark, sf, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        F.expr("o_orderkey div 4").alias("action_id"), F.col("c_name").alias("company_name"), F.to_date("o_orderdate").alias("rating_date"),
        F.concat("heading", F.lit(" "), "o_orderpriority").alias("heading"), F.lit("u").alias("document_url"))


RATINGS = f"""ra AS (SELECT o_orderkey // 4 AS action_id, c_name AS company_name, CAST(o_orderdate AS DATE) AS rating_date,
    {[h for h in HEADS]!r}[CAST(c_custkey % {len(HEADS)} + 1 AS INTEGER)] || ' ' || o_orderpriority AS h FROM orders JOIN customer ON o_custkey = c_custkey),
  rd AS (SELECT * FROM ra QUALIFY row_number() OVER (PARTITION BY action_id ORDER BY rating_date DESC, h) = 1)""".replace('"Downgraded and placed on \'Watch Developing\'"', "'Downgraded and placed on ''Watch Developing'''")


@query("rating_actions", f"""WITH {RATINGS} SELECT action_id, company_name, rating_date, h AS heading, {HEADING} AS action_type FROM rd
  WHERE rating_date >= (SELECT max(rating_date) FROM rd) - 400""")
def rating_actions(spark, sf):
    return fl.rating_actions(headings(spark, sf), days_back=400).drop("document_url")


@query("action_counts", f"WITH {RATINGS} SELECT {HEADING} AS action_type, count(*) AS n FROM rd GROUP BY 1")
def action_counts(spark, sf):
    return fl.rating_actions(headings(spark, sf)).groupBy("action_type").agg(F.count(F.lit(1)).alias("n"))


@query("rating_company_search", f"WITH {RATINGS} SELECT action_id, company_name FROM rd WHERE contains(lower(company_name), '#00000012')")
def rating_company_search(spark, sf):
    return fl.company_contains(fl.rating_actions(headings(spark, sf)), "#00000012").select("action_id", "company_name")


def person(side: str):
    n = F.expr("o_custkey div 2")
    return F.concat(F.lit("Elm Street Partners "), n.cast("string"), F.lit(" L.P." if side == "d" else " LP"))


@query("ownership_transitions", """WITH g AS (SELECT o_custkey // 20 AS issuer_cik, 'Elm Street Partners ' || (o_custkey // 2) || ' LP' AS p, o_custkey // 2 AS k,
    min(CAST(o_orderdate AS DATE)) AS first_13g, max(CAST(o_orderdate AS DATE)) AS last_13g, count(*) AS n_13g FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL),
  d AS (SELECT o_custkey // 20 AS issuer_cik, 'Elm Street Partners ' || (o_custkey // 2) || ' L.P.' AS p, o_custkey // 2 AS k, min(CAST(o_orderdate AS DATE)) AS first_13d,
    count(*) AS n_13d FROM orders WHERE o_orderstatus = 'P' GROUP BY ALL)
  SELECT g.issuer_cik, 'Issuer ' || g.issuer_cik AS issuer_name, g.p AS person_name_13g, d.p AS person_name_13d, first_13g, last_13g, n_13g, first_13d, n_13d,
  CAST(first_13d - first_13g AS INTEGER) AS days_passive_first FROM g JOIN d ON g.issuer_cik = d.issuer_cik AND g.k = d.k WHERE first_13d > first_13g""")
def ownership_transitions(spark, sf):
    o = table(spark, sf, "orders")
    issuer = F.expr("o_custkey div 20").alias("issuer_cik")
    filed = F.to_date("o_orderdate").alias("filed")
    g = o.where("o_orderstatus = 'F'").select(issuer, F.concat(F.lit("Issuer "), F.expr("o_custkey div 20").cast("string")).alias("issuer_name"), person("g").alias("person_name"), filed)
    d = o.where("o_orderstatus = 'P'").select(issuer, person("d").alias("person_name"), filed)
    return fl.transitions(g, d)


def decorated(spark, sf):
    """Customer names with the decorations the three keys remove."""
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    return c.select("c_custkey", F.concat(F.when(k % 2 == 0, "The ").otherwise(""), F.lit("Alpha & Beta "), k.cast("string"),
                                          F.when(k % 3 == 0, " Holdings, Inc.").when(k % 3 == 1, " Corp /DE/").otherwise(" L.L.C. (Formerly Gamma)")).alias("name"))


DECORATED = """dn AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'The ' ELSE '' END || 'Alpha & Beta ' || c_custkey ||
  CASE c_custkey % 3 WHEN 0 THEN ' Holdings, Inc.' WHEN 1 THEN ' Corp /DE/' ELSE ' L.L.C. (Formerly Gamma)' END AS name FROM customer)"""


def _steps_sql(steps, x: str) -> str:
    for pattern, repl in steps:
        x = f"regexp_replace({x}, '{pattern.replace(chr(39), chr(39) * 2)}', '{repl}', 'g')"
    return f"trim({x})"


@query("name_keys", f"""WITH {DECORATED} SELECT c_custkey, {_steps_sql(names.FILER_STEPS, 'upper(name)')} AS filer_key, {_steps_sql(names.ISSUER_STEPS, 'upper(name)')} AS issuer_key,
  {_steps_sql(names.LISTED_STEPS, 'trim(upper(name))')} AS listed_key FROM dn""")
def name_keys(spark, sf):
    return decorated(spark, sf).select("c_custkey", names.filer_key("name").alias("filer_key"), names.issuer_key("name").alias("issuer_key"),
                                       names.listed_key("name").alias("listed_key"))


@query("listing_status", """WITH a AS (SELECT DISTINCT upper(c_name) AS k FROM customer WHERE c_custkey % 3 = 0 UNION SELECT DISTINCT upper(s_name) FROM supplier)
  SELECT c_custkey, CASE WHEN upper(c_name) IN (SELECT k FROM a) THEN 'Public (listed)' ELSE 'Private/unlisted' END AS listing_status FROM customer""")
def listing_status(spark, sf):
    c = table(spark, sf, "customer")
    listed = fl.listed_names((c.where("c_custkey % 3 = 0"), "c_name"), (table(spark, sf, "supplier"), "s_name"), None)
    return fl.tag_listing(c.select("c_custkey", F.concat(F.lit("The "), F.col("c_name"), F.lit(" (Erstwhile X)")).alias("company")), "company", listed).select("c_custkey", "listing_status")


@query("match_constituents", """WITH h AS (SELECT c_custkey AS k FROM customer), t AS (SELECT s_suppkey AS k FROM supplier)
  SELECT h.k AS c_custkey, CASE WHEN t.k IS NOT NULL THEN lpad(CAST(t.k AS VARCHAR), 10, '0') END AS cik, CASE WHEN t.k IS NOT NULL THEN 'T' || t.k END AS ticker,
  CASE WHEN t.k IS NULL THEN NULL WHEN h.k % 3 = 0 THEN 'k_exact' WHEN h.k % 3 = 1 THEN 'k_sorted' ELSE 'k_nospace' END AS match_method
  FROM h LEFT JOIN t ON h.k = t.k""")
def match_constituents(spark, sf):
    k = F.col("c_custkey")
    n = k.cast("string")
    h = table(spark, sf, "customer").select("c_custkey", F.when(k % 3 == 0, F.concat(F.lit("Delta Works N"), n, F.lit(" Inc")))
                                            .when(k % 3 == 1, F.concat(F.lit("N"), n, F.lit(" Works Delta Corp"))).otherwise(F.concat(F.lit("DeltaWorks N"), n)).alias("name"))
    s = table(spark, sf, "supplier").select(F.concat(F.lit("DELTA WORKS N"), F.col("s_suppkey").cast("string"), F.lit(" CO /DE/")).alias("title"),
                                            F.lpad(F.col("s_suppkey").cast("string"), 10, "0").alias("cik_padded"),
                                            F.concat(F.lit("T"), F.col("s_suppkey").cast("string")).alias("ticker"), F.col("s_suppkey").alias("cik_str"))
    return fl.match_constituents(h, s).select("c_custkey", "cik", "ticker", "match_method")


@query("calendar_labels", """SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, 'CY' || year(o_orderdate - INTERVAL 6 MONTH) || 'Q' || quarter(o_orderdate - INTERVAL 6 MONTH) AS frame FROM orders""")
def calendar_labels(spark, sf):
    day = F.to_date("o_orderdate")
    return table(spark, sf, "orders").select(day.alias("day"), completed_frame(day).alias("frame")).distinct()


@query("latest_reported_quarter", """WITH d AS (SELECT CAST(max(o_orderdate) AS DATE) - INTERVAL 3 MONTH AS d FROM orders)
  SELECT CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter FROM d""")
def latest_reported_quarter(spark, sf):
    return fl.latest_reported_quarter(table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d")), "d")
