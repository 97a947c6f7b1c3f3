"""Regulator files as typed tables: indexes, fact documents, ownership and holdings XML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import blank_to_null, lookup, no_commas, to_double

XML = {"ignoreNamespace": "true", "mode": "PERMISSIVE"}

# Rules a passive schedule is filed under.
FILING_RULES = {
    "Rule 13d-1(b)": "qualified institutional investor",
    "Rule 13d-1(c)": "passive investor",
    "Rule 13d-1(d)": "exempt",
}


def filing_index(lines: DataFrame) -> DataFrame:
    """Pipe-delimited index lines with a numeric company id; everything else is preamble."""
    p = F.transform(F.split("line", r"\|"), lambda x: F.trim(x))
    df = lines.select(p.alias("p")).where((F.size("p") == 5) & F.col("p")[0].rlike(r"^\d+$"))
    return df.select(F.col("p")[0].cast("bigint").alias("cik"), F.col("p")[1].alias("entity_idx"), F.col("p")[2].alias("form"),
                     F.to_date(F.col("p")[3]).alias("filed"), F.regexp_replace(F.substring_index(F.col("p")[4], "/", -1), r"\.txt", "").alias("accn"))


def parallel_arrays(docs: DataFrame, fields: list[str], at: str = "recent") -> DataFrame:
    """Rows of a document that stores one array per column."""
    inner = ", ".join(f"`{f}`: array<string>" for f in fields)
    arrays = F.from_json("content", f"struct<cik: string, filings: struct<`{at}`: struct<{inner}>>>")
    df = docs.select(arrays["cik"].alias("cik"), arrays["filings"][at].alias("a"))
    return df.select("cik", F.explode(F.arrays_zip(*[F.col(f"a.{f}").alias(f) for f in fields])).alias("z")).select("cik", "z.*")


def ticker_map(docs: DataFrame) -> DataFrame:
    """Company id, ticker and title from a map of records."""
    m = F.from_json("content", "map<string, struct<cik_str: bigint, ticker: string, title: string>>")
    return docs.select(F.explode(F.map_values(m)).alias("r")).select("r.*", F.lpad(F.col("r.cik_str").cast("string"), 10, "0").alias("cik_padded"))


POINT = "struct<start: string, end: string, val: double, fy: bigint, fp: string, form: string, filed: string, accn: string, frame: string>"
FACTS = f"struct<cik: string, entityName: string, facts: map<string, map<string, struct<label: string, units: map<string, array<{POINT}>>>>>>"


def company_facts(docs: DataFrame) -> DataFrame:
    """Fact documents as long rows: taxonomy, concept and unit are map keys, not columns, so
    the schema does not depend on which concepts a company uses."""
    d = docs.select(F.from_json("content", FACTS).alias("d"))
    d = d.select(F.col("d.cik").try_cast("bigint").alias("cik"), F.col("d.entityName").alias("entity"), F.explode("d.facts").alias("taxonomy", "c"))
    d = d.select("cik", "entity", "taxonomy", F.explode("c").alias("concept", "b"))
    d = d.select("cik", "entity", "taxonomy", "concept", F.col("b.label").alias("label"), F.explode("b.units").alias("unit", "p"))
    d = d.select("cik", "entity", "taxonomy", "concept", "label", "unit", F.explode("p").alias("p"))
    return d.select("cik", "entity", "taxonomy", "concept", "label", "unit", F.to_date("p.start").alias("start"), F.to_date("p.end").alias("end"),
                    F.col("p.val").alias("value"), "p.fy", "p.fp", "p.form", F.to_date("p.filed").alias("filed"), "p.accn", "p.frame")


def concept_frames(docs: DataFrame) -> DataFrame:
    """One concept across companies for one period."""
    f = F.from_json("content", "struct<taxonomy: string, tag: string, ccp: string, uom: string, data: array<struct<accn: string, cik: bigint, entityName: string, end: string, val: double>>>")
    return docs.select(f.alias("f")).select("f.taxonomy", F.col("f.tag").alias("concept"), F.col("f.ccp").alias("period"), F.col("f.uom").alias("unit"),
                                            F.explode("f.data").alias("r")).select(
        "taxonomy", "concept", "period", "unit", "r.accn", "r.cik", F.col("r.entityName").alias("entity"), F.to_date("r.end").alias("end"), F.col("r.val").alias("value"))


# -- ownership schedules --------------------------------------------------------------

SHARES = "soleVotingPower: string, sharedVotingPower: string, soleDispositivePower: string, sharedDispositivePower: string"
PASSIVE = f"""struct<headerData: struct<submissionType: string>, formData: struct<
  coverPageHeader: struct<eventDateRequiresFilingThisStatement: string, securitiesClassTitle: string,
    issuerInfo: struct<issuerCik: string, issuerName: string, issuerCusip: string>,
    designateRulesPursuantThisScheduleFiled: struct<designateRulePursuantThisScheduleFiled: array<string>>>,
  coverPageHeaderReportingPersonDetails: array<struct<reportingPersonName: string, citizenshipOrOrganization: string,
    reportingPersonBeneficiallyOwnedNumberOfShares: struct<{SHARES}>,
    reportingPersonBeneficiallyOwnedAggregateNumberOfShares: string, classPercent: string,
    aggregateAmountExcludesCertainSharesFlag: string, typeOfReportingPerson: array<string>>>,
  items: struct<item1: string, item2: string, item4: string, item10: string>>>"""
ACTIVE = f"""struct<headerData: struct<submissionType: string, previousAccessionNumber: string>, formData: struct<
  coverPageHeader: struct<amendmentNo: string, dateOfEvent: string, securitiesClassTitle: string,
    issuerInfo: struct<issuerCik: string, issuerName: string, issuerCusip: string>>,
  reportingPersons: struct<reportingPersonInfo: array<struct<reportingPersonCIK: string, reportingPersonName: string, fundType: string,
    citizenshipOrOrganization: string, {SHARES}, aggregateAmountOwned: string, percentOfClass: string, isAggregateExcludeShares: string,
    typeOfReportingPerson: array<string>>>>,
  items1To7: struct<item1: string, item2: string, item3: string, item4: string, item5: string, item6: string, item7: string>>>"""


def _ownership(docs: DataFrame, schema: str) -> DataFrame:
    # The two schedules spell the issuer's ids with different capitals.
    same_case = F.regexp_replace(F.regexp_replace("content", "issuerCIK>", "issuerCik>"), "issuerCUSIP>", "issuerCusip>")
    return docs.withColumn("_x", F.from_xml(same_case, schema, XML))


def _squeeze(c):
    return blank_to_null(F.regexp_replace(c, r"\s+", " "))


def passive_filings(docs: DataFrame) -> DataFrame:
    """One row per passive schedule. ``docs``: path, accn, content."""
    x = _ownership(docs, PASSIVE)
    rule = F.get(F.col("_x.formData.coverPageHeader.designateRulesPursuantThisScheduleFiled.designateRulePursuantThisScheduleFiled"), F.lit(0))
    cover, issuer = "_x.formData.coverPageHeader", "_x.formData.coverPageHeader.issuerInfo"
    return x.select("path", "accn", F.col("_x.headerData.submissionType").alias("form"), F.col(f"{cover}.eventDateRequiresFilingThisStatement").alias("event_date"),
                    F.col(f"{cover}.securitiesClassTitle").alias("security_class"), F.col(f"{issuer}.issuerCik").alias("issuer_cik"),
                    _squeeze(F.col(f"{issuer}.issuerName")).alias("issuer_name"), F.col(f"{issuer}.issuerCusip").alias("issuer_cusip"),
                    rule.alias("filing_rule"), lookup(FILING_RULES, rule).alias("filing_rule_desc"),
                    _squeeze(F.col("_x.formData.items.item1")).alias("item1_issuer"), _squeeze(F.col("_x.formData.items.item2")).alias("item2_identity"),
                    _squeeze(F.col("_x.formData.items.item4")).alias("item4_ownership"), _squeeze(F.col("_x.formData.items.item10")).alias("item10_certification"))


def passive_persons(docs: DataFrame) -> DataFrame:
    """One row per reporting person of each passive schedule."""
    x = _ownership(docs, PASSIVE)
    issuer = "_x.formData.coverPageHeader.issuerInfo"
    p = x.select("path", "accn", F.col(f"{issuer}.issuerCik").alias("issuer_cik"), _squeeze(F.col(f"{issuer}.issuerName")).alias("issuer_name"),
                 F.explode("_x.formData.coverPageHeaderReportingPersonDetails").alias("p"))
    own = "p.reportingPersonBeneficiallyOwnedNumberOfShares"
    return p.select("path", "accn", "issuer_cik", "issuer_name", _squeeze(F.col("p.reportingPersonName")).alias("person_name"), F.col("p.citizenshipOrOrganization").alias("citizenship"),
                    no_commas(F.col(f"{own}.soleVotingPower")).alias("sole_voting"), no_commas(F.col(f"{own}.sharedVotingPower")).alias("shared_voting"),
                    no_commas(F.col(f"{own}.soleDispositivePower")).alias("sole_dispositive"), no_commas(F.col(f"{own}.sharedDispositivePower")).alias("shared_dispositive"),
                    no_commas(F.col("p.reportingPersonBeneficiallyOwnedAggregateNumberOfShares")).alias("aggregate_owned"), no_commas(F.col("p.classPercent")).alias("percent_of_class"),
                    F.col("p.aggregateAmountExcludesCertainSharesFlag").alias("excludes_shares"), F.array_join("p.typeOfReportingPerson", "|").alias("person_type"))


def active_filings(docs: DataFrame) -> DataFrame:
    """One row per active schedule with its items."""
    x = _ownership(docs, ACTIVE)
    cover, issuer, items = "_x.formData.coverPageHeader", "_x.formData.coverPageHeader.issuerInfo", "_x.formData.items1To7"
    names = {"item1": "item1_security", "item2": "item2_identity", "item3": "item3_source_of_funds", "item4": "item4_purpose", "item5": "item5_interest",
             "item6": "item6_contracts", "item7": "item7_exhibits"}
    return x.select("path", "accn", F.col("_x.headerData.submissionType").alias("form"), F.col(f"{cover}.amendmentNo").alias("amendment_no"),
                    F.col("_x.headerData.previousAccessionNumber").alias("previous_accn"), F.col(f"{cover}.dateOfEvent").alias("date_of_event"),
                    F.col(f"{cover}.securitiesClassTitle").alias("security_class"), F.col(f"{issuer}.issuerCik").alias("issuer_cik"),
                    _squeeze(F.col(f"{issuer}.issuerName")).alias("issuer_name"), F.col(f"{issuer}.issuerCusip").alias("issuer_cusip"),
                    *[_squeeze(F.col(f"{items}.{k}")).alias(v) for k, v in names.items()])


def active_persons(docs: DataFrame) -> DataFrame:
    """One row per reporting person of each active schedule."""
    x = _ownership(docs, ACTIVE)
    issuer = "_x.formData.coverPageHeader.issuerInfo"
    p = x.select("path", "accn", F.col(f"{issuer}.issuerCik").alias("issuer_cik"), _squeeze(F.col(f"{issuer}.issuerName")).alias("issuer_name"),
                 F.explode("_x.formData.reportingPersons.reportingPersonInfo").alias("p"))
    return p.select("path", "accn", "issuer_cik", "issuer_name", F.col("p.reportingPersonCIK").alias("person_cik"), _squeeze(F.col("p.reportingPersonName")).alias("person_name"),
                    F.col("p.fundType").alias("fund_type"), F.col("p.citizenshipOrOrganization").alias("citizenship"),
                    no_commas(F.col("p.soleVotingPower")).alias("sole_voting"), no_commas(F.col("p.sharedVotingPower")).alias("shared_voting"),
                    no_commas(F.col("p.soleDispositivePower")).alias("sole_dispositive"), no_commas(F.col("p.sharedDispositivePower")).alias("shared_dispositive"),
                    no_commas(F.col("p.aggregateAmountOwned")).alias("aggregate_owned"), no_commas(F.col("p.percentOfClass")).alias("percent_of_class"),
                    F.col("p.isAggregateExcludeShares").alias("excludes_shares"), F.array_join("p.typeOfReportingPerson", "|").alias("person_type"))


# -- holdings -------------------------------------------------------------------------

INFO_TABLE = """struct<infoTable: array<struct<nameOfIssuer: string, titleOfClass: string, cusip: string, value: string,
  shrsOrPrnAmt: struct<sshPrnamt: string, sshPrnamtType: string>, putCall: string, investmentDiscretion: string, otherManager: string,
  votingAuthority: struct<Sole: string, Shared: string, None: string>>>>"""


def information_table(docs: DataFrame) -> DataFrame:
    """Holdings as filed, with any or no namespace. ``docs``: path, cik, accn, content."""
    t = docs.select("cik", "accn", F.explode(F.from_xml("content", INFO_TABLE, XML)["infoTable"]).alias("t"))
    return t.select("cik", "accn", F.col("t.nameOfIssuer").alias("issuer"), F.col("t.titleOfClass").alias("title_of_class"), "t.cusip",
                    to_double("t.value").alias("value_reported"), to_double("t.shrsOrPrnAmt.sshPrnamt").alias("shares_or_principal"),
                    F.col("t.shrsOrPrnAmt.sshPrnamtType").alias("share_type"), F.col("t.putCall").alias("put_call"),
                    F.col("t.investmentDiscretion").alias("investment_discretion"), F.col("t.otherManager").alias("other_manager"),
                    to_double("t.votingAuthority.Sole").alias("voting_sole"), to_double("t.votingAuthority.Shared").alias("voting_shared"),
                    to_double("t.votingAuthority.None").alias("voting_none"))


FUND = """struct<formData: struct<invstOrSecs: struct<invstOrSec: array<struct<name: string, lei: string, cusip: string,
  identifiers: struct<isin: struct<_value: string>>, valUSD: string, pctVal: string, assetCat: string>>>>>"""


def fund_holdings(docs: DataFrame) -> DataFrame:
    """Holdings of a fund's monthly portfolio report. ``docs``: path, accn, content."""
    h = docs.select("accn", F.explode(F.from_xml("content", FUND, XML)["formData"]["invstOrSecs"]["invstOrSec"]).alias("h"))
    return h.select("accn", "h.name", "h.lei", "h.cusip", F.col("h.identifiers.isin._value").alias("isin"), to_double("h.valUSD").alias("value_usd"),
                    to_double("h.pctVal").alias("pct_of_fund"), F.col("h.assetCat").alias("asset_category"))


# -- instance documents ---------------------------------------------------------------

ASIDE = r"<!\[CDATA\[.*?\]\]>|<!--.*?-->|<\?.*?\?>"
START = r"""<[\w.:-]+(?:[^<>"']++|"[^"]*+"|'[^']*+')*+>"""
MARK = rf"(?s)(?:{ASIDE})|{START}(?:[^<]++|{ASIDE}|</[^>]*+>)*+"
DOCTYPE = r"""(?s)^((?:\s++|<\?.*?\?>|<!--.*?-->)*+)(<!DOCTYPE(?:[^\[>"']++|"[^"]*+"|'[^']*+')*+(?:\[[^\]]*+\]\s*+)?>)"""

# Entities every document may use.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&amp;": "&"}


def _attribute(text: Column, name: str) -> Column:
    return _unescaped(F.regexp_extract(text, rf"""(?s)[\s]{name}\s*=\s*(["'])(.*?)\1""", 2))


def _unescaped(text: Column) -> Column:
    """Text with the entities every document may use and character numbers replaced, once; others stay as they are written."""
    def point(digits: Column) -> Column:
        """The character of a number, NULL where there is none. Digits are tried by pattern before, since a cast that fails costs an exception each time."""
        number = digits.cast("int")
        return F.when(number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF), F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))

    def said(part: Column) -> Column:
        number = F.when(F.regexp_like(part, F.lit(r"^&#x[0-9A-Fa-f]{1,6};$")), point(F.conv(F.regexp_extract(part, r"^&#x([0-9A-Fa-f]{1,6});$", 1), 16, 10))) \
            .when(F.regexp_like(part, F.lit(r"^&#[0-9]{1,7};$")), point(F.regexp_extract(part, r"^&#([0-9]{1,7});$", 1)))
        written = F.when(F.startswith(part, F.lit("&#")), number).otherwise(lookup(ENTITIES, part))
        return F.when(F.startswith(part, F.lit("&")), F.coalesce(written, part)).otherwise(part)

    parts = F.regexp_extract_all(text, F.lit(r"&[^;&\s]{1,10};|[^&]+|&"), F.lit(0))
    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(parts, said), "")).otherwise(text)


def _content(tail: Column) -> Column:
    """The text of what stands between two tags: sections of character data as they are, other text unescaped, comments and instructions left out."""
    parts = F.regexp_extract_all(tail, F.lit(rf"(?s){ASIDE}|[^<]+"), F.lit(0))
    plain = lambda p: F.when(F.startswith(p, F.lit("<![CDATA[")), F.substr(p, F.lit(10), F.length(p) - 12)).when(F.startswith(p, F.lit("<")), "").otherwise(_unescaped(p))
    text = F.when(F.contains(tail, F.lit("<")), F.array_join(F.transform(parts, plain), "")).otherwise(_unescaped(tail))
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def _checked(docs: DataFrame) -> DataFrame:
    """(source_url, content, reason): why a document can't be read, NULL where it can. A document type that declares no entities is taken out."""
    declared = F.regexp_extract("content", DOCTYPE, 2)
    content = F.when(declared != "", F.regexp_replace("content", DOCTYPE, "$1")).otherwise(F.col("content"))
    d = docs.select(F.col("path").alias("source_url"), content.alias("content"), declared.alias("declared"))
    broken = F.from_xml("content", "_bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})["_bad"].isNotNull()
    reason = F.when(F.col("content").isNull(), "empty").when(F.contains("declared", F.lit("<!ENTITY")), "entities declared").when(broken, "not well formed")
    return d.select("source_url", "content", reason.alias("reason"))


def instance_rejects(docs: DataFrame) -> DataFrame:
    """Documents that ``instance_facts`` leaves out, and why."""
    return _checked(docs).where("reason IS NOT NULL").select("source_url", "reason")


def elements(docs: DataFrame) -> DataFrame:
    """Every element of well-formed documents, at any depth: source_url, pos, depth (the root is 1), child (number of the root's child it lies in, 0 for the root),
    prefix, name, attributes, text up to its first child.

    ``docs``: source_url, content. A mark is the tag that starts an element with all up to the next such tag, so character data and comments never look like tags and
    tags that end elements are no rows. A mark's change is what it leaves open, +1 less the ends in it, and depth is a running sum of changes within a document.
    """
    m, tail = F.col("mark"), F.col("tail")
    tag = F.regexp_extract(m, rf"(?s)^{START}", 0)
    marks = docs.select("source_url", F.posexplode(F.regexp_extract_all("content", F.lit(MARK), F.lit(0))).alias("pos", "mark"))
    marks = marks.where(~F.startswith(m, F.lit("<!")) & ~F.startswith(m, F.lit("<?"))).select("source_url", "pos", tag.alias("tag"), F.substr(m, F.length(tag) + 1).alias("tail"))
    alone, full = F.endswith("tag", F.lit("/>")), F.regexp_extract("tag", r"^<([\w.:-]+)", 1)
    plain = ~F.contains(tail, F.lit("<!")) & ~F.contains(tail, F.lit("<?"))
    said = F.when(plain, F.substring_index(tail, "<", 1)).otherwise(F.regexp_extract(tail, rf"(?s)^(?:[^<]++|{ASIDE})*+", 0))
    left = F.when(plain, tail).otherwise(F.regexp_replace(tail, rf"(?s)(?:{ASIDE})", ""))
    ends = ((F.length(left) - F.length(F.replace(left, F.lit("</"), F.lit("")))) / 2).cast("int")
    marks = marks.select(
        "source_url", "pos", (F.when(alone, 0).otherwise(1) - ends).alias("change"), F.when(F.contains(full, F.lit(":")), F.substring_index(full, ":", 1)).alias("prefix"),
        F.substring_index(full, ":", -1).alias("name"), F.col("tag").alias("attributes"), F.when(alone, "").otherwise(_content(said)).alias("text"))
    up_to = Window.partitionBy("source_url").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marks = marks.withColumn("depth", F.sum("change").over(up_to) - F.col("change") + 1)
    marks = marks.withColumn("child", F.sum(F.when(F.col("depth") == 2, 1).otherwise(0)).over(up_to))
    return marks.select("source_url", "pos", "depth", "child", "prefix", "name", "attributes", "text")


def instance_facts(docs: DataFrame) -> DataFrame:
    """Facts of instance documents, one row each; documents that can't be read are in ``instance_rejects``.

    Contexts, units and facts are children of the root, and each child is one row: what lies in it is summed up by name, since the
    element names of facts are open-ended and no schema can name them. Facts meet their context, then their unit, in windows over document and
    id, so a document is parsed once. Of definitions with the same id the last stands. ``docs``: path, content.
    """
    e = elements(_checked(docs).where("reason IS NULL").select("source_url", "content")).where("depth >= 2")
    attribute = lambda n: _attribute(F.col("attributes"), n)
    root = F.col("depth") == 2
    own = lambda c: F.max(F.when(root, c))
    last = lambda n: F.max_by("text", F.when(F.col("name") == n, F.col("pos")))
    listed = lambda n, c: F.transform(F.array_sort(F.collect_list(F.when((F.col("name") == n) & (c != ""), F.struct("pos", c.alias("v"))))), lambda x: x["v"])
    axis = attribute("dimension")
    children = e.where(root | F.col("name").isin("identifier", "startDate", "endDate", "instant", "explicitMember", "measure")).groupBy("source_url", "child").agg(
        own(F.col("name")).alias("concept"), own(F.col("prefix")).alias("taxonomy"), own(F.col("attributes")).alias("attributes"), own(F.col("text")).alias("value_text"),
        *[blank_to_null(last(n)).alias(a) for n, a in (("identifier", "entity"), ("startDate", "period_start"), ("endDate", "_end"), ("instant", "_instant"))],
        listed("explicitMember", F.when(axis != "", F.concat(axis, F.lit("="), F.col("text"))).otherwise("")).alias("dims"),
        listed("measure", F.trim(F.substring_index("text", ":", -1))).alias("measures"))
    kind = F.when(F.col("concept").isin("context", "unit"), F.col("concept")).when(
        (F.col("concept") != "schemaRef") & F.regexp_like("attributes", F.lit(r"\scontextRef\s*=")), "fact")
    c = children.withColumn("kind", kind).where("kind IS NOT NULL").withColumn("context_id", F.when(F.col("kind") == "fact", attribute("contextRef")).when(F.col("kind") == "context", attribute("id"))) \
        .withColumn("_unit", F.when(F.col("kind") == "fact", blank_to_null(attribute("unitRef"))).when(F.col("kind") == "unit", attribute("id")))
    found = lambda k, x, key: F.max_by(x, F.when(F.col("kind") == k, F.col("child"))).over(Window.partitionBy("source_url", key))
    context = F.struct("entity", "period_start", "_end", "_instant", F.concat_ws(";", "dims").alias("dimensions"))
    c = c.withColumn("x", found("context", context, "context_id")).where("kind <> 'context'").select(
        "source_url", "child", "kind", "concept", "taxonomy", "context_id", "_unit", "value_text", blank_to_null(attribute("decimals")).alias("decimals"), "x",
        blank_to_null(F.concat_ws("/", "measures")).alias("measures"))
    c = c.withColumn("_measure", F.when(F.col("_unit").isNotNull(), found("unit", F.col("measures"), "_unit"))).where("kind = 'fact'").select("*", "x.*")
    number = F.nanvl(F.when(F.col("_unit").isNotNull(), F.col("value_text").try_cast("double")), F.lit(None).cast("double"))
    return c.select(
        "source_url", "concept", "taxonomy", "context_id", "entity", "period_start", F.coalesce("_end", "_instant").alias("period_end"),
        F.col("_instant").isNotNull().alias("instant"), (F.coalesce("dimensions", F.lit("")) != "").alias("has_dimensions"),
        F.coalesce("dimensions", F.lit("")).alias("dimensions"), F.coalesce("_measure", "_unit").alias("unit"), "decimals", "value_text", number.alias("value"))


def reported_period(facts: DataFrame) -> DataFrame:
    """Periods a context reports about itself replace its declared ones; instants keep theirs."""
    w = Window.partitionBy("source_url", "context_id")
    said = lambda c: F.max(F.when(F.col("concept") == c, F.col("value_text"))).over(w)
    return facts.select("*", said("DateOfStartOfReportingPeriod").alias("_s"), said("DateOfEndOfReportingPeriod").alias("_e")) \
        .withColumn("period_start", F.coalesce("_s", "period_start")) \
        .withColumn("period_end", F.when(F.col("instant"), F.col("period_end")).otherwise(F.coalesce("_e", "period_end"))).drop("_s", "_e")


def with_filing(facts: DataFrame, index: DataFrame, url: str = "xbrl") -> DataFrame:
    """Filing columns on every fact; the index is reduced to one row per document first."""
    order = [F.col(c).desc_nulls_last() for c in index.columns if c != url]
    first = Window.partitionBy(url).orderBy(*(order or [F.lit(0)]))
    one = (index.where(F.col(url).isNotNull()).withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")
           .withColumnRenamed(url, "source_url"))
    return facts.join(one, "source_url", "left")
