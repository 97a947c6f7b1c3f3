import hashlib
import json
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.sources import archive as ar
from tidemark.sources import cells as ce
from tidemark.sources import files as fi
from tidemark.sources import grids as gr
from tidemark.sources import markets as mk
from tidemark.sources import regulators as rg
from tidemark.sources import world as wo


def put(folder, name, content):
    p = folder / name
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(p)


def docs(spark, content, **extra):
    return spark.createDataFrame([("f", content, *extra.values())], "path string, content string" + "".join(f", {k} string" for k in extra))


def test_csv_files_with_repeated_headers_and_quotes(spark, tmp_path):
    put(tmp_path, "a.csv", 'SYMBOL , CLOSE\nR, "1,400.5"\nT, 9\n')
    put(tmp_path, "b.csv", "SYMBOL , CLOSE\nQ, -\n")
    src = fi.lines(spark, str(tmp_path))
    head = fi.header_of(src)
    assert head == ["SYMBOL", "CLOSE"]
    r = {x.SYMBOL: x.CLOSE for x in mk.price_file(src, head, ["CLOSE"]).collect()}
    assert r == {"R": None, "T": 9.0, "Q": None}
    with pytest.raises(RuntimeError, match="schema drift"):
        fi.csv_rows(src, head, required=["VOLUME"], dataset="px")


def test_banner_row(spark, tmp_path):
    put(tmp_path, "oi.csv", "Participant wise Open Interest, as on Aug 20\nClient Type,Total Long Contracts      ,Total Short Contracts\nFII,10,4\nTOTAL,20,20\n")
    src = fi.lines(spark, str(tmp_path))
    r = fi.bannered_csv(src, fi.header_of(src, skip=1), "2026-08-20").orderBy("`Client Type`").collect()
    assert [(x["Client Type"], x["Total Long Contracts"], x.trade_date) for x in r] == [("FII", "10", date(2026, 8, 20)), ("TOTAL", "20", date(2026, 8, 20))]


def test_manifest_integrity_and_lookup(spark, tmp_path):
    for name, body, day, broken in (("noaa/oni/a.txt", b"one", 1, False), ("noaa/oni/b.txt", b"two", 2, False), ("sec/13d/c.xml", b"x", 3, True)):
        put(tmp_path, name, body)
        sha = hashlib.sha256(b"other" if broken else body).hexdigest()
        s, d = name.split("/")[:2]
        put(tmp_path, name + ".meta.json", json.dumps({"source": s, "dataset": d, "fetched_at_utc": f"2026-08-0{day}T00:00:00.5+00:00", "sha256": sha, "bytes": len(body), "year": 2020 + day}))
    put(tmp_path, "sec/13d/bad.meta.json", "{oops")
    m = ar.read_manifest(spark, str(tmp_path), "year int")
    assert m.count() == 3
    assert {x.path.split("/")[-1] for x in ar.latest_raw(m).collect()} == {"b.txt", "c.xml"}
    assert ar.find_raw(m, "noaa", "oni", year=2021).first().path.endswith("a.txt")
    assert ar.find_raw(m, "noaa", "oni", year=1999).count() == 0
    files = fi.binary_documents(spark, [str(tmp_path / "noaa" / "oni" / "*.txt"), str(tmp_path / "sec" / "13d" / "*.xml")])
    state = {x.path.split("/")[-1]: x.state for x in ar.integrity(files.withColumn("path", F.regexp_replace("path", "file:/+", "file:///")), m.withColumn("path", F.regexp_replace("path", "file:/+", "file:///"))).collect()}
    assert state == {"a.txt": "ok", "b.txt": "ok", "c.xml": "hash_mismatch"}


def test_company_facts_keep_open_ended_concepts(spark):
    doc = {"cik": "0000000007", "entityName": "E", "facts": {"us-gaap": {"Assets": {"label": "A", "units": {"USD": [{"end": "2024-12-31", "val": 100, "fy": 2024, "fp": "FY", "form": "10-K", "filed": "2025-02-01", "accn": "a"},
                                                                                                               {"end": "2024-12-31", "val": 110, "filed": "2025-06-01", "accn": "b"}]}}},
                                                             "dei": {"Shares": {"label": None, "units": {"shares": [{"end": "2024-12-31", "val": 5, "filed": "2025-02-01", "accn": "a"}]}}}, "ecd": {}}}
    r = rg.company_facts(docs(spark, json.dumps(doc)))
    assert sorted((x.cik, x.taxonomy, x.concept, x.unit, x.value, x.filed) for x in r.collect()) == [
        (7, "dei", "Shares", "shares", 5.0, date(2025, 2, 1)), (7, "us-gaap", "Assets", "USD", 100.0, date(2025, 2, 1)), (7, "us-gaap", "Assets", "USD", 110.0, date(2025, 6, 1))]


def test_instance_document_and_self_reported_period(spark):
    xml = ('<x:xbrl xmlns:x="http://i" xmlns:f="http://f"><x:context id="D"><x:period><x:startDate>2024-10-01</x:startDate><x:endDate>2024-12-31</x:endDate></x:period></x:context>'
           '<x:context id="I"><x:period><x:instant>2024-12-31</x:instant></x:period></x:context><x:unit id="U"><x:measure>iso4217:INR</x:measure></x:unit>'
           '<f:DateOfStartOfReportingPeriod contextRef="D">2024-04-01</f:DateOfStartOfReportingPeriod><f:DateOfEndOfReportingPeriod contextRef="I">1999-01-01</f:DateOfEndOfReportingPeriod>'
           '<f:Sales contextRef="D" unitRef="U" decimals="0">12.5</f:Sales><f:Assets contextRef="I" unitRef="U">bad</f:Assets><f:Name contextRef="D">7</f:Name></x:xbrl>')
    both = docs(spark, xml).unionByName(docs(spark, "<broken")).unionByName(docs(spark, '<!DOCTYPE a [<!ENTITY b "c">]><a/>'))
    r = {x.concept: x for x in rg.reported_period(rg.instance_facts(both)).collect()}
    assert (r["Sales"].period_start, r["Sales"].period_end, r["Sales"].value, r["Sales"].unit, r["Sales"].taxonomy) == ("2024-04-01", "2024-12-31", 12.5, "INR", "f")
    assert (r["Assets"].instant, r["Assets"].period_end, r["Assets"].value, r["Assets"].value_text) == (True, "2024-12-31", None, "bad")
    assert r["Name"].value is None and r["Name"].value_text == "7" and len(r) == 5


def test_instance_sections_nesting_and_entities(spark):
    root = '<?xml version="1.0"?>\n<!-- a <b> --><!DOCTYPE xbrl SYSTEM "x>y.dtd" [ <!ELEMENT a ANY> ]>\n<xbrl xmlns="http://i" xmlns:f="http://f" xmlns:d="http://d">'
    context = ('<context id="C&amp;1"><entity><identifier scheme="s"><![CDATA[<A&B>]]></identifier></entity><period><startDate> 2024-01-01\n</startDate><endDate>2024-03-31</endDate></period>'
               '<scenario><d:explicitMember dimension="f:X">M1</d:explicitMember><d:explicitMember dimension="f:Y"><!-- none -->M2</d:explicitMember></scenario></context>')
    facts = ('<f:Note contextRef="C&amp;1"><![CDATA[ 1 < 2 &amp; </f:Note><f:Fake contextRef="C"> ]]></f:Note><f:Both contextRef="C&amp;1">a&lt;b &#8377;&#x1F600; <![CDATA[<c>]]> d &amp;lt;</f:Both>'
             '<f:Tuple contextRef="C&amp;1">head<f:Inner contextRef="C&amp;1">in</f:Inner>tail</f:Tuple><f:Empty contextRef="none" unitRef="pure"/><f:Amount decimals="-3" contextRef = \'C&amp;1\' unitRef="U">&#49;2.5<!-- <x> --></f:Amount>'
             '<unit id="U"><divide><unitNumerator><measure>iso4217:INR</measure></unitNumerator><unitDenominator><measure>shares</measure></unitDenominator></divide></unit>'
             '<f:Said note="a > b" contextRef="C&amp;1">x</f:Said></xbrl>')
    d = docs(spark, root + context + facts).unionByName(docs(spark, None)).unionByName(docs(spark, '<!DOCTYPE a [<!ENTITY b "c">]><a/>')).unionByName(docs(spark, "<a><b></a>"))
    r = {x.concept: x for x in rg.instance_facts(d).collect()}
    assert set(r) == {"Note", "Both", "Tuple", "Empty", "Amount", "Said"}
    assert r["Note"].value_text == '1 < 2 &amp; </f:Note><f:Fake contextRef="C">' and r["Both"].value_text == "a<b \u20b9\U0001f600 <c> d &lt;"
    assert r["Tuple"].value_text == "head" and (r["Empty"].value_text, r["Empty"].unit, r["Empty"].period_end, r["Empty"].instant) == ("", "pure", None, False)
    assert (r["Amount"].value, r["Amount"].unit, r["Amount"].decimals, r["Amount"].entity, r["Amount"].period_start) == (12.5, "INR/shares", "-3", "<A&B>", "2024-01-01")
    assert r["Said"].dimensions == "f:X=M1;f:Y=M2" and r["Said"].has_dimensions
    assert sorted(x.reason for x in rg.instance_rejects(d).collect()) == ["empty", "entities declared", "not well formed"]


def test_a_mark_is_an_element_and_holds_its_ends(spark):
    """Ends, also with text, comments and character data that look like ends between them, are no rows; depth and text stay as they are."""
    x = ("<r>a<b k='1>2'>b<!-- </b> --><c><d>d</d > <![CDATA[</c></b>]]><e/>t</c>u</b><?p </r> ?>v<f>&#38;&#x41;&#0;&amp;gt;&no;</f><g/></r>")
    mark = docs(spark, x).select(F.size(F.regexp_extract_all("content", F.lit(rg.MARK), F.lit(0))).alias("n")).first().n
    got = [(e.name, e.depth, e.child, e.text) for e in rg.elements(docs(spark, x).withColumnRenamed("path", "source_url")).orderBy("pos").collect()]
    assert mark == len(got) == 7
    assert got == [("r", 1, 0, "a"), ("b", 2, 1, "b"), ("c", 3, 1, ""), ("d", 4, 1, "d"), ("e", 4, 1, ""), ("f", 2, 2, "&A&#0;&gt;&no;"), ("g", 2, 3, "")]


def test_instance_of_deep_elements(spark):
    n = 3000
    x = "".join(f"<a{i}>" for i in range(n)) + "".join(f"</a{i}>" for i in reversed(range(n)))
    got = rg.elements(spark.createDataFrame([("f", f"<r>{x}<z/></r>")], "source_url string, content string"))
    assert got.agg(F.max("depth")).first()[0] == n + 1 and got.where("name = 'z'").first().depth == 2


def test_instance_of_many_elements(spark):
    n = 20000
    x = "<r>" + "".join(f'<context id="c{i}"><period><instant>2024-01-{i % 28 + 1:02d}</instant></period></context><v contextRef="c{i}" unitRef="u">{i}</v>' for i in range(n)) + "</r>"
    got = rg.instance_facts(docs(spark, x)).where("instant").agg(F.count("*").alias("n"), F.sum("value").alias("s")).first()
    assert (got.n, got.s) == (n, n * (n - 1) / 2)


def test_ownership_xml_tolerates_case_and_namespace(spark):
    body = "<{p}edgarSubmission{ns}><{p}formData><{p}coverPageHeader><{p}issuerInfo><{p}{tag}>77</{p}{tag}></{p}issuerInfo></{p}coverPageHeader><{p}coverPageHeaderReportingPersonDetails><{p}reportingPersonName>A\n  B</{p}reportingPersonName><{p}classPercent>1,005.5</{p}classPercent><{p}typeOfReportingPerson>IA</{p}typeOfReportingPerson><{p}typeOfReportingPerson>HC</{p}typeOfReportingPerson></{p}coverPageHeaderReportingPersonDetails></{p}formData></{p}edgarSubmission>"
    for p, ns, tag in (("", "", "issuerCik"), ("n:", ' xmlns:n="http://x"', "issuerCIK"), ("", ' xmlns="http://x"', "issuerCIK")):
        x = rg.passive_persons(docs(spark, body.format(p=p, ns=ns, tag=tag), accn="a")).first()
        assert (x.issuer_cik, x.person_name, x.percent_of_class, x.person_type) == ("77", "A B", 1005.5, "IA|HC")


def test_settlement_order_ignores_total_and_price(spark):
    d = json.dumps({"tradeDate": "t", "settlements": [{"month": "AUG", "settle": "1,900.5A"}, {"month": "Total", "settle": "-", "volume": "9"}, {"month": "OCT", "settle": "1800"}]})
    r = mk.settlements(docs(spark, d, product="gold", trade_date_requested="2026-08-20")).collect()
    assert {x.month: (x.contract_order, x.settle_num, x.is_total) for x in r} == {"AUG": (0, 1900.5, False), "Total": (None, None, True), "OCT": (1, 1800.0, False)}


def test_page_error_inside_a_success_raises(spark):
    bad = docs(spark, json.dumps({"error": {"code": 429, "message": "quota"}}))
    with pytest.raises(Exception, match="quota"):
        wo.chokepoint_pages(bad, ["date", "portname", "n_total"]).collect()
    with pytest.raises(RuntimeError, match="schema drift"):
        wo.chokepoint_pages(bad, ["date"])


def test_short_state_vectors_do_not_shift(spark):
    d = json.dumps({"time": 1700000000, "states": [["i", "AB  ", "IN", 1, 2, 72.5], ["j", "  ", "IN"] + [None] * 14 + ["6"]]})
    r = {x.icao24: x for x in wo.aircraft_states(docs(spark, d, box="b")).collect()}
    assert (r["i"].callsign, r["i"].longitude, r["i"].category) == ("AB", 72.5, None) and (r["j"].callsign, r["j"].category) == (None, "6")


def grid_folder(spark, tmp_path, days: int = 40):
    layout = gr.Layout(3, 2, 1, 70.0, 10.0, 1.0)
    rows = [(date(2026, 1, 1) + timedelta(i), np.array([i, -999, 2, 3, 4, 5], dtype="<f4").tobytes()) for i in range(days)]
    folder = str(tmp_path / "grids")
    gr.write_grids(spark.createDataFrame(rows, "date date, content binary").repartition(3), folder, layout)
    return folder, layout


def test_grid_source_reads_what_was_written(spark, tmp_path):
    folder, layout = grid_folder(spark, tmp_path)
    rows = gr.read_grids(spark, folder, layout).collect()
    assert len(rows) == 40 * 5 and {x.layer for x in rows} == {0}
    assert {(x.date, x.value) for x in rows if (x.lat, x.lon) == (10.0, 70.0)} == {(date(2026, 1, 1) + timedelta(i), float(i)) for i in range(40)}
    assert (11.0, 72.0, 5.0) in {(x.lat, x.lon, x.value) for x in rows}
    gr.write_grids(spark.createDataFrame([(date(2026, 1, 1), np.full(6, 7, dtype="<f4").tobytes())], "date date, content binary"), "file:" + folder, layout)
    again = gr.read_grids(spark, "file:" + folder, layout)
    assert again.count() == 40 * 5 + 1 and again.where("date = DATE '2026-01-01'").agg(F.sum("value")).first()[0] == 42


@pytest.mark.parametrize("bound, days", [("date = DATE '2026-01-05'", 1), ("date > DATE '2026-02-01' AND date <= DATE '2026-02-04'", 3), ("date IN (DATE '2026-01-01', DATE '2026-01-09')", 2),
                                         ("date < DATE '2025-01-01'", 0), ("date >= DATE '2026-02-05' AND value = 3", 5), ("date = DATE '2026-01-01' OR value < 0", 1), ("date IS NULL", 0)])
def test_grid_source_opens_files_of_wanted_days_only(spark, tmp_path, bound, days):
    folder, layout = grid_folder(spark, tmp_path)
    bad = tmp_path / "grids" / "grid_20300101.bin"
    bad.write_bytes(b"short")                      # read only where its day is wanted
    got = gr.read_grids(spark, folder, layout).where(bound)
    if " OR " in bound or "NULL" in bound:         # nothing is taken over, so every file is opened
        with pytest.raises(Exception, match="grid layout changed"):
            got.collect()
    elif ">=" in bound:
        with pytest.raises(Exception, match="grid layout changed"):
            got.collect()
        assert got.where("date < DATE '2030-01-01'").select("date").distinct().count() == days
    else:
        assert got.select("date").distinct().count() == days


def test_grid_source_parts_are_consecutive_days_of_bounded_size(spark, tmp_path, monkeypatch):
    folder, layout = grid_folder(spark, tmp_path)
    reader = gr.GridReader(folder, layout)
    assert len(reader.partitions()) == 2 and [d for p in reader.partitions() for d, _ in p.files] == [date(2026, 1, 1) + timedelta(i) for i in range(40)]
    monkeypatch.setattr(gr, "PART_BYTES", 1)
    assert [len(p.files) for p in reader.partitions()] == [1] * 40
    rest = list(reader.pushFilters([gr.GreaterThan(("date",), date(2026, 2, 7)), gr.GreaterThan(("value",), 1.0), gr.IsNotNull(("date",))]))
    assert [f.attribute for f in rest] == [("value",)] and len(reader.partitions()) == 2


def test_grid_source_refuses_names_sizes_and_days_twice(spark, tmp_path):
    folder, layout = grid_folder(spark, tmp_path, 2)
    write = lambda *rows: gr.write_grids(spark.createDataFrame(rows, "date date, content binary"), folder, layout)
    with pytest.raises(Exception, match="24 bytes"):
        write((date(2026, 1, 1), b"x"))
    with pytest.raises(Exception, match="24 bytes"):
        write((None, bytes(24)))
    with pytest.raises(Exception, match="more than one grid"):
        write((date(2026, 1, 1), bytes(24)), (date(2026, 1, 1), bytes(24)))
    (tmp_path / "grids" / "_SUCCESS").write_bytes(b"")
    assert gr.read_grids(spark, folder, layout).where("date = DATE '2026-01-02'").count() == 5
    (tmp_path / "grids" / "notes.bin").write_bytes(b"")
    with pytest.raises(Exception, match="no date"):
        gr.read_grids(spark, folder, layout).count()


def test_alert_feeds_without_event_types_are_loud(spark):
    feed = lambda tag: f"<rss><channel><item><title>a</title>{tag}</item><item><title>b</title></item></channel></rss>"
    rows = [("good", feed("<e:eventtype xmlns:e='u'> EQ </e:eventtype>")), ("bad", feed("<kind>EQ</kind>")), ("empty", "<rss><channel></channel></rss>"), ("null", None)]
    d = spark.createDataFrame(rows, "path string, content string")
    with pytest.raises(Exception, match="bad: no item has an event type"):
        wo.disaster_alerts(d).collect()
    assert [(x.path, x.title, x.event_type) for x in wo.disaster_alerts(d.where("path <> 'bad'")).orderBy("title").collect()] == [("good", "a", "EQ"), ("good", "b", None)]
    assert wo.disaster_alerts(d, strict=False).count() == 2
    assert [tuple(x) for x in wo.alert_rejects(d).collect()] == [("bad", "no item has an event type; the names of the feed changed")]


def test_grid_file_and_weighted_mean(spark, tmp_path):
    grid = np.full((2, 4, 3), 10.0, dtype="<f4")
    grid[0, 1, 1], grid[0, 2, 1] = -999.0, 40.0
    path = put(tmp_path, "g.bin", grid.tobytes())
    cells = wo.grid_cells(fi.binary_documents(spark, path), 3, 4, 2, lon0=70.0, lat0=0.0, step=20.0).where("layer = 0")
    assert cells.count() == 11
    r = wo.regional_means(cells, {"mid": (80, 100, 0, 45), "none": (0, 1, 0, 1)}, by=()).collect()
    w = np.cos(np.radians([0, 40]))
    assert len(r) == 1 and r[0].valid_cells == 2 and r[0]["mean"] == pytest.approx((10 * w[0] + 40 * w[1]) / w.sum())
    with pytest.raises(Exception, match="expected"):
        wo.grid_cells(fi.binary_documents(spark, path), 5, 4, 2).collect()


def cells(spark, *tables):
    rows = [(f"d{n}", 0, r, c, v) for n, t in enumerate(tables) for r, row in enumerate(t) for c, v in enumerate(row)]
    return spark.createDataFrame(rows, "doc string, table_no int, r int, c int, text string")


def test_tidy_tables(spark):
    years = [["Item", "2025", "2025"], ["", "Jul. 25", "Aug. 25"], ["1", "1", "2"], ["(Per cent)", "(Per cent)", "(Per cent)"], ["Cash ratio", "(4.5)", "1,200"], ["Note", "Note", "Note"], ["nan", "5", "6"]]
    plain = [["Item", "Volume", "Rate"], ["Call", "100", "-"], ["Repo", "–", "5.25"]]
    r = sorted((x.doc, x.row_label, x.series, x.value_num) for x in ce.tidy_tables(cells(spark, years, plain, [["a", "b"]])).collect())
    assert r == [("d0", "Cash ratio", "2025 / Aug. 25", 1200.0), ("d0", "Cash ratio", "2025 / Jul. 25", -4.5), ("d1", "Call", "Volume", 100.0), ("d1", "Repo", "Rate", 5.25)]


def test_tidy_tables_are_shuffled_once(spark):
    """The number of the table is a literal, as where a page has one table; documents may come as numbers."""
    one = [["Item", "2025", "2025"], ["", "Jul. 25", "Aug. 25"], ["1", "1", "2"], ["Cash ratio", "(4.5)", "1,200"]]
    two = cells(spark, one, one).select(F.substr("doc", F.lit(2)).cast("int").alias("doc"), F.lit(0).alias("table_no"), "r", "c", "text")
    tidy = ce.tidy_tables(two)
    assert tidy._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    releases = spark.createDataFrame([(0, "Other"), (1, "Money market today")], "prid int, title string")
    found = ce.release_tables(two, releases, "MONEY").collect()
    assert sorted((x.doc, x.prid, x.series, x.value_num, x.release_title) for x in found) == [
        ("1", "1", "2025 / Aug. 25", 1200.0, "Money market today"), ("1", "1", "2025 / Jul. 25", -4.5, "Money market today")]


def test_sheet_sections(spark):
    t = [["PROFIT & LOSS", ""], ["Report Date", "2025-03-31"], ["Sales", "5"], ["", ""], ["Orphan", "9"], ["BALANCE SHEET", ""], ["Report Date", "2025-03-31"], ["Total", "3"], ["Other", "1"], ["Total", "4"], ["Other", "2"]]
    r = {(x.statement, x.concept): x.value for x in ce.sheet_facts(cells(spark, t)).collect()}
    assert r == {("income_statement", "Sales"): 5.0, ("balance_sheet", "Total Equity and Liabilities"): 3.0, ("balance_sheet", "Total Assets"): 4.0, ("balance_sheet", "Other"): 1.0, ("balance_sheet", "Other_2"): 2.0}


def test_sheet_is_shuffled_once_and_not_joined(spark):
    """Period ends by column, of each section its own; a section without them has no facts, a gap in r ends one."""
    t = [["Quarters", "", ""], ["Report Date", "2025-03-31", "2025-06-30"], ["Sales", "1", "2"], ["Sales", "x", "4"], ["BALANCE SHEET", "7", "8"], ["Report Date", "bad", "2024-06-30"],
         ["Total", "5", "6"], ["CASH FLOW:", "", ""], ["PROFIT & LOSS", "", ""], ["Nothing", "2023-13-01", ""], ["Tax", "9", "9"], ["CASH FLOW:", "", ""], ["Report Date", "2022-03-31", ""]]
    late = spark.createDataFrame([("d0", 0, 20, 0, "Late"), ("d0", 0, 20, 1, "3"), (None, 0, 0, 0, "Quarters")], "doc string, table_no int, r int, c int, text string")
    facts = ce.sheet_facts(cells(spark, t).unionByName(late))
    plan = facts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    assert sorted((x.statement, x.concept, str(x.period_end), x.value) for x in facts.collect()) == [
        ("balance_sheet", "Total Equity and Liabilities", "2024-06-30", 6.0), ("income_statement", "Sales", "2025-03-31", 1.0), ("income_statement", "Sales", "2025-06-30", 2.0),
        ("income_statement", "Sales_2", "2025-06-30", 4.0)]


def test_press_releases_keep_their_own_pdf(spark):
    page = ('<td class="tableheader"><b>Aug 21, 2026</b></td><a class=\'link2\' href=BS_PressReleaseDisplay.aspx?prid=1>No  file</a><a class=\'link2\' href=BS_PressReleaseDisplay.aspx?prid=2>Money Market</a>'
            '<a href="https://rbidocs.rbi.org.in/rdocs/PressRelease/PDFs/P2.PDF"><td class="tableheader"><b>Aug 20, 2026</b></td><a class=\'link2\' href=BS_PressReleaseDisplay.aspx?prid=3>Old</a>')
    r = [(x.prid, x.release_date, x.title, x.pdf_url and x.pdf_url[-6:]) for x in ce.press_releases(docs(spark, page)).orderBy("position").collect()]
    assert r == [("1", "Aug 21, 2026", "No file", None), ("2", "Aug 21, 2026", "Money Market", "P2.PDF"), ("3", "Aug 20, 2026", "Old", None)]


def test_press_releases_stay_in_their_page(spark):
    found = ce.press_releases(docs(spark, "no marks"))
    assert found.count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Window" not in plan


def test_missing_days_are_reported(spark):
    landed = spark.createDataFrame([(date(2026, 1, 1),), (date(2026, 1, 3),)], "date date")
    assert sorted(x.date for x in ar.missing_days("2026-01-01", "2026-01-04", landed).collect()) == [date(2026, 1, 2), date(2026, 1, 4)]


def test_bulk_tsv_stays_text(spark, tmp_path):
    put(tmp_path, "OWN.tsv", "ACCESSION_NUMBER\tRPTOWNERCIK\na\t0001\n")
    assert fi.tsv(spark, str(tmp_path)).first().RPTOWNERCIK == "0001"


def test_filing_rule_is_described(spark):
    x = ("<e><formData><coverPageHeader><issuerInfo><issuerCik>1</issuerCik></issuerInfo><designateRulesPursuantThisScheduleFiled><designateRulePursuantThisScheduleFiled>Rule 13d-1(b)"
         "</designateRulePursuantThisScheduleFiled></designateRulesPursuantThisScheduleFiled></coverPageHeader><items><item2>Who  ever</item2></items></formData></e>")
    r = rg.passive_filings(docs(spark, x, accn="a")).first()
    assert (r.filing_rule, r.filing_rule_desc, r.item2_identity) == ("Rule 13d-1(b)", "qualified institutional investor", "Who ever")


def test_sidecars_that_cannot_be_used_are_named_with_a_reason(spark):
    good = {"source": "noaa", "dataset": "oni", "fetched_at_utc": "2026-08-01T00:00:00+00:00", "sha256": hashlib.sha256(b"one").hexdigest(), "bytes": 3}
    rows = [("a", json.dumps(good)), ("b", "{oops"), ("c", json.dumps({**good, "source": None})), ("d", json.dumps({**good, "fetched_at_utc": "soon"})), ("e", ""), ("f", None),
            ("g", json.dumps({k: v for k, v in good.items() if k != "sha256"}))]
    side = spark.createDataFrame([(f"{p}.meta.json", x) for p, x in rows], "path string, content string")
    assert {r.path: r.reason for r in ar.sidecar_rejects(side).collect()} == {
        "b": "not JSON", "c": "no source", "d": "no readable time", "e": "not JSON", "f": "not JSON", "g": "no sha256"}
    assert {r.path for r in ar.manifest(side).collect()} == {"a", "d", "g"}
    files = spark.createDataFrame([(p, bytearray(b"one")) for p in "abz"], "path string, content binary")
    state = lambda *more: {r.path: r.state for r in ar.integrity(files, ar.manifest(side), *more).collect()}
    assert state() == {"a": "ok", "b": "no_sidecar", "z": "no_sidecar"}
    assert state(ar.sidecar_rejects(side)) == {"a": "ok", "b": "unreadable_sidecar", "z": "no_sidecar"}


def test_failed_answers_are_listed_or_raised(spark):
    bar = {"Date": "08/20/2026", "Symbol": " GOLD ", "Close": 5.0}
    bodies = [json.dumps({"IsSuccess": True, "Data": [bar]}), json.dumps({"IsSuccess": False, "Message": "closed", "Data": []}), "<html>", json.dumps({"Data": [bar]}), "null"]
    df = spark.createDataFrame([(f"p{k}", x) for k, x in enumerate(bodies)], "path string, content string")
    assert [r.Symbol for r in mk.commodity_bars(df).collect()] == ["GOLD"]
    assert {r.path: (r.reason, r.message) for r in mk.failed_answers(df).collect()} == {
        "p1": ("refused", "closed"), "p2": ("not JSON", None), "p3": ("no flag", None), "p4": ("no flag", None)}
    with pytest.raises(Exception, match="failed answer in p"):
        mk.commodity_bars(df, strict=True).collect()
    assert mk.commodity_bars(df.where("path = 'p0'"), strict=True).count() == 1


def test_every_day_of_a_range_has_a_state(spark):
    rows = [("2026-08-01", True), ("2026-08-01", False), ("2026-08-03", False), ("2026-08-04", None), ("2026-09-01", True)]
    landed = spark.createDataFrame(rows, "date string, ok boolean").withColumn("date", F.to_date("date"))
    got = [(r.date.day, r.state, r.rows) for r in ar.day_range("2026-08-01", "2026-08-05", landed, status=F.col("ok")).orderBy("date").collect()]
    assert got == [(1, "landed", 2), (2, "missing", 0), (3, "failed", 1), (4, "failed", 1), (5, "missing", 0)]
    assert [r.date.day for r in ar.missing_days("2026-08-01", "2026-08-05", landed).orderBy("date").collect()] == [2, 5]
