from datetime import datetime

import pytest

from tidemark.operators import lineage as ln
from tidemark.operators import quality as q


def test_one_silent_revision(spark):
    df = spark.createDataFrame([("A", 10.0, "1"), ("B", 20.0, "1"), ("A", 10.0, "2"), ("B", 25.0, "2")], "sym string, close double, _vintage_id string")
    r = q.detect_revisions(df, ["sym"]).collect()
    assert len(r) == 1 and (r[0].sym, r[0].fields_changed, r[0].example_before, r[0].example_after) == ("B", "close", "20.0", "25.0")
    assert (r[0].first_vintage, r[0].latest_vintage) == ("1", "2")


def test_null_and_empty_are_values_and_metadata_is_not(spark):
    df = spark.createDataFrame([("A", "x", "d1", "1"), ("A", None, "d2", "2"), ("B", None, "d1", "1"), ("B", "", "d2", "2"), ("C", "y", "d1", "1"), ("C", "y", "d2", "2"), (None, "p", "d1", "1"), (None, "q", "d2", "2")],
                               "sym string, v string, knowledge_date string, _vintage_id string")
    r = {x.sym: (x.example_before, x.example_after) for x in q.detect_revisions(df, ["sym"]).collect()}
    assert r == {"A": ("x", "(missing)"), "B": ("(missing)", ""), None: ("p", "q")}
    with pytest.raises(KeyError):
        q.detect_revisions(df, ["nope"])


def test_volume_collapse(spark):
    df = spark.createDataFrame([(v,) for v, n in (("a", 100), ("b", 80), ("c", 10)) for _ in range(n)], "_vintage_id string")
    r = q.volume_trend(df).orderBy("vintage").collect()
    assert [(x.rows, x.row_change, x.collapsed) for x in r] == [(100, None, False), (80, -20, False), (10, -70, True)]


def test_status_priority_and_freshness_fallback(spark):
    vol = spark.createDataFrame([("s_a", "1", 100, None, False), ("s_a", "2", 10, -90, True), ("s_b", "1", 5, None, False), ("t_c", "1", 5, None, False), ("t_c", "2", 5, 0, False), ("u_d", "1", 1, None, False)],
                                "view string, vintage string, rows bigint, row_change bigint, collapsed boolean")
    rev = spark.createDataFrame([("t_c", 3), ("s_a", 1)], "view string, n_revised bigint")
    fresh = spark.createDataFrame([("s", "a", "2026-01-01", 10.0), ("s", "z", "2026-01-02", 50.0), ("t", "other", "2026-01-01", 1.0)], "source string, dataset string, last_fetch_utc string, age_hours double")
    r = {x.view: x for x in q.quality_report(vol, rev, fresh).collect()}
    assert {k: v.status for k, v in r.items()} == {"s_a": "COLLAPSED", "s_b": "STALE", "t_c": "REVISED", "u_d": "OK"}
    assert (r["s_b"].freshness_basis, r["s_a"].freshness_basis, r["u_d"].freshness_basis) == ("source", "dataset", "none")
    assert (r["s_b"].revisions, r["t_c"].revisions) == ("n/a", "3")


def test_stored_report_knows_its_age(spark, tmp_path):
    path = str(tmp_path / "report")
    rep = spark.createDataFrame([("v", "OK")], "view string, status string")
    q.materialise_report(rep, path, datetime(2026, 1, 1, 10))
    q.materialise_report(rep, path, datetime(2026, 1, 1, 11))
    r = q.read_report(spark.read.parquet(path), 600, datetime(2026, 1, 1, 11, 5)).collect()
    assert [(x.age_seconds, x.stale) for x in r] == [(300.0, False)]


def test_lineage_marks_the_second_visit(spark):
    e = ln.edges(spark)
    r = ln.trace(e, "derived_factor_model").orderBy("visit").collect()
    seen = [(x.view, x.repeated) for x in r]
    assert seen[0] == ("derived_factor_model", False)
    assert [s for s in seen if s[0] == "nse_bhavcopy"] == [("nse_bhavcopy", False), ("nse_bhavcopy", True), ("nse_bhavcopy", True)]
    assert ("bse_scrip_master", False) in seen and not any(x.truncated for x in r)


def test_lineage_broadcasts_no_edges(spark):
    traced = ln.trace(ln.edges(spark), "derived_factor_model")
    assert "SortMergeJoin" in traced._jdf.queryExecution().executedPlan().toString()


def test_lineage_stops_in_a_cycle_and_at_depth(spark):
    loop = ln.edges(spark, {"a": ("b",), "b": ("a",)})
    assert [(x.view, x.repeated) for x in ln.trace(loop, "a").orderBy("visit").collect()] == [("a", False), ("b", False), ("a", True)]
    deep = ln.edges(spark, {f"n{i}": (f"n{i + 1}",) for i in range(12)})
    r = ln.trace(deep, "n0", 6).collect()
    assert max(x.depth for x in r) == 7 and [x.view for x in r if x.truncated] == ["n7"]


def test_many_paths_are_one_visit_each(spark):
    """Thirty diamonds in a row: 2 ** 30 paths, 91 views."""
    up = {}
    for i in range(30):
        up[f"n{i}"] = (f"l{i}", f"r{i}")
        up[f"l{i}"] = up[f"r{i}"] = (f"n{i + 1}",)
    r = ln.trace(ln.edges(spark, up), "n0").collect()
    assert len(r) == 1 + 120 and sum(x.repeated for x in r) == 30 and max(x.depth for x in r) == 60
    assert {x.view for x in r if x.repeated} == {f"n{i}" for i in range(1, 31)}


def test_a_deep_first_visit_closes_a_later_short_one(spark):
    up = {"r": ("a", "x"), "a": ("b",), "b": ("x",), "x": ("y",)}
    r = [(x.view, x.depth, x.repeated, x.truncated) for x in ln.trace(ln.edges(spark, up), "r", 2).orderBy("visit").collect()]
    assert r == [("r", 0, False, False), ("a", 1, False, False), ("b", 2, False, False), ("x", 3, False, True), ("x", 1, True, False)]


def test_repeated_view_is_not_opened_again(spark):
    e = ln.edges(spark, {"r": ("a", "b"), "a": ("c",), "b": ("a",), "c": ("d",)})
    r = [(x.view, x.depth, x.repeated) for x in ln.trace(e, "r").orderBy("visit").collect()]
    assert r == [("r", 0, False), ("a", 1, False), ("c", 2, False), ("d", 3, False), ("b", 1, False), ("a", 2, True)]


def test_raw_links_fall_back_to_the_name(spark):
    r = {(x.view, x.raw_dataset) for x in ln.raw_links(spark, ["noaa_oni", "derived_x"]).collect()}
    assert ("noaa_oni", "noaa/oni") in r and ("sec_13d_filings", "sec/13d") in r and not any(v == "derived_x" for v, _ in r)
