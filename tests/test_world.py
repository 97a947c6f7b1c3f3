from datetime import date, timedelta

import numpy as np
import pytest

from tidemark.operators import monsoon as mo
from tidemark.operators import supply_chain as sc

TRANSIT = "date date, portname string, n_total double, n_tanker double, n_cargo double, capacity double"


def series(port, levels, start=date(2026, 1, 1), wobble=0.5, amplitude=0.0):
    rows, d = [], start
    for level, days in levels:
        for _ in range(days):
            v = level + (wobble if (d - start).days % 2 else -wobble) + amplitude * np.sin(2 * np.pi * d.timetuple().tm_yday / 365.25)
            rows.append((d, port, float(v), float(v / 2), float(v / 4), float(v * 10)))
            d += timedelta(1)
    return rows


def panel(spark, *parts):
    return spark.createDataFrame([r for p in parts for r in p], TRANSIT)


def test_collapse_reads_against_the_baseline_before_it(spark):
    r = {x.metric: x for x in sc.deviation(panel(spark, series("Suez Canal", [(80, 186), (40, 14)]))).collect()}
    assert (r["n_total"].baseline_mean, r["n_total"].recent_mean) == (80.0, 40.0) and r["n_total"].zscore < -5 and r["n_total"].pct_change == -50.0
    flat = {x.metric: x.zscore for x in sc.deviation(panel(spark, series("S", [(80, 200)], wobble=0.0))).collect()}
    assert set(flat.values()) == {None}
    assert sc.deviation(panel(spark, series("S", [(80, 30)]))).count() == 0


def test_reroute_readings(spark):
    p = panel(spark, series("Bab el-Mandeb Strait", [(77.3, 186), (31.4, 14)]), series("Cape of Good Hope", [(49.3, 186), (95.5, 14)]),
              series("Strait of Hormuz", [(78.3, 186), (3.2, 14)]), series("Panama Canal", [(30, 186), (35, 14)]), series("Magellan Strait", [(5, 186), (5, 14)]))
    r = {x.corridor: x for x in sc.reroute_balance(sc.deviation(p)).collect()}
    assert r["Bab el-Mandeb Strait"].absorbed_pct > 90 and r["Bab el-Mandeb Strait"].interpretation == "rerouted"
    assert r["Strait of Hormuz"].interpretation == "no_substitute_route" and r["Strait of Hormuz"].absorbed_pct is None
    assert r["Panama Canal"].interpretation == "corridor_not_falling" and "Suez Canal" not in r


def test_break_is_dated(spark):
    b = sc.regime_breaks(panel(spark, series("S", [(80, 200), (10, 200)], start=date(2022, 1, 1)))).collect()
    assert [(x.break_date, x.pct_change) for x in b] == [(date(2022, 7, 20), -87.5)]


def test_season_alone_is_no_break_and_does_not_hide_one(spark):
    assert sc.regime_breaks(panel(spark, series("S", [(80, 1461)], start=date(2022, 1, 1), amplitude=25.0))).count() == 0
    b = sc.regime_breaks(panel(spark, series("S", [(80, 730), (12, 731)], start=date(2022, 1, 1), amplitude=25.0))).collect()
    big = max(b, key=lambda x: abs(x.change_per_day))
    assert big.break_date == date(2024, 1, 1) and big.pct_change < -70


def test_second_break_is_measured_against_the_first_regime(spark):
    p = panel(spark, series("S", [(90, 400), (8, 300), (4.5, 300)]), series("Q", [(50, 300)]))
    r = {x.portname: x for x in sc.current_regime(p, sc.regime_breaks(p)).collect()}
    assert r["S"].baseline_mean == pytest.approx(90, abs=0.5) and r["S"].vs_baseline_pct < -90 and r["S"].regime_vs_previous_pct > -60
    assert r["Q"].previous_regime_mean is None and r["Q"].regime_start == date(2026, 1, 1) and r["Q"].vs_baseline_pct == 0.0


def rain(spark, years, per_day, days=range(122), region="all_india"):
    rows = [(date(y, 6, 1) + timedelta(d), region, float(per_day)) for y in years for d in days]
    return spark.createDataFrame(rows, "date date, region string, rain_mm_per_day double")


def test_normals_and_truncated_window(spark):
    r = rain(spark, range(1991, 2021), 5.0)
    n = mo.normals(mo.season_sums(r)).first()
    assert (n.normal_mm, n.n_years, n.normal_sd) == (610.0, 30, 0.0)
    assert mo.normals(mo.season_sums(r, 7, 1)).first().normal_mm == 155.0


def test_bias_drops_a_sparse_year(spark):
    main = rain(spark, (2023, 2024), 4.0)
    other = rain(spark, (2023,), 4.8).unionByName(rain(spark, (2024,), 40.0, range(30)))
    b = mo.instrument_bias(mo.season_sums(other), mo.season_sums(main), (2023, 2024, 2025)).first()
    assert (b.ratio, b.n_years, b.overlap_years) == (1.2, 1, "2023")


def test_departure_is_corrected_or_refused(spark):
    hist = rain(spark, range(1991, 2021), 4.0).unionByName(rain(spark, (2023,), 4.0))
    other = rain(spark, (2023, 2026), 5.0)
    d = mo.departure(hist, other, (2023,)).first()
    assert (d.basis, d.cpc_imd_ratio, d.departure_pct, d.season_year) == ("cpc_bias_corrected_to_imd", 1.25, 0.0, 2026)
    d = mo.departure(hist, rain(spark, (2026,), 5.0), (2024,)).first()
    assert (d.basis, d.departure_pct, d.sigma, d.observed_mm) == ("cpc_uncorrected", None, None, 610.0)
    d = mo.departure(hist.unionByName(rain(spark, (2026,), 4.4)), other, (2023,)).first()
    assert (d.basis, d.departure_pct, d.cpc_imd_ratio) == ("imd", 10.0, 1.0)


def test_progress_reports_coverage(spark):
    p = mo.progress(rain(spark, (2026,), 2.0, [0, 1, 2, 9])).first()
    assert (p.cumulative_mm, p.days_observed, p.season_days_elapsed, p.coverage_pct) == (8.0, 4, 10, 40.0)


def test_enso_trajectory_and_base_rate(spark):
    names = ["DJF", "JFM", "FMA", "MAM", "AMJ", "MJJ"]
    rows = [(n, y, a, f"{y}-{i + 1:02d}", "el_nino" if a >= 0.5 else "neutral") for y, base in ((2024, 0.6), (2025, 0.0)) for i, n in enumerate(names) for a in [base + 0.1 * i]]
    e = mo.enso_state(spark.createDataFrame(rows, "season string, year int, anomaly_c double, period string, phase string")).first()
    assert (e.as_of_season, e.as_of_year, e.anomaly_change_6_seasons, e.trajectory) == ("MJJ", 2025, 0.5, "strengthening")
    assert (e.is_leading_monsoon_season, e.prior_years_same_season, e.prior_el_nino_share) == (True, 1, 1.0)
