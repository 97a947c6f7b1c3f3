from datetime import date, timedelta
from functools import partial
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions import mackinnon
from tidemark.functions.mackinnon import engle_granger, engle_granger_pvalue
from tidemark.functions.scalar import exact_quantile
from tidemark.operators import correlation as corr
from tidemark.operators import cross_asset as ca
from tidemark.operators import digest as dg
from tidemark.operators import prices as px
from tidemark.operators.outliers import multivariate_outliers

DAYS = [date(2026, 1, 1) + timedelta(days=i) for i in range(101)]


def panel(spark, returns: dict[str, np.ndarray]):
    rows = []
    for s, r in returns.items():
        p = 100 * np.exp(np.concatenate([[0.0], np.cumsum(r)]))
        rows += [(s, d, float(v)) for d, v in zip(DAYS, p) if np.isfinite(v)]
    return spark.createDataFrame(rows, "symbol string, trade_date date, close double")


def test_beta_of_a_known_slope_and_of_the_same_series(spark):
    rng = np.random.default_rng(42)
    m = rng.normal(0, 0.01, 100)
    p = panel(spark, {"MKT": m, "A": 1.3 * m + rng.normal(0, 0.002, 100), "SAME": m, "FLAT": np.zeros(100)})
    r = {x.symbol: x for x in px.compute_betas(p, "MKT").collect()}
    assert abs(r["A"].beta - 1.3) < 0.15 and r["A"].n_obs == 100
    assert abs(r["SAME"].beta - 1) < 1e-9 and abs(r["SAME"].r_squared - 1) < 1e-9
    assert r["FLAT"].beta == pytest.approx(0, abs=1e-12) and r["FLAT"].r_squared == pytest.approx(0, abs=1e-9)
    with pytest.raises(RuntimeError, match="too few"):
        px.compute_betas(p.where("symbol <> 'MKT'"), "MKT", strict=True)


def test_correlation_equals_pandas_pairwise(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(0, 0.01, 100)
    rets = {f"S{i}": base * (i % 3) + rng.normal(0, 0.01, 100) for i in range(9)}
    rets["FLAT"] = np.zeros(100)
    p = panel(spark, rets)
    p = p.where(~((F.col("symbol") == "S4") & (F.dayofmonth("trade_date") % 3 == 0)))          # gaps
    p = p.where(~((F.col("symbol") == "S5") & (F.col("trade_date") < DAYS[85])))               # too short
    got = {(x.symbol_a, x.symbol_b): (x.correlation, x.n_obs) for x in corr.rolling_correlation(p, 60, 20, block=3).collect()}
    pdf = p.toPandas().sort_values(["symbol", "trade_date"])
    pdf["r"] = pdf.groupby("symbol")["close"].transform(lambda s: np.log(s / s.shift(1)))
    wide = pdf.pivot(index="trade_date", columns="symbol", values="r").tail(60)
    wide = wide[wide.columns[wide.count() >= 20]].drop(columns="FLAT")
    want = wide.corr(min_periods=20)
    n = wide.count()
    expected = {(a, b): (want.loc[a, b], min(n[a], n[b])) for i, a in enumerate(want) for b in list(want)[i + 1:] if pd.notna(want.loc[a, b])}
    assert got.keys() == expected.keys() and len(got) == 28
    for k, (rho, obs) in expected.items():
        assert got[k][0] == pytest.approx(rho, abs=1e-10) and got[k][1] == obs


def market(spark, symbols: int = 40):
    """Symbols of three strengths around one factor, some with gaps, one flat and one a mirror image."""
    rng = np.random.default_rng(7)
    base = rng.normal(0, 0.01, 100)
    rets = {f"S{i}": base * (i % 3) + rng.normal(0, 0.01, 100) for i in range(symbols)}
    rets |= {"FLAT": np.full(100, 0.01), "MIRROR": -rets["S2"]}
    p = panel(spark, rets)
    return p.where(~(F.col("symbol").isin("S4", "S5", "S11") & (F.dayofmonth("trade_date") % 3 == 0)))


@pytest.mark.parametrize("block", [7, 256])
@pytest.mark.parametrize("at_least", [0.0, 0.5, 0.7])
def test_thresholded_correlation_is_the_full_one_over_the_threshold(spark, at_least, block):
    p = market(spark)
    key = lambda x: (x.symbol_a, x.symbol_b, round(x.correlation, 10), x.n_obs, x.as_of_date)
    want = {key(x) for x in corr.rolling_correlation(p, block=block).where(F.abs("correlation") >= at_least).collect()}
    assert not any("FLAT" in x for x in want)
    got = {key(x) for x in corr.rolling_correlation(p, block=block, at_least=at_least).collect()}
    assert got == want and len(want) > 10
    assert any(x[2] < 0 for x in want)


def test_bound_dismisses_most_pairs_and_no_close_one():
    rng = np.random.default_rng(11)
    a, b = rng.normal(0, 1, (200, 60)), rng.normal(0, 1, (150, 60))
    b[:20] = a[:20] + rng.normal(0, 0.3, (20, 60))
    b[20] = 5.0
    i, j, rho = corr._close_pairs(a, b, 0.8)
    every = np.corrcoef(a, b[np.arange(150) != 20])[:200, 200:]
    assert len(i) == (np.abs(every) >= 0.8).sum() >= 15 and 20 not in j
    assert np.allclose(rho, np.corrcoef(a, b)[i, 200 + j])


@pytest.mark.parametrize("block", [7, 256])
def test_sector_sums_equal_the_mean_of_stored_pairs(spark, block):
    p = market(spark)
    rows = [(f"S{i}", ("steel", "power", None)[i % 3]) for i in range(30)] + [("S1", "metals"), ("MIRROR", "steel")]
    industry = spark.createDataFrame(rows, "symbol string, industry string")
    want = {(x.industry_a, x.industry_b): x.correlation for x in corr.sector_correlation(corr.rolling_correlation(p), industry).collect()}
    out = corr.rolling_sector_correlation(p, industry, block=block)
    got = {(x.industry_a, x.industry_b): x.correlation for x in out.collect()}
    assert got.keys() == want.keys() and len(got) >= 9
    assert all(got[k] == pytest.approx(want[k], abs=1e-10) for k in want)
    assert corr.rolling_sector_correlation(p.limit(0), industry).count() == 0


def test_symmetric_matrix_is_null_where_nothing_is_stored(spark):
    pairs = spark.createDataFrame([("A", "B", 0.5)], "symbol_a string, symbol_b string, correlation double")
    syms = spark.createDataFrame([("A",), ("B",), ("C",)], "symbol string")
    m = {(x.symbol_a, x.symbol_b): x.correlation for x in corr.symmetric_matrix(pairs, syms).collect()}
    assert len(m) == 9 and m["A", "B"] == m["B", "A"] == 0.5 and m["C", "C"] == 1.0 and m["A", "C"] is None


def test_cointegration_accepts_and_rejects():
    rng = np.random.default_rng(7)
    walk = np.cumsum(rng.normal(0, 1, 250)) + 100
    assert engle_granger_pvalue(walk * 2 + rng.normal(0, 0.5, 250), walk) < 0.01
    reject = [engle_granger_pvalue(np.cumsum(rng.normal(0, 1, 120)), np.cumsum(rng.normal(0, 1, 120))) for _ in range(40)]
    assert sum(p > 0.05 for p in reject) >= 32
    assert engle_granger_pvalue(walk * 3 + 1, walk) == 0.0


def least_squares(y, x):
    coef = np.linalg.lstsq(x, y, rcond=None)[0]
    return coef, y - x @ coef


def plain_statistic(y, x, lags=None):
    """One pair, one regression for each number of lags."""
    _, e = least_squares(y, np.column_stack([x, np.ones(len(x))]))
    d = np.diff(e)

    def design(k, start):
        rows = np.arange(start, len(d))
        return d[rows], np.column_stack([e[rows]] + [d[rows - j] for j in range(1, k + 1)])

    if lags is None:
        most = min(int(np.ceil(12 * (len(e) / 100) ** 0.25)), len(e) // 2 - 1)
        scores = []
        for k in range(most + 1):
            t, z = design(k, most)
            scores.append(len(t) * (np.log(2 * np.pi) + np.log(np.sum(least_squares(t, z)[1] ** 2) / len(t)) + 1) + 2 * (k + 1))
        lags = int(np.argmin(scores))
    t, z = design(lags, lags)
    coef, u = least_squares(t, z)
    return coef[0] / np.sqrt(u @ u / (len(t) - z.shape[1]) * np.linalg.inv(z.T @ z)[0, 0]), lags


@pytest.mark.parametrize("n", [20, 33, 60, 250])
@pytest.mark.parametrize("lags", [None, 0, 1, 4])
def test_many_pairs_at_once_equal_one_by_one(n, lags):
    rng = np.random.default_rng(n)
    x = np.cumsum(rng.normal(0, 1, (40, n)), axis=1) + 100
    y = np.where(np.arange(40)[:, None] % 2 == 0, np.cumsum(rng.normal(0, 1, (40, n)), axis=1), 2 * x + rng.normal(0, 1, (40, n)))
    t, used, p = engle_granger(y, x, lags)
    for i in range(40):
        want, k = plain_statistic(y[i], x[i], lags)
        assert used[i] == k and t[i] == pytest.approx(want, rel=1e-8) and 0 <= p[i] <= 1


def test_constant_and_collinear_pairs():
    x = np.arange(30.0) ** 1.5
    t, used, p = engle_granger(np.stack([np.full(30, 4.0), 3 * x + 1, np.sin(x)]), np.stack([x, x, np.full(30, 2.0)]))
    assert np.isnan(t[0]) and np.isnan(p[0]) and t[1] == -np.inf and p[1] == 0 and np.isfinite(t[2]) and list(used[:2]) == [-1, -1]


@pytest.mark.parametrize("lags", [1, None])
def test_only_ill_conditioned_pairs_are_solved_by_a_basis(monkeypatch, lags):
    """Products of columns serve most series; what they can't solve exactly enough goes through a basis of the columns."""
    rng = np.random.default_rng(5)
    e = rng.normal(0, 90, (3000, 60))
    e[:5] = (-1.0) ** np.arange(60) * (1 + 1e-6 * rng.normal(0, 1, (5, 60)))
    solved, fit = [], mackinnon._fit
    k = mackinnon._chosen_by_basis(e, 11)[0] if lags is None else np.full(3000, lags)
    want = np.array([fit(e[i:i + 1], int(k[i]))[0] for i in range(3000)])
    monkeypatch.setattr(mackinnon, "_fit", lambda e, k: (solved.append(len(e)), fit(e, k))[1])
    t, used = mackinnon.adf_statistics(e, lags)
    assert (used == k).all() and np.allclose(t, want, rtol=1e-8) and sum(solved) < 30
    assert solved or (k[:5] == 0).all()
    p = mackinnon.surface_pvalues(np.r_[t, np.nan, -np.inf, 5.0])
    assert np.allclose(p, [math.nan if math.isnan(v) else mackinnon.surface_pvalue(v) for v in [*t, math.nan, -math.inf, 5.0]], rtol=1e-12, equal_nan=True)


def test_a_bound_that_dismisses_few_pairs_is_not_followed_pair_by_pair(monkeypatch):
    rng = np.random.default_rng(12)
    a, b = rng.normal(0, 1, (120, 60)), rng.normal(0, 1, (90, 60))
    called, einsum = [], np.einsum
    monkeypatch.setattr(corr.np, "einsum", lambda *x, **y: (called.append(x[0]), einsum(*x, **y))[1])
    i, j, rho = corr._close_pairs(a, b, 0.2)
    every = np.corrcoef(a, b)[:120, 120:]
    assert not called and len(i) == (np.abs(every) >= 0.2).sum() > 500 and np.allclose(rho, every[i, j])


def test_pairs_screen_takes_joint_dates_only(spark):
    rng = np.random.default_rng(5)
    m = rng.normal(0, 0.01, 100)
    p = panel(spark, {"A": m, "B": m + rng.normal(0, 1e-3, 100), "C": m + rng.normal(0, 1e-3, 100)})
    gone = p.where(~((F.col("symbol") == "C") & F.col("trade_date").isin(DAYS[80], DAYS[91])))
    got = {(x.symbol_a, x.symbol_b): x for x in corr.pairs_screen(gone, corr.rolling_correlation(gone), 0.8).collect()}
    level = {}
    for r in gone.where(F.col("trade_date") >= sorted({r.trade_date for r in p.collect()})[-60]).collect():
        level.setdefault(r.symbol, {})[r.trade_date] = r.close
    assert len(got) == 3
    for (a, b), x in got.items():
        days = sorted(level[a].keys() & level[b].keys())
        want, k = plain_statistic(np.array([level[a][d] for d in days]), np.array([level[b][d] for d in days]))
        assert (x.n_obs, x.lags) == (len(days), k) and x.statistic == pytest.approx(want, rel=1e-7)
    with pytest.raises(ValueError):
        corr.pairs_screen(p, corr.rolling_correlation(p), min_obs=5, lags=3)


def test_pairs_screen_runs_only_on_the_shortlist(spark):
    rng = np.random.default_rng(3)
    m = rng.normal(0, 0.01, 100)
    p = panel(spark, {"A": m, "B": m + rng.normal(0, 1e-3, 100), "C": rng.normal(0, 0.01, 100)})
    out = corr.pairs_screen(p, corr.rolling_correlation(p), 0.8).collect()
    assert [(x.symbol_a, x.symbol_b, x.n_obs) for x in out] == [("A", "B", 60)] and 0 <= out[0].coint_pvalue <= 1


def test_pairs_are_screened_where_they_are_found(spark):
    """Symbols in several blocks, some with gaps: the same rows as by a join with the levels, and no join with pairs."""
    rng = np.random.default_rng(9)
    m = rng.normal(0, 0.01, 100)
    p = panel(spark, {f"S{i}": m * (i % 3 - 1) + rng.normal(0, 0.01, 100) for i in range(40)})
    p = p.where(~((F.col("symbol").isin("S7", "S12")) & F.col("trade_date").isin(DAYS[80], DAYS[91]))).localCheckpoint()
    find = partial(corr.rolling_correlation, p, block=6, at_least=0.2)
    for lags in (None, 1):
        joined, found = (corr.pairs_screen(p, x, 0.25, lags=lags) for x in (find(), find))
        got, want = ({(x.symbol_a, x.symbol_b): x for x in df.collect()} for df in (found, joined))
        assert got.keys() == want.keys() and len(got) > 100 and {x.n_obs for x in got.values()} == {58, 60}
        for k, x in got.items():
            assert (x.lags, x.n_obs, x.as_of_date) == (want[k].lags, want[k].n_obs, want[k].as_of_date)
            assert [x.correlation, x.statistic, x.coint_pvalue] == pytest.approx([want[k].correlation, want[k].statistic, want[k].coint_pvalue], rel=1e-9)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapGroupsInPandas" in plan and "MapInPandas" not in plan.replace("FlatMapGroupsInPandas", "")
    assert corr.pairs_screen(p, find, 0.25, shortlist=5).count() == 5


def test_momentum_needs_the_whole_lookback_and_flat_scores_zero(spark):
    p = panel(spark, {"A": np.full(100, 0.01), "B": np.full(100, 0.01)})
    assert {x.momentum_zscore for x in px.momentum_zscore(p).collect()} == {0.0}
    short = p.where(F.col("trade_date") < DAYS[10])
    assert px.momentum_zscore(short).count() == 0
    with pytest.raises(RuntimeError):
        px.momentum_zscore(short, strict=True)


def test_size_keeps_unmatched_symbols(spark):
    uni = spark.createDataFrame([("A", "I1", DAYS[0]), ("B", "I2", DAYS[0]), ("C", "I3", DAYS[0]), ("D", "I4", DAYS[0])], "symbol string, isin string, trade_date date")
    caps = spark.createDataFrame([("I1", "100"), ("I2", "10000"), ("I3", "")], "isin string, market_cap string")
    r = {x.symbol: x.size_score for x in px.size_factor(uni, caps).collect()}
    assert r["A"] == pytest.approx(2 ** -0.5) and r["B"] == pytest.approx(-(2 ** -0.5)) and r["C"] is None and r["D"] is None


def test_factor_model_clips_and_treats_missing_as_neutral(spark):
    m = spark.createDataFrame([("A", 9.0, DAYS[0]), ("B", 0.5, DAYS[0])], "symbol string, momentum_zscore double, as_of_date date")
    s = spark.createDataFrame([("A", 1.0)], "symbol string, size_score double")
    v = spark.createDataFrame([("A", 1.0)], "symbol string, low_vol_score double")
    assert {x.symbol: round(x.composite_score, 6) for x in px.factor_model(m, s, v).collect()} == {"A": 1.0, "B": 0.2}


def test_two_tiers_and_flag_text(spark):
    df = spark.createDataFrame([("TCS", 0.01), ("X", -0.9), ("Y", 0.5), ("Z", 0.1)], "symbol string, composite_score double")
    r = {(x.symbol, x.tier) for x in dg.two_tiers(df, 2).collect()}
    assert r == {("TCS", "watchlist"), ("X", "broad_scan"), ("Y", "broad_scan")}
    t = spark.createDataFrame([("a" * 116 + " bcdef",), ("short",), (None,)], "t string").select(dg.flag_text("t").alias("f"))
    assert [x.f for x in t.collect()] == ["a" * 116 + "...", "short", ""]


def test_constant_leg_is_skipped(spark):
    eq = spark.createDataFrame([(d, 100.0 + i % 7) for i, d in enumerate(DAYS)], "trade_date date, close double")
    legs = spark.createDataFrame([(leg, d, v) for i, d in enumerate(DAYS) for leg, v in (("moves", 50.0 + i % 5), ("flat", 3.0))], "leg string, trade_date date, value double")
    assert [x.asset_b for x in ca.equity_commodity_correlation(eq, legs, "NB", strict=True).collect()] == ["moves"]
    with pytest.raises(RuntimeError, match="no leg has 10 days"):
        ca.equity_commodity_correlation(eq, legs.where("leg <> 'moves'"), "NB", strict=True)


def test_monthly_change_spans_a_missing_month(spark):
    s = spark.createDataFrame([("r", date(2026, 1, 5), 5.0), ("r", date(2026, 1, 30), 6.0), ("r", date(2026, 3, 2), 6.25)], "leg string, day date, value double")
    m = ca.monthly_change(ca.monthly_last(s, ["leg"], "day", "value"), ["leg"], "value", "bps").collect()
    assert [(x.month_end, x.change) for x in m] == [(date(2026, 3, 31), 25.0)]


def test_exact_quantile_of_values_in_a_narrow_range(spark):
    """All values in one bucket of the first histogram, with ties, and far fewer buckets than values."""
    rng = np.random.default_rng(4)
    values = np.r_[0.25 + rng.random(3000) * 1e-12, np.full(500, 0.25), [-1e300, 1e300, 5.0]]
    df = spark.createDataFrame([(float(x),) for x in values], "v double").repartition(3)
    for q in (0.0, 0.0003, 0.1, 0.5, 0.77, 0.9999, 1.0):
        got = df.limit(1).select(exact_quantile(df, "v", q, -1.0, 1.0, 8).alias("q")).first().q
        assert got == pytest.approx(np.quantile(values, q), rel=1e-14)
    assert df.limit(1).select(exact_quantile(df.where("false"), "v", 0.5, 0.0, 1.0).alias("q")).first().q is None


def test_exact_quantile_equals_numpy(spark):
    rng = np.random.default_rng(5)
    v = np.concatenate([rng.normal(0, 1, 2000), np.zeros(500)])
    df = spark.createDataFrame([(float(x),) for x in v], "v double")
    for q in (0.0, 0.05, 0.5, 0.777, 1.0):
        got = df.limit(1).select(exact_quantile(df, "v", q, -1.0, 1.0, 64).alias("q")).first().q
        assert got == pytest.approx(np.quantile(v, q), abs=1e-12)


def test_outliers_find_the_injected_point(spark):
    rng = np.random.default_rng(0)
    rows = [(f"S{i}", *map(float, rng.normal(0, 1, 4))) for i in range(99)] + [("ODD", 9.0, 9.0, -9.0, 9.0)]
    df = spark.createDataFrame(rows, "symbol string, beta double, momentum_zscore double, notional_zscore double, change_pct_points double")
    a, b = (multivariate_outliers(df).orderBy("anomaly_score_raw").collect() for _ in range(2))
    assert a[0].symbol == "ODD" and a[0].is_outlier and sum(x.is_outlier for x in a) == 5
    assert [(x.symbol, x.anomaly_score_raw) for x in a] == [(x.symbol, x.anomaly_score_raw) for x in b]


def test_a_vector_travels_to_a_fixed_number_of_blocks(spark, monkeypatch):
    """Many symbols make large blocks, whose pairs are computed in parts; pairs and sums stay the same."""
    monkeypatch.setattr(corr, "BLOCKS", 3)
    rng = np.random.default_rng(11)
    rows = [(f"s{k}", date(2026, 1, 1) + timedelta(d), float(p)) for k in range(40) for d, p in enumerate(np.exp(rng.normal(0, 0.01, 30).cumsum()))
            if k % 4 or d % 9]
    panel = spark.createDataFrame(rows, "symbol string, trade_date date, close double")
    industry = spark.createDataFrame([(f"s{k}", "abc"[k % 3]) for k in range(40)] + [("s1", "a")], "symbol string, industry string")
    routed, _ = corr._routed(panel, 25, 10, None, 4, None)
    assert routed.count() == 40 * 3
    stored = corr.rolling_correlation(panel, 25, 10, block=4)
    whole = {(r.symbol_a, r.symbol_b): r.correlation for r in corr.rolling_correlation(panel, 25, 10).collect()}
    pairs = stored.collect()
    assert len(pairs) == len(whole) == 40 * 39 // 2 and all(abs(whole[r.symbol_a, r.symbol_b] - r.correlation) < 1e-12 for r in pairs)
    cells = {(r.industry_a, r.industry_b): r.correlation for r in corr.rolling_sector_correlation(panel, industry, 25, 10, block=4).collect()}
    for r in corr.sector_correlation(stored, industry).collect():
        assert abs(cells.pop((r.industry_a, r.industry_b)) - r.correlation) < 1e-12
    assert not cells
