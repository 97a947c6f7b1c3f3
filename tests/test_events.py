from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import events as ev
from tidemark.operators import insider as ins

TX = ("issuer_cik long, issuer_name string, ticker string, owner_cik long, role string, trans_date date, filed date, accn string, shares double, "
      "price_per_share double, value_usd double, is_open_market_buy boolean, is_common_stock boolean")


def tx(spark, rows):
    return spark.createDataFrame([(1, "TKO", "TKO", o, role, d, f, a, s, p, s * p, True, True) for o, role, d, f, a, s, p in rows], TX)


D = date(2026, 3, 2)


def test_one_trade_from_two_filers_counts_once(spark):
    t = tx(spark, [(10, "director", D, D + timedelta(1), "a", 1_579_080.0, 158.32), (11, "tenpercentowner", D, D + timedelta(2), "b", 1_579_080.0, 158.32),
                   (12, "officer", D + timedelta(3), D + timedelta(4), "c", 1_052.0, 158.32 * 1.0)])
    r = ins.cluster_buys(t).collect()
    assert len(r) == 1 and r[0].n_insiders == 2 and r[0].n_directors == 1 and r[0].n_officers == 1
    assert r[0].total_value_usd == pytest.approx(1_579_080 * 158.32 + 1_052 * 158.32)


def test_golden_total(spark):
    t = tx(spark, [(10, "director", D, D, "a", 1_579_080.0, 158.32), (11, "other", D, D, "b", 1_579_080.0, 158.32), (12, "officer", D + timedelta(1), D, "c", 1.0, 166252.4)])
    assert round(ins.cluster_buys(t).first().total_value_usd) == 250_166_198


def test_one_owner_or_distant_trades_are_no_cluster(spark):
    assert ins.cluster_buys(tx(spark, [(10, "officer", D + timedelta(i), D, str(i), 1000.0 + i, 100.0) for i in range(5)])).count() == 0
    assert ins.cluster_buys(tx(spark, [(10, "officer", D, D, "a", 1000.0, 100.0), (11, "officer", D + timedelta(31), D, "b", 1000.0, 100.0)])).count() == 0
    assert ins.cluster_buys(tx(spark, [(10, "officer", D, D, "a", 1000.0, 100.0), (11, "officer", D + timedelta(30), D, "b", 1000.0, 100.0)])).count() == 1


def test_clusters_equal_brute_force_with_a_hot_issuer(spark):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(900):
        issuer = 1 if i % 3 == 0 else int(rng.integers(2, 12))
        rows.append((issuer, f"I{issuer}", "T", int(rng.integers(0, 25)) if i % 50 else None, ["officer", "director", "other"][int(rng.integers(0, 3))],
                     D + timedelta(int(rng.integers(0, 200))), D + timedelta(int(rng.integers(0, 300))), str(i), float(rng.integers(400, 900)), 150.0))
    pdf = pd.DataFrame(rows, columns=["issuer_cik", "issuer_name", "ticker", "owner_cik", "role", "trans_date", "filed", "accn", "shares", "price_per_share"])
    full = [(*r, r[8] * 150.0, True, True) for r in rows]
    df = spark.createDataFrame([(*r[:4], *r[4:10], r[10], r[11], r[12]) for r in full], TX)
    got = {x.issuer_cik: (x.window_start, x.n_insiders, x.n_transactions, round(x.total_value_usd), x.n_officers, x.n_directors, x.first_filed)
           for x in ins.cluster_buys(df, window_days=4, min_insiders=3, min_value=60_000).collect()}
    pdf["v"] = pdf.shares * 150.0
    pdf = pdf[pdf.v >= 60_000].sort_values(["filed", "accn"]).drop_duplicates(["issuer_cik", "trans_date", "shares", "price_per_share"])
    want = {}
    for issuer, g in pdf.groupby("issuer_cik"):
        for d in sorted(set(g.trans_date)):
            w = g[(g.trans_date >= d) & (g.trans_date <= d + timedelta(4))]
            if w.owner_cik.nunique() >= 3:
                want[issuer] = (d, w.owner_cik.nunique(), len(w), round(w.v.sum()), w[w.role == "officer"].owner_cik.nunique(), w[w.role == "director"].owner_cik.nunique(), w.filed.min())
                break
    assert got == want and len(got) > 5


def test_joint_filing_does_not_multiply_trades(spark):
    trans = spark.createDataFrame([("a", "Common", "P", "A", "10", "5", None, "D", "1", "02-MAR-2026"), ("a", "Preferred", "X", "A", "x", "5", None, "D", "2", "bad")],
                                  "ACCESSION_NUMBER string, SECURITY_TITLE string, TRANS_CODE string, TRANS_ACQUIRED_DISP_CD string, TRANS_SHARES string, TRANS_PRICEPERSHARE string, SHRS_OWND_FOLWNG_TRANS string, DIRECT_INDIRECT_OWNERSHIP string, NONDERIV_TRANS_SK string, TRANS_DATE string")
    subs = spark.createDataFrame([("a", "4", "77", "Iss", "T", "05-MAR-2026", "true")], "ACCESSION_NUMBER string, DOCUMENT_TYPE string, ISSUERCIK string, ISSUERNAME string, ISSUERTRADINGSYMBOL string, FILING_DATE string, AFF10B5ONE string")
    own = spark.createDataFrame([("a", f"000{i}", "N", "Director,Officer" if i == 1 else "TenPercentOwner", "T") for i in (3, 1, 2)], "ACCESSION_NUMBER string, RPTOWNERCIK string, RPTOWNERNAME string, RPTOWNER_RELATIONSHIP string, RPTOWNER_TITLE string")
    r = ins.insider_transactions(trans, subs, own, "2026Q1").orderBy("trans_sk").collect()
    assert len(r) == 2 and r[0].owner_cik == 1 and r[0].n_owners_on_filing == 3 and r[0].role == "officer"
    assert (r[0].value_usd, r[0].days_to_file, r[0].plan_10b5_1, r[0].is_open_market_buy, r[0].is_common_stock) == (50.0, 3, True, True, True)
    assert (r[1].shares, r[1].trans_date, r[1].trans_desc, r[1].is_common_stock) == (None, None, "option expiration/exercise", False)


def test_signed_notionals_and_anomaly(spark):
    deals = spark.createDataFrame([("A", D, "BUY", "100000", "461.9"), ("B", D, "sell", "50000", "463.7"), ("B", D, "other", "1", "1")], "symbol string, deal_date date, side string, quantity string, price string")
    r = {x.symbol: x.net_notional for x in ev.daily_net_notional(deals, None).collect()}
    assert r == pytest.approx({"A": 46_190_000.0, "B": -23_185_000.0})
    one = {x.symbol: x.notional_zscore for x in ev.deal_anomaly(ev.daily_net_notional(deals)).collect()}
    assert one == {"A": None, "B": None}
    flat = spark.createDataFrame([("A", D + timedelta(i), 5.0) for i in range(3)], "symbol string, deal_date date, net_notional double")
    assert ev.deal_anomaly(flat).first().notional_zscore == 0.0


def test_zero_against_a_side_diverges(spark):
    p = spark.createDataFrame([(D, "FII", 5, 5), (D, "DII", 9, 1)], "trade_date date, client_type string, total_long long, total_short long")
    r = ev.client_divergence(p).first()
    assert (r.fii_direction, r.dii_direction, r.divergence_flag) == (0, 1, True)


def test_source_divergence_floor_and_threshold(spark):
    a = spark.createDataFrame([(D, 0, 1000)], "trade_date date, `Future Index Long` long, `Future Index Short` long")
    b = spark.createDataFrame([(D, "NSE_FO|INDEX_FUTURES", 0, 1011)], "trade_date date, segment string, total_long_contracts long, total_short_contracts long")
    m = {k: v for k, v in ev.POSITION_METRICS.items() if k.startswith("index_futures")}
    r = {x.metric: (x.pct_diff, x.diverges) for x in ev.source_divergence(a, b, m).collect()}
    assert r["index_futures_long"] == (0.0, False) and r["index_futures_short"][1] is True


def test_material_events_do_not_multiply_with_vintages(spark):
    ann = spark.createDataFrame([("n1", 5, "Co", "Credit Rating", "h", "2026-08-20 10:00:00", "2026-08-20", "1"), ("n1", 5, "Co", "Credit Rating", "h2", "2026-08-20 10:00:00", "2026-08-20", "2"),
                                 ("n2", 6, "Co", "AGM", "h", "2026-08-20 11:00:00", "2026-08-20", "1"), ("n3", 6, "Co", "Credit Rating", "old", "2026-08-01 11:00:00", "2026-08-20", "1")],
                                "NEWSID string, SCRIP_CD long, company_name string, subcatname string, headline string, news_dt string, knowledge_date string, _vintage_id string").withColumn("news_dt", F.to_timestamp("news_dt"))
    mas = spark.createDataFrame([("5", "IN5", "Co Ltd", f"2026-08-0{i}", str(i)) for i in (1, 2, 3)], "SCRIP_CD string, ISIN_NUMBER string, Scrip_Name string, knowledge_date string, _vintage_id string")
    r = ev.material_events(ann, mas).collect()
    assert [(x.NEWSID, x.headline, x.ISIN_NUMBER) for x in r] == [("n1", "h2", "IN5")]
