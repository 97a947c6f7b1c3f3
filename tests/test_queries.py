import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parent.parent
DATA = Path("/root/testdata/sf0.001")
SAMPLE = ("asof_latest_per", "capm_beta", "factor_model", "discover_filings", "restatements", "statement_balance", "transit_deviation", "season_departure", "detect_revisions",
          "rating_board", "shape_settlements", "entity_totals", "live_last_value")


def test_registry_needs_no_session_and_is_consistent():
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q) and len(q) > 190 and len(o) > 190"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


@pytest.mark.skipif(not DATA.exists(), reason="driver tables are not here")
@pytest.mark.parametrize("name", SAMPLE)
def test_query_agrees_with_its_sql(spark, name):
    sys.path.insert(0, str(ROOT / "tools"))
    import check

    con = duckdb.connect()
    for t in check.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = entry.queries()[name](spark, str(DATA))
    cur = con.execute(entry.oracle_sql()[name])
    want = check.rows_of([d[0] for d in cur.description], cur.fetchall())
    assert check.rows_of(df.columns, [tuple(r) for r in df.collect()]) == want


@pytest.mark.skipif(not DATA.exists(), reason="driver tables are not here")
def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["symbol", "as_of_date", "momentum_zscore", "size_score", "low_vol_score", "composite_score"] and df.count() > 0
