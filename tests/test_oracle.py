"""Spark vs the DuckDB oracle on the sf0.001 test tables, every key of the dossier."""

import pytest

duckdb = pytest.importorskip("duckdb")

from tools.compare_oracle import TABLES, digest  # noqa: E402
from __spark_entry__ import oracle_sql, queries  # noqa: E402
from orderflow.plans.dossier import QUERY_KEYS  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("key", QUERY_KEYS)
def test_matches_oracle(spark, con, key):
    sdf = queries()[key](spark, SF)
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.execute(oracle_sql()[key])
    d_cols = [x[0] for x in rel.description]
    d_rows = rel.fetchall()
    assert sorted(sdf.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert digest(sdf.columns, s_rows)[0] == digest(d_cols, d_rows)[0]


def test_entry_runs(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0
    assert "pct_QuantiteReceptionPiece_cum" in df.columns
