"""Every registered query equals its DuckDB oracle (small scale factor)."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "scripts"))

import __spark_entry__ as entry_mod  # noqa: E402
from check_oracles import TABLES, _digest  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["run", "batch_no", "total_batches", "file_name", "n_rows", "batch_tokens", "n_copies"]


def test_every_query_has_an_oracle():
    assert set(entry_mod._QUERIES) == set(entry_mod._ORACLES)


@pytest.mark.parametrize("name", sorted(entry_mod._QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry_mod.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(entry_mod.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    sc, sh, _ = _digest(df.columns, srows)
    oc, oh, _ = _digest(ocols, orows)
    assert sc == oc
    assert len(srows) == len(orows)
    assert sh == oh
