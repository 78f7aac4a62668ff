"""Registered queries against their SQL at the smallest scale.

Every query runs, with keys cut into segments.
`tools/run.sh` does the same at any scale.
"""

import glob
import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

import __spark_entry__ as entry  # noqa: E402
from compare import digest  # noqa: E402

DIR = "/root/testdata/sf0.001"
NAMES = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in glob.glob(f"{DIR}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


@pytest.mark.skipif(not os.path.isdir(DIR), reason="driver tables are not here")
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, split_keys, con, name):
    df = entry.queries()[name](spark, DIR)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    got, want = digest(df.columns, rows)[1], digest(cols, cur.fetchall())[1]
    assert got == want


@pytest.mark.skipif(not os.path.isdir(DIR), reason="driver tables are not here")
def test_flagship(spark):
    out = entry.entry(spark)
    assert out.columns == ["stratum", "clips", "passed", "failed", "pass_rate", "quarantined"] and out.count() > 0
