"""The registered queries: whole, shaped as promised, equal to their SQL."""

import datetime as dt
import math
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry  # noqa: E402

COLUMNS = {
    "p1_found": {"snapshot_date", "natural_key", "change_kind"}, "p2_found": {"id"}, "p3_found": {"row_id"}, "p4_found": {"table_name", "record_key"}, "p5_found": {"natural_key_a", "natural_key_b"},
    "p6_found": {"organization_id", "target_date"}, "p7_found": {"natural_key"}, "p8_ids": {"doc_id", "ids"}, "p10_found": {"doc_id"},
}


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, bool) or isinstance(v, str):
        return v
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return round(float(v), 6)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test data")
    for f in os.listdir(folder):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{folder}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, data, duck, name):
    df = entry.queries()[name](spark, data)
    rows = df.collect()
    if name in COLUMNS:
        assert set(df.columns) == COLUMNS[name]
    if name in entry.oracle_sql():
        got = duck.execute(entry.oracle_sql()[name])
        columns = [c[0] for c in got.description]
        assert sorted(columns) == sorted(df.columns)
        order = sorted(columns)
        key = lambda r: tuple((x is not None, str(x)) for x in r)
        want = sorted((tuple(plain(r[columns.index(c)]) for c in order) for r in got.fetchall()), key=key)
        assert sorted((tuple(plain(r[c]) for c in order) for r in rows), key=key) == want


def test_entry(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    if os.path.isdir("/root/testdata/sf0.001"):
        assert entry.entry(spark).count() > 0


def test_core_needs_no_llm():
    import subprocess

    code = "import sys; sys.modules['noticeflow.llm'] = None; import __spark_entry__ as e; q = e.queries(); assert 'p1_found' in q and 'p8_ids' not in q; assert set(e.oracle_sql()) <= set(q)"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    assert subprocess.run([sys.executable, "-c", code], cwd=root).returncode == 0
