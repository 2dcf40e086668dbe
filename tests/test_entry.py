"""Every registered query runs on the smallest tables, and equals its oracle where there is one."""

import math
import os

import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")
FOLDER = "/root/testdata/sf0.001"
HEAVY = {"pipeline"}
NAMES = sorted(n for n in entry.queries() if n not in HEAVY and not n.startswith("op"))

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: None if isinstance(v, float) and math.isnan(v) else round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else v
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_oracle(spark, name):
    got = entry.queries()[name](spark, FOLDER)
    found = rows(got.columns, [tuple(r) for r in got.collect()])
    if name in entry.oracle_sql():
        con = duckdb.connect()
        for file in os.listdir(FOLDER):
            con.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM read_parquet('{FOLDER}/{file}')")
        answer = con.execute(entry.oracle_sql()[name])
        columns = [c[0] for c in answer.description]
        assert found == rows(columns, answer.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() >= 0
