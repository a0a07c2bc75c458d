"""Every registered query against its oracle, over the smallest tables."""

import duckdb
import pytest

from gristmill.plans import corpus, registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def plain(v):
    if isinstance(v, float):
        return round(v, 5) + 0.0
    return v if isinstance(v, (str, bool, type(None))) else float(v) if hasattr(v, "__float__") else str(v)


QUERIES, ORACLE_SQL = registry.QUERIES | corpus.QUERIES, registry.ORACLE_SQL | corpus.ORACLE_SQL


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, SF)
    rows = [tuple(plain(r[c]) for c in sorted(got.columns)) for r in got.collect()]
    assert rows
    if name in ORACLE_SQL:
        cur = con.execute(ORACLE_SQL[name])
        cols = [x[0] for x in cur.description]
        want = [tuple(plain(dict(zip(cols, r, strict=True))[c]) for c in sorted(cols)) for r in cur.fetchall()]
        assert sorted(got.columns) == sorted(cols)
        key = lambda r: tuple(map(str, r))
        assert sorted(rows, key=key) == sorted(want, key=key)
