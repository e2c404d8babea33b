"""Registered queries against their SQL in DuckDB, on the smallest tables; some of each family to keep it short."""

import os

import pytest

from lociframe.plans import registry

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
NAMED = ["j04_count", "j05_coverage", "j10_annotate2", "r24_union", "sc01_counts", "sc03_peaks_control", "h04_filter", "h08_track", "c17_scores", "c20_domains", "v07_cluster", "m19_del", "a05_differential", "f02_clip", "f04_split", "r20_shuffle_bases", "io25_skip", "q05_filtered_matrix"]
#: These and every sixth of all others.
SOME = sorted({*NAMED, *sorted(registry.ORACLE_SQL)[::6]})


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    return c


def plain(rows):
    one = lambda v: f"{v:.6g}" if isinstance(v, float) else str(v)
    return sorted(tuple(map(one, r)) for r in rows)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
@pytest.mark.parametrize("name", SOME)
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    cur = duck.execute(registry.ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = [tuple(r[names.index(c)] for c in cols) for r in cur.fetchall()]
    assert plain(tuple(r) for r in df.select(*[f"`{c}`" for c in cols]).collect()) == plain(want)


def test_sql_is_for_queries():
    assert set(registry.ORACLE_SQL) <= set(registry.QUERIES)
