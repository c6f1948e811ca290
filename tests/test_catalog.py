"""Every query against its SQL, as DuckDB runs it, on the smallest tables."""

import duckdb
import pytest

from meridian.plans import catalog

from .conftest import SF

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    if v is None or v != v:
        return "null"
    if isinstance(v, bool):
        return str(v)
    return repr(round(float(v), 6)) if isinstance(v, int | float) else str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", [k for k in catalog.QUERIES if k in catalog.SQL])
def test_same_rows(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    got = rows_of(df.columns, df.collect())
    want = duck.execute(catalog.SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(df.columns)
    assert got == rows_of(names, want.fetchall())


@pytest.mark.parametrize("name", [k for k in catalog.QUERIES if k not in catalog.SQL])
def test_runs(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and catalog.FLAGSHIP in e.queries()
    assert e.entry(spark).count() > 0


def test_online_clusters_are_leaders(spark):
    """The clusters of the catalogue's stories, by walking them one by one."""
    from meridian.plans import composite as P

    stories = [r for r in P._stories(spark, SF).select("story_id", "published", "country").collect()]
    pairs = {}
    for r in P.alg03_candidate_pairs(spark, SF).collect():
        if (r.km if r.km is not None else 999) <= 20 and r.overlap >= 0.2 or r.shared is not None:
            pairs.setdefault(r.story_id, set()).add(r.founder_id)
    key = {r.story_id: (r.published, r.story_id) for r in stories}
    founders, want = set(), {}
    for s in sorted(key, key=key.get):
        mine = sorted((f for f in pairs.get(s, ()) if f in founders), key=key.get)
        want[s] = mine[0] if mine else None
        if not mine:
            founders.add(s)
    got = {r.story_id: r.compared_to for r in P.alg03_online_cluster(spark, SF).collect()}
    assert got == want and any(want.values())
