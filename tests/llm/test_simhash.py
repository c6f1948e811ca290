import random

import duckdb
import numpy as np
import pandas as pd
import xxhash

from meridian.llm import components, queries, simhash, simhash_sql

from .fixtures import ODD, no_docs, odd_docs, sample_texts

SF = "/root/testdata/sf0.001"


def plain(text):
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def by_hand(ids, fps):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, (i, a) in enumerate(zip(ids, fps)):
        for j, b in zip(ids[:x], fps[:x]):
            if (a ^ b).bit_count() <= 3 and root(i) != root(j):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return {i: root(i) for i in ids}


def test_odd_rows(spark):
    rows = simhash.near_duplicates(odd_docs(spark)).collect()
    assert len(rows) == len(ODD)
    texts = {r[0]: r[1] for r in ODD}
    want = by_hand(sorted(texts), [plain(texts[k]) for k in sorted(texts)])
    for r in rows:
        assert int(r.fingerprint, 16) == plain(texts[r.doc_id]) and len(r.fingerprint) == 16
        assert r.component_id == want[r.doc_id]
    assert simhash.near_duplicates(no_docs(spark)).count() == 0
    nameless = simhash.near_duplicates(spark.createDataFrame([(None, "a b c d"), (7, "a b c d"), (None, "x y z w")], "doc_id long, text string"))
    assert sorted(str(r.component_id) for r in nameless.collect()) == ["7", "7", "None"]


def test_the_table(spark):
    texts = sample_texts()
    fps = [plain(t) for t in texts]
    want = by_hand(list(range(len(texts))), fps)
    got = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in queries.op6_simhash(spark, SF).collect()}
    assert got == {i: (fps[i], want[i]) for i in want}


def test_links_connect_what_is_near(spark, monkeypatch):
    rng = random.Random(3)
    fps = set()
    for _ in range(60):
        base = rng.getrandbits(64)
        fps.add(base)
        for _ in range(rng.randrange(0, 40)):
            x = base
            for b in rng.sample(range(64), rng.randrange(0, 6)):
                x ^= 1 << b
            fps.add(x)
    for _ in range(300):  # a dense group
        fps.add(sum(1 << b for b in rng.sample(range(64), 3)))
    fps = sorted(fps)
    ids = rng.sample(range(10_000), len(fps))
    order = np.argsort(ids)
    want = by_hand([ids[i] for i in order], [fps[i] for i in order])
    nodes = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)), i) for f, i in zip(fps, ids)], "fp long, node long")
    found = {r.node: r.component for r in components.components(simhash.links(nodes)).collect()}
    assert {i: found.get(i, i) for i in ids} == want
    a = np.array(fps, dtype=np.uint64)
    edges = []
    monkeypatch.setattr(simhash, "DIVIDE", 8)
    for t in range(7):
        key = a & (simhash._MASKS[t] | simhash._MASKS[(t + 1) % 7])
        order = np.argsort(key, kind="stable")
        edges += simhash._links(np.full(len(a), t), key[order].view(np.int64), a[order], np.array(ids)[order]).tolist()
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, y in edges:
        x, y = root(int(x)), root(int(y))
        parent[max(x, y)] = min(x, y)
    assert {i: root(i) for i in ids} == want


def test_a_large_bucket_is_divided():
    """20,000 prints with one key, in chains of near ones: few edges, and those that are needed."""
    rng = np.random.default_rng(6)
    fixed = np.uint64((1 << 19) - 1)
    base = rng.integers(0, 1 << 62, 10_000, dtype=np.uint64) & ~fixed
    fps = np.unique(np.concatenate([base, base ^ np.uint64(1 << 40 | 1 << 50)]))
    ids = np.arange(len(fps))
    edges = simhash._links(np.zeros(len(fps), dtype=np.int64), np.zeros(len(fps), dtype=np.int64), fps, ids)
    at = {int(f): i for i, f in enumerate(fps.tolist())}
    want = {tuple(sorted((i, at[int(f) ^ (1 << 40 | 1 << 50)]))) for f, i in at.items()}
    assert len(want) == 10_000 and want <= {tuple(sorted(e)) for e in edges.tolist()} and len(edges) < len(fps)


def rounds_of(monkeypatch):
    """Counts the tables that components() stores, two at least in each round."""
    stored = []

    def durable(df, keep=components.durable):
        stored.append(1)
        return keep(df)

    monkeypatch.setattr(components, "durable", durable)
    return stored


def test_a_chain_takes_a_logarithm_of_rounds(spark, monkeypatch):
    stored = rounds_of(monkeypatch)
    path = spark.range(2000).selectExpr("id AS a", "id + 1 AS b")
    rows = components.components(path).collect()
    assert len(rows) == 2001 and {r.component for r in rows} == {0}
    assert len(stored) <= 15 + 3  # 12 doublings of one round, its hooks, and the edges before and after
    names = random.Random(8).sample(range(10**6), 500)
    stored.clear()
    rows = components.components(spark.createDataFrame(list(zip(names, names[1:])), "a long, b long")).collect()
    assert len(rows) == 500 and {r.component for r in rows} == {min(names)}
    assert len(stored) <= 40


def test_components_of_paths_and_stars(spark):
    rng = random.Random(4)
    names = rng.sample(range(1000), 200)
    edges = list(zip(names[:60], names[1:60])) + [(names[100], x) for x in names[101:150]] + list(zip(range(2000, 2040), range(2001, 2041)))
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {x: min(names[:60]) for x in names[:60]} | {x: min(names[100:150]) for x in names[100:150]} | {x: 2000 for x in range(2000, 2041)}
    assert got == want
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_the_sql_agrees(spark):
    """On the table, and on odd rows, words of all lengths that the hash treats in ways of its own among them."""
    long = spark.createDataFrame([(100 + n, "w" * n + " b" * (n % 4)) for n in range(80)], "doc_id long, text string")
    near = spark.createDataFrame([(300 + n, "one two three four five six seven eight nine ten " * 40 + f"x{n} y z") for n in range(6)], "doc_id long, text string")
    odd = odd_docs(spark).select("doc_id", "text").unionByName(long).unionByName(near)
    for docs, rows in ((odd, simhash.near_duplicates(odd)), (spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"), queries.op6_simhash(spark, SF))):
        documents = docs.toPandas()  # noqa: F841
        want = duckdb.sql(queries.SQL["op6_simhash"]).fetchall()
        got = [(r.doc_id, r.fingerprint, r.component_id) for r in rows.collect()]
        assert sorted(set(got)) == sorted(set(want)) and len({x[2] for x in got}) < len({x[0] for x in got})


def test_hashes_in_sql():
    texts = ["".join(chr(97 + (i * n) % 26) for i in range(n)) for n in range(1, 140)] + ["é漢" * 30]
    documents = pd.DataFrame({"doc_id": range(len(texts)), "text": texts})  # noqa: F841
    got = dict(duckdb.sql(f"WITH {simhash_sql.HASHED} SELECT s, h FROM hashed").fetchall())
    assert got == {t: xxhash.xxh64_intdigest(t.encode(), 42) for t in texts}
