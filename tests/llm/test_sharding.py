import zlib

import duckdb
from pyspark.sql import functions as F

from meridian.llm import queries, sharding

from .fixtures import ODD, no_docs, odd_docs

SF = "/root/testdata/sf0.001"


def test_odd_rows(spark):
    rows = sharding.shard(odd_docs(spark)).collect()
    texts = {r[0]: (r[1] or "").encode() for r in ODD}
    assert len(rows) == len(ODD)
    for r in rows:
        assert (r["size"], r.text_crc32) == (len(texts[r.doc_id]) + 1, zlib.crc32(texts[r.doc_id]))
    gapless(rows)
    assert sharding.shard(no_docs(spark)).count() == 0
    assert sharding.shard(spark.createDataFrame([(None, "x"), (None, None)], "doc_id long, text string")).count() == 2


def gapless(rows):
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in by.values()) and set(by) <= set(range(8))
    return by


def test_the_table_is_dealt_evenly(spark):
    rows = queries.op9_sharding(spark, SF).collect()
    assert len(gapless(rows)) == 8 and {r.law for r in rows} == {"bytes"}
    total = {s: sum(r["size"] for r in rows if r.shard == s) for s in range(8)}
    assert max(total.values()) < 1.02 * min(total.values())
    assert len({(r.slot_id, r.shard) for r in rows}) == len({r.slot_id for r in rows})


def test_a_rebalance_moves_little(spark, tmp_path):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.expr("repeat('x', cast(id % 97 as int))").alias("text"))
    rows = sharding.slotted(docs, 256)
    first = sharding.slot_map(rows, 8)
    path = str(tmp_path / "maps")
    sharding.save_map(first, path)
    grown = sharding.rebalance(sharding.load_map(spark, path), sharding.slot_sizes(rows), 9)
    sharding.save_map(grown, path)
    old = {r.slot_id: r.shard for r in sharding.load_map(spark, path, 1).collect()}
    new = sharding.load_map(spark, path).collect()
    assert {r.version for r in new} == {2} and {r.slot_id for r in new} == set(old)
    load = {}
    for r in new:
        load[r.shard] = load.get(r.shard, 0) + r.bytes
    assert set(load) == set(range(9)) and max(load.values()) < 1.1 * min(load.values())
    assert sum(old[r.slot_id] != r.shard for r in new) < 0.2 * len(new)
    # a shard that goes gives up all it has, and others keep theirs unless they are too full
    fewer = sharding.rebalance(first, sharding.slot_sizes(rows), 7).collect()
    assert {r.shard for r in fewer} == set(range(7))
    assert sum(old[r.slot_id] != r.shard for r in fewer) <= sum(s == 7 for s in old.values())
    moved = sharding.placed(rows, sharding.load_map(spark, path)).collect()
    assert len({(r.shard, r.slot) for r in moved}) == 4000


def test_the_sql_agrees(spark):
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = duckdb.sql(sharding.SQL)
    names = want.columns
    got = queries.op9_sharding(spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(str, (tuple(r) for r in got.select(*names).collect()))) == sorted(map(str, want.fetchall()))
    duckdb.sql("DROP VIEW documents")
