"""Files that are replaced as a whole, builds that are switched, tables of which only touched buckets are rewritten, exports that go on."""

import datetime as dt
import hashlib
import hmac
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from meridian.operators import export as X
from meridian.operators import merge as M
from meridian.operators import tables


def test_a_text_is_replaced_as_a_whole(spark, tmp_path):
    path = f"file://{tmp_path}/deep/er/state"
    assert tables.read_text(spark, path) is None
    for text in ("one", "zwei ü\n", ""):
        tables.replace_text(spark, path, text)
        assert tables.read_text(spark, path) == text
    assert [p.name for p in (tmp_path / "deep/er").iterdir() if not p.name.endswith(".crc")] == ["state"]


def test_a_build_that_fails_changes_nothing(spark, tmp_path):
    root = f"file://{tmp_path}/gazetteer"
    rows = lambda n: spark.range(n).coalesce(1)
    assert tables.current_build(spark, root) is None
    first = tables.publish(spark, root, lambda place: rows(3).write.parquet(f"{place}/places"))
    reading = spark.read.parquet(f"{tables.current_build(spark, root)}/places")

    def half(place):
        rows(9).write.parquet(f"{place}/places")
        rows(9).select(F.raise_error(F.lit("bad dump"))).write.parquet(f"{place}/names")

    with pytest.raises(Exception, match="bad dump"):
        tables.publish(spark, root, half)
    assert tables.current_build(spark, root) == first and len(list(Path(tmp_path, "gazetteer").glob("build-*"))) == 1
    second = tables.publish(spark, root, lambda place: rows(5).write.parquet(f"{place}/places"))
    assert tables.current_build(spark, root) == second != first and reading.count() == 3  # who reads the old one goes on
    tables.publish(spark, root, lambda place: rows(7).write.parquet(f"{place}/places"))
    assert not Path(first.removeprefix("file://")).exists() and spark.read.parquet(f"{tables.current_build(spark, root)}/places").count() == 7


SECTIONS = "story_id string, section string, first_seen_at timestamp, last_seen_at timestamp"


def files_of(path):
    return {str(p.relative_to(path)) for p in path.rglob("*.parquet")}


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    at = lambda d: dt.datetime(2024, 1, d)
    root, place = f"file://{tmp_path}/sections", tmp_path / "sections"
    M.lay_out(spark.createDataFrame([(f"s{i}", "world", at(2), at(3)) for i in range(200)], SECTIONS), root, ["story_id"], 32)
    before = files_of(place)
    assert len(before) == 32  # one file a bucket
    new = spark.createDataFrame([("s7", "world", at(1), at(9)), ("s7", "home", at(4), at(4)), ("s900", "world", at(5), at(6))], SECTIONS)
    merge = lambda a, b: M.merge_seen(a, b, ["story_id", "section"])
    touched = M.merge_into(new, root, SECTIONS, ["story_id"], 32, merge)
    after = files_of(place)
    assert 1 <= len(touched) <= 2 and {f.split("/")[0] for f in before ^ after} == {f"{M.BUCKET}={b}" for b in touched} and len(after) == 32
    got = {(r.story_id, r.section): (r.first_seen_at.day, r.last_seen_at.day) for r in M.read_buckets(spark, root, SECTIONS).collect()}
    assert len(got) == 202 and got["s7", "world"] == (1, 9) and got["s7", "home"] == (4, 4) and got["s900", "world"] == (5, 6) and got["s8", "world"] == (2, 3)
    assert M.merge_into(new, root, SECTIONS, ["story_id"], 32, merge) == touched  # again: the same table
    assert {(r.story_id, r.section): (r.first_seen_at.day, r.last_seen_at.day) for r in M.read_buckets(spark, root, SECTIONS).collect()} == got
    assert M.merge_into(new.limit(0), root, SECTIONS, ["story_id"], 32, merge) == []


@pytest.mark.parametrize("how", ["first", "last"])
def test_partial_merges_are_whole_merges(spark, tmp_path, how):
    schema = "outlet string, alias string, story_id string, at long"
    rows = lambda lo, hi, mark: spark.createDataFrame([(f"o{i % 3}", f"a{i}", f"{mark}{i}", i * 7 % 5) for i in range(lo, hi)] + [("o0", f"a{lo}", f"{mark}again", 9)], schema)
    current, incoming = rows(0, 90, "old").dropDuplicates(["outlet", "alias"]), rows(60, 140, "new")
    order = [F.col("at"), F.col("story_id")]
    merge = lambda a, b: (M.first_wins if how == "first" else M.last_wins)(a, b, ["outlet", "alias"], order)
    root = f"file://{tmp_path}/aliases"
    M.lay_out(current, root, ["outlet", "alias"], 8)
    M.merge_into(incoming, root, schema, ["outlet", "alias"], 8, merge)
    want = sorted(map(tuple, merge(current, incoming).collect()))
    assert sorted(map(tuple, M.read_buckets(spark, root, schema).collect())) == want and len(want) == 140


def test_a_merge_that_fails_leaves_the_table(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    M.lay_out(spark.range(50).selectExpr("id", "id * 2 AS v"), root, ["id"], 4)
    before = files_of(tmp_path / "t")
    bad = lambda a, b: a.unionByName(b.withColumn("v", F.raise_error(F.lit("no")).cast("long")))
    with pytest.raises(Exception, match="no"):
        M.merge_into(spark.range(3).selectExpr("id", "id AS v"), root, "id long, v long", ["id"], 4, bad)
    assert files_of(tmp_path / "t") == before and M.read_buckets(spark, root, "id long, v long").agg(F.sum("v")).first()[0] == 2450


NOW = dt.datetime(2024, 1, 20, tzinfo=dt.UTC)


def store_of(spark, seen):
    stories = spark.createDataFrame([(f"s{i:02}", "bbc", NOW.replace(tzinfo=None) - dt.timedelta(hours=h)) for i, h in enumerate(seen)], "story_id string, outlet string, last_seen_at timestamp")
    texts = spark.createDataFrame([], "story_id string, text string")
    read = spark.createDataFrame([], "story_id string, config_hash string, text_hash string, created_at timestamp")
    return {"stories": stories, "story_texts": texts, "extractions": read}


def test_an_export_goes_on_where_it_ended(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(X, "COLD_START", 4)
    path, sent = f"file://{tmp_path}/rail.json", []
    tables_ = store_of(spark, [200, 100, 90, 80, 70, 70, 70, 60, 50, 40])
    send = lambda rows: sent.append(sorted(r.story_id for r in rows.collect()))

    def broken(rows):
        raise ConnectionError("https://me:secret@far.example refused")

    run = lambda how=send: X.run_export(tables_, path, NOW, how, "e1", 3)
    assert X.load_state(spark, path) == {} and run() == 4 and sent == [["s01", "s02", "s03", "s04"]]
    state = X.load_state(spark, path)
    with pytest.raises(ConnectionError):
        run(broken)
    failed = X.load_state(spark, path)
    assert failed["cursor_us"] == state["cursor_us"] and failed["last_error"] == "https://***:***@far.example refused" and failed["last_ok_at"] == state["last_ok_at"]
    # rows of one moment that the limit parts go again, so none is missed
    while run() == 3 and len(sent) < 9:
        pass
    assert {x for some in sent for x in some} == {f"s{i:02}" for i in range(1, 10)} and X.load_state(spark, path)["last_error"] is None
    n = len(sent)
    assert run() == 0 and sent[n] == []
    tables.replace_text(spark, path, "{ broken")  # a state that is lost: the window goes again
    assert run() == 4 and sent[-1] == sent[0]


def test_bodies_as_rows_are_those_of_the_driver(spark):
    items = [(i % 7, f"s{i:03}", json.dumps({"id": i, "text": "é" * (i * 37 % 400)}, ensure_ascii=False)) for i in range(300)] + [(9, "big", json.dumps("x" * 5000))]
    found = spark.createDataFrame(items, "last_seen_at long, story_id string, item string").repartition(5)
    want = list(X.bodies(found, "t", 20, 4000))
    got = X.signed_rows(X.body_rows(found, "t", 20, 4000), "key", "rail", 123).orderBy("batch").collect()
    assert [r.body.encode() for r in got] == want and [r.batch for r in got] == list(range(len(want)))
    for r, body in zip(got, want, strict=True):
        headers, _ = X.signed(body, "key", "rail", 123)
        assert (r.content_sha256, r.signature) == (headers["x-content-sha256"], headers["x-signature"]) and r.n == len(json.loads(body)["items"])
        assert r.signature == hmac.new(b"key", f"rail\n123\n{hashlib.sha256(body).hexdigest()}".encode(), hashlib.sha256).hexdigest()
    assert X.body_rows(found.limit(0), "t").count() == 0
