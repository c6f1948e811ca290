"""Streams with state that is let go: the interval join, founders with timers, and messages that may not be sent."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from meridian.operators import cluster
from meridian.operators import health as H
from meridian.streaming import flows

from .test_streams import SCHEMA, T0, story, write

SHARED = f"{SCHEMA}, shared array<string>"


def hours(n):
    return T0 + dt.timedelta(hours=n)


def test_the_interval_join_is_that_of_the_batch(spark, tmp_path):
    """Rows in four runs, some up to a day late, both sides first at times, countries that are null on both sides."""
    src, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    rng = random.Random(3)
    rows = [(f"{'f' if rng.random() < 0.3 else 's'}{i}", rng.choice(["GB", "FR", None]), hours(i / 2 - rng.choice([0, 0, 0, 5, 20])), None, None) for i in range(600)]
    rows += [("f_edge", "X", hours(0), None, None), ("s_edge", "X", hours(48), None, None), ("s_over", "X", hours(48.01), None, None), ("s_none", "X", None, None, None)]

    def sides(df):
        return df.filter("story_id LIKE 's%'"), df.filter("story_id LIKE 'f%'").selectExpr("story_id AS cluster_id", "country AS founder_country", "published AS founder_published")

    flow = lambda: flows.near_founders(*sides(flows.read_stream(spark, src, SCHEMA, 1)))
    sink = lambda df, n: df.write.mode("append").parquet(out)
    order = sorted(rows[:600], key=lambda r: int(r[0][1:]))
    told = []
    for part in (rows[600:], order[:200], order[200:400], order[400:]):
        write(spark, src, part)
        told += flows.run_once(flow(), sink, check)
    got = [(r.story_id, r.cluster_id) for r in spark.read.parquet(out).collect()]
    want = {(r.story_id, r.cluster_id) for r in cluster.near_founders(*sides(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert len(got) == len(set(got)) and set(got) == want and ("s_edge", "f_edge") in want and ("s_over", "f_edge") not in want and len(want) > 2000
    # half a row an hour and side, of which three days and one late stay: not all 600
    assert max(t["kept"] for t in told) < 500 and sum(t["late"] for t in told) == 0
    write(spark, src, [("s_late", "GB", hours(10), None, None), ("s_far", "GB", hours(2000), None, None)])
    told = flows.run_once(flow(), sink, check)
    write(spark, src, [("s_next", "GB", hours(2001), None, None), ("f_next", "GB", hours(2001), None, None)])
    told += flows.run_once(flow(), sink, check)
    assert told[-1]["kept"] < 10 and sum(t["late"] for t in told) >= 1
    assert not spark.read.parquet(out).filter("story_id = 's_late'").count()


def indexed(spark, src, same, late="1 day"):
    return flows.indexed_leaders(flows.read_stream(spark, src, SHARED, 1), same, "country", "shared", ["headline"], late=late)


def put(spark, path, rows):
    spark.createDataFrame([(*r, r[3].split() if r[3] else None) for r in rows], SHARED).coalesce(1).write.mode("append").parquet(path)


def test_timed_leaders_are_those_of_the_batch(spark, tmp_path):
    src, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    rng = random.Random(17)
    words = "quake north town river flood fair market fire".split()
    rows = [story(f"s{i:03}", i / 1.5, " ".join(rng.sample(words, 3)), rng.choice(["GB", "FR"])) for i in range(240)]
    alike = lambda a, b: len(set(a[0].split()) & set(b[0].split())) >= 2
    sink = lambda df, n: df.write.mode("append").parquet(out)
    for part in (rows[:60], rows[60:130], rows[130:]):
        put(spark, src, part)
        flows.run_once(indexed(spark, src, alike), sink, check, keyed_state=True)
    got = {r.story_id: r.founder_id for r in spark.read.parquet(out).collect()}
    pairs = [(a[0], b[0], True) for a in rows for b in rows if a[0] != b[0] and a[1] == b[1] and abs((a[2] - b[2]).total_seconds()) <= 48 * 3600 and alike((a[3],), (b[3],))]
    stories = spark.createDataFrame(rows, SCHEMA).selectExpr("story_id", "country AS outlet", "story_id AS primary_alias", "published")
    placed = cluster.place(stories, spark.createDataFrame(pairs, "story_id string, founder_id string, same boolean")).collect()
    assert got == {r.story_id: r.compared_to or r.story_id for r in placed} and len(set(got.values())) > 10


def test_founders_go_after_days_of_silence(spark, tmp_path):
    """A key that nothing comes for any more: its founders leave the state by their timers, moved by other keys' stories."""
    src, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    sink = lambda df, n: df.write.mode("append").parquet(out)
    same = lambda a, b: a == b
    run = lambda: flows.run_once(indexed(spark, src, same), sink, check, keyed_state=True)
    put(spark, src, [story(f"a{i}", i / 10, f"quake w{i}") for i in range(50)] + [("none", "GB", None, "quake w1", 1.0), story("bare", 1, "")])
    kept = run()[0]["kept"]
    put(spark, src, [story("b", 6, "quake w3"), story("c", 80, "fire x", "FR")])
    run()
    put(spark, src, [story("d", 24 * 6 + 1, "fire y", "FR")])
    run()
    put(spark, src, [story("e", 24 * 6 + 2, "fire y", "FR")])
    after = run()[-1]["kept"]
    got = {r.story_id: r.founder_id for r in spark.read.parquet(out).collect()}
    assert got["b"] == "a3" and got["none"] == "none" and got["bare"] == "bare" and got["d"] == "d" and got["e"] == "d" and len(got) == 56
    assert kept > 50 and after < 12  # what is left is of the other key


def snapshots(spark, rows):
    return spark.createDataFrame([(k, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), f, s) for k, h, f, s in rows], "k string, at timestamp, failing array<string>, sent boolean")


def test_messages_that_are_not_sent_are_made_again(spark):
    rows = [
        ("m", 0, [], True), ("m", 1, ["a"], False), ("m", 2, ["a"], False), ("m", 3, ["a", "b"], True), ("m", 4, ["b", "a"], True), ("m", 5, ["b"], None), ("m", 6, ["b"], True), ("m", 29, ["b"], True), ("m", 30, ["b"], False),
        ("m", 31, ["b"], True), ("m", 32, None, True), ("n", 40, None, True), ("n", 63.99, [], True), ("n", 64, [], True), (None, 1, ["a"], True),
    ]
    got = [(r.k, (r.at - dt.datetime(2024, 1, 1)).total_seconds() / 3600, r.new, r.still, r.recovered, r.due, r.sent) for r in H.fold_digests(snapshots(spark, rows).repartition(5), "k").orderBy("k", "at").collect()]
    assert got == [
        ("m", 0, [], [], [], True, True), ("m", 1, ["a"], [], [], False, False), ("m", 2, ["a"], [], [], False, False), ("m", 3, ["a", "b"], [], [], False, True), ("m", 5, [], ["b"], ["a"], False, False), ("m", 6, [], ["b"], ["a"], False, True),
        ("m", 30, [], ["b"], [], True, False), ("m", 31, [], ["b"], [], True, True), ("m", 32, [], [], ["b"], False, True), ("n", 40, [], [], [], True, True), ("n", 64, [], [], [], True, True),
    ]
    assert H.fold_digests(snapshots(spark, rows).limit(0), "k").count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_digests_against_a_state_that_is_kept_by_hand(spark, seed):
    rng = random.Random(seed)
    rows = [(f"m{i % 3}", i // 3 * rng.choice([1, 7]) + i / 1000, rng.sample("abc", rng.randrange(0, 3)), rng.random() < 0.6) for i in range(300)]
    want, states = [], {}
    for k, h, failing, sent in sorted(rows, key=lambda r: (r[0], r[1])):
        now = int(round(h * 3600))
        message, state = H.decide(states.get(k, {}), [(x, x not in failing, x) for x in "abc"], now)
        if message:
            want.append((k, round(h, 3), sorted(line[5:] for line in message.split("\n") if line.startswith("new: ")), sent))
        states[k] = state if sent or not message else states.get(k, {})
    got = [(r.k, round((r.at - dt.datetime(2024, 1, 1)).total_seconds() / 3600, 3), r.new, r.sent) for r in H.fold_digests(snapshots(spark, rows), "k").orderBy("k", "at").collect()]
    assert [g[2:] for g in got] == [w[2:] for w in want] and len(got) == len(want) > 50
