import datetime as dt
import random

from pyspark.sql import functions as F

from meridian.operators import cluster
from meridian.streaming import flows

T0 = dt.datetime(2026, 11, 5, 9)
SCHEMA = "story_id string, country string, published timestamp, headline string, value double"


def write(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def story(i, hours, headline, country="GB"):
    return (i, country, T0 + dt.timedelta(hours=hours), headline, 1.0)


def test_windows_go_on_from_their_checkpoint(spark, tmp_path):
    src, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    write(spark, src, [story("a", 0, "x"), story("b", 1, "x"), story("c", 30, "x")])
    flow = lambda: flows.tumbling(flows.read_stream(spark, src, SCHEMA), "published", "1 day", ["country"])
    sink = lambda df, n: df.write.mode("append").parquet(out)
    flows.run_once(flow(), sink, check)
    write(spark, src, [story("d", 100, "x"), story("late", -200, "x")])
    flows.run_once(flow(), sink, check)
    write(spark, src, [story("e", 300, "x")])
    flows.run_once(flow(), sink, check)
    got = sorted((r.start.day, r.n) for r in spark.read.parquet(out).collect())
    batch = flows.tumbling(spark.read.parquet(src).filter("story_id NOT IN ('late', 'e')"), "published", "1 day", ["country"])
    assert got == sorted((r.start.day, r.n) for r in batch.collect())


def test_leaders_keep_state(spark, tmp_path):
    src, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))

    def same(a, b):
        s, t = set(a[0].split()), set(b[0].split())
        return len(s & t) >= 2

    sink = lambda df, n: df.write.mode("append").parquet(out)
    flow = lambda: flows.leaders(flows.read_stream(spark, src, SCHEMA), same, "country", ["headline"])
    write(spark, src, [story("a", 0, "quake north town"), story("b", 1, "quake north river"), story("f", 1, "quake north town", "FR")])
    flows.run_once(flow(), sink, check)
    write(spark, src, [story("c", 2, "river quake flood"), story("d", 3, "town north fair"), story("e", 60, "quake north town")])
    flows.run_once(flow(), sink, check)
    got = {r.story_id: r.founder_id for r in spark.read.parquet(out).collect()}
    assert got == {"a": "a", "b": "a", "f": "f", "c": "c", "d": "a", "e": "e"}


def test_batch_forms(spark):
    df = spark.createDataFrame([story("a", 0, "x"), story("b", 1, "x"), story("c", 10, "x"), story("d", 0, "x", "FR")], SCHEMA)
    assert sorted((r.country, r.n) for r in flows.sessions(df, "published", "2 hours", ["country"]).collect()) == [("FR", 1), ("GB", 1), ("GB", 2)]
    assert sum(r.n for r in flows.sliding(df, "published", "2 days", "1 day", ["country"]).collect()) == 8
    assert {r.country: r.silent for r in flows.silent(df, "country", "published", F.lit(T0 + dt.timedelta(hours=20)), 12).collect()} == {"GB": False, "FR": True}


def test_leaders_in_order_are_those_of_the_batch(spark, tmp_path):
    """Stories that come in order, in three runs: the clusters that cluster.place makes of all at once."""
    src, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    rng = random.Random(7)
    words = "quake north town river flood fair market fire".split()
    rows = [story(f"s{i:03}", i / 3, " ".join(rng.sample(words, 3)), rng.choice(["GB", "FR"])) for i in range(150)]

    def alike(a, b):
        return len(set(a[0].split()) & set(b[0].split())) >= 2

    sink = lambda df, n: df.write.mode("append").parquet(out)
    for part in (rows[:40], rows[40:90], rows[90:]):
        write(spark, src, part)
        flows.run_once(flows.leaders(flows.read_stream(spark, src, SCHEMA), alike, "country", ["headline"]), sink, check)
    got = {r.story_id: r.founder_id for r in spark.read.parquet(out).collect()}
    pairs = [(a[0], b[0], True) for a in rows for b in rows if a[0] != b[0] and a[1] == b[1] and abs((a[2] - b[2]).total_seconds()) <= 48 * 3600 and alike((a[3],), (b[3],))]
    stories = spark.createDataFrame(rows, SCHEMA).selectExpr("story_id", "country AS outlet", "story_id AS primary_alias", "published")
    placed = cluster.place(stories, spark.createDataFrame(pairs, "story_id string, founder_id string, same boolean")).collect()
    assert got == {r.story_id: r.compared_to or r.story_id for r in placed} and len(set(got.values())) > 5


def test_late_and_timeless_stories(spark, tmp_path):
    src, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    sink = lambda df, n: df.write.mode("append").parquet(out)
    flow = lambda: flows.leaders(flows.read_stream(spark, src, SCHEMA), lambda a, b: a == b, "country", ["headline"])
    write(spark, src, [("n", "GB", None, "quake", 1.0), story("b", 10, "quake")])
    flows.run_once(flow(), sink, check)
    write(spark, src, [story("late", 1, "quake"), ("m", "GB", None, "quake", 1.0), story("next", 11, "quake"), ("z", "FR", None, "quake", 1.0)])
    flows.run_once(flow(), sink, check)
    assert {r.story_id: r.founder_id for r in spark.read.parquet(out).collect()} == {"n": "n", "b": "b", "late": "b", "m": "m", "next": "b", "z": "z"}
