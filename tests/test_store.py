import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from meridian import schemas
from meridian.operators import cluster as K
from meridian.operators import identity as I
from meridian.operators import merge as M

T0 = dt.datetime(2026, 11, 5, 9)


def table(spark, name, *rows):
    fields = [f.name for f in spark.createDataFrame([], schemas.TABLES[name]).schema]
    return spark.createDataFrame([tuple(r.get(f) for f in fields) for r in rows], schemas.TABLES[name])


def story(i, **more):
    base = {"story_id": i, "outlet": "bbc", "headline": "H", "url": "https://b/1", "authors": ["A"], "categories": {"a": "1", "b": "2"}, "format_flags": ["live"], "text_hash": "t1", "first_seen_at": T0, "last_seen_at": T0, "status": "extracted"}
    return base | more


def test_stories_merge(spark):
    current = table(spark, "stories", story("s1"), story("s2", status="feed"), story("s3"))
    later = T0 + dt.timedelta(hours=1)
    new = [
        story("s1", headline="", url=None, authors=[], categories={"b": "3", "c": ""}, format_flags=["video"], text_hash=None, last_seen_at=later, first_seen_at=later, status="scraped"),
        story("s2", headline="New", last_seen_at=later, status="scraped"),
        story("s3", headline="New", authors=["B"], last_seen_at=later, status="scraped"),
        story("s4", status="scraped"),
    ]
    out = M.merge_stories(current, table(spark, "stories", *new))
    got = {r.story_id: r for r in out.collect()}
    a = got["s1"]
    assert (a.headline, a.url, a.authors, a.status, a.text_hash) == ("H", "https://b/1", ["A"], "extracted", "t1")
    assert a.categories == {"a": "1", "b": "3"} and a.format_flags == ["live", "video"] and a.last_seen_at == later and a.first_seen_at == T0
    assert got["s2"].status == "feed" and got["s2"].headline == "New"
    assert got["s3"].status == "scraped" and got["s3"].authors == ["B"] and got["s4"].status == "scraped"
    twice = M.merge_stories(out, table(spark, "stories", *new))
    assert {r.story_id: r.asDict() | {"status": None} for r in twice.collect()} == {k: r.asDict() | {"status": None} for k, r in got.items()}


def test_other_merges(spark):
    later = T0 + dt.timedelta(hours=1)
    texts = table(spark, "story_texts", {"story_id": "a", "text": "x", "text_hash": "1", "updated_at": T0}, {"story_id": "b", "text": "y", "text_hash": "2", "updated_at": T0})
    new = table(spark, "story_texts", {"story_id": "a", "text": "x2", "text_hash": "1", "updated_at": later}, {"story_id": "b", "text": "z", "text_hash": "3", "updated_at": later}, {"story_id": "c", "text": "n", "text_hash": "4"})
    assert {r.story_id: r.text for r in M.merge_texts(texts, new).collect()} == {"a": "x", "b": "z", "c": "n"}
    health = table(spark, "outlet_health", {"outlet": "bbc", "consecutive_failures": 2, "last_success_at": T0}, {"outlet": "pbs", "consecutive_failures": 1})
    runs = spark.createDataFrame([("bbc", later, False, 0, "boom"), ("pbs", later, True, 3, None), ("new", later, False, 0, "x")], "outlet string, finished_at timestamp, ok boolean, new_stories int, error string")
    got = {r.outlet: r for r in M.finish_runs(health, runs).collect()}
    assert (got["bbc"].consecutive_failures, got["bbc"].last_error, got["bbc"].last_success_at) == (3, "boom", T0)
    assert (got["pbs"].consecutive_failures, got["pbs"].last_new_story_at) == (0, later) and got["new"].consecutive_failures == 1


def test_leases(spark):
    now = F.lit(T0)
    rows = [story("a", published=T0), story("b", lease_until=T0 + dt.timedelta(hours=2)), story("c", lease_until=T0 - dt.timedelta(hours=1)), story("d", status="scraped")]
    stories = table(spark, "stories", *rows)
    taken = M.claim(stories, "extracted", "me", now, 1)
    assert [r.story_id for r in taken.filter("lease_owner = 'me'").collect()] == ["a"]
    assert {r.story_id for r in M.claimable(stories, "extracted", now).collect()} == {"a", "c"}
    back = M.release(taken, spark.createDataFrame([("a",)], "story_id string"), "done")
    assert back.filter("story_id = 'a' AND lease_owner IS NULL AND status = 'done'").count() == 1


def test_dropping_outlets(spark):
    tables = {n: table(spark, n) for n in schemas.TABLES}
    tables["stories"] = table(spark, "stories", story("a"), story("b", outlet="nyt"), story("c"))
    tables["clusters"] = table(spark, "clusters", {"cluster_id": "k", "founder_story": "b"}, {"cluster_id": "m", "founder_story": "a"})
    tables["cluster_members"] = table(spark, "cluster_members", *({"cluster_id": c, "story_id": s} for c, s in ("kb", "kc", "ma")))
    tables["llm_calls"] = table(spark, "llm_calls", {"call_id": "1", "story_id": "b"})
    out = M.drop_outlets(tables, ["nyt"], ["nyt"])
    assert {r.story_id for r in out["stories"].collect()} == {"a", "c"} and [r.cluster_id for r in out["clusters"].collect()] == ["m"]
    assert [(r.cluster_id, r.story_id) for r in out["cluster_members"].collect()] == [("m", "a")] and out["llm_calls"].count() == 1
    plan = {r.table: r.rows for r in M.drop_plan(tables, ["nyt"], ["nyt"]).filter("rows > 0").collect()}
    assert plan == {"stories": 1, "clusters": 1, "cluster_members": 2}
    with pytest.raises(ValueError):
        M.checked_drop(["bbc"], ["nyt"])
    with pytest.raises(ValueError):
        schemas.check_version(schemas.SCHEMA_VERSION + 1)


def test_aliases_and_flags(spark):
    df = spark.createDataFrame([("bbc", " 77 ", "urn:77", "HTTPS://B.org/x/?q"), ("pbs", None, "p1", None), ("zz", "1", "2", "nope")], "o string, asset_id string, id string, u string")
    fields = {"asset_id": F.col("asset_id"), "id": F.col("id")}
    assert [r.x for r in df.select(I.aliases(F.col("o"), fields, F.col("u")).alias("x")).collect()] == [["77", "urn:77", "https://b.org/x"], ["p1"], ["nope"]]
    rows = [
        ("reuters", "https://r/x", {"subjects": ["ANLINS", "XX"], "media": ["image"]}, ["analysis"]),
        ("reuters", "https://r/live/x", {"media": ["Video"]}, ["live", "video"]),
        ("bbc", "https://b/x", {"types": ["Photo Gallery"]}, ["gallery"]),
        ("bbc", "https://b/x", {"types": ["correspondent"]}, ["other_format"]),
        ("bbc", "https://b/x", {"types": ["article"], "subtypes": ["odd"]}, []),
        ("guardian", "https://g/x", {"tones": ["Minute by minute"], "design": ["QuizDesign"]}, ["live", "quiz"]),
        ("pbs", "https://p/newshour/show/x", {"post_type": ["show"]}, ["broadcast"]),
        ("nyt", "https://n/2026/opinion/x", {}, ["opinion"]),
        ("other", "https://o/opinion/x", {}, []),
    ]
    df = spark.createDataFrame([(i, *r[:3]) for i, r in enumerate(rows)], "i int, o string, u string, l map<string,array<string>>")
    assert [r.x for r in df.select("i", I.format_flags(F.col("o"), F.col("u"), F.col("l")).alias("x")).orderBy("i").collect()] == [r[3] for r in rows]


def test_identity_is_sequential(spark):
    known = spark.createDataFrame([("bbc", "k1", "old1", T0), ("bbc", "k2", "old2", T0 - dt.timedelta(hours=1))], "outlet string, alias string, story_id string, first_seen_at timestamp")
    rows = [
        (1, "bbc", ["a", "b"], 1),
        (2, "bbc", ["c"], 2),
        (3, "bbc", ["b", "c"], 3),  # bridges the first two: the earlier one wins, c stays where it is
        (4, "bbc", ["c", "d"], 4),
        (5, "bbc", ["k1", "k2"], 5),
        (6, "pbs", ["a"], 6),
        (7, "bbc", ["lone"], 7),
        (8, "bbc", [], 8),
    ]
    for order in itertools.islice(itertools.permutations(rows), 0, 3000, 1500):
        df = spark.createDataFrame(list(order), "row_id long, outlet string, aliases array<string>, seq long").repartition(3)
        got = {r.row_id: (r.story_id, r.is_new) for r in I.assign_stories(df, known).collect()}
        assert set(got) == {1, 2, 3, 4, 5, 6, 7}
        assert got[3] == (got[1][0], False) and got[4] == (got[2][0], False) and got[5] == ("old2", False)
        assert got[1][1] and got[2][1] and got[6][1] and got[7][1] and len({got[i][0] for i in (1, 2, 6, 7)}) == 4


def test_known_rows(spark):
    known = spark.createDataFrame([("bbc", "a", "s1", T0)], "outlet string, alias string, story_id string, first_seen_at timestamp")
    sections = spark.createDataFrame([("s1", "world")], "story_id string, section string")
    rows = spark.createDataFrame([(1, "bbc", ["a"], "world", 0), (2, "bbc", ["b"], "world", 1), (3, "bbc", ["a"], "sport", 0)], "row_id long, outlet string, aliases array<string>, section string, page int")
    assert [r.row_id for r in I.known_rows(rows, known, sections).collect()] == [1]
    assert {(r.section, r.page): r.all_known for r in I.pages_known(rows, known, sections).collect()} == {("world", 0): True, ("world", 1): False, ("sport", 0): False}


FACTS = "story_id string, outlet string, primary_alias string, headline string, published timestamp, country string, entities array<string>, latitude double, longitude double, format_flags array<string>"


def at(i, hours=0, headline="", country="GB", entities=(), place=(None, None), flags=()):
    return (i, "bbc", i, headline, T0 + dt.timedelta(hours=hours), country, list(entities), *place, list(flags))


def by_hand(rows):
    """Pairs with a reason, one by one."""
    import math

    stop = set(__import__("meridian.functions.text", fromlist=["x"]).STOP_WORDS)
    tokens = lambda s: {w for w in __import__("re").findall("[a-z0-9]+", s.lower()) if len(w) > 2 and w not in stop}
    out = set()
    for a in rows:
        for b in rows:
            if a[0] == b[0] or a[5] != b[5] or not a[5] or "live" in a[9] or "live" in b[9] or abs(a[4] - b[4]) > dt.timedelta(hours=48):
                continue
            near = False
            if None not in (a[7], a[8], b[7], b[8]):
                p, q = math.radians(a[7]), math.radians(b[7])
                h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[8] - a[8]) / 2) ** 2
                near = 2 * 6371.0088 * math.asin(math.sqrt(h)) <= 50
            shared = {e.strip().lower() for e in a[6]} & {e.strip().lower() for e in b[6]}
            s, t = tokens(a[3]), tokens(b[3])
            if near or shared or (s and t and len(s & t) / len(s | t) >= 0.34):
                out.add((a[0], b[0]))
    return out


def test_candidate_pairs(spark):
    import random

    rng = random.Random(3)
    rows = [
        at("edge48", 48, "alpha bravo charlie"), at("edge0", 0, "alpha bravo charlie"), at("late", 49, "alpha bravo charlie"),
        at("live", 1, "alpha bravo charlie", flags=["live"]), at("none", 1, "alpha bravo charlie", country=None),
        at("p1", 0, place=(80.0, 179.9)), at("p2", 1, place=(80.1, -179.5)), at("p3", 1, place=(0.0, 0.44)), at("p4", 2, place=(0.0, 0.0)),
        at("e1", 0, entities=[" Ann Lee"]), at("e2", 1, entities=["ANN LEE "]),
    ]
    words = "storm flood quake fire march vote trial crash strike summit".split()
    for i in range(80):
        place = (rng.uniform(-1, 1) + rng.choice([0, 60, 85]), rng.uniform(-2, 2) + rng.choice([0, 179])) if rng.random() < 0.6 else (None, None)
        place = (place[0], (place[1] + 180) % 360 - 180) if place[0] is not None else place
        rows.append(at(f"r{i}", rng.uniform(0, 200), " ".join(rng.sample(words, 4)), rng.choice(["GB", "FR"]), rng.sample(["x", "y", "z", "w", "v", "u"], 1), place))
    df = spark.createDataFrame(rows, FACTS)
    got = {(r.story_id, r.founder_id) for r in K.candidate_pairs(df, df).collect()}
    assert got == by_hand(rows)


def test_placement_never_chains_and_order_never_matters(spark):
    a, b, c = at("a", 0, "quake hits town north"), at("b", 1, "quake hits town south river"), at("c", 2, "south river quake flood bridge")
    rows = [a, b, c, at("x", 0, "stabbing london park"), at("y", 1, "stabbing london station"), at("z", 60, "quake hits town north")]
    want = None
    for order in itertools.islice(itertools.permutations(rows), 0, 700, 300):
        df = spark.createDataFrame(list(order), FACTS).repartition(3)
        pairs = K.candidate_pairs(df, df).withColumn("same", ~((F.col("story_id").isin("x", "y")) & F.col("founder_id").isin("x", "y")))
        got = {r.story_id: (r.cluster_id, r.verdict, r.compared_to) for r in K.place(df, pairs).collect()}
        want = want or got
        assert got == want
    assert want["b"][2] == "a" and want["c"][1] == "founder" and want["x"][0] != want["y"][0] and want["z"][1] == "founder"
    assert want["a"][0].startswith("nf_") and want["b"][0] == want["a"][0]


def test_pins(spark):
    schema = "cluster_id string, founder_story string, is_live boolean, is_physical_event boolean, category string, pinnable boolean, latitude double, longitude double"
    base = ("f", False, True, "disaster", True, 0.0, 0.0)
    rows = [("ok", *base), ("live", "f", True, *base[2:]), ("not", "f", False, None, *base[3:]), ("cat", "f", False, True, "courts_and_justice", True, 0.0, 0.0), ("place", *base[:5], None, 0.0), ("far", *base)]
    members = spark.createDataFrame([("ok", "m", 0.0, 0.4), ("far", "m", 0.0, 0.5), ("far", "f", 9.0, 9.0), ("ok", "n", None, None)], "cluster_id string, story_id string, latitude double, longitude double")
    got = {r.cluster_id: r.not_pin_reason for r in K.pin_decisions(spark.createDataFrame(rows, schema), members).collect()}
    assert got == {"ok": None, "live": "live_blog", "not": "founder_not_an_event", "cat": "founder_category_never_pins", "place": "founder_place_not_pinnable", "far": "members_far_apart"}


def walked(stories, pairs):
    """(story, founder or None) by walking the stories one by one."""
    same, founders, out = {}, set(), {}
    for a, b in pairs:
        same.setdefault(a, set()).add(b)
    for s in sorted(stories, key=stories.get):
        mine = sorted((f for f in same.get(s, ()) if f in founders), key=stories.get)
        out[s] = mine[0] if mine else None
        if not mine:
            founders.add(s)
    return out


@pytest.mark.parametrize("at_once", [0, 3, 10**6])
def test_rounds_place_as_a_walk_does(spark, at_once):
    rng = random.Random(at_once)
    names = [f"s{i}" for i in range(120)]
    stories = {n: (T0 + dt.timedelta(minutes=rng.randrange(60)), n) for n in names}
    chain = sorted(names, key=stories.get)[:14]
    pairs = {(b, a) for a, b in zip(chain, chain[1:])} | {(rng.choice(names), rng.choice(names)) for _ in range(160)}
    pairs = {(a, b) for a, b in pairs if a != b}
    rows = spark.createDataFrame([(n, "o", n, at) for n, (at, _) in stories.items()], "story_id string, outlet string, primary_alias string, published timestamp")
    asked = spark.createDataFrame([(a, b, True) for a, b in pairs] + [(names[0], names[1], False)], "story_id string, founder_id string, same boolean")
    got = {r.story_id: r.compared_to for r in K.place(rows, asked, at_once).collect()}
    assert got == walked(stories, pairs)


def test_budgets_by_parts_are_the_same(spark):
    rng = random.Random(2)
    rows = [(i, rng.randrange(3), rng.randrange(400), float(rng.randrange(1, 9))) for i in range(900)]
    calls = spark.createDataFrame(rows, "i int, day int, at int, cost double")
    for down in (False, True):
        order = [F.col("at").desc() if down else F.col("at"), F.col("i")]
        want, got = (sorted((r.i, r.spent_before) for r in M.within_budget(calls, F.col("day"), order, "cost", 300.0, part, down).collect()) for part in (None, F.floor(F.col("at") / 10)))
        assert got == want and 100 < len(want) < 900


def test_older_schemas_and_ended_runs(spark):
    old = spark.createDataFrame([("a", "bbc", "7", "x")], "story_id string, outlet string, word_count string, gone string")
    new = schemas.migrated(old, "stories", 2)
    assert new.schema == table(spark, "stories").schema and (new.first().word_count, new.first().headline) == (7, None)
    with pytest.raises(ValueError):
        schemas.migrated(old, "stories", schemas.SCHEMA_VERSION + 1)
    runs = spark.createDataFrame([("r1", T0, None, 0), ("r2", T0, T0, 4)], "run_id string, started_at timestamp, finished_at timestamp, new_stories int")
    later = T0 + dt.timedelta(hours=1)
    got = {r.run_id: (r.finished_at, r.new_stories) for r in M.end_runs(runs, spark.createDataFrame([("r1", later, 3), ("zz", later, 1)], "run_id string, finished_at timestamp, new_stories int")).collect()}
    assert got == {"r1": (later, 3), "r2": (T0, 4)}


def test_long_chains_of_rows_keep_their_first_story(spark):
    rows = [(i, "bbc", [f"a{i}", f"a{i + 1}"], i) for i in range(300)] + [(1000, "bbc", ["a7"], 1000), (1001, "pbs", ["a7"], 1001)]
    df = spark.createDataFrame(rows, "row_id long, outlet string, aliases array<string>, seq long").repartition(4)
    none = spark.createDataFrame([], "outlet string, alias string, story_id string, first_seen_at timestamp")
    got = {r.row_id: (r.story_id, r.is_new) for r in I.assign_stories(df, none).collect()}
    assert len({got[i][0] for i in range(300)}) == 1 and sorted(i for i, x in got.items() if x[1]) == [0, 1001] and got[1000][0] == got[0][0]
