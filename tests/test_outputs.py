import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from meridian import schemas
from meridian.functions import hashing
from meridian.operators import checks as C
from meridian.operators import export as X
from meridian.operators import health as H
from meridian.operators import snapshot as S

from .test_store import T0, story, table

GOOD = {
    "is_physical_event": True,
    "category": "disaster",
    "event_date": "2026-11-05",
    "event_place": {"name": "Marnham", "quote": "A fire in Marnham", "country": "GB", "kind": "city", "within": None},
    "other_places": [],
    "key_entities": ["Ann"],
    "not_event_reason": None,
    "cluster_hint": "fire",
}


def changed(**more):
    out = json.loads(json.dumps(GOOD))
    for k, v in more.items():
        part = out
        *path, last = k.split("__")
        for p in path:
            part = part[p]
        part[last] = v
    return out


@pytest.fixture(scope="module")
def schema_results(spark):
    cases = [
        (json.dumps(GOOD), None),
        ("[1]", "not_an_object"),
        ("no json", "not_an_object"),
        (json.dumps(changed(is_physical_event="yes")), "is_physical_event"),
        (json.dumps(changed(category="weather")), "category"),
        (json.dumps(changed(not_event_reason="because")), "not_event_reason"),
        (json.dumps(changed(event_date="2026-02-30")), "event_date"),
        (json.dumps(changed(event_place=None)), "event_place"),
        (json.dumps(changed(event_place__name=" ")), "event_place.name"),
        (json.dumps(changed(event_place__quote=None)), "event_place.quote"),
        (json.dumps(changed(event_place__kind="planet")), "event_place.kind"),
        (json.dumps(changed(event_place__country="GBR")), "event_place.country"),
        (json.dumps(changed(event_place__within=5)), "event_place.within"),
        (json.dumps(changed(is_physical_event=False, event_place=None)), None),
        (json.dumps(changed(is_physical_event=False)), "event_place"),
        (json.dumps(changed(other_places="x")), "other_places"),
        (json.dumps(changed(key_entities=[1])), "key_entities"),
        (json.dumps(changed(cluster_hint=7)), "cluster_hint"),
    ]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, raw string, want string")
    return df.select("i", "raw", "want", C.schema_failure("raw").alias("got")).orderBy("i").collect()


def test_answer_schema(schema_results):
    for r in schema_results:
        assert r.got == r.want, r


def test_checks_correct_answers(spark):
    text = "A fire in Marnham killed two.  It began at night."
    place = {"name": "Marnham", "within": None, "country": "GB", "kind": "city"}
    rows = [
        ("ok", True, "A fire in  Marnham", text, [], None),
        ("quote", True, "A fire at Marnham", text, [], "quote_not_in_text"),
        ("name", True, "It began at night", text, [], "name_not_in_quote"),
        ("flag", True, "A fire in Marnham", text, ["live"], "flagged: live"),
        ("empty", True, "A fire in Marnham", " ", [], "no_article_text"),
        ("none", False, None, text, ["live"], None),
        ("date", True, "A fire in Marnham", text, [], "date_outside_window"),
        ("planned", True, "Marnham is due to burn", text + " Marnham is due to burn", [], "planned"),
    ]
    data = [(i, (ev, None, "disaster", "2026-10-01" if i == "date" else "2026-11-05", (*place.values(), q) if q else None, [], [], None), t, T0, f) for i, ev, q, t, f, _ in rows]
    df = spark.createDataFrame(data, f"story_id string, answer struct<{C.ANSWER.replace(' struct<', ': struct<')}>, text string, published timestamp, format_flags array<string>")
    got = {r.story_id: r for r in C.apply_checks(df).collect()}
    for i, _, _, _, _, want in rows:
        assert got[i].failure == want, (i, got[i])
    assert got["quote"].answer.is_physical_event is False and got["quote"].answer.event_place is None and got["quote"].answer.not_event_reason == "other" and got["quote"].answer.category == "disaster"
    assert got["flag"].checks["quote"] == "not applicable: overridden" and got["none"].checks["quote"] == "not applicable: no happening" and got["ok"].checks["evidence"] == "passed"


def test_second_look(spark):
    agree = {p: "agree" for p in C.POINTS}
    rows = [(1, agree, ["conflict"], None), (2, agree | {"happened": "disagree"}, [], None), (3, agree, ["opinion_analysis"], "keep"), (4, {}, [], "drop")]
    df = spark.createDataFrame(rows, "i int, v map<string,string>, a array<string>, d string").withColumn("p", C.disputed("v", "a"))
    assert [(list(r.p), r.o) for r in df.select("i", "p", C.outcome("p", "d").alias("o")).orderBy("i").collect()] == [([], "verified"), (["happened"], "not_run"), (["category"], "kept"), (C.POINTS, "dropped")]
    stored = spark.createDataFrame([("a", "h", "verified", 0, 7), ("b", "h", "bad_answer", 1, 7), ("c", "h", "bad_answer", 2, 7), ("d", "old", "verified", 0, 7)], "story_id string, input_hash string, outcome string, attempts int, geonames_id long")
    wanted = spark.createDataFrame([(x, "h", 7) for x in "abcde"], "story_id string, input_hash string, geonames_id long")
    assert {r.story_id for r in C.needs_check(wanted, stored).collect()} == {"b", "d", "e"}
    assert {r.story_id for r in C.gate(wanted, stored).collect()} == {"a"}
    assert C.gate(wanted.withColumn("geonames_id", F.lit(8).cast("long")), stored).count() == 0


HASHES = {"extract": "e", "resolve": "r", "cluster": "c"}


def snapshot_tables(spark):
    day = dt.timedelta(days=1)
    s = [story(f"s{i}", headline=f"H{i}", url=f"https://b/{i}", published=T0 - day * (i % 3), outlet="bbc") for i in range(12)]
    s[4]["headline"], s[5]["url"], s[6]["published"] = None, "ftp://x", None
    s += [story("w", published=T0 - 4 * day, headline="old"), story("p", published=T0 - 4 * day, headline="pin"), story("n", published=None)]
    clusters = [
        {"cluster_id": "nf_000000000001", "config_hash": "c", "founder_story": "s0", "is_pin": True, "latitude": 1.123456789, "longitude": 2.0, "place_precision": "city"},
        {"cluster_id": "nf_000000000002", "config_hash": "c", "founder_story": "w", "is_pin": False},
        {"cluster_id": "nf_000000000003", "config_hash": "c", "founder_story": "p", "is_pin": True, "latitude": 1.0, "longitude": 2.0, "place_precision": "point"},
        {"cluster_id": "nf_000000000004", "config_hash": "c", "founder_story": "n", "is_pin": False},
        {"cluster_id": "nf_000000000005", "config_hash": "other", "founder_story": "s1", "is_pin": False},
    ]
    members = [("nf_000000000001", f"s{i}") for i in range(12)] + [("nf_000000000002", "w"), ("nf_000000000003", "p"), ("nf_000000000004", "n")]
    read = [{"story_id": x, "config_hash": "e", "category": "disaster", "event_date": T0.date(), "place_quote": "in A place", "place_name": "A place"} for x in ("s0", "p")]
    found = [{"story_id": x, "config_hash": "r", "geonames_id": 7} for x in ("s0", "p")]
    return (
        table(spark, "clusters", *clusters),
        table(spark, "cluster_members", *({"cluster_id": c, "story_id": x, "config_hash": "c"} for c, x in members)),
        table(spark, "stories", *s),
        table(spark, "extractions", *read),
        table(spark, "resolutions", *found),
        spark.createDataFrame([(7, "A place, Land")], "geonames_id long, display_name string"),
    )


def test_snapshot(spark):
    tables = snapshot_tables(spark)
    now = F.lit(T0 + dt.timedelta(minutes=1))
    got = {r.id: r for r in S.items(*tables, now, HASHES).collect()}
    assert set(got) == {"nf_000000000001", "nf_000000000003"}
    one = got["nf_000000000001"]
    # the eight earliest, without the two that can't be sent
    assert [r.headline for r in one.reports] == ["H11", "H2", "H8", "H1", "H10", "H7"] and one.title == "H11"
    assert one.location.lat == 1.12346 and one.location.place == "A place, Land" and one.location.evidence == "in A place" and one.eventDate == "2026-11-05"
    assert one.firstReportedAt == "2026-11-03T09:00:00Z" and one.lastReportedAt == "2026-11-05T09:00:00Z"
    assert {r.id for r in S.items(*tables, now, HASHES, pins=False).collect()} == set()
    health = table(spark, "outlet_health", {"outlet": "bbc", "last_new_story_at": T0}, {"outlet": "zz"})
    outlets = S.outlets_block(health)
    assert [(r.outlet, r.lastNewStoryAt) for r in outlets.collect()] == [(o, "2026-11-05T09:00:00Z" if o == "bbc" else None) for o in schemas.OUTLETS]
    make = lambda t: S.body(S.items(*t, now, HASHES), outlets, "2026-11-05T09:01:00Z", "2026-11-05T08:00:00Z", False, False)
    body = make(tables)
    assert S.body_problems(body) == [] and body["snapshotId"] == make(tuple(t.repartition(5) for t in tables))["snapshotId"]
    problems = S.item_problems(spark.read.schema(S.ITEM.replace(" struct<", " struct<")).json(spark.sparkContext.parallelize([json.dumps(i) for i in body["items"]])), "2026-11-05T09:01:00Z").collect()
    assert problems == []


def item(**more):
    out = {
        "id": "nf_0123456789ab",
        "category": "disaster",
        "title": "H",
        "firstReportedAt": "2026-11-05T09:00:00Z",
        "lastReportedAt": "2026-11-05T10:00:00Z",
        "eventDate": "2026-11-05",
        "location": {"lat": 1.5, "lon": 2.5, "precision": "city", "place": "P", "geonamesId": 5, "evidence": "in P", "evidenceOutlet": "bbc"},
        "reports": [{"outlet": "bbc", "headline": "H", "url": "https://b/1", "publishedAt": "2026-11-05T09:00:00Z"}, {"outlet": "pbs", "headline": "G", "url": "https://p/1", "publishedAt": "2026-11-05T10:00:00Z"}],
    }
    for k, v in more.items():
        part = out
        *path, last = k.split("__")
        for p in path:
            part = part[int(p) if p.isdigit() else p]
        part[int(last) if last.isdigit() else last] = v
    return out


MUTATIONS = [
    ({}, None),
    ({"id": "x"}, "id"),
    ({"category": "weather"}, "category"),
    ({"title": " ", "reports__0__headline": " "}, "title_missing"),
    ({"title": "x" * 301, "reports__0__headline": "x" * 301}, "title_long"),
    ({"firstReportedAt": "2026-11-05"}, "firstReportedAt_shape"),
    ({"lastReportedAt": "2026-11-05T10:00:00+00:00"}, "lastReportedAt_shape"),
    ({"lastReportedAt": "2026-11-05T08:00:00Z"}, "first_after_last"),
    ({"eventDate": "5 Nov"}, "event_date_shape"),
    ({"location__lat": 91.0}, "lat_range"),
    ({"location__lon": -181.0}, "lon_range"),
    ({"location__lat": 1.1234567}, "lat_decimals"),
    ({"location__precision": "region"}, "precision"),
    ({"location__place": ""}, "place_missing"),
    ({"location__place": "x" * 121}, "place_long"),
    ({"location__geonamesId": 0}, "geonames_id"),
    ({"location__evidence": None}, "evidence_missing"),
    ({"location__evidence": "x" * 201}, "evidence_long"),
    ({"location__evidenceOutlet": "zz"}, "evidence_outlet"),
    ({"reports": []}, "reports_number"),
    ({"reports__1__outlet": "zz"}, "report_outlet"),
    ({"reports__1__headline": ""}, "report_headline"),
    ({"reports__1__url": "ftp://x"}, "report_url"),
    ({"reports__1__publishedAt": "soon"}, "report_time"),
    ({"reports__1__publishedAt": "2026-11-05T08:00:00Z"}, "lead_not_earliest"),
    ({"reports__1__outlet": "bbc", "reports__1__url": "https://b/1"}, "report_twice"),
    ({"title": "other"}, "title_not_lead"),
    ({"firstReportedAt": "2026-11-05T09:30:00Z"}, "first_not_lead"),
    ({"firstReportedAt": "2026-10-01T09:00:00Z", "reports__0__publishedAt": "2026-10-01T09:00:00Z", "lastReportedAt": "2026-10-02T09:00:00Z"}, "outside_window"),
    ({"location": None, "firstReportedAt": "2026-11-01T09:00:00Z", "reports__0__publishedAt": "2026-11-01T09:00:00Z", "lastReportedAt": "2026-11-02T09:00:00Z"}, "outside_window"),
]


def test_one_mutation_for_each_rule(spark):
    docs = [json.dumps(item(**m) | {"id": item(**m)["id"] if "id" in m else f"nf_{i:012x}"}) for i, (m, _) in enumerate(MUTATIONS)]
    df = spark.read.schema(S.ITEM).json(spark.sparkContext.parallelize(docs))
    got = {}
    for r in S.item_problems(df, "2026-11-05T12:00:00Z").collect():
        got.setdefault(r.id, set()).add(r.problem)
    for i, (m, want) in enumerate(MUTATIONS):
        found = got.get(m.get("id", f"nf_{i:012x}"), set())
        assert (want in found) if want else not found, (m, found)
    twice = spark.read.schema(S.ITEM).json(spark.sparkContext.parallelize([docs[0], docs[0]]))
    assert [r.problem for r in S.item_problems(twice).collect()] == ["id_twice"]


def test_body_rules():
    body = {"schema": S.SCHEMA, "snapshotId": "snap_" + "0" * 16, "generatedAt": "2026-11-05T12:00:00Z", "dataAsOf": "2026-11-05T12:00:00Z", "pinsWithheld": False, "worldNewsWithheld": False, "outlets": [{"outlet": o} for o in schemas.OUTLETS], "items": [item()]}
    assert S.body_problems(body) == []
    for more in ({"schema": "x"}, {"snapshotId": "y"}, {"dataAsOf": None}, {"pinsWithheld": None}, {"outlets": []}, {"pinsWithheld": True}, {"extra": 1}, {"items": [item()] * 3001}, {"worldNewsWithheld": True, "items": [item(location=None)]}):
        assert S.body_problems(body | more), more
    assert S.body_problems({k: v for k, v in body.items() if k != "items"})


def test_export(spark):
    hour = dt.timedelta(hours=1)
    stories = table(
        spark,
        "stories",
        story("new", last_seen_at=T0 + hour, first_seen_at=T0 + hour),
        story("read_later", last_seen_at=T0 - hour),
        story("old", last_seen_at=T0 - hour),
        story("dropped", last_seen_at=T0 + hour, outlet="nyt"),
        story("feed", last_seen_at=T0 + 2 * hour, status="feed", first_seen_at=T0 - 48 * hour),
        story("too_old", last_seen_at=T0 - 400 * hour),
    )
    texts = table(spark, "story_texts", {"story_id": "new", "text": "body"}, {"story_id": "feed", "text": "body"})
    place = {"config_hash": "e", "is_physical_event": True, "category": "disaster", "place_name": "P", "place_kind": "city", "other_places": [], "key_entities": [str(i) for i in range(20)]}
    read = table(spark, "extractions", place | {"story_id": "read_later", "created_at": T0 + hour}, place | {"story_id": "new", "created_at": T0 - hour, "place_kind": "Region"}, place | {"story_id": "feed"}, place | {"story_id": "too_old", "created_at": T0 + hour})
    cursor, now = F.lit(T0), F.lit(T0 + 3 * hour)
    rows = X.rows_since(stories, texts, read, "e", cursor, F.lit(T0 - 168 * hour), 100)
    sections = table(spark, "story_sections", {"story_id": "new", "section": "b"}, {"story_id": "new", "section": "a"})
    found = X.items(X.with_sections(rows, sections), cursor, now)
    got = {x["id"]: x for x in (json.loads(r["item"]) for r in found.collect())}
    assert set(got) == {"new", "read_later", "feed"}
    assert got["new"]["text"] == "body" and got["new"]["sections"] == ["a", "b"] and got["new"]["event"]["isPhysical"] is False and "placeName" not in got["new"]["event"]
    assert got["read_later"]["event"]["placeName"] == "P" and len(got["read_later"]["event"]["keyEntities"]) == 12
    assert "event" not in got["feed"] and "text" not in got["feed"] and len(got["new"]["itemHash"]) == 32
    bodies = [json.loads(b) for b in X.bodies(found, "2026-11-05T12:00:00Z", most=2)]
    assert [[i["id"] for i in b["items"]] for b in bodies] == [["read_later", "new"], ["feed"]]
    assert X.run_limit("", 10) == 20_000 and X.run_limit("x", 10) == 10


def test_batches(spark):
    df = spark.createDataFrame([([5, 5, 50, 5, 5, 5, 5],)], "s array<int>")
    assert df.select(X.batch_numbers("s", 3, 20)).first()[0] == [0, 0, 1, 2, 2, 2, 3]


def test_state(tmp_path):
    path = str(tmp_path / "x" / "state.json")
    assert X.read_state(path) == {}
    X.write_state(path, a=1)
    assert X.write_state(path, b=2) == {"a": 1, "b": 2} == X.read_state(path)


def test_health(spark):
    now = F.lit(T0)
    hour = dt.timedelta(hours=1)
    health = table(spark, "outlet_health", {"outlet": "bbc", "consecutive_failures": 3, "last_error": "boom", "last_new_story_at": T0 - 12 * hour}, {"outlet": "pbs"}, {"outlet": "nyt", "consecutive_failures": 9})
    stories = table(spark, "stories", story("a", first_seen_at=T0 - 2 * hour), story("b", outlet="nyt"))
    got = {r.name: r.ok for r in H.store_checks(health, stories, now, ["bbc", "pbs"], ["nyt"]).collect()}
    assert got == {"runs:bbc": False, "runs:pbs": True, "silence:bbc": True, "silence:pbs": False, "newest": False}
    assert H.push_check({}, 0)[1] is False and H.push_check({"last_ok_at_s": 0}, 1200)[1] and not H.push_check({"last_ok_at_s": 0}, 1260)[1]
    s = 10_000
    fine = {"news": {"newestTs": s * 1000 - 1, "lastPushAt": s * 1000 - 1, "pushedHeld": 5}}
    assert H.production_check(fine, s)[1] is True and H.production_check(None, s)[1] is False and H.production_check({}, s)[1] is None
    assert H.production_check({"news": {}, "evidenceScope": {"observingSinceMs": s * 1000 - 60_000}}, s)[1] is None and H.production_check({"news": {}}, s)[1] is False
    told, state = H.decide({}, [("a", False, "bad"), ("b", None, "?")], 0)
    assert "new: bad" in told and state["told"] == ["a"]
    assert H.decide(state, [("a", False, "bad")], 60)[0] is None
    told, state = H.decide(state, [("a", True, "fine")], 120)
    assert "recovered: a" in told and H.decide(state, [("a", True, "")], 121)[0] is None and H.decide(state, [("a", True, "")], 120 + 86400)[0]
    checks = spark.createDataFrame([(1, "a", True), (2, "a", False), (3, "a", None), (4, "a", False), (5, "a", True), (1, "b", False)], "at int, name string, ok boolean")
    assert sorted((r.at, r.name, r.change) for r in H.fold_alerts(checks).collect()) == [(1, "b", "new"), (2, "a", "new"), (4, "a", "still"), (5, "a", "recovered")]


def test_status(spark):
    tables = {n: table(spark, n) for n in schemas.TABLES}
    tables["stories"] = table(spark, "stories", story("a"), story("b", status="feed", format_flags=["live", "video"]))
    tables["outlet_health"] = table(spark, "outlet_health", {"outlet": "bbc"}, {"outlet": "pbs"})
    tables["verifications"] = table(spark, "verifications", {"story_id": "a", "outcome": "kept", "updated_at": T0}, {"story_id": "b", "outcome": "kept", "updated_at": T0})
    out = {k: [tuple(r) for r in v.collect()] for k, v in H.status(tables).items()}
    assert out["by_status"] == [("extracted", 1), ("feed", 1)] and [r[-1] for r in out["by_outlet"]] == [2, 0]
    assert out["by_day"] == [(T0.date(), {"kept": 2})] and out["by_flag"] == [("live", 2), ("video", 1)]
    calls = table(spark, "llm_calls", {"model": "a", "cost_usd": 1.5, "created_at": T0}, {"model": "b", "cost_usd": 2.0, "created_at": T0 - dt.timedelta(days=1)})
    assert H.spend_of_day(calls, F.lit(T0.date())).first()[0] == 1.5 and [r.model for r in H.served_models(calls, "a").collect()] == ["b"]


def test_same_content_same_id():
    assert hashing.item_hash(["a", None, ["x"]]) == hashing.item_hash(["a", None, ["x"]]) != hashing.item_hash(["b", None, ["x"]])


def test_messages_and_queues(spark):
    from meridian.operators import messages as Q

    df = table(spark, "stories", story("a", description=None), story("b", status="scraped"), story("c", status="scraped"))
    rows = df.join(table(spark, "story_texts", {"story_id": "a", "text": "word " * 4000}).select("story_id", "text"), "story_id", "left").withColumn("outlet_tags", Q.outlet_tags(F.create_map(F.lit("k"), F.array(F.lit(" x "), F.lit("x"))), ["k", "none"]))
    got = {r.story_id: r for r in Q.with_input_hash(rows.withColumn("m", Q.story_message()), "m").collect()}
    assert got["a"].m.startswith("Outlet: bbc\nHeadline: H\nLabels: x\n\nword") and got["a"].m.endswith("word") and len(got["a"].m) < 12_100 and got["b"].m.endswith("Labels: x")
    assert got["a"].input_hash != got["b"].input_hash == got["c"].input_hash
    read = table(spark, "extractions", {"story_id": "b", "config_hash": "old"}, {"story_id": "a", "config_hash": "now", "is_physical_event": True, "place_name": "P"})
    assert [r.story_id for r in Q.unread(df, read, "old", "scraped", 9).collect()] == ["c"]
    assert [r.story_id for r in Q.read_under_other_settings(df, read, "now", F.lit(T0)).collect()] == ["b"]
    found = table(spark, "resolutions", {"story_id": "a", "config_hash": "r", "extract_hash": "old"})
    assert [r.story_id for r in Q.unresolved(read, found, "now", "r", 9).collect()] == ["a"]
    pair = spark.createDataFrame([((("x", "H1"), ("y", "H2")))], "a struct<outlet:string,headline:string>, b struct<outlet:string,headline:string>")
    more = ["published", "hint", "place", "event_date"]
    for s in "ab":
        pair = pair.withColumn(s, F.struct(f"{s}.outlet", f"{s}.headline", *(F.lit(None).cast("string").alias(c) for c in more)))
    assert pair.select(Q.pair_message("a", "b")).first()[0] == "Story 1\nOutlet: x\nHeadline: H1\n\nStory 2\nOutlet: y\nHeadline: H2"
    assert pair.select(Q.pin_claim(F.lit("disaster"), F.lit("P"), F.lit("city"), F.lit(" a  b "))).first()[0] == "A disaster event happened at P, shown as a city. Quote: a b"


def test_signed_requests():
    import gzip

    headers, body = X.signed(b"{}", "s", "v1", 5)
    assert gzip.decompress(body) == b"{}" and headers["x-signature"] == hashing.sign("s", hashing.signing_text("v1", 5, b"{}"))


@pytest.mark.parametrize(("most", "target"), [(3, 50), (20, 1000), (1, 10), (7, 5)])
def test_batches_of_long_groups_are_those_of_the_fold(spark, most, target):
    rng = random.Random(most)
    rows = [(rng.choice(["a", "b", None]), i, rng.choice([1, 2, 9, 30, 200])) for i in range(400)] + [("short", 1000, 5)]
    df = spark.createDataFrame(rows, "g string, i long, size long").repartition(3)
    got = {r.i: r.batch for r in X.batched_rows(df, "g", "i", "size", most, target).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        batch = n = total = 0
        for _, i, size in sorted(r for r in rows if r[0] == g):
            if n and (n >= most or total + size > target):
                batch, n, total = batch + 1, 0, 0
            want[i] = batch
            n, total = n + 1, total + size
    assert got == want
