"""Rules that the driver has for one value, as operators over tables, and containment without all pairs."""

import io
import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from meridian.functions import geo, hashing
from meridian.operators import export as X
from meridian.operators import gazetteer as G
from meridian.operators import snapshot as S
from meridian.sources import feeds, files

PLACE = "geonames_id long, country string, latitude double, longitude double, feature_class string, feature_code string, admin1 string, admin2 string"


def test_containers_by_cells_are_those_of_all_pairs(spark):
    """Random places, many of them near the poles and the date line, half of the codes missing."""
    rng = random.Random(8)
    spots = [(89.9, 10), (89.5, -170), (-89.95, 0), (0, 179.95), (0, -179.95), (60, 179.5), (60, -179.9), (85, 30), (45, 0.01), (45, -0.01)]
    rows = []
    for i in range(400):
        lat, lon = rng.choice(spots)
        kind, code = rng.choice([("P", "PPL"), ("A", "ADM1"), ("A", "ADM2"), ("A", "PCLI"), ("S", "BLDG"), ("P", "PPLX"), ("A", "ADM3")])
        rows.append((i, rng.choice("XY"), max(-90.0, min(90.0, lat + rng.uniform(-1.5, 1.5))), (lon + rng.uniform(-2, 2) + 180) % 360 - 180, kind, code, rng.choice(["1", "2", None]), rng.choice(["5", "6", None])))
    places = G.with_precision(spark.createDataFrame(rows, PLACE))
    containers = places.filter("geonames_id % 2 = 0")
    p, c = places.alias("p"), containers.alias("c")
    fields = ["latitude", "longitude", "feature_code", "admin1", "admin2", "precision"]
    whole = p.join(c, F.col("p.country") == F.col("c.country")).filter(G.inside(F.struct(*(F.col(f"p.{f}").alias(f) for f in fields)), F.struct(*(F.col(f"c.{f}").alias(f) for f in fields))))
    want = {tuple(r) for r in whole.select("p.geonames_id", "c.geonames_id").collect()}
    for degrees in (0.5, 1.0, 4.0):
        got = [tuple(r) for r in G.contained(places, containers, degrees).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert len(want) > 3000
    assert G.contained(places.limit(0), containers).count() == 0


def test_a_circle_lies_within_its_cells(spark):
    rng = random.Random(1)
    pairs = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(300)] + [(90.0, 0.0), (-90.0, 180.0), (0.0, -180.0)]
    rows = [(a, b, max(-90.0, min(90.0, a + rng.uniform(-1, 1))), b + rng.uniform(-3, 3) if abs(a) < 80 else rng.uniform(-180, 180)) for a, b in pairs for _ in range(20)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").filter(geo.distance_km("a", "b", "c", "d") <= 100)
    missed = df.filter(~F.array_contains(geo.cells_around("a", "b", 100, 0.7), geo.cell("c", "d", 0.7)))
    assert df.count() > 500 and missed.count() == 0


def test_frames_as_rows(spark):
    outlets = [{"outlet": o} for o in S.OUTLETS]
    whole = {"schema": S.SCHEMA, "snapshotId": "snap_" + "0" * 16, "generatedAt": "2024-01-01T00:00:00Z", "dataAsOf": "2024-01-01T00:00:00Z", "pinsWithheld": False, "worldNewsWithheld": False, "outlets": outlets, "items": []}
    rng = random.Random(6)
    odd = {
        "schema": [1, "x"], "snapshotId": ["snap_", "snap_" + "g" * 16], "generatedAt": ["now"], "dataAsOf": ["2024"], "pinsWithheld": [True, "yes", 1], "worldNewsWithheld": [True, "no"],
        "outlets": [[], outlets[1:], outlets + outlets[:2], [{"outlet": "zz"}, *outlets]], "items": [[{"location": {"lat": 1}}], [{"x": 1}], [{}] * (S.MAX_ITEMS + 1)],
    }
    bodies = [whole]
    for _ in range(60):
        body = dict(whole)
        for k in rng.sample(sorted(odd), rng.randrange(1, 4)):
            if rng.random() < 0.2:
                del body[k]
            else:
                body[k] = rng.choice(odd[k])
        if rng.random() < 0.2:
            body["more"] = 1
        bodies.append(body)
    df = spark.createDataFrame([(i, json.dumps(b)) for i, b in enumerate(bodies)] + [(-1, "[]"), (-2, None), (-3, "{")], "i int, body string")
    got = {}
    for r in S.frame_problems(df, "i", "body").collect():
        got.setdefault(r.i, []).append(r.problem)
    assert {i: sorted(v) for i, v in got.items() if i >= 0} == {i: sorted(p) for i, b in enumerate(bodies) if (p := S.body_problems(b))}
    assert [got[i] for i in (-1, -2, -3)] == [["not an object"]] * 3


def test_jobs_of_tables(spark):
    rng = random.Random(3)
    sections = {f"s{i}": [f"x{j}" for j in rng.sample(range(9), rng.randrange(1, 5))] for i in range(8)}
    groups = {f"g{i}": rng.sample(sorted(sections), 3) for i in range(3)}
    wanted = [rng.choice([*groups, *sections]) for _ in range(7)]
    table = lambda rows, schema: spark.createDataFrame(rows, schema)
    rows, unknown = feeds.jobs(
        table([*enumerate(wanted), (99, "no")], "position long, name string"),
        table([(s, i, x) for s, xs in sections.items() for i, x in enumerate(xs)], "source string, position long, section string"),
        table([(g, i, s) for g, xs in groups.items() for i, s in enumerate(xs)], "name string, position long, source string"),
    )
    assert [(r.source, r.section) for r in rows.orderBy("n").collect()] == feeds.build_jobs(wanted, sections, groups) and [r.name for r in unknown.collect()] == ["no"]


def test_small_rules(spark):
    meta = spark.createDataFrame([("a", "names_rule", "1"), ("b", "names_rule", "2"), ("c", "names_rule", "x"), ("d", "other", "9"), ("e", "names_rule", None)], "build string, key string, value string")
    assert {r.build: (r.rule, r.is_old) for r in G.names_rules(meta).collect()} == {"a": (1, True), "b": (2, False), "c": (1, True), "d": (1, True), "e": (1, True)}
    limits = spark.createDataFrame([("c", 5), ("", 5), (None, 99_999)], "cursor string, n long").select(X.run_limits(F.col("cursor"), F.col("n")).alias("x")).collect()
    assert [r.x for r in limits] == [X.run_limit("c", 5), X.run_limit("", 5), X.run_limit(None, 99_999)]
    good = hashing.sign("s", "text")
    rows = [("text", good, 0.0, 300.0), ("text", good, 0.0, 300.5), ("text", good, 300.0, 0.0), ("other", good, 0.0, 0.0), ("text", "x", 0.0, 0.0), ("text", None, 0.0, 0.0), (None, good, 0.0, 0.0), ("text", good, None, 0.0)]
    df = spark.createDataFrame(rows, "t string, g string, a double, b double")
    assert [r.x for r in df.select(hashing.is_verified("s", "t", "g", "a", "b").alias("x")).collect()] == [True, False, True, False, False, False, False, False]


def test_archives_side_by_side(spark, tmp_path):
    for name, lines in (("a", ["1\tx", "é"]), ("b", [str(i) for i in range(25_000)]), ("c", [])):
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("in.txt", "\n".join(lines))
            z.writestr("other.txt", "no")
    found = files.zip_lines(spark, f"file://{tmp_path}/*.zip", "in.txt")
    assert sorted(r.value for r in found.collect()) == sorted(["1\tx", "é", *map(str, range(25_000))])
    bad = spark.createDataFrame([(bytearray(b"no zip"),)], "content binary")
    with pytest.raises(Exception, match="zip"):
        files.archive_lines(bad, "in.txt").count()
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("other.txt", "x")
    with pytest.raises(Exception, match="in.txt"):
        files.archive_lines(spark.createDataFrame([(bytearray(out.getvalue()),)], "content binary"), "in.txt").count()
    assert files.archive_lines(spark.createDataFrame([(None,)], "content binary"), "in.txt").count() == 0


def test_hashes_of_settings(spark):
    rows = [(0, '{"b": 1, "a": {"y": "é", "x": [1.5, null]}}', '{"k":2}'), (1, None, ""), (2, "{", "[]"), (3, " {} ", '{"k": 2 }')]
    found = hashing.config_hashes(spark.createDataFrame(rows, "i int, e string, v string"), {"extract": "e", "verify": "v"}).orderBy("i").collect()
    read = lambda x: json.loads(x) if x and x != "{" else {}
    for r, (_, e, v) in zip(found, rows, strict=True):
        want = hashing.ConfigHashes({"extract": read(e), "verify": read(v)})
        assert {s: r[f"{s}_hash"] for s in hashing.ConfigHashes.DEPENDS} == {s: want.of(s) for s in hashing.ConfigHashes.DEPENDS}
