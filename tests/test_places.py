"""Made-up places: namesakes, a region that shares a town's name, codes that are missing, a place known by another name."""

import zipfile

import pytest

from meridian.operators import gazetteer as G
from meridian.sources import files

# id, name, ascii, lat, lon, class, code, country, admin1, admin2, population
PLACES = [
    (1, "Zedland", "Zedland", 50.0, 5.0, "A", "PCLI", "ZD", None, None, 9_000_000),
    (2, "Arden", "Arden", 52.0, 4.0, "A", "ADM1", "ZD", "AR", None, 2_000_000),
    (3, "Bravo", "Bravo", 48.0, 9.0, "A", "ADM1", "ZD", "BR", None, 3_000_000),
    (4, "Marnham", "Marnham", 52.1, 4.1, "P", "PPLA", "ZD", "AR", "AR1", 300_000),
    (5, "Marnham", "Marnham", 48.1, 9.1, "P", "PPL", "ZD", "BR", "BR1", 5_000),
    (6, "Westgate", "Westgate", 52.11, 4.12, "P", "PPLX", "ZD", "AR", "AR1", 0),
    (7, "Twinby", "Twinby", 52.3, 4.3, "P", "PPL", "ZD", "AR", None, 1000),
    (8, "Twinby", "Twinby", 48.3, 9.3, "P", "PPL", "ZD", "BR", None, 900),
    (9, "Larabel", "Larabel", 51.0, 8.0, "P", "PPL", "ZD", "AR", None, 0),
    (10, "Larabel", "Larabel", 47.0, 10.0, "A", "ADM1", "ZD", "LA", None, 800_000),
    (11, "Vila-Sorá", "Vila-Sora", 52.4, 4.5, "P", "PPL", "ZD", "AR", None, 50_000),
    (12, "Town Hall", "Town Hall", 52.1, 4.1, "S", "BLDG", "ZD", "AR", "AR1", 0),
    (13, "Nearby", "Nearby", 52.0, 4.0, "P", "PPL", "ZD", None, None, 0),
    (14, "Nearby", "Nearby", 52.1, 4.2, "P", "PPL", "ZD", None, None, 0),
    (15, "Marnham Marsh", "Marnham Marsh", 52.1, 4.1, "A", "ADM2", "ZD", "AR", "AR1", 400_000),
]
SCHEMA = "geonames_id long, name string, ascii_name string, latitude double, longitude double, feature_class string, feature_code string, country string, admin1 string, admin2 string, population long"


@pytest.fixture(scope="module")
def gazetteer(spark):
    places = spark.createDataFrame(PLACES, SCHEMA).cache()
    alternates = spark.createDataFrame([("sora town", 11, "wikipedia"), ("marnham city", 15, "wikipedia"), ("old marn", 4, "alternate"), ("ghost", 999, "alternate")], "folded string, geonames_id long, source string")
    return places, G.build_names(places, alternates).cache()


CASES = [
    # name, within, country, kind -> id, outcome
    ("Marnham", None, "ZD", "city", 4, "matched"),
    ("Marnham", "Bravo", "zd", "city", 5, "matched"),
    ("Westgate", "Marnham", "ZD", "district", 6, "matched"),
    ("Zedland", None, "ZD", "country", 1, "matched"),
    ("Arden", None, "ZD", "region", 2, "matched"),
    ("Acacia Avenue", "Marnham", "ZD", "street", 4, "climbed_no_match"),
    ("Acacia Avenue", "Nowhere", "ZD", "street", None, "no_match"),
    ("Twinby", None, "ZD", "city", None, "ambiguous"),
    ("Twinby", "Arden", "ZD", "city", 7, "matched"),
    ("Larabel", None, "ZD", "city", 10, "region_of_that_name"),
    ("Twinby", None, "ZD", "region", None, "only_towns"),
    ("Twinby", "Arden", "ZD", "region", 2, "climbed_only_towns"),
    ("Twinby", "Marnham", "ZD", "region", None, "only_towns"),
    ("VILA-SORA", None, "ZD", "city", 11, "matched"),
    ("Sora Town", None, "ZD", "city", 11, "matched"),
    ("Marnham City", None, "ZD", "city", None, "no_match"),
    ("old  marn", None, "ZD", None, 4, "matched"),
    ("Ghost", None, "ZD", None, None, "no_match"),
    ("  ", None, "ZD", "city", None, "no_name"),
    ("Marnham", None, None, "city", None, "no_country"),
    ("Marnham", None, "XX", "city", None, "no_match"),
    ("Town Hall", "Marnham", "ZD", "venue", 12, "matched"),
    ("Nearby", None, "ZD", "city", 13, "matched"),
]


def test_resolution(spark, gazetteer):
    places, names = gazetteer
    rows = [(str(i), *c[:4]) for i, c in enumerate(CASES)]
    queries = spark.createDataFrame(rows, "query_id string, name string, within string, country string, kind string").repartition(3)
    got = {int(r.query_id): r for r in G.resolve(queries, names, places).collect()}
    assert len(got) == len(CASES)
    for i, case in enumerate(CASES):
        r = got[i]
        assert (r.place.geonames_id if r.place else None, r.outcome) == case[4:], case
        assert r.climbed == r.outcome.startswith("climbed")
        assert r.pinnable == (r.precision in ("point", "district", "city"))


def test_display_names(spark, gazetteer):
    countries = spark.createDataFrame([("ZD", "Zedland")], "code string, name string")
    areas = spark.createDataFrame([("ZD.AR", "Arden", 1), ("ZD.AR.AR1", "Marnham Marsh", 2), ("ZD.LA", "Larabel", 1), ("ZD.BR", "B" * 200, 1)], "code string, name string, level int")
    got = {r.geonames_id: r.display_name for r in G.display_names(gazetteer[0], countries, areas).collect()}
    assert got[1] == "Zedland" and got[2] == "Arden, Zedland" and got[4] == "Marnham, Zedland"
    assert got[6] == "Westgate, Marnham Marsh, Zedland" and got[7] == "Twinby, Arden, Zedland" and got[10] == "Larabel, Zedland"
    assert got[13] == "Nearby, Zedland" and got[5] == "Marnham, Zedland"


def test_feed_places(spark, gazetteer):
    places, names = gazetteer
    rows = [("a", "Lost Hall", "Marnham", "ZD", "venue"), ("b", "Lost Road", "Marnham", "ZD", "street"), ("c", "Marnham", None, "ZD", "city"), ("d", "Town Hall", None, "ZD", "venue"), ("e", "Arden", None, "ZD", "region")]
    queries = spark.createDataFrame(rows, "query_id string, name string, within string, country string, kind string")
    shown = places.selectExpr("geonames_id", "name AS display_name")
    got = {r.query_id: (r.id, r.precision, r.fallback) for r in G.feed_places(G.resolve(queries, names, places), queries, shown).collect()}
    assert got == {"a": (4, "area", True), "c": (4, "area", False), "d": (12, "facility", False)}


def test_dumps(spark, tmp_path):
    line = lambda *f: "\t".join(map(str, f))
    (tmp_path / "places.txt").write_text(
        "\n".join([
            "# comment",
            line(1, ' Quo"ted ', "Quoted", "", 1.5, -2.5, "P", "PPL", "ZD", "", "AR", "", "", "", "12", "", "", "", ""),
            line(2, "Road", "", "", 1, 2, "R", "RD", "ZD", "", "", "", "", "", "0", "", "", "", ""),
            line(3, "Bad", "", "", "x", 2, "P", "PPL", "ZD", "", "", "", "", "", "0", "", "", "", ""),
            line(4, "Odd", "", "", 0, 0, "A", "ADM1", "ZD", "", "", "", "", "", "many", "", "", "", ""),
            "5\tshort",
        ])
    )
    got = {r.geonames_id: r for r in files.read_places(spark, str(tmp_path / "places.txt")).collect()}
    assert set(got) == {1, 4} and got[1].name == 'Quo"ted' and got[1].admin1 == "AR" and got[1].population == 12 and got[4].population == 0
    (tmp_path / "alt.txt").write_text(
        "\n".join([
            line(1, 10, "en", "Plain Name", "", "", "", ""),
            line(2, 10, "fr", "Nom", "", "", "", ""),
            line(3, 10, "fr", "Préféré", "1", "", "", ""),
            line(4, 10, "en", "Old", "1", "", "", "1"),
            line(5, 10, "post", "1234", "1", "", "", ""),
            line(6, 11, "link", "https://en.wikipedia.org/wiki/Lara_(state)#x", "", "", "", ""),
            line(7, 12, "link", "http://en.wikipedia.org/wiki/S%C3%A3o_Jo,_Texas", "", "", "", ""),
            line(8, 13, "link", "https://fr.wikipedia.org/wiki/Lara", "", "", "", ""),
            line(9, 14, "link", "https://en.wikipedia.org/wiki/File:X", "", "", "", ""),
            line(10, "x", "en", "No id", "", "", "", ""),
        ])
    )
    got = sorted((r.folded, r.geonames_id, r.source) for r in files.read_alternates(spark, str(tmp_path / "alt.txt")).collect())
    assert got == [("lara", 11, "wikipedia"), ("plain name", 10, "alternate"), ("prefere", 10, "alternate"), ("sao jo", 12, "wikipedia")]
    (tmp_path / "c.txt").write_bytes(b"#ISO\tx\r\nZD\tZED\t1\tZ\tZedland\r\n\tno\tcode\t\tX\r\n")
    assert [tuple(r) for r in files.read_countries(spark, str(tmp_path / "c.txt")).collect()] == [("ZD", "Zedland")]
    (tmp_path / "a.txt").write_text("ZD.AR\tArdén\tArden\t2\n")
    assert [tuple(r) for r in files.read_admin_areas(spark, str(tmp_path / "a.txt"), 1).collect()] == [("ZD.AR", "Ardén", 1)]


def test_dumps_in_archives(spark, tmp_path):
    lines = ["# c\tx", "ZD\tZED\t1\tZ\tZedland\r", *(f"C{i}\tx\t1\tz\tLand {i}" for i in range(25_000)), "short"]
    with zipfile.ZipFile(tmp_path / "dump.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("readme.txt", "not this")
        z.writestr("countries.txt", "\n".join(lines))
    got = {r.code: r.name for r in files.read_countries(spark, f"{tmp_path}/dump.zip#countries.txt").collect()}
    assert len(got) == 25_001 and got["ZD"] == "Zedland" and got["C24999"] == "Land 24999"


def test_incidents_merge_by_key(spark):
    make = lambda *rows: {n: spark.createDataFrame([(i, v) for i, v in rows], f"{k} string, v string") for n, k in files.INCIDENT_KEYS.items()}
    out = files.merge_incidents(make(("a", "old"), ("b", "old")), make(("b", "new"), ("c", "new")))
    assert all(sorted(map(tuple, t.collect())) == [("a", "old"), ("b", "new"), ("c", "new")] for t in out.values())


def test_rule_number(spark):
    meta = lambda v: spark.createDataFrame([("names_rule", v)] if v else [], "key string, value string")
    assert G.names_rule_is_old(meta(None)) and G.names_rule_is_old(meta("x")) and not G.names_rule_is_old(meta("2"))
