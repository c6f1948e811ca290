import pytest
from pyspark.sql import functions as F

from meridian.functions import geo, hashing, jsons, text as T, times


def each(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", fn(F.col("v")).alias("x")).orderBy("i").collect()]


def test_clean_text(spark):
    got = each(spark, ["<p>A &amp; B​C</p>\n  d ", "plain", "x &lt;b&gt;", None], T.clean_text)
    assert got == ["A & BC d", "plain", "x <b>", None]


def test_fold(spark):
    assert each(spark, ["  Zürich  West", "STRASSE", "Straße", "Łódź", "Ｏdesa"], T.fold) == ["zurich west", "strasse", "strasse", "łodz", "odesa"]


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("HTTPS://Www.Example.ORG:443/A/b/?q=1#x", "https://www.example.org/A/b"),
        ("http://example.org:8080/", "http://example.org:8080"),
        ("http://u:p@Example.org/x/", "http://example.org/x"),
        (" no scheme ", "no scheme"),
        ("  ", None),
    ],
)
def test_canonical_url(spark, url, want):
    assert each(spark, [url], T.canonical_url) == [want]


def test_url_sections(spark):
    urls = ["https://x.org/2026/09/10/arts/design/slug.html", "https://x.org/world/middle-east/slug", "https://x.org/mideast/2026/09/13/slug", "https://x.org/slug", "https://x.org/", None]
    assert each(spark, urls, T.url_sections) == [["arts", "design"], ["world", "middle-east"], ["mideast"], [], [], []]


def test_names_and_lists(spark):
    assert each(spark, ["Ann Lee, Bo Ek, and Cy Day, and, Ann Lee"], T.split_authors) == [["Ann Lee", "Bo Ek", "Cy Day"]]
    assert each(spark, ["a.jpg 100w, b.jpg 300w, c.jpg 300w", "only.jpg"], T.largest_srcset) == ["b.jpg", "only.jpg"]
    assert each(spark, ["The Quick, quick storm of 2026 at sea"], T.headline_tokens) == [["quick", "storm", "2026", "sea"]]


def test_trim_evidence(spark):
    words = " ".join(f"word{i}" for i in range(80))
    df = spark.createDataFrame([(words, "word60"), (words, "absent"), ("short  text", "x"), (None, "x"), (words, "word79"), (words, "word0")], "q string, p string")
    got = [r.x for r in df.select(T.trim_evidence("q", "p").alias("x")).collect()]
    assert "word60" in got[0] and len(got[0]) <= 200 and got[0] in words and got[0].split()[0] in words.split()
    assert got[1].startswith("word0 ") and len(got[1]) <= 200 and got[2] == "short text" and got[3] is None
    assert got[4].endswith("word79") and got[5].startswith("word0")


def test_evidence(spark):
    rows = [
        ("Yasser told Reuters in Aleppo that it was quiet.", "Aleppo", "spoken_to_a_reporter"),
        ("Strikes hit the base in Jordan, an official told Reuters.", "Jordan", None),
        ("He is scheduled to appear in Miami.", "Miami", "planned"),
        ("SUWON, South Korea, Nov. 4 (Yonhap) -- The team won again.", "Suwon", "dateline"),
        ("SUWON, South Korea, Nov. 4 (Yonhap) -- A fire in Suwon killed two.", "Suwon", None),
        ("A place (like) this. told the BBC near A.C+ yes", "A.C+", "spoken_to_a_reporter"),
    ]
    df = spark.createDataFrame(rows, "q string, n string, want string")
    assert [r.x for r in df.select(T.evidence_failure("q", "n").alias("x")).collect()] == [r[2] for r in rows]


def test_restates(spark):
    rows = [("Guangzhou", "Guangzhou Shi", True), ("London", "Greater London", False), ("York", "Yorkshire", False), ("Dublin", "dublin", True), ("", "x", False)]
    df = spark.createDataFrame(rows, "a string, b string, w boolean")
    assert [r.x for r in df.select(T.restates("a", "b").alias("x")).collect()] == [r[2] for r in rows]


def test_redact_and_shorten(spark):
    assert each(spark, ["see https://me:secret@h.org/x and ftp://a:b@c"], T.redact) == ["see https://***:***@h.org/x and ftp://***:***@c"]
    assert each(spark, ["a  b", "x" * 300], T.shorten) == ["a b", "x" * 197 + "..."]


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ("2026-11-05T09:00:00Z", "2026-11-05T09:00:00Z"),
        ("2026-11-05T09:00:00+02:00", "2026-11-05T07:00:00Z"),
        ("2026-11-05 09:00:00.75", "2026-11-05T09:00:00Z"),
        ("Thu, 05 Nov 2026 09:00:00 GMT", "2026-11-05T09:00:00Z"),
        ("Thu, 5 Nov 2026 09:00:00 -0500", "2026-11-05T14:00:00Z"),
        ("05 Nov 2026 09:00:00 EST", "2026-11-05T14:00:00Z"),
        ("1762333200", "2025-11-05T09:00:00Z"),
        ("1762333200000", "2025-11-05T09:00:00Z"),
        ("2026/11/5", "2026-11-05T00:00:00Z"),
        ("Tuesday 3 November 2026", "2026-11-03T00:00:00Z"),
        ("2026-02-31", None),
        ("soon", None),
        ("", None),
        (None, None),
    ],
)
def test_utc(spark, given, want):
    assert each(spark, [given], lambda c: times.iso(times.utc(c))) == [want]


def test_windows(spark):
    df = spark.sql("SELECT timestamp '2026-11-05 00:00:00' AS a, timestamp '2026-11-07 00:00:00' AS b, timestamp '2026-11-07 00:00:01' AS c, cast(null AS timestamp) AS d")
    assert tuple(df.select(*(times.within_hours("a", x) for x in "bcd")).first()) == (True, False, False)
    df = spark.sql("SELECT explode(sequence(date '2026-11-01', date '2026-11-07')) AS e, timestamp '2026-11-05 13:00:00' AS p")
    assert [r.x for r in df.orderBy("e").select(times.date_in_window("e", "p").alias("x")).collect()] == [False, True, True, True, True, True, False]


def test_geo(spark):
    df = spark.sql("SELECT 51.5074 AS a, -0.1278 AS b, 48.8566 AS c, 2.3522 AS d")
    assert abs(df.select(geo.distance_km("a", "b", "c", "d")).first()[0] - 343.556) < 1
    assert each(spark, ["1.5", "1.0", "2", "1.0E-5", "1.23e-05", "12.345678"], geo.decimals) == [1, 0, 0, 5, 7, 6]
    assert each(spark, ["courts_and_justice", "disaster", "other", None], geo.can_pin) == [False, True, True, True]


def test_hashes(spark):
    df = spark.createDataFrame([("bbc", "x")], "o string, a string")
    got = df.select(hashing.story_id("o", "a"), hashing.cluster_id("o", "a"), hashing.text_hash(F.lit(" a  b ")), hashing.text_hash(F.lit("  "))).first()
    import hashlib

    digest = hashlib.sha256(b"bbc\nx").hexdigest()
    assert tuple(got) == (f"st_{digest[:16]}", f"nf_{digest[:12]}", hashlib.sha256(b"a b").hexdigest(), None)
    assert hashing.snapshot_id({"a": 1, "snapshotId": "x", "generatedAt": "y"}) == hashing.snapshot_id({"a": 1})
    h = hashing.ConfigHashes({"extract": {"v": 1}})
    assert h.of("cluster") != hashing.ConfigHashes({"extract": {"v": 2}}).of("cluster") and h.of("resolve") == hashing.ConfigHashes({"extract": {"v": 1}, "cluster": {"z": 1}}).of("resolve")
    text = hashing.signing_text("p", 5, "é".encode())
    assert hashing.verified("s", text, hashing.sign("s", text), 100, 350) and not hashing.verified("s", text, hashing.sign("s", text), 100, 500) and not hashing.verified("t", text, hashing.sign("s", text), 100, 101)


def test_json(spark):
    assert each(spark, ['["a", " ", 3]', '{"k": 1, "l": 2}', "[broken", None, "7"], jsons.string_list) == [["a", "3"], ["k", "l"], [], [], []]
    assert each(spark, ['{"verdict": " Same "}', '{"verdict": "maybe"}', "x"], jsons.verdict) == ["same", "unsure", "unsure"]
    got = each(spark, ['{"a": "", "b": {"c": "x"}}', '{"a": []}'], lambda c: jsons.first_of(F.parse_json(c), "$.a", "$.b.c"))
    assert got == ["x", None]


def test_signatures_are_hmacs(spark):
    texts = ["", "a", "naïve\ntext", "x" * 200]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for secret in ("", "short", "k" * 64, "a key of more than one block " * 4):
        got = [r.s for r in df.select(hashing.signature(secret, "t").alias("s")).collect()]
        assert got == [hashing.sign(secret, t) for t in texts]


def test_item_hashes_of_texts(spark):
    texts = ['{"a":"b"}', 'back\\slash "q"', "é漢", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.h for r in df.select(hashing.text_item_hash("t").alias("h")).collect()] == [hashing.item_hash([t]) for t in texts]


def test_waits_grow_and_are_capped(spark):
    rows = [(1, 0.0, None, 0.5), (1, 1.0, "", 1.5), (3, 0.5, "soon", 4.0), (20, 0.5, None, 60.0), (0, 0.5, None, 1.0), (5, 0.0, " 7 ", 7.0), (5, 0.0, "900", 60.0), (5, 0.0, "-3", 0.0)]
    df = spark.createDataFrame(rows, "n int, j double, a string, w double")
    assert all(r.w == r.x for r in df.withColumn("x", times.retry_delay("n", F.col("j"), retry_after="a")).collect())


def test_first_of_skips_objects(spark):
    df = spark.createDataFrame([('{"a":{"b":"x"},"c":"y"}',), ('{"a":["z"],"c":5}',), ('{"a":" t "}',)], "j string").withColumn("v", F.try_parse_json("j"))
    assert [r.x for r in df.select(jsons.first_of("v", "$.a", "$.a.b", "$.c").alias("x")).collect()] == ["x", "5", "t"]


def test_texts_of_arrays_are_cleaned_as_single_ones(spark):
    rows = [["<b>A</b>  &amp; b", None, "x\u200b y\u00a0z"], [], None, ["plain", " & "]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, a array<string>")
    got = [r.x for r in df.select("i", T.clean_texts("a").alias("x")).orderBy("i").collect()]
    assert got == [["A & b", None, "x y z"], [], None, ["plain", "&"]]
