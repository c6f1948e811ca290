"""What keeps queries in proportion to their input: no table that grows is broadcast, and each different question is answered once."""

from datetime import datetime

from pyspark.sql import functions as F

from meridian.operators import cluster, gazetteer
from meridian.plans import catalog, inputs, relational

from .conftest import SF


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_stories_are_broadcast(spark):
    assert "BroadcastHashJoin" not in planned(catalog.QUERIES["alg03_candidate_pairs"](spark, SF))


def test_no_placement_broadcasts(spark, monkeypatch):
    """Every plan of a placement as it was run, also what its rounds store: no joined table is broadcast, however small it looks."""
    run, store = [], cluster.stored
    monkeypatch.setattr(cluster, "stored", lambda df: run.append(df) or store(df))
    for name in ("alg03_online_cluster", "alg03_cluster_rounds"):
        placed = catalog.QUERIES[name](spark, SF)
        placed.collect()
        run.append(placed)
    assert len(run) > 6 and not [plan for plan in map(planned, run) if "Broadcast" in plan]


def test_a_placement_makes_no_pairs_that_its_judge_never_joins(spark, monkeypatch):
    """The catalogue's judge wants more than headlines: no headline is met by its words, and no pair is looked at from both of its ends."""
    made, pairs = [], cluster.candidate_pairs
    monkeypatch.setattr(cluster, "rare_tokens", lambda *_: 1 / 0)
    monkeypatch.setattr(cluster, "candidate_pairs", lambda *a, **k: made.append(pairs(*a, **k)) or made[-1])
    assert catalog.QUERIES["alg03_cluster_rounds"](spark, SF).filter("verdict = 'same'").count() > 0
    assert made and all(r.founder_id < r.story_id for r in made[0].collect())  # numbers in the order of the stories


def test_some_reasons_give_their_part_of_all_pairs(spark):
    from meridian.plans.composite import _stories

    stories = _stories(spark, SF)
    at = {r.story_id: (r.published, r.story_id) for r in stories.collect()}
    rows = lambda *a, **k: {tuple(r) for r in cluster.candidate_pairs(stories, stories, *a, **k).collect()}
    every = rows()
    assert rows(earlier=True) == {r for r in every if at[r[1]] < at[r[0]]} and len(rows(earlier=True)) * 2 == len(every)
    assert rows(("place",)) == {r for r in every if r[2] is not None and r[2] <= 50}
    assert rows(("place", "entity")) == {r for r in every if r[2] is not None and r[2] <= 50 or r[3] is not None}


def test_guessed_sizes_do_not_grow_with_rounds(spark, monkeypatch):
    """A chain of stories takes a round for each link or two; what the driver thinks a round reads must not be the square of the round before."""
    names = [f"s{i:02}" for i in range(16)]
    stories = spark.createDataFrame([(n, "o", n, datetime(2024, 1, 1, i)) for i, n in enumerate(names)], "story_id string, outlet string, primary_alias string, published timestamp")
    pairs = spark.createDataFrame([(b, a, True) for a, b in zip(names, names[1:])], "story_id string, founder_id string, same boolean")
    sizes, store = [], cluster.stored
    monkeypatch.setattr(cluster, "stored", lambda df: sizes.append(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) or store(df))
    placed = {r.story_id: r.compared_to for r in cluster.place(stories, pairs, 0).collect()}
    assert placed == {n: names[i - 1] if i % 2 else None for i, n in enumerate(names)}
    assert len(sizes) > 10 and max(map(len, sizes[3:])) < 40


def test_a_pair_with_several_reasons_comes_once(spark):
    row = lambda k, hour, lat, entities, headline: (k, "o", k, headline, datetime(2024, 1, 1, hour), "C1", entities, lat, 10.0 if lat is not None else None, [])
    stories = spark.createDataFrame(
        [
            row("a", 0, 50.0, ["X", "Y"], "flood river town"),
            row("b", 1, 50.1, ["y", "x"], "flood river town"),
            row("c", 2, 59.0, ["x", "y"], "flood river city"),
            row("d", 3, None, [], "town flood river"),
            row("e", 4, 50.0, ["z"], "vote"),
        ],
        "story_id string, outlet string, primary_alias string, headline string, published timestamp, country string, entities array<string>, latitude double, longitude double, format_flags array<string>",
    )
    pairs = [(r.story_id, r.founder_id) for r in cluster.candidate_pairs(stories, stories).collect()]
    want = {("a", "b"), ("a", "c"), ("b", "c"), ("a", "d"), ("b", "d"), ("c", "d"), ("a", "e"), ("b", "e")}
    assert sorted(pairs) == sorted(want | {(y, x) for x, y in want})
    assert cluster.pair_bound(stories) == len(want)


def test_questions_are_ranked_by_a_few_places_each(spark):
    """Of the places that go by a name, two of each precision get to where a question is judged."""
    assert "WindowGroupLimit" in planned(catalog.QUERIES["alg01_resolve"](spark, SF))


def test_a_region_of_that_name_is_found_behind_others(spark):
    """An empty town, of whose namesakes among regions the first two contain it and the third doesn't."""
    place = lambda k, cls, code, admin1, people, lat: (k, "Alba", None, lat, 10.0, cls, code, "C1", admin1, None, people)
    schema = "geonames_id long, name string, ascii_name string, latitude double, longitude double, feature_class string, feature_code string, country string, admin1 string, admin2 string, population long"
    places = spark.createDataFrame([place(1, "P", "PPL", "A", 0, 50.0), *(place(k, "A", "ADM1", "A", 900 - k, 50.0) for k in (2, 3)), place(4, "A", "ADM1", "B", 5, 60.0)], schema)
    names = gazetteer.build_names(places, spark.createDataFrame([], "folded string, geonames_id long, source string"))
    queries = spark.createDataFrame([(k, "Alba", None, "c1", "city") for k in range(3)] + [(9, None, None, None, None)], "query_id long, name string, within string, country string, kind string")
    got = {r.query_id: (r.outcome, r.place and r.place.geonames_id) for r in gazetteer.resolve(queries, names, places).collect()}
    assert got == {0: ("region_of_that_name", 4), 1: ("region_of_that_name", 4), 2: ("region_of_that_name", 4), 9: ("no_name", None)}


def test_rows_are_made_in_fixed_partitions(spark):
    """Joins that make far more than they read are dealt by number, whatever the bytes of their input."""
    for name in ("jn11_gazetteer_candidates", "jn17_contained"):
        assert "REPARTITION_BY_NUM" in planned(catalog.QUERIES[name](spark, SF)), name


def test_feeds_are_files_of_many_users(spark):
    """Feeds in few files, from which as many items are read as there are events."""
    events = spark.read.parquet(f"{SF}/events.parquet")
    users = events.select("user_id").distinct().count()
    for atom, name in ((True, "src03_atom"), (False, "src01_rss")):
        assert len(spark.read.text(inputs._xml(spark, SF, atom)).inputFiles()) <= users / 4
        assert catalog.QUERIES[name](spark, SF).count() == events.count()


def test_containers_are_put_into_the_squares_that_they_reach(spark):
    """Not into all around them; and what meets by a code or a country is ids, of which none are broadcast."""
    spots = spark.range(-70, 70).select((F.col("id") + 0.3).alias("lat"), (F.col("id") * 2.5 + 0.3).alias("lon"))
    sizes = spots.select(*(F.max(F.size(gazetteer.geo.cells_around("lat", "lon", km, 2.0))) for km in (30, 150))).first()
    assert sizes[0] <= 4 and sizes[1] <= 18
    plan = planned(catalog.QUERIES["jn17_contained"](spark, SF))
    assert "Broadcast" not in plan and "struct(" not in plan


def test_questions_are_moved_once(spark):
    """To where they meet their places, and told apart there; one that is asked twice by the same query still comes once."""
    assert "hashpartitioning(query_id" not in planned(catalog.QUERIES["jn11_gazetteer_candidates"](spark, SF))
    places = spark.createDataFrame([(1, "Alba", "alba", 0.0, 0.0, "P", "PPL", "C1", None, None, 5), (2, "Alba", "Albe", 0.0, 0.0, "P", "PPL", "", None, None, 5)], "geonames_id long, name string, ascii_name string, latitude double, longitude double, feature_class string, feature_code string, country string, admin1 string, admin2 string, population long")
    names = gazetteer.build_names(places, spark.createDataFrame([("alba", 1, "alternate")], "folded string, geonames_id long, source string"))
    queries = spark.createDataFrame([(1, "Alba", "c1"), (1, " ALBA", "C1 "), (2, "alba", "c1"), (3, "alba", ""), (4, "", "c1")], "query_id long, name string, country string")
    assert sorted((r.query_id, r.place.geonames_id) for r in gazetteer.candidates(queries, names, places).collect()) == [(1, 1), (2, 1)]


def test_headlines_are_told_apart_by_bits_where_they_meet(spark):
    """Most pairs that share a word go by a number; of headlines of all lengths none that overlaps enough is lost, nor comes twice or from a later founder."""
    import random

    plan = planned(catalog.QUERIES["alg03_candidate_pairs"](spark, SF))
    assert "bit_count" in plan and "xxhash64(country" in plan
    rng = random.Random(9)
    words = [f"word{k}" for k in range(40)]
    texts = [rng.sample(words, rng.choice([1, 2, 3, 5, 9, 20, 40])) for _ in range(90)]
    rows = [(str(i), "o", str(i), " ".join(t), datetime(2024, 1, 1, i % 24), "C1", [], None, None, []) for i, t in enumerate(texts)]
    stories = spark.createDataFrame(rows, "story_id string, outlet string, primary_alias string, headline string, published timestamp, country string, entities array<string>, latitude double, longitude double, format_flags array<string>")
    want = {(str(i), str(j)) for i, a in enumerate(texts) for j, b in enumerate(texts) if i != j and len(set(a) & set(b)) / len(set(a) | set(b)) >= 0.34}
    got = [(r.story_id, r.founder_id) for r in cluster.candidate_pairs(stories, stories).collect()]
    assert sorted(got) == sorted(want) and 2 * cluster.pair_bound(stories) == len(want) > 200


def test_streams_meet_in_cells_of_time(spark, tmp_path):
    """A row is compared to those of its cell of four days: of a country's founders in a year, to few."""
    from meridian.streaming import flows

    src, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 7919)
    spark.range(600).select("id", (F.col("id") % 2 == 0).alias("founds"), F.when(F.col("id") % 3 != 0, F.lit("GB")).alias("country"), at.alias("at")).coalesce(1).write.parquet(src)
    events = flows.read_stream(spark, src, "id long, founds boolean, country string, at timestamp")
    a = events.filter("NOT founds").selectExpr("id AS story_id", "country", "at AS published")
    b = events.filter("founds").selectExpr("id AS cluster_id", "country AS founder_country", "at AS founder_published")
    met = flows.near_founders(a, b)
    assert "345600" in met._jdf.queryExecution().analyzed().toString()
    flows.run_once(met, lambda df, n: df.write.mode("append").parquet(out), state, "append")
    got = sorted((r.story_id, r.cluster_id) for r in spark.read.parquet(out).collect())
    assert got == sorted((s, f) for s in range(1, 600, 2) for f in range(0, 600, 2) if abs(s - f) * 7919 <= 48 * 3600 and (s % 3 == 0) == (f % 3 == 0))


def test_documents_are_read_once_and_in_bounded_files(spark, monkeypatch):
    """Rows for the store: documents that are read whole hold a bounded number of items, and the registry doesn't have them read again."""
    paths, write = [], inputs._xml
    monkeypatch.setattr(inputs, "_xml", lambda *a: paths.append(write(*a)) or paths[-1])
    plan = planned(catalog.QUERIES["src06_base_rows"](spark, SF))
    assert "Cartesian" not in plan and "Broadcast" in plan
    items = spark.read.text(paths[0], wholetext=True).select(F.size(F.split("value", "</item>")) - 1)
    assert sorted(r[0] for r in items.collect()) == [1000] * (spark.read.parquet(f"{SF}/events.parquet").count() // 1000)


def test_streams_of_files_with_the_same_days(spark, tmp_path):
    """A table in files that each go through all days: no row is too late, and what is appended is not dealt anew to find its last."""
    import duckdb

    events = spark.read.parquet(f"{SF}/events.parquet")
    for k in range(3):
        events.filter(f"event_id % 3 = {k}").coalesce(1).write.mode("append").parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF}/events.parquet')")
    for name in ("stm04_interval_stream", "stm07_leaders_stream", "stm07_indexed_stream"):
        df = catalog.QUERIES[name](spark, str(tmp_path))
        want = con.execute(catalog.SQL[name])
        names = [c[0] for c in want.description]
        assert sorted(map(str, df.select(*names).toPandas().astype(str).values.tolist())) == sorted(map(str, want.fetch_df().astype(str).values.tolist())), name
        assert "Exchange" not in planned(df), name


def test_same_is_asked_once_of_two_kinds():
    """Stories and founders with the same fields, of which there may be many, are compared once."""
    from meridian.streaming import flows

    asked, hour = [], 3600.0
    known = flows._Known(lambda a, b: asked.append((a, b)) or a == b, 48 * hour, [])
    want = []
    for i in range(400):
        at, mine = i * hour, ([f"w{i % 3}"],)
        first = known.first(at, mine)
        assert first == min((f for f in want if f[2] == mine and at - f[0] <= 48 * hour), default=(None,))[:2] if first else not any(f[2] == mine and at - f[0] <= 48 * hour for f in want)
        if first is None:
            want.append((at, f"s{i}", mine))
            known.add((f"s{i}", at, *mine))
    assert len(want) > 20 and len(asked) <= 9 * len(want)


def test_near_founders_meet_in_small_cells(spark):
    """Pairs of a country are made by many tasks: rows are dealt by number and hours, not by windows of two days."""
    plan = planned(catalog.QUERIES["flt08_near_founders"](spark, SF))
    assert "REPARTITION_BY_NUM" in plan and "21600" in plan


def test_a_text_is_normalised_once_for_its_evidence(spark):
    assert planned(catalog.QUERIES["str17_trim_evidence"](spark, SF)).count(r"\s+") <= 2


def test_python_sees_references_not_texts(spark):
    """Texts with references of all kinds as html.unescape has them, of which Python gets each different one once."""
    import html
    import random

    from pyspark.sql import functions as F

    from meridian.functions import text as T

    rng = random.Random(5)
    parts = ["&amp;", "&amp", "&ampx;", "&notit;", "&#65;", "&#x41", "&#xZ", "&#0;", "&#128;", "&", "&&", "& ", "&lt;b&gt;", "&CounterClockwiseContourIntegral;", "&" + "a" * 40, "\U0001f600", "x", " y", "&é;", "&#1114112;", "&eacuteé", "$1\\"]
    rows = [("".join(rng.choices(parts, k=rng.randrange(0, 12))),) for _ in range(300)] + [(None,), ("",), ("&",)]
    df = spark.createDataFrame(rows, "t string")
    got = df.select("t", F.get(T._decoded(F.array("t")), F.lit(0)).alias("x")).collect()
    assert all(r.x == (html.unescape(r.t) if r.t is not None else None) for r in got)


def test_pairs_that_meet_go_by_their_bitmaps(spark):
    """Headlines that all share a rare word and little else: of 780 pairs few get to where tokens are compared, and none that counts is lost."""
    texts = [" ".join(["shared", *(f"w{i * 31 + k}" for k in range(10))]) for i in range(38)] + ["shared alpha beta gamma", "shared alpha beta delta"]
    rows = spark.createDataFrame([(i, "en", x.split()) for i, x in enumerate(texts)], "doc_id long, lang string, t array<string>")
    got = [(r.a, r.b, r.overlap) for r in relational.overlapping(rows, "doc_id", "lang", "t", 0.34).collect()]
    assert got == [(38, 39, 0.6)]
    hashed = rows.select("doc_id", "lang", F.transform("t", lambda w: F.xxhash64(w)).alias("t"))  # "shared" comes first in each
    met = {(r.a, r.b) for r in relational.may_overlap(hashed, "doc_id", "lang", 0.05).collect()}
    every = {(r.a, r.b) for r in relational.overlapping(rows, "doc_id", "lang", "t", 0.05).collect()}
    assert every <= met
    few = {(r.a, r.b) for r in relational.may_overlap(hashed, "doc_id", "lang", 0.34).collect()}
    assert (38, 39) in few and len(few) < 40


def test_what_rounds_of_listings_read_is_written_once(spark, monkeypatch):
    """Each round reads what is stored already; it must not be worked out anew each time."""
    given, plain = [], inputs.listings.read_listings
    monkeypatch.setattr(inputs.listings, "read_listings", lambda sections, list_page, known, seen_in: given.extend((known, seen_in)) or plain(sections, list_page, known, seen_in))
    assert catalog.QUERIES["src27_paged_listings"](spark, SF).count() > 0
    assert len(given) == 2 and not any("Aggregate" in planned(df) for df in given)


def test_items_are_read_back_once(spark):
    """Not once for each of their eleven fields."""
    assert "get_json_object" not in planned(catalog.QUERIES["flt15_items"](spark, SF))
