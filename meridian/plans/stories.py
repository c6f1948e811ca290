"""The store's operators over the store of plans/store.py, each beside SQL that says by itself what they have to give."""

from __future__ import annotations

from pyspark.sql import functions as F

from meridian import schemas
from meridian.functions import geo, hashing, times
from meridian.functions.text import STOP_WORDS
from meridian.operators import checks as C
from meridian.operators import cluster as K
from meridian.operators import export as X
from meridian.operators import gazetteer as G
from meridian.operators import health as H
from meridian.operators import identity as I
from meridian.operators import merge as M
from meridian.operators import messages as Q
from meridian.operators import snapshot as S
from meridian.plans.registry import query, table
from meridian.plans.store import over_store, store
from meridian.sources import feeds, pages

HASHES = {"extract": "e1", "resolve": "r1", "cluster": "k1"}
DROPPED = "('guardian', 'nyt')"


def at(text: str):
    return F.lit(text).cast("timestamp")


def seconds(c):
    return F.unix_timestamp(c)


def km(a: str, b: str) -> str:
    """SQL for the great-circle distance of two points with columns latitude and longitude."""
    return (
        f"2 * 6371.0088 * asin(sqrt(least(1, pow(sin((radians({b}.latitude) - radians({a}.latitude)) / 2), 2)"
        f" + cos(radians({a}.latitude)) * cos(radians({b}.latitude)) * pow(sin((radians({b}.longitude) - radians({a}.longitude)) / 2), 2))))"
    )


# ---- which rows are taken ------------------------------------------------------------------------------------


@query(over_store("""
SELECT story_id, CAST(epoch(first_seen_at) AS BIGINT) AS seen FROM stories s WHERE status = 'feed' AND first_seen_at >= TIMESTAMP '2024-01-12 00:00:00' AND headline IS NOT NULL
AND (lease_until IS NULL OR lease_until < TIMESTAMP '2024-01-25 00:00:00') AND NOT EXISTS (SELECT 1 FROM extractions e WHERE e.story_id = s.story_id AND e.config_hash = 'e1')
ORDER BY coalesce(published, first_seen_at) DESC, story_id LIMIT 400
""", "stories", "extractions"))
def flt02_unread_feed(spark, sf):
    stories, read = store(spark, sf, "stories", "extractions")
    return Q.unread_feed(stories, read, "e1", at("2024-01-12 00:00:00"), at("2024-01-25 00:00:00"), 400).select("story_id", seconds("first_seen_at").alias("seen"))


@query(over_store("""
SELECT story_id, place_name FROM extractions e WHERE config_hash = 'e1' AND accepted AND is_physical_event AND place_name <> ''
AND NOT EXISTS (SELECT 1 FROM resolutions r WHERE r.story_id = e.story_id AND r.config_hash = 'r1' AND r.extract_hash = 'e1') ORDER BY created_at DESC, story_id LIMIT 900
""", "extractions", "resolutions"))
def flt03_unresolved(spark, sf):
    return Q.unresolved(*store(spark, sf, "extractions", "resolutions"), "e1", "r1", 900).select("story_id", "place_name")


@query(over_store(f"""
SELECT s.story_id, category, place_kind FROM stories s JOIN extractions e ON e.story_id = s.story_id AND e.config_hash = 'e1'
WHERE status = 'feed' AND first_seen_at >= TIMESTAMP '2024-01-05 00:00:00' AND is_physical_event AND failure_reason IS NULL AND place_name IS NOT NULL AND place_quote IS NOT NULL AND outlet NOT IN {DROPPED}
""", "stories", "extractions"))
def flt04_feed_rows(spark, sf):
    stories, read = store(spark, sf, "stories", "extractions")
    return G.feed_rows(stories, read, "e1", at("2024-01-05 00:00:00"), schemas.DROPPED_OUTLETS).select("story_id", "category", "place_kind")


@query(over_store(f"""
SELECT s.story_id, t.text IS NOT NULL AS has_text, e.category FROM stories s LEFT JOIN story_texts t ON t.story_id = s.story_id LEFT JOIN extractions e ON e.story_id = s.story_id AND e.config_hash = 'e1'
WHERE (s.last_seen_at > TIMESTAMP '2024-01-20 00:00:00' OR e.created_at > TIMESTAMP '2024-01-20 00:00:00') AND s.last_seen_at > TIMESTAMP '2024-01-18 00:00:00' AND outlet NOT IN {DROPPED}
ORDER BY s.last_seen_at, s.story_id LIMIT 2000
""", "stories", "story_texts", "extractions"))
def flt06_rows_since(spark, sf):
    rows = X.rows_since(*store(spark, sf, "stories", "story_texts", "extractions"), "e1", at("2024-01-20 00:00:00"), at("2024-01-18 00:00:00"), 2000)
    return rows.select("story_id", F.col("text").isNotNull().alias("has_text"), "category")


@query(over_store("SELECT CAST(CAST(updated_at AS DATE) AS VARCHAR) AS day, outcome, count(*) AS n FROM verifications WHERE CAST(updated_at AS DATE) >= DATE '2024-01-15' GROUP BY ALL", "verifications"))
def flt07_outcomes_by_day(spark, sf):
    days = H.outcomes_by_day(*store(spark, sf, "verifications"), at("2024-01-15 12:00:00"))
    return days.select(F.col("day").cast("string").alias("day"), F.explode("outcomes").alias("outcome", "n"))


@query(over_store("""
SELECT a.story_id, f.cluster_id FROM (SELECT story_id, CASE WHEN n % 13 <> 0 THEN 'C' || n % 25 END AS country, published FROM stories) a
JOIN (SELECT c.* FROM clusters c JOIN stories s ON s.story_id = c.founder_story JOIN extractions e ON e.story_id = s.story_id AND e.config_hash = 'e1' WHERE c.config_hash = 'k1' AND c.open) f
ON a.country IS NOT DISTINCT FROM f.country AND abs(epoch(a.published) - epoch(f.founder_published)) <= 48 * 3600
""", "stories", "clusters", "extractions"))
def flt08_near_founders(spark, sf):
    clusters, stories, read, found = store(spark, sf, "clusters", "stories", "extractions", "resolutions")
    subjects = stories.withColumn("country", F.when(F.col("n") % 13 != 0, F.concat(F.lit("C"), F.col("n") % 25)))
    return K.near_founders(subjects, K.open_founders(clusters, stories, read, found, HASHES))


@query(over_store("""
SELECT c.cluster_id, s.story_id, c.country AS founder_country, e.category, round(r.latitude, 6) AS latitude, r.place_precision
FROM clusters c JOIN stories s ON s.story_id = c.founder_story JOIN extractions e ON e.story_id = s.story_id AND e.config_hash = 'e1' LEFT JOIN resolutions r ON r.story_id = s.story_id AND r.config_hash = 'r1'
WHERE c.config_hash = 'k1' AND c.open
""", "clusters", "stories", "extractions", "resolutions"))
def jn02_open_founders(spark, sf):
    rows = K.open_founders(*store(spark, sf, "clusters", "stories", "extractions", "resolutions"), HASHES)
    return rows.select("cluster_id", "story_id", "founder_country", "category", F.round("latitude", 6).alias("latitude"), "place_precision")


@query(over_store("""
SELECT m.cluster_id, s.story_id, s.outlet, e.place_name, round(r.longitude, 6) AS longitude, r.pinnable
FROM cluster_members m JOIN stories s ON s.story_id = m.story_id JOIN extractions e ON e.story_id = s.story_id AND e.config_hash = 'e1' LEFT JOIN resolutions r ON r.story_id = s.story_id AND r.config_hash = 'r1' WHERE m.config_hash = 'k1'
""", "cluster_members", "stories", "extractions", "resolutions"))
def jn03_members_of(spark, sf):
    rows = K.members_of(*store(spark, sf, "cluster_members", "stories", "extractions", "resolutions"), HASHES)
    return rows.select("cluster_id", "story_id", "outlet", "place_name", F.round("longitude", 6).alias("longitude"), "pinnable")


@query(over_store("""
SELECT s.story_id, round(r.latitude, 6) AS latitude, r.pinnable FROM stories s JOIN extractions e ON e.story_id = s.story_id AND e.config_hash = 'e1' LEFT JOIN resolutions r ON r.story_id = s.story_id AND r.config_hash = 'r1'
WHERE e.accepted AND published IS NOT NULL AND NOT EXISTS (SELECT 1 FROM cluster_members m WHERE m.story_id = s.story_id AND m.config_hash = 'k1') ORDER BY published, s.story_id LIMIT 700
""", "stories", "extractions", "resolutions", "cluster_members"))
def jn01_pending(spark, sf):
    rows = K.pending(*store(spark, sf, "stories", "extractions", "resolutions", "cluster_members"), HASHES, 700)
    return rows.select("story_id", F.round("latitude", 6).alias("latitude"), "pinnable")


@query(over_store("""
SELECT count(*) AS n FROM extractions e WHERE config_hash = 'e1' AND accepted AND is_physical_event AND place_name IS NOT NULL AND NOT EXISTS (SELECT 1 FROM resolutions r WHERE r.story_id = e.story_id AND r.config_hash = 'r1')
""", "extractions", "resolutions"))
def val04_unresolved_before_clusters(spark, sf):
    return spark.createDataFrame([(K.unresolved(*store(spark, sf, "extractions", "resolutions"), HASHES),)], "n long")


@query(over_store("""
SELECT story_id, coalesce(published, first_seen_at) = published AS dated FROM stories s WHERE status = 'scraped' AND NOT EXISTS (SELECT 1 FROM extractions e WHERE e.story_id = s.story_id AND e.config_hash = 'e1')
ORDER BY coalesce(published, first_seen_at) DESC, story_id LIMIT 500
""", "stories", "extractions"))
def jn07_unread(spark, sf):
    rows = Q.unread(*store(spark, sf, "stories", "extractions"), "e1", "scraped", 500)
    return rows.select("story_id", (F.coalesce("published", "first_seen_at") == F.col("published")).alias("dated"))


@query(over_store("""
SELECT story_id FROM stories s WHERE first_seen_at >= TIMESTAMP '2024-01-10 00:00:00' AND EXISTS (SELECT 1 FROM extractions e WHERE e.story_id = s.story_id AND e.config_hash <> 'e1')
AND NOT EXISTS (SELECT 1 FROM extractions e WHERE e.story_id = s.story_id AND e.config_hash = 'e1')
""", "stories", "extractions"))
def jn08_read_under_other_settings(spark, sf):
    return Q.read_under_other_settings(*store(spark, sf, "stories", "extractions"), "e1", at("2024-01-10 00:00:00")).select("story_id")


@query(over_store("""
SELECT 'h' || n AS story_id, 'i' || n % 5 AS input_hash FROM stories LEFT JOIN verifications v USING (story_id)
WHERE NOT (coalesce(v.input_hash = 'i' || n % 5, FALSE) AND (coalesce(outcome IN ('verified', 'kept', 'dropped', 'unsure'), FALSE) OR coalesce(attempts, 0) >= 2))
""", "stories", "verifications"))
def flt21_needs_check(spark, sf):
    stories, told = store(spark, sf, "stories", "verifications")
    asked = stories.select("story_id", F.concat(F.lit("i"), F.col("n") % 5).alias("input_hash"), "n")
    return C.needs_check(asked, told).select(F.concat(F.lit("h"), "n").alias("story_id"), "input_hash")


@query(over_store("""
SELECT r.n AS row_id, s.story_id IS NULL OR (r.updated IS NOT NULL AND r.updated IS DISTINCT FROM s.updated) OR (s.text_fetched_at IS NULL AND s.text_hash IS NULL) AS wanted
FROM (SELECT n, CASE WHEN n % 4 <> 0 THEN story_id END AS known_id, CASE WHEN n % 3 = 0 THEN updated + INTERVAL 1 HOUR ELSE updated END AS updated FROM stories) r LEFT JOIN stories s ON s.story_id = r.known_id
""", "stories"))
def flt20_needs_page(spark, sf):
    (stories,) = store(spark, sf, "stories")
    rows = stories.select(F.col("n").alias("row_id"), F.when(F.col("n") % 4 != 0, F.col("story_id")).alias("known_id"), F.when(F.col("n") % 3 == 0, F.col("updated") + F.expr("INTERVAL 1 HOUR")).otherwise(F.col("updated")).alias("updated"))
    return I.needs_page(rows, stories).select("row_id", "wanted")


# ---- what a row is made into ---------------------------------------------------------------------------------


@query(over_store("""
SELECT s.story_id, array_to_string(list_sort(list_distinct(list_filter(list_transform(key_entities, lambda x: lower(trim(x))), lambda x: x <> ''))), '|') AS keys,
  coalesce(list_contains(format_flags, 'live'), FALSE) AS is_live,
  CAST(len(list_distinct(list_filter(regexp_extract_all(lower(coalesce(headline, '')), '[a-z0-9]+'), lambda w: length(w) > 2 AND NOT list_contains(string_split('STOP', ' '), w)))) AS BIGINT) AS n_tokens
FROM stories s JOIN extractions e USING (story_id)
""".replace("STOP", " ".join(STOP_WORDS)), "stories", "extractions"))
def flt16_facts(spark, sf):
    stories, read = store(spark, sf, "stories", "extractions")
    rows = K.facts(stories.join(read.select("story_id", F.col("key_entities").alias("entities")), "story_id"))
    return rows.select("story_id", F.array_join(F.array_sort("keys"), "|").alias("keys"), "is_live", F.size("tokens").cast("long").alias("n_tokens"))


_EVENT = """
physical AS (SELECT s.*, t.text, e.is_physical_event, e.category, e.event_date, e.place_name, e.place_kind, e.other_places, e.key_entities,
  e.is_physical_event AND e.category NOT IN ('courts_and_justice', 'opinion_analysis') AND e.place_kind NOT IN ('region', 'country') AS physical, e.story_id IS NOT NULL AND status <> 'feed' AS told
  FROM stories s LEFT JOIN story_texts t ON t.story_id = s.story_id LEFT JOIN extractions e ON e.story_id = s.story_id AND e.config_hash = 'e1')"""


@query(over_store("""
SELECT story_id, headline AS title, strftime(published, '%Y-%m-%dT%H:%M:%SZ') AS published, CASE WHEN told THEN CAST(physical AS VARCHAR) END AS physical, CASE WHEN told THEN category END AS category,
  CASE WHEN told THEN CAST(event_date AS VARCHAR) END AS event_date, CASE WHEN told AND physical THEN place_name END AS place_name, CASE WHEN told AND physical THEN place_kind END AS place_kind,
  CASE WHEN told THEN array_to_string(list_filter(other_places, lambda x: trim(x) <> ''), '|') END AS other_places,
  CASE WHEN coalesce(text, '') <> '' AND first_seen_at >= TIMESTAMP '2024-01-29 00:00:00' - INTERVAL 24 HOUR AND first_seen_at > TIMESTAMP '2024-01-28 06:00:00' THEN text END AS text,
  array_to_string(list_sort(list(section)), '|') AS sections
FROM physical LEFT JOIN (SELECT story_id, section FROM story_sections) USING (story_id) GROUP BY ALL
""", "stories", "story_texts", "extractions", "story_sections", more=_EVENT))
def flt15_items(spark, sf):
    """Export items, read back from their JSON: the event is masked, text goes along if it is new, empty fields are left out."""
    stories, texts, read, sections = store(spark, sf, "stories", "story_texts", "extractions", "story_sections")
    more = stories.withColumns({"thumbnail": F.lit(None).cast("string"), "categories": F.create_map(F.lit("t"), F.col("status"))})
    rows = more.join(texts.select("story_id", "text"), "story_id", "left").join(read.filter("config_hash = 'e1'").drop("config_hash", "text_hash"), "story_id", "left")
    out = X.items(X.with_sections(rows, sections), at("2024-01-28 06:00:00"), at("2024-01-29 00:00:00"))
    fields = "title string, published string, text string, sections array<string>, event struct<isPhysical:string,category:string,eventDate:string,placeName:string,placeKind:string,otherPlaces:array<string>>"
    read = out.select("story_id", F.from_json("item", fields).alias("x"))  # once for all fields
    return read.select(
        "story_id", "x.title", "x.published", F.col("x.event.isPhysical").alias("physical"), "x.event.category", F.col("x.event.eventDate").alias("event_date"), F.col("x.event.placeName").alias("place_name"),
        F.col("x.event.placeKind").alias("place_kind"), F.array_join("x.event.otherPlaces", "|").alias("other_places"), "x.text", F.array_join("x.sections", "|").alias("sections"),
    )


@query(over_store("SELECT story_id, array_to_string(list_sort(list(section)), ',') AS sections FROM (SELECT story_id FROM stories WHERE n % 5 <> 4) LEFT JOIN story_sections USING (story_id) GROUP BY story_id", "stories", "story_sections"))
def jn20_with_sections(spark, sf):
    stories, sections = store(spark, sf, "stories", "story_sections")
    return X.with_sections(stories.filter("n % 5 <> 4").select("story_id"), sections).select("story_id", F.array_join("sections", ",").alias("sections"))


@query(over_store("SELECT story_id, arg_min(section, (first_seen_at, section)) AS section FROM story_sections GROUP BY story_id", "story_sections"))
def win04_first_sections(spark, sf):
    return Q.first_sections(*store(spark, sf, "story_sections"))


@query(over_store(r"""
SELECT s.story_id, substr(sha256(concat_ws(chr(10), 'Outlet: ' || outlet, 'Published: ' || strftime(published, '%Y-%m-%d %H:%M:%S'), 'Headline: ' || headline,
  CASE WHEN description <> '' THEN 'Summary: ' || description END, 'Labels: News, ' || status, CASE WHEN coalesce(text, '') <> '' THEN chr(10) || text END)), 1, 32) AS input_hash
FROM stories s LEFT JOIN story_texts t USING (story_id)
""", "stories", "story_texts"))
def jn05_messages(spark, sf):
    """The message about each story, with its text if there is one, as its hash."""
    stories, texts = store(spark, sf, "stories", "story_texts")
    labels = Q.outlet_tags(F.create_map(F.lit("topics"), F.array(F.lit(" News"), F.lit("")), F.lit("section"), F.array("status", F.lit("News"))), ["topics", "section", "missing"])
    rows = stories.withColumn("outlet_tags", labels).join(texts.select("story_id", "text"), "story_id", "left").withColumn("message", Q.story_message())
    return Q.with_input_hash(rows, "message").select("story_id", "input_hash")


@query(over_store(r"""
SELECT story_id, concat_ws(' ', 'A ' || category || ' event happened at', place_name || ',', 'shown as a ' || place_kind || '.', 'Quote: ' || place_quote) AS claim,
  concat_ws(chr(10) || chr(10), concat_ws(chr(10), 'Story 1', 'Outlet: ' || outlet, 'Headline: ' || headline, CASE WHEN coalesce(place_name, '') <> '' THEN 'Where: ' || place_name END, 'When: ' || event_date),
    concat_ws(chr(10), 'Story 2', 'Outlet: ' || status, 'What happened: ' || category)) AS pair
FROM stories JOIN extractions USING (story_id)
""", "stories", "extractions"))
def str24_claims_and_pairs(spark, sf):
    stories, read = store(spark, sf, "stories", "extractions")
    none = lambda kind: F.lit(None).cast(kind)
    j = stories.join(read.drop("text_hash"), "story_id")
    a = F.struct("outlet", none("timestamp").alias("published"), "headline", none("string").alias("hint"), F.col("place_name").alias("place"), "event_date")
    b = F.struct(F.col("status").alias("outlet"), none("timestamp").alias("published"), none("string").alias("headline"), F.col("category").alias("hint"), none("string").alias("place"), none("date").alias("event_date"))
    j = j.withColumns({"a": a, "b": b})
    return j.select("story_id", Q.pin_claim("category", "place_name", "place_kind", "place_quote").alias("claim"), Q.pair_message("a", "b").alias("pair"))


# ---- identity ------------------------------------------------------------------------------------------------


@query(over_store("""
SELECT row_id, known_id FROM (SELECT n AS row_id FROM stories) LEFT JOIN (SELECT r.n AS row_id, arg_min(a.story_id, (first_seen_at, a.story_id)) AS known_id
  FROM (SELECT n, outlet, unnest(['a' || n * 2, 'u' || n % 500]) AS alias FROM stories) r JOIN story_aliases a ON a.outlet = r.outlet AND a.alias = r.alias GROUP BY r.n) USING (row_id)
""", "stories", "story_aliases"))
def jn06_owners(spark, sf):
    stories, known = store(spark, sf, "stories", "story_aliases")
    rows = stories.select(F.col("n").alias("row_id"), "outlet", F.array(F.concat(F.lit("a"), F.col("n") * 2), F.concat(F.lit("u"), F.col("n") % 500)).alias("aliases"))
    return I.owners(rows, known).select("row_id", "known_id")


@query(over_store("""
WITH RECURSIVE r AS (SELECT n, outlet, ['u' || n % 500, 'v' || n // 3, 'x' || n % 701] AS aliases FROM stories),
e AS (SELECT n, outlet, unnest(aliases) AS alias FROM r), f AS (SELECT outlet, alias, min(n) AS first FROM e GROUP BY ALL),
k AS (SELECT outlet, alias, min((first_seen_at, story_id)) AS old FROM story_aliases WHERE alias LIKE 'u%5' GROUP BY ALL),
t AS MATERIALIZED (SELECT e.n, any_value(e.outlet) AS outlet, min(k.old) AS old, min(f.first) AS first FROM e JOIN f USING (outlet, alias) LEFT JOIN k USING (outlet, alias) GROUP BY e.n),
walk AS (SELECT n, n AS here FROM t UNION ALL SELECT w.n, t.first FROM walk w JOIN t ON t.n = w.here WHERE t.old IS NULL AND t.first <> w.here)
SELECT w.n AS row_id, t.outlet, CASE WHEN t.old IS NOT NULL THEN t.old[2] ELSE 'st_' || substr(sha256(t.outlet || chr(10) || 'u' || t.n % 500), 1, 16) END AS story_id, t.old IS NULL AND w.n = w.here AS is_new
FROM walk w JOIN t ON t.n = w.here WHERE t.old IS NOT NULL OR t.first = t.n
""", "stories", "story_aliases").replace("WITH stories AS", "WITH RECURSIVE stories AS").replace("\nWITH RECURSIVE r AS", ", r AS"))
def ups01_assign_stories(spark, sf):
    """Rows with three aliases each, which chain and bridge, saved as if one by one into a store that has some of them."""
    stories, known = store(spark, sf, "stories", "story_aliases")
    n = F.col("n")
    aliases = F.array(F.concat(F.lit("u"), n % 500), F.concat(F.lit("v"), F.floor(n / 3)), F.concat(F.lit("x"), n % 701))
    return I.assign_stories(stories.select(n.alias("row_id"), "outlet", aliases.alias("aliases"), n.alias("seq")), known.filter("alias LIKE 'u%5'"))


@query(over_store("""
SELECT outlet, section, page, bool_and(known) AS all_known FROM (SELECT r.*, EXISTS (SELECT 1 FROM story_sections x WHERE x.story_id = o.known_id AND x.section = r.section) AS known
  FROM (SELECT n, outlet, status AS section, n // 20 AS page, 'a' || n AS alias FROM (SELECT n, outlet, CASE WHEN n % 50 < 25 THEN event_type ELSE 'click' END AS status FROM stories JOIN (SELECT event_id AS n, event_type FROM events) USING (n))) r
  LEFT JOIN (SELECT outlet, alias, story_id AS known_id FROM story_aliases WHERE alias LIKE 'a%') o ON o.outlet = r.outlet AND o.alias = r.alias) GROUP BY ALL
""", "stories", "story_aliases", "story_sections"))
def jn27_pages_known(spark, sf):
    stories, known, sections = store(spark, sf, "stories", "story_aliases", "story_sections")
    kinds = table(spark, sf, "events").select(F.col("event_id").alias("n"), "event_type")
    section = F.when(F.col("n") % 50 < 25, F.col("event_type")).otherwise(F.lit("click"))
    rows = stories.join(kinds, "n").select(F.col("n").alias("row_id"), "outlet", section.alias("section"), F.floor(F.col("n") / 20).alias("page"), F.array(F.concat(F.lit("a"), "n")).alias("aliases"))
    return I.pages_known(rows, known.filter("alias LIKE 'a%'"), sections)


@query(over_store("SELECT n, position FROM (SELECT n, n AS position, row_number() OVER (PARTITION BY outlet, status, url ORDER BY n) AS rn FROM stories) WHERE rn = 1", "stories"))
def win09_first_on_a_page(spark, sf):
    (stories,) = store(spark, sf, "stories")
    return feeds.first_on_page(stories.select("n", "outlet", F.col("status").alias("section"), F.col("url").alias("id"), F.col("n").alias("position"))).select("n", "position")


# ---- merges --------------------------------------------------------------------------------------------------

_CHANGED = """
old AS (SELECT * FROM stories WHERE n % 3 <> 0),
new AS (SELECT story_id, n, outlet, CASE WHEN n % 10 = 0 THEN '' WHEN n % 4 = 0 THEN headline || ' again' ELSE headline END AS headline, description, CASE WHEN n % 8 = 0 THEN 'hx' ELSE text_hash END AS text_hash,
  CASE WHEN n % 5 = 0 THEN ['video', 'gallery'] END AS format_flags, word_count, last_seen_at + INTERVAL 1 DAY AS last_seen_at, first_seen_at + INTERVAL 9 DAY AS first_seen_at, 'scraped' AS status FROM stories WHERE n % 2 = 0)"""


@query(over_store("""
SELECT story_id, coalesce(nullif(new.headline, ''), old.headline) AS headline, coalesce(nullif(new.description, ''), old.description) AS description, coalesce(nullif(new.text_hash, ''), old.text_hash) AS text_hash,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(old.format_flags, []), coalesce(new.format_flags, [])))), ',') AS flags, CAST(epoch(coalesce(new.last_seen_at, old.last_seen_at)) AS BIGINT) AS last_seen,
  CAST(epoch(coalesce(old.first_seen_at, new.first_seen_at)) AS BIGINT) AS first_seen, coalesce(CASE WHEN new.n IS NOT NULL AND new.n % 6 <> 0 THEN 'new' END, CASE WHEN old.n IS NOT NULL THEN 'old' END) AS label,
  CASE WHEN new.n IS NULL AND old.n % 2 = 0 THEN '?' WHEN coalesce(new.n, old.n) % 4 = 1 THEN 'kept' END AS side,
  CASE WHEN old.n IS NULL THEN new.status WHEN new.n IS NOT NULL AND old.status <> 'feed' AND (coalesce(old.headline <> '' AND nullif(new.headline, '') <> old.headline, FALSE)
    OR coalesce(old.text_hash <> '' AND nullif(new.text_hash, '') <> old.text_hash, FALSE)) THEN 'scraped' ELSE old.status END AS status
FROM old FULL JOIN new USING (story_id)
""", "stories", more=_CHANGED))
def ups02_merge_stories(spark, sf):
    """Stories scraped again: values, categories key by key, flags, times and status of all that were there or are new."""
    (stories,) = store(spark, sf, "stories")
    n = F.col("n")
    words = lambda *x: F.array(*map(F.lit, x))
    whole = stories.withColumns({
        "thumbnail": F.lit(None).cast("string"), "published_raw": F.lit(None).cast("string"), "updated_raw": F.lit(None).cast("string"), "authors": F.array().cast("array<string>"),
        "categories": F.create_map(F.lit("label"), F.lit("old"), F.lit("side"), F.when(n % 4 == 1, F.lit("kept"))),
    })
    again = whole.filter("n % 2 = 0").withColumns({
        "headline": F.when(n % 10 == 0, F.lit("")).when(n % 4 == 0, F.concat("headline", F.lit(" again"))).otherwise(F.col("headline")),
        "text_hash": F.when(n % 8 == 0, F.lit("hx")).otherwise(F.col("text_hash")),
        "format_flags": F.when(n % 5 == 0, words("video", "gallery")),
        "last_seen_at": F.col("last_seen_at") + F.expr("INTERVAL 1 DAY"),
        "first_seen_at": F.col("first_seen_at") + F.expr("INTERVAL 9 DAYS"),
        "status": F.lit("scraped"),
        "categories": F.create_map(F.lit("label"), F.when(n % 6 != 0, F.lit("new")).otherwise(F.lit(""))),
    })
    out = M.merge_stories(whole.filter("n % 3 <> 0"), again)
    flags = F.array_join("format_flags", ",")
    return out.select("story_id", "headline", "description", "text_hash", flags.alias("flags"), seconds("last_seen_at").alias("last_seen"), seconds("first_seen_at").alias("first_seen"), F.col("categories")["label"].alias("label"), F.col("categories")["side"].alias("side"), "status")


@query(over_store("""
SELECT coalesce(o.story_id, w.story_id) AS story_id, CASE WHEN o.story_id IS NULL OR (w.story_id IS NOT NULL AND o.text_hash <> w.text_hash) THEN w.text ELSE o.text END AS text
FROM (SELECT * FROM story_texts WHERE CAST(substr(story_id, 2) AS INT) % 2 = 0) o FULL JOIN (SELECT story_id, 'new ' || text AS text, CASE WHEN CAST(substr(story_id, 2) AS INT) % 4 = 0 THEN 'x' || text_hash ELSE text_hash END AS text_hash FROM story_texts WHERE CAST(substr(story_id, 2) AS INT) % 5 < 3) w ON o.story_id = w.story_id
""", "story_texts"))
def ups06_merge_texts(spark, sf):
    texts = store(spark, sf, "story_texts")[0].withColumn("n", F.substring("story_id", 2, 20).cast("long"))
    new = texts.filter("n % 5 < 3").withColumns({"text": F.concat(F.lit("new "), "text"), "text_hash": F.when(F.col("n") % 4 == 0, F.concat(F.lit("x"), "text_hash")).otherwise(F.col("text_hash"))})
    return M.merge_texts(texts.filter("n % 2 = 0").drop("n"), new.drop("n")).select("story_id", "text")


_NEW_READINGS = "again AS (SELECT story_id, 'e1' AS config_hash, 'again' AS category, created_at FROM extractions WHERE CAST(substr(story_id, 2) AS INT) % 5 = 2)"


@query(over_store("""
SELECT 'extraction' AS part, story_id, config_hash AS a, category AS b FROM extractions x WHERE NOT EXISTS (SELECT 1 FROM again g WHERE g.story_id = x.story_id AND g.config_hash = x.config_hash)
UNION ALL SELECT 'extraction', story_id, config_hash, category FROM again
UNION ALL SELECT 'story', story_id, CASE WHEN story_id IN (SELECT story_id FROM again) AND status <> 'feed' THEN 'extracted' ELSE status END, CASE WHEN story_id NOT IN (SELECT story_id FROM again) THEN lease_owner END FROM stories
""", "stories", "extractions", more=_NEW_READINGS))
def ups07_store_readings(spark, sf):
    """New readings replace those of the same settings as a whole, and their stories move on."""
    stories, read = store(spark, sf, "stories", "extractions")
    again = read.filter(F.substring("story_id", 2, 20).cast("long") % 5 == 2).withColumns({"config_hash": F.lit("e1"), "category": F.lit("again")})
    after, readings = M.store_readings(stories, read, again)
    one = readings.select(F.lit("extraction").alias("part"), "story_id", F.col("config_hash").alias("a"), F.col("category").alias("b"))
    return one.unionByName(after.select(F.lit("story").alias("part"), "story_id", F.col("status").alias("a"), F.col("lease_owner").alias("b")))


@query(over_store("""
SELECT r.run_id, CAST(epoch(coalesce(e.finished_at, r.finished_at)) AS BIGINT) AS finished, CAST(coalesce(e.new_stories, r.new_stories) AS BIGINT) AS new_stories, c.calls FROM scrape_runs r
LEFT JOIN (SELECT run_id, started_at + INTERVAL 2 HOUR AS finished_at, rows_seen + 1 AS new_stories FROM scrape_runs WHERE rows_seen % 2 = 0) e USING (run_id),
(SELECT count(*) AS calls FROM (SELECT call_id FROM llm_calls WHERE cost_usd < 0.06 UNION SELECT call_id FROM llm_calls WHERE cost_usd > 0.04)) c
""", "scrape_runs", "llm_calls"))
def ups12_runs_and_calls(spark, sf):
    """Runs that end, and a ledger that takes each call once."""
    runs, calls = store(spark, sf, "scrape_runs", "llm_calls")
    ended = runs.filter("rows_seen % 2 = 0").select("run_id", (F.col("started_at") + F.expr("INTERVAL 2 HOURS")).alias("finished_at"), (F.col("rows_seen") + 1).alias("new_stories"))
    ledger = M.first_wins(calls.filter("cost_usd < 0.06"), calls.filter("cost_usd > 0.04"), ["call_id"], [F.col("created_at")])
    n = ledger.agg(F.count(F.lit(1)).alias("calls"))
    done = M.end_runs(runs, ended.unionByName(ended.limit(1).withColumn("run_id", F.lit("never began"))))
    return done.join(F.broadcast(n)).select("run_id", seconds("finished_at").alias("finished"), F.col("new_stories").cast("long").alias("new_stories"), "calls")


@query(over_store("""
SELECT story_id, CASE WHEN n % 4 = 2 THEN 'done' ELSE status END AS status, CASE WHEN n % 4 <> 2 THEN lease_owner END AS lease_owner, CASE WHEN n % 4 <> 2 THEN CAST(epoch(lease_until) AS BIGINT) END AS lease FROM stories
""", "stories"))
def ups14_release(spark, sf):
    (stories,) = store(spark, sf, "stories")
    ids = stories.filter("n % 4 = 2").select("story_id")
    return M.release(stories, ids.unionByName(ids), "done").select("story_id", "status", "lease_owner", seconds("lease_until").alias("lease"))


_GONE = f"gone AS (SELECT story_id FROM stories WHERE outlet IN {DROPPED})"


@query(over_store("""
SELECT m.cluster_id, m.story_id FROM cluster_members m JOIN clusters c USING (cluster_id) JOIN gone g ON g.story_id = c.founder_story WHERE m.story_id NOT IN (SELECT story_id FROM gone)
""", "stories", "clusters", "cluster_members", more=_GONE))
def jn23_orphaned_members(spark, sf):
    clusters, members, stories = store(spark, sf, "clusters", "cluster_members", "stories")
    return M.orphans(clusters, members, stories, schemas.DROPPED_OUTLETS)


@query(over_store("""
SELECT 'stories' AS "table", count(*) AS rows FROM gone UNION ALL SELECT 'story_aliases', count(*) FROM story_aliases WHERE story_id IN (SELECT story_id FROM gone)
UNION ALL SELECT 'story_sections', count(*) FROM story_sections WHERE story_id IN (SELECT story_id FROM gone) UNION ALL SELECT 'story_texts', count(*) FROM story_texts WHERE story_id IN (SELECT story_id FROM gone)
UNION ALL SELECT 'extractions', count(*) FROM extractions WHERE story_id IN (SELECT story_id FROM gone) UNION ALL SELECT 'resolutions', count(*) FROM resolutions WHERE story_id IN (SELECT story_id FROM gone)
UNION ALL SELECT 'clusters', count(*) FROM clusters WHERE founder_story IN (SELECT story_id FROM gone) UNION ALL SELECT 'verifications', count(*) FROM verifications WHERE story_id IN (SELECT story_id FROM gone)
UNION ALL SELECT 'cluster_members', count(*) FROM cluster_members m LEFT JOIN clusters c USING (cluster_id) WHERE m.story_id IN (SELECT story_id FROM gone) OR c.founder_story IN (SELECT story_id FROM gone)
UNION ALL SELECT 'outlet_health', count(*) FROM outlet_health WHERE outlet IN ('guardian', 'nyt') UNION ALL SELECT 'llm_calls', 0
""", "stories", "story_aliases", "story_sections", "story_texts", "extractions", "resolutions", "clusters", "cluster_members", "verifications", "outlet_health", more=_GONE))
def jn24_drop_outlets(spark, sf):
    """Rows of each table that go with two outlets: stories, all that hangs on them, members of their clusters; calls stay."""
    names = ["stories", "story_aliases", "story_sections", "story_texts", "extractions", "resolutions", "clusters", "cluster_members", "verifications", "outlet_health", "llm_calls"]
    tables = dict(zip(names, store(spark, sf, *names), strict=True))
    return M.drop_plan(tables, schemas.DROPPED_OUTLETS, schemas.DROPPED_OUTLETS)


# ---- clusters and the body -----------------------------------------------------------------------------------

_FOUNDERS = f"""
founders AS (SELECT c.cluster_id, c.founder_story, coalesce(list_contains(s.format_flags, 'live'), FALSE) AS is_live, e.is_physical_event, e.category, r.pinnable, r.latitude, r.longitude
  FROM clusters c JOIN stories s ON s.story_id = c.founder_story JOIN extractions e ON e.story_id = s.story_id AND e.config_hash = 'e1' LEFT JOIN resolutions r ON r.story_id = s.story_id AND r.config_hash = 'r1' WHERE c.config_hash = 'k1'),
far AS (SELECT f.cluster_id, bool_or({km("r", "f")} > 50) AS far FROM founders f JOIN cluster_members m ON m.cluster_id = f.cluster_id AND m.config_hash = 'k1' AND m.story_id <> f.founder_story
  JOIN extractions e ON e.story_id = m.story_id AND e.config_hash = 'e1' JOIN resolutions r ON r.story_id = m.story_id AND r.config_hash = 'r1' WHERE r.latitude IS NOT NULL GROUP BY f.cluster_id),
reasons AS (SELECT cluster_id, CASE WHEN is_live THEN 'live_blog' WHEN NOT is_physical_event THEN 'founder_not_an_event' WHEN category IN ('courts_and_justice', 'opinion_analysis') THEN 'founder_category_never_pins'
  WHEN NOT coalesce(pinnable AND latitude IS NOT NULL, FALSE) THEN 'founder_place_not_pinnable' WHEN coalesce(far, FALSE) THEN 'members_far_apart' END AS reason FROM founders LEFT JOIN far USING (cluster_id))"""


@query(over_store("""
SELECT c.cluster_id, c.config_hash, CASE WHEN r.cluster_id IS NULL THEN c.is_pin ELSE reason IS NULL END AS is_pin, CASE WHEN r.cluster_id IS NULL THEN c.not_pin_reason ELSE reason END AS not_pin_reason
FROM clusters c LEFT JOIN reasons r ON r.cluster_id = c.cluster_id AND c.config_hash = 'k1'
""", "stories", "extractions", "resolutions", "clusters", "cluster_members", more=_FOUNDERS))
def ups15_decide_again(spark, sf):
    names = ["clusters", "cluster_members", "stories", "extractions", "resolutions"]
    return K.decide_again(*store(spark, sf, *names), HASHES).select("cluster_id", "config_hash", "is_pin", "not_pin_reason")


_SPOTS = "SELECT o_orderkey AS id, o_orderstatus, o_orderpriority, (o_orderkey * 37 % 1000) / 10.0 - 50 AS latitude, (o_orderkey * 91 % 3000) / 10.0 - 150 AS longitude FROM orders"


@query(f"""
WITH f AS ({_SPOTS}), m AS (SELECT l_orderkey AS id, l_linenumber, (l_orderkey * 37 % 1000) / 10.0 - 50 + (l_suppkey % 7) / 10.0 AS latitude, (l_orderkey * 91 % 3000) / 10.0 - 150 AS longitude FROM lineitem WHERE l_linenumber <> 4),
far AS (SELECT f.id, bool_or({km("m", "f")} > 50) AS far FROM f JOIN m USING (id) WHERE l_linenumber > 1 GROUP BY f.id)
SELECT 'o' || id AS cluster_id, reason IS NULL AS is_pin, reason AS not_pin_reason FROM (SELECT id, CASE WHEN o_orderpriority = '5-LOW' THEN 'live_blog' WHEN o_orderstatus = 'P' THEN 'founder_not_an_event'
  WHEN o_orderpriority = '1-URGENT' THEN 'founder_category_never_pins' WHEN id % 11 = 0 THEN 'founder_place_not_pinnable' WHEN coalesce(far, FALSE) THEN 'members_far_apart' END AS reason FROM f LEFT JOIN far USING (id))
""")
def agg13_pin_decisions(spark, sf):
    """Orders as events, their lines as members, the first of them the founder; every veto of the ladder."""
    spot = lambda key, mul, mod, off: F.col(key) * mul % mod / 10.0 - off
    o, l = table(spark, sf, "orders"), table(spark, sf, "lineitem")  # noqa: E741
    named = lambda key: F.concat(F.lit("o"), key)
    clusters = o.select(
        named("o_orderkey").alias("cluster_id"), F.concat(named("o_orderkey"), F.lit("-1")).alias("founder_story"), (F.col("o_orderpriority") == "5-LOW").alias("is_live"), (F.col("o_orderstatus") != "P").alias("is_physical_event"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("opinion_analysis")).otherwise(F.lit("conflict")).alias("category"), (F.col("o_orderkey") % 11 != 0).alias("pinnable"),
        spot("o_orderkey", 37, 1000, 50).alias("latitude"), spot("o_orderkey", 91, 3000, 150).alias("longitude"),
    )
    there = F.col("l_linenumber") != 4
    members = l.select(
        named("l_orderkey").alias("cluster_id"), F.concat(named("l_orderkey"), F.lit("-"), F.when(F.col("l_linenumber") > 1, F.concat_ws("-", "l_linenumber", "l_partkey", "l_suppkey")).otherwise(F.lit("1"))).alias("story_id"),
        F.when(there, spot("l_orderkey", 37, 1000, 50) + F.col("l_suppkey") % 7 / 10.0).alias("latitude"), F.when(there, spot("l_orderkey", 91, 3000, 150)).alias("longitude"),
    )
    return K.pin_decisions(clusters, members)


@query(over_store(f"""
SELECT cluster_id AS id, category, title, strftime(f, '%Y-%m-%dT%H:%M:%SZ') AS first_at, strftime(l, '%Y-%m-%dT%H:%M:%SZ') AS last_at, n_reports, CASE WHEN drawn THEN display_name END AS place, CASE WHEN drawn THEN round_even(latitude, 5) END AS lat,
  CASE WHEN drawn THEN place_precision END AS "precision", CASE WHEN drawn THEN place_quote END AS evidence, CASE WHEN drawn THEN outlet END AS evidence_outlet
FROM (SELECT c.*, s.outlet, e.category, e.place_quote, g.f, g.l, CAST(len(g.reports) AS BIGINT) AS n_reports, g.reports[1] AS title, 'Shown ' || r.geonames_id AS display_name, c.is_pin AND c.place_precision IN ('point', 'district', 'city') AND r.geonames_id IS NOT NULL AND r.geonames_id % 3 <> 0 AS drawn
  FROM clusters c JOIN stories s ON s.story_id = c.founder_story LEFT JOIN extractions e ON e.story_id = s.story_id AND e.config_hash = 'e1' LEFT JOIN resolutions r ON r.story_id = s.story_id AND r.config_hash = 'r1'
  JOIN (SELECT cluster_id, min(published) AS f, max(published) AS l, list(headline ORDER BY rn) FILTER (rn <= 8 AND headline IS NOT NULL) AS reports FROM (
    SELECT m.cluster_id, s.headline, s.published, row_number() OVER (PARTITION BY m.cluster_id ORDER BY s.published NULLS LAST, s.story_id) AS rn FROM cluster_members m JOIN stories s USING (story_id) WHERE m.config_hash = 'k1') GROUP BY cluster_id) g ON g.cluster_id = c.cluster_id
  WHERE c.config_hash = 'k1') WHERE l IS NOT NULL AND len(title) > 0 AND epoch(TIMESTAMP '2024-01-31 12:00:00') - epoch(l) <= CASE WHEN drawn THEN 7 * 86400 ELSE 72 * 3600 END ORDER BY last_at DESC, id DESC LIMIT 3000
""", "clusters", "cluster_members", "stories", "extractions", "resolutions"))
def jn21_items(spark, sf):
    """The items of a body: founder, reading, place, reports and span of each event that is still in its window."""
    names = ["clusters", "cluster_members", "stories", "extractions", "resolutions"]
    clusters, members, stories, read, found = store(spark, sf, *names)
    shown = found.select("geonames_id").distinct().filter("geonames_id % 3 <> 0").select("geonames_id", F.concat(F.lit("Shown "), "geonames_id").alias("display_name"))
    out = S.items(clusters, members, stories, read, found, shown, at("2024-01-31 12:00:00"), HASHES)
    loc = F.col("location")
    return out.select("id", "category", "title", F.col("firstReportedAt").alias("first_at"), F.col("lastReportedAt").alias("last_at"), F.size("reports").cast("long").alias("n_reports"), loc["place"].alias("place"), loc["lat"].alias("lat"), loc["precision"].alias("precision"), loc["evidence"].alias("evidence"), loc["evidenceOutlet"].alias("evidence_outlet"))


@query(over_store("SELECT outlet, strftime(last_new_story_at, '%Y-%m-%dT%H:%M:%SZ') AS last_new FROM (SELECT unnest(['reuters', 'bbc', 'guardian', 'pbs', 'nyt']) AS outlet) LEFT JOIN outlet_health USING (outlet)", "outlet_health"))
def jn25_outlets_block(spark, sf):
    return S.outlets_block(*store(spark, sf, "outlet_health")).select("outlet", F.col("lastNewStoryAt").alias("last_new"))


@query("""
WITH s AS (SELECT CAST(event_id AS VARCHAR) AS id, event_id, user_id % 25 AS country, floor(epoch(ts)) AS at, CAST(epoch_us(ts) AS BIGINT) AS us, event_id % 50 = 0 AS live, 'person ' || CAST(floor(value) AS BIGINT) || ' ' || event_id % 40 AS entity,
  [event_type, 'bucket' || CAST(floor(value / 2) AS BIGINT), 'user' || user_id] AS t, CASE WHEN event_id % 2 = 0 THEN user_id % 140 - 70 + value / 50 END AS latitude, CASE WHEN event_id % 2 = 0 THEN user_id * 7 % 360 - 180 + value / 40 END AS longitude FROM events)
SELECT count(*) AS n FROM s a JOIN s b ON a.country = b.country AND a.id <> b.id AND NOT a.live AND NOT b.live AND abs(a.at - b.at) <= 48 * 3600 AND (b.us < a.us OR (b.us = a.us AND b.id < a.id))
WHERE KILOMETRES <= 50 OR a.entity = b.entity OR len(list_intersect(a.t, b.t)) / len(list_distinct(list_concat(a.t, b.t))) >= 0.34
""".replace("KILOMETRES", km("a", "b")))
def agg15_upper_bound(spark, sf):
    from meridian.plans.composite import _stories

    return spark.createDataFrame([(K.pair_bound(_stories(spark, sf)),)], "n long")


# ---- status and health ---------------------------------------------------------------------------------------


@query(over_store("""
SELECT 'status' AS part, status AS k, count(*) AS n FROM stories GROUP BY status UNION ALL SELECT 'outlet', outlet, coalesce(n, 0) FROM outlet_health LEFT JOIN (SELECT outlet, count(*) AS n FROM stories GROUP BY outlet) USING (outlet)
UNION ALL SELECT 'flag', flag, count(*) FROM (SELECT unnest(format_flags) AS flag FROM stories) GROUP BY flag
UNION ALL (SELECT 'run', run_id, CAST(epoch(started_at) AS BIGINT) FROM scrape_runs ORDER BY started_at DESC, run_id LIMIT 5) UNION ALL SELECT 'as_of', '', CAST(epoch(max(finished_at)) AS BIGINT) FROM scrape_runs
""", "stories", "outlet_health", "scrape_runs"))
def agg01_status(spark, sf):
    """A status report: stories by status, by outlet beside its health, by flag, the last runs and how recent all is."""
    names = ["stories", "outlet_health", "verifications", "scrape_runs"]
    s = H.status(dict(zip(names, store(spark, sf, *names), strict=True)))
    part = lambda df, name, k, n: df.select(F.lit(name).alias("part"), k.alias("k"), n.cast("long").alias("n"))
    out = part(s["by_status"], "status", F.col("status"), F.col("n")).unionByName(part(s["by_outlet"], "outlet", F.col("outlet"), F.col("stories")))
    out = out.unionByName(part(s["by_flag"], "flag", F.col("flag"), F.col("n"))).unionByName(part(s["runs"], "run", F.col("run_id"), seconds("started_at")))
    return out.unionByName(part(s["data_as_of"], "as_of", F.lit(""), seconds("data_as_of")))


@query(over_store("SELECT round(coalesce(sum(cost_usd) FILTER (CAST(created_at AS DATE) = DATE '2024-01-14'), 0), 6) AS spent, round(coalesce(sum(cost_usd) FILTER (CAST(created_at AS DATE) = DATE '2030-01-01'), 0), 6) AS later FROM llm_calls", "llm_calls"))
def agg06_spend_of_day(spark, sf):
    (calls,) = store(spark, sf, "llm_calls")
    day = lambda d, name: H.spend_of_day(calls, F.lit(d).cast("date")).select(F.round("spent", 6).alias(name))
    return day("2024-01-14", "spent").join(F.broadcast(day("2030-01-01", "later")))


@query(over_store("SELECT DISTINCT model FROM llm_calls WHERE model <> 'alpha'", "llm_calls"))
def agg09_served_models(spark, sf):
    return H.served_models(*store(spark, sf, "llm_calls"), "alpha")


@query(over_store("SELECT stage, model, count(*) FILTER (outcome <> 'error') AS done, count(*) FILTER (outcome = 'error') AS failed, round(sum(cost_usd), 6) AS cost FROM llm_calls GROUP BY ALL", "llm_calls"))
def agg11_run_counters(spark, sf):
    (calls,) = store(spark, sf, "llm_calls")
    return H.counters(calls, ["stage", "model"], F.col("outcome") == "error", "cost_usd").withColumn("cost", F.round("cost", 6))


@query(over_store(r"""
SELECT 'runs:' || outlet AS name, consecutive_failures < 3 AS ok, outlet || ' ' || consecutive_failures || ' failed runs in a row' || CASE WHEN consecutive_failures >= 3 THEN ' could not read https://***:***@h/' || regexp_extract(last_error, '(\d+)$', 1) ELSE '' END AS detail
  FROM outlet_health WHERE outlet <> 'nyt' AND outlet <> 'guardian'
UNION ALL SELECT 'silence:' || outlet, coalesce(floor((epoch(TIMESTAMP '2024-01-31 00:00:00') - epoch(last_new_story_at)) / 60) <= 720, FALSE), concat_ws(' ', outlet, 'last new story', CAST(floor((epoch(TIMESTAMP '2024-01-31 00:00:00') - epoch(last_new_story_at)) / 60) AS BIGINT), 'min ago')
  FROM outlet_health WHERE outlet IN ('bbc', 'pbs')
UNION ALL SELECT 'newest', floor((epoch(TIMESTAMP '2024-01-31 00:00:00') - epoch(max(first_seen_at))) / 60) <= 60, CAST(floor((epoch(TIMESTAMP '2024-01-31 00:00:00') - epoch(max(first_seen_at))) / 60) AS BIGINT) || ' min old' FROM stories WHERE outlet NOT IN ('guardian', 'nyt')
""", "outlet_health", "stories"))
def val03_store_checks(spark, sf):
    return H.store_checks(*store(spark, sf, "outlet_health", "stories"), at("2024-01-31 00:00:00"), ["bbc", "pbs"], schemas.DROPPED_OUTLETS)


@query("""
WITH x AS (SELECT user_id AS name, event_id AS "at", CASE WHEN event_type = 'view' THEN NULL ELSE event_type <> 'error' END AS ok FROM events), k AS (SELECT *, lag(ok) OVER (PARTITION BY name ORDER BY "at") AS before FROM x WHERE ok IS NOT NULL)
SELECT "at", name, CASE WHEN NOT ok AND coalesce(before, TRUE) THEN 'new' WHEN ok AND NOT coalesce(before, TRUE) THEN 'recovered' ELSE 'still' END AS change FROM k WHERE NOT ok OR NOT coalesce(before, TRUE)
""")
def stm08_alerts(spark, sf):
    e = table(spark, sf, "events")
    return H.fold_alerts(e.select(F.col("user_id").alias("name"), F.col("event_id").alias("at"), F.when(F.col("event_type") != "view", F.col("event_type") != "error").alias("ok")))


@query("""
WITH RECURSIVE e AS (SELECT user_id % 40 AS monitor, date_trunc('hour', ts) AS moment, event_type, bool_or(value > 60) AS bad, min(event_id) % 3 <> 0 AS sends FROM events GROUP BY ALL),
s AS MATERIALIZED (SELECT monitor, moment, coalesce(list(event_type ORDER BY event_type) FILTER (bad), []) AS failing, bool_and(sends) AS sent, row_number() OVER (PARTITION BY monitor ORDER BY moment) AS k FROM e GROUP BY monitor, moment),
r AS (SELECT monitor, CAST(0 AS BIGINT) AS k, CAST(NULL AS TIMESTAMP) AS moment, CAST([] AS VARCHAR[]) AS told, CAST(NULL AS TIMESTAMP) AS told_at, CAST([] AS VARCHAR[]) AS fresh, CAST([] AS VARCHAR[]) AS again, CAST([] AS VARCHAR[]) AS gone, FALSE AS due, FALSE AS sent FROM (SELECT DISTINCT monitor FROM s)
 UNION ALL SELECT monitor, k, moment, CASE WHEN says AND sent THEN failing ELSE told END, CASE WHEN says AND sent THEN moment ELSE told_at END, fresh, again, gone, due, sent
 FROM (SELECT *, due OR len(fresh) > 0 OR len(gone) > 0 AS says FROM (SELECT s.monitor, s.k, s.moment, s.failing, s.sent, r.told, r.told_at, list_filter(s.failing, lambda x: NOT list_contains(r.told, x)) AS fresh, list_filter(s.failing, lambda x: list_contains(r.told, x)) AS again,
   list_filter(r.told, lambda x: NOT list_contains(s.failing, x)) AS gone, r.told_at IS NULL OR s.moment - r.told_at >= INTERVAL 24 HOUR AS due FROM r JOIN s ON s.monitor = r.monitor AND s.k = r.k + 1)))
SELECT monitor, CAST(epoch(moment) AS BIGINT) AS "at", array_to_string(fresh, ',') AS fresh, array_to_string(again, ',') AS again, array_to_string(gone, ',') AS gone, due, sent FROM r WHERE k > 0 AND (due OR len(fresh) > 0 OR len(gone) > 0)
""")
def stm08_digests(spark, sf):
    """Monitors that check by the hour, whose messages can't always be sent, with a digest when the last one sent is a day old."""
    e = table(spark, sf, "events").select((F.col("user_id") % 40).alias("monitor"), F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("at"), "event_type", "value", "event_id")
    checks = e.groupBy("monitor", "at", "event_type").agg(F.bool_or(F.col("value") > 60).alias("bad"), (F.min("event_id") % 3 != 0).alias("sends"))
    snapshots = checks.groupBy("monitor", "at").agg(F.collect_list(F.when(F.col("bad"), F.col("event_type"))).alias("failing"), F.bool_and("sends").alias("sent"))
    rows = H.fold_digests(snapshots, "monitor")
    joined = lambda c: F.array_join(c, ",")
    return rows.select("monitor", F.unix_timestamp("at").alias("at"), joined("new").alias("fresh"), joined("still").alias("again"), joined("recovered").alias("gone"), "due", "sent")


@query("SELECT o_custkey % 3 AS n, CASE o_custkey % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE ELSE TRUE END AS old FROM orders GROUP BY ALL")
def val05_names_rule(spark, sf):
    """Gazetteers without a rule number, with this one's, and with one that is no number."""
    meta = lambda *v: spark.createDataFrame([("names_rule", x) for x in v], "key string, value string")
    told = [G.names_rule_is_old(meta()), G.names_rule_is_old(meta(str(G.NAMES_RULE))), G.names_rule_is_old(meta("x"))]
    n = (F.col("o_custkey") % 3).alias("n")
    return table(spark, sf, "orders").select(n).distinct().withColumn("old", F.get(F.array(*map(F.lit, told)), F.col("n").cast("int")))


@query("""
SELECT o_custkey AS build, coalesce(max(CASE WHEN o_orderstatus <> 'F' THEN TRY_CAST(CASE o_orderkey % 3 WHEN 0 THEN '2' WHEN 1 THEN 'x' ELSE '1' END AS INT) END), 1) AS rule,
  coalesce(max(CASE WHEN o_orderstatus <> 'F' THEN TRY_CAST(CASE o_orderkey % 3 WHEN 0 THEN '2' WHEN 1 THEN 'x' ELSE '1' END AS INT) END), 1) < 2 AS is_old FROM orders GROUP BY o_custkey
""")
def val05_names_rules(spark, sf):
    """Builds by customer: with this code's rule, an older one, one that is no number, and without any."""
    o = table(spark, sf, "orders")
    key = F.when(F.col("o_orderstatus") != "F", F.lit("names_rule")).otherwise(F.lit("built_at"))
    return G.names_rules(o.select(F.col("o_custkey").alias("build"), key.alias("key"), F.get(F.array(F.lit("2"), F.lit("x"), F.lit("1")), (F.col("o_orderkey") % 3).cast("int")).alias("value")))


@query("SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 3 = 0 THEN o_custkey * 50 ELSE greatest(o_custkey * 50, 20000) END AS BIGINT) AS most FROM orders")
def top09_run_limits(spark, sf):
    o = table(spark, sf, "orders")
    cursor = F.when(o.o_orderkey % 3 == 0, F.lit("c")).when(o.o_orderkey % 3 == 1, F.lit(""))
    return o.select("o_orderkey", X.run_limits(cursor, (o.o_custkey * 50).cast("long")).alias("most"))


@query("SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN TRUE WHEN 1 THEN FALSE WHEN 2 THEN o_custkey % 600 <= 300 ELSE FALSE END AS good FROM orders")
def hsh05_verified_rows(spark, sf):
    """Signatures of orders' bodies that are right and fresh, forged, of several ages, of another body, and missing."""
    o = table(spark, sf, "orders")
    text = lambda n: F.concat_ws("\n", F.lit("relay"), F.lit("1000"), F.sha2((o.o_orderkey + n).cast("string"), 256))
    k = o.o_orderkey % 5
    given = F.when(k.isin(0, 2), hashing.signature("s", text(0))).when(k == 1, hashing.signature("t", text(0))).when(k == 3, hashing.signature("s", text(1)))
    age = F.when(k == 2, o.o_custkey % 600).otherwise(F.lit(10))
    return o.select("o_orderkey", hashing.is_verified("s", text(0), given, F.lit(1000), F.lit(1000) + age).alias("good"))


@query("""
SELECT o_orderkey AS id, unnest(CASE o_orderkey % 8 WHEN 1 THEN ['missing: items', 'snapshotId', 'pinsWithheld'] || [] WHEN 2 THEN ['unknown: extra'] WHEN 3 THEN ['outlet bbc: 2 times', 'outlet pbs: 0 times', 'outlet zz'] WHEN 4 THEN ['pins withheld but sent']
  WHEN 5 THEN ['not an object'] WHEN 6 THEN ['schema', 'generatedAt', 'world news withheld but sent'] WHEN 7 THEN ['not an object'] ELSE [] END) AS problem FROM orders
""")
def set05_frame_problems(spark, sf):
    """A body for each order: whole, without a key, with one too many, with other outlets, belied by its items, no object, no JSON."""
    import json

    outlets = [{"outlet": x} for x in S.OUTLETS]
    whole = {"schema": S.SCHEMA, "snapshotId": "snap_" + "0" * 16, "generatedAt": "2024-01-01T00:00:00Z", "dataAsOf": "2024-01-01T00:00:00Z", "pinsWithheld": False, "worldNewsWithheld": False, "outlets": outlets, "items": []}
    bodies = [
        whole, {k: v for k, v in whole.items() if k != "items"} | {"snapshotId": "x", "pinsWithheld": "no"}, whole | {"extra": None}, whole | {"outlets": [{"outlet": x} for x in ["reuters", "bbc", "bbc", "guardian", "nyt", "zz"]]},
        whole | {"pinsWithheld": True, "items": [{"id": 1}, {"location": {"lat": 1.0}}]}, [whole], whole | {"schema": 1, "generatedAt": "today", "worldNewsWithheld": True, "items": [{"location": None}]},
    ]
    texts = F.array(*(F.lit(json.dumps(b)) for b in bodies), F.lit("{"))
    o = table(spark, sf, "orders")
    return S.frame_problems(o.select(F.col("o_orderkey").alias("id"), F.get(texts, (o.o_orderkey % 8).cast("int")).alias("body")), "id", "body")


# ---- the gazetteer -------------------------------------------------------------------------------------------

_NAMES = """
names AS (SELECT lower(name) AS folded, geonames_id, 'name' AS source FROM places
  UNION ALL SELECT lower(ascii_name), geonames_id, 'ascii' FROM places WHERE lower(ascii_name) <> lower(name)
  UNION ALL SELECT a.folded, a.geonames_id, a.source FROM alternates a JOIN places p ON p.geonames_id = a.geonames_id WHERE a.folded <> '' AND (a.source <> 'wikipedia' OR p.feature_class IN ('P', 'S')))"""
_GAZETTEER = _NAMES + """,
kept AS (SELECT *, CASE WHEN feature_class = 'S' THEN 'point' ELSE CASE feature_code WHEN 'PPL' THEN 'city' WHEN 'PPLC' THEN 'city' WHEN 'PPLX' THEN 'district' WHEN 'ADM1' THEN 'region' WHEN 'ADM2' THEN 'region' WHEN 'PCLI' THEN 'country' END END AS prec FROM places)"""


@query(over_store("SELECT folded, geonames_id, source FROM names", "places", "alternates", more=_NAMES))
def jn12_build_names(spark, sf):
    return G.build_names(*store(spark, sf, "places", "alternates"))


@query(over_store("""
SELECT DISTINCT q.query_id, k.geonames_id, k.prec AS "precision", k.prec IN ('point', 'district', 'city') AS pinnable
FROM (SELECT event_id AS query_id, CASE WHEN event_id % 3 = 0 THEN 'alt ' || event_id % 90 ELSE 'town ' || event_id % 70 END AS folded, 'C' || event_id % 6 AS country FROM events) q JOIN names n USING (folded) JOIN kept k ON k.geonames_id = n.geonames_id AND k.country = q.country
""", "places", "alternates", more=_GAZETTEER))
def jn11_gazetteer_candidates(spark, sf):
    places, alternates = store(spark, sf, "places", "alternates")
    e = table(spark, sf, "events")
    name = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit(" Alt  "), F.col("event_id") % 90)).otherwise(F.concat(F.lit("TOWN "), F.col("event_id") % 70))
    asked = e.select(F.col("event_id").alias("query_id"), name.alias("name"), F.concat(F.lit(" c"), F.col("event_id") % 6).alias("country"))
    found = G.candidates(asked, G.build_names(places, alternates), places)
    return found.select("query_id", F.col("place.geonames_id").alias("geonames_id"), F.col("place.precision").alias("precision"), F.coalesce("place.pinnable", F.lit(False)).alias("pinnable"))


@query(over_store(f"""
SELECT k.geonames_id, h.geonames_id AS container_id FROM kept k JOIN kept h ON h.country = k.country AND h.geonames_id % 7 IN (0, 3, 5)
WHERE CASE WHEN coalesce(h.prec = 'country', FALSE) THEN TRUE WHEN h.feature_code = 'ADM1' AND h.admin1 IS NOT NULL AND k.admin1 IS NOT NULL THEN k.admin1 = h.admin1
  WHEN h.feature_code = 'ADM2' AND h.admin2 IS NOT NULL AND k.admin2 IS NOT NULL AND k.admin1 IS NOT NULL THEN k.admin2 = h.admin2 AND k.admin1 IS NOT DISTINCT FROM h.admin1
  ELSE {km("k", "h")} <= CASE WHEN h.prec = 'region' THEN 150 ELSE 30 END END
""", "places", "alternates", more=_GAZETTEER))
def jn17_contained(spark, sf):
    """Every place and each of three sevenths of the places as a container, met by country, code or grid square."""
    places = G.with_precision(store(spark, sf, "places")[0])
    return G.contained(places, places.filter("geonames_id % 7 IN (0, 3, 5)"))


@query(over_store("SELECT r.story_id, r.geonames_id, p.name, p.prec AS \"precision\", p.population FROM resolutions r LEFT JOIN kept p USING (geonames_id)", "places", "alternates", "resolutions", more=_GAZETTEER))
def jn15_looked_up(spark, sf):
    found, places = store(spark, sf, "resolutions", "places")
    rows = G.looked_up(found.select("story_id", "geonames_id"), places)
    return rows.select("story_id", "geonames_id", "place.name", "place.precision", "place.population")


def _decided(asked: str, climbs: bool) -> str:
    """SQL of one pass over asked(query_id, name, country, kind, held): the best candidate within the container, or why there is none."""
    fits = "CASE WHEN k.prec IS NULL THEN -99 WHEN w.wanted IS NULL THEN 0 ELSE -abs(list_position(['point', 'district', 'city', 'region', 'country'], k.prec) - w.wanted) END"
    inside = f"""CASE WHEN h.geonames_id IS NULL THEN TRUE WHEN coalesce(h.prec = 'country', FALSE) THEN TRUE WHEN h.feature_code = 'ADM1' AND h.admin1 IS NOT NULL AND k.admin1 IS NOT NULL THEN k.admin1 = h.admin1
      WHEN h.feature_code = 'ADM2' AND h.admin2 IS NOT NULL AND k.admin2 IS NOT NULL AND k.admin1 IS NOT NULL THEN k.admin2 = h.admin2 AND k.admin1 IS NOT DISTINCT FROM h.admin1
      ELSE {km("k", "h")} <= CASE WHEN h.prec = 'region' THEN 150 ELSE 30 END END"""
    apart = f"""CASE WHEN r.feature_code = 'ADM1' AND r.admin1 IS NOT NULL AND b.admin1 IS NOT NULL THEN b.admin1 <> r.admin1
      WHEN r.feature_code = 'ADM2' AND r.admin2 IS NOT NULL AND b.admin2 IS NOT NULL AND b.admin1 IS NOT NULL THEN NOT (b.admin2 = r.admin2 AND b.admin1 IS NOT DISTINCT FROM r.admin1) ELSE {km("b", "r")} > 150 END"""
    climb = "a.held IS NOT NULL" if climbs else "FALSE"
    return f"""(WITH w AS (SELECT *, list_position(['point', 'district', 'city', 'region', 'country'], CASE lower(trim(kind)) WHEN 'venue' THEN 'point' WHEN 'street' THEN 'point' WHEN 'district' THEN 'district' WHEN 'city' THEN 'city' WHEN 'region' THEN 'region' WHEN 'country' THEN 'country' END) AS wanted,
  coalesce(lower(trim(kind)) IN ('region', 'country'), FALSE) AS area FROM {asked}),
near AS (SELECT DISTINCT w.query_id, w.area, k.*, coalesce(k.prec IN ('point', 'district', 'city'), FALSE) AS pin, {fits} AS fit FROM w JOIN names n ON n.folded = lower(trim(w.name)) JOIN kept k ON k.geonames_id = n.geonames_id AND k.country = w.country LEFT JOIN kept h ON h.geonames_id = w.held WHERE {inside}),
pool AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY fit DESC, population DESC, geonames_id) AS rn FROM near WHERE NOT area OR NOT pin),
best AS (SELECT * FROM pool WHERE rn = 1),
region AS (SELECT b.query_id, arg_min(r.geonames_id, r.rn) AS geonames_id FROM best b JOIN pool r ON r.query_id = b.query_id AND r.prec = 'region' WHERE b.pin AND b.population <= 0 AND {apart} GROUP BY b.query_id),
unclear AS (SELECT b.query_id FROM best b JOIN pool s ON s.query_id = b.query_id AND s.rn = 2 WHERE b.fit = s.fit AND {km("b", "s")} > 25 AND CASE WHEN b.population > 0 THEN s.population >= b.population * 0.5 ELSE s.population = 0 END),
told AS (SELECT a.query_id, a.held, CASE WHEN coalesce(trim(a.name), '') = '' THEN 'no_name' WHEN coalesce(trim(a.country), '') = '' THEN 'no_country'
  WHEN a.query_id NOT IN (SELECT query_id FROM near) THEN CASE WHEN {climb} THEN 'climbed_no_match' ELSE 'no_match' END
  WHEN b.query_id IS NULL THEN CASE WHEN {climb} AND h.prec IN ('region', 'country') THEN 'climbed_only_towns' ELSE 'only_towns' END
  WHEN g.geonames_id IS NOT NULL THEN 'region_of_that_name' WHEN a.query_id IN (SELECT query_id FROM unclear) THEN CASE WHEN {climb} THEN 'climbed_ambiguous' ELSE 'ambiguous' END ELSE 'matched' END AS outcome, b.geonames_id AS best, g.geonames_id AS region
  FROM {asked} a LEFT JOIN best b ON b.query_id = a.query_id LEFT JOIN region g ON g.query_id = a.query_id LEFT JOIN kept h ON h.geonames_id = a.held)
SELECT query_id, outcome, CASE WHEN outcome LIKE 'climbed%' THEN held WHEN outcome = 'region_of_that_name' THEN region WHEN outcome = 'matched' THEN best END AS place FROM told)"""


_ASKED = _GAZETTEER + """,
asked AS (SELECT event_id AS query_id, CASE WHEN event_id % 17 = 0 THEN ' ' WHEN event_id % 3 = 0 THEN 'alt ' || event_id % 90 ELSE 'town ' || event_id % 62 END AS name, CASE WHEN event_id % 5 = 0 THEN 'town ' || event_id % 59 WHEN event_id % 5 = 1 THEN '' END AS within,
  CASE WHEN event_id % 19 <> 0 THEN 'C' || event_id % 5 ELSE '' END AS country, CASE WHEN event_id % 7 < 6 THEN split_part('venue,street,city,region,country,district', ',', CAST(1 + event_id % 7 AS INT)) END AS kind FROM events),
containers AS (SELECT country || chr(10) || within AS query_id, within AS name, country, NULL AS kind, CAST(NULL AS BIGINT) AS held FROM (SELECT DISTINCT country, within FROM asked WHERE trim(within) <> '' AND trim(country) <> '')),
inner_pass AS """ + _decided("containers", False) + """,
outer_asked AS (SELECT a.query_id, a.name, a.country, a.kind, i.place AS held FROM asked a LEFT JOIN inner_pass i ON i.query_id = a.country || chr(10) || a.within AND trim(a.within) <> ''),
resolved AS """ + _decided("outer_asked", True)


def _asked(spark, sf):
    n = F.col("event_id")
    number = lambda word, m: F.concat(F.lit(word), n % m)
    kinds = F.array(*map(F.lit, ["venue", "street", "city", "region", "country", "district"]))
    return table(spark, sf, "events").select(
        n.alias("query_id"),
        F.when(n % 17 == 0, F.lit(" ")).when(n % 3 == 0, number("alt ", 90)).otherwise(number("town ", 62)).alias("name"),
        F.when(n % 5 == 0, number("town ", 59)).when(n % 5 == 1, F.lit("")).alias("within"),
        F.when(n % 19 != 0, number("C", 5)).otherwise(F.lit("")).alias("country"),
        F.when(n % 7 < 6, F.get(kinds, (n % 7).cast("int"))).alias("kind"),
    )


@query(over_store("SELECT query_id, outcome, place AS geonames_id, prec AS \"precision\", coalesce(prec IN ('point', 'district', 'city'), FALSE) AS pinnable, outcome LIKE 'climbed%' AS climbed FROM resolved LEFT JOIN kept ON geonames_id = place", "places", "alternates", more=_ASKED))
def alg01_resolve(spark, sf):
    """Names, with or without what they lie within, resolved against the gazetteer, with each outcome that there is."""
    places, alternates = store(spark, sf, "places", "alternates")
    rows = G.resolve(_asked(spark, sf), G.build_names(places, alternates), places)
    return rows.select("query_id", "outcome", F.col("place.geonames_id").alias("geonames_id"), "precision", "pinnable", "climbed")


_SHOWN = """
keyed AS (SELECT p.*, a2.name AS area2, a1.name AS area1, c.name AS country_name FROM places p LEFT JOIN admin_areas a2 ON a2.code = p.country || '.' || p.admin1 || '.' || p.admin2 LEFT JOIN admin_areas a1 ON a1.code = p.country || '.' || p.admin1 LEFT JOIN countries c ON c.code = p.country),
middle AS (SELECT *, coalesce(area2, area1) AS area FROM keyed),
told AS (SELECT geonames_id, name, CASE WHEN NOT (starts_with(lower(area), lower(name)) AND NOT regexp_matches(substr(area, length(name) + 1, 1), '[a-zA-Z0-9]')) THEN area END AS area, country_name FROM middle),
shown AS (SELECT geonames_id, concat_ws(', ', name, CASE WHEN lower(area) <> lower(name) THEN area END, CASE WHEN lower(country_name) <> lower(name) AND lower(country_name) IS DISTINCT FROM lower(area) THEN country_name END) AS display_name FROM told)"""


@query(over_store("SELECT geonames_id, display_name FROM shown", "places", "countries", "admin_areas", more=_SHOWN))
def jn14_display_names(spark, sf):
    return G.display_names(*store(spark, sf, "places", "countries", "admin_areas"))


@query(over_store("""
SELECT query_id, geonames_id AS id, display_name AS name, round_even(latitude, 4) AS lat, round_even(longitude, 4) AS lon, CASE WHEN climbed THEN 'area' WHEN prec = 'point' THEN 'facility' ELSE 'area' END AS "precision", climbed AS fallback
FROM (SELECT r.query_id, r.outcome LIKE 'climbed%' AS climbed, k.*, a.kind FROM resolved r JOIN kept k ON k.geonames_id = r.place JOIN asked a ON a.query_id = r.query_id WHERE k.prec IN ('point', 'district', 'city'))
LEFT JOIN shown USING (geonames_id) WHERE NOT climbed OR (kind = 'venue' AND prec IN ('city', 'district'))
""", "places", "alternates", "countries", "admin_areas", more=_SHOWN + "," + _ASKED))
def alg02_feed_places(spark, sf):
    places, alternates, countries, areas = store(spark, sf, "places", "alternates", "countries", "admin_areas")
    asked = _asked(spark, sf)
    return G.feed_places(G.resolve(asked, G.build_names(places, alternates), places), asked, G.display_names(places, countries, areas))


@query("""
WITH p AS (SELECT event_id, user_id, 'x ' || string_agg('https://h/?d=' || (user_id + k) % 4 || '&x=1 and &d=' || event_id % 3, ' ' ORDER BY k) AS page FROM events, range(5) t(k) GROUP BY ALL),
n AS (SELECT event_id, d, count(*) AS n FROM (SELECT event_id, unnest(regexp_extract_all(page, '[?&]d=(\\d+)', 1)) AS d FROM p) GROUP BY ALL) SELECT event_id, arg_max(d, (n, d)) AS deployment FROM n GROUP BY event_id
""")
def agg12_deployment(spark, sf):
    parts = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda k: F.concat(F.lit("https://h/?d="), (F.col("user_id") + k) % 4, F.lit("&x=1 and &d="), F.col("event_id") % 3))
    return table(spark, sf, "events").select("event_id", pages.deployment_of(F.concat(F.lit("x "), F.array_join(parts, " "))).alias("deployment"))


# ---- order of clusters ---------------------------------------------------------------------------------------


@query("SELECT event_id, least(pow(2, greatest(event_id % 9 - 1, 0)), 60) * (0.5 + (event_id % 10) / 10.0) AS plain, CASE event_id % 4 WHEN 0 THEN 7.0 WHEN 1 THEN 60.0 ELSE least(pow(2, greatest(event_id % 9 - 1, 0)), 60) * (0.5 + (event_id % 10) / 10.0) END AS asked FROM events")
def mth08_retry_delay(spark, sf):
    n = F.col("event_id")
    after = F.when(n % 4 == 0, F.lit(" 7 ")).when(n % 4 == 1, F.lit("900")).when(n % 4 == 2, F.lit("Wed, 21 Oct"))
    jitter = (n % 10) / 10.0
    return table(spark, sf, "events").select("event_id", times.retry_delay(n % 9, jitter).alias("plain"), times.retry_delay(n % 9, jitter, retry_after=after).alias("asked"))


@query("""
SELECT p_partkey, strftime(to_timestamp(p_partkey * 1000003 / 1000.0) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S.') || lpad(CAST(p_partkey * 1000003 % 1000 AS VARCHAR), 3, '0') || 'Z' AS iso,
  CASE WHEN p_retailprice = floor(p_retailprice) THEN 0 WHEN round(p_retailprice * 10) / 10 = p_retailprice THEN 1 ELSE 2 END AS digits FROM part
""")
def dt04_millis_and_decimals(spark, sf):
    return table(spark, sf, "part").select("p_partkey", times.iso_from_millis(F.col("p_partkey") * 1000003).alias("iso"), geo.decimals("p_retailprice").cast("int").alias("digits"))


_FLAGS = {
    0: ("reuters", "https://r/live-x", {"subjects": ["ANLINS", "zz", "fbox"], "media": ["Video", "image"]}, "analysis,factbox,live,video"),
    1: ("bbc", "https://b/x", {"types": ["Photo Gallery"], "subtypes": ["Pod-cast", "odd"]}, "gallery,podcast"),
    2: ("bbc", "https://b/x", {"types": ["correspondent"]}, "other_format"),
    3: ("guardian", "https://g/x/live", {"tones": ["Minute by minute", "Letters"], "design": ["QuizDesign"], "card_types": ["audio", "text"]}, "audio,live,opinion,quiz"),
    4: ("pbs", "https://p/newshour/show/x", {"post_type": ["post"], "video_without_text": ["true"]}, "broadcast,video"),
    5: ("nyt", "https://n/2026/opinion/crosswords/x", {}, "opinion,quiz"),
    6: ("other", "https://o/opinion/x", {"tones": ["comment"]}, ""),
}


@query("SELECT event_id, CASE event_id % 7 " + " ".join(f"WHEN {i} THEN '{flags}'" for i, (*_, flags) in _FLAGS.items()) + " END AS flags FROM events")
def str13_flags_by_labels(spark, sf):
    """Flags of pages by the address and labels of each outlet in turn."""
    n = F.pmod("event_id", F.lit(7))
    pick = lambda value: F.coalesce(*(F.when(n == i, value(row)) for i, row in _FLAGS.items()))
    empty = F.create_map().cast("map<string,array<string>>")
    labels = pick(lambda row: F.create_map(*(x for k, v in row[2].items() for x in (F.lit(k), F.array(*map(F.lit, v))))) if row[2] else empty)
    e = table(spark, sf, "events").withColumns({"o": pick(lambda row: F.lit(row[0])), "u": pick(lambda row: F.lit(row[1])), "l": labels})
    return e.select("event_id", F.array_join(I.format_flags(F.col("o"), F.col("u"), F.col("l")), ",").alias("flags"))


@query("SELECT r_regionkey, CAST(CASE WHEN r_regionkey = 0 THEN 20000 ELSE greatest(r_regionkey * 10000, CASE WHEN r_regionkey % 2 = 0 THEN 20000 ELSE 0 END) END AS BIGINT) AS most FROM region")
def top09_run_limit(spark, sf):
    """How many rows a run sends: with a cursor its limit, without one the whole window."""
    rows = [(k, X.run_limit("cursor" if k % 2 else None, k * 10_000)) for k in (r.r_regionkey for r in table(spark, sf, "region").select("r_regionkey").collect())]
    return spark.createDataFrame(rows, "r_regionkey int, most long")


@query("""
SELECT * FROM (VALUES ('whole', ''), ('lacks', 'missing: items'), ('lacks', 'unknown: extra'), ('lacks', 'snapshotId'), ('lacks', 'pinsWithheld'), ('outlets', 'outlet bbc: 2 times'), ('outlets', 'outlet pbs: 0 times'), ('outlets', 'outlet zz'), ('withheld', 'pins withheld but sent')) t(body, problem)
WHERE EXISTS (SELECT 1 FROM region)
""")
def set05_body_problems(spark, sf):
    """The frame of a body: fields that are missing or unknown, outlets, flags that its items belie."""
    whole = {"schema": S.SCHEMA, "snapshotId": "snap_" + "0" * 16, "generatedAt": "2024-01-01T00:00:00Z", "dataAsOf": "2024-01-01T00:00:00Z", "pinsWithheld": False, "worldNewsWithheld": False, "outlets": [{"outlet": o} for o in S.OUTLETS], "items": []}
    lacks = {k: v for k, v in whole.items() if k != "items"} | {"extra": 1, "snapshotId": "x", "pinsWithheld": "no"}
    outlets = whole | {"outlets": [{"outlet": o} for o in ["reuters", "bbc", "bbc", "guardian", "nyt", "zz"]]}
    withheld = whole | {"pinsWithheld": True, "items": [{"location": {"lat": 1.0}}]}
    found = [(name, p) for name, body in {"whole": whole, "lacks": lacks, "outlets": outlets, "withheld": withheld}.items() for p in S.body_problems(body) or [""]]
    return spark.createDataFrame(found, "body string, problem string")


@query("SELECT r_regionkey, r_regionkey < 3 AS good FROM region")
def hsh05_verified(spark, sf):
    """Signatures that are right and fresh, that are forged, and that are too old."""


    text = hashing.signing_text("relay", 1_000, b"body")
    good = hashing.sign("s", text)
    said = {0: (good, 1000.0, 1000.0), 1: (good, 1000.0, 1300.0), 2: (good, 1300.0, 1000.0), 3: (hashing.sign("t", text), 1000.0, 1000.0), 4: (good, 1000.0, 1301.0)}
    keys = [r.r_regionkey for r in table(spark, sf, "region").select("r_regionkey").collect()]
    return spark.createDataFrame([(k, hashing.verified("s", text, *said[k])) for k in keys], "r_regionkey int, good boolean")
