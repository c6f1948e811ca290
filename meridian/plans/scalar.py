"""String, time, number and hash functions over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from meridian.functions import geo, hashing, jsons, times
from meridian.functions import text as T
from meridian.operators import checks as C
from meridian.plans.registry import SQL, query, table
from meridian.plans.relational import _CANONICAL


@query("SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '\\s+', ' ', 'g')) AS words FROM pages WHERE NOT contains(html, '&')")
def str01_clean_html(spark, sf):
    """Pages without a reference only, as its SQL says; str01_clean_html_all has every page."""
    return table(spark, sf, "pages").filter(~F.col("html").contains("&")).select("page_id", T.clean_text("html").alias("words"))


@query(r"""
WITH bare AS (SELECT page_id, regexp_replace(html, '<[^>]+>', '', 'g') AS t FROM pages),
decoded AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '&quot;?', '"', 'g'), '&copy;?', '©', 'g'), '&middot;?', '·', 'g'), '&amp;?', '&', 'g') AS t FROM bare)
SELECT page_id, trim(regexp_replace(regexp_replace(t, '[\x{200B}\x{200C}\x{200D}\x{2060}\x{FEFF}]', '', 'g'), '[\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}]+', ' ', 'g')) AS words FROM decoded
""")
def str01_clean_html_all(spark, sf):
    """Every page, references decoded: the SQL those four that the driver's pages have, a test any against html.unescape."""
    return table(spark, sf, "pages").select("page_id", T.clean_text("html").alias("words"))


@query("""
SELECT doc_id, len(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')) AS n, md5(array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> ''), chr(10) || chr(10))) AS joined FROM documents
""")
def str02_paragraphs(spark, sf):
    d = table(spark, sf, "documents").withColumn("parts", F.split("text", "\n"))
    return d.select("doc_id", F.size(F.filter("parts", lambda x: F.trim(x) != "")).cast("long").alias("n"), F.md5(T.paragraphs("parts")).alias("joined"))


@query("SELECT p_partkey, lower(p_name) AS folded, lower(p_brand) = lower(p_name) OR starts_with(lower(p_name) || ' x', lower(p_name)) AS restated FROM part")
def str03_fold(spark, sf):
    return table(spark, sf, "part").select("p_partkey", T.fold("p_name").alias("folded"), T.restates("p_name", F.concat("p_name", F.lit(" x"))).alias("restated"))


@query(f"SELECT page_id, {_CANONICAL} AS url FROM pages")
def str05_canonical_url(spark, sf):
    return table(spark, sf, "pages").select("page_id", T.canonical_url("url").alias("url"))


@query("""
WITH p AS (SELECT page_id, list_filter(string_split(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') AS s FROM pages),
q AS (SELECT page_id, s[1:greatest(len(s) - 1, 0)] AS s FROM p), r AS (SELECT page_id, s, list_position(list_transform(s, lambda x: NOT regexp_full_match(x, '\\d+')), TRUE) AS f FROM q),
t AS (SELECT page_id, CASE WHEN coalesce(f, 0) = 0 THEN [] ELSE s[f:] END AS s FROM r)
SELECT page_id, array_to_string(CASE WHEN coalesce(list_position(list_transform(s, lambda x: regexp_full_match(x, '\\d+')), TRUE), 0) > 0 THEN s[1:list_position(list_transform(s, lambda x: regexp_full_match(x, '\\d+')), TRUE) - 1] ELSE s END, '/') AS section FROM t
""")
def str06_url_section(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.array_join(T.url_sections("url"), "/").alias("section"))


@query("""
SELECT conv_id, turn, array_to_string(list_distinct_keep, '|') AS names FROM (SELECT conv_id, turn, list_filter(list_transform(list_filter(regexp_split_to_array(text, ',\\s+and\\s+|,|\\s+and\\s+'), lambda x: TRUE), lambda x: trim(x)),
  lambda x, i: x <> '' AND lower(x) <> 'and' AND list_position(list_transform(regexp_split_to_array(text, ',\\s+and\\s+|,|\\s+and\\s+'), lambda y: trim(y)), x) = i) AS list_distinct_keep FROM conversations WHERE role = 'user')
""")
def str07_split_authors(spark, sf):
    return table(spark, sf, "conversations").filter("role = 'user'").select("conv_id", "turn", F.array_join(T.split_authors("text"), "|").alias("names"))


@query(SQL["str07_split_authors"].replace(" WHERE role = 'user'", ""))
def str07_split_authors_all(spark, sf):
    """The turns of every role."""
    return table(spark, sf, "conversations").select("conv_id", "turn", F.array_join(T.split_authors("text"), "|").alias("names"))


@query("SELECT doc_id, CASE WHEN n_chars % 2 = 0 AND n_chars > 0 THEN n_chars ELSE len(string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' ')) END AS words FROM documents WHERE trim(regexp_replace(text, '\\s+', ' ', 'g')) <> ''")
def str11_word_count(spark, sf):
    d = table(spark, sf, "documents").filter(T.normalise("text") != "")
    return d.select("doc_id", T.word_count(F.when(F.col("n_chars") % 2 == 0, F.col("n_chars").cast("string")), "text").cast("long").alias("words"))


@query("""
SELECT page_id, array_to_string(list_sort(list_filter([CASE WHEN contains(p, '/live/') OR contains(p, '/live-') OR ends_with(p, '/live') THEN 'live' END, CASE WHEN contains(p, '/opinion/') THEN 'opinion' END, CASE WHEN contains(p, '/video/') THEN 'video' END],
  lambda x: x IS NOT NULL)), ',') AS flags FROM (SELECT page_id, lower(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)) AS p FROM pages)
""")
def str13_format_flags(spark, sf):
    from meridian.operators.identity import format_flags

    flags = format_flags(F.lit("nyt"), F.col("url"), F.create_map().cast("map<string,array<string>>"))
    return table(spark, sf, "pages").select("page_id", F.array_join(F.filter(flags, lambda x: x.isin("live", "opinion", "video")), ",").alias("flags"))


@query("""
WITH b AS (SELECT item_id, substr(trim(regexp_replace(text, '\\s+', ' ', 'g')), 1, 60) AS q FROM benchmark)
SELECT doc_id, item_id FROM documents JOIN b ON contains(trim(regexp_replace(text, '\\s+', ' ', 'g')), q)
""")
def str15_verbatim_quote(spark, sf):
    """Texts that have the whole of a benchmark text; the SQL looks for its first 60 characters, which gives the same rows of the driver's tables."""
    return C.quoted(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("""
SELECT doc_id, CASE WHEN regexp_matches(q, '(?i)\\b(is|are|was|were)\\s+(scheduled|due|expected|set|slated)\\s+to\\b|\\bwill\\s+(appear|take place|be held|go on trial|face)\\b|\\bplanned for\\b|\\bplans to\\b') THEN 'planned' END AS failure
FROM (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS q FROM documents) WHERE q <> ''
""")
def str16_evidence(spark, sf):
    d = table(spark, sf, "documents").filter(T.normalise("text") != "")
    failure = T.evidence_failure("text", F.lit("a place that nothing names"))
    return d.select("doc_id", F.when(failure == "planned", failure).alias("failure"))


def _pattern(p: str) -> str:
    return "'" + p.replace("'", "''") + "'"


@query(f"""
WITH d AS (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS q FROM documents), p AS (SELECT doc_id, q, string_split(q, ' ')[1] AS place FROM d WHERE q <> '')
SELECT doc_id, place, CASE WHEN regexp_matches(q, {_pattern(T.ATTRIBUTION)} || '\\s*,?\\s*(?:in|at|from|near|outside)\\s+' || regexp_escape(place)) THEN 'spoken_to_a_reporter' WHEN regexp_matches(q, {_pattern(T.PLANNED)}) THEN 'planned'
  WHEN regexp_matches(q, {_pattern(T.DATELINE)}) AND NOT contains(lower(regexp_replace(q, {_pattern(T.DATELINE)}, '')), lower(place)) THEN 'dateline' END AS failure FROM p
""")
def str16_evidence_all(spark, sf):
    """Every outcome of the three rules, with the first word of the text as the place; a test compares it with the rules by hand too."""
    d = table(spark, sf, "documents").filter(T.normalise("text") != "")
    place = F.get(F.split(T.normalise("text"), " "), F.lit(0))
    return d.select("doc_id", place.alias("place"), T.evidence_failure("text", place).alias("failure"))


@query("""
WITH a AS (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM documents), b AS (SELECT doc_id, t, string_split(t, ' ')[101] AS place, lower(trim(coalesce(string_split(t, ' ')[101], ''))) AS n FROM a),
c AS (SELECT *, length(t) - 200 AS room, CASE WHEN n <> '' THEN instr(lower(t), n) ELSE 0 END AS hit FROM b), d AS (SELECT *, CASE WHEN hit > 0 THEN least(greatest(hit - 1 + length(n) // 2 - 100, 0), room) ELSE 0 END AS st FROM c),
e AS (SELECT *, substr(t, st + 1, 200) AS w FROM d), f AS (SELECT *, CASE WHEN st > 0 AND n <> '' AND contains(w, ' ') AND contains(lower(substr(w, instr(w, ' ') + 1)), n) THEN substr(w, instr(w, ' ') + 1) ELSE w END AS o FROM e),
g AS (SELECT *, regexp_extract(o, '^(.*) [^ ]*$', 1) AS tail FROM f),
h AS (SELECT doc_id, place, CASE WHEN length(t) <= 200 THEN nullif(t, '') WHEN st < room AND contains(o, ' ') AND (n = '' OR contains(lower(tail), n)) THEN trim(tail) ELSE trim(o) END AS evidence FROM g)
SELECT doc_id, place, evidence, CAST(length(evidence) AS INT) AS n FROM h
""")
def str17_trim_evidence(spark, sf):
    d = table(spark, sf, "documents")
    told = T.let(T.normalise("text"), lambda t: T.let(F.get(F.split(t, " ", 102), F.lit(100)), lambda word: F.struct(word.alias("place"), T.trim_evidence(t, word).alias("evidence"))))
    return d.select("doc_id", told.alias("told")).select("doc_id", "told.place", "told.evidence", F.length("told.evidence").alias("n"))


@query("""
WITH t AS (SELECT doc_id, list_distinct(list_filter(regexp_extract_all(lower(text), '[a-z0-9]+'), lambda w: length(w) > 2 AND NOT list_contains(string_split(
  'a an and are as at be by for from has have in is it its of on or that the to was were with after before says said new latest live update updates', ' '), w))) AS t FROM documents)
SELECT a.doc_id, len(a.t) AS n, round(CASE WHEN len(a.t) = 0 OR len(b.t) = 0 THEN 0 ELSE len(list_intersect(a.t, b.t)) / len(list_distinct(list_concat(a.t, b.t))) END, 6) AS overlap FROM t a JOIN t b ON b.doc_id = a.doc_id + 1
""")
def str19_tokens_jaccard(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", T.headline_tokens("text").alias("t"))
    after = d.select((F.col("doc_id") - 1).alias("doc_id"), F.col("t").alias("u"))
    return d.join(after, "doc_id").select("doc_id", F.size("t").cast("long").alias("n"), F.round(T.jaccard("t", "u"), 6).alias("overlap"))


@query("SELECT doc_id, md5(regexp_replace(text, '(?i)\\b([a-z][a-z0-9+.\\-]*://)[^\\s/@:]+:[^\\s/@]*@', '\\1***:***@', 'g')) AS redacted FROM documents")
def str20_redact(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(T.redact("text")).alias("redacted"))


@query("SELECT doc_id, CASE WHEN length(t) <= 200 THEN t ELSE substr(t, 1, 197) || '...' END AS line FROM (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM documents)")
def str21_shorten(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.shorten("text").alias("line"))


@query("SELECT page_id, concat_ws('. ', nullif(trim(regexp_extract(html, '<title>([^<]*)', 1)), ''), nullif(trim(url), '')) AS line FROM pages")
def str23_feed_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", T.feed_text(F.regexp_extract("html", "<title>([^<]*)", 1), "url").alias("line"))


@query("""
SELECT doc_id, CASE WHEN contains(t, 'drone') OR contains(t, 'uav') THEN 'drone_strike' WHEN contains(t, 'missile') THEN 'missile_strike' WHEN contains(t, 'explosion') OR contains(t, 'strike') OR contains(t, 'attack') THEN 'explosive_impact' ELSE 'conflict_event' END AS type
FROM (SELECT doc_id, lower(text) AS t FROM documents)
""")
def str25_event_type(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.event_type("text").alias("type"))


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS iso, strftime(date_trunc('day', o_orderdate), '%Y-%m-%dT%H:%M:%SZ') AS slash, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS mail,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS millis, CAST(NULL AS VARCHAR) AS broken FROM orders
""")
def dt01_parse_time(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("t"))
    shapes = {
        "iso": F.date_format("t", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        "slash": F.date_format("t", "yyyy/M/d"),
        "mail": F.date_format("t", "EEE, dd MMM yyyy HH:mm:ss 'GMT'"),
        "millis": F.unix_millis("t").cast("string"),
        "broken": F.concat(F.lit("about "), F.date_format("t", "yyyy")),
    }
    return o.select("o_orderkey", *(times.iso(times.utc(v)).alias(k) for k, v in shapes.items()))


@query("SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) BETWEEN CAST(o_orderdate AS DATE) - 3 AND CAST(o_orderdate AS DATE) + 1 AS ok FROM lineitem JOIN orders ON o_orderkey = l_orderkey")
def dt05_date_window(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")  # noqa: E741
    j = l.join(o, l.l_orderkey == o.o_orderkey)
    return j.select("l_orderkey", "l_linenumber", times.date_in_window(F.to_date("l_shipdate"), "o_orderdate").alias("ok"))


@query("SELECT event_id, isodow(ts) <= 5 AND hour(ts) IN (1, 2, 3, 6, 7, 8, 9) AS peak, CAST(floor((epoch(TIMESTAMP '2024-02-01 00:00:00') - floor(epoch(ts))) / 60) AS BIGINT) AS minutes FROM events")
def dt06_peak_and_age(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    return e.select("event_id", times.is_peak("ts").alias("peak"), times.minutes_since("ts", F.lit("2024-02-01 00:00:00").cast("timestamp")).alias("minutes"))


@query("SELECT event_id, CAST(epoch_us(greatest(ts, TIMESTAMP '2024-01-21 00:00:00')) AS BIGINT) AS start_us FROM events")
def dt07_start_point(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    return e.select("event_id", F.unix_micros(times.start_point("ts", F.lit("2024-01-28 00:00:00").cast("timestamp"))).alias("start_us"))


_KM = "2 * 6371.0088 * asin(sqrt(least(1, pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2))))"


@query(f"""
WITH n AS (SELECT n_nationkey AS k, n_nationkey * 7 % 120 - 60 AS lat, n_nationkey * 29 % 360 - 180 AS lon FROM nation), s AS (SELECT s_suppkey AS k, s_nationkey AS n, s_suppkey * 37 % 180 - 90 AS lat, s_suppkey * 91 % 360 - 180 AS lon FROM supplier)
SELECT a.k AS s_suppkey, round({_KM}, 3) AS km FROM s a JOIN n b ON a.n = b.k
""")
def mth01_haversine(spark, sf):
    point = lambda k, m, n, o: ((F.col(k) * m % n - o).cast("double"))
    s = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("k"), point("s_suppkey", 37, 180, 90).alias("lat"), point("s_suppkey", 91, 360, 180).alias("lon"))
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("k"), point("n_nationkey", 7, 120, 60).alias("b"), point("n_nationkey", 29, 360, 180).alias("l"))
    return s.join(n, "k").select("s_suppkey", F.round(geo.distance_km("lat", "lon", "b", "l"), 3).alias("km"))


@query("""
WITH p AS (SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'ADM1' WHEN 1 THEN 'PPL' WHEN 2 THEN 'PPLX' WHEN 3 THEN 'PCLI' ELSE 'XXX' END AS code, CASE p_partkey % 3 WHEN 0 THEN 'city' WHEN 1 THEN 'Country' END AS kind FROM part),
q AS (SELECT p_partkey, CASE code WHEN 'ADM1' THEN 'region' WHEN 'PPL' THEN 'city' WHEN 'PPLX' THEN 'district' WHEN 'PCLI' THEN 'country' END AS precision, CASE code WHEN 'ADM1' THEN 3 WHEN 'PPL' THEN 2 WHEN 'PPLX' THEN 1 WHEN 'PCLI' THEN 4 END AS o, CASE kind WHEN 'city' THEN 2 WHEN 'Country' THEN 4 END AS w FROM p)
SELECT p_partkey, precision, CASE WHEN o IS NULL THEN -99 WHEN w IS NULL THEN 0 ELSE -abs(o - w) END AS fit, coalesce(precision IN ('point', 'district', 'city'), FALSE) AS pinnable FROM q
""")
def mth02_fit(spark, sf):
    codes = ["ADM1", "PPL", "PPLX", "PCLI", "XXX"]
    code = F.get(F.array(*map(F.lit, codes)), (F.col("p_size") % 5).cast("int"))
    kind = F.when(F.col("p_partkey") % 3 == 0, "city").when(F.col("p_partkey") % 3 == 1, "Country")
    p = table(spark, sf, "part").select("p_partkey", geo.precision(F.lit("P"), code).alias("precision"), kind.alias("kind"))
    return p.select("p_partkey", "precision", geo.fit("kind", "precision").alias("fit"), geo.pinnable("precision").alias("pinnable"))


@query("""
SELECT event_id, round((event_id % 1000 * CASE event_type WHEN 'click' THEN 0.006 ELSE 0.044 END + event_id % 700 * CASE event_type WHEN 'click' THEN 0.30 ELSE 1.32 END + event_id % 300 * CASE event_type WHEN 'click' THEN 1.20 ELSE 3.96 END)
  / 1000000 / CASE WHEN isodow(ts) <= 5 AND hour(ts) IN (1, 2, 3, 6, 7, 8, 9) THEN 1 ELSE 2 END, 9) AS cost FROM events
""")
def mth04_cost(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.when(F.col("event_type") == "click", "deepseek-flash").otherwise("another").alias("model"), F.col("ts").cast("timestamp").alias("ts"))
    cost = geo.cost_usd("model", F.col("event_id") % 1000, F.col("event_id") % 700, F.col("event_id") % 300, times.is_peak("ts"))
    return e.select("event_id", F.round(cost, 9).alias("cost"))


@query("SELECT event_id, CASE WHEN event_id % 4 = 0 AND event_id % 6 = 0 THEN event_id ELSE event_id % 6 END AS misses FROM events")
def mth09_usage(spark, sf):
    return table(spark, sf, "events").select("event_id", geo.cache_misses("event_id", F.col("event_id") % 4, F.col("event_id") % 6).alias("misses"))


@query("SELECT event_id, json_keys(props)[1] AS k, CAST(props ->> '$.k' AS BIGINT) AS v FROM events")
def jsn01_lists(spark, sf):
    v = F.try_variant_get(F.try_parse_json("props"), "$.k", "long")
    return table(spark, sf, "events").select("event_id", F.get(jsons.string_list("props"), F.lit(0)).alias("k"), v.alias("v"))


@query("SELECT page_id, 'st_' || substr(sha256(regexp_extract(url, '^https?://([^/]+)', 1) || chr(10) || url), 1, 16) AS story, 'nf_' || substr(sha256(regexp_extract(url, '^https?://([^/]+)', 1) || chr(10) || url), 1, 12) AS event FROM pages")
def hsh01_ids(spark, sf):
    host = F.regexp_extract("url", "^https?://([^/]+)", 1)
    return table(spark, sf, "pages").select("page_id", hashing.story_id(host, "url").alias("story"), hashing.cluster_id(host, "url").alias("event"))


@query("SELECT doc_id, sha256(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS h FROM documents WHERE trim(regexp_replace(text, '\\s+', ' ', 'g')) <> ''")
def hsh02_text_hash(spark, sf):
    return table(spark, sf, "documents").select("doc_id", hashing.text_hash("text").alias("h")).filter("h IS NOT NULL")


@query("SELECT c_nationkey, substr(sha256(array_to_string(list(c_name || ':' || c_mktsegment ORDER BY c_name, c_mktsegment), '|')), 1, 16) AS build FROM customer GROUP BY c_nationkey")
def hsh03_build_hash(spark, sf):
    return table(spark, sf, "customer").groupBy("c_nationkey").agg(hashing.files_hash("c_name", "c_mktsegment").alias("build"))
