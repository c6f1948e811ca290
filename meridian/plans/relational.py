"""Filters, joins, aggregates, windows, order and set operations.

The driver tables hold no stories, so events stand for them (user_id as the outlet, event_type as the status, value as a cost),
orders and lineitems for events and their reports, customers and suppliers for places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.functions import geo
from meridian.functions import text as T
from meridian.operators import gazetteer as G
from meridian.operators import health as H
from meridian.operators import merge as M
from meridian.plans.registry import query, table
from meridian.sources import feeds

NOW = "2024-01-28 00:00:00"


def now():
    return F.lit(NOW).cast("timestamp")


def events_as_stories(spark, sf) -> DataFrame:
    e = table(spark, sf, "events")
    at = F.col("ts").cast("timestamp")
    return e.select(
        F.col("event_id").cast("string").alias("story_id"),
        F.col("user_id").cast("string").alias("outlet"),
        F.col("event_type").alias("status"),
        F.when(F.col("event_id") % 3 != 0, at).alias("published"),
        at.alias("first_seen_at"),
        F.when(F.col("value") > 50, at + F.expr("INTERVAL 2 DAYS")).alias("lease_until"),
        F.when(F.col("event_id") % 7 != 0, F.col("props")).alias("headline"),
        "value",
    )


@query("""
SELECT CAST(event_id AS VARCHAR) AS story_id, value FROM events
WHERE event_type = 'view' AND (NOT coalesce(value > 50, FALSE) OR ts + INTERVAL 2 DAY < TIMESTAMP '2024-01-28 00:00:00')
ORDER BY coalesce(CASE WHEN event_id % 3 <> 0 THEN ts END, ts) DESC NULLS LAST, CAST(event_id AS VARCHAR) LIMIT 200
""")
def flt01_claimable(spark, sf):
    return M.newest_first(M.claimable(events_as_stories(spark, sf), "view", now()), 200).select("story_id", "value")


@query("""
SELECT CAST(event_id AS VARCHAR) AS story_id FROM events WHERE ts >= TIMESTAMP '2024-01-26 00:00:00' AND event_id % 7 <> 0
""")
def flt02_recent_feed_rows(spark, sf):
    recent = F.col("first_seen_at") >= now() - F.expr("INTERVAL 2 DAYS")
    return events_as_stories(spark, sf).filter(recent & F.col("headline").isNotNull()).select("story_id")


@query("""
SELECT o_orderkey, count(*) AS placed FROM orders JOIN lineitem ON l_orderkey = o_orderkey
WHERE o_orderstatus = 'F' AND l_returnflag = 'R' AND l_shipdate IS NOT NULL AND o_orderpriority NOT IN ('5-LOW') GROUP BY o_orderkey
""")
def flt03_accepted_and_kept_outlets(spark, sf):
    o = table(spark, sf, "orders").filter((F.col("o_orderstatus") == "F") & ~F.col("o_orderpriority").isin("5-LOW"))
    reports = table(spark, sf, "lineitem").filter((F.col("l_returnflag") == "R") & F.col("l_shipdate").isNotNull())
    return o.join(reports, o.o_orderkey == reports.l_orderkey).groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("placed"))


@query("""
WITH s AS (SELECT user_id, max(ts) AS seen FROM events GROUP BY user_id),
     x AS (SELECT user_id, max(ts) AS created FROM events WHERE event_type = 'purchase' AND value > 90 GROUP BY user_id)
SELECT s.user_id, CAST(epoch_us(seen) AS BIGINT) AS seen_us FROM s LEFT JOIN x ON s.user_id = x.user_id
WHERE (seen > TIMESTAMP '2024-01-29 12:00:00' OR created > TIMESTAMP '2024-01-27 00:00:00') AND seen > TIMESTAMP '2024-01-20 00:00:00'
""")
def flt06_cursor_export(spark, sf):
    e = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    s = e.groupBy("user_id").agg(F.max("ts").alias("seen"))
    x = e.filter("event_type = 'purchase' AND value > 90").groupBy("user_id").agg(F.max("ts").alias("created"))
    at = lambda t: F.lit(t).cast("timestamp")
    due = ((F.col("seen") > at("2024-01-29 12:00:00")) | (F.col("created") > at("2024-01-27 00:00:00"))) & (F.col("seen") > at("2024-01-20 00:00:00"))
    return s.join(x, "user_id", "left").filter(due).select("user_id", F.unix_micros("seen").alias("seen_us"))


@query("""
SELECT doc_id, regexp_matches(text, '(?i)license|licensed') AS third_party FROM documents WHERE regexp_matches(text, '(?i)rights reserved|licensed under')
""")
def flt10_third_party(spark, sf):
    return table(spark, sf, "documents").filter(F.col("text").rlike("(?i)rights reserved|licensed under")).select("doc_id", F.col("text").rlike("(?i)license|licensed").alias("third_party"))


_RULED = sorted({*feeds.CREDITS, *feeds.CATEGORIES, *feeds.WORDS, *feeds.LINKS})


def _ruled(rules: dict[str, str], value: str) -> str:
    """SQL: does the rule of the row's feed hold for a value? DuckDB's patterns can't look ahead, so that one rule is said otherwise."""
    quoted = lambda x: x.replace("'", "''")
    hit = lambda k, r: f"NOT contains(lower({value}), 'write to taiwan today')" if r.startswith("^(?!") else f"regexp_matches({value}, '(?i){quoted(r)}')"
    return f"CASE slug {" ".join(f"WHEN '{k}' THEN {hit(k, r)}" for k, r in rules.items())} ELSE FALSE END"


@query(f"""
WITH d AS (SELECT doc_id, text, source, split_part('{",".join([*_RULED, "another"])}', ',', CAST(1 + doc_id % {len(_RULED) + 1} AS INT)) AS slug, string_split(coalesce(text, ''), chr(10))[1] AS description FROM documents)
SELECT doc_id, slug, coalesce({_ruled(feeds.CREDITS, "source")}, FALSE) OR coalesce({_ruled(feeds.CATEGORIES, "source")}, FALSE) OR {_ruled(feeds.LINKS, "coalesce(source, '')")}
  OR {_ruled(feeds.WORDS, "concat_ws(' ', nullif(description, ''), nullif(text, ''))")} AS third_party FROM d
""")
def flt10_third_party_all(spark, sf):
    """Every document as an item of one of the feeds that have rules, or of one that has none, in turn; its source is a credit and a category."""
    slugs = F.array(*map(F.lit, [*_RULED, "another"]))
    d = table(spark, sf, "documents").withColumns({
        "slug": F.get(slugs, F.pmod("doc_id", F.lit(len(_RULED) + 1)).cast("int")),
        "creators": F.array_compact(F.array("source")),
        "categories": F.transform(F.array_compact(F.array("source")), lambda x: F.struct(x.alias("name"))),
        "link": F.col("source"),
        "description": F.substring_index("text", "\n", 1),
        "content": F.col("text"),
    })
    return d.select("doc_id", "slug", feeds.third_party("slug").alias("third_party"))


@query("""
SELECT o_orderkey, coalesce(CASE o_orderstatus WHEN 'F' THEN FALSE WHEN 'O' THEN TRUE END, TRUE) AS can_pin FROM orders
""")
def flt11_can_pin_dim(spark, sf):
    category = F.when(F.col("o_orderstatus") == "F", F.lit("courts_and_justice")).when(F.col("o_orderstatus") == "O", F.lit("disaster")).otherwise(F.lit("unheard_of"))
    return table(spark, sf, "orders").select("o_orderkey", geo.can_pin(category).alias("can_pin"))


@query("""
WITH e AS (SELECT event_id, CASE event_type WHEN 'view' THEN 'opinion_analysis' WHEN 'click' THEN 'conflict' ELSE 'health' END AS category,
  CASE WHEN event_id % 5 = 0 THEN 'Country ' WHEN event_id % 5 = 1 THEN 'city' ELSE NULL END AS kind, value FROM events)
SELECT event_id, CASE WHEN category = 'opinion_analysis' THEN 'category_never_pins' WHEN lower(trim(coalesce(kind, ''))) = 'country' THEN 'precision_never_pins' END AS veto,
  CASE WHEN category <> 'opinion_analysis' AND lower(trim(coalesce(kind, ''))) <> 'country' THEN kind END AS place_kind FROM e
""")
def flt14_event_mask(spark, sf):
    from meridian.operators.export import pin_veto

    category = F.when(F.col("event_type") == "view", F.lit("opinion_analysis")).when(F.col("event_type") == "click", F.lit("conflict")).otherwise(F.lit("health"))
    kind = F.when(F.col("event_id") % 5 == 0, F.lit("Country ")).when(F.col("event_id") % 5 == 1, F.lit("city"))
    e = table(spark, sf, "events").select("event_id", category.alias("category"), kind.alias("kind"))
    veto = pin_veto("category", "kind")
    return e.select("event_id", veto.alias("veto"), F.when(veto.isNull(), F.col("kind")).alias("place_kind"))


@query("""
SELECT o_orderkey, c_name, l_linenumber FROM orders JOIN customer ON c_custkey = o_custkey
LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_returnflag = 'A' AND l_quantity > 45
""")
def jn01_hash_scoped_left(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    lines = table(spark, sf, "lineitem").filter("l_returnflag = 'A' AND l_quantity > 45").select("l_orderkey", "l_linenumber")
    return o.join(c, o.o_custkey == c.c_custkey).join(lines, o.o_orderkey == lines.l_orderkey, "left").select("o_orderkey", "c_name", "l_linenumber")


@query("""
SELECT o_orderkey, c_mktsegment, n_name, l_suppkey FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_linenumber = 1 WHERE o_orderstatus = 'P'
""")
def jn02_founder_chain(spark, sf):
    o = table(spark, sf, "orders").filter("o_orderstatus = 'P'")
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    first = table(spark, sf, "lineitem").filter("l_linenumber = 1").select("l_orderkey", "l_suppkey")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).join(first, o.o_orderkey == first.l_orderkey, "left")
    return j.select("o_orderkey", "c_mktsegment", "n_name", "l_suppkey")


@query("""
WITH a AS (SELECT page_id, unnest([regexp_extract(url, '^https?://([^/]+)', 1), regexp_extract(url, '^https?://[^/]+(/[^?#]*)', 1)]) AS alias FROM pages),
o AS (SELECT alias, page_id, row_number() OVER (PARTITION BY alias ORDER BY page_id) AS rn FROM a WHERE alias <> '')
SELECT alias, page_id FROM o WHERE rn = 1
""")
def jn06_first_owner(spark, sf):
    aliases = F.array(F.regexp_extract("url", "^https?://([^/]+)", 1), F.regexp_extract("url", "^https?://[^/]+(/[^?#]*)", 1))
    each = table(spark, sf, "pages").select("page_id", F.explode(aliases).alias("alias")).filter("alias <> ''")
    return each.groupBy("alias").agg(F.min("page_id").alias("page_id"))


@query("""
SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)
ORDER BY coalesce(c_acctbal, 0) DESC NULLS LAST, c_custkey LIMIT 20
""")
def jn07_pending_topk(spark, sf):
    c, o = table(spark, sf, "customer"), table(spark, sf, "orders")
    return c.join(o, c.c_custkey == o.o_custkey, "left_anti").orderBy(F.coalesce("c_acctbal", F.lit(0.0)).desc_nulls_last(), "c_custkey").limit(20).select("c_custkey", "c_name")


@query("""
SELECT DISTINCT user_id FROM events e WHERE EXISTS (SELECT 1 FROM events x WHERE x.user_id = e.user_id AND x.event_type <> 'signup')
AND NOT EXISTS (SELECT 1 FROM events y WHERE y.user_id = e.user_id AND y.event_type = 'signup' AND y.ts >= TIMESTAMP '2024-01-28 00:00:00')
""")
def jn08_stale(spark, sf):
    e = table(spark, sf, "events")
    other = e.filter("event_type <> 'signup'").select("user_id")
    current = e.filter((F.col("event_type") == "signup") & (F.col("ts").cast("timestamp") >= now())).select("user_id")
    return e.select("user_id").distinct().join(other, "user_id", "left_semi").join(current, "user_id", "left_anti")


@query("""
SELECT l_orderkey, l_linenumber FROM lineitem l WHERE NOT EXISTS
(SELECT 1 FROM lineitem m WHERE m.l_partkey = l.l_partkey AND m.l_suppkey = l.l_suppkey AND m.l_returnflag = 'R' AND m.l_linestatus = l.l_linestatus)
""")
def jn09_anti_three_keys(spark, sf):
    l = table(spark, sf, "lineitem")  # noqa: E741
    keys = ["l_partkey", "l_suppkey", "l_linestatus"]
    return l.join(l.filter("l_returnflag = 'R'").select(*keys), keys, "left_anti").select("l_orderkey", "l_linenumber")


@query("""
SELECT DISTINCT q.q_id, p.p_partkey FROM (SELECT n_nationkey AS q_id, lower(substr(n_name, 1, 2)) AS folded FROM nation) q
JOIN (SELECT p_partkey, p_size, lower(unnest(string_split(p_name, ' '))) AS word FROM part) p ON substr(p.word, 1, 2) = q.folded AND p.p_size % 25 = q.q_id
""")
def jn11_candidates(spark, sf):
    q = table(spark, sf, "nation").select(F.col("n_nationkey").alias("q_id"), F.substring(T.fold("n_name"), 1, 2).alias("folded"), F.col("n_nationkey").alias("country"))
    words = table(spark, sf, "part").select("p_partkey", (F.col("p_size") % 25).alias("country"), F.explode(F.split(T.fold("p_name"), " ")).alias("word"))
    return q.join(words.withColumn("folded", F.substring("word", 1, 2)), ["folded", "country"]).select("q_id", "p_partkey").distinct()


@query("""
SELECT p_partkey FROM part WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey) AND
NOT (p_type LIKE 'PROMO%' AND EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 49))
""")
def jn12_names_of_kept_places(spark, sf):
    p, l = table(spark, sf, "part"), table(spark, sf, "lineitem").withColumnRenamed("l_partkey", "p_partkey")  # noqa: E741
    kept = p.join(l, "p_partkey", "left_semi")
    barred = kept.filter("p_type LIKE 'PROMO%'").join(l.filter("l_quantity > 49"), "p_partkey", "left_semi")
    return kept.join(barred, "p_partkey", "left_anti").select("p_partkey")


@query("""
SELECT s_suppkey, concat_ws(', ', s_name, n_name, r_name) AS display_name FROM supplier
LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
""")
def jn14_display_name(spark, sf):
    s, n, r = (table(spark, sf, x) for x in ("supplier", "nation", "region"))
    j = s.join(n, s.s_nationkey == n.n_nationkey, "left").join(r, n.n_regionkey == r.r_regionkey, "left")
    return j.select("s_suppkey", F.concat_ws(", ", "s_name", "n_name", "r_name").alias("display_name"))


#: A headline is a document's first line; whole tables are compared.
_TOKENS = """SELECT doc_id, lang, list_distinct(list_filter(regexp_extract_all(lower(string_split(text, chr(10))[1]), '[a-z0-9]+'),
  lambda w: length(w) > 2 AND NOT list_contains(string_split('a an and are as at be by for from has have in is it its of on or that the to was were with after before says said new latest live update updates', ' '), w))) AS t FROM documents"""


@query(f"""
WITH d AS ({_TOKENS}), g AS (SELECT min(doc_id) AS doc_id, lang, list_sort(t) AS t FROM d GROUP BY lang, list_sort(t)), x AS (SELECT doc_id, lang, unnest(t) AS w, len(t) AS n FROM g)
SELECT a, b, round(s / (na + nb - s), 6) AS overlap FROM (
  SELECT l.doc_id AS a, r.doc_id AS b, any_value(l.n) AS na, any_value(r.n) AS nb, count(*) AS s
  FROM x l JOIN x r ON l.lang = r.lang AND l.w = r.w AND l.doc_id < r.doc_id GROUP BY l.doc_id, r.doc_id) WHERE s / (na + nb - s) >= 0.34
""")
def jn16_similarity_pairs(spark, sf):
    """Pairs of different headlines (first lines) of a language; documents with the same words stand behind the first of them.

    Which one a document stands behind is in jn16_similarity_classes. The pairs of all documents, links of 1.0 included, are those of the same class
    and, for each pair here, those of the one class with those of the other.
    """
    return overlapping(_headlines(spark, sf).groupBy("lang", "t").agg(F.min("doc_id").alias("doc_id")), "doc_id", "lang", "t", 0.34)


def _headlines(spark, sf) -> DataFrame:
    """(doc_id, lang, t): the sorted tokens of each document's first line."""
    first_line = F.substring_index("text", "\n", 1)
    return table(spark, sf, "documents").select("doc_id", "lang", F.array_sort(T.headline_tokens(first_line)).alias("t"))


@query(f"""
WITH d AS ({_TOKENS}) SELECT doc_id, CASE WHEN lang IS NULL OR coalesce(len(t), 0) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY lang, list_sort(t)) END AS class_id FROM d
""")
def jn16_similarity_classes(spark, sf):
    """Each document with the smallest doc_id of its language and headline words, which stands for it in jn16_similarity_pairs.

    Two are of one class if they overlap by 1.0; one without a word or a language overlaps with none and is its own class.
    """
    d = _headlines(spark, sf)
    first = d.filter(F.size("t") > 0).groupBy("lang", "t").agg(F.min("doc_id").alias("first"))
    return d.join(first, ["lang", "t"], "left").select("doc_id", F.coalesce("first", "doc_id").alias("class_id"))


#: Longs of 64 bits that stand for a set of tokens in may_overlap().
BITMAPS = 8


def overlapping(rows: DataFrame, key: str, within: str, tokens: str, least: float) -> DataFrame:
    """Pairs (a, b), a < b, with the same `within` whose token sets overlap by `least` or more."""
    each = rows.select(key, within, F.explode(F.transform(tokens, lambda w: F.xxhash64(w))).alias("w"))  # numbers are joined and intersected faster
    freq = each.groupBy(within, "w").agg(F.count(key).alias("df"))  # counts keys, so that both uses of each are one plan
    ranked = each.join(freq, [within, "w"]).groupBy(key, within).agg(F.transform(F.array_sort(F.collect_list(F.struct("df", "w"))), lambda x: x["w"]).alias("t"))
    sets = ranked.select(F.col(key).alias("a"), F.col("t").alias("ta"))
    found = may_overlap(ranked, key, within, least).join(sets, "a").join(sets.select(F.col("a").alias("b"), F.col("ta").alias("tb")), "b")
    return found.withColumn("overlap", T.jaccard("ta", "tb")).filter(F.col("overlap") >= least).select("a", "b", F.round("overlap", 6).alias("overlap"))


def may_overlap(ranked: DataFrame, key: str, within: str, least: float) -> DataFrame:
    """Pairs (a, b), a < b, of ranked(key, within, t) that may overlap by `least`: all that do, and few others.

    Prefix filtering: t being hashes in an order from rare to frequent, sets that overlap so much share a token among the first
    n - ceil(least * n) + 1 of each, so only those are joined on, and frequent tokens hardly ever. What meets are ids, sizes,
    places and bitmaps, not tokens: at its first shared token a pair has at most the rest of the shorter set still to share, and
    each bit that only one of two sets has is a token that only this one has. Pairs for which that leaves too little go
    where they meet; else the tokens of far more pairs than there are in the result would have to be moved.
    """
    first = F.size("t") - T.at_least("t", least) + 1

    def bitmap(k: int) -> Column:
        own = F.filter("t", lambda x: F.pmod(x, F.lit(64 * BITMAPS)).between(64 * k, 64 * k + 63))
        return F.aggregate(own, F.lit(0).cast("long"), lambda acc, x: acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(x, F.lit(64)).cast("int"))))

    held = ranked.select(F.col(key).alias("a"), within, "t", first.alias("first"), F.size("t").alias("na"), *(bitmap(k).alias(f"ma{k}") for k in range(BITMAPS)))
    kept = ["a", within, "na", *(f"ma{k}" for k in range(BITMAPS))]
    prefix = held.select(*kept, F.posexplode(F.slice("t", F.lit(1), F.col("first"))).alias("i", "w"))
    other = prefix.select(F.col("a").alias("b"), within, F.col("na").alias("nb"), *(F.col(f"ma{k}").alias(f"mb{k}") for k in range(BITMAPS)), F.col("i").alias("j"), "w")
    shared = F.ceil(F.lit(least / (1 + least)) * (F.col("na") + F.col("nb")) - 1e-9)
    enough = F.least(F.col("na") - F.col("i"), F.col("nb") - F.col("j")) >= shared
    sizes = F.least("na", "nb") >= F.ceil(F.greatest("na", "nb") * least - 1e-9)
    only = lambda x, y: sum((F.bit_count(F.col(f"{x}{k}").bitwiseAND(F.bitwise_not(f"{y}{k}"))) for k in range(BITMAPS)), F.lit(0))
    alike = F.least(F.col("na") - only("ma", "mb"), F.col("nb") - only("mb", "ma")) >= shared
    return prefix.join(other, [within, "w"]).filter((F.col("a") < F.col("b")) & sizes & enough & alike).select("a", "b").distinct()


@query("""
WITH s AS (SELECT s_suppkey, s_nationkey, (s_suppkey * 37 % 180 - 90) * 1.0 AS lat, (s_suppkey * 91 % 360 - 180) * 1.0 AS lon FROM supplier),
n AS (SELECT n_nationkey, n_regionkey, (n_nationkey * 7 % 120 - 60) * 1.0 AS clat, (n_nationkey * 29 % 360 - 180) * 1.0 AS clon FROM nation)
SELECT s_suppkey, n_nationkey, CASE WHEN n_regionkey = 0 THEN TRUE WHEN n_regionkey = 1 THEN s_nationkey = n_nationkey
  ELSE 2 * 6371.0088 * asin(sqrt(least(1, pow(sin(radians(clat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(clat)) * pow(sin(radians(clon - lon) / 2), 2)))) <= 5000 END AS inside
FROM s JOIN n ON n_nationkey % 5 = s_nationkey % 5
""")
def jn17_containment(spark, sf):
    lat, lon = (F.col("s_suppkey") * 37 % 180 - 90).cast("double"), (F.col("s_suppkey") * 91 % 360 - 180).cast("double")
    s = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey", lat.alias("lat"), lon.alias("lon"), (F.col("s_nationkey") % 5).alias("k"))
    clat, clon = (F.col("n_nationkey") * 7 % 120 - 60).cast("double"), (F.col("n_nationkey") * 29 % 360 - 180).cast("double")
    n = table(spark, sf, "nation").select("n_nationkey", "n_regionkey", clat.alias("clat"), clon.alias("clon"), (F.col("n_nationkey") % 5).alias("k"))
    near = geo.distance_km("lat", "lon", "clat", "clon") <= 5000
    inside = F.when(F.col("n_regionkey") == 0, True).when(F.col("n_regionkey") == 1, F.col("s_nationkey") == F.col("n_nationkey")).otherwise(near)
    return s.join(n, "k").select("s_suppkey", "n_nationkey", inside.alias("inside"))


@query("""
WITH s AS (SELECT s_suppkey, s_nationkey, (s_suppkey * 37 % 180 - 90) * 1.0 AS lat, (s_suppkey * 91 % 360 - 180) * 1.0 AS lon FROM supplier),
n AS (SELECT n_nationkey, n_regionkey, (n_nationkey * 7 % 120 - 60) * 1.0 AS clat, (n_nationkey * 29 % 360 - 180) * 1.0 AS clon FROM nation),
j AS (SELECT *, 2 * 6371.0088 * asin(sqrt(least(1, pow(sin(radians(clat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(clat)) * pow(sin(radians(clon - lon) / 2), 2)))) AS km FROM s CROSS JOIN n)
SELECT s_suppkey, n_nationkey, CASE WHEN n_regionkey = 0 THEN TRUE WHEN n_regionkey = 1 THEN s_nationkey = n_nationkey ELSE km <= 5000 END AS inside,
  CASE n_regionkey WHEN 0 THEN TRUE WHEN 1 THEN s_nationkey = n_nationkey WHEN 2 THEN s_nationkey = n_nationkey AND s_suppkey % 3 = n_nationkey % 3 WHEN 3 THEN km <= 150 ELSE km <= 30 END AS held
FROM j
""")
def jn17_containment_all(spark, sf):
    """Every supplier against every nation's centre: inside as in jn17_containment, held as gazetteer.inside says.

    A nation is a country, a first or second division, a region or a city by its region. Nations are 25 rows, so they are broadcast.
    """
    degrees = lambda k, m, n, o: (F.col(k) * m % n - o).cast("double")
    text = lambda c: c.cast("string")
    place = F.struct(
        degrees("s_suppkey", 37, 180, 90).alias("latitude"),
        degrees("s_suppkey", 91, 360, 180).alias("longitude"),
        text(F.col("s_nationkey")).alias("admin1"),
        text(F.col("s_suppkey") % 3).alias("admin2"),
    )
    by_region = lambda *values: F.get(F.array(*map(F.lit, values)), F.col("n_regionkey").cast("int"))
    container = F.struct(
        degrees("n_nationkey", 7, 120, 60).alias("latitude"),
        degrees("n_nationkey", 29, 360, 180).alias("longitude"),
        text(F.col("n_nationkey")).alias("admin1"),
        text(F.col("n_nationkey") % 3).alias("admin2"),
        by_region("PCLI", "ADM1", "ADM2", "RGN", "PPL").alias("feature_code"),
        by_region("country", "region", "region", "region", "city").alias("precision"),
    )
    s = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey", place.alias("place"))
    n = table(spark, sf, "nation").select("n_nationkey", "n_regionkey", container.alias("container"))
    near = G.distance(F.col("place"), F.col("container")) <= 5000
    inside = F.when(F.col("n_regionkey") == 0, True).when(F.col("n_regionkey") == 1, F.col("s_nationkey") == F.col("n_nationkey")).otherwise(near)
    return s.crossJoin(F.broadcast(n)).select("s_suppkey", "n_nationkey", inside.alias("inside"), G.inside(F.col("place"), F.col("container")).alias("held"))


@query("""
SELECT o_orderkey, array_to_string(list_sort(list(l_partkey)), ',') AS sections FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey
""")
def jn20_sections(spark, sf):
    lists = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.sort_array(F.collect_list("l_partkey")).cast("array<string>"), ",").alias("sections"))
    o = table(spark, sf, "orders")
    return o.join(lists, o.o_orderkey == lists.l_orderkey, "left").select("o_orderkey", "sections")


@query("""
SELECT l_orderkey, l_linenumber FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey
WHERE c_mktsegment IN ('BUILDING') AND s_nationkey NOT IN (1, 2, 3)
""")
def jn23_orphans(spark, sf):
    gone = table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    founded = table(spark, sf, "orders").join(gone, "o_custkey", "left_semi").select(F.col("o_orderkey").alias("l_orderkey"))
    stays = table(spark, sf, "supplier").filter("s_nationkey NOT IN (1, 2, 3)").select(F.col("s_suppkey").alias("l_suppkey"))
    return table(spark, sf, "lineitem").join(founded, "l_orderkey", "left_semi").join(stays, "l_suppkey", "left_semi").select("l_orderkey", "l_linenumber")


@query("""
SELECT r_regionkey, r_name, coalesce(n, 0) AS n FROM region LEFT JOIN
(SELECT n_regionkey, count(*) AS n FROM nation WHERE n_nationkey > 12 GROUP BY n_regionkey) ON n_regionkey = r_regionkey
""")
def jn25_fixed_outlets(spark, sf):
    counts = table(spark, sf, "nation").filter("n_nationkey > 12").groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("n"))
    r = table(spark, sf, "region")
    return r.join(counts, r.r_regionkey == counts.n_regionkey, "left").select("r_regionkey", "r_name", F.coalesce("n", F.lit(0)).alias("n")).orderBy("r_regionkey")


@query("""
SELECT o_custkey, o_orderpriority, bool_and(EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')) AS all_known FROM orders GROUP BY o_custkey, o_orderpriority
""")
def jn27_known_pages(spark, sf):
    known = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("k", F.lit(True))
    j = table(spark, sf, "orders").join(known, "o_orderkey", "left")
    return j.groupBy("o_custkey", "o_orderpriority").agg(F.bool_and(F.coalesce("k", F.lit(False))).alias("all_known"))


@query("SELECT count(*) AS stories, count(DISTINCT user_id) AS outlets, CAST(epoch_us(max(ts)) AS BIGINT) AS newest_us FROM events")
def agg01_counts(spark, sf):
    return table(spark, sf, "events").agg(F.count(F.lit(1)).alias("stories"), F.countDistinct("user_id").alias("outlets"), F.unix_micros(F.max(F.col("ts").cast("timestamp"))).alias("newest_us"))


@query("SELECT event_type AS status, count(*) AS n FROM events GROUP BY event_type")
def agg02_by_status(spark, sf):
    return table(spark, sf, "events").groupBy(F.col("event_type").alias("status")).agg(F.count(F.lit(1)).alias("n")).orderBy("status")


@query("SELECT c_custkey, coalesce(n, 0) AS n FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey")
def agg03_by_outlet(spark, sf):
    n = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    c = table(spark, sf, "customer")
    return c.join(n, c.c_custkey == n.o_custkey, "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n"))


@query("""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) FILTER (event_type = 'error') AS errors, count(*) FILTER (event_type = 'purchase') AS purchases, count(*) AS n FROM events GROUP BY 1
""")
def agg04_day_outcome(spark, sf):
    e = table(spark, sf, "events").select(F.to_date("ts").cast("string").alias("day"), "event_type")
    return e.groupBy("day").agg(F.count_if(F.col("event_type") == "error").alias("errors"), F.count_if(F.col("event_type") == "purchase").alias("purchases"), F.count(F.lit(1)).alias("n"))


@query("SELECT k, CAST(json_extract_string(props, '$.' || k) AS BIGINT) AS v, count(*) AS n FROM (SELECT props, unnest(json_keys(props)) AS k FROM events) GROUP BY 1, 2")
def agg05_json_explode(spark, sf):
    e = table(spark, sf, "events").select(F.explode(F.from_json("props", "map<string,string>")).alias("k", "v"))
    return e.groupBy("k", F.col("v").cast("long").alias("v")).agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT event_id, round(before, 4) AS before FROM (SELECT event_id, coalesce(sum(value) OVER
 (PARTITION BY CAST(ts AS DATE) ORDER BY ts DESC, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM events) WHERE before < 2000
""")
def agg06_spend_day(spark, sf):
    kept = M.within_budget(table(spark, sf, "events"), F.to_date("ts"), [F.col("ts").desc(), F.col("event_id")], "value", 2000.0, F.date_trunc("minute", F.col("ts").cast("timestamp")), True)
    return kept.select("event_id", F.round("spent_before", 4).alias("before"))


@query("SELECT l_orderkey, CAST(CAST(min(l_shipdate) AS DATE) AS VARCHAR) AS first_day, CAST(CAST(max(l_shipdate) AS DATE) AS VARCHAR) AS last_day FROM lineitem GROUP BY l_orderkey")
def agg07_first_last(spark, sf):
    day = lambda c: F.to_date(c).cast("string")
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(day(F.min("l_shipdate")).alias("first_day"), day(F.max("l_shipdate")).alias("last_day"))


@query("SELECT DISTINCT p_brand, p_type FROM part WHERE p_brand <> 'Brand#1'")
def agg09_distinct_models(spark, sf):
    return table(spark, sf, "part").select("p_brand", "p_type").distinct().filter("p_brand <> 'Brand#1'")


@query("SELECT user_id, count(*) FILTER (event_type = 'error') AS failed, count(*) FILTER (event_type <> 'error') AS fine, round(sum(value), 4) AS cost FROM events GROUP BY user_id")
def agg11_counters(spark, sf):
    bad = F.col("event_type") == "error"
    return table(spark, sf, "events").groupBy("user_id").agg(F.count_if(bad).alias("failed"), F.count_if(~bad).alias("fine"), F.round(F.sum("value"), 4).alias("cost"))


@query("""
SELECT user_id, event_type AS top FROM (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS rn FROM events GROUP BY user_id, event_type) WHERE rn = 1
""")
def agg12_majority(spark, sf):
    n = table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    best = F.min_by("event_type", F.struct((-F.col("n")).alias("n"), F.col("event_type").alias("t")))
    return n.groupBy("user_id").agg(best.alias("top"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'live_blog' WHEN o_orderpriority = '5-LOW' THEN 'founder_not_an_event' WHEN coalesce(far, FALSE) THEN 'members_far_apart' END AS reason
FROM orders LEFT JOIN (SELECT l_orderkey, bool_or(abs(l_extendedprice - o_totalprice) > 100000) AS far FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY l_orderkey) ON l_orderkey = o_orderkey
""")
def agg13_veto(spark, sf):
    o = table(spark, sf, "orders")
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice")  # noqa: E741
    far = l.join(o, l.l_orderkey == o.o_orderkey).groupBy("l_orderkey").agg(F.bool_or(F.abs(F.col("l_extendedprice") - F.col("o_totalprice")) > 100000).alias("far"))
    reason = F.when(F.col("o_orderstatus") == "P", "live_blog").when(F.col("o_orderpriority") == "5-LOW", "founder_not_an_event").when(F.coalesce("far", F.lit(False)), "members_far_apart")
    return o.join(far, o.o_orderkey == far.l_orderkey, "left").select("o_orderkey", reason.alias("reason"))


@query("""
SELECT user_id, CAST(sum(n * (n - 1) / 2) AS BIGINT) AS pairs FROM (SELECT user_id, event_type, CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY ALL) GROUP BY user_id
""")
def agg15_pair_bound(spark, sf):
    n = table(spark, sf, "events").groupBy("user_id", "event_type", F.to_date("ts").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy("user_id").agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).cast("long").alias("pairs"))


@query("""
WITH m AS (SELECT event_id, user_id, ts, CAST(event_type = 'error' AS INT) AS f, sum(CAST(event_type <> 'error' AS INT)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM events)
SELECT event_id, CAST(sum(f) OVER (PARTITION BY user_id, island ORDER BY ts, event_id) AS BIGINT) AS in_a_row FROM m
""")
def agg16_failure_runs(spark, sf):
    e = table(spark, sf, "events").withColumn("at", F.struct("ts", "event_id"))
    return H.failure_runs(e, "user_id", "at", F.col("event_type") == "error").select("event_id", "in_a_row")


@query("""
WITH r AS (SELECT p_brand, p_partkey, p_size, p_retailprice, row_number() OVER (PARTITION BY p_brand ORDER BY -abs(p_size - 25) DESC, p_retailprice DESC, p_partkey) AS rn,
  lead(p_partkey) OVER (PARTITION BY p_brand ORDER BY -abs(p_size - 25) DESC, p_retailprice DESC, p_partkey) AS second,
  lead(p_size) OVER (PARTITION BY p_brand ORDER BY -abs(p_size - 25) DESC, p_retailprice DESC, p_partkey) AS second_size FROM part)
SELECT p_brand, p_partkey AS best, second, abs(p_size - 25) = abs(second_size - 25) AS ambiguous FROM r WHERE rn = 1
""")
def win01_rank_candidates(spark, sf):
    w = Window.partitionBy("p_brand").orderBy(F.abs(F.col("p_size") - 25), F.desc("p_retailprice"), "p_partkey")
    r = table(spark, sf, "part").withColumns({"rn": F.row_number().over(w), "second": F.lead("p_partkey").over(w), "second_size": F.lead("p_size").over(w)})
    return r.filter("rn = 1").select("p_brand", F.col("p_partkey").alias("best"), "second", (F.abs(F.col("p_size") - 25) == F.abs(F.col("second_size") - 25)).alias("ambiguous"))


@query("""
SELECT l_orderkey, l_linenumber, rn FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate NULLS LAST, l_orderkey, l_linenumber) AS rn FROM lineitem) WHERE rn <= 8 AND l_returnflag <> 'N'
""")
def win03_reports_cap(spark, sf):
    w = Window.partitionBy("l_suppkey").orderBy(F.col("l_shipdate").asc_nulls_last(), "l_orderkey", "l_linenumber")
    return table(spark, sf, "lineitem").withColumn("rn", F.row_number().over(w)).filter("rn <= 8").filter("l_returnflag <> 'N'").select("l_orderkey", "l_linenumber", F.col("rn").cast("long").alias("rn"))


@query("SELECT user_id, first(event_type ORDER BY ts, event_id) AS section FROM events GROUP BY user_id")
def win04_first_section(spark, sf):
    return table(spark, sf, "events").groupBy("user_id").agg(F.min_by("event_type", F.struct("ts", "event_id")).alias("section"))


_CANONICAL = "regexp_replace(lower(regexp_extract(url, '^([a-z]+://[^/?#]+)', 1)) || regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1), '/+$', '')"


@query(f"""
SELECT url, page_id FROM (SELECT {_CANONICAL} AS url, page_id, row_number() OVER (PARTITION BY {_CANONICAL} ORDER BY page_id DESC) AS rn FROM pages) WHERE rn = 1
""")
def win05_first_url(spark, sf):
    p = table(spark, sf, "pages").select(T.canonical_url("url").alias("url"), "page_id")
    return p.groupBy("url").agg(F.max("page_id").alias("page_id"))


@query("SELECT event_id, user_id FROM events ORDER BY ts, event_id LIMIT 100")
def top02_oldest_first(spark, sf):
    return table(spark, sf, "events").orderBy("ts", "event_id").limit(100).select("event_id", "user_id")


@query("SELECT event_id FROM (SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00' ORDER BY ts, event_id LIMIT 500)")
def top03_keyset_export(spark, sf):
    return table(spark, sf, "events").filter(F.col("ts").cast("timestamp") > F.lit("2024-01-15 00:00:00").cast("timestamp")).orderBy("ts", "event_id").limit(500).select("event_id")


@query("SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE event_type = 'purchase') WHERE rn = 1")
def top05_latest_run(spark, sf):
    e = table(spark, sf, "events").filter("event_type = 'purchase'")
    return e.groupBy("user_id").agg(F.max(F.struct("ts", "event_id")).getField("event_id").alias("event_id"))


@query("""
WITH a AS (SELECT user_id FROM events WHERE event_type = 'error' AND CAST(ts AS DATE) = DATE '2024-01-10' GROUP BY user_id),
     b AS (SELECT user_id FROM events WHERE event_type = 'error' AND CAST(ts AS DATE) = DATE '2024-01-11' GROUP BY user_id)
SELECT coalesce(a.user_id, b.user_id) AS name, CASE WHEN a.user_id IS NULL THEN 'new' WHEN b.user_id IS NULL THEN 'recovered' ELSE 'still' END AS change FROM a FULL JOIN b ON a.user_id = b.user_id
""")
def set06_alert_delta(spark, sf):
    e = table(spark, sf, "events").filter("event_type = 'error'")
    day = lambda d: e.filter(F.to_date("ts") == F.lit(d).cast("date")).select(F.col("user_id").alias("name")).distinct()
    return H.deltas(day("2024-01-10"), day("2024-01-11").withColumn("ok", F.lit(False)))


@query("SELECT p_partkey AS id, lower(p_name) AS folded, 'name' AS source FROM part UNION ALL SELECT p_partkey, lower(p_brand), 'ascii' FROM part WHERE lower(p_brand) <> lower(p_name)")
def set07_name_union(spark, sf):
    p = table(spark, sf, "part")
    name, brand = T.fold("p_name"), T.fold("p_brand")
    own = p.select(F.col("p_partkey").alias("id"), name.alias("folded"), F.lit("name").alias("source"))
    return own.unionByName(p.filter(brand != name).select(F.col("p_partkey").alias("id"), brand.alias("folded"), F.lit("ascii").alias("source")))


@query("""
SELECT p_brand, list_sort(list_distinct(list(p_size))) = list_sort(list_distinct(list(p_size))) AND len(list_intersect(list_distinct(list(p_size)), [1, 2, 3, 4, 5])) > 0 AS small,
  CAST(len(list_filter([1, 2, 3, 4, 5], lambda x: NOT list_contains(list_distinct(list(p_size)), x))) AS BIGINT) AS missing FROM part GROUP BY p_brand
""")
def set05_key_difference(spark, sf):
    wanted = F.array(*map(F.lit, range(1, 6)))
    g = table(spark, sf, "part").groupBy("p_brand").agg(F.collect_set("p_size").alias("s"))
    return g.select("p_brand", F.arrays_overlap("s", wanted).alias("small"), F.size(F.array_except(wanted, "s")).cast("long").alias("missing"))
