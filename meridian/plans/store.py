"""A store made from the driver tables, so that the store's operators can be held against SQL.

The driver has no stories. Each table here is one SELECT over driver tables, in words that Spark and DuckDB both have, so
both sides start from the same rows; what the operators make of them is written separately, in the library and in SQL.
Events are stories (a user's number gives the outlet), customers are places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.plans.registry import table

_AT = "date_trunc('second', ts)"
_OUTLET = "split_part('reuters,bbc,guardian,pbs,nyt', ',', CAST(1 + user_id % 5 AS INT))"

DEFINED = {
    "stories": f"""
SELECT concat('s', event_id) AS story_id, event_id AS n, {_OUTLET} AS outlet, concat('a', event_id) AS primary_alias,
  concat('https://x.org/', event_type, '/', event_id % 500) AS url, CAST(NULL AS STRING) AS source_url,
  CASE WHEN event_id % 7 <> 0 THEN concat(event_type, ' at place ', event_id % 97, ' by the river') END AS headline,
  CASE WHEN event_id % 4 = 0 THEN '' ELSE concat('seen by user ', user_id) END AS description,
  CASE WHEN event_id % 3 <> 0 THEN {_AT} END AS published, CASE WHEN event_id % 9 < 5 THEN {_AT} + INTERVAL 1 HOUR END AS updated,
  {_AT} AS first_seen_at, CASE WHEN event_id % 2 = 0 THEN {_AT} + INTERVAL 3 DAY ELSE {_AT} END AS last_seen_at,
  CASE WHEN event_id % 11 = 1 THEN split('live,video', ',') WHEN event_id % 10 = 3 THEN split('opinion', ',') END AS format_flags,
  CASE WHEN event_id % 6 <> 5 THEN concat('h', event_id % 1000) END AS text_hash,
  CASE WHEN event_id % 5 < 3 THEN {_AT} END AS text_fetched_at, CAST(event_id % 300 AS INT) AS word_count,
  CASE event_type WHEN 'view' THEN 'feed' WHEN 'click' THEN 'scraped' ELSE 'extracted' END AS status,
  CASE WHEN event_id % 6 = 0 THEN 'w1' END AS lease_owner, CASE WHEN event_id % 6 = 0 THEN {_AT} + INTERVAL 5 DAY END AS lease_until
FROM events""",
    "extractions": f"""
SELECT concat('s', event_id) AS story_id, CASE WHEN event_id % 3 = 2 THEN 'e0' ELSE 'e1' END AS config_hash, concat('h', event_id % 1000) AS text_hash,
  event_id % 5 <> 0 AS accepted, CASE WHEN event_id % 5 = 0 THEN 'quote_not_in_text' END AS failure_reason, value > 40 AS is_physical_event,
  split_part('conflict,courts_and_justice,opinion_analysis,health,accident', ',', CAST(1 + event_id % 5 AS INT)) AS category, CAST(ts AS DATE) AS event_date,
  CASE WHEN event_id % 9 <> 0 THEN concat('Place ', user_id % 50) WHEN event_id % 2 = 0 THEN '' END AS place_name,
  CASE WHEN event_id % 2 = 0 THEN concat('Area ', user_id % 10) END AS place_within,
  CASE WHEN event_id % 11 <> 0 THEN concat('C', user_id % 25) END AS place_country,
  split_part('venue,street,city,region,country,district', ',', CAST(1 + event_id % 6 AS INT)) AS place_kind,
  CASE WHEN event_id % 8 <> 7 THEN concat('It happened at Place ', user_id % 50, ' today') END AS place_quote,
  split(concat('A', event_id % 3, ', ,B'), ',') AS other_places, split(concat('Person ', event_id % 40, ',person ', event_id % 40, ', Org ', event_id % 12), ',') AS key_entities,
  {_AT} + INTERVAL 1 DAY AS created_at
FROM events WHERE event_id % 4 <> 1""",
    "resolutions": f"""
SELECT concat('s', event_id) AS story_id, CASE WHEN event_id % 16 = 2 THEN 'r0' ELSE 'r1' END AS config_hash, CASE WHEN event_id % 3 = 2 THEN 'e0' ELSE 'e1' END AS extract_hash,
  event_id % 200 AS geonames_id, CASE WHEN event_id % 10 <> 3 THEN CAST(user_id % 140 - 70 AS DOUBLE) + value / 100 END AS latitude,
  CASE WHEN event_id % 10 <> 3 THEN CAST(user_id * 7 % 360 - 180 AS DOUBLE) + value / 80 END AS longitude,
  split_part('point,city,region,district,country', ',', CAST(1 + event_id % 5 AS INT)) AS place_precision, event_id % 5 IN (0, 1, 3) AS pinnable, {_AT} + INTERVAL 2 DAY AS created_at
FROM events WHERE event_id % 8 IN (2, 3, 6, 7)""",
    "clusters": """
SELECT concat('c', user_id) AS cluster_id, CASE WHEN user_id % 9 = 0 THEN 'k0' ELSE 'k1' END AS config_hash, concat('s', min(event_id)) AS founder_story,
  CASE WHEN user_id % 13 <> 0 THEN concat('C', user_id % 25) END AS country, date_trunc('second', min(ts)) AS founder_published,
  CAST(user_id % 140 - 70 AS DOUBLE) AS latitude, CAST(user_id * 7 % 360 - 180 AS DOUBLE) AS longitude, split_part('city,point,region', ',', CAST(1 + user_id % 3 AS INT)) AS place_precision,
  user_id % 2 = 0 AS is_pin, CASE WHEN user_id % 2 <> 0 THEN 'old reason' END AS not_pin_reason, user_id % 4 <> 0 AS open, date_trunc('second', max(ts)) AS created_at
FROM events GROUP BY user_id""",
    "cluster_members": f"""
SELECT concat('s', event_id) AS story_id, CASE WHEN (CASE WHEN event_id % 10 = 4 THEN user_id + 1 ELSE user_id END) % 9 = 0 THEN 'k0' ELSE 'k1' END AS config_hash,
  concat('c', CASE WHEN event_id % 10 = 4 THEN user_id + 1 ELSE user_id END) AS cluster_id, 'same' AS verdict, CAST(NULL AS STRING) AS compared_to, {_AT} AS joined_at
FROM events WHERE event_id % 2 = 0""",
    "story_sections": f"""
SELECT concat('s', event_id) AS story_id, event_type AS section, {_AT} AS first_seen_at, {_AT} + INTERVAL 1 DAY AS last_seen_at FROM events
UNION ALL SELECT concat('s', event_id), concat('section', event_id % 4), {_AT}, {_AT} FROM events WHERE event_id % 3 = 0""",
    "story_texts": f"""
SELECT concat('s', event_id) AS story_id, CASE WHEN event_id % 12 <> 0 THEN concat('Text of ', event_type, ' ', event_id, '. It happened at Place ', user_id % 50, ' today.') ELSE '' END AS text,
  concat('h', event_id % 1000) AS text_hash, CAST(10 AS INT) AS word_count, {_AT} AS updated_at FROM events WHERE event_id % 3 <> 1""",
    "outlet_health": f"""
SELECT {_OUTLET} AS outlet, date_trunc('second', max(ts)) AS last_run_at, date_trunc('second', min(ts)) AS last_success_at,
  CASE WHEN min(user_id % 5) <> 3 THEN date_trunc('second', max(ts)) - INTERVAL 10 HOUR END AS last_new_story_at, concat('could  not read https://u:p@h/', min(event_id)) AS last_error,
  date_trunc('second', max(ts)) AS last_error_at, CAST(min(user_id % 5) + 1 AS INT) AS consecutive_failures, date_trunc('second', max(ts)) AS updated_at
FROM events WHERE user_id % 5 <> 4 GROUP BY {_OUTLET}""",
    "story_aliases": f"""
SELECT {_OUTLET} AS outlet, concat('a', event_id) AS alias, concat('s', event_id) AS story_id, {_AT} AS first_seen_at FROM events
UNION ALL SELECT {_OUTLET}, concat('u', event_id % 500), concat('s', min(event_id)), date_trunc('second', min(ts)) FROM events GROUP BY {_OUTLET}, event_id % 500""",
    "verifications": f"""
SELECT concat('s', event_id) AS story_id, concat('i', event_id % 7) AS input_hash, event_id % 200 AS geonames_id, split_part('verified,kept,dropped,unsure,error', ',', CAST(1 + event_id % 5 AS INT)) AS outcome,
  CAST(event_id % 3 AS INT) AS attempts, value / 1000 AS cost_usd, {_AT} AS created_at, {_AT} + INTERVAL 2 DAY AS updated_at
FROM events WHERE event_id % 2 = 1""",
    "llm_calls": f"""
SELECT concat('k', event_id) AS call_id, event_type AS stage, concat('s', event_id) AS story_id, split_part('alpha,beta,alpha', ',', CAST(1 + event_id % 3 AS INT)) AS model, 'e1' AS config_hash,
  value / 1000 AS cost_usd, CASE WHEN event_id % 10 = 0 THEN 'error' ELSE 'ok' END AS outcome, {_AT} AS created_at FROM events""",
    "scrape_runs": f"""
SELECT concat('r', event_id) AS run_id, {_AT} AS started_at, CASE WHEN event_id % 4 <> 0 THEN {_AT} + INTERVAL 1 HOUR END AS finished_at, CAST(event_id % 50 AS INT) AS rows_seen, CAST(event_id % 7 AS INT) AS new_stories
FROM events WHERE event_type = 'signup'""",
    "places": """
SELECT c_custkey + 1 AS geonames_id, concat('Town ', c_custkey % 60) AS name, CASE WHEN c_custkey % 3 = 0 THEN concat('Towne ', c_custkey % 60) WHEN c_custkey % 3 = 1 THEN concat('town ', c_custkey % 60) END AS ascii_name,
  CAST(c_custkey * 37 % 1400 AS DOUBLE) / 10 - 70 AS latitude, CAST(c_custkey * 91 % 3600 AS DOUBLE) / 10 - 180 AS longitude,
  split_part('P,P,S,A,A,P,A', ',', CAST(1 + c_custkey % 7 AS INT)) AS feature_class, split_part('PPL,PPLX,BLDG,ADM1,ADM2,PPLC,PCLI', ',', CAST(1 + c_custkey % 7 AS INT)) AS feature_code,
  concat('C', c_custkey % 5) AS country, CASE WHEN c_custkey % 4 <> 0 THEN concat('A', c_custkey % 6) END AS admin1, CASE WHEN c_custkey % 8 <> 1 THEN concat('B', c_custkey % 9) END AS admin2,
  CASE WHEN c_custkey % 10 < 3 THEN 0 ELSE c_custkey * 7919 % 5000 END AS population
FROM customer""",
    "alternates": """
SELECT concat('alt ', p_partkey % 80) AS folded, p_partkey * 2 AS geonames_id, CASE WHEN p_size % 2 = 0 THEN 'wikipedia' ELSE 'alternate' END AS source FROM part
UNION ALL SELECT '', s_suppkey + 1, 'alternate' FROM supplier""",
    "countries": "SELECT concat('C', r_regionkey) AS code, CASE WHEN r_regionkey = 2 THEN 'Town 7' ELSE r_name END AS name FROM region WHERE r_regionkey <> 4",
    "admin_areas": """
SELECT concat('C', n_nationkey % 5, '.A', n_nationkey % 6) AS code, CASE WHEN n_nationkey % 4 = 0 THEN concat('Town ', n_nationkey) ELSE n_name END AS name, 1 AS level FROM nation WHERE n_nationkey < 20
UNION ALL SELECT concat('C', n_nationkey % 5, '.A', n_nationkey % 6, '.B', n_nationkey % 9), concat('Second ', n_name), 2 FROM nation WHERE n_nationkey > 4""",
}


def store(spark: SparkSession, sf: str, *names: str) -> list[DataFrame]:
    """The named tables of the store."""
    out = []
    for name in names:
        text = DEFINED[name]
        used = [t for t in ("events", "customer", "part", "supplier", "region", "nation") if f"FROM {t}" in text]
        frames = {t: table(spark, sf, t) for t in used}
        if "events" in frames:
            frames["events"] = frames["events"].withColumn("ts", F.col("ts").cast("timestamp"))
        for t in used:
            text = text.replace(f"FROM {t}", f"FROM {{{t}}}")
        out.append(spark.sql(text, **frames))
    return out


def over_store(sql: str, *names: str, more: str = "") -> str:
    """SQL with the named tables of the store before it."""
    return "WITH " + ",\n".join([*(f"{n} AS ({DEFINED[n]})" for n in names), *([more] if more else [])]) + "\n" + sql
