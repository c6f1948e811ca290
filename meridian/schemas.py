"""Table schemas, and closed lists that the operators share."""

from __future__ import annotations

SCHEMA_VERSION = 5

#: The tables of a store and their columns.
TABLES = {
    "stories": "story_id string, outlet string, primary_alias string, url string, source_url string, headline string, description string,"
    " published timestamp, published_raw string, updated timestamp, updated_raw string, authors array<string>, word_count int, thumbnail string,"
    " categories map<string,string>, format_flags array<string>, text_hash string, text_fetched_at timestamp, first_seen_at timestamp,"
    " last_seen_at timestamp, status string, lease_owner string, lease_until timestamp",
    "story_aliases": "outlet string, alias string, story_id string, first_seen_at timestamp",
    "story_sections": "story_id string, section string, first_seen_at timestamp, last_seen_at timestamp",
    "story_texts": "story_id string, text string, text_hash string, word_count int, updated_at timestamp",
    "outlet_health": "outlet string, last_run_at timestamp, last_success_at timestamp, last_new_story_at timestamp, last_error string,"
    " last_error_at timestamp, consecutive_failures int, updated_at timestamp",
    "scrape_runs": "run_id string, started_at timestamp, finished_at timestamp, sections array<string>, rows_seen int, new_stories int, errors map<string,string>",
    "extractions": "story_id string, config_hash string, text_hash string, accepted boolean, failure_reason string, is_physical_event boolean,"
    " not_event_reason string, category string, event_date date, place_name string, place_within string, place_country string, place_kind string,"
    " place_quote string, other_places array<string>, key_entities array<string>, cluster_hint string, raw string, model string,"
    " schema_retried boolean, outlet_tags array<string>, checks map<string,string>, created_at timestamp",
    "llm_calls": "call_id string, stage string, story_id string, model string, config_hash string, prompt_tokens int, completion_tokens int,"
    " cache_hit_tokens int, cache_miss_tokens int, cost_usd double, latency_ms int, attempts int, outcome string, created_at timestamp",
    "resolutions": "story_id string, config_hash string, extract_hash string, resolved boolean, geonames_id long, matched_name string,"
    " latitude double, longitude double, feature_code string, place_precision string, pinnable boolean, climbed boolean, reason string, created_at timestamp",
    "clusters": "cluster_id string, config_hash string, founder_story string, country string, founder_published timestamp, latitude double,"
    " longitude double, place_precision string, is_pin boolean, not_pin_reason string, open boolean, created_at timestamp",
    "cluster_members": "story_id string, config_hash string, cluster_id string, verdict string, compared_to string, joined_at timestamp",
    "verifications": "story_id string, extract_hash string, resolve_hash string, verify_hash string, input_hash string, geonames_id long,"
    " place_precision string, fallback boolean, claim string, verify_answer string, flags string, critic_answer string, outcome string,"
    " reason string, attempts int, cost_usd double, created_at timestamp, updated_at timestamp",
    "places": "geonames_id long, name string, ascii_name string, latitude double, longitude double, feature_class string, feature_code string,"
    " country string, admin1 string, admin2 string, population long",
    "names": "folded string, geonames_id long, source string",
    "countries": "code string, name string",
    "admin_areas": "code string, name string, level int",
}

#: Categories that a story can have, and whether such a story may be drawn at a place.
PIN_POSSIBLE = {
    "conflict": True,
    "attack_or_violent_crime": True,
    "crime_and_policing": True,
    "protest_and_unrest": True,
    "disaster": True,
    "accident": True,
    "health": True,
    "politics_and_diplomacy": True,
    "courts_and_justice": False,
    "economy_and_business": True,
    "science_climate_tech": True,
    "society_culture_sport": True,
    "opinion_analysis": False,
}
#: Why a story is no happening at a place; kinds of places; kinds that are never drawn.
NOT_EVENT_REASONS = ["opinion", "analysis", "roundup", "policy", "past_event", "no_place", "other"]
PLACE_KINDS = ["venue", "street", "district", "city", "region", "country"]
NEVER_PINNED_KINDS = ["region", "country", "state", "province", "continent"]
#: Precision of a feature code; class S is a point whatever its code.
PRECISION_BY_CODE = {
    "PPLX": "district",
    "ADM3": "district",
    "ADM4": "district",
    "PPL": "city",
    "PPLA": "city",
    "PPLA2": "city",
    "PPLA3": "city",
    "PPLA4": "city",
    "PPLC": "city",
    "ADM1": "region",
    "ADM2": "region",
    "PCLI": "country",
    "PCL": "country",
    "PCLD": "country",
    "PCLF": "country",
    "PCLS": "country",
}
PINNABLE_PRECISIONS = ["point", "district", "city"]
#: How coarse a precision is, and the precision that each kind of place asks for.
PRECISION_ORDER = {"point": 0, "district": 1, "city": 2, "region": 3, "country": 4}
KIND_PRECISION = {"venue": "point", "street": "point", "district": "district", "city": "city", "region": "region", "country": "country"}
#: Outlets of a snapshot in their order, and those no longer read.
OUTLETS = ["reuters", "bbc", "guardian", "pbs", "nyt"]
DROPPED_OUTLETS = ["guardian", "nyt"]


def check_version(found: int | None) -> int:
    """The schema version to migrate from; a store that is newer than this code is refused."""
    found = found or 0
    if found > SCHEMA_VERSION:
        raise ValueError(f"the store has schema {found}, this code knows {SCHEMA_VERSION}")
    return found


def migrated(df, name: str, found: int | None):
    """A table of a store with an older schema in this one's columns: new ones are null, kinds are cast, others stay behind."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import StructType

    check_version(found)
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(TABLES[name])))
