"""The published body: one item for each event, its reports, and the rules that a body has to keep."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian import schemas
from meridian.functions import geo, hashing, times
from meridian.functions import text as T

PIN_DAYS, WORLD_HOURS = 7, 72
MAX_ITEMS, MAX_REPORTS, MAX_TITLE, MAX_URL, MAX_PLACE, MAX_DECIMALS = 3000, 8, 300, 600, 120, 5
SCHEMA = "meridian.snapshot/1"
OUTLETS = schemas.OUTLETS


def reports(members: DataFrame, stories: DataFrame) -> DataFrame:
    """(cluster_id, reports, first, last): an event's earliest reports, MAX_REPORTS at most, and its span of time.

    Those without a headline or an address that can be opened are left out after the cut, not replaced. One join and
    one aggregate for all events.
    """
    j = members.select("cluster_id", "story_id").join(stories.select("story_id", "outlet", "headline", "url", "published"), "story_id")
    rank = F.row_number().over(Window.partitionBy("cluster_id").orderBy(F.col("published").asc_nulls_last(), "story_id"))
    j = j.withColumn("rank", rank)
    good = (F.coalesce("headline", F.lit("")) != "") & F.coalesce(F.col("url").rlike("^https?://"), F.lit(False)) & (F.col("rank") <= MAX_REPORTS)
    report = F.struct(
        "rank",
        "outlet",
        F.substring("headline", 1, MAX_TITLE).alias("headline"),
        F.substring("url", 1, MAX_URL).alias("url"),
        times.iso("published").alias("publishedAt"),
    )
    grouped = j.groupBy("cluster_id").agg(F.sort_array(F.collect_list(F.when(good, report))).alias("r"), F.min("published").alias("first"), F.max("published").alias("last"))
    plain = F.transform("r", lambda x: F.struct(x["outlet"].alias("outlet"), x["headline"].alias("headline"), x["url"].alias("url"), x["publishedAt"].alias("publishedAt")))
    return grouped.select("cluster_id", plain.alias("reports"), "first", "last")


def items(clusters: DataFrame, members: DataFrame, stories: DataFrame, extractions: DataFrame, resolutions: DataFrame, shown: DataFrame, now: Column, hashes: dict[str, str], pins: bool = True, world: bool = True) -> DataFrame:
    """The items of a body, newest first, MAX_ITEMS at most.

    clusters ⋈ founder ⟕ extraction ⟕ resolution under these settings; shown(geonames_id, display_name) names the places.
    An item with a place stays PIN_DAYS after its last report, another one WORLD_HOURS; pins or world off leaves them out.
    """
    own = clusters.filter(F.col("config_hash") == hashes["cluster"]).select("cluster_id", "founder_story", "is_pin", "latitude", "longitude", "place_precision")
    founder = stories.select(F.col("story_id").alias("founder_story"), F.col("outlet").alias("founder_outlet"))
    read = extractions.filter(F.col("config_hash") == hashes["extract"]).select(F.col("story_id").alias("founder_story"), "category", "event_date", "place_quote", "place_name")
    found = resolutions.filter(F.col("config_hash") == hashes["resolve"]).select(F.col("story_id").alias("founder_story"), "geonames_id")
    j = own.join(founder, "founder_story").join(read, "founder_story", "left").join(found, "founder_story", "left").join(shown, "geonames_id", "left")
    j = j.join(reports(members.filter(F.col("config_hash") == hashes["cluster"]), stories), "cluster_id").filter("last IS NOT NULL AND size(reports) > 0")
    drawn = F.col("is_pin") & F.col("place_precision").isin(schemas.PINNABLE_PRECISIONS) & F.col("display_name").isNotNull() & F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    location = F.struct(
        F.bround("latitude", 5).alias("lat"),
        F.bround("longitude", 5).alias("lon"),
        F.col("place_precision").alias("precision"),
        F.col("display_name").alias("place"),
        F.col("geonames_id").alias("geonamesId"),
        T.trim_evidence("place_quote", "place_name").alias("evidence"),
        F.col("founder_outlet").alias("evidenceOutlet"),
    )
    j = j.withColumn("location", F.when(drawn, location))
    age = F.unix_timestamp(now) - F.unix_timestamp("last")
    stays = F.when(F.col("location").isNotNull(), (age <= PIN_DAYS * 86400) & F.lit(pins)).otherwise((age <= WORLD_HOURS * 3600) & F.lit(world))
    out = j.filter(stays).select(
        F.col("cluster_id").alias("id"),
        "category",
        F.get("reports", F.lit(0))["headline"].alias("title"),
        times.iso("first").alias("firstReportedAt"),
        times.iso("last").alias("lastReportedAt"),
        F.date_format("event_date", "yyyy-MM-dd").alias("eventDate"),
        "location",
        "reports",
    )
    return out.orderBy(F.desc("lastReportedAt"), F.desc("id")).limit(MAX_ITEMS)


def outlets_block(health: DataFrame) -> DataFrame:
    """(outlet, lastNewStoryAt) of all outlets, in their order, known or not."""
    spark = health.sparkSession
    dim = spark.createDataFrame(list(enumerate(OUTLETS)), "place int, outlet string")
    return dim.join(health.select("outlet", "last_new_story_at"), "outlet", "left").orderBy("place").select("outlet", times.iso("last_new_story_at").alias("lastNewStoryAt"))


def body(found: DataFrame, outlets: DataFrame, now: str, data_as_of: str | None, pins_withheld: bool, world_withheld: bool) -> dict:
    """The whole body with its id. A body has at most MAX_ITEMS items, so it is put together on the driver."""
    out = {
        "schema": SCHEMA,
        "snapshotId": "",
        "generatedAt": now,
        "dataAsOf": data_as_of,
        "pinsWithheld": pins_withheld,
        "worldNewsWithheld": world_withheld,
        "outlets": [r.asDict() for r in outlets.collect()],
        "items": [json.loads(x) for x in found.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("j")).toPandas()["j"]],
    }
    out["snapshotId"] = hashing.snapshot_id(out)
    return out


LOCATION = "lat double, lon double, precision string, place string, geonamesId long, evidence string, evidenceOutlet string"
ITEM = (
    "id string, category string, title string, firstReportedAt string, lastReportedAt string, eventDate string,"
    f" location struct<{LOCATION}>, reports array<struct<outlet string, headline string, url string, publishedAt string>>"
)
_UTC = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"


def item_problems(found: DataFrame, generated_at: str | None = None) -> DataFrame:
    """(id, problem): each way in which items break a rule. One pass over the items and one aggregate for repeated ids.

    Items are typed as ITEM, so a value of the wrong type has become null and shows as missing.
    """
    n = lambda c: F.coalesce(c, F.lit(False))
    missing = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    loc, lead = F.col("location"), F.get("reports", F.lit(0))
    located = loc.isNotNull()
    any_report = lambda f: F.exists(F.coalesce("reports", F.expr("array()").cast(found.schema["reports"].dataType)), f)
    rules = [
        ("id", ~n(F.col("id").rlike("^nf_[0-9a-f]{12}$"))),
        ("category", ~n(F.col("category").isin(*schemas.PIN_POSSIBLE))),
        ("title_missing", missing(F.col("title"))),
        ("title_long", n(F.length("title") > MAX_TITLE)),
        *((f"{c}_shape", ~n(F.col(c).rlike(_UTC))) for c in ("firstReportedAt", "lastReportedAt")),
        ("first_after_last", n(F.col("firstReportedAt") > F.col("lastReportedAt"))),
        ("event_date_shape", F.col("eventDate").isNotNull() & ~n(F.col("eventDate").rlike(r"^\d{4}-\d{2}-\d{2}$"))),
        *((f"{axis}_range", located & ~n(loc[axis].between(-m, m))) for axis, m in (("lat", 90.0), ("lon", 180.0))),
        *((f"{axis}_decimals", located & n(geo.decimals(loc[axis]) > MAX_DECIMALS)) for axis in ("lat", "lon")),
        ("precision", located & ~n(loc["precision"].isin(schemas.PINNABLE_PRECISIONS))),
        ("place_missing", located & missing(loc["place"])),
        ("place_long", located & n(F.length(loc["place"]) > MAX_PLACE)),
        ("geonames_id", located & ~n(loc["geonamesId"] > 0)),
        ("evidence_missing", located & missing(loc["evidence"])),
        ("evidence_long", located & n(F.length(loc["evidence"]) > T.MAX_EVIDENCE)),
        ("evidence_outlet", located & ~n(loc["evidenceOutlet"].isin(OUTLETS))),
        ("reports_number", ~n(F.size("reports").between(1, MAX_REPORTS))),
        ("report_outlet", any_report(lambda r: ~n(r["outlet"].isin(OUTLETS)))),
        ("report_headline", any_report(lambda r: missing(r["headline"]) | n(F.length(r["headline"]) > MAX_TITLE))),
        ("report_url", any_report(lambda r: ~n(r["url"].rlike("^https?://")) | n(F.length(r["url"]) > MAX_URL))),
        ("report_time", any_report(lambda r: ~n(r["publishedAt"].rlike(_UTC)))),
        ("lead_not_earliest", any_report(lambda r: n(r["publishedAt"] < lead["publishedAt"]))),
        ("report_twice", n(F.size(F.array_distinct(F.transform("reports", lambda r: F.struct(r["outlet"], r["url"])))) < F.size("reports"))),
        ("title_not_lead", n(F.size("reports") > 0) & ~lead["headline"].eqNullSafe(F.col("title"))),
        ("first_not_lead", n(F.size("reports") > 0) & ~lead["publishedAt"].eqNullSafe(F.col("firstReportedAt"))),
    ]
    if generated_at:
        age = F.unix_timestamp(F.to_timestamp(F.lit(generated_at))) - F.unix_timestamp(F.try_to_timestamp(F.col("lastReportedAt")))
        rules.append(("outside_window", n(age > F.when(located, PIN_DAYS * 86400).otherwise(WORLD_HOURS * 3600))))
    named = F.array_compact(F.array(*(F.when(bad, F.lit(name)) for name, bad in rules)))
    twice = found.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("id", F.lit("id_twice").alias("problem"))
    return found.select("id", F.explode(named).alias("problem")).unionByName(twice)


FRAME = ("schema", "snapshotId", "generatedAt", "dataAsOf", "pinsWithheld", "worldNewsWithheld", "outlets", "items")


def frame_problems(bodies: DataFrame, key: str, body: str) -> DataFrame:
    """(key, problem): what body_problems() says of each of many bodies, by expressions over the body's JSON; `not an object` of one that is none."""
    v, keys = F.try_parse_json(body), F.json_object_keys(F.when(F.try_parse_json(body).isNotNull(), F.col(body)))
    at = lambda path, kind="variant": F.try_variant_get("_v", path, kind)
    kind_of = lambda path: F.coalesce(F.schema_of_variant(at(path)), F.lit("VOID"))
    string = lambda path: F.when(kind_of(path) == "STRING", at(path, "string"))
    none = F.array().cast("array<string>")
    expected = F.array(*map(F.lit, FRAME))
    sorted_out = lambda a, b, word: F.transform(F.array_sort(F.array_except(a, b)), lambda k: F.concat(F.lit(f"{word}: "), k))
    told = lambda bad, name: F.when(bad, F.lit(name))
    listed = lambda path: F.coalesce(at(path, "array<variant>"), F.array().cast("array<variant>"))
    read = bodies.select(F.col(key).alias("_key"), v.alias("_v"), keys.alias("_keys")).withColumns({"_items": listed("$.items"), "_named": F.transform(listed("$.outlets"), lambda x: F.try_variant_get(x, "$.outlet", "string"))})
    times_of = lambda o: F.size(F.filter("_named", lambda x: x.eqNullSafe(F.lit(o))))
    located = lambda x: F.coalesce(F.schema_of_variant(F.try_variant_get(x, "$.location", "variant")).startswith("OBJECT<"), F.lit(False))
    whole = lambda path: (kind_of(path) == "BOOLEAN") & F.coalesce(at(path, "boolean"), F.lit(False))
    single = F.array_compact(
        F.array(
            told(~string("$.schema").eqNullSafe(F.lit(SCHEMA)), "schema"),
            told(~F.coalesce(string("$.snapshotId").rlike("^snap_[0-9a-f]{16}$"), F.lit(False)), "snapshotId"),
            *(told(~F.coalesce(string(f"$.{k}").rlike(_UTC), F.lit(False)), k) for k in ("generatedAt", "dataAsOf")),
            *(told(kind_of(f"$.{k}") != "BOOLEAN", k) for k in ("pinsWithheld", "worldNewsWithheld")),
            *(F.when(times_of(o) != 1, F.concat(F.lit(f"outlet {o}: "), times_of(o).cast("string"), F.lit(" times"))) for o in OUTLETS),
            told(F.size("_items") > MAX_ITEMS, "too many items"),
            told(whole("$.pinsWithheld") & F.exists("_items", located), "pins withheld but sent"),
            told(whole("$.worldNewsWithheld") & F.exists("_items", lambda x: ~located(x)), "world news withheld but sent"),
        )
    )
    strange = F.transform(F.filter("_named", lambda x: ~F.coalesce(x.isin(*OUTLETS), F.lit(False))), lambda x: F.concat(F.lit("outlet "), F.coalesce(x, F.lit("None"))))
    found = F.when(F.col("_keys").isNull(), F.array(F.lit("not an object"))).otherwise(F.concat(sorted_out(expected, F.coalesce("_keys", none), "missing"), sorted_out(F.coalesce("_keys", none), expected, "unknown"), single, strange))
    return read.select(F.col("_key").alias(key), F.explode(found).alias("problem"))


def body_problems(value: dict) -> list[str]:
    """Ways in which the frame of a body breaks a rule; its items are item_problems' business."""
    import re

    expected = set(FRAME)
    found = [f"missing: {k}" for k in sorted(expected - value.keys())] + [f"unknown: {k}" for k in sorted(value.keys() - expected)]
    found += ["schema"] * (value.get("schema") != SCHEMA)
    found += ["snapshotId"] * (not re.fullmatch("snap_[0-9a-f]{16}", str(value.get("snapshotId"))))
    found += [k for k in ("generatedAt", "dataAsOf") if not re.match(_UTC, str(value.get(k)))]
    found += [k for k in ("pinsWithheld", "worldNewsWithheld") if not isinstance(value.get(k), bool)]
    named = [x.get("outlet") for x in value.get("outlets") or []]
    found += [f"outlet {o}: {named.count(o)} times" for o in OUTLETS if named.count(o) != 1] + [f"outlet {o}" for o in named if o not in OUTLETS]
    listed = value.get("items") or []
    found += ["too many items"] * (len(listed) > MAX_ITEMS)
    found += ["pins withheld but sent"] * bool(value.get("pinsWithheld") is True and any(i.get("location") for i in listed))
    found += ["world news withheld but sent"] * bool(value.get("worldNewsWithheld") is True and any(not i.get("location") for i in listed))
    return found
