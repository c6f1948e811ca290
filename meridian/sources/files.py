"""Tab-separated place dumps and the semicolon-separated incident export."""

from __future__ import annotations

import io
import itertools
import json
import zipfile
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.functions import hashing
from meridian.functions import text as T
from meridian.functions import times

CODES_NOT_NAMES = ["post", "iata", "icao", "faac", "abbr", "wkdt", "unlc"]


def zip_lines(spark: SparkSession, path: str, member: str) -> DataFrame:
    """value: the lines of one file in each zip archive at path; archives side by side."""
    return archive_lines(spark.read.format("binaryFile").load(path), member)


def archive_lines(archives: DataFrame, member: str) -> DataFrame:
    """value: the lines of one file in each zip archive of archives(content, ...), unpacked as a stream in the task that has read it.

    An archive can't be split, so it is one task's work, and 2 GB at most; its lines are dealt out anew after it. What is no
    archive, or has no such file, is an error: a gazetteer isn't built from half a dump.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for content in (c for batch in batches for c in batch.column("content") if c.is_valid):
            with zipfile.ZipFile(pa.BufferReader(content.as_buffer())) as archive, archive.open(member) as raw:
                lines = io.TextIOWrapper(raw, encoding="utf-8", errors="replace", newline="\n")
                while part := list(itertools.islice(lines, 10_000)):
                    yield pa.RecordBatch.from_arrays([pa.array([x.removesuffix("\n") for x in part], pa.string())], ["value"])

    found = archives.select("content").mapInArrow(run, "value string")
    return found.repartition(int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _fields(spark: SparkSession, path: str, least: int) -> DataFrame:
    """f: the fields of each line; no comments, no short lines. Quotes mean nothing in these files, and \\r may end a line.

    A path with a hash sign names a file in a zip archive: dump.zip#places.txt.
    """
    archive, _, member = path.partition("#")
    raw = zip_lines(spark, archive, member) if member else spark.read.text(path)
    lines = raw.select(F.regexp_replace("value", "\\r$", "").alias("value"))
    return lines.filter("value <> '' AND NOT startswith(value, '#')").select(F.split("value", "\\t").alias("f")).filter(F.size("f") >= least)


def read_places(spark: SparkSession, path: str) -> DataFrame:
    """Administrative areas, towns and spots; a line without a whole id or coordinates is none, a broken population is 0."""
    at = lambda i: F.get("f", F.lit(i))
    text = lambda i: F.nullif(F.trim(at(i)), F.lit(""))
    cast = lambda i, kind: F.trim(at(i)).try_cast(kind)
    rows = _fields(spark, path, 15).filter(at(6).isin("A", "P", "S"))
    return rows.select(
        cast(0, "long").alias("geonames_id"),
        F.trim(at(1)).alias("name"),
        text(2).alias("ascii_name"),
        cast(4, "double").alias("latitude"),
        cast(5, "double").alias("longitude"),
        at(6).alias("feature_class"),
        F.trim(at(7)).alias("feature_code"),
        F.trim(at(8)).alias("country"),
        text(10).alias("admin1"),
        text(11).alias("admin2"),
        F.coalesce(cast(14, "long"), F.lit(0)).alias("population"),
    ).filter("geonames_id IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL AND NOT isnan(latitude) AND NOT isnan(longitude)")


def read_alternates(spark: SparkSession, path: str) -> DataFrame:
    """(folded, geonames_id, source): English and preferred names that are not historic, and titles of English articles."""
    at = lambda i: F.coalesce(F.get("f", F.lit(i)), F.lit(""))
    language = F.lower(F.trim(at(2)))
    title = T.wikipedia_title(at(3))
    spoken = ~language.isin(*CODES_NOT_NAMES, "link") & (F.trim(at(7)) != "1") & (language.isin("en", "") | (F.trim(at(4)) == "1"))
    name = F.when(language == "link", title).when(spoken, F.nullif(F.trim(at(3)), F.lit("")))
    rows = _fields(spark, path, 4).select(name.alias("name"), F.trim(at(1)).try_cast("long").alias("geonames_id"), F.when(language == "link", F.lit("wikipedia")).otherwise(F.lit("alternate")).alias("source"))
    return rows.filter("name IS NOT NULL AND geonames_id IS NOT NULL").select(T.fold("name").alias("folded"), "geonames_id", "source")


def read_countries(spark: SparkSession, path: str) -> DataFrame:
    f = lambda i: F.trim(F.get("f", F.lit(i)))
    return _fields(spark, path, 5).select(f(0).alias("code"), f(4).alias("name")).filter("code <> '' AND name <> ''")


def read_admin_areas(spark: SparkSession, path: str, level: int) -> DataFrame:
    f = lambda i: F.trim(F.get("f", F.lit(i)))
    return _fields(spark, path, 2).select(f(0).alias("code"), f(1).alias("name"), F.lit(level).alias("level")).filter("code <> '' AND name <> ''")


INCIDENT_COLUMNS = ["Conflict", "Date", "Name", "Faction", "Origin", "Latitude", "Longitude", "PlusCode", "Description", "Source", "Geolocation", "Equipment", "EquipmentItems", "Units", "OrbatUnits", "Id"]


def read_incidents(spark: SparkSession, path: str, conflict: str = "ukraine", origins: tuple[str, ...] = ("VID", "UAV", "PIC")) -> DataFrame:
    """Rows of one conflict that were seen in pictures, with a time, a place on earth and an id."""
    schema = ", ".join(f"`{c}` string" for c in INCIDENT_COLUMNS)
    rows = spark.read.csv(path, sep=";", header=True, schema=schema, multiLine=True, quote='"', escape='"')
    return seen_incidents(rows, conflict, origins)


def seen_incidents(rows: DataFrame, conflict: str = "ukraine", origins: tuple[str, ...] = ("VID", "UAV", "PIC")) -> DataFrame:
    number = lambda c: F.trim(c).try_cast("double")
    on_earth = lambda c, most: F.coalesce(number(c).between(-most, most) & ~F.isnan(number(c)), F.lit(False))
    return rows.filter(
        F.lower(F.coalesce("Conflict", F.lit(""))).contains(conflict)
        & F.upper(F.coalesce("Origin", F.lit(""))).isin(*origins)
        & times.utc("Date").isNotNull()
        & on_earth("Latitude", 90.0)
        & on_earth("Longitude", 180.0)
        & (F.coalesce("Id", F.lit("")) != "")
    )


def latest_incident(rows: DataFrame) -> DataFrame:
    """The one row with the last (Date, Id)."""
    return rows.orderBy(F.desc("Date"), F.desc("Id")).limit(1)


def row_hash(rows: DataFrame, columns: list[str] = INCIDENT_COLUMNS) -> Column:
    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: hashing.digest(json.loads(x)))

    return run(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def incident_tables(rows: DataFrame, fetched_at: str, schema_version: int = 1, interpretation: dict | None = None) -> dict[str, DataFrame]:
    """An incident, its claims, its receipt and the run, one table each, for each of rows.

    A claim's number is its kind's: location, type, actors, weapons; those without a value are left out. An
    interpretation (event_type, event_time_start, actors, weapons) overrides what was parsed.
    """
    given = (interpretation or {}).get("payload", {})
    text = lambda c: F.nullif(F.col(c), F.lit(""))
    quote = F.coalesce(text("Description"), text("Name"), F.col("Id"))
    j = rows.withColumns({
        "incident_id": F.concat(F.lit("geoconfirmed:"), "Id"),
        "quote": quote,
        "type": F.lit(given["event_type"]) if given.get("event_type") else T.event_type("Name", "Description"),
        "starts": F.lit(given["event_time_start"]) if given.get("event_time_start") else F.col("Date"),
        "actors": F.array(*map(F.lit, given["actors"])) if given.get("actors") else F.array_compact(F.array(text("OrbatUnits"), text("Units"), text("Faction"))),
        "weapons": F.array(*map(F.lit, given["weapons"])) if given.get("weapons") else F.array_compact(F.array(text("EquipmentItems"))),
        "digest": row_hash(rows),
        "lon": F.col("Longitude").try_cast("double"),
        "lat": F.col("Latitude").try_cast("double"),
    })
    claim = lambda n, kind, value, there: F.when(there, F.struct(F.lit(n).alias("n"), F.lit(kind).alias("kind"), F.to_json(F.struct(value.alias("value"))).alias("value")))
    claims = F.array_compact(
        F.array(
            claim(1, "location", F.array("lon", "lat"), F.lit(True)),
            claim(2, "event_type", F.col("type"), F.lit(True)),
            claim(3, "actor", F.col("actors"), F.size("actors") > 0),
            claim(4, "weapon", F.col("weapons"), F.size("weapons") > 0),
        )
    )
    each = j.select("incident_id", "quote", F.explode(claims).alias("c"))
    fetched, version = F.lit(fetched_at), F.lit(schema_version)
    return {
        "incidents": j.select(
            F.col("incident_id").alias("id"),
            "type",
            F.col("quote").alias("title"),
            F.col("starts").alias("event_time_start"),
            fetched.alias("first_seen"),
            "lat",
            "lon",
            F.coalesce(text("PlusCode"), text("Description"), text("Name"), F.col("Id")).alias("location_text"),
            F.lit("visually_located").alias("status"),
        ),
        "claims": each.select(F.concat_ws(":", F.lit("claim"), "incident_id", "c.kind", F.col("c.n").cast("string")).alias("id"), "incident_id", "c.kind", "c.value", F.col("quote").alias("evidence_quote"), F.lit("supports").alias("relation")),
        "receipts": j.select(
            F.concat(F.lit("receipt:"), "Id").alias("id"),
            "incident_id",
            F.nullif(F.trim(F.split(F.coalesce("Source", F.lit("")), ",")[0]), F.lit("")).alias("source_url"),
            text("Geolocation").alias("archive_url"),
            F.concat(F.lit("sha256:"), "digest").alias("content_hash"),
            F.col("Date").alias("publication_time"),
            fetched.alias("fetched_at"),
            F.col("quote").alias("evidence_quote"),
        ),
        "runs": j.select(F.concat_ws(":", "digest", F.lit("ukraine"), version.cast("string")).alias("idempotency_key"), fetched.alias("fetched_at"), version.alias("schema_version"), F.lit((interpretation or {}).get("model", "structured-parser")).alias("model")),
    }


#: What names a row of each incident table.
INCIDENT_KEYS = {"incidents": "id", "claims": "id", "receipts": "id", "runs": "idempotency_key"}


def merge_incidents(current: dict[str, DataFrame], new: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables with new rows in place of those of the same key."""
    return {name: current[name].join(new[name].select(key), key, "left_anti").select(*current[name].columns).unionByName(new[name]) for name, key in INCIDENT_KEYS.items()}
