"""Messages for a model about a story or a pair of them, as columns, and the hash that ties an answer to its message."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.functions import text as T

MOST_TEXT = 12_000


def _line(label: str, value: Column) -> Column:
    return F.when(F.coalesce(F.trim(value), F.lit("")) != "", F.concat(F.lit(f"{label}: "), T.normalise(value)))


def story_message() -> Column:
    """Outlet, time, headline, summary, labels and text of a row of stories ⟕ texts; what is missing is left out."""
    return F.concat_ws(
        "\n",
        _line("Outlet", F.col("outlet")),
        _line("Published", F.col("published").cast("string")),
        _line("Headline", F.col("headline")),
        _line("Summary", F.col("description")),
        _line("Labels", F.array_join("outlet_tags", ", ")),
        F.when(F.coalesce("text", F.lit("")) != "", F.concat(F.lit("\n"), T.cut_at_word("text", MOST_TEXT))),
    )


def pair_message(a: str, b: str) -> Column:
    """Two stories, structs named a and b with outlet, published, headline, hint, place and event_date, one under the other."""
    block = lambda s, n: F.concat_ws(
        "\n", F.lit(f"Story {n}"), _line("Outlet", F.col(f"{s}.outlet")), _line("Published", F.col(f"{s}.published").cast("string")),
        _line("Headline", F.col(f"{s}.headline")), _line("What happened", F.col(f"{s}.hint")), _line("Where", F.col(f"{s}.place")), _line("When", F.col(f"{s}.event_date").cast("string")),
    )
    return F.concat_ws("\n\n", block(a, 1), block(b, 2))


def pin_claim(category, place, precision, quote) -> Column:
    """What a pin says, as a sentence that a checker can agree with or not."""
    return F.concat_ws(" ", F.concat(F.lit("A "), T.col(category), F.lit(" event happened at")), F.concat(T.col(place), F.lit(",")), F.concat(F.lit("shown as a "), T.col(precision), F.lit(".")), F.concat(F.lit("Quote: "), T.normalise(quote)))


def with_input_hash(rows: DataFrame, message: str) -> DataFrame:
    """rows with input_hash over the exact message: another message is another question."""
    return rows.withColumn("input_hash", F.substring(F.sha2(F.col(message), 256), 1, 32))


def unread(stories: DataFrame, extractions: DataFrame, config_hash: str, status: str, n: int) -> DataFrame:
    """The newest stories of a status that were not read under these settings."""
    from meridian.operators.merge import newest_first

    done = extractions.filter(F.col("config_hash") == config_hash).select("story_id")
    return newest_first(stories.filter(F.col("status") == status).join(done, "story_id", "left_anti"), n)


def unread_feed(stories: DataFrame, extractions: DataFrame, config_hash: str, since: Column, now: Column, n: int) -> DataFrame:
    """The newest rows of feeds with a headline, seen since a time and free to take, that were not read under these settings."""
    from meridian.operators.merge import claimable, newest_first

    fresh = claimable(stories, "feed", now).filter((F.col("first_seen_at") >= since) & F.col("headline").isNotNull())
    done = extractions.filter(F.col("config_hash") == config_hash).select("story_id")
    return newest_first(fresh.join(done, "story_id", "left_anti"), n)


def read_under_other_settings(stories: DataFrame, extractions: DataFrame, config_hash: str, since: Column) -> DataFrame:
    """Recent stories that were read, but under other settings only: a sign that settings changed by mistake."""
    recent = stories.filter(F.col("first_seen_at") >= since)
    other = extractions.filter(F.col("config_hash") != config_hash).select("story_id")
    current = extractions.filter(F.col("config_hash") == config_hash).select("story_id")
    return recent.join(other, "story_id", "left_semi").join(current, "story_id", "left_anti")


def unresolved(extractions: DataFrame, resolutions: DataFrame, extract_hash: str, resolve_hash: str, n: int) -> DataFrame:
    """The newest happenings with a place that were not looked up for this reading under these settings."""
    happened = extractions.filter((F.col("config_hash") == extract_hash) & F.coalesce("accepted", F.lit(True)) & F.col("is_physical_event") & (F.coalesce("place_name", F.lit("")) != ""))
    done = resolutions.filter((F.col("config_hash") == resolve_hash) & (F.col("extract_hash") == extract_hash)).select("story_id")
    return happened.join(done, "story_id", "left_anti").orderBy(F.desc("created_at"), "story_id").limit(n)


def first_sections(sections: DataFrame) -> DataFrame:
    """(story_id, section): where each story was first seen; the first by name of those of one time."""
    return sections.groupBy("story_id").agg(F.min(F.struct("first_seen_at", "section")).getField("section").alias("section"))


def outlet_tags(categories, fields: list[str]) -> Column:
    """An outlet's own labels, from some lists of a map of lists, each once in its first place."""
    lists = [F.coalesce(F.element_at(T.col(categories), f), F.array().cast("array<string>")) for f in fields]
    return F.array_distinct(F.filter(F.transform(F.concat(*lists), lambda x: F.trim(x)), lambda x: x != ""))
