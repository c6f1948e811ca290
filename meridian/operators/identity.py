"""Who a row is: its aliases, the story it belongs to, and what kind of page it is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.functions import hashing
from meridian.functions import text as T
from meridian.operators.tables import chain_ends, stored

#: The fields of a row that name its story, by outlet, the most specific first.
ALIAS_FIELDS = {"reuters": ["id", "content_code"], "bbc": ["asset_id", "id"], "guardian": ["short_url", "id"], "pbs": ["id", "post_id"], "nyt": ["guid"]}
#: Flags by an outlet's own labels.
SUBJECT_FLAGS = {"ANLINS": "analysis", "MKTREP": "market_report", "EXPLN": "explainer", "FBOX": "factbox"}
TYPE_FLAGS = {"video": "video", "audio": "audio", "liveexperience": "live", "photogallery": "gallery", "gallery": "gallery", "podcast": "podcast"}
TONE_FLAGS = {
    "comment": "opinion",
    "letters": "opinion",
    "editorials": "opinion",
    "analysis": "analysis",
    "explainers": "explainer",
    "reviews": "review",
    "obituaries": "obituary",
    "matchreports": "sport_report",
    "minutebyminute": "live",
    "timelines": "roundup",
    "podcast": "podcast",
    "advertisementfeatures": "advertisement",
}
DESIGN_FLAGS = {
    "liveblogdesign": "live",
    "deadblogdesign": "live",
    "videodesign": "video",
    "audiodesign": "audio",
    "gallerydesign": "gallery",
    "picturedesign": "gallery",
    "interactivedesign": "interactive",
    "fullpageinteractivedesign": "interactive",
    "commentdesign": "opinion",
    "letterdesign": "opinion",
    "editorialdesign": "opinion",
    "obituarydesign": "obituary",
    "reviewdesign": "review",
    "explainerdesign": "explainer",
    "timelinedesign": "roundup",
    "profiledesign": "profile",
    "quizdesign": "quiz",
    "newslettersignupdesign": "newsletter",
    "crosswordesign": "quiz",
}
PATH_FLAGS = {
    "/briefing/": "roundup",
    "/opinion/": "opinion",
    "/interactive/": "interactive",
    "/video/": "video",
    "/slideshow/": "gallery",
    "/podcasts/": "podcast",
    "/crosswords/": "quiz",
    "/games/": "quiz",
    "/reviews/": "review",
    "/recipes/": "other_format",
}


def aliases(outlet: Column, fields: dict[str, Column], url: Column) -> Column:
    """All names of a row: the outlet's own ids in their order, then the canonical address; each once."""
    own = F.when(F.lit(False), F.array().cast("array<string>"))
    for name, columns in ALIAS_FIELDS.items():
        own = own.when(outlet == name, F.array(*(T.blank_to_null(fields[c]) for c in columns if c in fields)))
    found = F.concat(F.coalesce(own, F.array().cast("array<string>")), F.array(T.canonical_url(url)))
    return F.array_distinct(F.filter(found, lambda x: x.isNotNull()))


def _label(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, r"[ \-]", ""))


def _flags_of(c: Column, table: dict[str, str]) -> Column:
    lookup = F.create_map(*(F.lit(x) for pair in table.items() for x in pair))
    return F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda x: F.element_at(lookup, x))


def format_flags(outlet: Column, url: Column, labels: Column) -> Column:
    """What kind of page a row is, by its address and the outlet's own labels only, sorted, each once.

    labels: a map of label lists: subjects, types, tones, design, card_types, media, article_type, post_type.
    """
    path = T.url_path(url)
    of = lambda k: F.element_at(labels, F.lit(k))
    lowered = lambda k: F.transform(F.coalesce(of(k), F.array().cast("array<string>")), _label)
    one = lambda when, flag: F.when(when, F.array(F.lit(flag))).otherwise(F.array().cast("array<string>"))
    has = lambda k, f: F.exists(lowered(k), f)
    live = path.contains("/live/") | path.endswith("/live") | path.contains("/live-")
    upper = F.transform(F.coalesce(of("subjects"), F.array().cast("array<string>")), lambda x: F.upper(x))
    by_outlet = {
        "reuters": [
            _flags_of(upper, SUBJECT_FLAGS),
            F.filter(lowered("media"), lambda x: x.isin("video", "gallery")),
            one(has("article_type", lambda x: x.contains("live")), "live"),
        ],
        "bbc": [
            _flags_of(lowered("types"), TYPE_FLAGS),
            one(has("types", lambda x: (x != "") & (x != "article") & ~x.isin(*TYPE_FLAGS)), "other_format"),
            _flags_of(lowered("subtypes"), TYPE_FLAGS),
        ],
        "guardian": [_flags_of(lowered("tones"), TONE_FLAGS), _flags_of(lowered("design"), DESIGN_FLAGS), F.filter(lowered("card_types"), lambda x: x.isin("video", "gallery", "audio"))],
        "pbs": [
            one(has("post_type", lambda x: x == "show") | path.startswith("/newshour/show/"), "broadcast"),
            one(has("post_type", lambda x: ~x.isin("", "post", "show")), "other_format"),
            one(has("video_without_text", lambda x: x == "true"), "video"),
        ],
        "nyt": [one(path.contains(k), v) for k, v in PATH_FLAGS.items()],
    }
    own = F.when(F.lit(False), F.array().cast("array<string>"))
    for name, parts in by_outlet.items():
        own = own.when(outlet == name, F.concat(*parts))
    return F.array_sort(F.array_distinct(F.filter(F.concat(one(live, "live"), F.coalesce(own, F.array().cast("array<string>"))), lambda x: x.isNotNull())))


def owners(rows: DataFrame, known: DataFrame) -> DataFrame:
    """rows(row_id, outlet, aliases, ...) with the story_id that the store has for any alias, the earliest; null if none."""
    named = rows.select("row_id", "outlet", F.explode("aliases").alias("alias"))
    first = named.join(known.select("outlet", "alias", "story_id", "first_seen_at"), ["outlet", "alias"]).groupBy("row_id").agg(F.min(F.struct("first_seen_at", "story_id")).alias("found"))
    return rows.join(first.select("row_id", F.col("found.story_id").alias("known_id")), "row_id", "left")


def assign_stories(rows: DataFrame, known: DataFrame) -> DataFrame:
    """(row_id, outlet, story_id, is_new) of rows(row_id, outlet, aliases, seq), as if saved one by one in order of seq.

    A row joins the earliest story that any of its aliases names, and then owns its aliases that nobody has. So an
    alias never moves, and a later row can bridge two stories without joining them. An alias that the store does not have
    belongs to the first row with it; so a row without an alias in the store takes the story of the earliest first row of any
    of its aliases, and that of its own, as a new one, if that is itself. Such steps lead back to a row that is new or
    known; they are followed by doubling, and nothing walks through the rows of an outlet in order.
    """
    named = rows.select("row_id", "outlet", "aliases", "seq").filter(F.size("aliases") > 0)
    each = named.select("row_id", "outlet", "seq", F.explode(F.array_distinct("aliases")).alias("alias"))
    first = each.groupBy("outlet", "alias").agg(F.min(F.struct("seq", "row_id")).alias("first"))
    old = known.groupBy("outlet", "alias").agg(F.min(F.struct("first_seen_at", "story_id")).alias("old"))
    told = each.join(first.join(old, ["outlet", "alias"], "left"), ["outlet", "alias"])
    by_row = told.groupBy("row_id").agg(F.min("old").alias("old"), F.min("first").alias("first"))
    own = F.coalesce("old.story_id", hashing.story_id("outlet", F.element_at("aliases", 1)))
    step = F.when(F.col("old").isNotNull(), F.col("row_id")).otherwise(F.col("first.row_id"))
    found = stored(named.join(by_row, "row_id").select("row_id", "outlet", own.alias("own"), step.alias("to"), (F.col("old").isNull() & (F.col("first.row_id") == F.col("row_id"))).alias("is_new")))
    ends = chain_ends(found.select(F.col("row_id").alias("node"), "to"))
    stories = found.select(F.col("row_id").alias("to"), F.col("own").alias("story_id"))
    return found.drop("to").join(ends.join(stories, "to").select(F.col("node").alias("row_id"), "story_id"), "row_id").select("row_id", "outlet", "story_id", "is_new")


def known_rows(rows: DataFrame, known: DataFrame, sections: DataFrame) -> DataFrame:
    """rows(row_id, outlet, aliases, section, page) that are stored for their section already."""
    return owners(rows, known).join(sections.select(F.col("story_id").alias("known_id"), "section"), ["known_id", "section"], "left_semi")


def pages_known(rows: DataFrame, known: DataFrame, sections: DataFrame) -> DataFrame:
    """(outlet, section, page, all_known): where reading a listing may stop."""
    marked = rows.join(known_rows(rows, known, sections).select("row_id", F.lit(True).alias("k")), "row_id", "left")
    return marked.groupBy("outlet", "section", "page").agg(F.bool_and(F.coalesce("k", F.lit(False))).alias("all_known"))


def needs_page(rows: DataFrame, stories: DataFrame) -> DataFrame:
    """rows(row_id, known_id, updated) with wanted: is the article's page to be fetched?"""
    stored = stories.select(F.col("story_id").alias("known_id"), F.col("updated").alias("old_updated"), "text_fetched_at", "text_hash", F.lit(True).alias("there"))
    changed = F.col("updated").isNotNull() & ~F.col("updated").eqNullSafe(F.col("old_updated"))
    untried = F.col("text_fetched_at").isNull() & F.col("text_hash").isNull()
    return rows.join(stored, "known_id", "left").withColumn("wanted", F.col("there").isNull() | changed | untried)
