"""Checks on a model's answer: an answer is corrected rather than thrown away, and what failed is kept beside it."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian import schemas
from meridian.functions import geo, times
from meridian.functions import text as T

ANSWER = (
    "is_physical_event boolean, not_event_reason string, category string, event_date string,"
    " event_place struct<name:string,within:string,country:string,kind:string,quote:string>,"
    " other_places array<string>, key_entities array<string>, cluster_hint string"
)


def schema_failure(raw) -> Column:
    """The first way in which an answer, as text, is not what was asked for; null if it is."""
    v = F.try_parse_json(T.col(raw))
    kind = lambda p: F.regexp_replace(F.schema_of_variant(F.try_variant_get(v, p, "variant")), r"[\(<].*", "")
    text = lambda p: F.when(kind(p) == "STRING", F.try_variant_get(v, p, "string"))
    is_event = F.when(kind("$.is_physical_event") == "BOOLEAN", F.try_variant_get(v, "$.is_physical_event", "boolean"))
    given = lambda p: F.coalesce(~kind(p).isin("VOID"), F.lit(False))
    strings = lambda p: F.coalesce(kind(p) == "ARRAY", F.lit(False)) & F.coalesce(F.schema_of_variant(F.try_variant_get(v, p, "variant")).isin("ARRAY<STRING>", "ARRAY<VOID>"), F.lit(False))
    place = "$.event_place"
    found = F.when(F.coalesce(F.schema_of_variant(v), F.lit("")).startswith("OBJECT"), F.lit(None)).otherwise(F.lit("not_an_object"))
    rules = [
        (is_event.isNull(), "is_physical_event"),
        (~F.coalesce(text("$.category").isin(*schemas.PIN_POSSIBLE), F.lit(False)), "category"),
        (given("$.not_event_reason") & ~F.coalesce(text("$.not_event_reason").isin(*schemas.NOT_EVENT_REASONS), F.lit(False)), "not_event_reason"),
        (times.strict_date(text("$.event_date")).isNull(), "event_date"),
        (is_event & ~F.coalesce(kind(place) == "OBJECT", F.lit(False)), "event_place"),
        *((is_event & (F.coalesce(F.trim(text(f"{place}.{k}")), F.lit("")) == ""), f"event_place.{k}") for k in ("name", "quote", "country", "kind")),
        (is_event & ~F.coalesce(text(f"{place}.kind").isin(*schemas.PLACE_KINDS), F.lit(False)), "event_place.kind"),
        (is_event & ~F.coalesce(F.trim(text(f"{place}.country")).rlike(r"^\p{L}{2}$"), F.lit(False)), "event_place.country"),
        (is_event & given(f"{place}.within") & text(f"{place}.within").isNull(), "event_place.within"),
        (~is_event & given(place) & (F.coalesce(F.to_json(F.try_variant_get(v, place, "variant")), F.lit("{}")) != "{}"), "event_place"),
        (given("$.other_places") & ~strings("$.other_places"), "other_places"),
        (given("$.key_entities") & ~strings("$.key_entities"), "key_entities"),
        (given("$.cluster_hint") & text("$.cluster_hint").isNull(), "cluster_hint"),
    ]
    return F.coalesce(found, *(F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for bad, name in rules))


def quoted(texts: DataFrame, quotes: DataFrame, block_bytes: int = 16 << 20) -> DataFrame:
    """(doc_id, item_id) of texts(doc_id, text) that have the whole of quotes(item_id, text), word for word but for white space.

    The quotes are the short side. They become one automaton, which finds all of them in one pass over a text; if they have more
    bytes than block_bytes, several of them, each with its pass. An empty quote is in no text.
    """
    clean = quotes.select("item_id", T.normalise("text").alias("q")).filter("q <> ''")
    size = clean.agg(F.coalesce(F.sum(F.octet_length("q")), F.lit(0))).first()[0]
    blocks = 1 + size // block_bytes
    rows = texts.select("doc_id", T.normalise("text").alias("text"))
    kinds = dict(texts.dtypes)["doc_id"], dict(quotes.dtypes)["item_id"]

    def found(block: int) -> DataFrame:
        own: dict[str, list] = {}
        for r in clean.filter(F.pmod(F.xxhash64("q"), F.lit(blocks)) == block).collect():  # block_bytes, about
            own.setdefault(r["q"], []).append(r["item_id"])
        sent = texts.sparkSession.sparkContext.broadcast(own)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            import ahocorasick

            automaton = ahocorasick.Automaton()
            for q, ids in sent.value.items():
                automaton.add_word(q, ids)
            automaton.make_automaton()
            for batch in batches:
                out = [(doc, i) for doc, text in zip(batch["doc_id"], batch["text"], strict=True) if text for i in {i for _, ids in automaton.iter(text) for i in ids}]
                yield pd.DataFrame(out, columns=["doc_id", "item_id"])

        return rows.mapInPandas(run, f"doc_id {kinds[0]}, item_id {kinds[1]}") if own else rows.limit(0).select("doc_id", F.lit(None).cast(kinds[1]).alias("item_id"))

    return reduce(DataFrame.unionByName, map(found, range(blocks)))


def quote_failure(text, quote, name) -> Column:
    q, n, whole = T.normalise(quote), T.normalise(name), T.normalise(text)
    return (
        F.when(F.coalesce(q, F.lit("")) == "", F.lit("quote_empty"))
        .when(F.coalesce(whole, F.lit("")) == "", F.lit("no_text"))
        .when(F.instr(whole, q) == 0, F.lit("quote_not_in_text"))
        .when(F.instr(F.lower(q), F.lower(F.coalesce(n, F.lit("")))) == 0, F.lit("name_not_in_quote"))
    )


def date_failure(event_date, published) -> Column:
    day = times.strict_date(event_date)
    inside = F.coalesce(times.date_in_window(day, published), F.lit(True))
    return F.when(day.isNull(), F.lit("no_date")).when(~inside, F.lit("date_outside_window"))


def format_failure(flags, text) -> Column:
    return F.when(F.size(F.coalesce(T.col(flags), F.array().cast("array<string>"))) > 0, F.concat(F.lit("flagged: "), F.array_join(T.col(flags), ", "))).when(
        F.coalesce(F.trim(T.col(text)), F.lit("")) == "", F.lit("no_article_text")
    )


def apply_checks(answers: DataFrame) -> DataFrame:
    """answers(story_id, answer struct of ANSWER, text, published, format_flags) with the answer as it is to be stored,
    failure (the first check that failed) and checks (what each said).

    A page of a kind that is no report, a quote that is not in the text, one that is no evidence, or a date outside the
    window turns the answer into no happening, with its reason; the category stays.
    """
    a = F.col("answer")
    event = F.coalesce(a["is_physical_event"], F.lit(False))
    j = answers.withColumns({
        "c_format": format_failure("format_flags", "text"),
        "c_quote": quote_failure("text", a["event_place"]["quote"], a["event_place"]["name"]),
        "c_evidence": T.evidence_failure(a["event_place"]["quote"], a["event_place"]["name"]),
        "c_date": date_failure(a["event_date"], "published"),
    })
    evidence = F.when(F.col("c_quote").isNull(), F.col("c_evidence"))
    failure = F.when(event, F.coalesce("c_format", "c_quote", evidence, "c_date"))
    told = lambda c: F.coalesce(F.concat(F.lit("failed: "), c), F.lit("passed"))
    overridden = event & F.col("c_format").isNotNull()
    quote_says = F.when(~event, F.lit("not applicable: no happening")).when(overridden, F.lit("not applicable: overridden")).otherwise(told(F.col("c_quote")))
    evidence_says = F.when(event & ~overridden, F.when(F.col("c_quote").isNotNull(), F.lit("not applicable: quote failed")).otherwise(told(F.col("c_evidence"))))
    date_says = F.when(overridden, F.lit("not applicable: overridden")).otherwise(told(F.col("c_date")))
    checks = F.map_filter(
        F.create_map(F.lit("schema"), F.lit("passed"), F.lit("country_veto"), F.lit("skipped"), F.lit("format"), told(F.col("c_format")), F.lit("quote"), quote_says, F.lit("evidence"), evidence_says, F.lit("date"), date_says),
        lambda _, v: v.isNotNull(),
    )
    changed = (
        a.withField("is_physical_event", F.lit(False))
        .withField("not_event_reason", F.coalesce(F.nullif(a["not_event_reason"], F.lit("")), F.lit("other")))
        .withField("event_place", F.lit(None).cast("struct<name:string,within:string,country:string,kind:string,quote:string>"))
    )
    j = j.withColumns({"failure": failure, "checks": checks})
    return j.withColumn("answer", F.when(F.col("failure").isNull(), a).otherwise(changed)).drop("c_format", "c_quote", "c_evidence", "c_date")


# ---- a second look -------------------------------------------------------------------------------------------

POINTS = ["happened", "event_place", "map_place", "precision"]
MAX_ATTEMPTS = 2
#: Outcomes by the second reader's decision; those that pass; those that are final.
DECISIONS = {"keep": "kept", "drop": "dropped", "unsure": "unsure"}
PASSING = ["verified", "kept"]
FINAL = ["verified", "kept", "dropped", "unsure"]


def disputed(verdicts, acceptable) -> Column:
    """Points of a map of verdicts that do not agree, and the category if none of the acceptable ones can be drawn."""
    points = F.filter(F.array(*(F.lit(p) for p in POINTS)), lambda p: F.lower(F.trim(F.coalesce(F.element_at(T.col(verdicts), p), F.lit("")))) != "agree")
    known = F.coalesce(T.col(acceptable), F.array().cast("array<string>"))
    bad = (F.size(known) > 0) & ~F.exists(known, geo.can_pin)
    return F.concat(points, F.when(bad, F.array(F.lit("category"))).otherwise(F.array().cast("array<string>")))


def outcome(points, decision) -> Column:
    return F.when(F.size(T.col(points)) == 0, F.lit("verified")).when(T.col(decision).isNull(), F.lit("not_run")).otherwise(geo.mapped(decision, DECISIONS))


def needs_check(candidates: DataFrame, verifications: DataFrame) -> DataFrame:
    """Candidates(story_id, input_hash, ...) without a final verdict on just this input and with tries left."""
    old = verifications.select("story_id", F.col("input_hash").alias("old_hash"), "outcome", "attempts")
    j = candidates.join(old, "story_id", "left")
    same = F.coalesce(F.col("old_hash") == F.col("input_hash"), F.lit(False))
    done = F.coalesce(F.col("outcome").isin(FINAL), F.lit(False)) | (F.coalesce("attempts", F.lit(0)) >= MAX_ATTEMPTS)
    return j.filter(~(same & done)).select(*candidates.columns)


def gate(candidates: DataFrame, verifications: DataFrame) -> DataFrame:
    """Candidates whose verdict passes, on the same place and for the same input."""
    good = verifications.filter(F.col("outcome").isin(PASSING)).select("story_id", "geonames_id", "input_hash")
    return candidates.join(good, ["story_id", "geonames_id", "input_hash"], "left_semi")


def headline_candidates(rows: DataFrame, places: DataFrame) -> DataFrame:
    """One row for each address, the newest that has a place: rows(story_id, url, category, first_seen_at, ...) and
    places(story_id, ...) of those that may be drawn."""
    from pyspark.sql import Window

    ok = rows.filter(F.col("url").rlike("^https?://") & geo.can_pin("category")).join(places, "story_id")
    rank = F.row_number().over(Window.partitionBy("url").orderBy(F.col("first_seen_at").desc(), "story_id"))
    return ok.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")
