"""String functions as column expressions; a Python UDF only where Spark has no equal (folding, entities, percent escapes)."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Callable
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Zero-width characters that carry no text.
INVISIBLE = "​‌‍⁠﻿"
#: Headline words that tell nothing about an event.
STOP_WORDS = (
    "a an and are as at be by for from has have in is it its of on or that the to was were"
    " with after before says said new latest live update updates"
).split()
MAX_EVIDENCE = 200


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c) -> Column:
    """Trimmed, and null if nothing is left."""
    return F.nullif(F.trim(col(c)), F.lit(""))


def normalise(c) -> Column:
    """White space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(col(c), r"\s+", " "))


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), in which value is worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


#: What may be a character reference, as Python's html.unescape looks for it, behind its ampersand.
REFERENCE = r"^(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


def _decoded(texts: Column) -> Column:
    """An array of strings with HTML character references as characters. Python only sees the different references of a row."""

    @F.pandas_udf("array<string>")
    def meant(s: pd.Series) -> pd.Series:
        return s.map(lambda xs: None if xs is None else [html.unescape("&" + x) for x in xs])

    behind = lambda x: F.filter(F.split(x, "&"), lambda p, i: i > 0)
    reference = lambda p: F.regexp_substr(p, F.lit(REFERENCE))
    some = F.filter(F.flatten(F.transform(F.filter(texts, lambda x: x.contains("&")), lambda x: F.transform(behind(x), reference))), lambda r: r.isNotNull())
    known = F.array_distinct(some)
    told = F.struct(texts.alias("t"), known.alias("r"), meant(known).alias("c"))  # no Python inside of a lambda

    def put(p: Column, told: Column) -> Column:
        whole = F.concat(F.lit("&"), p)
        return let(reference(p), lambda r: F.when(r.isNull(), whole).otherwise(F.concat(F.get(told["c"], F.array_position(told["r"], r).cast("int") - 1), F.substring(p, F.length(r) + 1, F.length(p)))))

    def one(x: Column, told: Column) -> Column:
        parts = lambda t: F.concat(F.get(t, F.lit(0)), F.array_join(F.transform(F.slice(t, F.lit(2), F.size(t)), lambda p: put(p, told)), ""))
        return F.when(x.contains("&"), let(F.split(x, "&"), parts)).otherwise(x)

    return let(told, lambda t: F.when(F.coalesce(F.size(t["r"]), F.lit(0)) <= 0, t["t"]).otherwise(F.transform(t["t"], lambda x: one(x, t))))


def clean_texts(c) -> Column:
    """clean_text of each string of an array."""
    bare = F.transform(col(c), lambda x: F.regexp_replace(x, "<[^>]+>", ""))
    return F.transform(_decoded(bare), lambda x: F.trim(F.regexp_replace(F.translate(x, INVISIBLE, ""), r"[\s\x1c-\x1f\x85\p{Z}]+", " ")))


def clean_text(c) -> Column:
    """Text of a scrap of HTML: no tags, references decoded, no zero-width characters, single spaces for any white space (&nbsp; too)."""
    return F.get(clean_texts(F.array(col(c))), F.lit(0))


def paragraphs(c) -> Column:
    """Paragraphs of an array that hold something, joined by an empty line."""
    return F.array_join(F.filter(F.transform(col(c), lambda x: F.trim(x)), lambda x: x != ""), "\n\n")


def fold_text(value: str) -> str:
    bare = "".join(ch for ch in unicodedata.normalize("NFKD", value.strip().casefold()) if not unicodedata.combining(ch))
    return " ".join(bare.split())


def fold(c) -> Column:
    """Case and accents folded. Plain ASCII stays in the JVM; the rest goes through an Arrow UDF, the same on both sides of a join."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(fold_text, na_action="ignore")

    c = col(c)
    return F.when(c.rlike(r"^[\x20-\x7E]*$"), normalise(F.lower(c))).otherwise(run(c))


def canonical_url(c) -> Column:
    """Scheme and host in lower case, no default port, query, fragment or slash at the end.

    Without a scheme and host the address stays as it is, trimmed; blank is null.
    """
    url = blank_to_null(c)
    part = lambda n: F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*)://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)(?::(\d*))?([^?#]*)", n)
    scheme, host, port = F.lower(part(1)), F.lower(part(2)), F.ltrim(part(3), F.lit("0"))
    default = ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443"))
    shown = F.when((port == "") | default, F.lit("")).otherwise(F.concat(F.lit(":"), port))
    built = F.concat(scheme, F.lit("://"), host, shown, F.regexp_replace(part(4), "/+$", ""))
    return F.when((scheme == "") | (host == ""), url).otherwise(built)


def url_path(c) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(col(c), r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1), F.lit("")))


def url_sections(c) -> Column:
    """The segments of a path up to the first number, without numbers in front and without the slug at the end."""
    path = F.coalesce(F.regexp_extract(col(c), r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1), F.lit(""))
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    inner = F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0)))
    number = lambda x: x.rlike(r"^\d+$")
    first = F.array_position(F.transform(inner, lambda x: ~number(x)), F.lit(True)).cast("int")
    rest = F.slice(inner, F.greatest(first, F.lit(1)), F.size(inner))
    stop = F.array_position(F.transform(rest, number), F.lit(True)).cast("int")
    return F.when(first == 0, F.array().cast("array<string>")).when(stop > 0, F.slice(rest, F.lit(1), stop - 1)).otherwise(rest)


def split_authors(c) -> Column:
    """Names of a byline or of an array of bylines, each once in its first place; a bare "and" is no name."""
    names = F.transform(F.split(col(c), r",\s+and\s+|,|\s+and\s+"), lambda x: F.trim(x))
    return F.array_distinct(F.filter(names, lambda x: (x != "") & (F.lower(x) != "and")))


def comma_list(c) -> Column:
    return F.filter(F.transform(F.split(col(c), ","), lambda x: F.trim(x)), lambda x: x != "")


def largest_srcset(c) -> Column:
    """The address with the greatest width of a srcset; the first of equals."""
    entries = F.transform(
        comma_list(c),
        lambda x, i: F.struct(F.coalesce(F.try_to_number(F.regexp_extract(x, r"\s(\d+)w$", 1), F.lit("999999")).cast("int"), F.lit(0)).alias("w"), (-i).alias("i"), F.split(x, r"\s+")[0].alias("u")),
    )
    return F.array_max(entries)["u"]


def word_count(given, text) -> Column:
    """The count that was given if it is a positive number, else the words of the text; null without either."""
    own = F.when(F.trim(col(given)).rlike(r"^\d+$"), F.trim(col(given)).cast("int"))
    counted = F.when(normalise(text) != "", F.size(F.split(normalise(text), " ")))
    return F.coalesce(F.when(own > 0, own), counted)


def headline_tokens(c) -> Column:
    """Different words of three letters or more that are no stop words."""
    words = F.regexp_extract_all(F.lower(F.coalesce(col(c), F.lit(""))), F.lit("([a-z0-9]+)"), F.lit(1))
    return F.array_distinct(F.filter(words, lambda w: (F.length(w) > 2) & ~w.isin(STOP_WORDS)))


def jaccard(a, b) -> Column:
    """Overlap of two sets of words; 0 if one is empty."""
    a, b = col(a), col(b)
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(both / (F.size(a) + F.size(b) - both))


def at_least(words, least: float) -> Column:
    """How many words a set must share with another to overlap by `least`; a hair is taken off, as 150 * 0.34 is a little over 51 in doubles."""
    return F.ceil(F.size(col(words)) * least - 1e-9).cast("int")


def entity_keys(c) -> Column:
    """Names as compared: trimmed, lower case, each once."""
    return F.array_distinct(F.filter(F.transform(F.coalesce(col(c), F.array().cast("array<string>")), lambda x: F.lower(F.trim(x))), lambda x: x.isNotNull() & (x != "")))


_CREDENTIALS = r"(?i)\b([a-z][a-z0-9+.\-]*://)[^\s/@:]+:[^\s/@]*@"


def redact(c) -> Column:
    """Without the user and password of any address."""
    return F.regexp_replace(col(c), _CREDENTIALS, "$1***:***@")


def redacted(text: str) -> str:
    """redact() of a text that the driver has."""
    return re.sub(_CREDENTIALS, r"\1***:***@", text)


def shorten(c, most: int = 200) -> Column:
    """One line of at most `most` characters, with dots where it was cut."""
    line = normalise(redact(F.coalesce(col(c), F.lit(""))))
    return F.when(F.length(line) <= most, line).otherwise(F.concat(F.substring(line, 1, most - 3), F.lit("...")))


def cut_at_word(c, most: int) -> Column:
    """At most `most` characters, ending with a whole word."""
    c = col(c)
    return F.when(F.length(c) <= most, c).otherwise(F.regexp_replace(F.substring(c, 1, most), r"\s+\S*$", ""))


def found_verbatim(text, quote) -> Column:
    """Is the quote in the text word for word, but for white space?"""
    return F.instr(normalise(text), normalise(quote)) > 0


def trim_evidence(quote, place, most: int = MAX_EVIDENCE) -> Column:
    """At most `most` characters of a quote around the place's name, cut between words, never through the name."""
    has = lambda x, name: F.when(name == "", F.lit(True)).otherwise(F.instr(F.lower(x), name) > 0)

    def around(text: Column, name: Column, start: Column) -> Column:
        room = F.length(text) - most

        def opened(window: Column) -> Column:
            head = F.regexp_extract(window, r"^[^ ]* (.*)$", 1)
            return let(head, lambda head: F.when((start > 0) & window.contains(" ") & (name != "") & has(head, name), head).otherwise(window))

        def closed(window: Column) -> Column:
            tail = F.regexp_extract(window, r"^(.*) [^ ]*$", 1)
            return let(tail, lambda tail: F.when((start < room) & window.contains(" ") & has(tail, name), tail).otherwise(window))

        return F.trim(let(let(F.substring(text, start + 1, F.lit(most)), opened), closed))

    def begun(text: Column, name: Column, at: Column) -> Column:
        return F.when(at > 0, F.least(F.greatest(at - 1 + F.floor(F.length(name) / 2) - most // 2, F.lit(0)), F.length(text) - most)).otherwise(0).cast("int")

    def cut(text: Column, name: Column) -> Column:
        found = F.when(name != "", F.instr(F.lower(text), name)).otherwise(0)
        return let(let(found, lambda at: begun(text, name, at)), lambda start: around(text, name, start))

    name = F.lower(F.trim(F.coalesce(col(place), F.lit(""))))
    return let(normalise(quote), lambda text: F.when(F.length(text) <= most, F.nullif(text, F.lit(""))).otherwise(let(name, lambda name: cut(text, name))))


def wikipedia_title(c) -> Column:
    """The plain title of an English encyclopedia article's address: decoded, without namespace pages and qualifiers."""

    @F.pandas_udf("string")
    def decode(s: pd.Series) -> pd.Series:
        return s.map(unquote, na_action="ignore")

    slug = F.regexp_extract(F.trim(col(c)), r"^https?://en\.wikipedia\.org/wiki/([^#]*)", 1)
    title = F.trim(F.translate(F.when(slug.contains("%"), decode(slug)).otherwise(slug), "_", " "))
    bare = F.trim(F.split(F.regexp_replace(title, r" \([^(]*\)$", ""), ",")[0])
    return F.when((title != "") & ~title.contains(":") & (bare != ""), bare)


def restates(name, area) -> Column:
    """Does the area only repeat the name, to a word's end?"""
    n, a = fold(name), fold(area)
    following = F.substring(a, F.length(n) + 1, F.lit(1))
    return (n != "") & (a != "") & a.startswith(n) & ((following == "") | ~following.rlike(r"[\p{L}\p{N}]"))


def feed_text(headline, summary) -> Column:
    """What stands for the text of a row that has only a headline and a summary."""
    return F.concat_ws(". ", blank_to_null(headline), blank_to_null(summary))


#: A reporter spoken to, and an event that is still to come.
ATTRIBUTION = (
    r"(?i)\b(?:told|tells|spoke to|speaking to|said to|talking to)\s+(?:the\s+)?"
    r"(?:Reuters|BBC|Guardian|PBS|New York Times|NYT|AP|AFP|CNN|reporters|journalists|our correspondent)\b"
)
PLANNED = (
    r"(?i)\b(?:is|are|was|were)\s+(?:scheduled|due|expected|set|slated)\s+to\b"
    r"|\bwill\s+(?:appear|take place|be held|go on trial|face)\b"
    r"|\bplanned for\b|\bplans to\b|\bis to (?:appear|stand trial|be held)\b"
)
DATELINE = r"^\s*[A-Z][A-Z .'\-]{1,40}(?:,[^()\n]{0,60})?\s*\([A-Za-z][\w .&/\-]{0,40}\)\s*(?:--|-|–|—)\s*"


def evidence_failure(quote, name) -> Column:
    """Why a quote that names the place is no evidence of a happening there; null if it may be."""
    q, n = normalise(quote), normalise(name)
    escaped = F.concat(F.lit(r"\Q"), F.regexp_replace(n, r"\\E", r"\\E\\\\E\\Q"), F.lit(r"\E"))
    spoken = F.regexp_like(q, F.concat(F.lit(ATTRIBUTION + r"\s*,?\s*(?:in|at|from|near|outside)\s+"), escaped))
    after = F.regexp_replace(q, DATELINE, "")
    return (
        F.when((q == "") | (n == ""), F.lit(None))
        .when(spoken, F.lit("spoken_to_a_reporter"))
        .when(q.rlike(PLANNED), F.lit("planned"))
        .when(q.rlike(DATELINE) & (F.instr(F.lower(after), F.lower(n)) == 0), F.lit("dateline"))
    )


def event_type(*columns) -> Column:
    """A coarse type by the keywords of some columns; the first rule that holds decides."""
    low = F.lower(F.concat_ws(" ", *(col(c) for c in columns)))
    found = F.when(F.lit(False), F.lit(""))
    for words, kind in EVENT_KEYWORDS:
        for word in words:
            found = found.when(low.contains(word), F.lit(kind))
    return found.otherwise(F.lit("conflict_event"))


#: Keywords of each type, in order.
EVENT_KEYWORDS = [(["drone", "uav"], "drone_strike"), (["missile"], "missile_strike"), (["explosion", "strike", "attack"], "explosive_impact")]
