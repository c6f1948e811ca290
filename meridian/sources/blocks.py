"""Article pages that carry their text as JSON: trees of blocks, or a wire's content object.

Everything is an expression over VARIANT values within the page's own row: trees are opened level by level with higher-order
functions, as deep as the page goes, and the body is what position rules leave of the flat list. A broken page, or one that is
nested deeper than the JSON reader takes (about 1000 levels), gives nulls and never fails.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.functions import jsons, times
from meridian.functions import text as T
from meridian.sources.pages import parsed


def _list(value: Column, path: str) -> Column:
    """The array at a path; anything else is empty."""
    return F.coalesce(F.try_variant_get(value, path, "array<variant>"), F.try_variant_get(F.parse_json(F.lit("[]")), "$", "array<variant>"))


def _text(value: Column, path: str) -> Column:
    """The string at a path; a number, a list or an object there is none."""
    at = F.try_variant_get(value, path, "variant")
    return F.when(F.schema_of_variant(at) == "STRING", F.try_variant_get(at, "$", "string"))


def _is(value: Column, *kinds: str) -> Column:
    return F.coalesce(_text(value, "$.type").isin(*kinds), F.lit(False))


def _clean(value: Column) -> Column:
    return F.nullif(T.clean_text(value), F.lit(""))


def _truth(value: Column, path: str, wanted: bool) -> Column:
    at = F.try_variant_get(value, path, "variant")
    return F.coalesce((F.schema_of_variant(at) == "BOOLEAN") & (F.try_variant_get(at, "$", "boolean") == wanted), F.lit(False))


def _inner(block: Column) -> Column:
    return _list(block, "$.model.blocks")


def first_paragraph(block: Column) -> Column:
    """Text of the first paragraph in a block or anywhere below it."""
    found = jsons.opened(F.array(block), lambda b: _is(b, "paragraph"), _inner, jsons.keys_in(block, "blocks") + 1)
    texts = F.transform(found, lambda p: _text(p, "$.model.text"))
    return F.get(F.filter(texts, lambda x: x.isNotNull()), F.lit(0))


def style_of(paragraph: Column) -> Column:
    """link: all that shows is links; italic: all its letters lean, those within links too, and links within these; else plain."""
    said = lambda b: F.coalesce(_text(b, "$.model.text").rlike(r"\S"), F.lit(False))
    leans = lambda b: F.coalesce(F.array_contains(F.try_variant_get(b, "$.model.attributes", "array<string>"), "italic"), F.lit(False))
    is_link = lambda b: _is(b, "urlLink")

    def of(own: Column) -> Column:
        most = F.when(F.exists(own, is_link), jsons.keys_in(paragraph, "blocks")).otherwise(F.lit(0))
        letters = F.filter(jsons.opened(own, lambda b: ~is_link(b), _inner, most), lambda b: said(b) & _is(b, "fragment"))
        links = T.let(F.filter(own, said), lambda shown: (F.size(shown) > 0) & F.forall(shown, is_link))
        italic = T.let(letters, lambda all_of: (F.size(all_of) > 0) & F.forall(all_of, leans))
        return F.when(links, F.lit("link")).when(italic, F.lit("italic")).otherwise(F.lit("plain"))

    return T.let(_inner(paragraph), of)


def entries(contents: Column) -> Column:
    """(style, text, aside) of all that a page's contents say, in order; asides are marked as unfit for a shorter text.

    Styles are those of paragraphs, and head; a block of links is an entry without text, stop.
    """
    entry = lambda style, text, aside: F.struct(style.alias("style"), text.alias("text"), aside.alias("aside"))
    no = F.lit(False)

    def of(block: Column) -> Column:
        direct = F.transform(
            _list(block, "$.model.blocks"),
            lambda b: F.when(_is(b, "paragraph"), F.array(b)).when(_is(b, "unorderedList", "orderedList"), F.flatten(F.transform(_list(b, "$.model.blocks"), lambda item: _list(item, "$.model.blocks")))),
        )
        said = F.filter(F.flatten(F.filter(direct, lambda x: x.isNotNull())), lambda b: _is(b, "paragraph"))
        aside = _truth(block, "$.model.suitableForAbridgement", False)
        return (
            F.when(_is(block, "text"), F.transform(said, lambda p: entry(style_of(p), _text(p, "$.model.text"), aside)))
            .when(_is(block, "subheadline", "crosshead"), F.array(entry(F.lit("head"), first_paragraph(block), no)))
            .when(_is(block, "links"), F.array(entry(F.lit("stop"), F.lit(""), no)))
        )

    return F.flatten(F.filter(F.transform(contents, of), lambda x: x.isNotNull()))


def body(found: Column) -> Column:
    """The text of cleaned entries.

    It ends with the last plain paragraph that is no aside, or if all are, the last plain one. Of what follows, paragraphs that
    are no asides belong to it too, up to a block of links: notes and corrections do, promotions don't.
    """
    def of(found: Column) -> Column:
        last = lambda wanted: F.array_max(F.transform(found, lambda e, i: F.when(wanted(e), i + 1)))
        stop = lambda end: F.coalesce(F.array_min(F.transform(found, lambda e, i: F.when((i >= end) & (e["style"] == "stop"), i))), F.size(found))
        ends = F.coalesce(last(lambda e: (e["style"] == "plain") & ~e["aside"]), last(lambda e: e["style"] == "plain"), F.lit(0))
        inside = lambda e, i, end: (i < end) & e["style"].isin("plain", "italic", "head")
        after = lambda e, i, end, stop: (i >= end) & (i < stop) & e["style"].isin("plain", "italic") & ~e["aside"]
        kept = lambda end, stop: F.filter(found, lambda e, i: inside(e, i, end) | after(e, i, end, stop))
        return T.let(ends, lambda end: T.let(stop(end), lambda stop: F.array_join(F.transform(kept(end, stop), lambda e: e["text"]), "\n\n")))

    # what each entry is held against is worked out once a page: within a lambda it would be for each entry
    return F.nullif(T.let(found, of), F.lit(""))


def scripts(html: Column, kind: str) -> Column:
    """What scripts of a type hold."""
    return F.regexp_extract_all(html, F.lit(rf'(?s)<script[^>]*type="{kind}"[^>]*>(.*?)</script>'), F.lit(1))


def linked_authors(html: Column) -> Column:
    """Names of the authors that a page's JSON-LD documents describe."""
    documents = F.filter(F.transform(scripts(html, r"application/ld\+json"), F.try_parse_json), lambda v: v.isNotNull())
    each = lambda v: F.when(F.schema_of_variant(F.try_variant_get(v, "$.author", "variant")).startswith("ARRAY"), _list(v, "$.author")).otherwise(F.array(F.try_variant_get(v, "$.author", "variant")))
    names = T.clean_texts(F.transform(F.flatten(F.transform(documents, each)), lambda a: _text(a, "$.name")))
    return F.filter(names, lambda x: F.coalesce(x, F.lit("")) != "")


def block_pages(pages: DataFrame, html: str) -> DataFrame:
    """pages with the text, labels and fields of pages that carry their blocks in a __NEXT_DATA__ script; nulls for others."""
    page = F.col(html)
    raw = F.nullif(F.regexp_extract(page, r'(?s)<script[^>]*id="__NEXT_DATA__"[^>]*>(.*?)</script>', 1), F.lit(""))
    whole = F.get_json_object(raw, "$.props.pageProps")
    held = F.get(F.map_values(F.from_json(F.get_json_object(whole, "$.page"), "map<string,string>")), F.lit(0))
    read = pages.withColumns({"_props": F.try_parse_json(whole), "_page": F.try_parse_json(held)})
    read = read.withColumn("_page", F.when(F.schema_of_variant("_page").startswith("OBJECT"), F.col("_page")))
    contents = _list(F.col("_page"), "$.contents")
    read = read.withColumn("_said", F.when(F.col("_page").isNotNull(), entries(contents)))
    clean = T.clean_texts(F.transform("_said", lambda e: e["text"]))
    # side by side, not looked up in a lambda: there the cleaning would be put in and all of a page be cleaned for each entry
    read = read.withColumn("_said", F.zip_with("_said", clean, lambda e, x: F.struct(e["style"].alias("style"), F.coalesce(x, F.lit("")).alias("text"), e["aside"].alias("aside"))))
    read = read.withColumn("text", body(F.filter("_said", lambda e: (e["text"] != "") | (e["style"] == "stop"))))

    props, own = F.col("_props"), F.col("_page")
    titled = lambda path: F.filter(_list(own, path), lambda x: F.coalesce(_text(x, "$.title"), F.lit("")) != "")
    parts = lambda c: _list(c, "$.model.blocks")
    last = lambda c, kind: F.try_element_at(F.filter(parts(c), lambda p: _is(p, kind)), F.lit(-1))
    named = F.filter(F.flatten(F.transform(F.filter(contents, lambda b: _is(b, "byline")), parts)), lambda b: _is(b, "contributor"))
    roles = ("name", "role", "location")
    said = lambda kind: F.transform(named, lambda c: first_paragraph(last(c, kind)))
    read = read.withColumns({f"_{k}": T.clean_texts(said(k)) for k in roles})
    people = F.transform(F.arrays_zip(*(f"_{k}" for k in roles)), lambda x: F.struct(*(F.nullif(x[f"_{k}"], F.lit("")).alias(k) for k in roles)))
    none = F.lit(None).cast("string")
    linked = F.transform(linked_authors(page), lambda x: F.struct(x.alias("name"), none.alias("role"), none.alias("location")))
    written = F.filter(people, lambda p: p["name"].isNotNull())
    read = read.withColumn("authors", F.when(own.isNotNull(), F.when(F.size(written) > 0, written).otherwise(linked)))

    meta = lambda path: _text(props, f"$.metadata.{path}")
    moment = lambda path: times.iso_from_millis(F.try_variant_get(props, f"$.metadata.{path}", "bigint"))
    image = F.get(F.filter(_list(props, "$.metadata.indexImage.blocks"), lambda b: _is(b, "rawImage")), F.lit(0))
    version = F.get(F.filter(_list(props, "$.metadata.videoMetadata.versions"), lambda b: F.schema_of_variant(b).startswith("OBJECT")), F.lit(0))
    number = lambda value, path: F.try_variant_get(value, path, "bigint")
    fields = {
        "topics": F.transform(titled("$.topics"), lambda x: F.struct(_text(x, "$.title").alias("title"), F.try_variant_get(x, "$.id", "string").alias("id"), _text(x, "$.url").alias("url"), F.try_variant_get(x, "$.isEvent", "boolean").alias("is_event"))),
        "page_section": F.transform(titled("$.section"), lambda x: F.struct(_text(x, "$.title").alias("title"), _text(x, "$.url").alias("url"))),
        "pillar": F.transform(F.filter(_list(props, "$.metadata.pillar"), lambda x: F.coalesce(_text(x, "$.title"), F.lit("")) != ""), lambda x: _text(x, "$.title")),
        "author": F.coalesce(_clean(meta("contributors")), F.get("authors", F.lit(0))["name"]),
        "published": moment("firstPublished"),
        "updated": F.coalesce(moment("lastUpdated"), moment("lastPublished")),
        "word_count": F.when(F.col("text").isNotNull(), F.size(F.split(T.normalise("text"), " "))),
        "page_first_published": moment("firstPublished"),
        "page_last_published": moment("lastPublished"),
        "page_last_updated": moment("lastUpdated"),
        "stated_word_count": number(props, "$.metadata.wordCount"),
        "content_id": _text(props, "$.analytics.contentId"),
        "language": _text(props, "$.analytics.language"),
        "producer": _text(props, "$.analytics.producer"),
        "page_type": _text(props, "$.type"),
        "page_subtype": _text(props, "$.subtype"),
        "seo_headline": _clean(meta("seoHeadline")),
        "promo_headline": _clean(meta("promoHeadline")),
        "page_description": _clean(meta("description")),
        "image_original": meta("indexImage.originalSrc"),
        "image_copyright": _text(image, "$.model.copyrightHolder"),
        "video_pid": meta("videoMetadata.id"),
        "video_duration_seconds": number(version, "$.duration"),
    }
    out = read.withColumns({k: F.when(own.isNotNull(), v) for k, v in fields.items()})
    return out.drop("_props", "_page", "_said", *(f"_{k}" for k in roles))


# ---- a wire's content object -----------------------------------------------------------------------------------

#: The kinds of elements of a content object that are text.
TEXT_KINDS = ("text", "paragraph", "subhead", "header")


def _first(value: Column, *paths: str) -> Column:
    """The first path that holds something: no empty text, list, or null."""
    at = lambda p: F.try_variant_get(value, p, "variant")
    filled = lambda v: ~F.coalesce(F.try_variant_get(v, "$", "string"), F.lit("")).isin("", "[]", "{}")
    return F.coalesce(*(F.when(filled(at(p)), at(p)) for p in paths))


def _lines(text: Column) -> Column:
    return F.split(text, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]")


def content_parts(value: Column) -> Column:
    """The paragraphs, not yet cleaned, of a content object: its elements, or the lines of its body or text."""
    content = _first(value, "$.content_elements", "$.body", "$.text")
    pieces = F.filter(F.try_variant_get(content, "$", "array<variant>"), lambda e: F.schema_of_variant(e).startswith("OBJECT") & F.coalesce(_text(e, "$.type"), F.lit("text")).isin(*TEXT_KINDS))
    return F.when(F.schema_of_variant(content) == "STRING", _lines(F.try_variant_get(content, "$", "string"))).otherwise(F.transform(pieces, lambda e: jsons.text_of(_first(e, "$.content", "$.text"))))


def marked_paragraphs(html) -> Column:
    """Texts of the elements whose data-testid says that they are a paragraph."""

    @F.pandas_udf("array<string>")
    def run(s: pd.Series) -> pd.Series:
        def outer(root):
            todo = [*reversed(root.children)]
            while todo:
                node = todo.pop()
                if isinstance(node, str):
                    continue
                if node.attrs.get("data-testid", "").startswith("paragraph-"):
                    yield node.raw()
                else:
                    todo += reversed(node.children)

        return s.map(lambda x: list(outer(parsed(x))))

    return run(T.col(html))


def content_pages(pages: DataFrame, html: str, agency: str) -> DataFrame:
    """pages with text, topics, subjects, sections, keywords and place of a wire's article pages.

    The text is that of the content object in a script, else of a JSON-LD document (a live blog's posts each with headline
    and body), else of the marked paragraphs. agency is the wire's name: a place that has it in parentheses is only a date.
    """
    page = F.col(html)
    held = F.regexp_extract_all(page, F.lit(r"(?s)<script[^>]*>(?:(?!</script>).)*?Fusion\.globalContent\s*=\s*((?:(?!</script>).)*)</script>"), F.lit(1))
    results = F.filter(F.transform(held, lambda x: F.try_parse_json(F.get_json_object(x, "$.result"))), lambda v: F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False)))
    documents = F.filter(F.transform(scripts(page, r"application/ld\+json"), F.try_parse_json), lambda v: v.isNotNull())
    objects = F.filter(F.flatten(F.transform(documents, lambda v: F.when(F.schema_of_variant(v).startswith("ARRAY"), _list(v, "$")).otherwise(F.array(v)))), lambda v: F.schema_of_variant(v).startswith("OBJECT"))

    def of_document(v: Column) -> Column:
        posts = F.flatten(F.transform(_list(v, "$.liveBlogUpdate"), lambda p: F.flatten(F.array(*(F.coalesce(_lines(_text(p, k)), F.array().cast("array<string>")) for k in ("$.headline", "$.articleBody"))))))
        whole = F.try_variant_get(_first(v, "$.articleBody"), "$", "string")
        return F.when(whole.isNotNull(), _lines(whole)).when(F.coalesce(_text(v, "$['@type']") == "LiveBlogPosting", F.lit(False)), posts)

    filled = lambda lists: F.filter(lists, lambda xs: F.exists(xs, lambda x: F.coalesce(x.rlike(r"\S"), F.lit(False))))
    found = F.coalesce(F.get(filled(F.transform(results, content_parts)), F.lit(0)), F.get(filled(F.transform(objects, of_document)), F.lit(0)), marked_paragraphs(html))
    read = pages.withColumns({"_results": results, "_parts": T.clean_texts(found)})
    own = F.get(F.filter("_results", lambda v: F.coalesce(F.schema_of_variant(F.try_variant_get(v, "$.taxonomy", "variant")).startswith("OBJECT"), F.lit(False))), F.lit(0))
    read = read.withColumn("_own", own)
    label, mine = (lambda path: _list(F.col("_own"), path)), F.col("_own")
    filled_text = lambda x, path: F.coalesce(_text(x, path), F.lit("")) != ""
    place = _text(mine, "$.additional_properties.article_properties.place")
    fields = {
        "text": F.nullif(F.array_join(F.filter("_parts", lambda x: F.coalesce(x, F.lit("")) != ""), "\n\n"), F.lit("")),
        "topics": F.transform(F.filter(label("$.taxonomy.tags"), lambda x: _truth(x, "$.is_topic", True) & filled_text(x, "$.short_bio")), lambda x: _text(x, "$.short_bio")),
        "subjects": F.transform(F.filter(label("$.taxonomy.n2"), lambda x: filled_text(x, "$.code")), lambda x: F.struct(_text(x, "$.code").alias("code"), _text(x, "$.name").alias("name"))),
        "sections": F.transform(F.filter(label("$.taxonomy.other_sections"), lambda x: filled_text(x, "$.name")), lambda x: _text(x, "$.name")),
        "keywords": F.filter(F.transform(label("$.taxonomy.keywords"), lambda x: _text(x, "$")), lambda x: x.isNotNull()),
        "place": F.when(~place.contains(f"({agency})") & (place != ""), place),
    }
    out = read.withColumns({k: v if k == "text" else F.when(mine.isNotNull(), v) for k, v in fields.items()})
    return out.drop("_results", "_parts", "_own")


def listing_labels(article: Column) -> Column:
    """(section, primary_topic, ad_topics) of a VARIANT article of a section's listing; each ad topic once."""
    words = lambda path: F.filter(F.transform(_list(article, path), lambda x: _text(x, "$")), lambda x: x.isNotNull())
    topic = F.coalesce(*(F.nullif(_text(article, f"$.primary_tag.{k}"), F.lit("")) for k in ("short_bio", "text")))
    return F.struct(words("$.kicker.names").alias("section"), topic.alias("primary_topic"), F.array_distinct(words("$.ad_topics")).alias("ad_topics"))
