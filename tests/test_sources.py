import json

from pyspark.sql import functions as F

from meridian.sources import blocks, feeds, files, pages

RSS2 = """<?xml version="1.0"?><rss version="2.0" xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:media="http://search.yahoo.com/mrss/" xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel><title>Chan</title>
<item><title>One</title><link>https://x.org/world/one</link><guid isPermaLink="false">g1</guid><pubDate>Thu, 05 Nov 2026 09:00:00 GMT</pubDate><description><![CDATA[<p>A &amp; B</p>]]></description>
<dc:creator>Ann Lee and Bo Ek</dc:creator><category domain="d">News</category><category> </category><media:content url="https://x.org/1.jpg" width="9"><media:credit>Cy</media:credit></media:content></item>
<item><title>Two</title><guid>https://x.org/world/two</guid><dc:creator>Reuters</dc:creator></item>
<item><title>Three</title><pubDate>sometime</pubDate></item></channel></rss>"""
RDF = """<?xml version="1.0"?><rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns="http://purl.org/rss/1.0/" xmlns:dc="http://purl.org/dc/elements/1.1/">
<item rdf:about="u"><title>Four</title><link>https://y.org/four</link><dc:date>2026-11-05T10:00:00Z</dc:date></item></rdf:RDF>"""
ATOM = """<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom"><entry><id>urn:5</id><title type="xhtml"><div xmlns="http://www.w3.org/1999/xhtml">Five</div></title><link rel="self" href="https://z.org/self"/><link href="https://z.org/five"/>
<updated>2026-11-05T11:00:00Z</updated><content type="html">&lt;b&gt;text&lt;/b&gt; more</content><author><name>Di</name></author><category term="t" scheme="s"/></entry></feed>"""


def test_three_dialects_one_shape(spark, tmp_path):
    for name, text in (("a.xml", RSS2), ("b.xml", RDF), ("c.xml", ATOM)):
        (tmp_path / name).write_text(text)
    items = feeds.read_feeds(spark, str(tmp_path))
    got = {r.title: r for r in items.collect()}
    assert set(got) == {"One", "Two", "Three", "Four", "Five"}
    one, two, three, four, five = (got[k] for k in ("One", "Two", "Three", "Four", "Five"))
    assert (one.link, one.guid, one.published, one.description) == ("https://x.org/world/one", "g1", "2026-11-05T09:00:00Z", "A & B")
    assert one.creators == ["Ann Lee and Bo Ek"] and [tuple(c) for c in one.categories] == [("d", "News")] and one.media[0].url == "https://x.org/1.jpg" and one.media_credit == "Cy"
    assert two.link == "https://x.org/world/two" and three.link is None and three.published == "sometime"
    assert (four.link, four.published) == ("https://y.org/four", "2026-11-05T10:00:00Z")
    assert (five.link, five.guid, five.published, five.description, five.creators) == ("https://z.org/five", "urn:5", "2026-11-05T11:00:00Z", "text more", ["Di"])
    rows = feeds.base_rows(items.withColumns({"slug": F.lit("kyivpost"), "x": F.lit(1)}), spark.createDataFrame([("kyivpost", "K", "https://k/feed")], "slug string, name string, url string"))
    base = {r.headline: r for r in rows.collect()}
    assert set(base) == {"One", "Four", "Five"}  # a wire's item and one without any address are none
    assert base["One"].authors == ["Ann Lee", "Bo Ek"] and base["One"].categories["section"] == ["world"] and base["One"].thumbnail == "https://x.org/1.jpg" and base["One"].id == "g1"


def test_third_party_rules(spark):
    kind = "slug string, creators array<string>, categories array<struct<domain:string,name:string>>, link string, description string, content string"
    rows = [
        ("kyivpost", ["AFP"], [], None, "", None, True),
        ("kyivpost", ["An Author"], [], None, "by AFP", None, False),
        ("cheknews", ["Jo, The Canadian Press"], [], None, "", None, True),
        ("businessworld", [], [(None, " Reuters ")], None, "", None, True),
        ("mailguardian", [], [], "https://m/partner-content/x", "", None, True),
        ("taiwantoday", [], [], None, "news", "Write to Taiwan Today at", False),
        ("taiwantoday", [], [], None, "news", None, True),
        ("vanguard", [], [], None, "x", "said (NAN)", True),
        ("unlisted", ["Reuters"], [], None, "", None, False),
        ("kyivpost", ["The Associated Press"], [], None, "", None, False),
        ("courthousenews", ["The Associated Press"], [], None, "", None, True),
        (None, None, None, None, None, None, False),
    ]
    df = spark.createDataFrame([r[:6] for r in rows], kind)
    assert [r.x for r in df.select(feeds.third_party("slug").alias("x")).collect()] == [r[6] for r in rows]


def test_jobs_and_pages(spark, tmp_path):
    assert feeds.build_jobs(["g", "a"], {"a": ["1", "2"], "b": ["3"]}, {"g": ["b", "a"]}) == [("b", "3"), ("a", "1"), ("a", "2")]
    rows = spark.createDataFrame([("o", "s", "1", 0), ("o", "s", "1", 1), ("o", "t", "1", 2)], "outlet string, section string, id string, position int")
    kept = feeds.first_on_page(rows)
    assert sorted(r.position for r in kept.collect()) == [0, 2]
    feeds.write_sections(kept, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 2


def test_block_listing(spark):
    body = {"data": [{"id": "urn:bbc:77", "path": "/news/x", "title": " T ", "summary": "", "topics": ["a"], "indexImage": {"model": {"blocks": {"src": "i.jpg", "width": 5}}}}]}
    got = pages.block_listing(spark.createDataFrame([("c", json.dumps(body)), ("c", "broken")], "collection string, body string"), "https://b.org").collect()
    assert [(r.asset_id, r.headline, r.description, r.url, r.thumbnail, r.topics) for r in got] == [("77", "T", None, "https://b.org/news/x", "i.jpg", ["a"])]


def test_section_rows(spark):
    article = {"canonical_url": "/w/x", "title": "", "basic_headline": "H  h", "description": "d", "published_time": "2026-11-05T09:00:00Z", "authors": [{"byline": "A"}, {"name": ""}, "B"], "thumbnail": {"url": "t"}, "word_count": 9}
    deep = {"meta": {"articles": []}, "result": {"x": [{"other": 1}], "page": {"list": [article, "junk"]}}}
    got = pages.section_rows(spark.createDataFrame([("s", json.dumps(deep)), ("s", "{")], "section string, body string"), "https://r.org").collect()
    assert [(r.url, r.headline, r.authors, r.thumbnail, r.word_count) for r in got] == [("https://r.org/w/x", "H h", ["A", "B"], "t", 9)]


def block(kind, *children, **more):
    return {"type": kind, "model": {"blocks": list(children), **more}}


def para(text, kind="fragment", **more):
    return {"type": "paragraph", "model": {"text": text, "blocks": [{"type": kind, "model": {"text": text, **more}}]}}


def test_block_text(spark):
    contents = [
        block("text", para("First.")),
        block("subheadline", block("text", para("Head"))),
        block("text", {"type": "unorderedList", "model": {"blocks": [block("listItem", para("Item"))]}}),
        block("text", para("Last.")),
        block("text", para("Correction", attributes=["italic"])),
        block("text", para("Promo"), suitableForAbridgement=False),
        {"type": "links"},
        block("text", para("After", attributes=["italic"])),
    ]
    only = [block("text", para("Only"), suitableForAbridgement=False)]
    links = [block("text", para("Go", "urlLink"))]
    got = texts(spark, contents, only, links, [])
    assert got == ["First.\n\nHead\n\nItem\n\nLast.\n\nCorrection", "Only", None, None]
    df = spark.createDataFrame([(2, "<html/>"), (3, None), (4, next_data("broken")), (5, next_data({"props": {"pageProps": {"page": {"x": 5}}}}))], "i int, h string")
    assert [(r.text, r.authors) for r in blocks.block_pages(df, "h").collect()] == [(None, None)] * 4


def next_data(value):
    return f'<html><script id="__NEXT_DATA__" type="application/json">{value if isinstance(value, str) else json.dumps(value)}</script></html>'


def texts(spark, *contents):
    rows = [(i, next_data({"props": {"pageProps": {"page": {"@\"news\",": {"contents": c}}}}})) for i, c in enumerate(contents)]
    return [r.text for r in blocks.block_pages(spark.createDataFrame(rows, "i int, h string"), "h").orderBy("i").collect()]


def test_blocks_that_are_odd(spark):
    italic = {"type": "fragment", "model": {"text": "leaning", "attributes": ["italic"]}}
    link = {"type": "urlLink", "model": {"text": "a link", "blocks": [{"type": "fragment", "model": {"text": "a link"}}]}}
    mixed = {"type": "paragraph", "model": {"text": "leaning a link", "blocks": [italic, link]}}
    leaning = {"type": "paragraph", "model": {"text": "leaning a link", "blocks": [italic, block("urlLink", italic, text="x")]}}
    first, stop = block("text", para("First.")), {"type": "links"}
    got = texts(
        spark,
        ["junk", 5, None, block("text", "junk", 7, para("Said &amp; <b>done</b>"), {"type": "paragraph", "model": {"text": "Odd", "blocks": ["x", 1, {"model": 3}]}})],
        [first, stop, block("text", mixed)],  # an upright link makes it an ordinary paragraph, which the body reaches
        [first, stop, block("text", leaning)],
        [first, block("text", block("text", para("within")))],  # a text block inside one is none of its paragraphs
        [first, block("text", {"type": "orderedList", "model": {"blocks": ["junk", block("listItem", para("one"), para("two"))]}})],
        [first, {"type": "crosshead", "model": {"blocks": [block("text", para("Last head"))]}}],
    )
    assert got == ["Said & done\n\nOdd", "First.\n\nleaning a link", "First.", "First.", "First.\n\none\n\ntwo", "First."]


def test_fields_of_block_pages(spark):
    person = lambda **k: block("contributor", *(block(kind, block("text", para(text))) for kind, text in k.items()))
    contents = [block("byline", person(name="Ann Lee and Bo Ek", role="Editor"), "junk", person(role="nobody"), person(name="Cy", location="Oslo")), block("text", para("One two three."))]
    props = {
        "type": "article",
        "metadata": {"firstPublished": 1762333200123, "lastPublished": 1762333300000, "contributors": "  ", "seoHeadline": "A &amp; B", "wordCount": 9, "pillar": [{"title": "News"}, {}, 3], "indexImage": {"originalSrc": "o.jpg", "blocks": [{"type": "x"}, {"type": "rawImage", "model": {"copyrightHolder": "C"}}]}, "videoMetadata": {"id": "p1", "versions": ["x", {"duration": 61}]}},
        "analytics": {"contentId": "urn:1", "language": "en"},
        "page": {"k": {"contents": contents, "topics": [{"title": "T", "id": "7", "isEvent": True}, {"title": ""}, "x"], "section": [{"title": "World", "url": "/w"}]}},
    }
    ld = '<script data-x type="application/ld+json">{"author": [{"name": " Di  Ek "}, "x", {"name": ""}]}</script><script type="application/ld+json">{broken</script>'
    bare = {**props, "metadata": {}, "page": {"k": {"contents": contents[1:]}}}
    rows = [(0, next_data({"props": {"pageProps": props}}) + ld), (1, next_data({"props": {"pageProps": bare}}) + ld)]
    one, two = blocks.block_pages(spark.createDataFrame(rows, "i int, h string"), "h").orderBy("i").collect()
    assert [tuple(a) for a in one.authors] == [("Ann Lee and Bo Ek", "Editor", None), ("Cy", None, "Oslo")] and one.author == "Ann Lee and Bo Ek"
    assert (one.published, one.updated, one.page_last_updated) == ("2025-11-05T09:00:00.123Z", "2025-11-05T09:01:40.000Z", None)
    assert (one.word_count, one.stated_word_count, one.seo_headline, one.content_id, one.page_type, one.language, one.producer) == (3, 9, "A & B", "urn:1", "article", "en", None)
    assert [tuple(t) for t in one.topics] == [("T", "7", None, True)] and [tuple(x) for x in one.page_section] == [("World", "/w")] and one.pillar == ["News"]
    assert (one.image_original, one.image_copyright, one.video_pid, one.video_duration_seconds) == ("o.jpg", "C", "p1", 61)
    assert [tuple(a) for a in two.authors] == [("Di Ek", None, None)] and (two.author, two.text, two.published, two.topics) == ("Di Ek", "One two three.", None, [])


def test_content_pages(spark):
    fusion = lambda result: f"<script>x=1;Fusion.globalContent = {json.dumps({'result': result})};Fusion.y={{}};</script>"
    ld = lambda value: f'<script type="application/ld+json">{json.dumps(value)}</script>'
    marked = '<div data-testid="paragraph-0">One <b>b</b> &amp; c</div><p data-testid="paragraph-1"><span data-testid="paragraph-9">in</span></p><div data-testid="x">no</div>'
    taxonomy = {"tags": [{"is_topic": True, "short_bio": "War"}, {"is_topic": False, "short_bio": "No"}, "x"], "n2": [{"code": "A", "name": "Aa"}, {}], "other_sections": [{"name": "World"}], "keywords": ["k", 5]}
    elements = [{"type": "text", "content": " First <i>one</i>"}, {"content": {"basic": "Second"}}, {"type": "image", "content": "no"}, {"type": "header", "text": "Third"}, "junk", {"type": "paragraph", "content": ""}]
    rows = [
        fusion({"content_elements": elements, "taxonomy": taxonomy, "additional_properties": {"article_properties": {"place": "KYIV"}}}) + ld({"articleBody": "not this"}),
        fusion({"body": "l1\n\nl2\u2028l3", "taxonomy": {}, "additional_properties": {"article_properties": {"place": "Sept 14 (Wire)"}}}),
        fusion({"content_elements": []}) + ld([{"x": 1}, {"articleBody": "a\nb"}]),
        ld({"@type": "LiveBlogPosting", "liveBlogUpdate": [{"headline": "H1", "articleBody": "B1"}, "x", {"headline": "H2"}]}) + marked,
        "<script>Fusion.globalContent={broken</script>" + marked,
        "<html/>",
        None,
    ]
    got = blocks.content_pages(spark.createDataFrame(list(enumerate(rows)), "i int, h string"), "h", "Wire").orderBy("i").collect()
    assert [r.text for r in got] == ["First one\n\nSecond\n\nThird", "l1\n\nl2\n\nl3", "a\n\nb", "H1\n\nB1\n\nH2", "One b & c\n\nin", None, None]
    one = got[0]
    assert (one.topics, [tuple(x) for x in one.subjects], one.sections, one.keywords, one.place) == (["War"], [("A", "Aa")], ["World"], ["k"], "KYIV")
    assert (got[1].topics, got[1].place, got[2].topics) == ([], None, None)
    article = {"kicker": {"names": ["World", 3]}, "primary_tag": {"short_bio": "", "text": "T"}, "ad_topics": ["a", "b", "a"]}
    df = spark.createDataFrame([(json.dumps(article),), ("5",)], "j string").select(blocks.listing_labels(F.try_parse_json("j")).alias("x"))
    assert [tuple(r.x) for r in df.collect()] == [(["World"], "T", ["a", "b"]), ([], None, [])]


PAGE = """<html><head><meta property="og:title" content="Title"><meta property="article:tag" content="x"><script type="application/ld+json">{"headline": "LD", "articleBody": "one\\ntwo", "author": {"name": "Ann"}, "datePublished": "2026-11-05"}</script></head>
<body><nav><p>menu</p></nav><div class="a body-text"><p>First &amp; <b>bold</b><p>Second<aside><p>ad</p></aside><script>x</script></div></body></html>"""


def test_article_pages(spark):
    df = spark.createDataFrame([(1, PAGE), (2, PAGE.replace("body-text", "z")), (3, None)], "i int, h string")
    got = [r.p for r in df.select("i", pages.article_pages("h").alias("p")).orderBy("i").collect()]
    assert got[0].text == "First & bold Second\n\nSecond" or got[0].text.startswith("First & bold")
    assert (got[0].headline, got[0].tags, got[0].authors, got[0].published) == ("Title", ["x"], ["Ann"], "2026-11-05") and got[1].text == "one\n\ntwo" and got[2].text is None


def test_listing_cards(spark):
    html = """<article class="card-lg x"><a class="card-lg__title" href="/n/1"> A  b</a><div class="card-lg__meta"><a>World</a><span>Nov 5</span></div><p class="card-lg__byline">Ann, Bo</p><img data-src="i.jpg" src="p"><div class="card-lg__play-cta"></div></article>
    <article class="card-sm"><span>no link</span></article><article class="other"><a class="other__title" href="/x">x</a></article>"""
    got = pages.listing_cards(spark.createDataFrame([("u", html)], "page string, h string"), "h", "https://p.org").collect()
    assert [(r.page, r.url, r.headline, r.section, r.listing_date, r.authors, r.thumbnail, r.is_video) for r in got] == [("u", "https://p.org/n/1", "A b", "World", "Nov 5", ["Ann", "Bo"], "i.jpg", True)]
    df = spark.createDataFrame([("a?d=12 b&d=12 c?d=9",), ("none",)], "p string")
    assert [r.x for r in df.select(pages.deployment_of("p").alias("x")).collect()] == ["12", None]


def test_incidents(spark, tmp_path):
    head = ";".join(files.INCIDENT_COLUMNS)
    row = lambda **k: ";".join(str(k.get(c, "")) for c in files.INCIDENT_COLUMNS)
    base = {"Conflict": "War in Ukraine", "Origin": "vid", "Date": "2026-11-05T09:00:00Z", "Latitude": "48.5", "Longitude": "37.5", "Id": "1"}
    bad = [{"Conflict": "Other"}, {"Origin": "TXT"}, {"Date": "?"}, {"Latitude": "NaN"}, {"Latitude": "91"}, {"Longitude": "inf"}, {"Id": ""}, {"Latitude": ""}]
    lines = [head, row(**base, Description="drone hits; depot".replace(";", ","), Units="U", Faction="F", EquipmentItems="T-1", Source="https://s/1, https://s/2"), row(**base | {"Id": "2", "Date": "2026-11-04T09:00:00Z"}, Name="plain")]
    lines += [row(**base | {"Id": f"b{i}"} | b) for i, b in enumerate(bad)]
    (tmp_path / "x.csv").write_text("\n".join(lines))
    rows = files.read_incidents(spark, str(tmp_path / "x.csv"))
    assert {r.Id for r in rows.collect()} == {"1", "2"}
    out = {k: v.collect() for k, v in files.incident_tables(files.latest_incident(rows), "now").items()}
    assert [r.id for r in out["incidents"]] == ["geoconfirmed:1"] and out["incidents"][0].type == "drone_strike"
    assert [(r.id.split(":", 2)[2], json.loads(r.value)["value"]) for r in sorted(out["claims"], key=lambda r: r.id[-1])] == [("1:location:1", [37.5, 48.5]), ("1:event_type:2", "drone_strike"), ("1:actor:3", ["U", "F"]), ("1:weapon:4", ["T-1"])]
    assert out["receipts"][0].source_url == "https://s/1" and out["runs"][0].idempotency_key.endswith(":ukraine:1")
    given = files.incident_tables(files.latest_incident(rows), "now", interpretation={"model": "m", "payload": {"event_type": "z", "actors": ["q"]}})
    assert given["incidents"].first().type == "z" and given["claims"].filter("kind = 'actor'").first().value == '{"value":["q"]}'


def test_items_have_their_place_in_the_document(spark):
    """One pass over mixed documents, in order, with broken ones and other columns between."""
    many = '<?xml version="1.0"?><rss><channel>' + "".join(f"<item><title>t{i}</title></item>" for i in range(300)) + "</channel></rss>"
    docs = [(0, RSS2), (1, RDF), (2, ATOM), (3, "<rss><channel><item>"), (4, None), (5, ""), (6, "not xml"), (7, many), (8, "<other><x>1</x></other>")]
    df = spark.createDataFrame(docs, "doc int, xml string").repartition(4)
    got = {}
    for r in feeds.feed_items(df, "xml").collect():
        got.setdefault(r.doc, {})[r.position] = r.title
    assert got == {0: {0: "One", 1: "Two", 2: "Three"}, 1: {0: "Four"}, 2: {0: "Five"}, 7: {i: f"t{i}" for i in range(300)}}
    plan = feeds.feed_items(df, "xml")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1


def test_credits_within_media(spark):
    """The item's own words first, else those of an element without an address, of a group, or of an element in a group."""
    item = lambda inner: f"<item><title>t</title>{inner}</item>"
    items = [
        "<media:credit>own</media:credit><media:content url='u'><media:credit>in</media:credit></media:content>",
        "<media:content><media:credit> in </media:credit></media:content>",
        "<media:group><media:content url='g'/><media:credit>group</media:credit><media:description>told</media:description></media:group>",
        "<media:group><media:content url='g'><media:credit>deep</media:credit></media:content></media:group><media:thumbnail url='th'/>",
        "<media:content url=''><media:credit> </media:credit></media:content>",
    ]
    doc = "<rss xmlns:media='m'><channel>" + "".join(map(item, items)) + "</channel></rss>"
    got = feeds.feed_items(spark.createDataFrame([(doc,)], "x string"), "x").orderBy("position").collect()
    assert [r.media_credit for r in got] == ["own", "in", "group", "deep", None] and [r.media_description for r in got] == [None, None, "told", None, None]
    assert [[m.url for m in r.media] for r in got] == [["u"], [], [], ["th"], []]
