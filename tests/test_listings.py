import random

from pyspark.sql import functions as F

from meridian.sources import listings

ROWS = "outlet string, section string, page int, position int, aliases array<string>, text string"
KNOWN = "outlet string, alias string, story_id string, first_seen_at timestamp"


def by_hand(pages, sections, known, seen_in, most):
    """The walk of one section after the other."""
    kept, count = [], {}
    for outlet, section in sections:
        page, seen = 0, set()
        while not most or page < most:
            new, all_known = [], True
            for position, aliases, text in sorted(pages.get((outlet, section, page), []), key=lambda r: r[0]):
                key = aliases[0]
                if key in seen:
                    continue
                seen.add(key)
                owner = next((known[outlet, a] for a in aliases if (outlet, a) in known), None)
                all_known &= owner is not None and (owner, section) in seen_in
                new.append((outlet, section, page, position, text))
            if not new:
                break
            kept += new
            page += 1
            count[outlet, section] = page
            if all_known:
                break
    return sorted(kept), count


def run(spark, pages, sections, known, seen_in, most=0):
    asked = []
    recorded = spark.createDataFrame([(*k, *r) for k, rows in pages.items() for r in rows], ROWS)

    def list_page(wanted):
        asked.append(wanted.count())
        return recorded.join(wanted, ["outlet", "section", "page"])

    rows, counts = listings.read_listings(
        spark.createDataFrame(sections, "outlet string, section string"), list_page,
        spark.createDataFrame([(o, a, s, None) for (o, a), s in known.items()], KNOWN), spark.createDataFrame(sorted(seen_in), "story_id string, section string"), most,
    )
    return sorted((r.outlet, r.section, r.page, r.position, r.text) for r in rows.collect()), {(r.outlet, r.section): r.pages for r in counts.collect()}, asked


def test_sections_are_read_as_one_by_one(spark):
    rng = random.Random(4)
    sections = [(f"o{i % 2}", f"s{i}") for i in range(6)]
    pages = {(o, s, p): [(i, [f"a{rng.randrange(60)}", f"b{rng.randrange(900)}"], f"t{rng.random()}") for i in range(rng.randrange(1, 5))] for o, s in sections for p in range(rng.randrange(0, 9))}
    known = {(o, f"{k}{i}"): f"st{i}" for o in ("o0", "o1") for k in "ab" for i in range(50) if k == "a" or i % 3 == 0}
    seen_in = {(f"st{i}", s) for i in range(50) for _, s in sections if rng.random() < 0.6}
    for most in (0, 2):
        want = by_hand(pages, sections, known, seen_in, most)
        rows, counts, asked = run(spark, pages, sections, known, seen_in, most)
        assert (rows, counts) == want and asked[0] == len(sections)
        # no page past an end: what is asked for is what was counted, and the empty page that ends a section
        assert sum(asked) <= sum(counts.values()) + len(sections)


def test_rows_without_an_alias_and_sections_without_a_page(spark):
    pages = {("o", "s", 0): [(0, [], "x"), (1, [], "y"), (2, ["a"], "z"), (3, ["a"], "again")], ("o", "s", 1): [(0, ["a"], "again")]}
    rows, counts, asked = run(spark, pages, [("o", "s"), ("o", "none")], {}, set())
    assert [r[4] for r in rows] == ["x", "y", "z"] and counts == {("o", "s"): 1} and asked == [2, 1]
    rows, counts, asked = run(spark, pages, [], {}, set())
    assert rows == [] and counts == {}
