"""Column functions: texts are put together from known parts, which must come out again.

Each rule has a maker of (text, wanted) pairs over seeded random parts, and pairs for its
edges.  Behaviour that only the landed data explain is marked as pinned.
"""

import base64
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from listinglake import fixed_values as fv
from listinglake.functions import arrays, dates, ids, nulls, numbers, text, urls

RNG = random.Random(20260815)
WORDS = "gull dune tern reef inlet marsh beacon sedge harbor jetty".split()
EMPTY = [(None, None), ("", None)]


def some(make, times=6):
    return [make() for _ in range(times)]


def n(low=1, high=9_000):
    return RNG.randint(low, high)


def word():
    return RNG.choice(WORDS)


def commas(value):
    return f"{value:,}"


def pair(make_text, make_wanted, *ranges):
    """A text and what is wanted of it, from the same random numbers."""
    parts = [n(*r) for r in ranges]
    return make_text(*parts), make_wanted(*parts)


def whole_numbers():
    yield from some(lambda: pair(lambda a, b: f"{word()} {a} {word()} {b}", lambda a, b: a, (0, 40), (0, 40)))
    yield from [(f"A {s} by the {word()}", 0) for s in ("Studio", "studio", "STUDIO", "microstudio")]
    yield from [(f"{word()}7{word()}", 7), ("no digits", None), ("9" * 11, None), *EMPTY]


def decimals():
    yield from some(lambda: pair(lambda a, b: f"{a}.{b} tubs of {b}", lambda a, b: a + b / 10, (0, 12), (0, 9)))
    yield from [(f"{k} showers", float(k)) for k in (0, 4, 11)]
    yield from [("HALF a bath", 0.5), ("two", None), *EMPTY]


def priced():
    for sign in ("$", "€", "£", "CAD"):
        yield from some(lambda: pair(lambda a: f"{sign}{commas(a)}", lambda a: (float(a), sign), (1, 10**7)), 3)
    yield from some(lambda: pair(lambda a, c: f"${a}.{c:02d}", lambda a, c: (round(a + c / 100, 2), "$"), (1, 900), (0, 99)), 3)
    yield from [("81", (81.0, None)), ("ask us", (None, None)), ("", (None, None)), (None, (None, None))]
    # Pinned: a comma never marks decimals, and a sign without digits keeps its currency.
    yield from [("€2.750,00", (2.75, "€")), ("£,", (None, "£"))]


def dollars():
    yield from some(lambda: pair(lambda a: f"{word()} ${commas(a)} a week", float, (1, 10**7)))
    yield from some(lambda: pair(lambda a, c: f"${commas(a)}.{c:02d} or ${c}", lambda a, c: round(a + c / 100, 2), (1, 10**5), (0, 99)))
    yield from [("on request", None), ("612", None), *EMPTY]


def comma_whole():
    yield from some(lambda: pair(lambda a, b: f"~{commas(a)} feet, {commas(b)} below", lambda a, b: a, (1, 10**8), (1, 10**6)))
    yield from [("3.75 of it", 3), ("none", None), *EMPTY]


def comma_decimal():
    yield from some(lambda: pair(lambda a, b: f"{commas(a)}.{b} acres", lambda a, b: a + b / 10, (1, 10**6), (0, 9)))
    yield from [("8 lots", 8.0), (", of sand", None), *EMPTY]


def slashed_baths():
    yield from some(lambda: pair(lambda a, b: f"{a}/{b}", lambda a, b: (a, b), (0, 30), (0, 9)))
    yield from some(lambda: pair(lambda a, b: f"  {a}  /  {b} ", lambda a, b: (a, b), (0, 30), (0, 9)), 2)
    yield from [("14", (14, 0)), ("q/5", (None, 5)), ("", (None, None)), (None, (None, None))]


def worded_baths():
    yield from some(lambda: pair(lambda a, b: f"{a} Full{RNG.choice([', ', ' '])}{b} Half", lambda a, b: (a, b), (0, 30), (0, 9)))
    yield from [("11 Full", (11, 0)), ("a few", (None, 0)), ("", (None, None)), (None, (None, None))]


def detail_baths():
    yield from some(lambda: pair(lambda a, b: f"Bathrooms: {a} & {b} Half", lambda a, b: (a, b), (0, 30), (1, 9)), 3)
    # Pinned: a second number counts only next to the word.
    yield from some(lambda: pair(lambda a, b: f"Bathrooms: {a} & {b}", lambda a, b: (a, 0), (0, 30), (1, 9)), 3)
    yield from [("17", (17, 0)), ("some", (None, None)), ("", (None, None)), (None, (None, None))]


def first_digits():
    yield from some(lambda: pair(lambda a: f"sleeps on {a} beds", lambda a: a, (0, 60)))
    yield from [("beds", None), *EMPTY]


def digits_in_front():
    yield from some(lambda: pair(lambda a: f"{a}{RNG.choice(['', ' BR', '+'])}", lambda a: a, (0, 60)))
    yield from [(f"about {n()}", None), *EMPTY]


def review_counts():
    yield from some(lambda: pair(lambda a: f"{a % 5}.{a % 10} ({commas(a)})", lambda a: a, (1, 10**6)))
    yield from [("unrated", None), *EMPTY]


def rate_ranges():
    yield from some(lambda: pair(lambda a, b: f"Weekly: ${commas(a)} - ${commas(b)}", lambda a, b: (float(a), float(b)), (1, 10**5), (1, 10**5)))
    yield from [("wEEkly:$31-$47", (31.0, 47.0)), ("By the night", (None, None)), (None, (None, None))]


def stripped():
    yield from some(lambda: (lambda a, b: (f"<p class='x'>{a}</p><br/>{b}", f"{a}  {b}"))(word(), word()))
    yield from [(f"\xa0{w}\xa0house&nbsp;", f"{w} house") for w in WORDS[:2]]
    yield from [("", ""), (None, ""), (" <i> </i> ", "")]
    # Pinned: other references stay as they are here.
    yield from [("surf &amp; sand &lt;3", "surf &amp; sand &lt;3")]


def unescaped():
    yield from [("&quot;Tern&quot; &hellip; &#65;&#x42;", '"Tern" … AB'), ("&nosuch;", "&nosuch;"), ("", ""), (None, None)]


def titled():
    yield from some(lambda: (lambda a, b: (f"{a} {b.upper()}", f"{a.capitalize()} {b.capitalize()}"))(word(), word()))
    yield from [("6x6 d'arc", "6X6 D'Arc"), ("VanDyke", "Vandyke"), ("", "")]


def neighborhoods():
    yield from some(lambda: (lambda a, b: (f"/outer-banks/{word()}/{a}-{b}/rentals/{word()}/", f"{a.capitalize()} {b.capitalize()}"))(word(), word()))
    yield from [("/outer-banks/avon/2x4-lots/x/", "2X4 Lots"), ("/elsewhere/x/", None), ("/outer-banks/avon/", None), *EMPTY]


def slugs():
    yield from some(lambda: (lambda a, b: (f"{a.title()} {b.title()}", f"{a}-{b}"))(word(), word()))
    yield from [("", "")]


def numbered_names():
    yield from some(lambda: (lambda w, k: (f"{w} cottage - #{k}", f"{w} cottage"))(word(), n()))
    yield from [("Reef #12 North", "Reef #12 North"), ("Reef-#12", "Reef"), ("  Reef ", "Reef")]


def without_query():
    yield from some(lambda: (lambda w, k: (f"/{w}/{k}?from={k}&to=x", f"/{w}/{k}"))(word(), n()))
    yield from [("/tern", "/tern")]


def last_parts():
    yield from some(lambda: (lambda w: (f"https://h/{word()}/{w}{RNG.choice(['', '/'])}", w))(word()))


def kinds_of_listing():
    yield from some(lambda: (f"hall-for-sale-{word()}", "For Sale"), 2)
    yield from some(lambda: (f"{word()}-for-lease-{n()}", "For Lease"), 2)
    # Pinned: lease is looked for first.
    yield from [("for-sale-and-for-lease", "For Lease"), (word(), "Unknown"), ("", "Unknown")]


def second_lines():
    yield from some(lambda: (lambda w, z: (f"  {w} Point, TX {z} ", (f"{w} Point", "TX", z)))(word(), f"{n(10000, 99999)}"))
    yield from [("Reef, TX 70001-0042", ("Reef", "TX", "70001-0042"))]
    yield from [(t, ("", "", "")) for t in ("Reef Texas", "", None)]


def villages():
    yield from some(lambda: (lambda a, b: (f"Village{RNG.choice([':', ' : '])} {a.title()} {b.title()}", f"{a}-{b}"))(word(), word()))
    yield from [("Check in on Sunday", None), (None, None)]


def coded(value):
    return base64.b64encode(value.encode()).decode()


def stay_codes():
    yield from some(lambda: (lambda k: (coded(f"{word().title()}Stay:{k}"), str(k)))(n()))
    # Pinned: only the first colon parts kind and id; a code without one is its own id.
    yield from [(coded("gull"), "gull"), (coded("k:8:9"), "8:9")]
    # Not base64, not UTF-8, cut short.
    yield from [("*** no ***", None), (base64.b64encode(b"\xfe\xff").decode(), None), (coded("tern")[:3], None), *EMPTY]


def stay_ids():
    yield from some(lambda: (lambda k: (f"https://h/rooms/{k}?guests=4", str(k)))(n()), 3)
    yield from some(lambda: (lambda k: (str(k), str(k)))(n()), 2)
    # Pinned: this source takes no blanks around an id.
    yield from [(" 31 ", None), (word(), None)]


def design_ids():
    yield from some(lambda: (lambda k: (f"https://h/{word()}/{k}-{word()}-{word()}/", str(k)))(n()), 3)
    yield from some(lambda: (lambda k: (f" {k:04d} ", f"{k:04d}"))(n(1, 900)), 3)
    # Pinned: a bare number in the path needs a page name before it.
    yield from [("/property-detail-page/0077", "0077"), ("/88/", None), ("gull-reef", None)]


def church_ids():
    yield from some(lambda: (lambda w: (RNG.choice([w, f" {w} ", f"https://h/property/{w}/"]), w))(f"{word()}-{n()}"))


def commercial_ids():
    yield from some(lambda: (lambda k: (RNG.choice([str(k), f"{word()}/{k}", f"https://h/properties/{word()}/{k}"]), str(k)))(n()))
    yield from [("0", "0"), ("77aa" * 10, None), ("", None)]


def home_ids():
    yield from some(lambda: (lambda k: (RNG.choice([str(k), f"/NC/{word()}/home/{k}", f"https://h/home/{k}?x=2"]), str(k)))(n()))
    yield from [(word(), None)]


def index_keys():
    yield from some(lambda: (lambda k: (f" {k} ", str(k)))(n()), 2)
    yield from some(lambda: (lambda w, k: (f"{w.upper()}-{k}", f"{w}-{k}"))(word(), n()), 2)
    yield from [(t, t) for t in ("https://H/Gull", "/outer-banks/Gull-9")]


def village_home_ids():
    yield from some(lambda: (lambda k: (RNG.choice([f"{k:06d}", f"/x/property/{k}?a=b"]), k))(n()))
    yield from [(word(), None)]


def town_home_ids():
    yield from some(lambda: (lambda k: (f"{k:06d}", k))(n()), 3)
    yield from [(word(), None)]


def ids_in_pages():
    yield from some(lambda: (lambda k: (f'<a>"{RNG.choice(["propertyId", "unitId", "PROPERTYID"])}":{k},</a>', k))(n()))
    # Pinned: quotes may stand around the sign, blanks behind it may not.
    yield from [('unitId="31"', 31), ("unitId= 31", None), (word(), None)]


def item_ids():
    yield from some(lambda: (lambda k: (f'"eid": "{k}1", "item_id":{k}', str(k)))(n()), 2)
    yield from [('"eid" : "26"', "26"), (word(), "")]


def tokens():
    yield from [(f"{k}?v=q", f"{fv.TWIDDY_IMAGES}/{k}?v=q") for k in (4, 81)] + [*EMPTY]


CASES = [
    (numbers.int_from_text, whole_numbers),
    (numbers.float_from_text, decimals),
    (numbers.price_and_currency, priced),
    (numbers.dollar_amount, dollars),
    (numbers.int_with_commas, comma_whole),
    (numbers.float_with_commas, comma_decimal),
    (numbers.baths_slash, slashed_baths),
    (numbers.baths_words, worded_baths),
    (numbers.baths_text, detail_baths),
    (numbers.beds_text, first_digits),
    (numbers.leading_int, digits_in_front),
    (numbers.review_count, review_counts),
    (numbers.rate_range, rate_ranges),
    (text.strip_html, stripped),
    (text.html_unescape, unescaped),
    (text.title_case, titled),
    (text.neighborhood, neighborhoods),
    (text.town_slug, slugs),
    (text.strip_number_suffix, numbered_names),
    (text.strip_query, without_query),
    (text.last_segment, last_parts),
    (text.listing_type, kinds_of_listing),
    (text.address_line2, second_lines),
    (text.village_label, villages),
    (ids.decode_stay_id, stay_codes),
    (ids.stays_id, stay_ids),
    (ids.carolinadesigns_id, design_ids),
    (ids.churchrealty_id, church_ids),
    (ids.crexi_id, commercial_ids),
    (ids.redfin_id, home_ids),
    (ids.sunrealty_key, index_keys),
    (ids.surforsound_id, village_home_ids),
    (ids.twiddy_id, town_home_ids),
    (ids.twiddy_page_id, ids_in_pages),
    (ids.sunrealty_page_id, item_ids),
    (urls.image_from_token, tokens),
    (lambda c: urls.absolute_path(c, "https://h"),
     lambda: [(f"/{w}", f"https://h/{w}") for w in WORDS[:2]] + [("https://k/q", "https://k/q"), ("", "")]),
    (lambda c: urls.absolute_unless_http(c, "https://h"),
     # Pinned: without a slash the two run together.
     lambda: [("/gull", "https://h/gull"), ("gull", "https://hgull"), ("http://k", "http://k"), ("", "")]),
    (lambda c: nulls.equals_ci(c, "reef"), lambda: [("rEEf", True), ("reefs", False), (None, False)]),
    (lambda c: nulls.null_if_in(c, ["-", ""]), lambda: [("-", None), ("", None), ("--", "--"), (None, None)]),
    (dates.day_of_timestamp_text,
     lambda: [(f"2027-0{m}-1{m}T12:30:00", f"2027-0{m}-1{m}") for m in (1, 4, 9)] + [("", ""), (None, "")]),
    (dates.us_date,
     lambda: [(f"{d.month}/{d.day}/{d.year}", d) for d in (dt.date(2027, 1, 9), dt.date(2028, 2, 29))]
     + [("03/07/2027", dt.date(2027, 3, 7)), ("13/13/2027", None), ("2027-03-07", None)]),
]


@pytest.mark.parametrize("fn, cases", CASES, ids=lambda v: getattr(v, "__name__", ""))
def test_parts_come_out_of_texts(evaluate, fn, cases):
    made = list(cases())
    got = evaluate(fn, [c[0] for c in made])
    got = [tuple(g) if isinstance(g, tuple) else g for g in got]
    assert list(zip([c[0] for c in made], got)) == made


def test_baths_float(evaluate):
    got = evaluate(numbers.baths_float, [6.0, 7.5, 2.2, 0.0, None], "double")
    assert [tuple(g) for g in got] == [(6, 0), (7, 1), (2, 0), (0, 0), (None, None)]


def test_baths_labelled(evaluate):
    got = evaluate(
        numbers.baths_labelled,
        [
            ["Full Bathrooms: 21", "Half Bathrooms 4"],
            ["Full 8", "Full 6", "Full"],
            ["none"],
            [],
            None,
        ],
        "array<string>",
    )
    assert [tuple(g) for g in got] == [
        (21, 4), (6, None), (None, None), (None, None), (None, None),
    ]


def test_sleeps_in_list(evaluate):
    got = evaluate(
        numbers.sleeps_in_list,
        [["4 cots", "roomy (Sleeps 18), bright", "(sleeps 5)"], ["few"], None, [None]],
        "array<string>",
    )
    assert got == [18, None, None, None]


def test_yes_no_and_truthy(evaluate):
    assert evaluate(nulls.yes_no, [True, False, None], "boolean") == ["Yes", "No", ""]
    assert evaluate(nulls.truthy, [True, False, None], "boolean") == [True, False, False]


def test_flag_one(evaluate):
    assert evaluate(nulls.flag_one, ["1", "0", "x", None]) == [True, False, False, False]


def test_map_lookups(evaluate):
    first, second = fv.LOT_ACRE_KEYS[:2]
    maps = [
        {first: "7.25"}, {second: "0.75"}, {first: "3,010.5"}, {first: "unknown", second: "6"},
        {first: "", second: "6"}, {"Depth": "9"}, {}, None,
    ]
    got = evaluate(lambda c: nulls.map_decimal(c, fv.LOT_ACRE_KEYS), maps, "map<string,string>")
    assert got == [7.25, 0.75, 3010.5, None, 6.0, None, None, None]
    built, renovated = fv.YEAR_KEYS
    years = [{built: "1871"}, {renovated: "2003"}, {renovated: "2011", built: "1938"}, {}]
    got = evaluate(lambda c: nulls.map_first_present(c, fv.YEAR_KEYS), years, "map<string,string>")
    assert got == ["1871", "2003", "1938", None]


def test_keyed_value(evaluate):
    rows = [
        [("Area", "12"), ("Depth", "640")], [("Depth", "deep")], [("Depth", None)], [],
    ]
    got = evaluate(
        lambda c: nulls.safe_int(nulls.keyed_value(c, "Depth")),
        rows, "array<struct<key: string, value: string>>",
    )
    assert got == [640, None, None, None]


def test_title_subtitle(spark):
    df = spark.createDataFrame(
        [("Loft", "2 cots"), ("Loft", ""), ("", "hammock"), ("Porch", None)],
        "a string, b string",
    )
    got = [r[0] for r in df.select(text.title_subtitle(F.col("a"), F.col("b"))).collect()]
    assert got == ["Loft: 2 cots", "Loft", "hammock", "Porch: None"]


def test_names_and_addresses(spark):
    df = spark.createDataFrame(
        [("Mara", "Voss"), ("", "Voss"), (None, None), ("88 Reef Way", "#12"), ("88 Reef Way", "")],
        "a string, b string",
    )
    rows = df.select(
        text.full_name(F.col("a"), F.col("b")), text.street_unit(F.col("a"), F.col("b"))
    ).collect()
    assert [r[0] for r in rows][:3] == ["Mara Voss", "Voss", ""]
    assert [r[1] for r in rows][3:] == ["88 Reef Way #12", "88 Reef Way"]


def test_home_photo(spark):
    df = spark.createDataFrame(
        [("58", "9075142", "webp"), ("6", "7654321", None), (None, "2", "jpg"), ("2", "", "jpg")],
        "s string, m string, f string",
    )
    got = [r[0] for r in df.select(urls.home_photo(F.col("s"), F.col("m"), F.col("f"))).collect()]
    assert got == [fv.REDFIN_PHOTO_BASE + "/58/bigphoto/142/9075142_0.webp", None, None, None]


def test_distinct_by_keeps_first_in_order(evaluate):
    got = evaluate(
        lambda c: arrays.distinct_by(c, text.strip_query),
        [["/b?1", "/a?1", "/b?2", "/a", "/c"], [], None],
        "array<string>",
    )
    assert got == [["/b?1", "/a?1", "/c"], [], []]


def test_pairs_to_map_last_wins(evaluate):
    got = evaluate(
        arrays.pairs_to_map,
        [[("a", "1"), ("b", "2"), ("a", "3")], []],
        "array<struct<key: string, value: string>>",
    )
    assert got == [{"a": "3", "b": "2"}, {}]


def test_ordered_distinct(spark):
    df = spark.createDataFrame(
        [(["x", None, "y"], ["y", "", "z"]), (None, ["z"])], "a array<string>, b array<string>"
    )
    got = [r[0] for r in df.select(arrays.ordered_distinct(F.col("a"), F.col("b"))).collect()]
    assert got == [["x", "y", "z"], ["z"]]


def test_saturday_after(evaluate):
    got = evaluate(
        dates.saturday_after, [dt.date(2026, 5, 5), dt.date(2026, 6, 2), dt.date(2026, 6, 3)], "date"
    )
    for start, sat in zip([dt.date(2026, 5, 5), dt.date(2026, 6, 2), dt.date(2026, 6, 3)], got):
        target = start + dt.timedelta(days=60)
        assert sat == target + dt.timedelta(days=(5 - target.weekday()) % 7)


def test_resolve_stay():
    assert dates.resolve_stay("2026-08-15", None, 7) == ("2026-08-15", "2026-08-22", 7)
    assert dates.resolve_stay("2026-08-15", "2026-08-18") == ("2026-08-15", "2026-08-18", 3)
    for args in [(None, None, 7), ("2026-08-15",), ("2026-08-15", "2026-08-15"),
                 ("2026-08-15", None, 0)]:
        with pytest.raises(ValueError):
            dates.resolve_stay(*args)
