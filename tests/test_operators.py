"""Operators on small tables: semantics the sources rely on."""

import random

import pytest
from pyspark.sql import functions as F

from listinglake import fixed_values as fv
from listinglake.operators import dedupe, filters, joins, rates, summary, topk, union
from listinglake.operators.offers import cheapest_offer, first_search_area
from listinglake.plans import budget, health, report, search
from listinglake.plans.details import find_details
from listinglake.schemas import to_record
from listinglake.sources.dims import check_town, find_place, places, towns


def ids(df):
    return [r["listing_id"] for r in df.collect()]


# ---- cheapest offer ---------------------------------------------------------------


def offers(spark, rows):
    return spark.createDataFrame(
        [(*r, i) for i, r in enumerate(rows)],
        "listing_id string, total_price double, check_in string, pos int",
    )


def test_cheapest_date_wins(spark):
    df = offers(spark, [("1", 1500.0, "11"), ("2", 2000.0, "11"), ("1", 1300.0, "12"), ("2", 2100.0, "12")])
    best = topk.sort_by_price(cheapest_offer(df, ["check_in", "pos"]))
    assert [(r.listing_id, r.total_price, r.check_in) for r in best.collect()] == [
        ("1", 1300.0, "12"), ("2", 2000.0, "11")]


def test_ties_keep_the_first_date_and_nulls_lose(spark):
    df = offers(spark, [
        ("a", None, "11"), ("b", 5.0, "11"), ("c", None, "11"),
        ("a", 9.0, "12"), ("b", 5.0, "12"), ("c", None, "12"), ("d", 5.0, "12")])
    best = topk.sort_by_price(cheapest_offer(df, ["check_in", "pos"])).collect()
    # b and d cost the same; b was seen first.  c has no price and goes last.
    assert [(r.listing_id, r.total_price, r.check_in) for r in best] == [
        ("b", 5.0, "11"), ("d", 5.0, "12"), ("a", 9.0, "12"), ("c", None, "11")]


def test_cheapest_offer_against_plain_python(spark):
    rng = random.Random(5)
    rows = [
        (rng.choice("hhhhhabcdefg"), rng.choice([None, 1.0, 2.0, 3.0]), rng.choice(["11", "12", "13"]))
        for _ in range(400)
    ]
    rows.sort(key=lambda r: r[2])
    kept = {}
    for i, (lid, price, day) in enumerate(rows):
        old = kept.get(lid)
        if old is None:
            kept[lid] = (price, day, i, i)
        elif price is not None and (old[0] is None or price < old[0]):
            kept[lid] = (price, day, i, old[3])
    want = sorted(
        ((lid, *v) for lid, v in kept.items()),
        key=lambda v: (v[1] is None, v[1] or 0, v[4]),
    )
    got = topk.sort_by_price(cheapest_offer(offers(spark, rows), ["pos"])).collect()
    assert [(r.listing_id, r.total_price, r.check_in, r.pos, r.first_seen.pos) for r in got] == want


def test_empty_merge(spark):
    empty = offers(spark, [])
    assert cheapest_offer(empty, ["pos"]).count() == 0
    area = empty.withColumn("search_area", F.lit("x"))
    assert first_search_area(area, ["pos"]).collect()[0][0] == ""


def test_first_search_area_skips_empty(spark):
    df = spark.createDataFrame([("", 0), ("B", 2), ("A", 3), (None, 1)], "search_area string, pos int")
    assert first_search_area(df, ["pos"]).collect()[0][0] == "B"


# ---- de-duplication -----------------------------------------------------------------


def paged(spark, rows):
    return spark.createDataFrame(rows, "listing_id string, page int, pos int, price double")


def test_dedupe_first_keeps_page_order(spark):
    df = paged(spark, [("1", 1, 0, 1.0), ("2", 1, 1, 1.0), ("2", 2, 0, 9.0), ("3", 2, 1, 1.0)])
    got = dedupe.dedupe_first(df, ["listing_id"]).orderBy("page", "pos")
    assert [(r.listing_id, r.page) for r in got.collect()] == [("1", 1), ("2", 1), ("3", 2)]


def test_dedupe_later_pages(spark):
    df = paged(spark, [
        ("1", 1, 0, 1.0), ("1", 1, 1, 2.0), ("1", 2, 0, 3.0), ("2", 2, 1, 1.0), ("2", 3, 0, 2.0),
        ("3", 3, 1, 1.0)])
    got = dedupe.dedupe_later_pages(df).orderBy("page", "pos").collect()
    assert [(r.listing_id, r.page, r.price) for r in got] == [
        ("1", 1, 1.0), ("1", 1, 2.0), ("2", 2, 1.0), ("3", 3, 1.0)]


def test_hot_key_reaches_the_shuffle_as_one_row_per_task(spark):
    """The rank filter must be planned in front of the exchange as well."""
    df = spark.range(1000).select(
        (F.col("id") % 2).alias("listing_id"), F.lit(1).alias("page"), F.col("id").alias("pos"))
    plan = dedupe.dedupe_first(df, ["listing_id"])._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below


def test_cheapest_offer_aggregates_before_the_shuffle(spark):
    df = offers(spark, [("a", 1.0, "1")]).repartition(3)
    plan = cheapest_offer(df, ["pos"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_min_by") and "Window" not in plan


# ---- filters --------------------------------------------------------------------------


def test_nightly_price_bounds(spark):
    df = spark.createDataFrame(
        [("cheap", 300.0, 3), ("mid", 900.0, 3), ("dear", 1500.0, 3), ("none", None, 3)],
        "listing_id string, total_price double, nights int")
    assert ids(filters.filter_nightly_price(df, high=350)) == ["cheap", "mid"]
    assert ids(filters.filter_nightly_price(df, low=200)) == ["mid", "dear"]
    assert ids(filters.filter_nightly_price(df)) == ["cheap", "mid", "dear", "none"]


def test_bedroom_bounds(spark):
    df = spark.createDataFrame([("a", None), ("b", 0), ("c", 3)], "listing_id string, bedrooms int")
    assert ids(filters.filter_min_bedrooms(df, 0)) == ["a", "b", "c"]
    assert ids(filters.filter_min_bedrooms(df, 1)) == ["c"]
    assert ids(filters.filter_beds_range(df, 0, 5)) == ["b", "c"]
    assert ids(filters.filter_beds_range(df)) == ["a", "b", "c"]


def test_listing_type_aliases(spark):
    df = spark.createDataFrame(
        [("s", "For Sale"), ("l", "For Lease"), ("u", "Unknown")], "listing_id string, listing_type string")
    for text, want in [("", ["s", "l", "u"]), ("BUY", ["s"]), ("for sale", ["s"]), ("rent", ["l"]),
                       ("sale or lease", ["l"]), ("unk", ["u"]), ("zzz", [])]:
        assert ids(filters.filter_listing_type(df, text)) == want


def test_town_argument(spark):
    df = spark.createDataFrame([("a", "duck"), ("b", "corolla")], "listing_id string, town string")
    assert ids(filters.filter_town(df, fv.TWIDDY, " DUCK ")) == ["a"]
    with pytest.raises(ValueError, match="Valid towns: corolla, duck"):
        filters.filter_town(df, fv.TWIDDY, "atlantis")
    assert check_town(fv.SUNREALTY, "4x4")[1] == check_town(fv.SUNREALTY, "carova")[1]


def test_drop_missing_id(spark):
    df = spark.createDataFrame([("a",), ("",), (None,)], "listing_id string")
    assert ids(filters.drop_missing_id(df)) == ["a"]
    numbers = spark.createDataFrame([(5,), (None,)], "listing_id long")
    assert ids(filters.drop_missing_id(numbers)) == [5]


# ---- caps ------------------------------------------------------------------------------


def test_caps(spark):
    df = paged(spark, [(str(i), 1 + i // 4, i % 4, float(9 - i)) for i in range(10)])
    assert ids(topk.cap(df, 3)) == ["0", "1", "2"]
    assert ids(topk.cap(df, 0)) == []
    assert ids(topk.cap_by_price(df, 2, "price", "listing_id")) == ["9", "8"]
    with pytest.raises(ValueError):
        topk.cap(df, -1)


@pytest.mark.parametrize("n", [3, 1200])
def test_cap_per_group_is_exact(spark, n):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"),
        F.lit(1).alias("page"), F.col("id").alias("pos"))
    got = topk.cap_per_group(df, ["g"], n).groupBy("g").agg(
        F.count("*").alias("c"), F.max("pos").alias("last")).collect()
    rows = {}
    for i in range(5000):
        rows.setdefault("hot" if i % 3 == 0 else f"g{i % 7}", []).append(i)
    assert {r.g: (r.c, r.last) for r in got} == {
        g: (len(v[:n]), v[:n][-1]) for g, v in rows.items()}


def test_rank_and_split(spark):
    df = spark.createDataFrame(
        [("a", 5.0, 10), ("b", 3.0, 50), ("c", 1.0, 0), ("d", 2.0, None), ("e", 4.0, 9)],
        "listing_id string, total_price double, review_count int")
    top, honorable = topk.top_and_honorable(df, 2, 5, min_reviews=9)
    assert (ids(top), ids(honorable)) == (["b", "e"], ["c", "d"])
    ranked = topk.with_rank(df, ["total_price"], 3).collect()
    assert [(r.Rank, r.listing_id) for r in ranked] == [(1, "c"), (2, "d"), (3, "b")]


# ---- joins -------------------------------------------------------------------------------


def test_merge_details_prefers_the_detail(spark):
    a = spark.createDataFrame([("1", "n", 2)], "listing_id string, name string, baths int")
    b = spark.createDataFrame([("1", 9), ("2", 8)], "listing_id string, baths int")
    assert [tuple(r) for r in joins.merge_details(a, b, ["baths"]).collect()] == [("1", "n", 9)]


def test_lookup_town_and_place(spark):
    df = spark.createDataFrame([(" DUCK",), ("nowhere",)], "town string")
    got = joins.lookup_town(df, fv.CAROLINADESIGNS).collect()
    assert [(r.town, r.external_id, r.display_name) for r in got] == [(" DUCK", "33", "Duck")]
    assert towns(spark).count() == len(fv.TOWNS)
    geo = spark.createDataFrame(
        [("Asheville, NC ", '[{"boundingbox": ["35.5","35.7","-82.7","-82.4"], "display_name": "A"}, {}]'),
         ("Bare", '[{"boundingbox": ["1","2","3","x"]}]'), ("None", "[]")], "query string, body string")
    dim = places(geo)
    rows = {r.query_key: tuple(r)[1:] for r in dim.collect()}
    assert rows == {"asheville, nc": (35.5, -82.7, 35.7, -82.4, "A"), "bare": (1.0, 3.0, 2.0, None, "Bare")}
    cities = spark.createDataFrame([(" ASHEVILLE, NC",), ("x",)], "city string")
    found = {r.city: r.display_name for r in joins.lookup_place(cities, dim).collect()}
    assert found == {" ASHEVILLE, NC": "A", "x": None}


def test_find_place(spark):
    geo = spark.createDataFrame(
        [("Asheville", '[{"boundingbox": ["35.5","35.7","-82.7","-82.4"]}]')], "query string, body string")
    dim = places(geo)
    assert find_place(dim, " ASHEVILLE ")["ne_lng"] == -82.4
    with pytest.raises(ValueError, match="No geocoding result"):
        find_place(dim, "Nowhere")
    with pytest.raises(ValueError, match="Provide either"):
        find_place(dim, " ")


def test_find_details(spark):
    rows = spark.createDataFrame(
        [("5", "https://h/outer-banks/a/swb-36"), ("54", "https://h/outer-banks/b/110-d")],
        "listing_id string, url string")
    asked = {
        fv.STAYS: "https://h/rooms/5?x=1", fv.CAROLINADESIGNS: "/p/5-name/", fv.CHURCHREALTY: "/property/5/",
        fv.CREXI: 5, fv.REDFIN: "/NC/home/5", fv.SURFORSOUND: "/property/5", fv.TWIDDY: " 5 "}
    for source, identifier in asked.items():
        assert ids(find_details(rows, source, identifier)) == ["5"], source
    for source in (fv.STAYS, fv.CREXI, fv.REDFIN, fv.SURFORSOUND, fv.TWIDDY):
        with pytest.raises(ValueError, match="Cannot extract listing ID"):
            find_details(rows, source, "not an id")
    index = rows.withColumn("page", F.lit(1)).withColumn("pos", F.lit(0))
    assert ids(find_details(rows, fv.SUNREALTY, "110-D", index)) == ["54"]
    assert ids(find_details(rows, fv.SUNREALTY, "110-D")) == ["54"]
    assert ids(find_details(rows, fv.SUNREALTY, "https://h/outer-banks/b/110-d/")) == ["54"]
    assert ids(find_details(rows, fv.SUNREALTY, "54")) == ["54"]
    homes = rows.withColumn("url", F.concat(F.lit(fv.TWIDDY_BASE + "/outer-banks/x"), "listing_id", F.lit("/")))
    assert ids(find_details(homes, fv.TWIDDY, "/outer-banks/x54")) == ["54"]


INDEX = [
    ("655", "https://h/outer-banks/a/SWB-36", 1, 0), ("7", "https://h/outer-banks/b/xswb-36", 1, 1),
    ("9", "https://h/outer-banks/b/110-d", 2, 0),
]


@pytest.mark.parametrize("asked, want", [
    (" 655 ", "655"), ("SWB-36", "655"), ("xswb-36", "7"), ("110-D", "9"), ("b/110-d", "9"),
    ("https://h/outer-banks/b/110-d", "9"), ("/outer-banks/b/110-d", "9"), ("none", None), ("1", None),
])
def test_resolve_identifier(spark, asked, want):
    index = spark.createDataFrame(INDEX, "listing_id string, url string, page int, pos int")
    got = ids(joins.resolve_identifier(index, asked))
    assert got == ([want] if want else [])
    many = spark.createDataFrame([(asked,), ("zzz",)], "identifier string")
    assert ids(joins.resolve_identifiers(many, index)) == ([want] if want else [])


def test_join_unique_with_a_hot_key(spark):
    """A third of the rows share one key; every row finds its partner exactly once."""
    rows = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"),
        "id", F.create_map(F.lit("a"), F.col("id")).alias("m"))
    side = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    left = joins.join_unique(rows, side, "k", "left").collect()
    key = lambda i: 0 if i % 3 == 0 else i % 50
    assert sorted((r.id, r.k, r.v) for r in left) == [
        (i, key(i), key(i) * 10 if key(i) < 40 else None) for i in range(900)]
    assert joins.join_unique(rows, side, "k").count() == sum(key(i) < 40 for i in range(900))


def test_per_town_cap(spark):
    homes = spark.createDataFrame(
        [(str(i), "duck" if i < 6 else "avon", 9, "d", 100.0 * i, 1, i) for i in range(8)],
        "listing_id string, town string, bedrooms int, check_in string, weekly_rate double, "
        "page int, pos int")
    got = budget.week_budget_listing_rate(homes, "d", max_per_town=2)
    assert ids(got.in_budget) == ["0", "1", "6", "7"]


# ---- rates, budgets ----------------------------------------------------------------------


def test_first_week_decides(spark):
    weeks = spark.createDataFrame(
        [("1", "d", 0, False, 5.0), ("1", "d", 1, True, 6.0), ("2", "d", 0, True, None),
         ("3", "d", 4, True, 7.0), ("3", "e", 0, True, 1.0)],
        "listing_id string, arrive string, pos int, is_available boolean, weekly_rate double")
    assert [(r.listing_id, r.weekly_rate) for r in rates.available_week(weeks, "d").collect()] == [("3", 7.0)]


def test_budget_jobs(spark):
    homes = spark.createDataFrame(
        [("1", "duck", 7), ("2", "duck", 8), ("3", "corolla", 9), ("4", "duck", 2), ("5", "avon", 9),
         ("6", "duck", None)], "listing_id string, town string, bedrooms int")
    details = spark.createDataFrame(
        [(str(i), 20 + i, i, 1) for i in range(1, 7)],
        "listing_id string, sleeps int, bathrooms_full int, bathrooms_half int")
    shown = spark.createDataFrame(
        [("1", "8/15/2026", "$9,000.00", "N", 0), ("1", "8/15/2026", "$1.00", "N", 1),
         ("2", "8/15/2026", None, None, 0), ("3", "8/15/2026", "$11,000.50", "N", 0),
         ("4", "8/15/2026", "$1.00", "N", 0)],
        "listing_id string, arrival_date string, weekly_rate string, book_type string, pos int")
    got = budget.week_budget_display_rate(homes, details, shown, "2026-08-15", ["duck", "corolla"])
    assert [(r.listing_id, r.rate, r.rate_display, r.sleeps) for r in got.in_budget.collect()] == [
        ("1", 9000.0, "$9,000.00", 21)]
    assert {r.town: tuple(r)[1:] for r in got.funnel.collect()} == {
        "duck": (2, 1, 1), "corolla": (1, 1, 0), None: (3, 2, 1)}
    flagged = spark.createDataFrame(
        [("1", "2026-08-15", 900.0, False, "c", 0), ("2", "2026-08-15", 10000.0, True, "c", 0),
         ("3", "2026-08-15", 11000.0, True, "c", 0)],
        "listing_id string, arrive string, weekly_rate double, is_available boolean, "
        "week_content string, pos int")
    got = budget.week_budget_open_flag(homes, details, flagged, "2026-08-15")
    assert [(r.listing_id, r.rate, r.bathrooms_full) for r in got.in_budget.collect()] == [
        ("2", 10000.0, 2), ("3", 11000.0, 3)]
    carried = homes.withColumn("check_in", F.lit("2026-08-15")).withColumn(
        "weekly_rate", F.when(F.col("listing_id") != "2", F.col("bedrooms") * 1000.0))
    got = budget.week_budget_listing_rate(carried, "2026-08-15")
    assert [(r.listing_id, r.village, r.rate) for r in got.in_budget.collect()] == [
        ("1", "duck", 7000.0), ("3", "corolla", 9000.0), ("5", "avon", 9000.0)]


# ---- union, summary, health ------------------------------------------------------------------


def test_union_sources_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "listing_id long, name string")
    b = spark.createDataFrame([("2", 3)], "listing_id string, beds int")
    got = union.union_sources({"a": a, "b": b}).select("source", "listing_id", "name", "beds")
    assert sorted(map(tuple, got.collect())) == [("a", "1", "x", None), ("b", "2", None, 3)]


def test_missing_fields_and_population(spark):
    df = spark.createDataFrame(
        [("", 0, False), (None, None, None), ("x", 1, True)], "name string, bedrooms int, pool boolean")
    fields = ["pool", "bedrooms", "name"]
    got = [r[0] for r in df.select(summary.missing_fields(df, fields)).collect()]
    assert got == [["name"], ["pool", "bedrooms", "name"], []]
    assert summary.population(df, ["name", "bedrooms"]).collect()[0].asDict() == {
        "rows": 3, "name_filled": 1, "bedrooms_filled": 2}


def listing_rows(spark, rows):
    return spark.createDataFrame(
        rows, "listing_id string, name string, total_price double, title string, page int, pos int")


def test_health_report_rules(spark):
    good = listing_rows(spark, [("2", "", None, "", 1, 1), ("1", "n", 0.0, "t", 1, 0)])
    bad = listing_rows(spark, [("1", "", 0.0, "t", 1, 0), ("2", "n", 1.0, "t", 1, 1)])
    none = spark.createDataFrame([], "source string, kind string, entity_id string, page int, drift string")

    def status(listings, details, quarantined=none):
        r = health.health_report({fv.STAYS: listings}, {fv.STAYS: details}, quarantined).collect()
        return (r[0].status, r[0].summary, r[0].detail)

    assert status(good, good) == (
        "PASS", "search + details OK (2 results, all required fields populated)",
        ["search returned 2 results"])
    assert status(bad, bad)[:2] == ("FAIL", "search result missing required fields: ['name']")
    assert status(good.limit(0), good)[0] == "WARN"
    assert status(good, good.limit(0))[:2] == ("FAIL", "details failed: no detail row")
    untitled = good.withColumn("title", F.lit(""))
    assert status(good, untitled)[:2] == ("FAIL", "details missing required fields: ['title']")
    failed = spark.createDataFrame([(fv.STAYS, "search", None, 0, "no state"), (fv.STAYS, "search", None, 7, "later")], none.schema)
    assert status(good, good, failed)[:2] == ("FAIL", "search failed: no state")
    later = spark.createDataFrame([(fv.STAYS, "search", None, 7, "bad page")], none.schema)
    assert status(good, good, later)[0] == "PASS"
    assert status(good, good, later)[2] == ["search returned 2 results", "1 responses drifted"]
    broken = spark.createDataFrame([(fv.STAYS, "details", "1", 1, "no block")], none.schema)
    assert status(good, good.limit(0), broken)[:2] == ("FAIL", "details failed: no block")
    assert status(good, good, broken)[0] == "PASS"
    tally = summary.status_tally(
        health.health_report({fv.STAYS: good}, {fv.STAYS: good}, none)).collect()[0]
    assert tuple(tally) == (1, 0, 0)


# ---- searches ----------------------------------------------------------------------------------


def stays(spark, rows):
    df = spark.createDataFrame(
        rows, "listing_id string, total_price double, check_in string, nights int, page int, pos int")
    return to_record(df, "stays_listing", keep=["page", "pos"])


def test_over_priced_first_copy_hides_a_later_one(spark):
    df = stays(spark, [("1", 900.0, "2026-08-15", 3, 1, 0), ("1", 300.0, "2026-08-15", 3, 2, 0),
                       ("2", 300.0, "2026-08-15", 3, 2, 1), ("3", 1.0, "2026-08-16", 3, 1, 0)])
    got = search.search_stays(df, check_in="2026-08-15", nights=3, price_max=200, area="A")
    assert ids(got.rows) == ["2"]
    assert tuple(got.summary.collect()[0]) == ("A", 1)
    assert "page" not in got.rows.columns


def test_multi_date_search(spark):
    d = ["2026-07-11", "2026-07-12"]
    df = stays(spark, [("A", 1500.0, d[0], 7, 1, 0), ("B", 2000.0, d[0], 7, 1, 1),
                       ("A", 1300.0, d[1], 7, 1, 0), ("C", 1800.0, d[1], 7, 1, 1),
                       ("D", 1.0, d[1], 7, 1, 2), ("E", 1.0, d[1], 6, 1, 0)])
    got = search.search_stays_on_dates(df, check_in_dates=d, nights=7, max_results=2)
    # Every date is cut to two rows first, so D never gets in.
    assert [(r.listing_id, r.check_in) for r in got.rows.collect()] == [("A", d[1]), ("C", d[1])]
    for kw in [{"check_in_dates": d, "nights": 0}, {"check_in_dates": [], "nights": 7},
               {"check_in_dates": d, "nights": 7, "check_in": d[0]}]:
        with pytest.raises(ValueError):
            search.search_stays_on_dates(df, **kw)


def rental(spark, record, rows):
    df = spark.createDataFrame(
        rows, "listing_id string, town string, bedrooms int, check_in string, page int, pos int")
    return to_record(df, record, keep=["page", "pos", "check_in"])


def test_town_searches(spark):
    rows = [("1", "avon", 7, "", 1, 0), ("2", "avon", None, "", 1, 1), ("1", "avon", 7, "", 1, 2),
            ("1", "avon", 7, "", 2, 0), ("3", "avon", 8, "", 2, 1), ("4", "salvo", 9, "", 1, 0)]
    sos = rental(spark, "surforsound_listing", rows)
    got = search.search_surforsound(sos, "Avon", 7)
    assert ids(got.rows) == [1, 1, 3]
    assert tuple(got.summary.collect()[0]) == ("Avon, Hatteras Island, NC", 3)
    assert ids(search.search_surforsound(sos, "avon", 0, strict=True).rows) == [1, 2, 3]
    duck = [("5", "duck", 3, "", 1, 0), ("6", "Duck", 9, "", 1, 1)]
    tw = search.search_twiddy(rental(spark, "twiddy_listing", duck), "duck", 4)
    assert ids(tw.rows) == [6]
    assert tw.summary.collect()[0].search_area == "Duck, NC (Outer Banks)"
    cd = rental(spark, "carolinadesigns_listing", duck)
    assert search.search_carolinadesigns(cd, "DUCK", title=" ").summary.collect()[0][0] == "Duck".upper().title()
    assert search.search_carolinadesigns(cd, "duck", title=" T ").summary.collect()[0][0] == "T"
    sun = search.search_sunrealty(rental(spark, "sunrealty_listing", duck), "duck")
    assert ids(sun.rows) == ["6"]
    assert sun.summary.collect()[0][0] == "Duck, NC (Outer Banks) - Sun Realty"
    with pytest.raises(ValueError, match="query is required"):
        search.search_crexi(cd, "")


def test_report_columns(spark):
    rows = spark.createDataFrame(
        [("1", "n", "duck", 7, 2.0, 4.5, 30, 7, 9000.0, "2026-08-15", "u", 9, 1)],
        "listing_id string, name string, town string, bedrooms int, bathrooms double, rating double,"
        "review_count int, nights int, total_price double, check_in string, url string, beds int, pos int")
    tables = report.stays_report(
        rows, ["pos"], top_n=12, honorable_n=4, min_reviews=5, check_ins=["2026-08-15"]
    )
    assert tables["top_picks"].columns == fv.STAYS_REPORT
    assert tables["top_picks"].collect()[0]["7-Night Total"] == 9000.0
    assert tables["honorable_mentions"].count() == 0
