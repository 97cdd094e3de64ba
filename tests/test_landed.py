"""Landing folders by request key: what a search opens, and when it stops."""

import datetime as dt
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from listinglake import fixed_values as fv
from listinglake import schemas
from listinglake.operators.dedupe import dedupe_first, dedupe_later_pages
from listinglake.operators.paging import cap_in_page_order
from listinglake.operators.topk import cap
from listinglake.plans import landed as plans
from listinglake.plans.normalize import search_tables
from listinglake.sources import landing as sources_landing
from listinglake.sources.landing import newest_landed
from listinglake.sources.landing_store import (
    area_key, asked, read_landing, stretch_of, stretches, write_landing,
)
from listinglake.sources.sinks import write_silver

DAY = dt.date(2026, 8, 15)


def card(i, beds=4):
    return (
        f'<div class="sos-property-card" data-property-url="https://h/property/{i}?a=1">'
        f'<div class="sos-property-card_name">Pelican - #{i}</div>'
        '<div class="sos-property-card__details"><p class="mb-0"><small>'
        '<span class="small sos-letter-spc-1">BED</span></small><br/>'
        f'<span class="text-primary fw-bold"> {beds} </span></p></div></div>'
    )


def response(source, area, page, body, check_in=None, nights=None, param="villages"):
    return (
        source, "search", None, {param: area}, check_in, nights, page, 200, None, body,
    )


@pytest.fixture
def store(spark, tmp_path):
    def make(*rows):
        write_landing(spark.createDataFrame(rows, schemas.RESPONSES), str(tmp_path / "landing"))
        return read_landing(spark, str(tmp_path / "landing"))

    make.path = tmp_path / "landing"
    return make


def plan_of(df):
    explain = df.sparkSession._jvm.PythonSQLUtils.explainString
    return explain(df._jdf.queryExecution(), "formatted")


def test_stretches_double(spark):
    pages = [None, -1, 0, 1, 2, 3, 4, 7, 8, 1023, 1024, 2**31 - 1]
    df = spark.createDataFrame([(p,) for p in pages], "page int")
    assert [r[0] for r in df.select(stretch_of(F.col("page"))).collect()] == [
        0, 0, 0, 0, 1, 1, 2, 2, 3, 9, 10, 30,
    ]


def test_free_text_shares_folders(spark):
    words = [f"search {i}" for i in range(2000)] + [" Search 5 "]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    keys = [r[0] for r in df.select(area_key(fv.CREXI, F.col("w"))).collect()]
    assert len(set(keys)) <= 256 and keys[5] == keys[-1]


def test_only_the_asked_folder_is_opened(spark, store):
    landing = store(
        response(fv.SURFORSOUND, "Avon", 1, card(1), DAY),
        response(fv.SURFORSOUND, "avon", 1, card(2), None),
        response(fv.SURFORSOUND, "buxton", 1, card(3), DAY),
        response(fv.TWIDDY, "duck", 1, "{}", None, param="town"),
    )
    folder = asked(landing, fv.SURFORSOUND, area="avon", check_in="2026-08-15")
    filters = plan_of(folder).split("PartitionFilters: [")[-1].split("]")[0]
    for part in ("source", "kind", "area", "check_in"):
        assert part in filters
    assert "avon" in filters
    assert [r["body"] for r in folder.collect()] == [card(1)]
    assert [r["body"] for r in asked(landing, fv.SURFORSOUND, area="avon", check_in="").collect()] == [card(2)]
    assert asked(landing, fv.SURFORSOUND).count() == 3
    # The parse sees the scan's rows and no others.
    rows = plans.search_village(landing, "AVON", check_in="2026-08-15").rows
    assert [r["listing_id"] for r in rows.collect()] == [1]


def village_pages(rng, pages, repeats=0.3):
    known = list(range(1, pages * 4))
    out = []
    for page in range(1, pages + 1):
        ids = [rng.choice(known) for _ in range(rng.randrange(1, 5))]
        if rng.random() < repeats:
            ids.append(ids[0])
        out.append([(i, i % 7) for i in ids])
    return out


def plain_village(pages, n, least, strict):
    seen, rows = set(), []
    for number, page in enumerate(pages):
        for i, beds in page:
            if i in seen and (number or strict):
                continue
            seen.add(i)
            rows.append((i, beds))
    return [i for i, beds in rows if beds >= least][:n]


@pytest.mark.parametrize("n,least,strict", [(5, 0, False), (12, 3, True), (500, 2, False), (0, 0, False)])
def test_village_search_equals_the_cap_over_all_pages(store, n, least, strict):
    pages = village_pages(random.Random(n), 21)
    landing = store(
        *[
            response(fv.SURFORSOUND, "frisco", at + 1, "".join(card(i, b) for i, b in page), DAY)
            for at, page in enumerate(pages)
        ],
        response(fv.SURFORSOUND, "waves", 1, card(900), DAY),
    )
    found = plans.search_village(landing, "frisco", least, n, "2026-08-15", strict)
    rows = found.rows.collect()
    assert [r["listing_id"] for r in rows] == plain_village(pages, n, least, strict)
    assert found.summary.collect()[0]["total_returned"] == len(rows)
    with pytest.raises(ValueError, match="negative"):
        plans.search_village(landing, "frisco", max_results=-1)
    assert plans.search_village(landing, "buxton").rows.count() == 0


@pytest.mark.parametrize("whole", [False, True])
def test_reading_stops_when_there_are_enough(spark, whole):
    rng = random.Random(4)
    rows = [(p, i, rng.randrange(60), rng.random()) for p in range(1, 64) for i in range(3)]
    df = spark.createDataFrame(rows, "page int, pos int, listing_id int, price double").withColumn(
        "stretch", stretch_of(F.col("page"))
    )
    once = dedupe_later_pages(df) if whole else dedupe_first(df, ["listing_id"])
    for n, steps in ((2, 2), (9, 4), (1000, 6)):
        read = []

        def rows_of(s):
            read.append(s)
            return df.filter(F.col("stretch") == s)

        got = cap_in_page_order(
            rows_of, list(range(6)), n, ["listing_id"], lambda x: x.filter("price < 0.6"), whole
        )
        want = cap(once.filter("price < 0.6"), n)
        assert got.collect() == want.collect()
        assert read == list(range(len(read))) and len(read) <= steps


def stay_body(ids):
    import base64
    import json

    found = [
        {
            "demandStayListing": {"id": base64.b64encode(f"DemandStayListing:{i}".encode()).decode()},
            "structuredContent": {"primaryLine": [{"body": f"{i % 5} bedrooms"}]},
            "structuredDisplayPrice": {"primaryLine": {"price": f"${100 + i}"}},
        }
        for i in ids
    ]
    state = {"niobeClientData": [["k", {"data": {"presentation": {"staysSearch": {"results": {"searchResults": found}}}}}]]}
    return f'<script id="data-deferred-state-0" type="application/json">{json.dumps(state)}</script>'


def test_stays_by_static_and_by_looked_up_dates(spark, store, tmp_path):
    days = [DAY + dt.timedelta(days=7 * i) for i in range(5)]
    landing = store(
        *[
            response(fv.STAYS, None, page, stay_body(range(20 * page, 20 * page + 6)), day, 3)
            for day in days
            for page in (1, 2, 3)
        ],
        response(fv.STAYS, None, 1, stay_body([7]), days[1], 4),
    )
    one = plans.search_stays_landed(landing, check_in="2026-08-22", nights=3, min_bedrooms=2, max_results=4)
    assert [r["listing_id"] for r in one.rows.collect()] == ["22", "23", "24", "42"]
    assert {r["check_in"] for r in one.rows.collect()} == {"2026-08-22"}

    spark.createDataFrame([(days[1], 3), (days[3], 3), (days[3], 3), (days[4], 9)], "check_in date, nights int").write.parquet(
        str(tmp_path / "dates")
    )
    dates = spark.read.parquet(str(tmp_path / "dates"))
    many = plans.search_stays_on_asked_dates(landing, dates, 3, max_results=5).rows
    assert "dynamicpruning" in plan_of(many)
    got = many.collect()
    # Ties in price go to the earlier date.
    assert [(r["listing_id"], r["check_in"]) for r in got] == [
        (str(20 + i), days[1].isoformat()) for i in range(5)
    ]
    none = dates.filter("nights = 77")
    assert plans.search_stays_on_asked_dates(landing, none, 77).rows.count() == 0
    with pytest.raises(ValueError, match="nights"):
        plans.search_stays_on_asked_dates(landing, dates, 0)


def test_towns_are_read_from_their_folder(store):
    landing = store(
        response(fv.SUNREALTY, "Carova / 4x4 Beaches", 1, '{"response": {"docs": [{"item_id": "8", "is_nid$field_beds": "5"}]}}', param="town"),
        response(fv.SUNREALTY, "Duck", 1, '{"response": {"docs": [{"item_id": "9"}]}}', param="town"),
        response(fv.TWIDDY, "duck", 1, '{"results": [{"propertyId": "3", "town": "elsewhere", "bedrooms": "6 beds"}]}', param="town"),
        response(fv.CAROLINADESIGNS, "duck", 1, '{"Results": [{"Propid": "55", "Propname": "Gull", "Bedrooms": 2}]}', param="town"),
    )
    sun = plans.search_sunrealty_town(landing, "4X4", 5)
    assert [r["listing_id"] for r in sun.rows.collect()] == ["8"]
    assert sun.summary.collect()[0]["search_area"].startswith("Carova / 4x4 Beaches")
    # What a site answers for a town belongs to it, whatever the row says.
    assert [r["town"] for r in plans.search_twiddy_town(landing, "duck", 6).rows.collect()] == ["elsewhere"]
    assert plans.search_carolinadesigns_town(landing, "duck", 3).rows.count() == 0
    assert [r["listing_id"] for r in plans.search_carolinadesigns_town(landing, "duck").rows.collect()] == ["55"]
    with pytest.raises(ValueError, match="Unknown town"):
        plans.search_sunrealty_town(landing, "atlantis")


def test_a_large_folder_is_written_by_many_tasks(spark, tmp_path):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "32k")
    try:
        rows = spark.range(0, 20000, 1, 24).select(
            F.col("id").alias("listing_id"),
            F.when(F.col("id") % 10 == 0, F.concat(F.lit("t"), F.col("id") % 7)).otherwise("hot").alias("town"),
            F.sha2(F.col("id").cast("string"), 256).alias("name"),
        )
        write_silver(rows, str(tmp_path / "silver"), "x")
    finally:
        spark.conf.set(key, before)
    files = {
        p.name: len(list(p.glob("*.parquet"))) for p in Path(tmp_path / "silver" / "source=x").iterdir()
    }
    assert files["town=hot"] >= 10
    # A small folder may share a task with it, and is then written by those that do.
    assert all(n <= files["town=hot"] for n in files.values())
    assert spark.read.parquet(str(tmp_path / "silver")).count() == 20000


def fetches(*rows):
    """(page, fetched day, status, body) of one request's pages."""
    return [
        (fv.SURFORSOUND, "search", None, {"villages": "avon"}, DAY, None, page, status,
         None if day is None else dt.datetime(2026, 1, day), body)
        for page, day, status, body in rows
    ]


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_old_fetches_go_before_bodies_are_read(spark, store):
    landing = store(*fetches(
        (1, 3, 200, card(1)), (1, 5, 200, card(2)), (1, 7, 503, "gone"),  # a newer failure does not count
        (2, None, 200, card(3)), (2, 1, 200, card(4)),  # a known time comes before none
        (3, 4, 500, "a"), (3, 6, 500, "b"),  # the newest of those that all failed
        (4, 2, 200, card(5)), (4, 2, 200, card(5)),  # twins
        (5, 2, 200, card(6)),
    ))
    folder = asked(landing, fv.SURFORSOUND, area="avon", check_in="2026-08-15")
    left = newest_landed(folder, "search")
    assert sorted((r["page"], r["body"]) for r in left.collect()) == [
        (1, card(2)), (2, card(4)), (3, "b"), (4, card(5)), (5, card(6)),
    ]
    # The old fetches are few, so they are sent to the tasks; no response is shuffled.
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and plan.count("Exchange") == plan.count("BroadcastExchange")
    tables = search_tables(folder, fv.SURFORSOUND)
    assert sorted(r["listing_id"] for r in tables.rows.collect()) == [2, 4, 5, 6]
    assert [(r["page"], r["drift"]) for r in tables.quarantine.collect()] == [(3, "HTTP status 500")]


def test_many_old_fetches_shuffle_no_body(spark, store, monkeypatch):
    rows = [(p, d, 200, card(p * 10 + d)) for p in range(1, 400) for d in (1, 2, 3)]
    landing = asked(store(*fetches(*rows)), fv.SURFORSOUND)
    monkeypatch.setattr(sources_landing, "BLOCK_ROWS", 128)  # several blocks a file
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")  # as with more old fetches than the planner sends by itself
    try:
        for sent in (0, 1_000_000):
            monkeypatch.setattr(sources_landing, "SENT_REQUESTS", sent)
            left = newest_landed(landing, "search")
            plan = left._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" not in plan
            assert plan.count("Exchange") == plan.count("BroadcastExchange")
            got = sorted((r["page"], r["body"]) for r in left.collect())
            assert got == [(p, card(p * 10 + 3)) for p in range(1, 400)]
    finally:
        spark.conf.set(key, before)


def test_nothing_is_shuffled_when_all_landed_once(spark, store):
    landing = store(*fetches(*[(p, 1, 200, card(p)) for p in range(1, 9)]))
    folder = asked(landing, fv.SURFORSOUND)
    assert exchanges(newest_landed(folder, "search")) == 0
    rows = search_tables(folder, fv.SURFORSOUND).rows
    assert exchanges(rows) == 0 and rows.count() == 8
    # What was read from a landing folder can be landed again.
    write_landing(folder, str(store.path) + "-copy")
    assert read_landing(spark, str(store.path) + "-copy").count() == 8
