"""Jobs that read their input once: the health report, and repeats on later pages."""

import datetime as dt
import json
import random
import re

from pyspark.sql import functions as F

from listinglake import fixed_values as fv
from listinglake import schemas
from listinglake.operators.dedupe import dedupe_later_pages
from listinglake.plans import health
from listinglake.sources.landing_store import read_landing, write_landing


def row(source, kind, body, page=1, entity=None, status=200):
    return (source, kind, entity, {"town": "duck"}, None, None, page, status, None, body)


def twiddy_search(*homes):
    return json.dumps({"results": [
        {"propertyId": i, "propertyName": n, "bedrooms": b, "town": "duck"} for i, n, b in homes]})


def stay(i, name="House"):
    return json.dumps({"Propid": str(i), "Propname": name, "NumBedrooms": "4"})


def report(df):
    return {r["name"]: (r["status"], r["summary"], r["detail"]) for r in df.collect()}


def test_health_of_landing(spark, tmp_path):
    rows = [
        row(fv.TWIDDY, "search", twiddy_search((7, "Seven", "3 beds"), (8, "", "")), 2),
        row(fv.TWIDDY, "search", "{}", 3),
        row(fv.TWIDDY, "search", "broken", 4),
        row(fv.TWIDDY, "info", '{"propertyID": 7, "name": "Seven"}', entity="7"),
        row(fv.TWIDDY, "info", "{}", entity="8"),
        row(fv.TWIDDY, "amenities", '{"bedrooms": 3}', entity="7"),
        row(fv.CAROLINADESIGNS, "search", json.dumps({"Results": [{"Propid": "5", "Propname": "Five", "Bedrooms": 3, "Baths": "2/1"}]})),
        row(fv.CAROLINADESIGNS, "details", "{}", entity="5"),
        row(fv.SUNREALTY, "search", '{"response": {}}', 1),
        row(fv.SUNREALTY, "search", '{"response": {"docs": [{"item_id": "3", "ss_name": "x"}]}}', 2),
        row(fv.CREXI, "search", '{"data": []}'),
        row(fv.REDFIN, "search", "gone", status=500),
    ]
    write_landing(spark.createDataFrame(rows, schemas.RESPONSES), str(tmp_path))
    landing = read_landing(spark, str(tmp_path))
    got = report(health.health_of_landing(landing))
    assert set(got) == set(fv.SOURCES)
    assert got[fv.TWIDDY][0] == "PASS" and got[fv.TWIDDY][2] == ["search returned 2 results", "2 responses drifted"]
    assert got[fv.CAROLINADESIGNS][:2] == ("FAIL", "details failed: missing Propid")
    assert got[fv.SUNREALTY][:2] == ("FAIL", "search failed: missing docs")
    assert got[fv.CREXI][0] == "WARN" and got[fv.STAYS][0] == "WARN"
    assert got[fv.REDFIN][:2] == ("FAIL", "search failed: HTTP status 500")
    # One home without a detail row, and a first row that lacks fields.
    few = landing.filter("source = 'twiddy' and kind = 'search' and page = 2")
    assert report(health.health_of_landing(few, [fv.TWIDDY]))[fv.TWIDDY][1] == "details failed: no detail row"
    bare = spark.createDataFrame([row(fv.TWIDDY, "search", twiddy_search((8, "", "")))], schemas.RESPONSES)
    assert report(health.health_of_landing(bare, [fv.TWIDDY]))[fv.TWIDDY][1] == (
        "search result missing required fields: ['name', 'bedrooms']")


def scans(df, column="page"):
    """Scans of files that read the column."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(rf"FileScan parquet \[[^\]]*\b{column}#", plan))


def test_each_folder_is_read_once_for_health(spark, tmp_path):
    rows = [row(fv.CAROLINADESIGNS, "search", "{}"), row(fv.TWIDDY, "info", "{}", entity="1")]
    write_landing(spark.createDataFrame(rows, schemas.RESPONSES), str(tmp_path))
    landing = read_landing(spark, str(tmp_path))
    # The searches: one scan a source, rows and drifted responses in one.
    probe = health._probe_rows(landing, fv.CAROLINADESIGNS, "search", ["listing_id"])
    assert scans(probe, "body") == 1
    # The details: one scan for each kind of response.
    whole = health.health_of_landing(landing, [fv.CAROLINADESIGNS, fv.TWIDDY])
    assert scans(whole, "body") == 1 + 3


def test_health_parses_the_details_it_may_need_only(spark, tmp_path):
    def info(n, **other):
        return json.dumps({"propertyID": n, "name": f"Home {n}", **other})

    def asset(n):
        return row(fv.CREXI, "details", json.dumps({"name": f"A{n}"}), entity=str(n))

    old = (fv.CAROLINADESIGNS, "details", "5", None, None, None, 1, 200, dt.datetime(2026, 1, 1), stay(5))
    # The newest fetch counts, though it has lost the id.
    new = (*old[:8], dt.datetime(2026, 1, 2), "{}")
    escaped = '{"Propid": "\\u0035", "Propname": "Five", "NumBedrooms": "4"}'
    rows = [
        row(fv.TWIDDY, "search", twiddy_search((7, "Seven", "3 beds"))),
        *[row(fv.TWIDDY, "info", info(n), entity=str(n)) for n in (6, 8, 77)],
        row(fv.TWIDDY, "info", info(7), entity="https://h/seven"),  # the id is inside only
        row(fv.TWIDDY, "amenities", '{"bedrooms": 3}', entity="https://h/seven"),
        row(fv.CREXI, "search", '{"data": [{"id": "3", "name": "x", "locations": [{"city": "a", "state": "TX"}]}]}'),
        *[asset(n) for n in (1, 2, 3, 33)],
        row(fv.CAROLINADESIGNS, "search", json.dumps({"Results": [{"Propid": "5", "Propname": "Five", "Bedrooms": 3, "Baths": "2/1"}]})),
        *[row(fv.CAROLINADESIGNS, "details", stay(n), entity=str(n)) for n in (1, 2, 3)],
    ]

    def judged(name, *more):
        path = str(tmp_path / name)
        write_landing(spark.createDataFrame([*rows, *more], schemas.RESPONSES), path)
        landing = read_landing(spark, path)
        return landing, report(health.health_of_landing(landing))

    landing, got = judged("a", old, new)
    assert got[fv.TWIDDY][0] == got[fv.CREXI][0] == "PASS"
    assert got[fv.CAROLINADESIGNS][1] == "details failed: missing Propid"
    _, got = judged("b", row(fv.CAROLINADESIGNS, "details", escaped, entity="/five"))
    assert got[fv.CAROLINADESIGNS][0] == "PASS"

    def left(source, wanted):
        one = spark.createDataFrame([(wanted,)], "id string")
        found = health._details_of(landing, source, one)
        return sorted(r["entity_id"] for r in found.collect())

    assert left(fv.CREXI, "3") == ["3"] and left(fv.CREXI, None) == []
    assert left(fv.TWIDDY, "8") == ["8", "https://h/seven", "https://h/seven"]
    assert left(fv.CAROLINADESIGNS, "2") == ["2"]
    assert left(fv.CAROLINADESIGNS, "x") == ["1", "2", "3", "5"]  # not digits: all are parsed


def test_health_compares_whole_ids_before_it_parses(spark):
    def page(n, **other):
        return json.dumps({"Propid": n, "NumBedrooms": "7", "MinPrice": 7, **other})

    bodies = {
        "text": page("7"), "number": page(7), "single": "{'Propid' : '7'}", "longer": page("17"),
        "inner": page("1", Sidebar=[{"Propid": "7"}]), "elsewhere": page("8", CanonicalUrl="https://c/7"),
        "escaped": '{"Prop\\u0069d": "7"}',
    }
    homes = {
        "item": '<p>7</p><script>{"item_id" : "7"}</script>', "eid": '{"eid": 7, "n": 9}',
        "other": '<p>7</p>{"item_id": "8", "eid": 7}', "longer": '{"item_id": "17"}', "7": "<p>gone</p>",
    }
    rows = [row(fv.CAROLINADESIGNS, "details", body, entity=name) for name, body in bodies.items()]
    rows += [row(fv.SUNREALTY, "details", body, entity=name) for name, body in homes.items()]
    landing = spark.createDataFrame(rows, schemas.RESPONSES).withColumn("chosen", F.lit(True))
    wanted = spark.createDataFrame([("7",)], "id string")

    def left(source):
        return {r["entity_id"] for r in health._details_of(landing, source, wanted).collect()}

    assert left(fv.CAROLINADESIGNS) == {"text", "number", "single", "inner", "escaped"}
    assert left(fv.SUNREALTY) == {"item", "eid", "7"}


def test_landed_bodies_are_packed(spark, tmp_path, monkeypatch):
    import pyarrow.parquet as pq

    from listinglake.workload import health as job

    def searches(spark, sf):
        rows = [row(fv.TWIDDY, "search", twiddy_search((n, "Home", "3 beds")), n) for n in range(3)]
        return spark.createDataFrame(rows, schemas.RESPONSES)

    monkeypatch.setattr(job, "SEARCHES", {fv.TWIDDY: searches})
    monkeypatch.setattr(job, "DETAILS", {})
    monkeypatch.setattr(job, "checkpoint_dir", lambda spark: str(tmp_path))
    landing = job.landed(spark, "")
    # Page 0 becomes the last one.
    assert {(r["page"], r["body"]) for r in landing.collect()} == {
        (n or 2**31 - 1, twiddy_search((n, "Home", "3 beds"))) for n in range(3)}
    files = list(tmp_path.rglob("*.parquet"))
    body = pq.ParquetFile(files[0]).metadata.row_group(0).to_dict()["columns"]
    assert files and {c["compression"] for c in body} == {"ZSTD"}


def plain(rows):
    seen, out = set(), []
    for page, pos, key, at in sorted(rows):
        if page <= 1 or (at, key) not in seen:
            out.append((page, pos, key, at))
        seen.add((at, key))
    return sorted(out)


def test_later_pages_add_unseen_ids_in_one_pass(spark, tmp_path):
    rng = random.Random(2)
    rows = {(rng.randrange(1, 6), i, 0 if rng.random() < 0.4 else rng.randrange(40), rng.choice("ab")) for i in range(900)}
    rows |= {(1, 2000 + i, 0, "a") for i in range(200)} | {(3, 5000, None, "a"), (4, 5001, None, "a"), (0, 5002, 77, "b")}
    spark.createDataFrame(sorted(rows, key=repr), "page int, pos int, listing_id int, town string").write.parquet(str(tmp_path / "x"))
    df = spark.read.parquet(str(tmp_path / "x"))
    for slices in (1, 7, 64):
        got = dedupe_later_pages(df, within=["town"], slices=slices)
        assert got.columns == df.columns and scans(got) == 1
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain_any(rows), key=repr)


def plain_any(rows):
    """``plain`` for rows whose key may be null; null is a key like any other."""
    filled = [(p, i, -1 if k is None else k, t) for p, i, k, t in rows]
    return [(p, i, None if k == -1 else k, t) for p, i, k, t in plain(filled)]


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_details_are_chosen_by_name_and_fetched_once(spark):
    from listinglake.operators.joins import join_unique
    from listinglake.plans.details import find_all_details

    rows = [("1", "https://h/a", "x"), (None, "https://h/b/", "y"), ("3", None, "z")]
    details = spark.createDataFrame(rows, "listing_id string, url string, name string")
    asked = spark.createDataFrame([("https://h/a/",), ("https://h/b",), ("3",), ("9",)], "identifier string")
    found = find_all_details(asked, details, fv.SUNREALTY)
    assert "_detail" not in "".join(
        line for line in _plan(found).splitlines() if "min_by" in line
    )
    got = sorted((r["identifier"], r["found_by"], r["name"]) for r in found.collect())
    assert got == [("3", "id", "z"), ("https://h/a/", "url", "x"), ("https://h/b", "url", "y")]
    few = spark.createDataFrame([("3", 1)], "listing_id string, v int")
    joined = join_unique(details, few, "listing_id")
    assert "SortMergeJoin" in joined._jdf.queryExecution().sparkPlan().toString()


def test_child_tables_read_written_lists(landed):
    from listinglake.plans.children import child_tables
    from listinglake.plans.normalize import detail_tables

    info = '{"propertyID": "5", "name": "n", "exteriorImage": "https://e/5"}'
    more = '{"sectionModel": {"featuredAmenities": [{"displayLabel": "Pool"}]}}'
    given = landed(
        (fv.TWIDDY, "info", info, {"entity_id": "5"}), (fv.TWIDDY, "amenities", more, {"entity_id": "5"})
    )
    tables = child_tables({fv.TWIDDY: detail_tables(given, fv.TWIDDY).rows})
    assert all("from_json" not in _plan(t) and "parquet" in _plan(t) for t in tables.values())
    assert [tuple(r) for r in tables["images"].collect()] == [(fv.TWIDDY, "5", 0, "https://e/5")]
    assert [tuple(r) for r in tables["amenities"].collect()] == [(fv.TWIDDY, "5", 0, "Pool", True)]
    assert tables["weekly_rates"].collect() == []


def test_nodes_of_few_pages_are_python_objects_at_a_time(spark, monkeypatch):
    from listinglake.functions import html

    class Counting(html._NodeTable):
        size = 0

        def add_page(self, page):
            self.size += len(page)
            assert self.size <= 300, "too many pages at once"
            super().add_page(page)

    monkeypatch.setattr(html, "SLICE_BYTES", 200)
    monkeypatch.setattr(html, "_NodeTable", Counting)
    texts = [None if n % 7 == 0 else f"<p>{n}<b>{'x' * (n % 50)}</b></p>" for n in range(100)]
    given = spark.createDataFrame(list(enumerate(texts)), "n int, body string").coalesce(1)
    nodes = given.select("n", html.html_nodes(F.col("body"), ["class"]).alias("nodes"))
    for n, found in nodes.collect():
        assert (found is None) == (n % 7 == 0)
        if found is not None:
            assert [x["tag"] for x in found][:3] == ["p", "#text", "b"]
            assert found[0]["end"] == len(found) and found[1]["text"] == str(n)


def test_records_are_ranked_only_where_requests_repeat(landed):
    from listinglake.plans.normalize import search_tables

    def page(n, price):
        home = f'{{"propertyId": {n}, "propertyName": "{price}"}}'
        return (fv.TWIDDY, "search", f'{{"results": [{home}]}}')

    once = [(*page(n, "a"), {"params": {"town": "duck"}, "page": n}) for n in (1, 2, 3)]
    rows = search_tables(landed(*once), fv.TWIDDY).rows
    assert "row_number" not in _plan(rows)
    assert sorted(r["listing_id"] for r in rows.collect()) == [1, 2, 3]

    again = (*page(2, "b"), {"params": {"town": "duck"}, "page": 2, "http_status": 503})
    rows = search_tables(landed(*once, again), fv.TWIDDY).rows
    assert "row_number" in _plan(rows) and "LeftAnti" in _plan(rows)
    assert sorted((r["listing_id"], r["name"]) for r in rows.collect()) == [(1, "a"), (2, "a"), (3, "a")]


def test_many_repeated_requests_are_ranked_at_once(landed, monkeypatch):
    from listinglake.plans.normalize import search_tables
    from listinglake.sources import landing

    monkeypatch.setattr(landing, "SENT_REQUESTS", 0)
    row = (fv.TWIDDY, "search", '{"results": [{"propertyId": 7}]}', {"page": 1})
    rows = search_tables(landed(row, row), fv.TWIDDY).rows
    assert "LeftAnti" not in _plan(rows)
    assert [r["listing_id"] for r in rows.collect()] == [7]


def test_bodies_of_failed_fetches_are_not_parsed(landed):
    from listinglake.plans.normalize import search_tables

    row = (fv.TWIDDY, "search", '{"results": [{"propertyId": 7}]}', {"page": 1})
    failed = (*row[:3], {"page": 2, "http_status": 503})
    tables = search_tables(landed(row, failed), fv.TWIDDY)
    assert re.search(r"from_json\([^\n]*CASE WHEN coalesce\(\(\(http_status", _plan(tables.rows))
    assert [r["listing_id"] for r in tables.rows.collect()] == [7]
    assert [r["drift"] for r in tables.quarantine.collect()] == ["HTTP status 503"]


def stay_page(data):
    state = json.dumps({"niobeClientData": [["k", {"data": data}]]})
    return (
        "<html><script>var x = 1;</script>"
        f'<script id="data-deferred-state-0" type="a">{state}</script><p>x</p><script>y</script></html>'
    )


def odd_stays():
    """Pages whose fields have other types than they should, or come twice."""
    rng = random.Random(7)
    photos = [{"baseUrl": "https://1"}, {"baseUrl": ""}, {"baseUrl": 5}, "x", None, {"baseUrl": {"a": 1}}]
    values = [
        "x", 5, 1.5, None, True, [], {}, [1, {"title": "t"}], {"title": ["t"]}, [[{"amenities": 3}]],
        [{"amenities": [{"title": "Wifi", "available": "no"}, {"title": "TV", "available": True}]}],
    ]
    names = ["title", "lat", "seeAllAmenitiesGroups", "cardData", "ratings", "houseRules", "overallRating"]
    for n in range(120):
        sections = []
        for kind in rng.sample(["HERO_DEFAULT", "HERO_DEFAULT", "AMENITIES_DEFAULT", "LOCATION_DEFAULT", "", None, 7], 5):
            section = {name: rng.choice(values) for name in rng.sample(names, 4)}
            if kind == "HERO_DEFAULT":
                items = list(section.items()) + [("previewImages", rng.choice([rng.sample(photos, 3), rng.choice(values)]))]
                rng.shuffle(items)
                section = dict(items)
            sections.append({"sectionId": kind, "section": rng.choice([section, section, section, "x", [section], None])})
        stops = [{"items": [{"image": {"uri": f"https://t{n}"}}, {"image": rng.choice(values)}]}, rng.choice(values)]
        state = {
            "presentation": {"stayProductDetailPage": {"sections": {"sections": sections}}},
            "node": {"pdpPresentation": {"mediaTour": {"stops": rng.choice([stops, None])}}},
        }
        if n % 17 == 0:
            state["presentation"]["stayProductDetailPage"]["sections"]["sections"] = rng.choice([None, "x", []])
        yield stay_page(state)


def test_images_of_stays_are_the_same_without_other_fields(landed):
    from listinglake.plans.normalize import detail_tables

    pages = [*odd_stays(), "<p>gone</p>", '<script id="data-deferred-state-0">{']
    given = landed(*[
        (fv.STAYS, "details", page, {"entity_id": str(n), "http_status": 500 if n == 9 else 200})
        for n, page in enumerate(pages)
    ])
    whole = detail_tables(given, fv.STAYS)
    lists = ["image_urls", "amenities", "unavailable_amenities"]

    def taken(rows, columns):
        return sorted((tuple(r) for r in rows.select("listing_id", *columns).collect()), key=repr)

    for columns in (["image_urls"], lists):
        few = detail_tables(given, fv.STAYS, columns)
        assert few.rows.columns == ["listing_id", *columns, "page", "pos"]
        assert taken(few.rows, columns) == taken(whole.rows, columns)
        assert few.quarantine.count() == whole.quarantine.count() > 2
    assert sum(len(images) for _, images in taken(whole.rows, ["image_urls"])) > 30
    assert detail_tables(given, fv.STAYS, ["image_urls", "title"]).rows.columns == whole.rows.columns


def test_child_images_parse_no_other_fields(spark, tmp_path):
    from listinglake.workload import children as job

    orders = "o_orderkey bigint, o_orderpriority string, o_totalprice double, o_orderstatus string"
    parts = "p_partkey bigint, p_name string, p_retailprice double, p_type string"
    spark.createDataFrame([(n, "1-URGENT", 2.5, "F") for n in (1, 2, 58, 87)], orders).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(n, "tin bolt", 2.5, "STEEL") for n in (1, 2, 19, 31)], parts).write.parquet(f"{tmp_path}/part.parquet")
    rows = job.child_images(spark, str(tmp_path))
    # The bodies are made in the same plan; their schemas do not count.
    parsed = re.sub(r"StructsToJsonEvaluator\(.*?\)\.evaluate\(", "", _plan(rows))
    # Of stays, redfin, crexi (assets and brokers), twiddy (calendars), surforsound and sunrealty.
    for field in ("lat", "agentName", "marketingDescription", "lastName", "weekContent", "formattedRate", "avail"):
        assert f"StructField({field}," not in parsed, field
    assert "StructField(previewImages," in parsed
    got = {(r["source"], r["listing_id"], r["pos"], r["url"]) for r in rows.collect() if r["listing_id"].endswith("2")}
    assert got == {
        (fv.STAYS, "2", 0, "https://i/2"), (fv.STAYS, "2", 1, "https://i/a"), (fv.STAYS, "2", 2, "https://i/b2"),
        (fv.CAROLINADESIGNS, "2", 0, "https://i/2"),
        (fv.CHURCHREALTY, "hall-for-sale-2", 0, "https://1/2"), (fv.CHURCHREALTY, "hall-for-sale-2", 1, "https://2"),
        (fv.REDFIN, "2", 0, "https://f/2"), (fv.REDFIN, "2", 1, "https://s/1"),
        (fv.SUNREALTY, "2", 0, "https://i.rezfusion.com/2"), (fv.SUNREALTY, "2", 1, "https://i.rezfusion.com/z"),
        (fv.SURFORSOUND, "2", 0, "https://www.surforsound.com/media/2.jpg?w=1"), (fv.SURFORSOUND, "2", 1, "https://x/media/2.jpg"),
        (fv.TWIDDY, "2", 0, "https://e/2"),
    }


def test_texts_of_attributes_are_read_once_within_bounds(spark, monkeypatch):
    from listinglake.functions import html

    monkeypatch.setattr(html, "KNOWN_TEXTS", 3)
    calls = []
    read = html._NodeTable._read
    monkeypatch.setattr(html._NodeTable, "_read", lambda self, text: calls.append(text) or read(self, text))
    table = html._NodeTable(("class", "src"), False)
    for n in range(50):
        table.add_page(f"<p class=' a  b '>{n}<img SRC=x{n} alt='class'/></p><b title='src'>t</b>")
    assert len(table.known) == 3 and calls.count(" class=' a  b '") == 1
    assert [list(v)[:5] for v in table.values()] == [["a b", None, None, None, None], [None, None, "x0", None, None]]
    assert table.i[:5] == [0, 1, 2, 3, 4] and table.end[:5] == [3, 2, 3, 5, 5]
