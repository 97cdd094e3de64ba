"""Payload -> record, for the sources that answer in JSON."""

import base64
import datetime as dt
import json

import pytest

from listinglake import fixed_values as fv
from listinglake.plans.normalize import child_tables, detail_tables, search_tables
from listinglake.sources import twiddy


def only(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def drift(tables):
    return [r["drift"] for r in tables.quarantine.collect()]


def stay_page(state) -> str:
    text = json.dumps(state)
    return (
        "<html><head></head><body><script>var x = {};</script>"
        f'<script id="data-deferred-state-0" type="application/json">{text}</script>'
        "</body></html>"
    )


def stay_result(n=417, **over):
    item = {
        "demandStayListing": {
            "id": base64.b64encode(f"DemandStayListing:{n}".encode()).decode(),
            "location": {"coordinate": {"latitude": 36.25, "longitude": -75.75}},
        },
        "structuredContent": {
            "primaryLine": [{"body": "6 bedrooms"}, {"body": "9 beds"}, {"body": "4.5 baths"}]
        },
        "structuredDisplayPrice": {
            "primaryLine": {"discountedPrice": None, "price": "$2,340", "qualifier": "total"}
        },
        "title": "Cottage in Avon",
        "subtitle": "Dune house",
        "nameLocalized": "Other name",
        "avgRatingLocalized": "4.6 (87)",
        "contextualPictures": [{"picture": "https://img/1.jpg"}, {"picture": "https://img/2.jpg"}],
    }
    item.update(over)
    return item


def stay_search(*results):
    data = {"presentation": {"staysSearch": {"results": {
        "searchResults": list(results), "paginationInfo": {"pageCursors": ["a"]}}}}}
    return stay_page({"niobeClientData": [["key", {"data": data}]]})


STAY = {"check_in": dt.date(2026, 8, 15), "nights": 5}


def test_stays_search(landed):
    t = search_tables(landed((fv.STAYS, "search", stay_search(stay_result()), STAY)), fv.STAYS)
    r = only(t.rows)
    assert (r.listing_id, r.url) == ("417", fv.STAYS_BASE + "/rooms/417")
    assert (r.name, r.property_type) == ("Dune house", "Cottage in Avon")
    assert (r.bedrooms, r.beds, r.bathrooms) == (6, 9, 4.5)
    assert (r.total_price, r.price_currency, r.price_display) == (2340.0, "$", "$2,340")
    assert (r.rating, r.review_count) == (4.6, 87)
    assert (r.latitude, r.longitude) == (36.25, -75.75)
    assert (r.check_in, r.check_out, r.nights) == ("2026-08-15", "2026-08-20", 5)
    assert r.image_url == "https://img/1.jpg"
    assert drift(t) == []


def test_stays_search_variants(landed):
    no_bath = stay_result(2, structuredContent={"primaryLine": [{"body": "Studio"}]})
    discounted = stay_result(
        3,
        structuredDisplayPrice={"primaryLine": {"discountedPrice": "€900", "price": "€950"}},
        subtitle="", avgRatingLocalized=None, contextualPictures=[],
    )
    no_id = stay_result(4, demandStayListing={"id": None})
    studio = stay_result(5, structuredContent={"primaryLine": [{"body": "Studio bedroom"}]})
    body = stay_search(no_bath, discounted, no_id, studio)
    rows = {
        r.listing_id: r
        for r in search_tables(landed((fv.STAYS, "search", body, STAY)), fv.STAYS).rows.collect()
    }
    assert set(rows) == {"2", "3", "5"}
    # "Studio" only counts as 0 bedrooms on a line about bedrooms.
    assert rows["2"].bedrooms is None and rows["2"].bathrooms is None
    assert rows["5"].bedrooms == 0
    assert (rows["3"].total_price, rows["3"].price_currency) == (900.0, "€")
    assert rows["3"].name == "Other name"
    assert rows["3"].rating is None and rows["3"].review_count is None
    assert rows["3"].image_url is None
    assert [rows[k].pos for k in "235"] == [0, 1, 3]


def test_stays_search_drift(landed):
    t = search_tables(
        landed(
            (fv.STAYS, "search", "<html>nothing</html>", STAY),
            (fv.STAYS, "search", stay_page({"niobeClientData": [["k", {"data": {}}]]}), STAY),
            (fv.STAYS, "search", "x", {**STAY, "http_status": 503}),
            (fv.STAYS, "search", stay_search(), STAY),
        ),
        fv.STAYS,
    )
    assert t.rows.count() == 0
    assert sorted(drift(t)) == [
        "HTTP status 503", "missing staysSearch.results", "page has no embedded state",
    ]


def stay_details():
    def sec(name, body):
        return {"sectionId": name, "section": body}

    sections = [
        sec("TITLE_DEFAULT", {"title": "Old"}),
        sec("TITLE_DEFAULT", {"title": "Salt box"}),
        sec("DESCRIPTION_DEFAULT", {"htmlDescription": {"htmlText": "<b>Nice</b><br/>place&nbsp;"}}),
        sec("AMENITIES_DEFAULT", {"title": {"nested": 1}, "seeAllAmenitiesGroups": [
            {"amenities": [{"title": "Wifi", "available": True}, {"title": "TV", "available": False}]},
            {"amenities": None},
            {"amenities": [{"title": "", "available": True}, {"title": "Pool", "available": True}]},
        ]}),
        sec("MEET_YOUR_HOST", {"about": "Hi", "cardData": {
            "name": "Ann", "isSuperhost": True,
            "stats": [{"type": "REVIEW_COUNT", "value": "1,234"},
                      {"type": "YEARS", "value": "9"},
                      {"type": "REVIEW_COUNT", "value": "n/a"}]}}),
        sec("REVIEWS_DEFAULT", {"overallRating": 4.88, "overallCount": 52, "isGuestFavorite": True,
            "ratings": [{"label": "Cleanliness", "localizedRating": "4.9"},
                        {"label": "Value", "localizedRating": "4.0"},
                        {"label": "Value", "localizedRating": "4.7"},
                        {"label": "", "localizedRating": "1"}]}),
        sec("LOCATION_DEFAULT", {"subtitle": "Buxton, NC", "lat": 35.25, "lng": -75.5}),
        sec("POLICIES_DEFAULT", {"houseRules": [{"title": "No smoking"}, {"title": None}],
                                 "cancellationPolicyForDisplay": "Flexible"}),
        sec("BOOK_IT_SIDEBAR", {"maxGuestCapacity": 8}),
        sec("SLEEPING_ARRANGEMENT_WITH_IMAGES", {"arrangementDetails": [
            {"title": "Bedroom 1", "subtitle": "1 queen bed"}, {"title": "", "subtitle": ""}]}),
        sec("HIGHLIGHTS_DEFAULT", {"highlights": [
            {"title": "Self check-in", "subtitle": None}, {"title": None, "subtitle": None}]}),
        sec("HERO_DEFAULT", {"previewImages": [{"baseUrl": "https://i/1"}, {"baseUrl": "https://i/2"}]}),
        sec("OTHER", None),
    ]
    data = {
        "presentation": {"stayProductDetailPage": {"sections": {"sections": sections}}},
        "node": {"pdpPresentation": {"mediaTour": {"stops": [
            {"items": [{"image": {"uri": "https://i/2"}}, {"image": {"uri": "https://i/3"}}]},
            {"items": None}, {"items": [{"image": None}]}]}}},
    }
    return stay_page({"niobeClientData": [["k", {"data": data}]]})


def test_stays_details(landed):
    t = detail_tables(
        landed((fv.STAYS, "details", stay_details(), {"entity_id": "https://h/rooms/42?x=1"})),
        fv.STAYS,
    )
    r = only(t.rows)
    assert (r.listing_id, r.url) == ("42", fv.STAYS_BASE + "/rooms/42")
    assert (r.title, r.description, r.max_guests) == ("Salt box", "Nice  place", 8)
    assert r.sleeping_arrangements == ["Bedroom 1: 1 queen bed"]
    assert (r.location_subtitle, r.latitude, r.longitude) == ("Buxton, NC", 35.25, -75.5)
    assert (r.host_name, r.host_is_superhost, r.host_is_verified) == ("Ann", True, False)
    assert (r.host_about, r.host_review_count) == ("Hi", 1234)
    assert (r.overall_rating, r.review_count, r.is_guest_favorite) == (4.88, 52, True)
    assert r.rating_breakdown == {"Cleanliness": "4.9", "Value": "4.7"}
    assert (r.amenities, r.unavailable_amenities) == (["Wifi", "Pool"], ["TV"])
    assert [tuple(h) for h in r.highlights] == [("Self check-in", None)]
    assert (r.house_rules, r.cancellation_policy) == (["No smoking"], "Flexible")
    assert r.image_urls == ["https://i/1", "https://i/2", "https://i/3"]


def test_stays_details_bare_and_drift(landed):
    bare = stay_page({"niobeClientData": [["k", {"data": {"presentation": {
        "stayProductDetailPage": {"sections": {"sections": []}}}}}]]})
    t = detail_tables(
        landed(
            (fv.STAYS, "details", bare, {"entity_id": "7"}),
            (fv.STAYS, "details", stay_page({"niobeClientData": []}), {"entity_id": "8"}),
        ),
        fv.STAYS,
    )
    r = only(t.rows)
    assert (r.title, r.description, r.amenities, r.image_urls) == ("", "", [], [])
    assert (r.sleeping_arrangements, r.highlights, r.house_rules) == ([], [], [])
    assert (r.rating_breakdown, r.host_is_superhost, r.max_guests) == ({}, False, None)
    assert drift(t) == ["missing stayProductDetailPage sections"]


def test_carolinadesigns_search(landed):
    full = {
        "Propid": " 482 ", "Propname": "MARSH WIND", "Bedrooms": 12, "Baths": "11/3",
        "PropURL": "/avon/482-marsh-wind/", "DisplayLocation": "Sound side",
        "DisplaySub": "Sub", "ImageURL": "https://i", "PetFriendly": True, "PrivatePool": None,
    }
    bare = {"Propid": "7", "Baths": None}
    body = json.dumps({"Results": [full, {"Propid": ""}, {"Propid": None}, bare], "Title": "T"})
    t = search_tables(
        landed(
            (fv.CAROLINADESIGNS, "search", body, {"params": {"town": "duck"}}),
            (fv.CAROLINADESIGNS, "search", '{"Title": "x"}'),
            (fv.CAROLINADESIGNS, "search", '{"Results": []}'),
        ),
        fv.CAROLINADESIGNS,
    )
    a, b = t.rows.orderBy("pos").collect()
    assert (a.listing_id, a.name, a.bedrooms) == ("482", "MARSH WIND", 12)
    assert a.url == fv.CAROLINADESIGNS_BASE + "/avon/482-marsh-wind/"
    assert (a.bathrooms_full, a.bathrooms_half, a.town) == (11, 3, "duck")
    assert (a.location, a.subdivision, a.pet_friendly, a.private_pool) == (
        "Sound side", "Sub", True, False)
    assert b.url == fv.CAROLINADESIGNS_BASE + "/property-detail-page/7"
    assert (b.name, b.bedrooms, b.bathrooms_full, b.bathrooms_half) == ("", None, None, None)
    assert drift(t) == ["missing Results"]


def test_carolinadesigns_details(landed):
    body = json.dumps({
        "Propid": "482", "Propname": "MARSH WIND", "Area": "Kill Devil Hills", "NumBedrooms": "12",
        "Bathroominfo": ["Full Bathrooms: 11", "Half Bathrooms: 3", None], "Sleeps": "28+",
        "Description": "<p>Big</p>", "Sidebar": [{"Items": ["Pool", ""]}, {"Items": None},
                                                 {"Items": ["Spa"]}],
        "PicsLarge": [{"ImgUrl": "https://a"}, {"ImgUrl": ""}, None],
        "Weeks1CurrAvail": [
            {"ArrivalDate": "6/6/2026", "Rate": "$8,210.00", "CostPerNight": "$1,172.00", "BookType": "NORM"},
            {"ArrivalDate": "6/20/2026", "Rate": "$0.00", "CostPerNight": "Booked", "BookType": ""}],
        "Weeks2CurrAvail": None, "MinPrice": 8210, "MaxPrice": 17500,
    })
    t = detail_tables(
        landed(
            (fv.CAROLINADESIGNS, "details", body, {"entity_id": "482"}),
            (fv.CAROLINADESIGNS, "details", "{}", {"entity_id": "9"}),
        ),
        fv.CAROLINADESIGNS,
    )
    r = only(t.rows)
    assert r.url == fv.CAROLINADESIGNS_BASE + "/property-detail-page/482"
    assert (r.town, r.bedrooms, r.bathrooms_full, r.bathrooms_half, r.sleeps) == (
        "kill-devil-hills", 12, 11, 3, 28)
    assert (r.description, r.amenities, r.image_urls) == ("Big", ["Pool", "Spa"], ["https://a"])
    assert [tuple(w) for w in r.weekly_rates] == [
        ("6/6/2026", "$8,210.00", "$1,172.00", "NORM"), ("6/20/2026", None, "Booked", None)]
    assert (r.min_price, r.max_price) == (8210, 17500)
    assert drift(t) == ["missing Propid"]
    weeks = child_tables(t.rows, fv.CAROLINADESIGNS)["weekly_rates"].collect()
    assert [(w.listing_id, w.pos, w.weekly_rate) for w in weeks] == [
        ("482", 0, "$8,210.00"), ("482", 1, None)]


def crexi_item(i=1, **over):
    return {
        "id": i, "name": "Plaza", "urlSlug": "plaza-main", "askingPrice": 1250000.5,
        "squareFootage": 8000, "types": ["Retail", "Office"], "thumbnailUrl": "https://t",
        "locations": [{"address": "1 Main", "city": "Atlanta", "state": {"code": "GA"}, "zip": "30301"}],
        **over,
    }


def test_crexi_search(landed):
    body = json.dumps({"data": [
        crexi_item(), crexi_item(2, urlSlug=None, locations=[], types=[], askingPrice=None),
        crexi_item(3, locations=[{"city": "Dallas", "state": "TX"}]),
        crexi_item(4, locations=[{"city": "Dallas", "state": None}])], "totalCount": 4})
    t = search_tables(
        landed(
            (fv.CREXI, "search", body), (fv.CREXI, "search", '{"data": {"a": 1}}'),
            (fv.CREXI, "search", '{"x": 1}'), (fv.CREXI, "search", '{"data": [{"name": "n"}]}'),
        ),
        fv.CREXI,
    )
    a, b, c, d = t.rows.orderBy("pos").collect()
    assert (a.listing_id, a.url) == ("1", fv.CREXI_BASE + "/properties/plaza-main/1")
    assert (a.address, a.city, a.state, a.zip) == ("1 Main", "Atlanta", "GA", "30301")
    assert (a.price, a.property_type, a.building_sqft) == (1250000.5, "Retail, Office", 8000)
    assert (b.url, b.address, b.state, b.property_type, b.price) == ("", "", "", "", None)
    assert (c.state, d.state) == ("TX", "")
    assert sorted(drift(t)) == ["missing data list", "missing data list", "missing id"]


def test_crexi_details_with_side_lists(landed):
    asset = {
        "urlSlug": "plaza", "name": "Plaza", "marketingDescription": "", "description": "<p>A&nbsp;b c</p>",
        "types": ["Land"], "askingPrice": 5, "details": {"Lot Size (acres)": "1,234.5",
        "Year Renovated": "1990", "Square Footage": "12,000"},
        "summaryDetails": [{"key": "SquareFootage", "value": "bad"}], "locations": [],
    }
    gallery = json.dumps([{"imageUrl": "https://1"}, {"imageUrl": None}, {"imageUrl": "https://2"}])
    brokers = json.dumps([{"firstName": "Ann", "lastName": "Lee"}, {"firstName": "", "lastName": None},
                          {"firstName": "Bo"}])
    rows = [(fv.CREXI, "details", json.dumps(asset), {"entity_id": e}) for e in "1234"]
    rows += [
        (fv.CREXI, "gallery", gallery, {"entity_id": "1", "fetched_at": dt.datetime(2026, 5, 2)}),
        (fv.CREXI, "gallery", "[]", {"entity_id": "1", "fetched_at": dt.datetime(2026, 5, 1)}),
        (fv.CREXI, "brokers", brokers, {"entity_id": "1"}),
        (fv.CREXI, "gallery", "nope", {"entity_id": "2", "http_status": 404}),
        (fv.CREXI, "brokers", "nope", {"entity_id": "2", "http_status": 401}),
        (fv.CREXI, "gallery", '{"a": 1}', {"entity_id": "3"}),
        (fv.CREXI, "brokers", "x", {"entity_id": "3", "http_status": 500}),
        (fv.CREXI, "details", "[1]", {"entity_id": "5"}),
    ]
    t = detail_tables(landed(*rows), fv.CREXI)
    got = {r.listing_id: r for r in t.rows.collect()}
    assert set(got) == set("1234")
    assert got["1"].image_urls == ["https://1", "https://2"]
    assert got["1"].broker_names == ["Ann Lee", "Bo"]
    for k in "234":
        assert (got[k].image_urls, got[k].broker_names) == ([], [])
    r = got["1"]
    assert (r.description, r.building_sqft, r.lot_acres, r.year_built) == (
        "A&nbsp;b c", 12000, 1234.5, "1990")
    assert drift(t) == ["asset is not an object"]


def test_failed_refetch_does_not_hide_a_good_response(landed):
    may, june = dt.datetime(2026, 5, 1), dt.datetime(2026, 6, 1)
    gallery = json.dumps([{"imageUrl": "https://1"}])
    rows = [
        (fv.CREXI, "details", '{"name": "old"}', {"entity_id": "1", "fetched_at": may}),
        (fv.CREXI, "details", "x", {"entity_id": "1", "fetched_at": june, "http_status": 500}),
        (fv.CREXI, "gallery", gallery, {"entity_id": "1", "fetched_at": may}),
        (fv.CREXI, "gallery", "x", {"entity_id": "1", "fetched_at": june, "http_status": 503}),
        (fv.CREXI, "details", '{"name": "a"}', {"entity_id": "2"}),
        (fv.CREXI, "gallery", gallery, {"entity_id": "2", "fetched_at": may}),
        (fv.CREXI, "gallery", "x", {"entity_id": "2", "fetched_at": june, "http_status": 404}),
        (fv.CREXI, "details", "x", {"entity_id": "3", "http_status": 500}),
    ]
    t = detail_tables(landed(*rows), fv.CREXI)
    got = {r.listing_id: (r.name, r.image_urls) for r in t.rows.collect()}
    assert got == {"1": ("old", ["https://1"]), "2": ("a", [])}
    assert drift(t) == ["HTTP status 500"]


def test_sunrealty_search(landed):
    doc = {
        "item_id": "655", "is_eid": "9", "ss_name": "Blue Whale", "ss_url": "https://h/swb-36",
        "is_nid$field_beds": 4, "fs_rc_core_lodging_product$baths": 3.5,
        "is_rc_core_lodging_product$occ_total": 12, "sm_nid$rc_core_term_town$name": ["Carova"],
        "sm_nid$rc_core_term_community$name": ["C1", "C2"],
        "sm_nid$rc_core_term_distance_to_beach$name": [],
        "sm_nid$rc_core_term_featured_amenities$name": ["Pool"],
        "sm_rc_core_item_teaser_slideshow": [], "ss_vrweb_default_image": "https://d",
    }
    body = json.dumps({"response": {"numFound": 3, "docs": [doc, {"is_eid": 7}, {"ss_name": "x"}]}})
    t = search_tables(
        landed(
            (fv.SUNREALTY, "search", body, {"check_in": dt.date(2026, 8, 15)}),
            (fv.SUNREALTY, "search", '{"response": {"numFound": 0}}'),
            (fv.SUNREALTY, "search", '{"x": 1}'),
        ),
        fv.SUNREALTY,
    )
    a, b = t.rows.orderBy("pos").collect()
    assert (a.listing_id, a.name, a.url, a.bedrooms, a.sleeps) == (
        "655", "Blue Whale", "https://h/swb-36", 4, 12)
    assert (a.bathrooms_full, a.bathrooms_half, a.town, a.community) == (3, 1, "Carova", "C1")
    assert (a.distance_to_beach, a.featured_amenities, a.image_url) == (None, ["Pool"], "https://d")
    assert a.check_in == "2026-08-15"
    assert (b.listing_id, b.url, b.town, b.community, b.featured_amenities) == ("7", "", "", None, [])
    assert sorted(drift(t)) == ["missing docs", "missing response"]


def test_twiddy_search(landed):
    item = {
        "propertyId": 5744, "propertyName": "Station One", "town": None, "bedrooms": "10 beds",
        "propertyUrl": "/outer-banks/corolla/pine-island/rentals/station-one/",
        "distanceToBeach": "OceanFront", "images": ["392559?v=a"],
        "amenityItems": [{"label": "b", "description": None}, {"label": "c", "description": "x (Sleeps 25)"}],
    }
    body = json.dumps({"results": [item, {"propertyId": 0}, {"propertyId": 8, "propertyUrl": "https://x/y"}]})
    t = search_tables(
        landed(
            (fv.TWIDDY, "search", body, {"params": {"town": "corolla"}}),
            (fv.TWIDDY, "search", "{}"),
        ),
        fv.TWIDDY,
    )
    a, b = t.rows.orderBy("pos").collect()
    assert (a.listing_id, a.name, a.bedrooms, a.town) == (5744, "Station One", 10, "corolla")
    assert a.url == fv.TWIDDY_BASE + item["propertyUrl"]
    assert (a.neighborhood, a.distance_to_beach, a.oceanfront) == ("Pine Island", "OceanFront", True)
    assert (a.image_url, a.sleeps, a.bathrooms) == (fv.TWIDDY_IMAGES + "/392559?v=a", 25, None)
    assert (a.pet_friendly, a.private_pool) == (False, False)
    assert (b.url, b.neighborhood, b.oceanfront, b.sleeps, b.image_url) == (
        "https://x/y", None, False, None, None)
    assert drift(t) == ["missing results"]


def test_twiddy_details(landed):
    info = {"propertyID": 5744, "name": "Station One", "city": "Southern Shores",
            "fullUrl": "/outer-banks/x/", "neighborhood": "Pine Island", "description": "d",
            "exteriorImage": "https://e"}
    amen = {"sectionModel": {"featuredAmenities": [{"displayLabel": "Pool"}, {"displayLabel": ""}]},
            "bathroomsSummary": "9 Full 1 Half", "bedrooms": 10, "sleepsCount": 25}
    weeks = [{"arrive": "2026-05-03T00:00:00", "depart": "2026-05-10T00:00:00", "weeklyRate": 9650,
              "weekContent": "<s>$1</s> <strong>$9,650</strong>", "isAvailable": True},
             {"arrive": None, "depart": None, "weeklyRate": None, "isAvailable": None}]
    cal = {"availabilityYears": [{"year": 2026, "months": [{"monthNum": 5, "weeks": weeks},
                                                          {"monthNum": 6, "weeks": None}]},
                                 {"year": 2027, "months": None}]}
    t = detail_tables(
        landed(
            (fv.TWIDDY, "info", json.dumps(info), {"entity_id": "5744"}),
            (fv.TWIDDY, "amenities", json.dumps(amen), {"entity_id": "5744"}),
            (fv.TWIDDY, "calendar", json.dumps(cal), {"entity_id": "5744"}),
            (fv.TWIDDY, "info", "{}", {"entity_id": "1"}),
        ),
        fv.TWIDDY,
    )
    r = only(t.rows)
    assert (r.listing_id, r.town, r.bedrooms, r.bathrooms_full, r.bathrooms_half, r.sleeps) == (
        5744, "southern-shores", 10, 9, 1, 25)
    assert (r.url, r.amenities, r.image_urls) == (fv.TWIDDY_BASE + "/outer-banks/x/", ["Pool"], ["https://e"])
    assert [tuple(w) for w in r.weekly_rates] == [
        ("2026-05-03", "2026-05-10", 9650.0, True, "$1   $9,650"), ("", "", None, False, "")]
    assert drift(t) == ["missing propertyID"]


def home_page(entries, extra=""):
    cache = {k: ({"res": {"text": "{}&&" + json.dumps(v)}, "loaded": True} if v is not None else None)
             for k, v in entries.items()}
    state = json.dumps({"ReactServerAgent.cache": {"dataCache": cache}})
    return f"<html><script>{fv.REDFIN_STATE_MARKER}{state};\nroot.x = {{}};</script>{extra}</html>"


HOME = {
    "propertyId": 1, "listingId": 2, "mlsId": {"value": "4366321"}, "dataSourceId": 103,
    "photoFormat": "webp", "beds": 3, "baths": 2.5, "price": {"value": 500000},
    "sqFt": {"value": 1800}, "lotSize": {"value": 9000}, "yearBuilt": {"value": 1999},
    "city": "Arden", "state": "NC", "zip": "28704", "url": "/NC/Arden/x/home/111190110",
    "streetLine": {"value": "732 {Streamside} Dr"}, "unitNumber": {"value": "B"},
}


def test_redfin_search(landed):
    bare = {"propertyId": None, "listingId": 77, "price": None}
    key = "/z" + fv.REDFIN_SEARCH_KEY + "a=1"
    ok = home_page({"other": {"payload": {}}, key: {"payload": {"homes": [HOME, bare, {"city": "x"}]}}})
    t = search_tables(
        landed(
            (fv.REDFIN, "search", ok),
            (fv.REDFIN, "search", "<html>none</html>"),
            (fv.REDFIN, "search", home_page({"other": {"payload": {}}})),
            (fv.REDFIN, "search", home_page({key: {"payload": {"homes": {"a": 1}}}})),
            (fv.REDFIN, "search", ok[: ok.index("Arden")]),
        ),
        fv.REDFIN,
    )
    a, b = t.rows.orderBy("pos").collect()
    assert (a.listing_id, a.url) == ("111190110", fv.REDFIN_BASE + HOME["url"])
    assert (a.address, a.city, a.state, a.zip) == ("732 {Streamside} Dr B", "Arden", "NC", "28704")
    assert (a.price, a.bedrooms, a.bathrooms, a.building_sqft, a.lot_sqft, a.year_built) == (
        500000.0, 3, 2.5, 1800, 9000, 1999)
    assert a.image_url.endswith("/103/bigphoto/321/4366321_0.webp")
    assert (b.listing_id, b.url, b.address, b.price, b.image_url) == ("77", "", "", None, None)
    assert len(drift(t)) == 4


def test_redfin_details(landed):
    home = {"payload": {
        "addressSectionInfo": {
            "beds": 4, "baths": 3, "priceInfo": {"amount": 725000}, "sqFt": {"value": 2400},
            "lotSize": 12000, "yearBuilt": 2005, "streetAddress": {"assembledAddress": "1 Main"},
            "city": "Arden", "state": "NC", "zip": "28704", "cumulativeDaysOnMarket": 0},
        "mediaBrowserInfo": {"photos": [
            {"photoUrls": {"fullScreenPhotoUrl": "https://1"}},
            {"photoUrls": {"fullScreenPhotoUrl": "", "nonFullScreenPhotoUrl": "https://2"}},
            {"photoUrls": {"fullScreenPhotoUrl": "https://1"}}, {"photoUrls": None}]}}}
    agents = {"payload": {"mainHouseInfo": {"listingAgents": [
        {"agentInfo": {"agentName": "Ann"}, "brokerName": ""}]}}}
    ld = (
        '<script type="application/ld+json">{bad</script>'
        '<script type="application/ld+json">{"@type": "Organization", "description": "no"}</script>'
        '<script type="application/ld+json">{"@type": ["Product", "RealEstateListing"], '
        '"description": " Owner&apos;s &amp; joy "}</script>'
    )
    full = home_page({fv.REDFIN_HOME_KEY: home, fv.REDFIN_AGENT_KEY: agents}, ld)
    part = home_page({fv.REDFIN_HOME_KEY: {"payload": {"addressSectionInfo": {"city": "A"}}}})
    none = home_page({fv.REDFIN_HOME_KEY: {"payload": {"x": 1}}})
    t = detail_tables(
        landed(
            (fv.REDFIN, "details", full, {"entity_id": "/NC/x/home/5"}),
            (fv.REDFIN, "details", part, {"entity_id": "6"}),
            (fv.REDFIN, "details", none, {"entity_id": "7"}),
        ),
        fv.REDFIN,
    )
    a, b = t.rows.orderBy("listing_id").collect()
    assert (a.listing_id, a.url) == ("5", fv.REDFIN_BASE + "/NC/x/home/5")
    assert (a.price, a.bedrooms, a.bathrooms, a.building_sqft, a.lot_sqft, a.year_built) == (
        725000.0, 4, 3.0, 2400, 12000, 2005)
    assert (a.days_on_market, a.description, a.image_urls) == (
        0, "Owner's & joy", ["https://1", "https://2"])
    assert (a.listing_agent, a.listing_brokerage, a.hoa_fee) == ("Ann", None, None)
    assert (b.url, b.address, b.city, b.price, b.description, b.image_urls) == (
        fv.REDFIN_BASE + "/home/6", "", "A", None, None, [])
    assert drift(t) == ["missing addressSectionInfo"]


@pytest.mark.parametrize("source", fv.SOURCES)
def test_quarantine_and_rows_never_overlap(landed, source):
    t = search_tables(landed((source, "search", "not a page"), (source, "other", "x")), source)
    assert t.rows.count() == 0
    assert t.quarantine.count() == 1


# ---- how numbers and repeated fetches are read -----------------------------------------------


@pytest.mark.parametrize("written, read", [("12", 12), ("12.0", 12), ('"12"', 12), ('" 12.0 "', 12),
                                           ("12.5", None), ('"a lot"', None), ("null", None)])
def test_whole_numbers_in_any_spelling(landed, written, read):
    body = '{"results": [{"propertyId": %s, "propertyName": "n"}]}' % written
    payloads = twiddy.search_payloads(landed((fv.TWIDDY, "search", body)))
    assert [r.listing_id for r in twiddy.listings(payloads).collect()] == [read] * (read is not None)


def test_a_detail_landed_under_its_url_has_the_id_of_the_page(landed):
    body = '{"propertyID": "31", "name": "n", "fullUrl": "/outer-banks/x/"}'
    responses = landed((fv.TWIDDY, "info", body, {"entity_id": "https://h/outer-banks/x/"}))
    assert twiddy.details(twiddy.detail_payloads(responses)).collect()[0].listing_id == 31


def test_the_newest_usable_fetch_of_a_request_counts(landed):
    def fetch(name, day, status=200, **asked):
        body = '{"results": [{"propertyId": 5, "propertyName": "%s"}]}' % name
        at = dt.datetime(2024, 5, day)
        return (fv.TWIDDY, "search", body, {"fetched_at": at, "http_status": status, "page": 1, **asked})

    responses = landed(
        fetch("old", 1), fetch("new", 3), fetch("between", 2), fetch("failed", 4, 503),
        fetch("other page", 1, page=2), fetch("other town", 1, params={"town": "duck"}),
    )
    payloads = twiddy.search_payloads(responses)
    names = sorted(r["name"] for r in twiddy.listings(payloads).collect())
    assert names == ["new", "other page", "other town"]
