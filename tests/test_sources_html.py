"""Page -> record, for the sources that answer in HTML."""

import datetime as dt
from html.parser import HTMLParser

from pyspark.sql import functions as F

from listinglake import fixed_values as fv
from listinglake.functions.html import (
    find, find_all, html_nodes, is_tag, markup_text, text_of, texts_of,
)
from listinglake.plans.normalize import detail_tables, search_tables
from listinglake.sources import surforsound


def only(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def drift(tables):
    return [r["drift"] for r in tables.quarantine.collect()]


# ---- nodes -------------------------------------------------------------------


def nodes_of(spark, html, **kw):
    df = spark.createDataFrame([(html,)], "body string")
    return df.select(html_nodes(F.col("body"), ["class", "href"], **kw).alias("n"))


def test_nodes_nest_and_close(spark):
    html = "<div class=a><p>one<p>two</div> tail<br><img/></i><b>x</b>"
    rows = nodes_of(spark, html).collect()[0]["n"]
    got = [(n["i"], n["tag"], n["end"], n["depth"]) for n in rows]
    assert got == [
        (0, "div", 5, 0), (1, "p", 5, 1), (2, "#text", 3, 2), (3, "p", 5, 2),
        (4, "#text", 5, 3), (5, "#text", 6, 0), (6, "br", 7, 0), (7, "img", 8, 0),
        (8, "b", 10, 0), (9, "#text", 10, 1),
    ]
    assert rows[0]["class"] == "a" and rows[1]["class"] is None


def test_text_skips_scripts_and_comments(spark):
    html = (
        "<div>Price : <b> $5 </b><!-- c -->now<script>var a='<p>';</script>"
        "<style>p{}</style> A &amp;&nbsp;B </div>"
    )
    n = nodes_of(spark, html)
    div = find(F.col("n"), lambda x: is_tag(x, "div"))
    r = n.select(
        text_of(F.col("n"), div).alias("t"), text_of(F.col("n"), div, " ").alias("s")
    ).collect()[0]
    assert r["t"] == "Price :$5nowA &\xa0B"
    assert r["s"] == "Price : $5 now A &\xa0B"


def test_nodes_null_empty_and_many_pages(spark):
    df = spark.createDataFrame([(0, None), (1, ""), (2, "plain"), (3, "<p>a</p>")], "k int, body string")
    got = {
        r["k"]: r["n"]
        for r in df.coalesce(1).select("k", html_nodes(F.col("body"), []).alias("n")).collect()
    }
    assert got[0] is None and got[1] == []
    assert [x["tag"] for x in got[2]] == ["#text"]
    assert [(x["tag"], x["end"]) for x in got[3]] == [("p", 2), ("#text", 2)]


def test_markup_text(spark):
    html = "<div id=d><p>Hello <b>big</b> &lt;world&gt;</p>\n<br/>x &amp; y</div><p>no</p>"
    n = nodes_of(spark, html, keep_blanks=True)
    div = find(F.col("n"), lambda x: is_tag(x, "div"))
    got = n.select(markup_text(F.col("n"), div)).collect()[0][0]
    assert got == " Hello  big  &lt;world&gt; \n x &amp; y"


class _Tree(HTMLParser):
    """Independent check: nested lists from the standard parser."""

    VOID = {"br", "img", "meta", "hr", "input", "link"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = ("", [])
        self.path = [self.root]

    def handle_starttag(self, tag, attrs):
        node = (tag, [])
        self.path[-1][1].append(node)
        if tag not in self.VOID:
            self.path.append(node)

    def handle_endtag(self, tag):
        for i in range(len(self.path) - 1, 0, -1):
            if self.path[i][0] == tag:
                del self.path[i:]
                return

    def handle_comment(self, data):
        self.path[-1][1].append(None)

    def handle_data(self, data):
        if self.path[-1][0] in ("script", "style"):
            return
        items = self.path[-1][1]
        if items and isinstance(items[-1], str):
            items[-1] += data
        else:
            items.append(data)

    def rows(self):
        out = []

        def walk(items, depth):
            for x in items:
                if x is None or (isinstance(x, str) and not x.strip()):
                    continue
                at = len(out)
                out.append(None)
                if isinstance(x, str):
                    out[at] = ("#text", at + 1, depth, x)
                else:
                    walk(x[1], depth + 1)
                    out[at] = (x[0], len(out), depth, None)

        walk(self.root[1], 0)
        return out


def test_nodes_match_the_standard_parser_on_whole_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select(
        "page_id", "html", html_nodes(F.col("html"), []).alias("n")
    )
    odd = [
        "a < b <p>x</p> <P Class=a>y<br/>z", "<a href=it's>q</a><b title='>'>w</b>",
        "<!-- <p> --><p>1<!-- c -->2</p>", "<script>if (a<b) '</p>'</script><i/>t</div>", "<p", "&lt;p&gt; &amp",
    ]
    extra = spark.createDataFrame(list(enumerate(odd)), "page_id long, html string").select(
        "page_id", "html", html_nodes(F.col("html"), []).alias("n")
    )
    checked = 0
    for row in pages.union(extra).collect():
        tree = _Tree()
        tree.feed(row["html"])
        tree.close()
        got = [(x["tag"], x["end"], x["depth"], x["text"]) for x in row["n"]]
        assert got == tree.rows(), row["html"][:200]
        checked += 1
    assert checked > len(odd)


# ---- churchrealty -------------------------------------------------------------


def church_card(slug="church-for-sale-houston", street="10355 Mills Road",
                line2="Houston, TX 77070", photo="https://p/img.jpg", logo_first=False):
    logo = '<div class="sri-listing big"><a href="#"><img src="https://p/logo.png"/></a></div>'
    img = f'<img decoding="async" src=""/><img src="{photo}"/>'
    return (
        '<div class="x property_wrap"><div class="featured_image">'
        + (logo + img if logo_first else img + logo)
        + f'</div><div class="col_content"><p>{street}</p><p> {line2} </p>'
        '<p>Agent : Vince</p></div><p class="prop_button">'
        f'<a href="https://h/about">x</a><a href="https://h/property/{slug}//">View</a></p></div>'
    )


def test_churchrealty_index(landed):
    no_link = '<div class="property_wrap"><div class="col_content"><p>1 St</p></div></div>'
    bare = '<div class="property_wrap"><a href="/property/loft-for-lease">x</a></div>'
    page = "<html><body>" + no_link + church_card() + church_card(
        "hall-for-lease-x", line2="Fort Worth", logo_first=True, photo="https://p/2.jpg") + bare + "</body></html>"
    t = search_tables(
        landed((fv.CHURCHREALTY, "search", page), (fv.CHURCHREALTY, "search", "<p>No listings</p>")),
        fv.CHURCHREALTY,
    )
    a, b, c = t.rows.orderBy("pos").collect()
    assert (a.listing_id, a.url) == ("church-for-sale-houston", "https://h/property/church-for-sale-houston/")
    assert (a.name, a.address, a.city, a.state, a.zip) == (
        "10355 Mills Road", "10355 Mills Road", "Houston", "TX", "77070")
    assert (a.listing_type, a.image_url, a.price) == ("For Sale", "https://p/img.jpg", None)
    assert (b.listing_type, b.city, b.image_url) == ("For Lease", "", "https://p/2.jpg")
    assert (c.listing_id, c.name, c.image_url, c.city) == ("loft-for-lease", "", None, "")
    assert drift(t) == ["no property cards"]


def church_detail(paragraphs, head="<h1>Big <b>Hall</b></h1>", h3="<h3>Near stadium!</h3>", top=True):
    lines = "".join(f"<p>{p}</p>" for p in paragraphs)
    head = f'<div class="property_top_area">{head}</div>' if top else head
    return (
        f'<html><body><div class="property_wrap">{head}<div class="property_item_content">{h3}{lines}</div>'
        '</div><div class="property_gallery_images"><img src="https://1"/><img src="https://2"/>'
        '<img src="https://1"/><img src=""/></div></body></html>'
    )


def test_churchrealty_details(landed):
    page = church_detail([
        "Seating: 500", "", "600 Charles Street", "Humble, TX 77338", "Land Area: 4.52 acres",
        "Price: $3,900,000", "Building: ~51,325 sqft plus 3,000", "Agent : Bob Allen",
        "Phone: <a>281-540-2008</a> <i>ext 2</i>", "Email: x@y",
    ])
    t = detail_tables(
        landed((fv.CHURCHREALTY, "details", page,
                {"entity_id": "https://h/property/hall-for-sale-humble/"})),
        fv.CHURCHREALTY,
    )
    r = only(t.rows)
    assert (r.listing_id, r.url) == (
        "hall-for-sale-humble", fv.CHURCHREALTY_BASE + "/property/hall-for-sale-humble/")
    assert (r.name, r.description, r.listing_type) == ("BigHall", "Near stadium!", "For Sale")
    assert (r.address, r.city, r.state, r.zip) == ("600 Charles Street", "Humble", "TX", "77338")
    assert (r.price, r.building_sqft, r.lot_acres, r.year_built) == (3900000.0, 51325, 4.52, None)
    assert (r.agent_name, r.agent_phone) == ("Bob Allen", "281-540-2008 ext 2")
    assert r.image_urls == ["https://1", "https://2"]


def test_churchrealty_detail_variants(landed):
    unknown_first = church_detail(
        ["Zoned commercial", "600 Charles", "Humble, TX 77338", "Price: Please call agent",
         "Price: $5", "Price: call", "Phone:"], h3="", top=False)
    bare = '<div class="property_wrap"><div class="property_item_content"></div></div>'
    t = detail_tables(
        landed(
            (fv.CHURCHREALTY, "details", unknown_first, {"entity_id": "a"}),
            (fv.CHURCHREALTY, "details", bare, {"entity_id": "b"}),
            (fv.CHURCHREALTY, "details", "<p>oops</p>", {"entity_id": "c"}),
            (fv.CHURCHREALTY, "details", '<div class="property_wrap"></div>', {"entity_id": "d"}),
        ),
        fv.CHURCHREALTY,
    )
    a, b = t.rows.orderBy("listing_id").collect()
    # An unknown paragraph in front of the address is taken for the street.
    assert (a.address, a.city, a.zip) == ("Zoned commercial", "Humble", "77338")
    assert (a.price, a.description, a.agent_phone, a.name) == (None, None, None, "BigHall")
    assert (b.name, b.address, b.city, b.image_urls, b.agent_name) == ("", "", "", [], None)
    assert sorted(drift(t)) == ["no property block", "no property content"]


# ---- sunrealty ----------------------------------------------------------------

LONG = "If you are searching for an unforgettable home with a long list of extras, this is the one."


def sun_page(amenities=None, extra="", form=None):
    amenities = amenities if amenities is not None else (
        "<div class='wrap'><h3>Rooms</h3><div class='item-list'><ul><li>no</li></ul></div>"
        "<h3>Amenities &amp; Beds</h3><p>x</p><div class='item-list a'><ul><li>Ocean view</li>"
        "<li> </li><li>Pool</li></ul></div><div class='other'><li>no</li></div>"
        "<div class='item-list'><ul><li>Hot <b>Tub</b></li></ul></div><h3>More</h3>"
        "<div class='item-list'><li>late</li></div></div><div class='item-list'><li>outside</li></div>"
    )
    form = form if form is not None else (
        '{"rcItemAvailForm": [{"eid":"655","avail":[{"b":"2026-04-28","e":"2026-05-02","a":"0"},'
        '{"b":"2026-05-03","e":"2026-06-13","a":1},{"b":"","e":"x","a":"1"}]}], "z": [1]}'
    )
    return (
        "<html><body><h1>Site</h1><div class='field field-name-title'>The Blue Whale SWB-36</div>"
        "<div class='rc-lodging-beds rc'>Bedrooms: 4</div>"
        "<div class='rc-lodging-baths rc'>Bathrooms: 3 &amp; 1 Half</div>"
        "<div class='field-name-field-town'>Carova</div>"
        "<div class='field-name-rc-core-term-community'>Carova / 4x4</div>"
        f"<div class='field-name-body'>short</div><div class='field-name-body'><p>{LONG}</p><p>End.</p></div>"
        f"<div class='group-vr-property-amenities z'>{amenities}</div>"
        "<img src='https://i.rezfusion.com/1?a=1&amp;b=2' data-src='https://i.rezfusion.com/2'/>"
        "<img src='https://other/3'/><img data-src='https://i.rezfusion.com/2'/>"
        f"{extra}<script>jQuery.extend(Drupal.settings, {form});</script></body></html>"
    )


def test_sunrealty_details(landed):
    t = detail_tables(
        landed(
            (fv.SUNREALTY, "details", sun_page(), {"entity_id": "https://h/swb-36"}),
            (fv.SUNREALTY, "details", "<p>nothing</p>", {"entity_id": "https://h/x"}),
        ),
        fv.SUNREALTY,
    )
    r = only(t.rows)
    assert (r.listing_id, r.url, r.name) == ("655", "https://h/swb-36", "The Blue Whale SWB-36")
    assert (r.town, r.community, r.bedrooms, r.bathrooms_full, r.bathrooms_half, r.sleeps) == (
        "Carova", "Carova / 4x4", 4, 3, 1, None)
    assert r.description == LONG + " End."
    assert r.amenities == ["Ocean view", "Pool", "HotTub"]
    assert r.image_urls == ["https://i.rezfusion.com/1?a=1&b=2", "https://i.rezfusion.com/2"]
    assert [tuple(w) for w in r.availability_windows] == [
        ("2026-04-28", "2026-05-02", False), ("2026-05-03", "2026-06-13", True)]
    assert drift(t) == ["no title block"]


def test_sunrealty_detail_variants(landed):
    t = detail_tables(
        landed(
            (fv.SUNREALTY, "details", sun_page(amenities="", form='{"item_id": 12}'), {"entity_id": "a"}),
            (fv.SUNREALTY, "details",
             sun_page(amenities="<h3>Amenities <i>and</i> beds</h3><div class='item-list'><li>x</li></div>",
                      form='{"rcItemAvailForm": [{bad json}'), {"entity_id": "b"}),
            (fv.SUNREALTY, "details", "<div class='field-name-title'>T</div>", {"entity_id": "c"}),
        ),
        fv.SUNREALTY,
    )
    a, b, c = t.rows.orderBy("url").collect()
    assert (a.listing_id, a.amenities, a.availability_windows) == ("12", [], [])
    assert (b.amenities, b.availability_windows) == ([], [])
    assert (c.listing_id, c.name, c.town, c.community, c.bedrooms) == ("", "T", "", None, None)
    assert (c.bathrooms_full, c.bathrooms_half, c.description, c.image_urls) == (None, None, "", [])


# ---- surforsound --------------------------------------------------------------


def stat(label, value):
    return (
        f'<p class="mb-0"><span class="sos-letter-spc-1 up">{label}</span>'
        f'<span class="fw-bold small">{value}</span></p>'
    )


def sos_card(i=553, village="Salvo", stats=None, price="$4,995 /week", name="Splash Mansion"):
    stats = stats if stats is not None else (
        stat("Bed", "8") + stat("Bath", "8 Full, 2 Half") + stat("Location", "Oceanfront"))
    return (
        f'<div class="sos-property-card small" data-property-url="https://h/r/property/{i}?Checkin=2026">'
        f'<div class="lead sos-property-card_name x"> {name} - #{i} </div>'
        f'<div class="sos-property-card__details w">{stats}'
        f'<div><span class="text-info fw-bold">{price}</span></div></div>'
        f'<div class="d-flex justify-content-around"><small>Saturday Check in</small>'
        f"<small>Village: {village}</small></div></div>"
    )


def sos_page(cards, total=15, size=24):
    return (
        f'<html><body><div class="sos-search-results-grid" total-properties-found="{total}" '
        f'page-size="{size}">{cards}</div></body></html>'
    )


def test_surforsound_search(landed):
    bad = '<div class="sos-property-card" data-property-url="/nothing"></div>'
    own_village = sos_card(9, stats=stat("Village", "Kitty Hawk") + stat("Bed", "x") + stat("BED", "3"),
                           price="call", name="B")
    t = search_tables(
        landed(
            (fv.SURFORSOUND, "search", sos_page(sos_card() + bad + own_village),
             {"check_in": dt.date(2026, 8, 15)}),
            (fv.SURFORSOUND, "search", sos_card(727, village="Avon"), {"page": 2}),
            (fv.SURFORSOUND, "search", sos_page("", total=0), {"page": 3}),
            (fv.SURFORSOUND, "search", "<p>Nothing here</p>", {"page": 4}),
        ),
        fv.SURFORSOUND,
    )
    a, b, c = t.rows.orderBy("page", "pos").collect()
    assert (a.listing_id, a.url, a.name) == (553, "https://h/r/property/553", "Splash Mansion")
    assert (a.bedrooms, a.bathrooms_full, a.bathrooms_half, a.location) == (8, 8, 2, "Oceanfront")
    assert (a.town, a.weekly_rate, a.check_in) == ("salvo", 4995.0, "2026-08-15")
    assert (b.listing_id, b.town, b.bedrooms, b.weekly_rate) == (9, "kitty-hawk", 3, None)
    assert (b.bathrooms_full, b.bathrooms_half) == (None, None)
    assert (c.listing_id, c.town, c.check_in) == (727, "avon", "")
    assert drift(t) == ["neither cards nor a search grid"]


def test_surforsound_landing_gaps(landed):
    rows = [
        (fv.SURFORSOUND, "search", sos_page(sos_card(), total=30), {"params": {"villages": "avon"}}),
        (fv.SURFORSOUND, "search", sos_card(), {"params": {"villages": "avon"}, "page": 2}),
        (fv.SURFORSOUND, "search", sos_page(sos_card(), total=49), {"params": {"villages": "salvo"}}),
    ]
    got = {
        r.villages: (r.total_found, r.pages_expected, r.pages_landed, r.complete)
        for r in surforsound.landing_gaps(landed(*rows), ["villages"]).collect()
    }
    assert got == {"avon": (30, 2, 2, True), "salvo": (49, 3, 1, False)}


def sos_detail(weeks="[]", tail=""):
    return (
        f"<html><body><script>window.a = 1;</script><script>Sos.WeeklyAvailabilities = {weeks};</script>"
        "<h1>Splash Mansion - #553</h1>"
        '<div class="sos-property-card__property-features">'
        + stat("VILLAGE", " Salvo ") + stat("BED", "8") + stat("BATH", "8 Full, 2 Half")
        + '</div><div id="property-description"><p>A <b>wonderful</b> home.</p>\n</div>'
        '<ul class="sos-column-list-3"><li>Private Pool</li><li>Hot Tub</li><li>Private Pool</li>'
        f'<li>{"x" * 200}</li></ul>'
        '<p>Weekly: <b>$2,995</b> - $14,495</p><p>Weekly: $1 - $2</p>'
        '<img data-lazy="/media/a/1.jpg?w=1"/><img data-lazy="/media/a/1.jpg?w=2"/>'
        '<img data-lazy="https://x/media/2.jpg"/><img data-lazy="/other/3.jpg"/><img src="/media/4.jpg"/>'
        f"{tail}</body></html>"
    )


def test_surforsound_details(landed):
    weeks = (
        '[{"isOnSpecial":false,"startDate":"2026-07-04","rate":14495.11,"formattedRate":"$14,495",'
        '"referenceRate":13995.0},{"startDate":null,"rate":null,"isOnSpecial":true}]'
    )
    other = '<div class="sos-property-card__property-features">' + stat("BED", "3") + "</div>"
    t = detail_tables(
        landed(
            (fv.SURFORSOUND, "details", sos_detail(weeks, other), {"entity_id": "/x/property/553"}),
            (fv.SURFORSOUND, "details", sos_detail("[{bad]"), {"entity_id": "7"}),
            (fv.SURFORSOUND, "details", "<h1>Bare</h1>", {"entity_id": "8"}),
            (fv.SURFORSOUND, "details", "<p>No heading</p>", {"entity_id": "9"}),
        ),
        fv.SURFORSOUND,
    )
    bad, bare, r = t.rows.orderBy("listing_id").collect()
    assert (r.listing_id, r.url, r.name) == (553, fv.SURFORSOUND_DETAIL + "/553", "Splash Mansion")
    assert (r.town, r.bedrooms, r.bathrooms_full, r.bathrooms_half, r.sleeps) == ("salvo", 8, 8, 2, None)
    assert r.description == "A  wonderful  home."
    assert r.amenities == ["Private Pool", "Hot Tub"]
    assert r.image_urls == [fv.SURFORSOUND_BASE + "/media/a/1.jpg?w=1", "https://x/media/2.jpg"]
    assert (r.weekly_rate_min, r.weekly_rate_max) == (2995.0, 14495.0)
    assert [tuple(w) for w in r.weekly_availabilities] == [
        ("2026-07-04", 14495.11, "$14,495", 13995.0, False), (None, None, None, None, True)]
    assert bad.weekly_availabilities == []
    assert (bare.name, bare.town, bare.description, bare.amenities, bare.image_urls) == (
        "Bare", "", "", [], [])
    assert (bare.weekly_rate_min, bare.weekly_availabilities) == (None, [])
    assert drift(t) == ["no h1"]


def test_texts_of_picks_in_order(spark):
    n = nodes_of(spark, "<ul><li>a<li>b</ul><li>c</li>")
    got = n.select(
        texts_of(F.col("n"), find_all(F.col("n"), lambda x: is_tag(x, "li")), "|")
    ).collect()[0][0]
    assert got == ["a|b", "b", "c"]
