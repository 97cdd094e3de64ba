"""Values fixed by the landed sites: lookups, addresses, patterns, rules.

Nothing here is computed.  Each value has to equal what the sites use, otherwise
ids, links and parsed fields come out wrong.
"""

from __future__ import annotations

# ---- fixed values: source names -------------------------------------------
STAYS = "stays"
CAROLINADESIGNS = "carolinadesigns"
CHURCHREALTY = "churchrealty"
CREXI = "crexi"
REDFIN = "redfin"
SUNREALTY = "sunrealty"
SURFORSOUND = "surforsound"
TWIDDY = "twiddy"

SOURCES = [
    STAYS, CAROLINADESIGNS, CHURCHREALTY, CREXI,
    REDFIN, SUNREALTY, SURFORSOUND, TWIDDY,
]

# ---- fixed values: site addresses -----------------------------------------
STAYS_BASE = "https://www.airbnb.com"
CAROLINADESIGNS_BASE = "https://www.carolinadesigns.com"
CHURCHREALTY_BASE = "https://www.churchrealty.com"
CREXI_BASE = "https://www.crexi.com"
REDFIN_BASE = "https://www.redfin.com"
REDFIN_PHOTO_BASE = "https://ssl.cdn-redfin.com/photo"
SUNREALTY_BASE = "https://www.sunrealtync.com"
SURFORSOUND_BASE = "https://www.surforsound.com"
SURFORSOUND_DETAIL = SURFORSOUND_BASE + "/hatteras-vacation-rental/property"
TWIDDY_BASE = "https://www.twiddy.com"
TWIDDY_IMAGES = TWIDDY_BASE + "/property-images"

# ---- fixed values: towns, as (source, slug, external id, display name) -----
TOWNS = [
    (CAROLINADESIGNS, "corolla", "32", "Corolla"),
    (CAROLINADESIGNS, "duck", "33", "Duck"),
    (CAROLINADESIGNS, "southern-shores", "34", "Southern Shores"),
    (CAROLINADESIGNS, "kitty-hawk", "35", "Kitty Hawk"),
    (CAROLINADESIGNS, "kill-devil-hills", "36", "Kill Devil Hills"),
    (CAROLINADESIGNS, "nags-head", "37", "Nags Head"),
    (SUNREALTY, "duck", None, "Duck"),
    (SUNREALTY, "corolla", None, "Corolla"),
    (SUNREALTY, "kill-devil-hills", None, "Kill Devil Hills"),
    (SUNREALTY, "south-nags-head", None, "South Nags Head"),
    (SUNREALTY, "nags-head", None, "Nags Head"),
    (SUNREALTY, "avon", None, "Avon"),
    (SUNREALTY, "kitty-hawk", None, "Kitty Hawk"),
    (SUNREALTY, "salvo", None, "Salvo"),
    (SUNREALTY, "carova", None, "Carova / 4x4 Beaches"),
    (SUNREALTY, "4x4", None, "Carova / 4x4 Beaches"),
    (SUNREALTY, "rodanthe", None, "Rodanthe"),
    (SUNREALTY, "southern-shores", None, "Southern Shores"),
    (SUNREALTY, "hatteras", None, "Hatteras"),
    (SUNREALTY, "waves", None, "Waves"),
    (SUNREALTY, "manteo", None, "Manteo"),
    (SURFORSOUND, "rodanthe", None, "Rodanthe"),
    (SURFORSOUND, "waves", None, "Waves"),
    (SURFORSOUND, "salvo", None, "Salvo"),
    (SURFORSOUND, "avon", None, "Avon"),
    (SURFORSOUND, "buxton", None, "Buxton"),
    (SURFORSOUND, "frisco", None, "Frisco"),
    (SURFORSOUND, "hatteras", None, "Hatteras"),
    (TWIDDY, "corolla", None, "Corolla"),
    (TWIDDY, "duck", None, "Duck"),
    (TWIDDY, "southern-shores", None, "Southern Shores"),
    (TWIDDY, "kill-devil-hills", None, "Kill Devil Hills"),
    (TWIDDY, "nags-head", None, "Nags Head"),
    (TWIDDY, "4x4", None, "4x4"),
]

# ---- fixed values: search-area labels -------------------------------------
CHURCHREALTY_AREA = "Texas (DFW and Houston metros)"
SUNREALTY_AREA_SUFFIX = ", NC (Outer Banks) - Sun Realty"
SURFORSOUND_AREA_SUFFIX = ", Hatteras Island, NC"
TWIDDY_AREA_SUFFIX = ", NC (Outer Banks)"

# ---- fixed values: markers inside pages -----------------------------------
STAYS_STATE_SCRIPT = r'(?s)<script id="data-deferred-state-0"[^>]*>(.*?)</script>'
REDFIN_STATE_MARKER = "root.__reactServerState.InitialContext = "
REDFIN_TEXT_PREFIX = "{}&&"
REDFIN_SEARCH_KEY = "/stingray/api/gis?"
REDFIN_HOME_KEY = "/stingray/api/home/details/aboveTheFold"
REDFIN_AGENT_KEY = "/stingray/api/home/details/mainHouseInfoPanelInfo"
LD_JSON_SCRIPT = r'(?s)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>'
LD_JSON_TYPES = ["RealEstateListing", "Product"]
SURFORSOUND_WEEKS = r"(?s)WeeklyAvailabilities\s*=\s*(\[.*?\]);"
SUNREALTY_WINDOWS = r'(?s)"rcItemAvailForm"\s*:\s*(\[.*)'
SUNREALTY_PHOTO_HOST = "rezfusion"
TWIDDY_PAGE_ID = r'(?i)(?:propertyId|unitId)["\s]*[=:]["\\s]*(\d+)'

# ---- fixed values: text patterns ------------------------------------------
FIRST_INT = r"(\d+)"
FIRST_DECIMAL = r"(\d+(?:\.\d+)?)"
CURRENCY_AMOUNT = r"([^\d.,]*)\s*([\d,]+(?:\.\d+)?)"
DOLLAR_AMOUNT = r"\$([\d,]+(?:\.\d+)?)"
COMMA_INT = r"(\d[\d,]*)"
COMMA_DECIMAL = r"([\d,]+(?:\.\d+)?)"
CITY_STATE_ZIP = r"^(.+),\s*([A-Z]{2})\s+(\d{5}(?:-\d{4})?)$"
HTML_TAG = r"<[^>]+>"
REVIEWS_IN_PARENS = r"\((\d[\d,]*)\)"
SLEEPS_IN_PARENS = r"(?i)\(Sleeps\s+(\d+)\)"
WEEKLY_RANGE = r"(?i)Weekly:\s*\$([\d,]+)\s*-\s*\$([\d,]+)"
VILLAGE_LINE = r"(?i)^Village\s*:\s*([A-Za-z][A-Za-z\- ]*)"

# ---- fixed values: alternative keys, in order of preference ----------------
LOT_ACRE_KEYS = ["Lot Size (acres)", "Lot Size (Acres)", "Land Area (acres)"]
YEAR_KEYS = ["Year Built", "Year Renovated"]

# ---- fixed values: statuses that stand for an empty side list --------------
EMPTY_STATUSES = {"gallery": [404], "brokers": [401, 403, 404]}

# ---- fixed values: thresholds ---------------------------------------------
HALF_BATH_FRACTION = 0.4
BODY_MIN_CHARS = 80
ITEM_MAX_CHARS = 200
DEFAULT_CAP = 50
PAGE_SIZE = 24

# ---- fixed values: required fields per source (search, details) ------------
HEALTH_SPEC = [
    (STAYS, ["listing_id", "name", "total_price"], ["listing_id", "title"]),
    (CAROLINADESIGNS, ["listing_id", "name", "bedrooms", "bathrooms_full"],
     ["listing_id", "name", "bedrooms"]),
    (CHURCHREALTY, ["listing_id", "name", "city", "state", "listing_type"],
     ["listing_id", "name", "address", "price"]),
    (CREXI, ["listing_id", "name", "city", "state"], ["listing_id", "name"]),
    (REDFIN, ["listing_id", "address", "city", "price"],
     ["listing_id", "address", "price"]),
    (SUNREALTY, ["listing_id", "name", "bedrooms"], ["listing_id", "name"]),
    (SURFORSOUND, ["listing_id", "name", "bedrooms", "town"],
     ["listing_id", "name", "bedrooms"]),
    (TWIDDY, ["listing_id", "name", "bedrooms"], ["listing_id", "name", "bedrooms"]),
]

# ---- fixed values: health summaries ----------------------------------------
HEALTH_EMPTY = "search returned 0 results — could be drift OR genuinely empty"
HEALTH_SEARCH_MISSING = "search result missing required fields: "
HEALTH_DETAILS_MISSING = "details missing required fields: "
HEALTH_OK = "search + details OK (%s results, all required fields populated)"
HEALTH_COUNT = "search returned %s results"

# ---- fixed values: budget and report rules --------------------------------
BUDGET_MIN_BEDROOMS = 7
BUDGET_MAX_RATE = 11000
REPORT_NIGHTS = 7
REPORT_MIN_RATING = 4.0

# ---- fixed values: report columns, one list per sheet ----------------------
STAYS_REPORT = [
    "Rank", "Listing", "Town", "7-Night Total", "BR", "Beds", "Baths",
    "Rating", "Reviews", "Check-in", "Why", "URL",
]
CAROLINADESIGNS_REPORT = [
    "Rank", "Listing", "Town", "Subdivision", "Beach Proximity", "7-Night Total",
    "BR", "Full Baths", "Half Baths", "Sleeps", "Pets OK", "Private Pool", "Why", "URL",
]
TWIDDY_REPORT = [
    "Rank", "Listing", "Town", "Neighborhood", "Beach Proximity", "7-Night Total",
    "BR", "Full Baths", "Half Baths", "Sleeps", "Oceanfront", "Pets OK",
    "Private Pool", "Why", "URL",
]
SURFORSOUND_REPORT = [
    "Rank", "Listing", "Town", "Location", "7-Night Total", "BR", "Full Baths",
    "Half Baths", "Why", "URL",
]
