"""JSON carried inside pages or inside other JSON, as column expressions.

Spark's JSON reader stops at the end of the first complete value, so text that
follows an embedded object needs no bracket counting: cut at the start, parse.

Each function names its argument once.  The arguments are parses themselves, and a
second mention inside one expression would be a second parse.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from listinglake import fixed_values as fv
from listinglake.functions.arrays import first_where
from listinglake.functions.nulls import present
from listinglake.functions.text import group


def script_json(body: Column, script_pattern: str) -> Column:
    """Text of the first script matching the pattern, null when absent.

    The pattern's lazy part would test for the end tag at every character; so the text is
    taken up to the last end tag, and cut at the first.
    """
    start, end = script_pattern.split("(.*?)")
    tail = F.regexp_extract(body, f"{start}(.*{end})", 1)
    return present(F.substring_index(tail, end, 1))


def json_after_marker(body: Column, marker: str) -> Column:
    """Text from the first ``{`` behind the marker; null when either is missing."""
    return group(body, rf"(?s)\Q{marker}\E[^{{]*(\{{.*)")


def array_after_key(body: Column, key_pattern: str) -> Column:
    """Text from the ``[`` behind a key; the pattern captures it to the end."""
    return group(body, key_pattern)


def anti_hijack_json(text: Column) -> Column:
    """JSON object text without the guarding prefix; short or other text -> null."""
    return group(
        text, rf"(?s)^(?=.{{5}})(?:\Q{fv.REDFIN_TEXT_PREFIX}\E)?[\s\p{{Z}}]*(\{{.*)"
    )


def cache_payload(cache: Column, key_part: str, payload_schema: str) -> Column:
    """Payload of the first cache entry whose key contains ``key_part``.

    ``cache`` maps keys to entry texts; entries that are not objects are skipped.
    """
    entry = first_where(
        F.map_entries(cache),
        lambda e: e["key"].contains(key_part) & e["value"].startswith("{"),
    )["value"]
    text = F.from_json(entry, "res STRUCT<text: STRING>")["res"]["text"]
    return F.from_json(anti_hijack_json(text), f"payload {payload_schema}")["payload"]


def ld_json_description(body: Column) -> Column:
    """Raw description of the first structured-data block of a listing type."""
    blocks = F.regexp_extract_all(body, F.lit(fv.LD_JSON_SCRIPT), F.lit(1))
    parsed = F.transform(
        blocks, lambda b: F.from_json(b, "`@type` STRING, description STRING")
    )
    typed = F.transform(
        parsed,
        lambda p: F.struct(
            F.when(p["@type"].startswith("["), F.from_json(p["@type"], "ARRAY<STRING>"))
            .otherwise(F.array(p["@type"]))
            .alias("types"),
            p["description"].alias("description"),
        ),
    )
    wanted = F.array(*[F.lit(t) for t in fv.LD_JSON_TYPES])
    return first_where(
        typed,
        lambda t: F.arrays_overlap(t["types"], wanted) & (t["description"] != ""),
    )["description"]
