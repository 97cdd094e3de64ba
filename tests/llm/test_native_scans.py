"""URL rules, benchmark windows and licence passages; their queries also run against SQL."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

import oracle
from listinglake.llm import decontaminate, license_scan, registry, url_rules
from llm_cases import as_set, corpus, frame, prose

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
SPLIT = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, name):
    found = registry.queries()[name](spark, SF_DIR)
    _, problems = oracle.compare(found, oracle.connect(SF_DIR), registry.oracle_sql()[name])
    assert problems == []


URLS = [
    None, "", "no scheme", "http://", "http://example.net", "http://example.net/",
    "HTTP://WWW.Example.NET/en/x?y#z", "http://example.net/en", "http://notexample.net/en/",
    "https://a.b.example.com/de/?q", "https://example.com/fr/", "http://x.org/fr/a/b/c/d",
    "http://org/fr/", "http://org:80/fr/", "http://u@net/x", "http://net?x/y", "x://y://z.net/a",
    "http://example.com\n/de/", "http://.net/", "http://É.NET/Ä", "http://a.net//en/",
    "http://" + "a." * 3000 + "net/" + "b/" * 3000,
]


def judged(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [
        r for r in rules
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    if not fits:
        return host, path, None, default
    best = max(fits, key=lambda r: (len(r.host + r.path), r.host + r.path))
    return host, path, best.host + best.path, best.verdict


RULES = [*url_rules.RULES, url_rules.Rule("b.example.com", "/de/x", "allow"),
         url_rules.Rule("y", "", "block")]


@pytest.mark.parametrize("rules", [url_rules.RULES, RULES, []])
def test_urls_are_judged_as_in_plain_python(spark, rules):
    urls = [*URLS, "https://a.b.example.com/de/xy", "http://q.y", "http://net/"]
    rows = [(i, u) for i, u in enumerate(urls)] + [(0, None), (None, "http://net/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("rule", F.lit(1))
    got = url_rules.judge(pages, rules=rules).select("page_id", "host", "path", "rule", "verdict")
    assert as_set(got.collect()) == as_set([(i, *judged(u, rules)) for i, u in rows])
    assert url_rules.judge(pages.limit(0)).count() == 0


def test_rules_beyond_the_broadcast_bound_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(url_rules, "BROADCAST_RULES", 0)
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    got = url_rules.judge(pages).select("host", "path", "rule", "verdict").collect()
    assert as_set(got) == as_set([judged(u, url_rules.RULES) for u in URLS])


def split(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in SPLIT.split(lowered) if w]


def contaminated(rows, items, n=10):
    out = []
    for i, text in rows:
        found, places, hit = split(text), set(), set()
        for item, passage in items:
            theirs = split(passage)
            size = min(n, len(theirs))
            parts = {tuple(theirs[p : p + size]) for p in range(len(theirs) - size + 1)}
            for p in range(len(found) - size + 1):
                if size and item is not None and tuple(found[p : p + size]) in parts:
                    places.update(range(p, p + size))
                    hit.add(item)
        out.append((i, len(found), len(places), len(hit), bool(places)))
    return out


@pytest.fixture(scope="module")
def benchmark():
    rows = corpus()
    taken = dict(rows)[20].split()
    return [
        (1, " ".join(taken[:15]).upper()), (2, " -- ".join(taken[5:30])), (3, "w1, w2"), (4, ""),
        (5, None), (6, "same " * 12), (1, " ".join(taken[:15]).upper()), (7, "no such words"),
        (None, " ".join(taken[:15])), (30, " ".join(taken[2:14])),
    ]


@pytest.mark.parametrize("bound", [decontaminate.BROADCAST_WINDOWS, 0])
def test_hits_as_in_plain_python(spark, benchmark, monkeypatch, bound):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", bound)
    rows = [r for r in corpus() if r[0] != 82]
    items = spark.createDataFrame(benchmark, "item_id long, text string")
    got = decontaminate.contamination(frame(spark, rows), items)
    got = got.select("doc_id", "n_words", "n_hit", "n_items", "contaminated").collect()
    want = contaminated(rows, benchmark)
    assert any(r[-1] for r in want) and as_set(got) == as_set(want)


def test_removed_passages(spark):
    rows = [(1, "Keep. A b c d e f g h i j, and this!"), (2, "Clean  text\n"), (3, None), (4, "")]
    items = spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string")
    got = decontaminate.remove_hits(frame(spark, rows), items)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    want = [(1, "Keep. and this!"), (2, "Clean  text\n"), (3, None), (4, "")]
    assert as_set(got.select("doc_id", "text").collect()) == as_set(want)
    none = decontaminate.remove_hits(frame(spark, rows), items.limit(0))
    assert as_set(none.select("doc_id", "text").collect()) == as_set(rows)


def test_licences(spark):
    mit = license_scan._MIT_GRANT
    rows = [
        (1, "Prose.\nReleased under the MIT license\nmore"), (2, mit.replace(" ", "\n")),
        (3, f"x y z\n\n{mit.lower()} extra\n\nend"), (4, None), (5, ""), (6, "licensed"),
        (7, "Licensed under CC BY-NC 4.0.\nLicensed under the Apache License, Version 2.0."),
        (8, "the software the work the license " * 500), (1, "Prose.\nReleased under the MIT license\nmore"),
        (None, "Licensed under CC BY-SA 4.0"), (9, "Licensed under CC BY 3.0 by someone else today"),
    ]
    got = license_scan.scan(frame(spark, rows))
    assert all((r["n_matches"] > 0) == (r["license"] is not None) for r in got.collect())
    assert as_set(got.select("id", "license").collect()) == as_set([
        (1, "MIT"), (1, "MIT"), (2, "MIT"), (3, "MIT"), (4, None), (5, None), (6, None),
        (7, "Apache-2.0"), (8, None), (None, "CC-BY-SA-4.0"), (9, None),
    ])
    assert license_scan.scan(frame(spark, rows).limit(0)).count() == 0


BSD = """Redistribution and use in source and binary forms, with or without modification, are
permitted provided that the following conditions are met:"""
GPL = license_scan._GNU.format(kind="", version="3")


def commented(lead, text, width=9):
    parts = text.split()
    lines = [" ".join(parts[i : i + width]) for i in range(0, len(parts), width)]
    return "\n".join(f"{lead} {x}".rstrip() for x in lines)


def best_window(text, theirs):
    """The best Dice of any run of words, by trying all."""
    found = split(text)
    out = 0.0
    for i in range(len(found) - 1):
        ours = set()
        for j in range(i + 1, len(found)):
            ours.add((found[j - 1], found[j]))
            out = max(out, 2 * len(ours & theirs) / (len(ours) + len(theirs)))
    return out


def test_licences_that_fill_no_line_or_paragraph(spark):
    other = "int main(void) { return call(one, two); } // of the software and in the work"
    rows = [
        (1, f"# Copyright 2020 by them\n#\n{commented('#', BSD)}\n#\n# 1. Keep this notice.\n{other}"),
        (2, "A page that tells of many things and ends so. Licensed under CC BY 4.0."),
        (3, f"{prose(random.Random(1), 80)} {GPL}\n{other}\n{other}"),
        (4, f"/*\n * x\n *\n{commented(' *', GPL)}\n *\n * This program comes without any warranty."
            f"\n */\n{other}"),
        (5, "Long before. Released under the MIT License. Long after that."),
        (6, f"{other} {BSD} {prose(random.Random(2), 60)} Licensed under CC BY-SA 4.0 as said"),
        (7, "Licensed under a scheme of the software, and the license of the work."),
        (8, "Released under the MIT License."),
    ]
    got = {r["id"]: r for r in license_scan.scan(frame(spark, rows)).collect()}
    want = {1: "BSD", 2: "CC-BY-4.0", 3: "GPL-3.0", 4: "GPL-3.0", 5: "MIT", 6: "BSD", 7: None, 8: "MIT"}
    assert {i: r["license"] for i, r in got.items()} == want
    assert [got[i]["n_matches"] for i in (5, 7, 8)] == [1, 0, 1]
    assert got[6]["n_matches"] == 2 and got[2]["passage"] == "licensed under cc by 4 0"
    known = [set(zip(w, w[1:])) for w in (split(t.text) for t in license_scan.TEMPLATES)]
    for i, text in rows:
        best = max(best_window(text, theirs) for theirs in known)
        assert got[i]["dice"] == pytest.approx(best if best >= license_scan.THRESHOLD else 0)


def test_hits_go_whatever_the_other_columns_are_called(spark):
    rng = random.Random(12)
    passage = prose(rng, 10, 10**6)
    long = " ".join([passage] * 400)
    rows = [(1, f"before {passage}; behind"), (2, "clean text"), (3, f"x {long} y"), (4, None)]
    docs = frame(spark, rows)
    for name in ("_at", "_id", "_print", "__at", "id", "hits", "words"):
        docs = docs.withColumn(name, F.lit(name))
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    got = decontaminate.remove_hits(docs, items)
    assert got.columns == docs.columns
    found = {r["doc_id"]: r for r in got.collect()}
    assert {i: r["text"] for i, r in found.items()} == {1: "before behind", 2: "clean text", 3: "x y", 4: None}
    assert all(r[c] == c for r in found.values() for c in ("_at", "_id", "_print", "__at", "id", "hits", "words"))
