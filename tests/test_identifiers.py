"""Suffix index, and details by every name that a request may use."""

import random

import pytest
from pyspark.sql import functions as F

from listinglake import fixed_values as fv
from listinglake.operators.joins import resolve_identifiers
from listinglake.operators.suffixes import SuffixIndex, with_suffixes
from listinglake.plans.details import find_all_details


def words(rng, n, longest=7):
    return ["".join(rng.choice("ab/é") for _ in range(rng.randrange(0, longest))) for _ in range(n)]


def test_index_finds_every_end():
    rng = random.Random(5)
    for _ in range(200):
        codes = words(rng, rng.randrange(0, 30), 5)
        index = SuffixIndex(codes)
        for text in words(rng, 20):
            want = sorted({c for c in codes if c and text.endswith(c)}, key=len, reverse=True)
            assert index.ends_of(text) == want


@pytest.mark.parametrize("sent", [10**6, 0])
def test_rows_of_every_end(spark, sent):
    rng = random.Random(6)
    texts = words(rng, 300) + [None, ""] + ["hot/ab"] * 200
    codes = sorted(set(words(rng, 40, 5)) | {"hot/ab", "b", "ab"})
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string").repartition(5)
    asked = spark.createDataFrame([(c,) for c in codes], "code string")
    got = with_suffixes(df, "text", asked, sent_codes=sent)
    want = [(n, t, c) for n, t in enumerate(texts) for c in codes if t and c and t.endswith(c)]
    assert sorted(map(tuple, got.select("n", "text", "code").collect())) == sorted(want)
    none = with_suffixes(df, "text", asked.limit(0), sent_codes=sent)
    assert none.count() == 0


def test_texts_are_not_shuffled_for_few_codes(spark):
    df = spark.range(1000).select(F.concat(F.lit("x"), F.col("id")).alias("text"))
    codes = spark.createDataFrame([("9",), ("99",), ("x7",)], "code string")
    found = with_suffixes(df, "text", codes)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Range") == 1
    assert found.count() == 100 + 10 + 1


def test_kinds_of_identifiers_keep_apart(spark):
    index = spark.createDataFrame(
        [("12", "https://h/a/SWB-112", 1, 0), ("112", "https://h/a/12", 1, 1), ("5", "https://h/outer-banks/Q", 1, 2)],
        "listing_id string, url string, page int, pos int")
    asked = {
        "12": "12", "112": "112", "swb-112": "12", "SWB-112": "12", "a/12": "112", "https://h/a/12": "112",
        "/outer-banks/Q": "5", "/outer-banks/q": None, "https://h/a": None, "": None, "2": None,
    }
    requests = spark.createDataFrame([(a,) for a in [*asked, None]], "identifier string")
    got = {r["identifier"]: r["listing_id"] for r in resolve_identifiers(requests, index).collect()}
    assert got == {a: want for a, want in asked.items() if want}


DETAILS = "listing_id string, url string, name string"


def test_sunrealty_details_by_all_names(spark):
    details = spark.createDataFrame(
        [("54", "https://www.sunrealtync.com/outer-banks/avon/110-d", "Gull"), ("", "https://h/x/swb-36", "Tern"),
         ("54", "https://www.sunrealtync.com/outer-banks/avon/110-d", "Gull")], DETAILS)
    requests = spark.createDataFrame(
        [(i, a) for i, a in enumerate([
            "54", " /outer-banks/avon/110-d/ ", "https://www.sunrealtync.com/outer-banks/avon/110-d", "110-D",
            "SWB-36", "none", None, "", "54"])], "n int, identifier string")
    got = find_all_details(requests, details, fv.SUNREALTY)
    assert got.columns == ["n", "identifier", "found_by", "listing_id", "url", "name"]
    assert sorted((r["n"], r["found_by"], r["name"]) for r in got.collect()) == [
        (0, "id", "Gull"), (1, "url", "Gull"), (2, "url", "Gull"), (3, "index", "Gull"), (4, "index", "Tern"), (8, "id", "Gull"),
    ]
    # An id that only the search rows know leads to the page.
    index = spark.createDataFrame([("77", "https://h/x/swb-36/", 1, 0)], "listing_id string, url string, page int, pos int")
    asked = spark.createDataFrame([("77",)], "identifier string")
    (row,) = find_all_details(asked, details, fv.SUNREALTY, index=index).collect()
    assert (row["found_by"], row["name"]) == ("index", "Tern")


def test_twiddy_id_from_the_page(spark):
    details = spark.createDataFrame(
        [(7, "https://www.twiddy.com/outer-banks/seven/", "Seven"), (8, "https://www.twiddy.com/outer-banks/eight", "Eight")],
        "listing_id long, url string, name string")
    pages = spark.createDataFrame(
        [("https://www.twiddy.com/outer-banks/old-name", '{"propertyId":8}'), ("/outer-banks/seven", '"propertyId":"8"'),
         ("/outer-banks/blank", "<p>nothing</p>"), (None, '"propertyId":7')], "entity_id string, body string")
    requests = spark.createDataFrame(
        [(a,) for a in ["8", "/outer-banks/old-name/", "/outer-banks/seven", "/outer-banks/blank", "what"]], "identifier string")
    got = find_all_details(requests, details, fv.TWIDDY, pages=pages).collect()
    assert sorted((r["identifier"], r["found_by"], r["name"]) for r in got) == [
        ("/outer-banks/old-name/", "page", "Eight"), ("/outer-banks/seven", "url", "Seven"), ("8", "id", "Eight"),
    ]
    assert find_all_details(requests, details, fv.TWIDDY).count() == 2
    with pytest.raises(ValueError, match="no pages"):
        find_all_details(requests, details, fv.CREXI)
