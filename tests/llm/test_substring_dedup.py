import pytest
from pyspark.sql import functions as F

from listinglake.llm import substring_dedup
from llm_cases import as_set, corpus, frame, words


def plain(rows, window):
    first = {}
    for i, text in rows:
        found = words(text)
        for p in range(len(found) - window + 1):
            if i is not None:
                part = tuple(found[p : p + window])
                first[part] = min(first.get(part, i), i)
    out = []
    for i, text in rows:
        found = words(text)
        gone = set()
        for p in range(len(found) - window + 1):
            if i is not None and first[tuple(found[p : p + window])] < i:
                gone.update(range(p, p + window))
        kept = [w.decode() for j, w in enumerate(found) if j not in gone]
        out.append((i, len(found), len(gone), " ".join(kept)))
    return out


@pytest.mark.parametrize("window, short_run", [(50, 16), (8, 3), (5, 5)])
def test_same_words_go_as_in_plain_python(spark, window, short_run):
    rows = corpus()
    got = substring_dedup.remove_repeats(frame(spark, rows), window=window, short_run=short_run)
    got = got.select("doc_id", "n_words", "n_removed", "kept_text").collect()
    assert as_set(got) == as_set(plain(rows, window))


def test_own_columns_replace_others_and_empty_tables_pass(spark):
    docs = frame(spark, corpus()[:4]).withColumn("kept_text", F.lit(5)).withColumn("m", F.lit(1))
    got = substring_dedup.remove_repeats(docs)
    assert got.columns[-3:] == ["n_words", "n_removed", "kept_text"] and "m" in got.columns
    assert got.count() == 4
    assert substring_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_other_columns_may_have_any_name(spark):
    rows = corpus()
    docs = frame(spark, rows)
    for name in ("_start", "_windows", "spans", "start", "print", "_id", "__start"):
        docs = docs.withColumn(name, F.lit(name))
    got = substring_dedup.remove_repeats(docs).collect()
    assert as_set((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in got) == as_set(plain(rows, 50))
    assert all(r[c] == c for r in got for c in ("_start", "_windows", "spans", "start", "print", "_id", "__start"))
