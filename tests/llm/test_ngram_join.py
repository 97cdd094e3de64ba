import random

import numpy as np
from pyspark.sql import functions as F

from listinglake.llm import ngram_join
from llm_cases import as_set, corpus, frame, lower, prose, words


def plain(rows, k=5, percent=75):
    sets = []
    for _, text in rows:
        found = words(lower((text or "").encode()).decode())
        if len(found) >= k:
            sets.append({tuple(found[p : p + k]) for p in range(len(found) - k + 1)})
        else:
            sets.append({tuple(found)} if found else set())
    # A document is an id with a text; rows that repeat both are one.
    group = {(i, t): (i, t) for i, t in rows if i is not None}

    def root(node):
        while group[node] != node:
            node = group[node]
        return node

    for a, x in enumerate(rows):
        for b, y in enumerate(rows[:a]):
            common = len(sets[a] & sets[b])
            if x[0] is None or y[0] is None or not common:
                continue
            if 100 * common >= percent * len(sets[a] | sets[b]):
                x, y = root(x), root(y)
                group[x] = y
                x = rows[a]
    least = {}
    for node in group:
        least[root(node)] = min(node[0], least.get(root(node), node[0]))
    return [
        (i, len(s), None if i is None else least[root((i, t))]) for (i, t), s in zip(rows, sets)
    ]


def components(docs, **options):
    return ngram_join.jaccard_components(docs, **options).drop("text_hash", "group")


def test_components_as_in_plain_python(spark):
    rows = corpus()
    got = components(frame(spark, rows)).collect()
    assert as_set(got) == as_set(plain(rows))


def test_graded_copies_around_the_threshold(spark):
    """Chains of texts at all distances, so that the boundary decides."""
    rng = random.Random(3)
    rows, text = [], prose(rng, 80, 10**6).split()
    for i in range(60):
        if i % 20 == 0:
            text = prose(rng, 80, 10**6).split()
        text = list(text)
        for _ in range(rng.randrange(0, 4)):
            text[rng.randrange(len(text))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(text[: rng.randrange(60, 81)])))
    want = as_set(plain(rows))
    assert 3 < len({c for _, _, c in want}) < 60
    for levels in (1, 2):
        got = components(frame(spark, rows), levels=levels).collect()
        assert as_set(got) == want


def test_no_links_and_empty_tables(spark):
    docs = frame(spark, [(5, "a b c d e f"), (6, "g h i j k l"), (7, None)])
    got = components(docs.withColumn("key", F.lit("x")))
    assert as_set(got.collect()) == [(5, 2, 5), (6, 2, 6), (7, 0, 7)]
    assert components(docs.limit(0)).count() == 0


def test_rows_that_repeat_an_id_with_another_text(spark):
    rng = random.Random(9)
    a, b = prose(rng, 40, 10**6), prose(rng, 40, 10**6)
    got = components(frame(spark, [(5, a), (12, a), (12, b), (20, b), (20, b)]))
    assert as_set(got.collect()) == as_set([(5, 36, 5), (12, 36, 5), (12, 36, 12), (20, 36, 12), (20, 36, 12)])


def test_rows_that_cannot_meet_go_and_links_stay():
    rng = np.random.default_rng(1)
    for percent in (75, 60):
        for _ in range(200):
            m = int(rng.integers(1, 40))
            group = np.sort(rng.integers(0, 6, m))
            n = rng.integers(1, 60, m)
            rank = np.array([rng.integers(0, k * (100 - percent) // 100 + 1) for k in n])
            keep = ngram_join.may_meet(group, n, rank, percent)
            for i in range(m):
                mates = [
                    j for j in range(m) if j != i and group[i] == group[j]
                    and 100 * min(n[i], n[j]) >= percent * max(n[i], n[j])
                    and (100 + percent) * (n[i] - rank[i]) >= percent * (n[i] + n[j])
                ]
                assert keep[i] == bool(mates)


def test_large_regions_are_not_held(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "HELD_ROWS", 5)
    rng = random.Random(4)
    start = prose(rng, 12, 10**6)
    rows = [(i, f"{start} {prose(rng, rng.randrange(1, 6), 30)}") for i in range(60)]
    assert as_set(components(frame(spark, rows)).collect()) == as_set(plain(rows))


def test_sets_of_texts_without_copies_are_not_shuffled(spark, monkeypatch):
    plans = {}
    settle = ngram_join.settle

    def kept(df, name, **options):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return settle(df, name, **options)

    monkeypatch.setattr(ngram_join, "settle", kept)
    rng = random.Random(5)
    texts = [prose(rng, 30, 10**6) for _ in range(4)]
    # 3 stands there twice, 7 and 8 are copies, 9 repeats an id with another text.
    rows = [(1, texts[0]), (3, texts[1]), (3, texts[1]), (7, texts[2]), (8, texts[2]), (9, texts[3]), (9, texts[0] + " z")]
    docs = frame(spark, rows).selectExpr("doc_id as id", "text", "xxhash64(text) as text_hash")
    members = ngram_join._profile(docs, 5).where("slice is null")
    points = members.groupBy("key").agg(
        F.min("id").alias("id"), (F.count(F.lit(1)) > 1).alias("copied"), F.min("n").alias("n")
    ).localCheckpoint()
    keys = [(r["key"], r["n"]) for r in points.collect()]
    pairs = spark.createDataFrame([(keys[0][0], k) for k, _ in keys[1:]], "a long, b long")
    for kind in (np.uint64, np.uint16):
        got = ngram_join._sets(docs, points.drop("n"), pairs, 5, kind).collect()
        assert sorted((r["key"], len(np.frombuffer(r["set"], kind))) for r in got) == sorted(keys)
        assert "hashpartitioning" not in plans["made"] and "hashpartitioning" in plans["sets"]
