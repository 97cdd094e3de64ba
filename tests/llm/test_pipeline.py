"""The corpus pipeline, stage by stage, against plain Python on a small corpus."""

import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from listinglake.llm import registry
from llm_cases import DOCS, as_set, corpus, prose
from test_learned import toxic_corpus
from test_native_scans import split
from test_ngram_join import plain as plain_components
from test_substring_dedup import plain as plain_spans


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(11)
    toxic, labels, _ = toxic_corpus(400)
    rows = [(i + 1000, t) for i, t in toxic] + corpus()
    passage = prose(rng, 14, 10**6)
    rows += [(600 + i, f"{prose(rng, 30)} {passage}, {prose(rng, 30)}") for i in range(3)]
    full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
    spark.createDataFrame(full, DOCS).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i + 1000, 1, y) for i, y in labels]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        f"{path}/labels.parquet"
    )
    items = [(1, passage), (2, None), (3, prose(rng, 30, 10**6))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(
        f"{path}/benchmark.parquet"
    )
    return path


def test_stages_one_after_another(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == columns
        rows = docs.collect()
        after = [(r["doc_id"], r["text"]) for r in rows]
        assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in rows)
        if name == "toxicity":
            bad = {i for i, t in before if t and {"vile", "rotten", "nastiest"} & set(t.split())}
            gone = {i for i, _ in before} - {i for i, _ in after}
            assert gone <= bad and len(gone) >= 0.9 * len(bad)
        elif name == "near_duplicates":
            found = zip(before, plain_components(before))
            want = {(i, t) for (i, t), (_, _, c) in found if i is None or i == c}
            assert len(want) < len(before)
            assert as_set(after) == as_set(want | set())
        elif name == "substring_dedup":
            kept = plain_spans(before, 50)
            texts = {(i, len_, gone): text for i, len_, gone, text in kept}
            want = [(i, texts[i, n, g] if g else t) for (i, t), (_, n, g, _) in zip(before, kept)]
            assert any(g for _, _, g, _ in kept)
            assert as_set(after) == as_set(want)
        else:
            had = {i for i, t in before if t and "," in t}
            changed = {i for (i, t) in before if (i, t) not in set(after)}
            assert changed and changed <= had
            items = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
            for _, text in after:
                joined = " ".join(split(text))
                for item in filter(None, items):
                    theirs = split(item)
                    assert not any(
                        " ".join(theirs[p : p + 10]) in joined for p in range(len(theirs) - 9)
                    )
        docs = spark.createDataFrame(rows, docs.schema)
    name, last = corpus_pipeline.STAGES[-1]
    library = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model")
    )
    coded = last(spark, docs, sf_dir).collect()
    assert len(coded) == docs.count()
    assert all(r["ids"] == library.encode(r["text"] or "") for r in coded)


def test_the_registered_query_runs_all_stages(spark, sf_dir):
    got = registry.queries()["pipeline"](spark, sf_dir)
    assert {"doc_id", "ids", "n_tokens"} <= set(got.columns) and got.count() > 50


OWN = [
    "n_words", "n_removed", "kept_text", "score", "predicted", "evidence", "_at", "_id", "_print",
    "_start", "_windows", "spans", "hits", "id", "key", "component_id", "text_hash", "group", "slice", "a", "b",
]


def test_columns_of_operators_own_names_come_through(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name in OWN:
        docs = docs.withColumn(name, F.concat(F.lit(f"{name}/"), F.col("doc_id").cast("string")))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == columns, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    rows = docs.collect()
    assert rows and all(r[c] == (None if r["doc_id"] is None else f"{c}/{r['doc_id']}") for r in rows for c in OWN)


def test_texts_under_a_repeated_id_are_not_lost(spark, sf_dir):
    rng = random.Random(1)
    a, b, c, d = (prose(rng, 60, 10**6) for _ in range(4))
    rows = [
        (5, a, "en"), (12, a, "en"), (12, b, "en"), (20, b, "en"),  # b stays with the smallest id it has
        (30, c, "en"), (30, d, "en"), (30, d, "de"),  # two texts of one id, one of them twice
        (40, c[: len(c) - 8], "en"), (41, "", "en"), (41, None, "en"), (41, " ", "en"), (None, a, "x"), (None, a, "x"),
    ]
    docs = spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t)) for i, t, lang in rows], DOCS)
    got = corpus_pipeline.near_duplicates(spark, docs, sf_dir).collect()
    assert as_set((r["doc_id"], r["text"], r["lang"]) for r in got) == as_set([
        (5, a, "en"), (12, b, "en"), (30, c, "en"), (30, d, "de"), (41, "", "en"), (41, None, "en"), (41, " ", "en"),
        (None, a, "x"), (None, a, "x"),
    ])
    both = [(7, c, "en", "s", 1), (7, c[: len(c) - 8], "en", "s", 1)]  # two texts of one id that are near copies
    assert corpus_pipeline.near_duplicates(spark, spark.createDataFrame(both, DOCS), sf_dir).count() == 1
