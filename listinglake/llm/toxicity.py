"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Terms are words and their first 3 to 8 letters.  A bounded, repeatable sample of labelled
documents (MAX_EXAMPLES, by hash of the id) is learnt from: terms whose share among toxic
examples is higher by at least MIN_Z standard errors are the vocabulary; all other
words of a text count as one further term, which keeps the proportion of telling words
in the angle.  Document frequencies are counted over all documents.

Examples with equal vectors are one point with the share of toxic ones among them.  The
points are listed per term in an inverted index.  Points are numbered so that similar
ones are neighbours, and cut into blocks; for every term and block the index has the
greatest weight.  A query adds these up to a bound per block, scores the blocks from the
highest bound down and stops when no bound reaches the k-th best score: the k nearest
points are exact.  They vote with weights falling with their distance; the vote is
calibrated by isotonic regression over votes on the examples themselves (each left out of
its own vote), and the nearest points are returned as evidence.

Ids, labels and all other columns play no part in a document's score.

Results for odd input: a null or empty text is a text without words, scored by the share
of toxic examples; labels that are null, without id or without document are passed over,
and of several labels for one id the greatest counts; without any usable label all scores
are 0; rows that repeat are scored each; rows without id are kept; own columns replace
those of the same name.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listinglake.llm.common import Recent, giving_back, more, settle, table
from listinglake.llm.wordhash import pieces

MAX_EXAMPLES = 8192
MAX_TERMS = 1024
MIN_Z = 5.0
MIN_EXAMPLES = 5  # toxic examples that a term must be in
NEIGHBOURS = 16
BLOCK = 64
# Weight of a term that is in every document; sets how much the proportion counts.
FLOOR = 0.03
# Distance added to that of a point when it votes: 1 / (NEAR + distance).
NEAR = 0.02
KNOWN_WORDS = 100_000  # words kept per worker and generation, see Recent
REST = ""  # the term of all words without a term of their own

WORD = re.compile(r"\w+")
BEGINNINGS = range(3, 9)


def terms_of(word: str) -> list[str]:
    return ["=" + word, *[word[:k] for k in BEGINNINGS if k <= len(word)]]


class Reader:
    """Term counts of texts over a vocabulary (term -> number)."""

    def __init__(self, vocabulary: dict[str, int]):
        self.vocabulary = vocabulary
        self.rest = vocabulary[REST]
        self.known = Recent(KNOWN_WORDS)

    def _look(self, words: list[str]) -> dict[str, tuple[int, ...]]:
        get = self.vocabulary.get
        return {
            w: tuple(i for i in map(get, terms_of(w)) if i is not None) for w in words
        }

    def counts(self, text: str) -> dict[int, int]:
        words = Counter(WORD.findall(text.lower()))
        known = self.known.hold(words.keys(), self._look)
        out: dict[int, int] = {}
        rest = 0
        for word, terms in known.items():
            n = words[word]
            if not terms:
                rest += n
            for i in terms:
                out[i] = out.get(i, 0) + n
        if rest:
            out[self.rest] = rest
        return out


class Index:
    """Block-max inverted index over points, and what their labels say."""

    def __init__(self, weights: np.ndarray, points: np.ndarray, toxic: np.ndarray, block=BLOCK):
        """weights: IDF per term; points: unit vectors, a row each; toxic: share per point."""
        # Similar points side by side: by their heaviest term, then by its weight.
        if len(points):
            heavy = points.argmax(1)
            order = np.lexsort((points.max(1), heavy))
            points, toxic = points[order], toxic[order]
        self.weights, self.toxic, self.block, self.size = weights, toxic, block, len(points)
        self.blocks = -(-len(points) // block)
        n_terms = len(weights)
        self.most = np.zeros((n_terms, self.blocks))  # greatest weight per term and block
        self.lists: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for t in range(n_terms):
            at = np.flatnonzero(points[:, t]) if len(points) else np.zeros(0, int)
            values = points[at, t] if len(points) else np.zeros(0)
            np.maximum.at(self.most[t], at // block, values)
            starts = np.searchsorted(at, np.arange(self.blocks + 1) * block)
            self.lists.append((at, values, starts))
        self.prior = 0.0
        self.single: dict[int, tuple] = {}  # answers to queries of one term
        self.curve = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    def unit(self, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """A text's terms and weights, scaled to length 1; ready as a query."""
        terms = np.array(sorted(counts), dtype=np.int64)
        values = np.array([counts[t] for t in terms.tolist()], dtype=float) * self.weights[terms]
        length = math.sqrt(float(values @ values))
        return terms, values / length if length else values

    def nearest(self, terms, values, k=NEIGHBOURS, without=-1) -> tuple[np.ndarray, np.ndarray]:
        """The k points of highest cosine, exactly; equals by number.  (numbers, cosines)"""
        found_at, found = np.zeros(0, dtype=np.int64), np.zeros(0)
        if not self.size or not len(terms):
            return found_at, found
        bound = values @ self.most[terms]
        least = -1.0
        for b in np.argsort(-bound, kind="stable").tolist():
            if bound[b] < least - 1e-12:
                break
            low = b * self.block
            score = np.zeros(min(self.block, self.size - low))
            for t, v in zip(terms.tolist(), values.tolist()):
                at, weight, starts = self.lists[t]
                part = slice(starts[b], starts[b + 1])
                score[at[part] - low] += v * weight[part]
            here = np.arange(low, low + len(score))
            if low <= without < low + len(score):
                here, score = np.delete(here, without - low), np.delete(score, without - low)
            found_at, found = np.append(found_at, here), np.append(found, score)
            best = np.lexsort((found_at, -found))[:k]
            found_at, found = found_at[best], found[best]
            if len(found) == k:
                least = found[-1]
        return found_at, found

    def vote(self, at: np.ndarray, cosine: np.ndarray) -> float:
        if not len(at):
            return self.prior
        weight = 1 / (NEAR + 1 - np.minimum(cosine, 1))
        return float(weight @ self.toxic[at] / weight.sum())

    def score(self, counts: dict[int, int]) -> tuple[float, np.ndarray, np.ndarray]:
        """(calibrated score, nearest points, cosines)."""
        if not self.size:
            return 0.0, np.zeros(0, dtype=np.int64), np.zeros(0)
        if not counts:
            return self.prior, np.zeros(0, dtype=np.int64), np.zeros(0)
        # Texts of one term have one direction, so they share the answer.
        term = next(iter(counts)) if len(counts) == 1 else None
        if term in self.single:
            return self.single[term]
        at, cosine = self.nearest(*self.unit(counts))
        answer = float(np.interp(self.vote(at, cosine), *self.curve)), at, cosine
        if term is not None:
            self.single[term] = answer
        return answer


def isotonic(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray):
    """Non-decreasing curve from votes to the share of toxic ones: (votes, shares)."""
    order = np.argsort(votes, kind="stable")
    steps: list[list[float]] = []  # sum of labels, weight, sum of votes
    for v, y, w in zip(votes[order], labels[order], weights[order]):
        steps.append([y * w, w, v * w])
        while len(steps) > 1 and steps[-2][0] * steps[-1][1] >= steps[-1][0] * steps[-2][1]:
            last = steps.pop()
            steps[-1] = [a + b for a, b in zip(steps[-1], last)]
    return (
        np.array([s[2] / s[1] for s in steps]),
        np.array([s[0] / s[1] for s in steps]),
    )


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def choose_terms(counted: DataFrame, n1: int, n0: int) -> list[str]:
    """The telling terms of ``counted`` (term, toxic, clean), at most MAX_TERMS."""
    n = n1 + n0
    if not n1 or not n0:
        return []
    share = "(toxic + clean) / double({n})".format(n=n)
    z = f"(toxic / double({n1}) - clean / double({n0})) / sqrt({share} * (1 - {share}) * {1 / n1 + 1 / n0})"
    rows = (
        counted.where(f"toxic >= {MIN_EXAMPLES} and toxic + clean < {n}")
        .withColumn("z", F.expr(z))
        .where(f"z >= {MIN_Z}")
        .orderBy(F.desc("z"), "term")
        .limit(MAX_TERMS)
        .select("term")
        .collect()
    )
    return [r["term"] for r in rows]


def fit(docs: DataFrame, labels: DataFrame) -> tuple[dict[str, int], Index]:
    """Learn from ``labels`` (doc_id, toxic) of ``docs`` (id, text)."""
    known = (
        labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic"))
        .where("id is not null and toxic is not null")
        .where(~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"))
        .join(docs.select("id").distinct(), "id", "left_semi")
    )
    sample = known.orderBy(F.xxhash64("id"), "id").limit(MAX_EXAMPLES)
    # At most MAX_EXAMPLES rows of two numbers; equal texts with one label are one example.
    examples = (
        docs.join(F.broadcast(sample), "id")
        .select("toxic", "text")
        .where("text is not null")
        .dropDuplicates(["toxic", "text"])
    )
    examples = settle(examples, "examples")
    sizes = {r["toxic"]: r["count"] for r in examples.groupBy("toxic").count().collect()}
    n1 = sum(n for y, n in sizes.items() if y > 0)
    n0 = sum(n for y, n in sizes.items() if y <= 0)

    def count_terms(batches):
        toxic, clean = Counter(), Counter()

        def flush():
            terms = list(toxic.keys() | clean.keys())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(terms, pa.string()),
                    pa.array([toxic[t] for t in terms], pa.int64()),
                    pa.array([clean[t] for t in terms], pa.int64()),
                ],
                names=["term", "toxic", "clean"],
            )
            toxic.clear()
            clean.clear()

        for batch in batches:
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                terms = {t for w in set(WORD.findall(text.lower())) for t in terms_of(w)}
                (toxic if y > 0 else clean).update(terms)
                if len(toxic) + len(clean) > 500_000:
                    yield from flush()
        yield from flush()

    counted = (
        examples.repartition(8)
        .mapInArrow(count_terms, "term string, toxic long, clean long")
        .groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )
    terms = choose_terms(counted, n1, n0)
    vocabulary = {t: i for i, t in enumerate([REST, *terms])}

    # Document frequencies over all documents: one row per term and task.
    def frequencies(batches):
        reader = Reader(vocabulary)
        total = np.zeros(len(vocabulary) + 1, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total[-1] += 1
                total[list(reader.counts(text or ""))] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["term", "n"]
        )

    found = docs.select("text").mapInArrow(giving_back(frequencies), "term int, n long")
    frequency = np.zeros(len(vocabulary) + 1)
    for r in found.groupBy("term").agg(F.sum("n").alias("n")).collect():
        frequency[r["term"]] = r["n"]
    weights = np.log((1 + frequency[-1]) / (1 + frequency[:-1])).clip(0) + FLOOR

    def read(batches):
        reader = Reader(vocabulary)
        for batch in batches:
            counts = [reader.counts(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([list(c) for c in counts], pa.list_(pa.int32())),
                    pa.array([list(c.values()) for c in counts], pa.list_(pa.int32())),
                ],
                names=["toxic", "terms", "counts"],
            )

    rows = examples.mapInArrow(read, "toxic int, terms array<int>, counts array<int>").collect()
    points: dict[tuple, list[int]] = {}
    for r in rows:  # at most MAX_EXAMPLES, with the counts of telling terms only
        key = tuple(sorted(zip(r["terms"], r["counts"])))
        # Texts without a telling word have one direction, whatever their length.
        if all(t == 0 for t, _ in key):
            key = tuple((t, 1) for t, _ in key)
        n = points.setdefault(key, [0, 0])
        n[0] += 1
        n[1] += r["toxic"] > 0
    keys = sorted(k for k in points if k)
    vectors = np.zeros((len(keys), len(vocabulary)))
    for i, key in enumerate(keys):
        for t, c in key:
            vectors[i, t] = c * weights[t]
    vectors /= np.maximum(np.sqrt((vectors**2).sum(1, keepdims=True)), 1e-300)
    n = np.array([points[k][0] for k in keys], dtype=float)
    share = np.array([points[k][1] for k in keys], dtype=float) / np.maximum(n, 1)
    index = Index(weights, vectors, share)
    index.prior = n1 / (n1 + n0) if n1 + n0 else 0.0
    # Calibrate on the examples; a point of one example has no say in its own vote.
    numbers = {key: i for i, key in enumerate(keys)}
    if len(keys):
        heavy = vectors.argmax(1)
        order = np.lexsort((vectors.max(1), heavy))
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        votes = np.array(
            [
                index.vote(
                    *index.nearest(
                        *index.unit(dict(key)),
                        without=int(place[i]) if n[i] == 1 else -1,
                    )
                )
                for key, i in numbers.items()
            ]
        )
        index.curve = isotonic(votes, share, n)
    return vocabulary, index


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with ``score``, ``predicted`` and ``evidence`` (nearest points: cosine, share)."""
    own = ["score", "predicted", "evidence"]
    base = docs.drop(*own)
    keep = base.columns
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    vocabulary, index = fit(rows, labels)
    # At most MAX_EXAMPLES points over MAX_TERMS terms.
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, index))
    columns = "score double, predicted int, evidence array<struct<cosine:double,toxic:double>>"

    def run(batches):
        vocabulary, index = shared.value
        reader = Reader(vocabulary)
        for batch in batches:
            for part in pieces(batch, text_col):
                scores, evidence = [], []
                for text in part.column(text_col).to_pylist():
                    value, at, cosine = index.score(reader.counts(text or ""))
                    scores.append(value)
                    evidence.append(
                        [
                            {"cosine": float(c), "toxic": float(index.toxic[i])}
                            for i, c in zip(at[:3].tolist(), cosine[:3].tolist())
                        ]
                    )
                kind = pa.list_(pa.struct([("cosine", pa.float64()), ("toxic", pa.float64())]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in keep]
                    + [
                        pa.array(scores, pa.float64()),
                        pa.array([int(x >= 0.5) for x in scores], pa.int32()),
                        pa.array(evidence, kind),
                    ],
                    names=[*keep, *own],
                )

    return base.mapInArrow(giving_back(run), more(base.schema, columns))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_documents(docs, table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "evidence"
    )
