"""Repeated long passages: windows of k words as edges of a De Bruijn graph, compacted.

The nodes of the graph are sequences of k-1 words, its edges the windows of k words that
some document holds.  A path along which no document branches off repeats as a whole, so
one row stands for all of its edges.

1. Paths.  Every window is filed under its minimizer, the least hash among the short word
   runs it covers.  Equal windows have equal minimizers, so a repeat can only be among the
   windows of one minimizer.  Consecutive windows under one minimizer form a path piece.
2. Branches.  One grouping by minimizer tells which are found in several documents, and
   which of those with more than one piece, that is, where the graph branches.
3. Compaction.  A second scan leaves out all other minimizers.  A piece that does not
   branch is a single row; one that branches is a row for each window.  A join with the
   smallest document of each piece or window gives the source coordinates of every repeat.
4. Cutting.  The spans of a document are joined to its text, which drops the words.

Windows are compared by 128 bits of hash over their words, under which two different
passages are equal with a chance of 2**-128 a pair.  The two minimizer facts travel
as bit tables of fixed size, that at most let a few rows too many through.

Results for odd input: a null or empty text has no words; texts below k words have no
windows; a row without id neither loses words nor counts as a source; rows that repeat an
id are one document, so they do not remove each other's words; other columns stay as
they are, and own columns replace those of the same name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listinglake.llm.common import giving_back, mark_table, marked, more, settle, table, unused
from listinglake.llm.wordhash import (
    pieces, span_hashes, window_hashes, word_hashes, words_of,
)

WINDOW = 50
SHORT_RUN = 16  # words under a minimizer; any window covers WINDOW - SHORT_RUN + 1 of them
PIECE = 1 << 19  # bytes of text looked at together


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by doubling."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[: len(values) - size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _paths(column: pa.Array, window: int, short_run: int):
    """(word hashes, first word of each text, path pieces) of a batch of texts.

    Pieces are arrays: text, first window as a word of the batch, number of windows,
    minimizer.
    """
    words = words_of(column)
    hashes = word_hashes(words)
    first = words.first
    n = len(hashes) - window + 1
    if n <= 0:
        none = np.zeros(0, dtype=np.int64)
        return hashes, first, (none, none, none, np.zeros(0, dtype=np.uint64))
    least = _sliding_min(window_hashes(hashes, short_run), window - short_run + 1)[:n]
    at = np.arange(n)
    text = np.searchsorted(first, at, side="right") - 1
    whole = at + window <= first[text + 1]
    begins = whole.copy()
    begins[1:] &= ~(whole[:-1] & (least[1:] == least[:-1]) & (text[1:] == text[:-1]))
    start = np.flatnonzero(begins)
    # A piece ends at the next piece or at the end of its text's windows.
    last = np.maximum(first[text[start] + 1] - window + 1, start)
    count = np.minimum(np.append(start[1:], n), last) - start
    return hashes, first, (text[start], start, count, least[start])


def repeated_spans(
    docs: DataFrame, id_col: str, text_col: str, window: int = WINDOW, short_run: int = SHORT_RUN
) -> DataFrame:
    """(id, print, start, windows): runs of windows that also start in a smaller id.

    ``start`` counts words from 0, ``print`` tells texts apart that share an id.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.xxhash64(text_col).alias("print"),
        F.col(text_col).alias("text"),
    ).where("id is not null and text is not null")

    def minimizers(batches):
        for batch in batches:
            for part in pieces(batch, "text", PIECE):
                hashes, _, (text, start, count, least) = _paths(
                    part.column("text"), window, short_run
                )
                piece = span_hashes(hashes, start, start + count + window - 1)
                ids = part.column("id").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(least.view(np.int64)),
                        pa.array(piece.view(np.int64)),
                        pa.array(ids[text]),
                    ],
                    names=["m", "piece", "id"],
                )

    met = (
        rows.select("id", "text")
        .mapInArrow(giving_back(minimizers), "m long, piece long, id long")
        .groupBy("m")
        .agg(
            F.min("id").alias("a"), F.max("id").alias("b"),
            F.min("piece").alias("p"), F.max("piece").alias("q"),
        )
        .where("a < b")
        .select("m", F.expr("p < q").alias("branches"))
    )
    met = settle(met, "minimizers")
    repeated = mark_table(met, "m")
    branching = mark_table(met.where("branches"), "m")
    bits = docs.sparkSession.sparkContext.broadcast((repeated, branching))

    def edges(batches):
        repeated, branching = bits.value
        for batch in batches:
            for part in pieces(batch, "text", PIECE):
                hashes, first, (text, start, count, least) = _paths(
                    part.column("text"), window, short_run
                )
                take = marked(repeated, least)
                text, start, count, least = (x[take] for x in (text, start, count, least))
                split = marked(branching, least)
                times = np.where(split, count, 1)
                begin = np.cumsum(times) - times
                step = np.arange(int(times.sum())) - np.repeat(begin, times)
                at = np.repeat(start, times) + step
                long = np.where(np.repeat(split, times), 1, np.repeat(count, times))
                text = np.repeat(text, times)
                end = at + long + window - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(span_hashes(hashes, at, end, 1).view(np.int64)),
                        pa.array(span_hashes(hashes, at, end, 2).view(np.int64)),
                        pa.array(part.column("id").to_numpy(zero_copy_only=False)[text]),
                        pa.array(part.column("print").to_numpy(zero_copy_only=False)[text]),
                        pa.array((at - first[text]).astype(np.int32)),
                        pa.array(long.astype(np.int32)),
                    ],
                    names=["h1", "h2", "id", "print", "start", "windows"],
                )

    found = rows.mapInArrow(
        giving_back(edges), "h1 long, h2 long, id long, print long, start int, windows int"
    )
    found = settle(found, "edges")
    source = (
        found.groupBy("h1", "h2")
        .agg(F.min("id").alias("source"), F.max("id").alias("last"))
        .where("source < last")
        .drop("last")
    )
    # Written, so that both sides of the join are dealt for it and a hot key can be split.
    source = settle(source, "sources")
    return (
        found.join(source, ["h1", "h2"])
        .where("id > source")
        .select("id", "print", "start", "windows")
    )


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    short_run: int = SHORT_RUN,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept_text`` (kept words, one space)."""
    spans = (
        repeated_spans(docs, id_col, text_col, window, short_run)
        .groupBy("id", "print")
        .agg(F.sort_array(F.collect_list(F.struct("start", "windows"))).alias("spans"))
        .select(F.col("id").alias("_id"), F.col("print").alias("_print"), "spans")
    )
    own = ["n_words", "n_removed", "kept_text"]
    base = docs.drop(*own)
    start_col, windows_col = unused(base, "_start", "_windows")
    joined = base.join(
        spans,
        (base[id_col].cast("long") == spans["_id"])
        & (F.xxhash64(base[text_col]) == spans["_print"]),
        "left",
    ).select(
        *[base[c] for c in base.columns],
        spans["spans"].getField("start").alias(start_col),
        spans["spans"].getField("windows").alias(windows_col),
    )
    keep = base.columns

    def cut(batches):
        for batch in batches:
            texts = batch.column(text_col).cast(pa.large_binary()).to_pylist()
            starts = batch.column(start_col).to_pylist()
            counts = batch.column(windows_col).to_pylist()
            n_words, n_removed, kept = [], [], []
            for text, start, count in zip(texts, starts, counts):
                words = (text or b"").split()  # the separators of bytes.split are ours
                n_words.append(len(words))
                if start:
                    edge = np.zeros(len(words) + 1, dtype=np.int64)
                    begin = np.array(start)
                    np.add.at(edge, begin, 1)
                    np.add.at(edge, begin + np.array(count) + window - 1, -1)
                    stay = np.cumsum(edge[:-1]) == 0
                    words = [words[i] for i in np.flatnonzero(stay).tolist()]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep]
                + [
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                names=[*keep, *own],
            )

    schema = more(
        joined.select(*keep).schema, "n_words long, n_removed long, kept_text string"
    )
    return joined.mapInArrow(cut, schema)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )
