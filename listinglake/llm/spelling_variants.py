"""Spelling variants: the words of a corpus that are one edit apart, by composed machines.

The vocabulary is an acceptor A, and T a transducer that replaces, inserts or deletes one
code point.  A o T o A accepts exactly the pairs of near words.  One machine of the whole
vocabulary would not fit a task, so the composition is cut at its initial states.

A pair's place is the length of its longest common prefix, and ``m`` the length of its
longer word.  All of its code points but the one at the place are common, so its words
agree on the ``m // 2`` first ones if the place lies behind them, and on the rest of them
at the end if it does not.  Each word therefore goes to four initial states: as the longer
or the shorter word of a pair, with its first half read, or with its second half left.
What a state leaves open of its words becomes a minimised acceptor, which is composed with
T and itself; T takes an inserted code point at its last possible place only, so that
every pair is accepted once, in one state.

A state that leaves too much open for a task (any number of words may share a half) is cut
again: the open part is halved, and the pairs that its words can form fall into one of the
two new states, by their place.  In the end one code point is open, and the alphabet bounds
the words.  Nothing is capped.  Forms are followed to their roots by pointer jumping.

Results for odd input: null texts have no words; a row without id counts with an empty id;
rows that repeat count each time; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listinglake.llm.common import settle, table
from listinglake.llm.wordhash import pieces

MIN_LENGTH = 5  # code points
MIN_COUNT = 3
RATIO = 2  # a form stands at least so many times as often as the word
TYPO_EVERY = 97

RUN = re.compile("[A-Za-zÀ-ÿ]+")

# Words a task holds before it sends their counts on.
HELD_WORDS = 300_000
# Code points that an initial state may leave open in all, and in one word.
MOST_OPEN = 1 << 19
LONGEST_OPEN = 64
ROWS = 20_000  # rows of a batch

# ---- counting -------------------------------------------------------------------


def words_of(doc_id: int | None, text: str, typo_every: int | None) -> Counter:
    """The counted words of a text, A-Z lower-cased.

    With ``typo_every``, one word in so many of each document loses a code point; which,
    a checksum of id and word decides.
    """
    # bytes.lower knows A-Z only.
    runs = Counter(RUN.findall(text.encode().lower().decode()))
    if not typo_every:
        return runs
    start = crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter = Counter()
    for word, n in runs.items():
        h = crc32(word.encode(), start)
        if h % typo_every == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
        out[word] += n
    return out


def word_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    typo_every: int | None = None,
) -> DataFrame:
    """(word, n): words of at least ``min_length`` code points and ``min_count`` occurrences."""

    def count(batches):
        total: dict[str, int] = {}
        for batch in batches:
            for part in pieces(batch, "text"):
                for doc_id, text in zip(
                    part.column("id").to_pylist(), part.column("text").to_pylist()
                ):
                    for word, n in words_of(doc_id, text or "", typo_every).items():
                        if len(word) >= min_length:
                            total[word] = total.get(word, 0) + n
                if len(total) >= HELD_WORDS:
                    yield from batches_of(total.items(), ["word", "n"], KINDS)
                    total = {}
        yield from batches_of(total.items(), ["word", "n"], KINDS)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    parts = rows.where("text is not null").mapInArrow(count, "word string, n long")
    total = parts.groupBy("word").agg(F.sum("n").alias("n"))
    return total.where(F.col("n") >= min_count)


KINDS = (pa.string(), pa.int64())


def batches_of(rows, names: list[str], kinds) -> Iterator[pa.RecordBatch]:
    held: list = []
    for row in rows:
        held.append(row)
        if len(held) >= ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)


# ---- machines -------------------------------------------------------------------


class Acceptor:
    """The minimised acceptor of sorted, distinct words.

    States are numbers; ``arcs[q]`` maps a code point to a state, ``final[q]`` tells
    whether a word ends there.  States of equal futures are one state.
    """

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        known: dict = {}
        path: list[list] = [[False, []]]  # states whose futures are not complete yet

        def close(depth: int, word: str) -> None:
            while len(path) > depth + 1:
                end, arcs = path.pop()
                future = (end, tuple(arcs))
                state = known.get(future)
                if state is None:
                    state = known[future] = self._add(end, arcs)
                path[-1][1].append((word[len(path) - 1], state))

        last = ""
        for word in words:
            depth = 0
            for a, b in zip(last, word):
                if a != b:
                    break
                depth += 1
            close(depth, last)
            path.extend([False, []] for _ in range(len(word) - depth))
            path[-1][0] = True
            last = word
        close(0, last)
        self.start = self._add(*path[0])

    def _add(self, end: bool, arcs: list) -> int:
        self.arcs.append(dict(arcs))
        self.final.append(end)
        return len(self.arcs) - 1


class OneEdit:
    """A o T o A for the open parts of words that agree on everything else.

    Composed states are (q, unedited, q), which only common code points reach, and
    (q, edited, r), from which both sides read the same.
    """

    def __init__(self, acceptor: Acceptor, behind: str):
        self.a = acceptor
        self.behind = behind  # the code point behind the open part, "" at a word's end
        self.both: dict[tuple[int, int], list[str]] = {}
        self.here: dict[int, list[tuple[str, str]]] = {}
        self.any: dict[int, bool] = {}

    def common(self, q: int, r: int) -> list[str]:
        """What the states (q, edited, r) accept: the common futures of q and r."""
        key = (q, r) if q < r else (r, q)
        found = self.both.get(key)
        if found is None:
            arcs, others = self.a.arcs[q], self.a.arcs[r]
            found = [""] if self.a.final[q] and self.a.final[r] else []
            if len(arcs) > len(others):
                arcs, others = others, arcs
            for c, to in arcs.items():
                other = others.get(c)
                if other is not None:
                    found += [c + w for w in self.common(to, other)]
            self.both[key] = found
        return found

    def edits(self, q: int) -> list[tuple[str, str]]:
        """Pairs of futures of q whose edit is the next code point; the longer one first."""
        found = self.here.get(q)
        if found is None:
            found = []
            arcs = list(self.a.arcs[q].items())
            for i, (c, to) in enumerate(arcs):
                for d, other in arcs[i + 1 :]:
                    found += [(c + w, d + w) for w in self.common(to, other)]
                # Inserted at its last possible place: the same code point doesn't follow.
                found += [
                    (c + w, w) for w in self.common(to, q) if (w or self.behind)[:1] != c
                ]
            self.here[q] = found
        return found

    def leads(self, q: int) -> bool:
        """Whether any pair is accepted from (q, unedited, q)."""
        found = self.any.get(q)
        if found is None:
            found = bool(self.edits(q)) or any(self.leads(to) for to in self.a.arcs[q].values())
            self.any[q] = found
        return found

    def pairs(self, longest: int) -> Iterator[tuple[str, str]]:
        """Accepted pairs whose longer part has ``longest`` code points."""
        todo = [("", self.a.start)]
        while todo:
            read, q = todo.pop()
            if not self.leads(q):
                continue
            for x, y in self.edits(q):
                if len(read) + len(x) == longest:
                    yield read + x, read + y
            todo += [(read + c, to) for c, to in self.a.arcs[q].items()]


def near_pairs(words: dict[str, int], m: int, p: int, s: int) -> Iterator[tuple]:
    """(word, n, other, its n) and the reverse for near words of one initial state.

    All words begin with the same ``p`` code points, end with the same ``s``, and have
    m or m - 1.  Of two near words the longer has m, and their place is in the open part.
    """
    if len(words) < 2 or all(len(w) < m for w in words):
        return
    any_word = next(iter(words))
    before, after = any_word[:p], any_word[len(any_word) - s :]
    open_parts = sorted(w[p : len(w) - s] for w in words)
    machine = OneEdit(Acceptor(open_parts), after[:1])
    for x, y in machine.pairs(m - p - s):
        a, b = before + x + after, before + y + after
        yield a, words[a], b, words[b]
        yield b, words[b], a, words[a]


# ---- the job --------------------------------------------------------------------


def _halved(rows: DataFrame) -> DataFrame:
    """Every row (word, n, m, p, s) in the two states that halve its open part."""
    half = "array(struct(p + (m - p - s) div 2 as p, s as s), struct(p as p, m - p - (m - p - s) div 2 as s))"
    rows = rows.select("word", "n", "m", F.explode(F.expr(half)).alias("c"))
    rows = rows.select("word", "n", "m", F.expr("cast(c.p as int) p"), F.expr("cast(c.s as int) s"))
    key = F.xxhash64("m", "p", "s", F.expr("substring(word, 1, p)"), F.expr("right(word, s)"))
    return rows.withColumn("key", key)


def _accepted(rows: DataFrame) -> DataFrame:
    """(word, n, other, other_n) of all near pairs, both ways, state by state."""

    def accept(batches):
        def states():
            key, held = None, {}
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns)):
                    if row[0] != key:
                        yield from held.items()
                        key, held = row[0], {}
                    _, word, n, m, p, s = row
                    # The hash only gathers them: states are told apart by what they read.
                    state = (m, p, s, word[:p], word[len(word) - s :])
                    held.setdefault(state, {})[word] = n
            yield from held.items()

        found = (x for (m, p, s, *_), words in states() for x in near_pairs(words, m, p, s))
        yield from batches_of(found, ["word", "n", "other", "other_n"], KINDS * 2)

    dealt = rows.select("key", "word", "n", "m", "p", "s").repartition("key")
    return dealt.sortWithinPartitions("key").mapInArrow(
        accept, "word string, n long, other string, other_n long"
    )


def near_words(
    words: DataFrame, most_open: int = MOST_OPEN, longest_open: int = LONGEST_OPEN
) -> DataFrame:
    """(word, n, other, other_n): all pairs of ``words`` (word, n) one edit apart, both ways."""
    m = F.explode(F.expr("array(length(word), length(word) + 1)"))
    rows = words.where("length(word) > 0").select(
        "word", "n", m.alias("m"), F.lit(0).alias("p"), F.lit(0).alias("s")
    )
    found = None
    while True:
        rows = settle(_halved(rows), "states")
        sizes = rows.groupBy("key").agg(
            F.count(F.lit(1)).alias("words"),
            F.sum(F.expr("m - p - s")).alias("open"),
            F.max(F.expr("m - p - s")).alias("longest"),
        )
        large = sizes.where(
            (F.col("words") > 1)
            & (F.col("longest") > 1)
            & ((F.col("open") > most_open) | (F.col("longest") > longest_open))
        )
        large = settle(large.select("key"), "large-states")
        if not large.take(1):
            here = _accepted(rows.where(F.expr("m - p - s") <= max(longest_open, 1)))
            return here if found is None else found.union(here)
        fit = rows.where(F.expr("m - p - s") <= max(longest_open, 1))
        here = settle(_accepted(fit.join(large, "key", "left_anti")), "near")
        found = here if found is None else found.union(here)
        rows = rows.join(large, "key", "left_semi").drop("key")


def variant_groups(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for ``words`` (word, n).

    The form is the near word of largest count (ties: the smallest) if that is at least
    ``ratio`` times the word's; the root is where the forms lead.
    """
    words = settle(words.select("word", "n"), "words")
    best = (
        near_words(words)
        .groupBy("word")
        .agg(
            F.count(F.lit(1)).alias("n_near"),
            F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"),
        )
        .select("word", "n_near", F.col("best.other").alias("other"), (-F.col("best.less")).alias("other_n"))
    )
    rows = words.join(best, "word", "left")
    has = F.col("other_n") >= ratio * F.col("n")
    rows = rows.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, F.col("other")).alias("form"), F.when(has, F.col("other_n")).alias("form_n"),
    )
    rows = settle(rows, "forms")
    # Each round every word looks where the word it points to points: twice as far.
    roots = settle(rows.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = roots.join(ahead, "root", "left")
        after = settle(
            after.select("word", F.coalesce("next", "root").alias("root"), F.expr("next is not null as moved")),
            "roots",
        )
        roots = after.select("word", "root")
        if not after.where("moved").take(1):
            break
    return rows.join(roots, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return variant_groups(word_counts(docs, typo_every=TYPO_EVERY))
