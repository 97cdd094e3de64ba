import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import pytest

from listinglake.llm import spelling_variants as sv
from llm_cases import frame


def plain_words(rows, every=97, length=5, least=3):
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if i is None else i}:{low}".encode())
            if h % every == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            out[low] += 1
    return {w: n for w, n in out.items() if len(w) >= length and n >= least}


def plain_groups(words):
    """By deletion: near words share a word that lacks one code point of each."""
    lacking = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            lacking[i, w[:i] + w[i + 1 :]].add(w)
    near = defaultdict(set)
    for some in lacking.values():
        for a in some:
            near[a] |= some - {a}
    for (_, short), some in lacking.items():
        if short in words:
            near[short] |= some
            for a in some:
                near[a].add(short)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 2 * n:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        f = form.get(w)
        out.append((w, n, len(near[w]), f, words.get(f), root))
    return sorted(out)


def documents(seed=3, n=60):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abé") for _ in range(rng.randrange(4, 9))) for _ in range(80)]
    rows = [(0, None), (1, ""), (None, "stands alone alone alone alone"), (2, "a1b2 ÀÖ×÷ß Ĉh")]
    for i in range(10, 10 + n):
        words = []
        for _ in range(rng.randrange(1, 120)):
            w = rng.choice(stems)
            at = rng.randrange(len(w))
            if rng.random() < 0.3:
                w = w[:at] + rng.choice("abé") * rng.randrange(2) + w[at + 1 :]
            words.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((i, " ".join(words)))
    return rows + rows[-2:]


COLUMNS = ["word", "n", "n_near", "form", "form_n", "root"]


def test_groups_against_plain_python(spark):
    rows = documents()
    docs = frame(spark, rows).withColumnRenamed("lang", "word").withColumnRenamed("source", "n")
    got = sv.variant_groups(sv.word_counts(docs, typo_every=7))
    want = plain_groups(plain_words(rows, 7))
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect())) == want
    assert sum(x[3] is not None for x in want) > 20 and any(x[5] != x[3] for x in want if x[3])


def test_query(spark, tmp_path):
    rows = documents(8, 200)
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = sv.op13_spelling_variants(spark, str(tmp_path))
    assert sorted(map(tuple, got.select(COLUMNS).collect())) == plain_groups(plain_words(rows))


@pytest.mark.parametrize("most,longest", [(1, 64), (20, 64), (10**6, 1), (10**6, 3)])
def test_states_cut_again_give_the_same_pairs(spark, most, longest):
    rng = random.Random(most + longest)
    words = {"".join(rng.choice("ab") for _ in range(rng.randrange(1, 9))): i for i in range(150)}
    words |= {"x" * 300: 1, "x" * 299: 2, "y" + "x" * 299: 3, "x" * 150 + "z" + "x" * 149: 4}
    frame_of = spark.createDataFrame(list(words.items()), "word string, n long")
    got = [tuple(r) for r in sv.near_words(frame_of, most, longest).collect()]
    assert len(got) == len(set(got))
    near = defaultdict(set)
    for a, n, b, k in got:
        assert words[a] == n and words[b] == k
        near[a].add(b)
    assert {w: len(x) for w, x in near.items()} == {
        w: k for w, _, k, *_ in plain_groups(words) if k
    }


def test_acceptor_is_minimal():
    words = sorted(a + b for a in ("walk", "talk", "chalk") for b in ("", "ed", "ing", "s"))
    machine = sv.Acceptor(words)
    futures = set()

    def future(q):
        out = {""} if machine.final[q] else set()
        for c, to in machine.arcs[q].items():
            out |= {c + x for x in future(to)}
        futures.add(frozenset(out))
        return out

    assert future(machine.start) == set(words)
    assert len(futures) == len(machine.arcs)


def test_no_rows(spark):
    docs = frame(spark, documents()).limit(0)
    assert sv.variant_groups(sv.word_counts(docs)).count() == 0
