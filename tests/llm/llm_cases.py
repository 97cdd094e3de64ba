"""Small corpora for the training-data operators, and plain Python to compare with."""

import random
import re

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall((text or "").encode())


def lower(raw):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in raw)


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def corpus(seed=7):
    """(doc_id, text): copies, near copies, shared passages, and odd rows."""
    rng = random.Random(seed)
    rows = [(None, prose(rng, 70)), (0, None), (1, ""), (2, "one"), (3, "  \t\n "), (4, "a b c d")]
    passage = prose(rng, 60)
    base = prose(rng, 120)
    for i in range(10, 40):
        text = prose(rng, rng.randrange(1, 200))
        if i % 4 == 0:
            text = f"{text} {passage} {prose(rng, 9)}"
        rows.append((i, text))
    for i in range(40, 60):  # near copies of one text
        part = base.split()
        for _ in range(rng.randrange(0, 5)):
            part[rng.randrange(len(part))] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(part)))
    for i in range(60, 75):  # exact copies, in other case and spacing for some
        rows.append((i, base.upper() if i % 5 == 0 else base.replace(" ", "\n", i % 3)))
    rows.append((80, " ".join(["same"] * 3000)))  # long, one word only
    rows.append((81, " ".join(["same"] * 2500)))
    rows.append((82, prose(rng, 20000)))
    rows.append((12, dict(rows)[12]))  # a repeated row
    return rows


def frame(spark, rows):
    full = [(i, t, "en", f"src{(i or 0) % 3}", None if t is None else len(t)) for i, t in rows]
    return spark.createDataFrame(full, DOCS).repartition(3)


def as_set(rows):
    return sorted(map(tuple, rows), key=repr)
