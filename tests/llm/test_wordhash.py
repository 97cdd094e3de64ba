import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from listinglake.llm import wordhash
from llm_cases import words

TEXTS = st.lists(st.none() | st.text("ab É\t\n\x0b", max_size=30), min_size=1, max_size=6)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_are_cut_as_bytes_are_split(texts):
    got = wordhash.words_of(pa.array(texts, pa.string()))
    flat = [bytes(got.data[a:b]) for a, b in zip(got.start, got.end)]
    split = [flat[a:b] for a, b in zip(got.first[:-1], got.first[1:])]
    assert split == [words(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_hashes_depend_on_the_words_only(texts):
    got = wordhash.words_of(pa.array(texts, pa.string()))
    hashes = wordhash.word_hashes(got).tolist()
    flat = [bytes(got.data[a:b]) for a, b in zip(got.start, got.end)]
    assert len(set(zip(flat, hashes))) == len(set(flat)) == len(set(hashes))


def test_windows_and_spans_of_equal_words_are_equal():
    got = wordhash.words_of(pa.array(["a b c a b c a b c x", "a b c"]))
    hashes = wordhash.word_hashes(got)
    for k in (3, 9):
        windows = wordhash.window_hashes(hashes, k)
        assert len(windows) == len(hashes) - k + 1
    three = wordhash.window_hashes(hashes, 3)
    assert three[0] == three[3] == three[6] != three[1]
    import numpy as np

    start, end = np.array([0, 3, 1, 10]), np.array([3, 6, 4, 13])
    spans = wordhash.span_hashes(hashes, start, end)
    assert spans[0] == spans[1] == spans[3] != spans[2]


def test_slices_hold_every_row_once():
    batch = pa.RecordBatch.from_pydict({"t": ["x" * n for n in (5, 50, 0, 7, 7, 100)]})
    parts = list(wordhash.pieces(batch, "t", limit=20))
    assert pa.Table.from_batches(parts).to_pydict() == batch.to_pydict()
    assert len(parts) > 2
    assert list(wordhash.pieces(batch.slice(0, 0), "t")) == []
