import random
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from listinglake.llm import token_files as tf
from llm_cases import corpus, frame
from test_tokens import texts

JSON = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(JSON)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [2]


def plain(rows):
    """Rows with equal ids may follow each other in any order, so equal rows only here."""
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = ids_of(text)
        out.append((i, start, len(ids), crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


def key(row):
    return repr(row)


@pytest.mark.parametrize("most", [10**6, 3])
def test_whole_texts_encode_as_the_library_does(most):
    tool = tf.Encoder(JSON, most)
    many = texts(500, 9) + ["A \x1c b\x85c\xa0d e ", "a ́b", "<|ENDOFTEXT|> <|endoftext|>", "x" * 5000]
    many += ["it's, he'll. 'S! a's; b, c. d! e? 1, 2.\n(f, g), h.. i,, é, j. ", "a, \u0301b .c \u0327, d"]
    for i in range(0, len(many), 60):
        part = many[i : i + 60]
        ids, bounds = tool.encode(pa.array(part), 2)
        got = [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
        assert got == [ids_of(t) for t in part]
    assert tool.encode(pa.array([], "string"), 2)[0].tolist() == []


def test_numbers_of_all_lengths_come_back():
    rng = random.Random(1)
    values = [0, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1]
    for n in (0, 1, 3, 4, 5, 1000):
        some = np.array([rng.choice(values) for _ in range(n)], dtype=np.uint32)
        control, data = tf.pack(some)
        assert len(control) == (n + 3) // 4
        back, used = tf.unpack(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), n)
        assert back.tolist() == some.tolist() and used == len(data)


def test_a_damaged_block_is_refused():
    block = tf.pack_block(0, 0, [1, None], np.array([1, 2]), np.array([5, 6, 300]))
    (found,) = tf.unpack_blocks(block + b"\n")
    assert found[2].to_pylist() == [1, None] and found[4].tolist() == [5, 6, 300]
    with pytest.raises(ValueError, match="damaged"):
        list(tf.unpack_blocks(block[:-6] + b"x" + block[-5:]))
    with pytest.raises(ValueError, match="not a block"):
        list(tf.unpack_blocks(b"x" + block))


@pytest.mark.parametrize("block,per_file", [(1 << 20, 32), (100, 2)])
def test_files_round_trip(spark, tmp_path, block, per_file):
    rows = corpus()
    docs = frame(spark, rows).withColumn("ids", F.lit("x")).withColumn("part", F.lit(1))
    folder = str(tmp_path / "tokens")
    tf.write_token_files(docs, JSON, folder, block_ids=block, file_blocks=per_file)
    got = tf.read_token_files(spark, folder)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32", "ids"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain(rows), key=key)
    vocabulary = spark.read.parquet(f"{folder}/vocabulary").orderBy("rank").collect()
    counts = np.bincount([i for r in plain(rows) for i in r[4]])
    want = sorted(((-n, i) for i, n in enumerate(counts.tolist()) if n))
    assert [(-r["n"], r["token"]) for r in vocabulary] == want
    assert [r["rank"] for r in vocabulary] == list(range(len(want)))


def test_repeated_ids_with_other_texts_have_their_own_places(spark, tmp_path):
    rows = [(5, "one two"), (5, "three"), (5, None), (None, "x y z"), (None, ""), (1, "early")]
    tf.write_token_files(frame(spark, rows), JSON, str(tmp_path / "t"))
    got = sorted(map(tuple, tf.read_token_files(spark, str(tmp_path / "t")).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, None, 1, 5, 5, 5]
    assert [r[1] for r in got] == np.cumsum([0, *(r[2] for r in got)])[:-1].tolist()
    want = sorted((i, ids_of(t)) for i, t in rows if i is not None)
    assert sorted((r[0], r[4]) for r in got if r[0] is not None) == want


def test_query_and_no_rows(spark, tmp_path):
    rows = [(i, t) for i, t in corpus() if i is not None]
    frame(spark, rows).write.parquet(str(tmp_path / "a" / "documents.parquet"))
    got = tf.op12_token_files(spark, str(tmp_path / "a"))
    want = [r[:4] for r in plain(rows)]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    frame(spark, rows).limit(0).write.parquet(str(tmp_path / "b" / "documents.parquet"))
    assert tf.op12_token_files(spark, str(tmp_path / "b")).count() == 0
