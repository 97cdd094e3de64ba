"""Token-id files: frequency-ranked ids in a byte-aligned code with separate control bytes.

Writing.  Every text is encoded with the library and closed with an end id.  Each distinct
piece between blanks is encoded once per worker: the tokenizer's words never reach over
white space, so the pieces' ids in a row are the text's.  The ids are counted over all
documents; the most frequent id gets rank 0, the next one rank 1.  Documents are dealt by
ranges of their id, sorted, and packed into blocks of whole documents.

A block holds, little-endian:

    8 bytes   MAGIC
    6 int64   bytes of the block, range it belongs to, ids of the range before it,
              documents, ids, bytes of the lengths' data
    int64     the documents' ids, then a byte each: 1 if the id is null
    lengths   control bytes, data bytes
    ranks     control bytes, data bytes
    uint32    CRC-32 of all before

A control byte tells of four values, two bits each, how many bytes (1 to 4) their data
takes.  Files are blocks one after another with a line feed behind each; the ranks'
meaning is in ``vocabulary`` (rank, token, n), the ranges' sizes and the ids before them in
``ranges`` (part, ids, base), both Parquet, beside the folder ``blocks``.

Reading.  A 256-row table gives the lengths of the four values of a control byte, their
running sum where each begins; gathering the bytes there decodes a whole block at once.

Results for odd input: a null text counts as empty, so its document holds the end id only;
rows without id come first; rows that repeat an id follow each other in the order they
were read; an empty table gives an empty folder and no rows; other columns are not read.
"""

from __future__ import annotations

import os
import uuid
import zlib
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listinglake.llm.common import settle, table
from listinglake.llm.wordhash import pieces
from listinglake.session import checkpoint_dir

MAGIC = b"TOKBLK1\n"
END_ID = 2
BLOCK_IDS = 1 << 20  # a block is closed once it has so many ids
FILE_BLOCKS = 32  # blocks of a file, at most
COUNT_SLICES = 16
SLICE_BYTES = 4 << 20  # text encoded at once
KNOWN_PIECES = 1_500_000  # pieces kept per worker
KNOWN_IDS = 1 << 23  # and their ids
LONE_MARK = "([A-Za-z0-9])([.,;:!?])([ \n])"
LONG_PIECE = 64  # characters; longer ones are not kept

# ---- encoding -------------------------------------------------------------------


class Encoder:
    """The library's ids of whole texts, every known piece looked up."""

    def __init__(self, path: str, most: int = KNOWN_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.vocabulary = self.library.get_vocab_size()
        self.most = most
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {"": 0}
        self.ids = np.zeros(0, dtype=np.uint32)
        self.bounds = np.zeros(2, dtype=np.int64)  # piece i is ids[bounds[i]:bounds[i + 1]]

    def _learn(self, new: list[str]) -> None:
        """Encode unknown pieces, all in one text; offsets tell whose ids they are."""
        if not new:
            return
        found = self.library.encode(" ".join(new), add_special_tokens=False)
        ids = np.array(found.ids, dtype=np.uint32)
        starts = np.fromiter((a for a, _ in found.offsets), np.int64, len(ids))
        lengths = np.fromiter(map(len, new), np.int64, len(new))
        owner = np.searchsorted(np.cumsum(lengths + 1), starts, side="right")
        sizes = np.bincount(owner, minlength=len(new))
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
        self.ids = np.concatenate([self.ids, ids])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(sizes)])

    def encode(self, texts: pa.Array, end: int | None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's begin and the last one's end)."""
        if len(self.number) > self.most or len(self.ids) > KNOWN_IDS:
            self._forget()
        # A-Z as the tokenizer would lower them, so that fewer pieces are distinct; not
        # where a special token may stand, whose capitals count.
        low = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        # A single mark between a word and a blank is a word of its own for the tokenizer.
        low = pc.replace_substring_regex(low, LONE_MARK, r"\1 \2\3")
        # These are white space for the tokenizer, and no mark combines with them.
        for blank in "\n\t":
            low = pc.replace_substring(low, blank, " ")
        split = pc.split_pattern(low, " ")
        flat = split.flatten().dictionary_encode()
        distinct = flat.dictionary.to_pylist()
        number = np.fromiter(map(self.number.get, distinct, repeat(-1)), np.int64, len(distinct))
        unknown = np.flatnonzero(number < 0)
        new = [distinct[i] for i in unknown.tolist()]
        number[unknown] = len(self.number) + np.arange(len(new))
        self._learn(new)
        number = number[flat.indices.to_numpy(zero_copy_only=False)]
        begin = self.bounds[number]
        size = self.bounds[number + 1] - begin
        to = np.cumsum(size)
        total = int(to[-1]) if len(to) else 0
        at = np.repeat(begin - (to - size), size) + np.arange(total)
        ids = self.ids[at]
        last = np.cumsum(split.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
        ends = to[last - 1] if len(texts) else np.zeros(0, np.int64)
        if end is not None:
            ids = np.insert(ids, ends, end).astype(np.uint32)
            ends = ends + np.arange(1, len(texts) + 1)
        if any(len(p) > LONG_PIECE for p in new):
            self._forget()
        return ids, np.concatenate([[0], ends]).astype(np.int64)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def binary_of(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A binary array of the slices of ``data`` between ``bounds`` (in elements)."""
    at = (bounds * data.itemsize).astype(np.int64)
    buffers = [None, pa.py_buffer(at.tobytes()), pa.py_buffer(np.ascontiguousarray(data).tobytes())]
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, buffers).cast(pa.binary())


def _encoded(docs: DataFrame, path: str, end: int) -> DataFrame:
    """Rows (id, seq, ids) of the documents, and rows (slice, counts) of each task's ids."""
    schema = "id long, seq long, ids binary, slice int, counts binary"
    names = ["id", "seq", "ids", "slice", "counts"]

    def encode(batches):
        tool = encoder(path)
        kind = np.uint16 if max(tool.vocabulary, end + 1) <= 1 << 16 else np.uint32
        counts = np.zeros(max(tool.vocabulary, end + 1), dtype=np.int64)
        for batch in batches:
            for part in pieces(batch, "text", SLICE_BYTES):
                n = part.num_rows
                ids, bounds = tool.encode(part.column("text").fill_null(""), end)
                counts += np.bincount(ids, minlength=len(counts))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"), part.column("seq"), binary_of(ids.astype(kind), bounds),
                        pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()),
                    ],
                    names=names,
                )
        full = [(i, c) for i, c in enumerate(np.array_split(counts, COUNT_SLICES)) if c.any()]
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(full), pa.int64()), pa.nulls(len(full), pa.int64()), pa.nulls(len(full), pa.binary())]
            + [
                pa.array([i for i, _ in full], pa.int32()),
                pa.array([c.tobytes() for _, c in full], pa.binary()),
            ],
            names=names,
        )

    return docs.withColumn("seq", F.monotonically_increasing_id()).mapInArrow(encode, schema)


def frequencies(encoded: DataFrame, size: int) -> np.ndarray:
    """How often each id stands in all documents; added up slice by slice in tasks.

    The driver gets one number per entry of the vocabulary.
    """

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[i] = total.get(i, 0) + np.frombuffer(counts, dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(total), pa.int32()),
                pa.array([x.tobytes() for x in total.values()], pa.binary()),
            ],
            names=["slice", "counts"],
        )

    parts = encoded.where("slice is not null").select("slice", "counts").repartition("slice")
    out = np.array_split(np.zeros(size, dtype=np.int64), COUNT_SLICES)
    for row in parts.mapInArrow(add, "slice int, counts binary").collect():
        out[row["slice"]] += np.frombuffer(row["counts"], dtype=np.int64)
    return np.concatenate(out)


# ---- the code -------------------------------------------------------------------

# For every control byte, the bytes of its four values.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of numbers below 2**32."""
    values = np.ascontiguousarray(values, dtype="<u4")
    code = (values > 0xFF).astype(np.uint8)
    width = 2
    if len(values) and values.max() > 0xFFFF:
        code += (values > 0xFFFF).view(np.uint8)
        code += (values > 0xFFFFFF).view(np.uint8)
        width = 4
    four = np.zeros((len(values) + 3) // 4 * 4, dtype=np.uint8)
    four[: len(values)] = code
    control = four[0::4] | four[1::4] << 2 | four[2::4] << 4 | four[3::4] << 6
    raw = values.astype(f"<u{width}").view(np.uint8).reshape(-1, width)
    return control.tobytes(), raw[np.arange(width, dtype=np.uint8) <= code[:, None]].tobytes()


def unpack(control: np.ndarray, data: np.ndarray, n: int) -> tuple[np.ndarray, int]:
    """(the ``n`` numbers, how many data bytes they take)."""
    length = LENGTHS[control].reshape(-1)[:n]
    if not n:
        return np.zeros(0, dtype=np.uint32), 0
    begin = np.cumsum(length, dtype=np.int64)
    used = int(begin[-1])
    begin -= length
    out = data[begin].astype(np.uint32)
    for j in range(1, int(length.max())):
        has = np.flatnonzero(length > j)
        out[has] |= data[begin[has] + j].astype(np.uint32) << np.uint32(8 * j)
    return out, used


def pack_block(part: int, before: int, doc_ids: list, sizes: np.ndarray, ranks: np.ndarray) -> bytes:
    control, data = pack(sizes)
    rank_control, rank_data = pack(ranks)
    body = b"".join(
        [
            np.array([i or 0 for i in doc_ids], dtype="<i8").tobytes(),
            bytes(i is None for i in doc_ids),
            control, data, rank_control, rank_data,
        ]
    )
    head = [8 + 48 + len(body) + 4, part, before, len(doc_ids), len(ranks), len(data)]
    out = MAGIC + np.array(head, dtype="<i8").tobytes() + body
    return out + zlib.crc32(out).to_bytes(4, "little")


def block_heads(content: bytes):
    """(place, size, part, before, documents, ids, bytes of the lengths) of a file's blocks."""
    at = 0
    while at < len(content):
        if content[at : at + 8] != MAGIC:
            raise ValueError("not a block of token ids")
        head = np.frombuffer(content, "<i8", 6, at + 8).tolist()
        yield at, *head
        at += head[0] + 1  # a line feed stands behind the block


def unpack_blocks(content: bytes):
    """(part, before, document ids, sizes, ranks) of every block of a file."""
    raw = np.frombuffer(content, dtype=np.uint8)
    for at, size, part, before, docs, ids, data_bytes in block_heads(content):
        end = at + size - 4
        if zlib.crc32(memoryview(content)[at:end]) != int.from_bytes(content[end : end + 4], "little"):
            raise ValueError("a block of token ids is damaged")
        at += 56
        doc_ids = np.frombuffer(content, "<i8", docs, at)
        null = raw[at + 8 * docs : at + 9 * docs].astype(bool)
        at += 9 * docs
        controls = (docs + 3) // 4
        sizes, _ = unpack(raw[at : at + controls], raw[at + controls :], docs)
        at += controls + data_bytes
        controls = (ids + 3) // 4
        ranks, _ = unpack(raw[at : at + controls], raw[at + controls : end], ids)
        yield part, before, pa.array(doc_ids, pa.int64(), mask=null), sizes, ranks


# ---- files ----------------------------------------------------------------------


def write_token_files(
    docs: DataFrame,
    path: str,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end: int = END_ID,
    block_ids: int = BLOCK_IDS,
    file_blocks: int = FILE_BLOCKS,
) -> None:
    """Encode ``docs`` with the tokenizer at ``path`` and write the files below ``folder``."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    encoded = settle(_encoded(rows, path, end), "token-ids", compression="zstd")
    size = max(encoder(path).vocabulary, end + 1)
    counts = frequencies(encoded, size)
    tokens = np.lexsort((np.arange(size), -counts))
    tokens = tokens[counts[tokens] > 0]
    vocabulary = [(i, int(t), int(counts[t])) for i, t in enumerate(tokens)]
    schema = "rank int, token long, n long"
    spark.createDataFrame(vocabulary, schema).coalesce(1).write.parquet(f"{folder}/vocabulary")
    rank = np.zeros(size, dtype=np.uint32)
    rank[tokens] = np.arange(len(tokens), dtype=np.uint32)
    ranks_of = spark.sparkContext.broadcast(rank)
    kind = np.uint16 if size <= 1 << 16 else np.uint32

    def blocks(batches):
        held: list = []
        doc_ids: list = []
        part, before, waiting = None, 0, 0

        def close():
            sizes = np.array([len(x) // kind().itemsize for x in held], dtype=np.uint32)
            ids = np.frombuffer(b"".join(held), dtype=kind)
            return pack_block(part, before, doc_ids, sizes, ranks_of.value[ids])

        def row(block):
            return pa.RecordBatch.from_arrays([pa.array([block], pa.binary())], names=["block"])

        for batch in batches:
            for doc_id, ids, part_now in zip(*(batch.column(c).to_pylist() for c in ("id", "ids", "part"))):
                part = part_now
                doc_ids.append(doc_id)
                held.append(ids)
                waiting += len(ids) // kind().itemsize
                if waiting >= block_ids:
                    yield row(close())
                    before += waiting
                    held, doc_ids, waiting = [], [], 0
        if held:
            yield row(close())

    sorted_rows = (
        encoded.where("slice is null")
        .select("id", "seq", "ids")
        .repartitionByRange("id", "seq")
        .sortWithinPartitions("id", "seq")
        .withColumn("part", F.spark_partition_id())
        .select("id", "ids", "part")
    )
    # A string is its bytes to the writer of text files; each block is one "line".
    (
        sorted_rows.mapInArrow(blocks, "block binary")
        .select(F.col("block").cast("string").alias("value"))
        .write.option("maxRecordsPerFile", file_blocks)
        .text(f"{folder}/blocks")
    )

    def heads(batches):
        for batch in batches:
            for content in batch.column(0):
                found = [(x[2], x[5]) for x in block_heads(content.as_buffer().to_pybytes())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in found], pa.int32()), pa.array([x[1] for x in found], pa.int64())],
                    names=["part", "ids"],
                )

    # A row for each range, so no more than the shuffle has partitions.
    ranges = _files(spark, folder).mapInArrow(heads, "part int, ids long")
    ranges = ranges.groupBy("part").agg(F.sum("ids").alias("ids")).orderBy("part").collect()
    base = np.cumsum([0, *(r["ids"] for r in ranges)]).tolist()
    spark.createDataFrame(
        [(r["part"], r["ids"], b) for r, b in zip(ranges, base)], "part int, ids long, base long"
    ).coalesce(1).write.parquet(f"{folder}/ranges")


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").load(f"{folder}/blocks").select("content")


def read_token_files(
    spark: SparkSession, folder: str, with_ids: bool = True
) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, and ids if asked for) of every document.

    ``start`` counts the ids of all documents before it.
    """
    found = spark.read.parquet(f"{folder}/vocabulary").orderBy("rank").collect()  # one vocabulary
    tokens = spark.sparkContext.broadcast(np.array([r["token"] for r in found], dtype="<u4"))
    files = _files(spark, folder)
    ids_ddl = ", ids array<long>" if with_ids else ""
    names = ["part", "doc_id", "within", "n_tokens", "ids_crc32"] + ["ids"] * with_ids

    def decode(batches):
        for batch in batches:
            for content in batch.column(0):
                for part, before, doc_ids, sizes, ranks in unpack_blocks(content.as_buffer().to_pybytes()):
                    ids = tokens.value[ranks]
                    to = np.cumsum(sizes, dtype=np.int64)
                    begin = to - sizes
                    crc = [zlib.crc32(ids[a:b]) for a, b in zip(begin.tolist(), to.tolist())]
                    columns = [
                        pa.array(np.full(len(sizes), part, np.int32)), doc_ids,
                        pa.array(before + begin), pa.array(sizes.astype(np.int64)), pa.array(crc, pa.int64()),
                    ]
                    if with_ids:
                        bounds = pa.array(np.concatenate([[0], to]), pa.int32())
                        columns.append(pa.ListArray.from_arrays(bounds, pa.array(ids.astype(np.int64))))
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"part int, doc_id long, within long, n_tokens long, ids_crc32 long{ids_ddl}"
    rows = files.mapInArrow(decode, schema)
    ranges = spark.read.parquet(f"{folder}/ranges").select("part", "base")
    rows = rows.join(F.broadcast(ranges), "part")  # a row per range of the writing shuffle
    rest = ["ids"] if with_ids else []
    return rows.select("doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32", *rest)


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = f"{checkpoint_dir(spark)}/listinglake/token-files-{uuid.uuid4().hex}"
    write_token_files(docs, public_tokenizers.path("word_bpe_49k.json"), folder)
    return read_token_files(spark, folder, with_ids=False)
