"""SentencePiece encoding for merge-type (BPE) vocabularies, and decoding.

Encoding keeps an agenda of adjacent symbol pairs that form a piece, ordered by score and
then by place.  The best pair is merged, the pairs it makes with its neighbours join the
agenda, and entries whose symbols have changed meanwhile are skipped.  What is left over
and is no piece is written as its UTF-8 bytes.

No merge crosses a place between two symbols that stand side by side in no piece, so a text
is cut at such places and encoded stretch by stretch.  (A table of hashed pairs tells them;
two pairs on one place of it only make a stretch longer.)  As a rule no piece holds the space
mark behind another symbol, and every word, which is from one space mark to the next, begins
a stretch; where pieces do cross words, the whole text counts as a word.
Every distinct stretch of a worker goes through the agenda once: the new ones of a slice side
by side, a row each whose cheapest pair (the first of equals) is merged in every round until
no row has one (symbols that are no piece never merge); longer ones one by one over a heap.
In each slice the sentencepiece library also encodes a word around every new stretch, and a
difference stops the job.  Where it cannot be given that word, every text of the slice
that holds the stretch is encoded by the library as a whole, its ids are compared, and the
stretch counts as new again in the next slice.
Normalising a text and decoding ids are the library's.

Results for odd input: a null text is encoded like an empty one (no ids, empty decoded
text); rows that repeat are encoded each; rows without id are kept; own columns replace
those of the same name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame, SparkSession

from listinglake.llm.common import Recent, giving_back, more, table
from listinglake.llm.wordhash import pieces

SPACE = "▁"
KNOWN_WORDS = 600_000  # stretches kept per worker and generation, see Recent
FEWER_WORDS = 150_000  # the same for a job that shares its memory with others
PAIR_BITS = 18  # of the table of pairs that stand in pieces, a byte each
# Stretches of up to so many symbols are merged side by side, so many rows at once.
LONGEST_ROW = 32
ROWS = 1 << 11  # whose arrays stay in the cache
TOGETHER = 16  # words that the library is given at once


class Stretches(NamedTuple):
    """Where normalised texts, one behind the other, are cut."""

    whole: str
    start: np.ndarray  # first symbol of each stretch, and the number of symbols at the end
    names: pa.Array  # distinct stretches
    name: np.ndarray  # which of them each stretch is
    word: np.ndarray  # first stretch of each word, and the number of stretches at the end
    text: np.ndarray  # the same of each text


def _pair_place(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The place in the table of pairs of symbols (uint32) side by side."""
    mixed = left * np.uint32(0x9E3779B1) + right * np.uint32(0x85EBCA77)
    return mixed >> np.uint32(32 - PAIR_BITS)


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, dtype=np.int32).tobytes()


class Codec:
    """The model at ``path``."""

    def __init__(self, path: str, known_words: int = KNOWN_WORDS):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.normal = sentencepiece.SentencePieceNormalizer(model_file=path).normalize
        model, count = self.model, self.model.get_piece_size()
        self.ids, self.bytes, self.cost = {}, {}, {}
        for i in range(count):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.ids[piece], self.cost[piece] = i, -model.get_score(i)
        self.unknown = model.unk_id()
        self.decimal = pa.array([str(i) for i in range(count)], pa.large_string())
        self.crossing = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.word = regex.compile(r"(?s).+" if self.crossing else f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.known = Recent(known_words)
        # All pairs of pieces that make a piece: left * count + right, sorted.
        pairs = sorted(
            (self.ids[p[:i]] * count + self.ids[p[i:]], i_, self.cost[p])
            for p, i_ in self.ids.items()
            for i in range(1, len(p))
            if p[:i] in self.ids and p[i:] in self.ids
        )
        self.pair = np.array([x[0] for x in pairs] + [2**62], dtype=np.int64)
        self.made = np.array([x[1] for x in pairs] + [-1], dtype=np.int32)
        self.price = np.array([x[2] for x in pairs] + [np.inf], dtype=np.float32)  # as in the model
        self.count = count
        self.symbol = np.full(0x110000, -1, dtype=np.int32)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.symbol[ord(piece)] = i
        beside = "".join({p[i : i + 2] for p in self.ids for i in range(len(p) - 1)})
        beside = np.frombuffer(beside.encode("utf-32-le"), dtype=np.uint32)
        self.inside = np.zeros(1 << PAIR_BITS, dtype=bool)
        self.inside[_pair_place(beside[::2], beside[1::2])] = True

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cost, piece) that symbols side by side make; no piece costs infinitely much."""
        key = left.astype(np.int64) * self.count + right
        at = np.searchsorted(self.pair, key)
        hit = (self.pair[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.price[at], np.float32(np.inf)), self.made[at]

    def rows(self, words: list[str]) -> list[bytes]:
        """Ids of stretches; every row has its own agenda."""
        width = max(map(len, words))
        codes = np.array(words, dtype=f"U{width}").view(np.uint32).reshape(len(words), width)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        place = np.arange(width, dtype=np.int32)
        held = place < lengths[:, None]
        symbol = np.where(held, self.symbol[codes], -1)
        foreign = held & (symbol < 0)
        after = np.where(place + 1 < lengths[:, None], place + 1, -1)
        before = np.broadcast_to(place - 1, symbol.shape).copy()
        cost = np.full(symbol.shape, np.inf, dtype=np.float32)
        made = np.full(symbol.shape, -1, dtype=np.int32)
        cost[:, :-1], made[:, :-1] = self._pairs(symbol[:, :-1], symbol[:, 1:])
        row = np.arange(len(words))
        while len(row):
            left = cost[row].argmin(1)
            open_ = np.isfinite(cost[row, left])
            row, left = row[open_], left[open_]
            right = after[row, left]
            symbol[row, left] = made[row, left]
            symbol[row, right] = -1
            cost[row, right] = cost[row, left] = np.inf
            behind = after[row, left] = after[row, right]
            has = behind >= 0
            r, at, to = row[has], left[has], behind[has]
            before[r, to] = at
            cost[r, at], made[r, at] = self._pairs(symbol[r, at], symbol[r, to])
            ahead = before[row, left]
            has = ahead >= 0
            r, at, to = row[has], ahead[has], left[has]
            cost[r, at], made[r, at] = self._pairs(symbol[r, at], symbol[r, to])
        kept = symbol >= 0
        flat = symbol[kept].tobytes()
        ends = (4 * np.cumsum(kept.sum(1))).tolist()
        out = [flat[a:b] for a, b in zip([0, *ends], ends)]
        for k in foreign.any(1).nonzero()[0].tolist():
            ids: list[int] = []
            for i, char, none in zip(symbol[k].tolist(), words[k], foreign[k].tolist()):
                if none:
                    self._spell(char, ids)
                elif i >= 0:
                    ids.append(i)
            out[k] = _packed(ids)
        return out

    def _spell(self, symbol: str, out: list[int]) -> None:
        """Adds what stands for a symbol that is no piece."""
        if self.bytes:
            out.extend([self.bytes[b] for b in symbol.encode()])
        elif not (out and out[-1] == self.unknown):
            out.append(self.unknown)  # neighbours without a piece are one unknown

    def ids_of(self, words: list[str]) -> dict[str, bytes]:
        """Ids of stretches of normalised texts, as int32."""
        # An array of texts does not tell trailing zeros from none.
        out = {w: self.agenda(w) for w in words if len(w) > LONGEST_ROW or "\0" in w}
        side = sorted([w for w in words if w not in out], key=len)  # rows of like length
        for i in range(0, len(side), ROWS):
            some = side[i : i + ROWS]
            out.update(zip(some, self.rows(some)))
        return out

    def agenda(self, text: str) -> bytes:
        """Ids of a normalised stretch of text, as int32."""
        get, symbols, n = self.cost.get, list(text), len(text)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        pairs = []
        for i in range(n - 1):
            cost = get(piece := symbols[i] + symbols[i + 1])
            if cost is not None:
                pairs.append((cost, i, i + 1, piece))
        heapify(pairs)
        while pairs:
            _, left, right, piece = heappop(pairs)
            # Skip what was merged otherwise meanwhile; a merged symbol is left empty.
            if after[left] != right or symbols[left] + symbols[right] != piece:
                continue
            symbols[left], symbols[right] = piece, ""
            behind = after[left] = after[right]
            after[right] = -1
            if behind < n:
                before[behind] = left
                cost = get(made := piece + symbols[behind])
                if cost is not None:
                    heappush(pairs, (cost, left, behind, made))
            ahead = before[left]
            if ahead >= 0:
                cost = get(made := symbols[ahead] + piece)
                if cost is not None:
                    heappush(pairs, (cost, ahead, left, made))
        out: list[int] = []
        for symbol in filter(None, symbols):
            if symbol in self.ids:
                out.append(self.ids[symbol])
            else:
                self._spell(symbol, out)
        return _packed(out)

    def words(self, text: str) -> list[str]:
        """The words of a normalised text, plainly: no merge leaves them."""
        plain = text[:1] == SPACE != text[-1:] and SPACE * 2 not in text
        if plain and not self.crossing:  # single marks, each in front of a word
            return [SPACE + w for w in text[1:].split(SPACE)]
        return self.word.findall(text)

    def stretches(self, texts: list[str]) -> Stretches:
        """Cuts normalised texts where no merge crosses."""
        whole = "".join(texts)
        codes = np.frombuffer(whole.encode("utf-32-le"), dtype=np.uint32)
        text = np.cumsum([0, *map(len, texts)])
        first = text[:-1][text[:-1] < text[1:]]
        cut = np.ones(len(codes), dtype=bool)
        cut[1:] = ~self.inside[_pair_place(codes[:-1], codes[1:])]
        word = np.zeros(len(codes), dtype=bool)
        if not self.crossing:
            mark = codes == ord(SPACE)
            word[1:] = mark[1:] & ~mark[:-1]
            cut |= word
        if not self.bytes:  # neighbours without a piece are one unknown
            foreign = self.symbol[codes] < 0
            cut[1:] &= ~(foreign[1:] & foreign[:-1])
            word &= cut
        cut[first] = word[first] = True
        start = np.append(np.flatnonzero(cut), len(codes))
        data = np.frombuffer(whole.encode(), dtype=np.uint8)
        byte = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))  # of each symbol
        names = pa.LargeStringArray.from_buffers(
            len(start) - 1, pa.py_buffer(byte[start]), pa.py_buffer(data)
        ).dictionary_encode()
        word = np.append(np.flatnonzero(word[start[:-1]]), len(start) - 1)
        name = names.indices.to_numpy()
        return Stretches(whole, start, names.dictionary, name, word, np.searchsorted(start, text))

    def coded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one behind the other, where those of each text begin and the end)."""
        cut = self.stretches(self.normal(texts))
        names, new = cut.names.to_numpy(zero_copy_only=False).tolist(), set()

        def learn(unknown: list[str]) -> dict[str, bytes]:
            new.update(unknown)
            return self.ids_of(unknown)

        ids = self.known.values(names, learn)
        flat = np.frombuffer(b"".join(ids), dtype=np.int32)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        count = sizes[cut.name]
        at = np.zeros(len(count) + 1, dtype=np.int64)
        np.cumsum(count, out=at[1:])
        begin = (np.cumsum(sizes) - sizes)[cut.name] - at[:-1]
        flat = flat[np.repeat(begin, count) + np.arange(at[-1])]
        unchecked = new
        try:
            fresh = np.array([k for k, n in enumerate(names) if n in new], dtype=np.int64)
            left = self.check(texts, cut, flat, at, fresh)
            unchecked = [names[k] for k in left]
        finally:
            self.known.forget(unchecked)
        return flat, at[cut.text]

    def check(
        self, texts: list[str], cut: Stretches, flat: np.ndarray, at: np.ndarray, new: np.ndarray
    ) -> np.ndarray:
        """Compares the ids of a word around each of the ``new`` stretches with the library's.

        ``at`` tells where the ids of each stretch begin.  Returns the stretches for which
        whole texts were compared instead.
        """
        place = np.zeros(len(cut.names), dtype=np.int64)
        place[cut.name[::-1]] = np.arange(len(cut.name))[::-1]  # where each stands first
        around = np.searchsorted(cut.word, place[new], side="right") - 1
        some = np.unique(around)
        a, b = cut.word[some], cut.word[some + 1]
        words = [cut.whole[i:j] for i, j in zip(cut.start[a].tolist(), cut.start[b].tolist())]
        made = [flat[i:j] for i, j in zip(at[a].tolist(), at[b].tolist())]
        alone = self._check_words(words, made)
        left = new[~alone[np.searchsorted(some, around)]]
        if len(left):
            held = np.flatnonzero(np.isin(cut.name, left))
            held = np.unique(np.searchsorted(cut.text, held, side="right") - 1).tolist()
            whole = self.model.encode([texts[k] for k in held], num_threads=1)
            for k, ids in zip(held, whole):
                made = flat[at[cut.text[k]] : at[cut.text[k + 1]]].tolist()
                if made != ids:
                    raise ValueError(f"agenda and library differ on a text: {made}, {ids}")
        return left

    def _check_words(self, words: list[str], made: list[np.ndarray]) -> np.ndarray:
        """Compares the words that the library can be given, and tells which these are."""
        given = np.zeros(len(words), dtype=bool)

        def compare(groups: list[list[int]]) -> None:
            joined = ["".join([words[k] for k in group]) for group in groups]
            plain = [w[1:].replace(SPACE, " ") for w in joined]  # it puts a mark in front
            whole = [i for i, q in enumerate(self.normal(plain)) if q == joined[i]]
            found = self.model.encode([plain[i] for i in whole], num_threads=1)
            for i, ids in zip(whole, found):
                ours = np.concatenate([made[k] for k in groups[i]]).tolist()
                if ours != ids:
                    raise ValueError(f"agenda and library differ on {joined[i]!r}: {ours}, {ids}")
                given[groups[i]] = True

        if not self.crossing and SPACE in self.ids:  # words side by side stay apart
            some = [k for k, w in enumerate(words) if w[0] == SPACE != w[-1]]
            compare([some[i : i + TOGETHER] for i in range(0, len(some), TOGETHER)])
        compare([[k] for k in np.flatnonzero(~given).tolist() if words[k][0] == SPACE])
        return given

    def encode(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text."""
        return list(_lists(*self.coded(texts)))

    def digests(self, flat: np.ndarray, begin: np.ndarray) -> list[str]:
        """SHA-256 of the decimal ids of each text joined by commas."""
        decimal = pa.ListArray.from_arrays(pa.array(begin, pa.int32()), self.decimal.take(flat))
        joined = pa.compute.binary_join(decimal, pa.scalar(",", pa.large_string()))
        return [hashlib.sha256(x.as_buffer()).hexdigest() for x in joined]

    def decode(self, ids: list[int]) -> str:
        return self.model.decode(ids) if ids else ""


def _lists(flat: np.ndarray, begin: np.ndarray) -> Iterator[list[int]]:
    begin = begin.tolist()
    return (flat[a:b].tolist() for a, b in zip(begin, begin[1:]))


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encode_decode(
    docs: DataFrame,
    path: str,
    text_col: str = "text",
    with_ids: bool = True,
    keep_words: bool = True,
) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids`` (if asked for), ``ids_sha256`` and ``decoded_text``.

    Without ``keep_words`` a task has tables and words of its own, fewer of the latter, and
    leaves the worker's memory to the job that uses it next.
    """
    own = ["n_tokens", "ids_sha256", "decoded_text"] + ["ids"] * with_ids
    base = docs.drop(*own)
    keep = base.columns
    columns = "n_tokens long, ids_sha256 string, decoded_text string"
    schema = more(base.schema, columns + ", ids array<int>" * with_ids)

    def run(batches):
        tool = codec(path) if keep_words else Codec(path, FEWER_WORDS)
        for batch in batches:
            for part in pieces(batch, text_col):
                flat, at = tool.coded([t or "" for t in part.column(text_col).to_pylist()])
                columns = [
                    pa.array(np.diff(at), pa.int64()),
                    pa.array(tool.digests(flat, at), pa.string()),
                    pa.array([tool.decode(ids) for ids in _lists(flat, at)], pa.string()),
                ]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), flat))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in keep] + columns,
                    names=[*keep, *own],
                )

    return base.mapInArrow(giving_back(run), schema)


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from pyspark.sql import functions as F

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("piece_bpe_32k.model")
    return encode_decode(docs, path, with_ids=False).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded_text", 256).alias("decoded_sha256")
    )
