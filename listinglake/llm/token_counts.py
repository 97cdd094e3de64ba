"""Token counts of whole texts from a tokenizer compiled to a counting transducer.

The tokenizer file (BPE with a word-end suffix) is compiled to a deterministic
transducer.  Its states stand for what is behind: the tokens that the encoding of the
current word would end in after each of the last few symbols.  A transition reads one
symbol and carries the number of tokens it emits, so that a run over a text adds up to
the number of tokens of the text.

Why states of bounded reach suffice: a sequence of tokens is the encoding of a word
exactly if every two neighbours are the encoding of the two together.  So the last token
of a longer word is the one that fits behind the encoding that ends where it begins, and
no token is longer than the vocabulary's longest.  States that agree in these last
tokens, and in the longest tail that can still grow into a token, behave alike and are
one state.  States and transitions are made when first met and kept per worker.

A text is cut into chunks.  Each chunk becomes a state map, in factored form: the symbols
up to the first place where every state has become the same one (head), the tokens from
there on, and the symbols since the last such place (tail).  Two maps compose by running
the transducer over tail and head, which is associative, so the maps of a text meet in a
parallel scan: blocks of BLOCK maps each, then the blocks.  Two levels span any text a
row can hold.

Results for odd input: a null text counts like an empty one (0 bytes, 0 tokens); strings
of special tokens inside a text are single tokens, as the library reads them; rows that
repeat are counted each; rows without id are kept; own columns replace those of the same
name.
"""

from __future__ import annotations

import json
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from listinglake.llm.common import Recent, more, table
from listinglake.llm.wordhash import pieces

LIMIT = 2048
CHUNK = 1 << 16  # characters
BLOCK = 256  # maps composed at once; BLOCK * BLOCK chunks are more than a row can hold
# States kept per worker before the tables start anew; a state takes about 1 kB.
MAX_STATES = 200_000
KNOWN_WORDS = 500_000  # words kept per worker and generation, see Recent

# Fixed values of the tokenizer: contractions cut off as words, in this order.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")


def _byte_symbols() -> list[str]:
    """The printable symbol that byte-level vocabularies write for each byte."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = [""] * 256
    spare = 256
    for b in range(256):
        if b in own:
            out[b] = chr(b)
        else:
            out[b], spare = chr(spare), spare + 1
    return out


END = "\n"  # written behind a word's last symbol; no byte is shown as this symbol


class _State:
    """One state: the last tokens after each recent symbol, nearest last."""

    __slots__ = ("ends", "tail", "next", "final")

    def __init__(self, ends, tail):
        self.ends = ends  # ((last token, tokens so far relative to now), ...)
        self.tail = tail  # symbols since the earliest place a coming token may begin
        self.next = {}  # symbol -> (state, tokens emitted)
        self.final = {}  # last symbol of the word -> tokens emitted


class Transducer:
    """The tokenizer at ``path`` as a transducer over symbols that counts tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        suffix = model.get("end_of_word_suffix")
        if model["type"] != "BPE" or not suffix:
            raise ValueError("needs a BPE tokenizer with a word-end suffix")

        def own(token: str) -> str:
            return token[: -len(suffix)] + END if token.endswith(suffix) else token

        self.rank = {(own(a), own(b)): i for i, (a, b) in enumerate(model["merges"])}
        specials = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.symbols = _byte_symbols()
        # Only tokens that are their own encoding can occur.
        tokens = (own(token) for token in model["vocab"] if token != suffix)
        self.parts = {t for t in tokens if self._encode(t) == [t]}
        self.longest = max(map(len, self.parts), default=1)
        # Beginnings of tokens, to know how far back a coming token may reach.
        self.heads = {p[:i] for p in self.parts for i in range(1, len(p) + 1)}
        self.fits: dict[tuple[str, str], bool] = {}
        self._fresh()

    def _fresh(self) -> None:
        self.states: dict[tuple, _State] = {}
        self.start = self._state((("", 0),), "")

    def _state(self, ends, tail) -> _State:
        state = self.states.get((ends, tail))
        if state is None:
            state = self.states[ends, tail] = _State(ends, tail)
        return state

    def _encode(self, symbols: str) -> list[str]:
        """Merge by rank, the leftmost of equals first; used on short pieces only."""
        parts = list(symbols)
        if len(parts) > 1 and parts[-1] == END:
            parts[-2:] = [parts[-2] + END]
        get = self.rank.get
        while len(parts) > 1:
            ranks = [get(pair, 1 << 60) for pair in zip(parts, parts[1:])]
            best = min(ranks)
            if best == 1 << 60:
                break
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _fit(self, left: str, right: str) -> bool:
        """Is the encoding of both together these two tokens?"""
        if not left:
            return True
        known = self.fits.get((left, right))
        if known is None:
            if len(self.fits) > 1_000_000:
                self.fits.clear()
            known = self.fits[left, right] = self._encode(left + right) == [left, right]
        return known

    def _last(self, state: _State, symbol: str) -> tuple[str, int]:
        """(last token, place before it) of the encoding after one more symbol."""
        ends, parts = state.ends, self.parts
        text = state.tail + symbol
        for i in range(len(ends)):  # the token that begins behind place i
            token = text[i:]
            if (token in parts or i == len(ends) - 1) and self._fit(ends[i][0], token):
                return token, i
        raise AssertionError("every symbol has an encoding")

    def step(self, state: _State, symbol: str) -> tuple[_State, int]:
        """The state after one more symbol that is not the word's last, and what it emits."""
        known = state.next.get(symbol)
        if known is None:
            token, at = self._last(state, symbol)
            count = state.ends[at][1] + 1
            tail = state.tail + symbol
            while tail and tail not in self.heads:
                tail = tail[1:]
            ends = (*state.ends, (token, count))[-(len(tail) + 1) :]
            after = self._state(tuple((t, c - count) for t, c in ends), tail)
            known = state.next[symbol] = (after, count)
        return known

    def end(self, state: _State, symbol: str) -> int:
        """Tokens emitted by the last symbol of a word."""
        known = state.final.get(symbol)
        if known is None:
            _, at = self._last(state, symbol + END)
            known = state.final[symbol] = state.ends[at][1] + 1
        return known

    def word(self, text: str) -> int:
        """Run one word from the start state to its end."""
        if len(self.states) > MAX_STATES:
            self._fresh()
        symbols = self.symbols
        raw = text.encode()
        state, total = self.start, 0
        for b in raw[:-1]:
            known = state.next.get(symbols[b])
            state, emitted = known if known else self.step(state, symbols[b])
            total += emitted
        return total + self.end(state, symbols[raw[-1]])


class Counter:
    """State maps of chunks, and their composition."""

    # Words of the tokenizer; its normaliser has made all white space a single space.
    WORD = regex.compile("|".join(CONTRACTIONS) + r"|\p{L}+|\p{N}|[^ \p{L}\p{N}]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.machine = Transducer(path)
        tokenizer = Tokenizer.from_file(path)
        self.normal = (
            tokenizer.normalizer.normalize_str if tokenizer.normalizer else lambda text: text
        )
        # Transitions over a whole word at once, composed from those over its symbols.
        self.known = Recent(KNOWN_WORDS)

    def run(self, text: str) -> int:
        """Tokens of a stretch that begins and ends at a word boundary."""
        words = self.WORD.findall(text)
        known = self.known.hold(set(words), lambda new: {w: self.machine.word(w) for w in new})
        return sum([known[w] for w in words])

    def maps(self, text: str, chunk: int = CHUNK) -> list[tuple[str, int | None, str]]:
        """State maps of the chunks of a text: (head, tokens, tail).

        All states are the same behind white space.  A chunk without any has tokens None
        and its symbols in head.
        """
        special = self.machine.special
        out: list[tuple[str, int | None, str]] = []
        at = 0
        for hit in [*(special.finditer(text) if special else ()), None]:
            plain = self.normal(text[at : hit.start() if hit else len(text)])
            for i in range(0, len(plain), chunk):
                out.append(self._map(plain[i : i + chunk]))
            if hit:
                out.append(("", 1, ""))  # a special token is a boundary by itself
                at = hit.end()
        return out

    def _map(self, piece: str) -> tuple[str, int | None, str]:
        first, last = piece.find(" "), piece.rfind(" ")
        if first < 0:
            return piece, None, ""
        return piece[:first], self.run(piece[first:last]), piece[last + 1 :]

    def compose(self, maps) -> tuple[str, int | None, str]:
        """The map of a sequence of maps."""
        head, total, tail = [], None, []
        for h, n, t in maps:
            (head if total is None else tail).append(h)
            if n is None:
                continue
            if total is None:
                total, tail = n, [t]
            else:
                total += self.run("".join(tail)) + n
                tail = [t]
        return "".join(head), total, "".join(tail)

    def close(self, total: tuple[str, int | None, str]) -> int:
        """Tokens when the whole text begins and ends at a word boundary."""
        head, n, tail = total
        return self.run(head) + (n or 0) + self.run(tail)


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(
    docs: DataFrame, path: str, text_col: str = "text", limit: int = LIMIT, chunk: int = CHUNK
) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit``.

    The maps of a text are composed where its chunks were read: a row's text is in one
    task anyway, so the scan needs no shuffle.
    """
    own = ["n_bytes", "n_tokens", "over_limit"]
    base = docs.drop(*own)
    keep = base.columns
    schema = more(base.schema, "n_bytes long, n_tokens long, over_limit boolean")

    def count(batches):
        tool = counter(path)
        for batch in batches:
            for part in pieces(batch, text_col):
                texts = [t or "" for t in part.column(text_col).to_pylist()]
                tokens = []
                for text in texts:
                    level = tool.maps(text, chunk)
                    while len(level) > 1:
                        level = [
                            tool.compose(level[i : i + BLOCK])
                            for i in range(0, len(level), BLOCK)
                        ]
                    tokens.append(tool.close(level[0]) if level else 0)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in keep]
                    + [
                        pa.array([len(t.encode()) for t in texts], pa.int64()),
                        pa.array(tokens, pa.int64()),
                        pa.array([n > limit for n in tokens], pa.bool_()),
                    ],
                    names=[*keep, *own],
                )

    return base.mapInArrow(count, schema)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path("word_bpe_49k.json")).drop("text")
