import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from listinglake.llm import common, piece_codec, token_counts
from llm_cases import corpus, frame

JSON = public_tokenizers.path("word_bpe_49k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
BITS = [
    "a", "e", "th", "ing", " ", "  ", "\n", "'s", "'", "'ll", "1", "23", "!", "!!", "é", "É", "ß",
    "İ", "Σ", "日", "本", "😀", "<|endoftext|>", "<s>", "▁", "▁▁", "\x00", "\x1c", "́",
    "한", "lovelove", "ﬁ", "​", "=====",
]


def texts(n, seed=1):
    rng = random.Random(seed)
    out = ["".join(rng.choice(BITS) for _ in range(rng.randrange(0, 30))) for _ in range(n)]
    return out + ["abcdefghij" * 500, "word " * 2000, ""]


@pytest.fixture(scope="module")
def counter():
    return token_counts.Counter(JSON)


@pytest.mark.parametrize("chunk", [1 << 16, 64, 3])
def test_counts_are_the_librarys_for_any_cut(counter, chunk):
    library = Tokenizer.from_file(JSON)
    for text in texts(400):
        maps = counter.maps(text, chunk)
        want = len(library.encode(text, add_special_tokens=False).ids)
        assert (counter.close(counter.compose(maps)) if maps else 0) == want


def test_maps_compose_in_any_order(counter):
    maps = counter.maps("one two three four five six seven " * 3 + "eight", 7)
    whole = counter.close(counter.compose(maps))
    for i in range(1, len(maps)):
        halves = [counter.compose(maps[:i]), counter.compose(maps[i:])]
        assert counter.close(counter.compose(halves)) == whole


def test_states_start_anew_when_full(monkeypatch):
    monkeypatch.setattr(token_counts, "MAX_STATES", 50)
    small = token_counts.Counter(JSON)
    small.known.limit = 5
    library = Tokenizer.from_file(JSON)
    for text in texts(60, 5):
        maps = small.maps(text)
        want = len(library.encode(text, add_special_tokens=False).ids)
        assert (small.close(small.compose(maps)) if maps else 0) == want


def test_token_table(spark):
    library = Tokenizer.from_file(JSON)
    rows = corpus()
    docs = frame(spark, rows).withColumn("n_tokens", F.lit("old"))
    got = token_counts.count_tokens(docs, JSON, limit=100)
    assert "lang" in got.columns and got.columns[-3:] == ["n_bytes", "n_tokens", "over_limit"]
    want = []
    for i, t in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 100))
    found = got.select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)
    assert token_counts.count_tokens(docs.limit(0), JSON).count() == 0


@pytest.mark.parametrize("limit", [250_000, 20])
def test_agenda_gives_the_librarys_ids(limit):
    tool = piece_codec.Codec(MODEL)
    tool.known.limit = limit
    many = texts(600, 2)
    for i in range(0, len(many), 50):
        part = many[i : i + 50]
        assert tool.encode(part) == tool.model.encode(part)


def test_rows_merge_as_the_heap_does(monkeypatch):
    tool = piece_codec.Codec(MODEL)
    some = {w for t in tool.normal(texts(2000, 6)) for w in tool.word.findall(t)} | {"▁" * 40, "a" * 32, "a" * 33, "q"}
    monkeypatch.setattr(piece_codec, "ROWS", 100)
    found = tool.ids_of(list(some))
    assert found == {w: tool.agenda(w) for w in some}
    assert tool.ids_of([]) == {}


def test_a_wrong_merge_stops_the_job():
    tool = piece_codec.Codec(MODEL)
    tool.cost, tool.price = {p: -c for p, c in tool.cost.items()}, -tool.price
    with pytest.raises(ValueError, match="differ"):
        tool.encode(["the reality of undecided merges, abandoned strawberries"])


def test_encoded_table(spark):
    import hashlib

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = corpus()
    docs = frame(spark, rows).withColumn("ids", F.lit(0))
    got = piece_codec.encode_decode(docs, MODEL)
    for r in got.collect():
        ids = library.encode(r["text"] or "")
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["decoded_text"] == (library.decode(ids) if ids else "")
        joined = ",".join(map(str, ids)).encode()
        assert r["ids_sha256"] == hashlib.sha256(joined).hexdigest()
    assert got.count() == len(rows)
    assert piece_codec.encode_decode(docs.limit(0), MODEL, with_ids=False).count() == 0


def test_words_the_library_cannot_take_alone_are_checked_in_their_texts(tmp_path):
    many = [t for t in texts(300, 4) if t.strip()]
    sentencepiece.SentencePieceTrainer.train(
        sentence_iterator=iter(["the reality of undecided merges and berries"] * 50), vocab_size=60,
        model_prefix=str(tmp_path / "tiny"), model_type="bpe", add_dummy_prefix=False,
        hard_vocab_limit=False, minloglevel=2,
    )
    tool = piece_codec.Codec(str(tmp_path / "tiny.model"))
    assert tool.encode(many) == tool.model.encode(many)
    tool = piece_codec.Codec(str(tmp_path / "tiny.model"))
    tool.cost, tool.price = {p: -c for p, c in tool.cost.items()}, -tool.price
    with pytest.raises(ValueError, match="differ on a text"):
        tool.encode(["undecided"])


def test_words_with_symbols_that_are_no_piece_are_merged_side_by_side(monkeypatch):
    tool = piece_codec.Codec(MODEL)
    words = [f"▁{a}{b}" for a in ("love", "ↀ", "aↀb", "日ↀↀ") for b in ("", "th", "ↀing", "1ↀ")]
    assert any(c not in tool.ids for w in words for c in w)
    want = {w: tool.agenda(w) for w in words}

    def alone(word):
        raise AssertionError(f"{word!r} went alone")

    monkeypatch.setattr(tool, "agenda", alone)
    assert tool.ids_of(words) == want
    texts_ = [" ".join(w[1:] for w in words), "ↀ"]
    assert tool.encode(texts_) == tool.model.encode(texts_)


def test_words_of_plain_and_other_texts():
    tool = piece_codec.Codec(MODEL)
    for text in ["", "▁", "▁a", "▁a▁b", "▁a▁", "▁a▁▁b", "a▁b", "▁▁a", "a\n▁b\x00", "▁a▁b▁▁"]:
        assert tool.words(text) == tool.word.findall(text)


def tiny(tmp_path, lines, **options):
    sentencepiece.SentencePieceTrainer.train(
        sentence_iterator=iter(lines * 50), model_prefix=str(tmp_path / "m"), model_type="bpe",
        hard_vocab_limit=False, minloglevel=2, **{"vocab_size": 60, **options},
    )
    return piece_codec.Codec(str(tmp_path / "m.model"))


def test_words_are_cut_where_no_piece_holds_both_symbols(monkeypatch):
    tool = piece_codec.Codec(MODEL)
    beside = {p[i : i + 2] for p in tool.ids for i in range(len(p) - 1)}
    assert "y." not in beside and "a$" not in beside and "nd" in beside
    asked, ids_of = [], tool.ids_of
    monkeypatch.setattr(tool, "ids_of", lambda words: asked.extend(words) or ids_of(words))
    for part in (["really and"], ["really. and$$$ really"], ["", "and$$$and. really"]):
        assert tool.encode(part) == tool.model.encode(part)
    assert "▁really" in asked and "▁and" in asked
    assert len(asked) == len(set(asked)) and not any(w.startswith("▁really.") for w in asked)


@pytest.mark.parametrize("bits", [18, 2])
def test_cuts_keep_texts_and_words(monkeypatch, bits):
    monkeypatch.setattr(piece_codec, "PAIR_BITS", bits)  # few places: hardly a cut inside words
    tool = piece_codec.Codec(MODEL)
    for many in (tool.normal(texts(300, 8)), ["", "▁", "a▁b", "", "▁▁a▁", "b", ""], [""], []):
        cut = tool.stretches(many)
        names = cut.names.to_pylist()
        parts = [names[k] for k in cut.name]

        def split(at):
            return [parts[a:b] for a, b in zip(at, at[1:])]

        assert ["".join(x) for x in split(cut.text.tolist())] == many
        words = [w for t in many for w in tool.words(t)]
        assert ["".join(x) for x in split(cut.word.tolist())] == words
        assert [cut.whole[a:b] for a, b in zip(cut.start, cut.start[1:])] == parts
        inner = {w[a + len(x) - 1 : a + len(x) + 1] for w, row in zip(words, split(cut.word.tolist()))
                 for a, x in zip([sum(map(len, row[:i])) for i in range(len(row))], row[:-1])}
        assert not any(pair in p for pair in inner for p in tool.ids)
    many = texts(300, 9)
    assert tool.encode(many) == tool.model.encode(many)
    assert tool.encode([""]) == [[]] and tool.encode([]) == []


@pytest.mark.parametrize(
    "options",
    [
        {},
        {"split_by_whitespace": False},
        {"byte_fallback": True, "vocab_size": 320},
        {"remove_extra_whitespaces": False},
        {"add_dummy_prefix": False, "remove_extra_whitespaces": False},
    ],
)
def test_other_models_give_the_librarys_ids(tmp_path, options):
    lines = ["the reality of undecided merges and berries", "of the  and of the"]
    tool = tiny(tmp_path, lines, **options)
    many = texts(300, 10) + [
        "of the", "the of the", "ↀↀ ↀ", "aↀ ↀb", "the  of", " the", "the ", "日本ↀ", "ↀ日 日ↀ",
    ]
    for _ in range(2):  # unknown stretches, then known ones
        assert tool.encode(many) == tool.model.encode(many)


def test_a_stretch_that_failed_its_check_stays_unknown():
    tool = piece_codec.Codec(MODEL)
    right = tool.cost, tool.price
    tool.cost, tool.price = {p: -c for p, c in tool.cost.items()}, -tool.price
    for _ in range(2):  # a second try in the same worker is compared again
        with pytest.raises(ValueError, match="differ"):
            tool.encode(["the reality of undecided merges"])
    tool.cost, tool.price = right
    assert tool.encode(["the reality"]) == tool.model.encode(["the reality"])


def test_digests_of_many_and_no_ids():
    import hashlib

    tool = piece_codec.Codec(MODEL)
    many = ["", "one two", "", "three", "😀"]
    want = [
        hashlib.sha256(",".join(map(str, tool.model.encode(t))).encode()).hexdigest() for t in many
    ]
    assert tool.digests(*tool.coded(many)) == want
    assert tool.digests(*tool.coded([])) == []


def test_a_codec_of_fewer_words_keeps_no_more_and_codes_the_same():
    path = public_tokenizers.path("piece_bpe_32k.model")
    rng = random.Random(6)
    texts = [" ".join("".join(rng.choices("abcdefghij", k=7)) for _ in range(4)) for _ in range(400)]
    few, many = piece_codec.Codec(path, 50), piece_codec.Codec(path)
    for i in range(0, len(texts), 20):
        part = texts[i : i + 20]
        assert few.encode(part) == many.encode(part)
    # A generation holds one slice at least, and two are kept.
    assert len(few.known.young) + len(few.known.old) < 400 < len(many.known.young)


def test_arrow_memory_goes_back_behind_a_task(monkeypatch):
    said = []

    class Pool:
        def release_unused(self):
            said.append("back")

    monkeypatch.setattr(common.pa, "default_memory_pool", Pool)
    for x in common.giving_back(lambda batches: (2 * b for b in batches))([1, 2]):
        said.append(x)
    assert said == [2, 4, "back"]
