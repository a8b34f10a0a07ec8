"""Tokens, the range coder, token files and packing."""

import random
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models, pre_tokenizers

from trunkline.llm import packing, rangecoder, token_files, tokens
from trunkline.session import shared_folder


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokens.tokenizer_path())


@pytest.fixture(scope="module")
def words():
    return tokens.Vocabulary(tokens.tokenizer_path())


ALPHABET = [
    "a", "B", " ", "  ", "\n", "'s", "'ll", "'", "!'s", " 's", "1", "é", "ß", "—", "’", "\t", "\xa0",
    "中", "😀", "<|endoftext|>", "\x1c", "'re", "re", "\n\n", " \n", "..", "\x00", "²", "Ж", "ͱ",
]


def test_ids_equal_the_library(words, tokenizer):
    rng = random.Random(3)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 14))) for _ in range(5000)]
    texts += ["", None, "a" * 5000, " " * 5000, "<|endoftext|>", "x<|endoftext|><|endoftext|> y"]
    texts += ["cut <|endo", "ftext|> here"]  # no token: two texts
    ids, ranges = words.encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[ranges[i] : ranges[i + 1]].tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


@given(st.lists(st.text(max_size=40), max_size=8))
@settings(max_examples=150, deadline=None)
def test_ids_of_any_text(texts):
    kept = tokens.vocabulary(tokens.tokenizer_path())
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    ids, ranges = kept.encode(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        expected = kept.tokenizer.encode(text, add_special_tokens=False).ids
        assert ids[ranges[i] : ranges[i + 1]].tolist() == expected


def test_special_tokens_are_as_the_library_has_them(words):
    """The string of a special token is that token, in a text of other words too."""
    ids, ranges = words.encode(pa.array(["a <|endoftext|> b", "a b"]))
    assert 50256 in ids[: ranges[1]] and ranges[1] < 8
    assert 50256 not in ids[ranges[1] :]


def test_new_pieces_need_no_encoding_each(tokenizer):
    """Pieces go to the tokenizer's model; only odd texts are encoded by the whole library."""
    small = tokens.Vocabulary(tokens.tokenizer_path())
    small.tokenizer = None
    rng = random.Random(5)
    texts = ["".join(rng.choice(ALPHABET[:16]) for _ in range(40)) for _ in range(200)]
    ids, ranges = small.encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[ranges[i] : ranges[i + 1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


class Counted:
    """A tokenizer that tells how many texts each call of it has."""

    def __init__(self, inner):
        self.inner, self.calls = inner, []

    def encode_batch_fast(self, texts, **options):
        self.calls.append(len(texts))
        return self.inner.encode_batch_fast(texts, **options)


@pytest.mark.parametrize("together", [1, 7, 4096])
def test_new_pieces_go_to_the_library_together(monkeypatch, tokenizer, together):
    """So many in one text; known pieces do not go there again."""
    monkeypatch.setattr(tokens, "TOGETHER", together, raising=False)
    small = tokens.Vocabulary(tokens.tokenizer_path())
    small.pieces = counted = Counted(getattr(small, "pieces", None))
    rng = random.Random(6)
    texts = ["".join(rng.choice(ALPHABET[:16]) for _ in range(60)) for _ in range(100)]
    texts += [" \n\n x\n", "\n", "".join(map(chr, range(28))), "été'll ça"]
    for _ in range(2):
        ids, ranges = small.encode(pa.array(texts))
        for i, text in enumerate(texts):
            assert ids[ranges[i] : ranges[i + 1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert counted.calls == [1] * -(-small.entries // together)


def test_a_vocabulary_without_some_bytes(tmp_path):
    """What the library leaves out is left out, and every text keeps its own ids."""
    model = models.BPE({"a": 0, "b": 1, "ab": 2, "Ġ": 3}, [("a", "b")])
    some = Tokenizer(model)
    some.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    some.save(str(tmp_path / "some.json"))
    texts = ["ab ab", "xyz", "cab abba\nb", "", None, "c", "b a"]
    ids, ranges = tokens.Vocabulary(str(tmp_path / "some.json")).encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[ranges[i] : ranges[i + 1]].tolist() == some.encode(text or "", add_special_tokens=False).ids


def test_a_worker_gives_freed_memory_back(monkeypatch):
    """Once after each batch, when a vocabulary has been read, and with what it forgets."""
    given = []
    monkeypatch.setattr(tokens.tx, "give_back", lambda: given.append(1))
    texts = pa.record_batch([pa.array([1, 2]), pa.array(["a b", None])], names=["doc_id", "text"])
    assert len(list(tokens.tx.pieces(texts, 1))) == 2 and len(given) == 1
    tokens.Vocabulary(tokens.tokenizer_path())
    tokens.tx.forget("none of this name ")
    assert len(given) == 3


def test_a_full_table_starts_afresh(monkeypatch, tokenizer):
    monkeypatch.setattr(tokens, "TABLE_BITS", 8)
    small = tokens.Vocabulary(tokens.tokenizer_path())
    for seed in range(6):
        rng = random.Random(seed)
        texts = [" ".join(str(rng.randint(0, 10**6)) for _ in range(seed * 40)) for _ in range(3)]
        ids, ranges = small.encode(pa.array(texts, pa.string()))
        for i, text in enumerate(texts):
            assert ids[ranges[i] : ranges[i + 1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 1000, 70_000])
def test_range_coder_round_trip(n):
    rng = np.random.default_rng(n)
    for ids in (
        np.zeros(n, np.int64),
        rng.integers(0, 50_257, n),
        np.minimum(rng.zipf(1.3, n), 50_256),
        np.tile(np.arange(7), n // 7 + 1)[:n],
    ):
        data = rangecoder.encode(ids, 50_257)
        assert (rangecoder.decode(data) == ids).all()


def test_range_coder_blocks_stand_alone(monkeypatch):
    monkeypatch.setattr(rangecoder, "BLOCK_IDS", 500)
    ids = np.random.default_rng(1).integers(0, 300, 1700)
    data = memoryview(rangecoder.encode(ids, 300))
    first, size = rangecoder.decode_block(data)
    second, _ = rangecoder.decode_block(data[size:])
    assert (second == ids[500:1000]).all() and (first == ids[:500]).all()


def test_range_coder_learns():
    rng = np.random.default_rng(2)
    phrases = [rng.integers(0, 50_257, 12) for _ in range(40)]
    ids = np.concatenate([phrases[i] for i in rng.integers(0, 40, 20_000)])
    assert 8 * len(rangecoder.encode(ids, 50_257)) / len(ids) < 3


def test_range_coder_keeps_its_format():
    """The bytes of a block are those that earlier files have."""
    ids = np.arange(20_000) ** 2 % 1_009 * (np.arange(20_000) % 7) % 5_003
    data = rangecoder.encode(ids, 50_257)
    assert (len(data), zlib.crc32(data)) == (17_006, 3_900_310_803)


def test_damage_is_seen():
    data = bytearray(rangecoder.encode(np.arange(5000) % 91, 100))
    data[len(data) // 2] ^= 1
    with pytest.raises(ValueError):
        rangecoder.decode(bytes(data))


def expected_files(rows, tokenizer):
    ids = {}
    for doc, text in rows:
        ids.setdefault(doc, []).append(brute.encode(tokenizer, text, 2))
    return ids


@pytest.mark.parametrize("segment", [1 << 20, 300])
def test_token_files(spark, edge, edge_rows, tokenizer, segment):
    folder = shared_folder(spark, "tokens")
    token_files.write_tokens(edge, folder, segment_ids=segment)
    found = token_files.read_tokens(spark, folder).orderBy("start").collect()
    assert len(found) == len(edge_rows)
    order = [r.doc_id for r in found]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    start = 0
    left = expected_files(edge_rows, tokenizer)
    for row in found:
        ids = np.frombuffer(row.ids, "<u4")
        assert row.start == start and row.n_tokens == len(ids) and row.ids_crc32 == brute.crc(ids)
        match = next(i for i, x in enumerate(left[row.doc_id]) if x.tolist() == ids.tolist())
        left[row.doc_id].pop(match)
        start += len(ids)
    some = token_files.read_tokens(spark, folder, 100, 110)
    assert sorted(r.doc_id for r in some.collect()) == list(range(100, 111))


def test_empty_token_files(spark, empty):
    folder = shared_folder(spark, "tokens")
    token_files.write_tokens(empty, folder)
    assert token_files.read_tokens(spark, folder).count() == 0


def check_packing(found, rows, tokenizer, size):
    expected = {}
    for doc, text in rows:
        expected.setdefault(doc, []).append(brute.encode(tokenizer, text, 0))
    pieces, sequences = {}, {}
    for r in found:
        assert brute.crc(np.frombuffer(r.ids, "<u4")) == r.ids_crc32 and len(r.ids) == 4 * r.length
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc, texts in expected.items():
        if len(texts) == 1:
            parts = sorted(pieces[doc], key=lambda r: r.start)
            joined = np.concatenate([np.frombuffer(r.ids, "<u4") for r in parts])
            assert joined.tolist() == texts[0].tolist()
            assert [r.start for r in parts] == np.cumsum([0] + [r.length for r in parts[:-1]]).tolist()
            assert {r.doc_tokens for r in parts} == {len(texts[0])}
    assert sum(r.length for r in found) == sum(len(t) for texts in expected.values() for t in texts)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    assert sorted(sequences) == list(range(len(sequences)))
    return len(sequences)


@pytest.mark.parametrize("size", [1024, 16])
def test_packing(edge, edge_rows, tokenizer, size):
    found = packing.pack(edge, size=size, with_ids=True).collect()
    n = check_packing(found, edge_rows, tokenizer, size)
    assert sum(r.length for r in found) / (n * size) > 0.9


def test_packing_sample(sample, tokenizer):
    df, docs = sample
    check_packing(packing.pack(df, with_ids=True).collect(), docs, tokenizer, 1024)


def test_packing_of_nothing(empty):
    assert packing.pack(empty).count() == 0


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), min_size=1, max_size=30))
@settings(max_examples=100, deadline=None)
def test_patterns_hold_the_histogram(histogram):
    packs = packing.patterns(histogram, 64)
    held = {}
    for count, pack in packs:
        assert count > 0 and sum(n * k for n, k in pack.items()) <= 64
        for length, each in pack.items():
            held[length] = held.get(length, 0) + count * each
    assert held == histogram
