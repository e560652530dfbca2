import base64
import hashlib
import os
import random
import zlib
from pathlib import Path

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
import numpy as np
import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
import tiktoken  # noqa: E402
import tokenizers  # noqa: E402
from cases import TEXTS, documents, empty  # noqa: E402
from tokenizers import models, pre_tokenizers  # noqa: E402

from veleta.llm import bpe, token_counts, token_files, word_ids  # noqa: E402
from veleta.llm.words import slices  # noqa: E402

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ALPHABET = [*"abcdefghijklmnop    \n\t'\"1234567890.,;:!?", *"éüñßçêäöÉ日本語中русский \u0085\x1c\x1f🙂👩‍🚀ꙮ", "'s", "'ll", "  ", " \n", "the ", "ing", "<unk>", "<s>", "<0x0A>", "▁"]


def some_texts(n=1500, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(n)] + [t or "" for _, t in TEXTS]


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(Path(RANKS).read_bytes())


def test_transducer_equals_the_library(ranks):
    own = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}, special_tokens={})
    texts = some_texts() + ["a" * 3000 + "b" * 2000 + "ab" * 3000 + " " * 3000 + "é" * 2000]
    want = [library.encode_ordinary(t) for t in texts]
    assert own.encode(texts) == want
    assert own.encode(texts) == want  # from what it remembers
    tokens = {v: k for k, v in ranks.items()}
    for t, ids in zip(texts, want):
        assert "".join(bpe.decode(tokens, ids, 3)) == t


def test_emptied_tables_change_nothing(ranks, monkeypatch):
    texts = some_texts(200, 2)
    want = bpe.Encoder(ranks, public_tokenizers.PATTERN).encode(texts)
    monkeypatch.setattr(bpe, "KEPT_STEPS", 50)
    monkeypatch.setattr(word_ids, "KEPT", 10)
    small = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    assert [ids for t in texts for ids in small.encode([t])] == want


def test_matches_take_their_steps_together(ranks, monkeypatch):
    rng = random.Random(8)
    pieces = list({"".join(rng.choice(["th", "e", "tion", "in", "é", "ß", "日", "\x00", "X"]) for _ in range(rng.randint(1, 40))).encode() for _ in range(600)})
    streaming = bpe.Transducer(ranks)
    want = [list(streaming.stream(p)) for p in pieces[:50]]
    library = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    assert want == [library.encode_ordinary(p.decode()) for p in pieces[:50]]
    for bounds in ({}, {"KEPT_SUFFIXES": 5, "PAIR_BITS": 3, "TOGETHER": 500, "LONGEST": 30}):
        for name, value in bounds.items():
            monkeypatch.setattr(bpe, name, value)
        own = bpe.Transducer(ranks)
        ids, counts = own.encode(pieces)
        assert [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])] == [library.encode_ordinary(p.decode()) for p in pieces]
        # No state is worked out for single matches, but those of the longest.
        assert bounds or own.made == 0


def test_foreign_patterns_match_whole_texts(ranks):
    for pattern in (r"\p{Lu}?[^\p{Lu}]+|\p{Lu}", r"[\s\S]{1,7}", r"\s?[A-Za-z]+(?: of)?|[\s\S]"):
        own = bpe.Encoder(ranks, pattern)
        library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for text in ["x JavaScriptObjectNotation y", "a list of things of use", *some_texts(200, 3)[:200]]:
            assert own.encode([text])[0] == library.encode_ordinary(text)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_of_a_tokenizer_file_have_the_ids_of_whole_texts(name):
    path = public_tokenizers.path(name)
    library = tokenizers.Tokenizer.from_file(path)
    texts = [*some_texts(600, 4), "x <|endoftext|> y<|endoftext|>", "A b\u00a0 c \u3000d", "one  two   three"]
    words = token_files._words(Path(path).read_bytes())
    column = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    for _ in range(2):  # the second time from what it remembers
        got = []
        for _, data, offsets in slices([column], at_most=3000):
            ids, ends = words.of(data, offsets)
            got += [p.tolist() for p in np.split(ids, ends[:-1])]
        assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_words_are_encoded_without_the_signs_around_them():
    seen = []

    def encode(words):
        seen.extend(words)
        return np.zeros(len(words), np.uint32), np.ones(len(words), np.int64)

    data = "the fox, the fox. the fox!\nfox é; é x×, né\nÉt".encode()
    word_ids.WordIds(encode, fine=True).of(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    assert sorted(seen) == sorted(["the", " the", " fox", "fox", ",", ".", "!\n", " é", ";", " x×,", " né", "\n", "Ét"])


def test_finer_cuts_keep_the_ids_of_whole_texts(ranks):
    rng = random.Random(7)
    parts = ["fox", "É", "né", "×", "÷", "ɏ", "ʰ", "’", ",", ".", "!!!", "'s", "'", "\n", "\n\n", " ", "  ", "\r\n", "\u00a0", "\u0085", "\x1c", "7", "<|endoftext|>", "<|", "日", "(", "&&&"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ranked = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    words = token_files._words(Path(public_tokenizers.path("byte_bpe_50k.json")).read_bytes())
    got = []
    for _, data, offsets in slices([pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])], at_most=5000):
        ids, ends = words.of(data, offsets)
        got += [p.tolist() for p in np.split(ids, ends[:-1])]
    assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert bpe.Encoder(ranks, public_tokenizers.PATTERN).encode(texts) == [ranked.encode_ordinary(t) for t in texts]


def test_decoder_holds_cut_characters_back(ranks):
    tokens = {v: k for k, v in ranks.items()}
    single = [ranks[bytes([b])] for b in "é🙂".encode()]
    decoder = bpe.Decoder(tokens)
    assert [decoder.feed([i]) for i in single] == ["", "é", "", "", "", "🙂"]
    assert decoder.feed(single[:1]) == "" and decoder.feed((), final=True) == "�"


def test_bpe_edges(spark):
    got = bpe.digests(documents(spark), RANKS, public_tokenizers.PATTERN).collect()
    assert len(got) == 14
    texts = {}
    for i, t in TEXTS:
        texts.setdefault(i, set()).add(hashlib.sha256((t or "").encode()).hexdigest())
    assert all(r.decoded_sha256 in texts[r.doc_id] for r in got) and {r.n_tokens for r in got if r.doc_id in (3, 4)} == {0}
    ids = bpe.encode_documents(documents(spark), RANKS, public_tokenizers.PATTERN)
    back = bpe.decode_documents(ids, RANKS)
    assert sorted(map(str, (t or "" for _, t in TEXTS))) == sorted(r.text for r in back.collect())
    assert bpe.digests(empty(spark), RANKS, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("seed", range(12))
def test_simple8b_round_trip(seed):
    rng = np.random.default_rng(seed)
    for n in (0, 1, 7, 1023, 1024, 1025, 4000):
        ids = rng.integers(0, int(rng.choice([1, 2, 300, 50_000, 2**40, 2**60])), n, dtype=np.uint64)
        if seed % 2 and n:
            ids[rng.integers(0, n, max(1, n // 9))] = 2**63 + seed
        if seed % 3 == 0:
            ids[n // 4 : n // 2] = 0
        words, ends = token_files.pack(ids)
        assert (token_files.unpack(words, ends, n) == ids).all()
        for b in range(len(ends)):  # a block alone
            first = ends[b - 1] if b else 0
            size = min(1024, n - b * 1024)
            assert (token_files.unpack(words[first : ends[b]], ends[b : b + 1] - first, size) == ids[b * 1024 : b * 1024 + size]).all()


def test_token_files(spark, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    token_files.write_tokens(documents(spark), str(tmp_path / "t"), path, end_id=2)
    library = tokenizers.Tokenizer.from_file(path)
    want = {}
    for i, t in TEXTS:
        want.setdefault(i, []).append([*library.encode(t or "", add_special_tokens=False).ids, 2])
    got = token_files.read_tokens(spark, str(tmp_path / "t")).orderBy("start").collect()
    start, order = 0, [r.doc_id for r in got]
    for r in got:
        assert r.start == start and r.n_tokens == len(r.ids) and list(r.ids) in want[r.doc_id]
        start += r.n_tokens
    assert len(got) == 14 and order == sorted(order, key=lambda i: (i is not None, i or 0))
    digests = {(r.start, r.ids_crc32) for r in token_files.read_digests(spark, str(tmp_path / "t")).collect()}
    assert digests == {(r.start, zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in got}
    token_files.write_tokens(empty(spark), str(tmp_path / "e"), path, end_id=2)
    assert token_files.read_tokens(spark, str(tmp_path / "e")).count() == 0


def test_counts_equal_the_unigram_library(spark):
    file = public_tokenizers.path("piece_bpe_32k.model")
    pieces, has_bytes = token_counts.read_pieces(Path(file).read_bytes())
    library = tokenizers.Tokenizer(models.Unigram(pieces, 0, byte_fallback=has_bytes))
    library.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    counter = token_counts.Counter(pieces, has_bytes)
    texts = some_texts()
    assert [counter.text(t)[0] for t in texts] == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    got = token_counts.token_counts(documents(spark), file).collect()
    assert len(got) == 14 and {r.n_tokens for r in got if r.doc_id in (3, 4)} == {0}
    assert token_counts.token_counts(empty(spark), file).count() == 0


def test_ties_and_unknown_runs():
    pieces = [("<unk>", 0.0), ("▁", -1.0), ("a", -2.0), ("b", -2.0), ("ab", -4.0), ("▁a", -3.0)]
    library = tokenizers.Tokenizer(models.Unigram(pieces, 0, byte_fallback=False))
    library.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    counter = token_counts.Counter(pieces, False)
    for t in ("ab", "a", "aab", "zz a", "zzazz", "abab b", "z<unk>z a"):
        assert counter.text(t)[0] == len(library.encode(t, add_special_tokens=False).ids), t
