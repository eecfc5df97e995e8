import random

import public_tokenizers
import pytest
import regex
import tiktoken

from quayside.llm import bpe
from quayside.llm.queries import rank_file

EVERY = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
PARTS = ["a", "b", " ", "  ", "\n", "\t", "'", "'s", "'ll", "'re", "é", "ß", "1", "２", "Ⅷ", "!", "$$", " ", " ", "日本",
         "本", "😀", "\x1c", "\x85", "​", "᠎", "́", "don't", "I'm", "'S", "_", "the ", "ing", "\r\n", "'t", "'d", "\x00"]


@pytest.fixture(scope="module")
def tool():
    return bpe.Codec(bpe.read_ranks(rank_file()))


@pytest.fixture(scope="module")
def known(tool):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tool.ranks, special_tokens={})


def check(tool, known, texts):
    ids, back = tool.round_trip(texts)
    assert ids.to_pylist() == [known.encode_ordinary(t) for t in texts]
    assert back.to_pylist() == [t.encode() for t in texts]


def test_mixed_texts_as_the_library(tool, known):
    r = random.Random(1)
    check(tool, known, ["".join(r.choices(PARTS, k=r.randrange(40))) for _ in range(1500)]
          + ["", "'", "'s", " 's", "''s", "x'", "!'s", " " * 300 + "x", "\n" * 200, "<|endoftext|>"])


def test_long_words_as_the_library(tool, known):
    r = random.Random(2)
    check(tool, known, ["a" * 5000, "ab" * 2000, "".join(r.choices("abcdefgh", k=1500)), "é" * 700, "=" * 3000, "日" * 400])


def test_every_code_point_splits_as_the_library(known):
    pattern = regex.compile(public_tokenizers.PATTERN)
    for between in (" a", "1", "!", "\n"):
        texts = [between.join(EVERY[i:i + 20000]) for i in range(0, len(EVERY), 20000)]
        raw, at, n = bpe.split(texts)
        got = [raw[a:b].decode() for a, b in zip(at[:-1], at[1:], strict=True)]
        assert got == [m for t in texts for m in pattern.findall(t)] and len(got) == n.sum()


def test_rounds_may_stop_and_go_on(tool, known, monkeypatch):
    monkeypatch.setattr(bpe, "ROUNDS", 2)
    monkeypatch.setattr(tool, "known", {})
    check(tool, known, ["antidisestablishmentarianism unwortheinmalig " + "ab" * 90])


def test_hash_collisions_fall_back_to_the_words(tool, known, monkeypatch):
    import numpy as np
    monkeypatch.setattr(np.random, "default_rng", lambda seed: type("R", (), {
        "integers": staticmethod(lambda lo, hi, n, dtype: np.zeros(n, dtype))})())
    check(tool, known, ["abc abd xyz, abc xyw", "abc"])


def test_rows_of_a_table(spark, tool, known):
    rows = [(1, "Hello world, don't"), (1, "Hello world, don't"), (2, None), (None, ""), (3, "naïve café " * 200)]
    docs = spark.createDataFrame([(i, t, "clash", 7) for i, t in rows], "doc_id long, text string, ids string, decoded int")
    out = bpe.encode(docs, rank_file())
    got = sorted([(r.id, list(r.ids), bytes(r.decoded)) for r in out.collect()], key=repr)
    assert got == sorted([(i, known.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows], key=repr)
    back = {(r.id, bytes(r.decoded)) for r in bpe.decode(out, rank_file()).collect()}
    assert back == {(i, (t or "").encode()) for i, t in rows}
    digest = bpe.digests(out).where("id = 2").collect()[0]
    assert digest.n_tokens == 0 and digest.ids_sha256 == digest.decoded_sha256
    assert bpe.encode(docs.limit(0), rank_file()).count() == 0


def test_decode_of_null_and_unknown_ids(spark):
    lists = spark.createDataFrame([(1, None), (2, []), (3, [64, 999999]), (4, [64, None]), (5, [64, 65])], "id long, ids array<int>")
    got = {r.id: r.decoded for r in bpe.decode(lists, rank_file()).collect()}
    ranks = {v: k for k, v in bpe.read_ranks(rank_file()).items()}
    assert got == {1: b"", 2: b"", 3: None, 4: None, 5: ranks[64] + ranks[65]}
