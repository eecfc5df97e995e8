import json
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quayside.llm import tokencount as C
from quayside.llm.common import table
from quayside.llm.queries import QUERIES, rank_file

SMALL = "/root/testdata/sf0.001"
FILE = "byte_bpe_50k.json"
PARTS = ["a", "b", "'", "s", "re", "'ll", "'s", " ", "  ", "\n", "\t", "7", "é", "漢", "字", "ß", "!", "<|endoftext|>", "<|endof",
         " ", "\x1c", "\x85", " ", "😀", "ſ", "Don't ", "aaaa", "\x00", "'T", "٣", "the "]


@pytest.fixture(scope="module")
def library():
    tool = Tokenizer.from_file(public_tokenizers.path(FILE))
    return lambda texts: [len(e.ids) for e in tool.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def tool():
    return C.Counter(rank_file(FILE), C.character_classes())


def test_mixed_texts_as_the_library(tool, library):
    r = random.Random(1)
    texts = ["".join(r.choices(PARTS, k=r.randrange(40))) for _ in range(6000)] + ["", "'", "<|endoftext|>" * 3, " " * 400 + "x"]
    assert tool.count(texts).tolist() == library(texts)


def test_every_code_point_as_the_library(tool, library):
    texts = [f"{c}a{c} {c}{c}1" for c in map(chr, range(0x110000)) if not 0xD800 <= ord(c) < 0xE000]
    assert tool.count(texts).tolist() == library(texts)


def test_long_matches_as_the_library(tool, library):
    r = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyzABC0123456789"
    texts = ["".join(r.choices(letters, k=1_000_000)), "a" * 1_000_000, "漢字仮名" * 50_000, "=" * 200_000]
    assert tool.count(texts).tolist() == library(texts)


def test_merges_are_counted_without_the_cut(tool, library):
    words = ["internationalization", " thththth", "aaaaaaa", "ſſ", " unbelievable"]
    assert [len(w.encode()) - tool.merges(w.encode()) for w in words] == library(words)


def test_query_as_the_library(spark, library):
    docs = table(spark, SMALL, "documents").collect()
    got = {r.doc_id: tuple(r) for r in QUERIES["op13_token_counts"](spark, SMALL).collect()}
    n = library([d.text or "" for d in docs])
    assert got == {d.doc_id: (d.doc_id, len((d.text or "").encode()), k, k > 512) for d, k in zip(docs, n, strict=True)}
    assert {r[3] for r in got.values()} == {True, False}


def test_odd_rows(spark, library):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "x <|endoftext|> y"), (4, "ab cd" * 9000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit(-1)).withColumn("id", F.lit(7))
    got = C.count_tokens(df, rank_file(FILE), limit=2).collect()
    want = library([t or "" for _, t in rows])
    assert sorted(map(tuple, got), key=str) == sorted(
        ((i, len((t or "").encode()), k, k > 2) for (i, t), k in zip(rows, want, strict=True)), key=str)
    assert C.count_tokens(df.where("doc_id = 99"), rank_file(FILE)).count() == 0


def test_other_kinds_of_tokenizers_are_refused():
    spec = json.loads(rank_file(FILE))
    spec["normalizer"] = {"type": "Lowercase"}
    for bad in (json.dumps(spec).encode(), rank_file("word_bpe_49k.json")):
        with pytest.raises(ValueError):
            C.Counter(bad, b"")
