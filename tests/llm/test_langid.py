import itertools
import zlib

import numpy as np
import pytest

from quayside.llm import langid as L
from quayside.llm.common import table

DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return L.train(table(spark, DIR, "documents"))


def test_held_out_accuracy(spark, model):
    docs = table(spark, DIR, "documents").select("doc_id", "text", "lang")
    want = {r.doc_id: r.lang for r in docs.collect()}
    got = L.identify(docs.drop("lang"), model).collect()
    held = [r.lang == want[r.id] for r in got if zlib.crc32(str(r.id).encode()) % 5 == 0]
    assert len(held) > 100 and np.mean(held) > 0.97 and all(0 <= r.score <= 1 for r in got)


def test_viterbi_is_the_best_of_all_paths():
    r = np.random.default_rng(1)
    score, per_text = r.standard_normal((7, 3)) * 2, np.array([5, 0, 1, 4])
    code = r.integers(0, 7, per_text.sum())
    path = L.viterbi(score, code, per_text, 1.5)
    at = 0
    for n in per_text:
        value = lambda p, at=at, n=n: sum(score[code[at + i], k] for i, k in enumerate(p)) - 1.5 * sum(
            a != b for a, b in itertools.pairwise(p))
        best = max(map(value, itertools.product(range(3), repeat=int(n))))
        assert abs(value(path[at:at + n]) - best) < 1e-9
        at += n


def test_spans_of_mixed_text(spark, model):
    docs = {r.lang: r.text for r in table(spark, DIR, "documents").where("length(text) > 400").orderBy("doc_id").collect()}
    de, es = docs["de"][:200], docs["es"][:200]
    (spans,) = model.label([f"{de} -- {es}"])
    named = [(a, z, model.langs[k]) for a, z, k in spans]
    assert [k for *_, k in named] == ["de", "es"] and abs(named[1][0] - 204) < 25


def test_scripts_narrow_the_candidates():
    counts = np.ones((2, L.BUCKETS))
    letters = np.zeros((2, len(L.SCRIPTS)))
    letters[0, L.SCRIPTS.index("latin")] = letters[1, L.SCRIPTS.index("cyrillic")] = 1000
    two = L.Model.of_counts(["en", "ru"], counts, letters)
    score, _ = two.word_scores(["word", "слово", "字"])
    assert score[0].argmax() == 0 and score[1].argmax() == 1 and score[2][0] == score[2][1]
    assert L.SCRIPTS[L._SCRIPT_OF[np.searchsorted(L._STARTS, ord("ж"), side="right") - 1]] == "cyrillic"


def test_words_in_a_script_of_another_language_are_spans():
    letters = np.zeros((3, len(L.SCRIPTS)))
    letters[:2, L.SCRIPTS.index("latin")] = letters[2, L.SCRIPTS.index("cyrillic")] = 1000
    three = L.Model.of_counts(["de", "en", "ru"], np.ones((3, L.BUCKETS)), letters)
    assert np.isfinite(three.word_scores(["字"])[0]).all()
    text = "some plain words добрый день and some more"
    inside, edge, alone = three.label([text, "слово at the edge", "字 слово 字"])
    latin = inside[0][2]
    assert latin != 2 and inside == [(0, 16, latin), (17, 28, 2), (29, len(text), latin)]
    assert [(a, z, k == 2) for a, z, k in edge] == [(0, 5, True), (6, 17, False)]
    assert alone == [(0, 9, 2)]


def test_words_keep_their_places():
    code, words, n, begin, end = L.words_of(["ab cd", "", "e!ab", "日本 x", "1 2"])
    assert [words[c] for c in code] == ["ab", "cd", "e", "ab", "日本", "x"] and n.tolist() == [2, 0, 2, 2, 0]
    assert list(zip(begin.tolist(), end.tolist(), strict=True)) == [(0, 2), (3, 5), (0, 1), (2, 4), (0, 2), (3, 4)]
    code, words, n, *_ = L.words_of(["ab", "cd"])
    assert [words[c] for c in code] == ["ab", "cd"] and n.tolist() == [1, 1]


def test_nulls_repeats_clashing_columns_and_empty_tables(spark, model):
    docs = spark.createDataFrame([(1, None, 0.1), (1, None, 0.1), (None, "", 0.2), (3, "123 !!", 0.3), (4, "und der die " * 20000, 1.0)],
                                 "doc_id long, text string, score double")
    got = sorted((r.lang, r.score) for r in L.identify(docs, model).collect())
    assert got == [("de", 1.0)] + [("und", 0.0)] * 4
    assert L.identify(docs.limit(0), model).count() == 0
    none = L.train(docs.selectExpr("doc_id", "text", "cast(null as string) lang"))
    assert {r.lang for r in L.identify(docs, none).collect()} == {"und"}
