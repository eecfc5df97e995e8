import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from quayside.llm import queries as Q
from quayside.llm import runs as R
from quayside.llm.common import table

SMALL = "/root/testdata/sf0.001"


def plain(words, least=12):
    """All runs by comparing the words with themselves at every distance."""
    code = np.unique(np.array(words, dtype=object).astype(str), return_inverse=True)[1] if words else np.zeros(0, int)
    n, best = len(code), {}
    for p in range(1, n // 2 + 1):
        same = np.concatenate([[False], code[:-p] == code[p:], [False]])
        edge = np.flatnonzero(np.diff(same))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if b - a >= p and b - a + p >= least:
                best.setdefault((a, b - a + p), p)
    return sorted(((a, size, p) for (a, size), p in best.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {k for a, size, p in runs for k in range(a + p, a + size)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def found(texts, least):
    code, _, first = R.words_of([t.encode() for t in texts])
    rows = R.all_runs(code, first, least)
    own = np.searchsorted(first, rows[:, 0], side="right") - 1
    return [[(a - int(first[k]), size, p) for a, size, p in rows[own == k].tolist()] for k in range(len(texts))]


def random_text(r):
    kind, n = r.randrange(4), r.randrange(60)
    if kind == 0:
        return " ".join(r.choices("ab", k=n))
    if kind == 1:
        return " ".join(r.choices("abc", weights=[8, 1, 1], k=n))
    parts = [r.choices("abcd", k=r.randrange(1, 7)) * r.randrange(1, 9) for _ in range(r.randrange(1, 4))]
    words = [w for p in parts for w in p]
    if kind == 3 and words:
        words[r.randrange(len(words))] = "z"
    return " ".join(words)


@pytest.mark.parametrize("least", [2, 5, 12])
def test_random_texts_as_brute_force(least):
    r = random.Random(least)
    for _ in range(150):
        texts = [random_text(r) for _ in range(8)]
        assert found(texts, least) == [plain(t.split(), least) for t in texts]


def test_fibonacci_words_and_powers():
    a, b = ["a"], ["a", "b"]
    while len(b) < 600:
        a, b = b, b + a
    texts = [" ".join(b), "x " * 500, "x y z " * 300, " ".join("x" * k + "y" for k in range(90)), "x " * 40 + "y " + "x " * 40]
    assert found(texts, 12) == [plain(t.split()) for t in texts]


def test_a_long_text_of_one_word_and_many_left_words_stay_cheap():
    n = 60_000
    hot = " ".join(f"w{k} one two three four five six seven" for k in range(8000))
    assert found(["x " * n, hot], 12) == [[(0, n, 1)], []]


def words_of(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def test_query_as_brute_force(spark):
    got = {r.doc_id: r for r in Q.QUERIES["op12_word_runs"](spark, SMALL).collect()}
    docs = table(spark, SMALL, "documents").collect()
    assert len(got) == len(docs) and sum(r.n_runs for r in got.values()) > 10
    for d in docs:
        words = words_of(d.doc_id, d.text)
        runs, r = plain(words), got[d.doc_id]
        top = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=None)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *(top or (None,) * 3))
        assert r.exponent_milli == (top and 1000 * top[1] // top[2])
        assert r.runs_sha256 == hashlib.sha256("".join("%d,%d,%d\n" % x for x in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()


def test_odd_rows(spark):
    text = "a b " * 10
    rows = [(1, None, "x"), (2, "", "x"), (3, " \t\n", None), (4, text, "x"), (4, text, "x"), (None, text, "x"),
            (5, "ünï çødé " * 7 + " ", "x"), (6, "é\x0b" * 13, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = sorted(((r.id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in R.find_runs(df).collect()), key=str)
    assert got == sorted([
        (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 20, [(0, 20, 2)], "a b"), (4, 20, [(0, 20, 2)], "a b"),
        (None, 20, [(0, 20, 2)], "a b"), (5, 15, [(0, 14, 2)], "ünï çødé  "), (6, 13, [(0, 13, 1)], "é")], key=str)
    none = hashlib.sha256(b"").hexdigest()
    first = R.digests(R.find_runs(df.where("doc_id = 1"))).first()
    assert tuple(first) == (1, 0, None, None, None, None, none, none)
    assert R.digests(R.find_runs(df.where("doc_id = 9"))).count() == 0


def test_repeated_documents_of_the_query(spark):
    chosen = [k for k in range(200) if zlib.crc32(str(k).encode()) % 10 == 0]
    texts = [None, "", "  ", "one", "a b c d e f g h i j k l m n", " tab\tand\nline  "]
    rows = [(k, t) for k in [*chosen[:6], chosen[0] + 1] for t in texts]
    got = Q.with_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, " ".join((r.text or "").split())) for r in got) == sorted((k, " ".join(words_of(k, t))) for k, t in rows)
