import zlib

import numpy as np
import pytest

from quayside.llm import quality as Q
from quayside.llm.common import table

DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return Q.train(table(spark, DIR, "documents"), table(spark, DIR, "labels"))


def test_held_out_accuracy(spark, model):
    docs, labels = table(spark, DIR, "documents"), table(spark, DIR, "labels")
    rows = Q.scores(docs, model).join(labels.withColumnRenamed("doc_id", "id"), "id").collect()
    held = [(r.score, r.quality) for r in rows if zlib.crc32(str(r.id).encode()) % 3 == 1]
    right = np.mean([(s >= 0.5) == (q == 1) for s, q in held])
    assert len(held) > 50 and right > 0.95


def test_passages_cover_the_whole_text():
    texts = [b"", b"one", b" ".join([b"w"] * 64), b" ".join([b"w"] * 65), b"\n\t ", " ".join(["é"] * 200).encode()]
    x, bags = Q.encode_chunk(texts)
    assert bags.tolist() == [1, 1, 1, 2, 1, 4] and x.shape == (10, Q.DIM) and np.isfinite(x).all()
    words = x[:, Q.CLASSES + Q.LAGS + 1] * Q.PASSAGE_WORDS
    assert words.round().tolist() == [0, 1, 64, 64, 1, 0, 64, 64, 64, 8]
    # a text's encoding doesn't depend on its neighbours
    alone = np.concatenate([Q.encode_chunk([t])[0] for t in texts])
    assert np.allclose(alone, x, atol=1e-6)


def test_gradients_are_those_of_the_loss():
    r = np.random.default_rng(0)
    net = Q.AttentionMIL.new(dim=6)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, bags, label = r.standard_normal((9, 6)), np.array([2, 4, 3]), np.array([0.0, 1.0, 1.0])

    def loss():
        y = net.forward(x, bags)["y"]
        return -(label * np.log(y) + (1 - label) * np.log(1 - y)).mean()

    for name, g in net.gradients(x, bags, label).items():
        for at in list(np.ndindex(g.shape))[:5]:
            keep = net.p[name][at]
            net.p[name][at] = keep + 1e-5
            up = loss()
            net.p[name][at] = keep - 1e-5
            down = loss()
            net.p[name][at] = keep
            assert abs((up - down) / 2e-5 - g[at]) < 1e-5, name


def test_nulls_repeats_clashing_columns_and_empty_tables(spark, model):
    docs = spark.createDataFrame([(1, None, 0.5), (1, None, 0.5), (None, "", 1.0), (2, "the and of to " * 3000, 2.0)],
                                 "doc_id long, text string, score double")
    got = Q.scores(docs, model).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.id != 2}) == 1  # null and empty alike
    kept = Q.keep_good(docs, model, threshold=0.0)
    assert kept.columns == docs.columns and kept.count() == 4 and Q.keep_good(docs, model, threshold=1.1).count() == 0
    assert Q.scores(docs.limit(0), model).count() == 0


def test_labels_that_teach_nothing(spark):
    docs = spark.createDataFrame([(k, "text") for k in range(30)], "doc_id long, text string")
    labels = spark.createDataFrame([(None, 1), (5, None), (6, 1), (6, 0), (7, 3)], "doc_id long, quality int")
    net = Q.train(docs, labels)
    assert {round(r.score, 6) for r in Q.scores(docs, net).collect()} == {0.5}


def plain_passages(text):
    """Encoder in plain Python: the passages of a text, their spans and words, and the encodings."""
    raw = text.encode() + b" "
    white = {32, 9, 11, 12, 10, 13}
    words, at = [], None
    for k, c in enumerate(raw):
        if c in white:
            if at is not None:
                words.append((at, k))
                at = None
        elif at is None:
            at = k
    groups = [words[i:i + Q.PASSAGE_WORDS] for i in range(0, len(words), Q.PASSAGE_WORDS)] or [[]]
    starts = [0] + [g[0][0] for g in groups[1:]] + [len(raw)]
    out, seen = [], [raw[a:b] for a, b in words]
    for k, g in enumerate(groups):
        span = raw[starts[k]:starts[k + 1]]
        classes = [sum(Q.CLASS_OF[c] == x for c in span) for x in range(Q.CLASSES)]
        row = [(n / len(span)) ** 0.5 for n in classes]
        some = max(1, len(g))
        own = range(k * Q.PASSAGE_WORDS, k * Q.PASSAGE_WORDS + len(g))
        row += [sum(i >= lag and seen[i] == seen[i - lag] for i in own) / some for lag in range(1, Q.LAGS + 1)]
        row += [sum(min(b - a, 64) for a, b in g) / some / 16, len(g) / Q.PASSAGE_WORDS, np.log1p(len(words)) / 10]
        out.append(row)
    return out


def test_encoder_attention_and_score_as_plain_loops(model):
    texts = ["", "one two two", "A, b! " * 70 + "x\n" * 90, "été 12 " * 65, " ".join(f"w{k % 7}" for k in range(200))]
    x, bags = Q.encode_chunk([t.encode() for t in texts])
    want = [row for t in texts for row in plain_passages(t)]
    assert len(want) == len(x) and np.allclose(x[:, :-Q.BUCKETS], want, atol=1e-5)
    buckets = x[:, -Q.BUCKETS:].astype(np.float64) ** 2
    n = np.round(x[:, Q.CLASSES + Q.LAGS + 1] * Q.PASSAGE_WORDS)
    assert np.allclose(buckets.sum(1), n > 0, atol=1e-4)  # the shares of a passage's words
    p, at, scores = {k: v.astype(np.float64) for k, v in model.p.items()}, 0, Q.score_texts(model, texts)
    for size, score in zip(bags, scores, strict=True):
        hidden, weight = [], []
        for row in x[at:at + size]:
            h = np.maximum(((row - p["mean"]) / p["std"]) @ p["W"] + p["b"], 0)
            gate = [np.tanh(h @ p["V"][:, k]) / (1 + np.exp(-(h @ p["U"][:, k]))) for k in range(p["w"].size)]
            hidden.append(h)
            weight.append(np.exp(np.dot(gate, p["w"])))
        z = sum(w * h for w, h in zip(weight, hidden, strict=True)) / sum(weight)
        assert abs(1 / (1 + np.exp(-(z @ p["c"] + p["c0"][0]))) - score) < 1e-4
        at += size


def test_training_reads_whole_texts_of_a_bounded_sample(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(Q.AttentionMIL, "fit", lambda self, bags, label: seen.append([len(b) for b in bags]) or self)
    docs = spark.createDataFrame([(k, "w " * 64 * (k + 100)) for k in range(12)] + [(3, "other")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(12)], "doc_id long, quality int")
    Q.train(docs, labels, folds=100, fold=99)
    assert set(seen[0]) - {1} <= {k + 100 for k in range(12)} and len(seen[0]) == 12
    Q.train(docs, labels, folds=100, fold=99, max_train=5)
    Q.train(docs, labels, folds=100, fold=99, max_train_bytes=45_000)
    Q.train(docs, labels, folds=100, fold=99, max_train_bytes=1)
    n = [len(s) for s in seen[1:]]  # a text has some 13,000 bytes, one may be the short one
    assert n[0] == 5 and n[1] in (3, 4) and n[2] == 1
