"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_WORDS`` words. Every passage is
encoded (byte classes, repeated words, hashed words), a small network maps it to
a hidden vector, a gated attention (tanh branch times sigmoid branch) learned
from document labels weighs the passages, and a logistic layer scores the
weighted sum. One bad passage among many good ones can so decide a document,
which a mean over the passages would hide.

The model is fitted on the driver from a bounded sample of labelled rows
(``max_train`` documents of ``max_train_bytes`` of text together, each with all its
passages); what reaches the driver is their encodings, bounded by both. Scoring
runs in Arrow batches over every passage of every text, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.common import Scratch, doc_bucket, per_batch, pick

PASSAGE_WORDS = 64
#: Punctuation that gets a class of its own; other bytes are upper, lower, digit, blank, line end, non-ASCII, rest.
MARKS = b"!$#%&*|.,;:<>=/\\-_\"'()[]{}@"
BUCKETS = 64
LAGS = 3
CLASSES = len(MARKS) + 7
DIM = CLASSES + LAGS + 3 + BUCKETS
#: Texts are encoded in chunks of about so many bytes (a longer text alone).
CHUNK = 1 << 20


def byte_classes() -> np.ndarray:
    out = np.full(256, len(MARKS) + 6, dtype=np.int64)
    for k, lo, hi in ((0, 65, 91), (1, 97, 123), (2, 48, 58), (5, 128, 256)):
        out[lo:hi] = len(MARKS) + k
    out[[32, 9, 11, 12]], out[[10, 13]] = len(MARKS) + 3, len(MARKS) + 4
    out[np.frombuffer(MARKS, np.uint8)] = np.arange(len(MARKS))
    return out


CLASS_OF = byte_classes()
BYTE_CODE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
BASE, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def encode_chunk(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(encodings, passages per text): one row per passage, one empty passage for
    a text without words."""
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    size = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    at = np.concatenate([[0], np.cumsum(size)])
    cls = CLASS_OF[raw]
    blank = (cls == len(MARKS) + 3) | (cls == len(MARKS) + 4)
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank])))  # words begin and end in turn
    begin, end = edge[::2], edge[1::2]
    doc = np.searchsorted(at, begin, side="right") - 1
    words = np.bincount(doc, minlength=len(texts))
    first = np.concatenate([[0], np.cumsum(words)])[:-1]
    n_pass = np.maximum(1, -(-words // PASSAGE_WORDS))
    base = np.concatenate([[0], np.cumsum(n_pass)])
    total = int(base[-1])
    passage = base[doc] + (np.arange(len(doc)) - first[doc]) // PASSAGE_WORDS
    # a word's polynomial hash from prefix sums, wrapping at 2**64
    power = np.full(len(raw) + 1, BASE, dtype=np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    summed = np.concatenate([[np.uint64(0)], np.cumsum(BYTE_CODE[raw] * power[:-1], dtype=np.uint64)])
    # sums of words at different places differ by a power of the base, which its inverse takes out
    back = np.full(len(raw) + 1, INVERSE, dtype=np.uint64)
    back[0] = 1
    h = (summed[end] - summed[begin]) * np.multiply.accumulate(back)[begin]
    h = (h ^ (h >> np.uint64(32))) * MIX
    h ^= h >> np.uint64(29)
    out = np.zeros((total, DIM), dtype=np.float32)
    starts = np.full(total, -1, dtype=np.int64)
    starts[base[:-1]] = at[:-1]
    head = np.flatnonzero(np.diff(passage, prepend=-1))
    inner = head[(np.arange(len(doc)) - first[doc])[head] > 0]
    starts[passage[inner]] = begin[inner]
    length = np.diff(np.concatenate([starts, [len(raw)]]))
    of = np.repeat(np.arange(total), length)
    counts = np.bincount(of * CLASSES + cls, minlength=total * CLASSES).reshape(total, CLASSES)
    out[:, :CLASSES] = np.sqrt(counts / length[:, None])
    n = np.bincount(passage, minlength=total)
    some = np.maximum(n, 1)
    for lag in range(1, LAGS + 1):
        same = np.zeros(len(h), dtype=bool)
        same[lag:] = (h[lag:] == h[:-lag]) & (doc[lag:] == doc[:-lag])
        out[:, CLASSES + lag - 1] = np.bincount(passage, weights=same, minlength=total) / some
    out[:, CLASSES + LAGS] = np.bincount(passage, weights=np.minimum(end - begin, 64), minlength=total) / some / 16
    out[:, CLASSES + LAGS + 1] = n / PASSAGE_WORDS
    out[:, CLASSES + LAGS + 2] = np.log1p(np.repeat(words, n_pass)) / 10
    bucket = (h >> np.uint64(58)).astype(np.int64)
    hist = np.bincount(passage * BUCKETS + bucket, minlength=total * BUCKETS).reshape(total, BUCKETS)
    out[:, -BUCKETS:] = np.sqrt(hist / some[:, None])
    return out, n_pass


def chunks(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first, texts as UTF-8) in chunks of about CHUNK bytes."""
    held, size, first = [], 0, 0
    for k, t in enumerate(texts):
        b = (t or "").encode()
        if held and size + len(b) > CHUNK:
            yield first, held
            held, size, first = [], 0, k
        held.append(b)
        size += len(b)
    if held:
        yield first, held


class AttentionMIL:
    """The network and its gradients; float32 parameters in ``p``."""

    HIDDEN, GATE = 32, 16

    def __init__(self, params: dict[str, np.ndarray]):
        self.p = params

    @classmethod
    def new(cls, dim: int = DIM, seed: int = 11) -> AttentionMIL:
        r = np.random.default_rng(seed)
        init = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        zero = lambda *s: np.zeros(s, np.float32)
        return cls({"mean": zero(dim), "std": np.ones(dim, np.float32), "W": init(dim, cls.HIDDEN), "b": zero(cls.HIDDEN),
                    "V": init(cls.HIDDEN, cls.GATE), "U": init(cls.HIDDEN, cls.GATE), "w": init(cls.GATE),
                    "c": init(cls.HIDDEN), "c0": zero(1)})

    def forward(self, x: np.ndarray, bags: np.ndarray) -> dict[str, np.ndarray]:
        """x: passages, bags: passages per document (1 at least), in order."""
        p = self.p
        at = np.concatenate([[0], np.cumsum(bags)[:-1]]).astype(np.int64)
        of = np.repeat(np.arange(len(bags)), bags)
        x = (x - p["mean"]) / p["std"]
        h = np.maximum(x @ p["W"] + p["b"], 0)
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        g = t * s
        e = g @ p["w"]
        a = np.exp(e - np.maximum.reduceat(e, at)[of])
        a = a / np.add.reduceat(a, at)[of]
        z = np.add.reduceat(a[:, None] * h, at, axis=0)
        y = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["c0"], -40, 40)))
        return {"x": x, "h": h, "t": t, "s": s, "g": g, "a": a, "z": z, "y": y, "of": of, "at": at}

    def score(self, x: np.ndarray, bags: np.ndarray) -> np.ndarray:
        return self.forward(x, bags)["y"].astype(np.float64)

    def gradients(self, x: np.ndarray, bags: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        f, p = self.forward(x, bags), self.p
        d = ((f["y"] - label) / len(bags)).astype(np.float32)
        dz = d[:, None] * p["c"]
        da = (dz[f["of"]] * f["h"]).sum(1)
        mean = np.add.reduceat(f["a"] * da, f["at"])[f["of"]]
        de = f["a"] * (da - mean)
        dg = de[:, None] * p["w"]
        dt, ds = dg * f["s"] * (1 - f["t"] ** 2), dg * f["t"] * f["s"] * (1 - f["s"])
        dh = f["a"][:, None] * dz[f["of"]] + dt @ p["V"].T + ds @ p["U"].T
        dh = dh * (f["h"] > 0)
        return {"W": f["x"].T @ dh, "b": dh.sum(0), "V": f["h"].T @ dt, "U": f["h"].T @ ds, "w": f["g"].T @ de,
                "c": f["z"].T @ d, "c0": d.sum(keepdims=True)}

    def fit(self, bags_x: list[np.ndarray], label: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 3e-3,
            decay: float = 1e-4, seed: int = 5) -> AttentionMIL:
        """Adam over shuffled batches of documents. Needs both labels; else the
        score is the share of label 1 (0.5 without any row)."""
        if not len(label) or label.min() == label.max():
            share = float(np.clip(label.mean() if len(label) else 0.5, 0.01, 0.99))
            self.p["c"][:], self.p["c0"][:] = 0, np.log(share / (1 - share))
            return self
        whole = np.concatenate(bags_x)
        self.p["mean"], self.p["std"] = whole.mean(0), whole.std(0) + np.float32(1e-2)
        r, m, v, k = np.random.default_rng(seed), {}, {}, 0
        for epoch in range(epochs):
            order = r.permutation(len(label))
            step = rate * (1 - epoch / epochs)
            for i in range(0, len(order), batch):
                rows, k = order[i:i + batch], k + 1
                bags = np.array([len(bags_x[j]) for j in rows])
                for name, g in self.gradients(np.concatenate([bags_x[j] for j in rows]), bags, label[rows]).items():
                    m[name] = 0.9 * m.get(name, 0) + 0.1 * g
                    v[name] = 0.999 * v.get(name, 0) + 0.001 * g * g
                    move = (m[name] / (1 - 0.9 ** k)) / (np.sqrt(v[name] / (1 - 0.999 ** k)) + 1e-8)
                    self.p[name] -= (step * (move + decay * self.p[name])).astype(np.float32)
        return self


def bounded_sample(labels: DataFrame, id_col: str, label_col: str, max_train: int, fold: int, folds: int) -> DataFrame:
    """(id, label): at most ``max_train`` labelled ids outside the held-out fold,
    the ones with the smallest id hashes. Ids with contradicting labels are left out."""
    rows = pick(labels, id=id_col, label=label_col).where("id is not null and label in (0, 1)")
    rows = rows.where(doc_bucket(F.col("id"), folds) != fold)
    rows = rows.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other")
    return rows.select("id", F.col("label").cast("int").alias("label")).orderBy(F.xxhash64("id"), "id").limit(max_train)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", fold: int = 1, folds: int = 3, max_train: int = 4000,
          max_train_bytes: int = 32 << 20) -> AttentionMIL:
    """Fit on labelled documents whose crc32(id) mod ``folds`` isn't ``fold``: those with the smallest id hashes,
    up to ``max_train`` of them and, but for the first, ``max_train_bytes`` of text. They are read whole.
    Of an id with several texts the one with the smallest hash counts."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "quality")
    sample = bounded_sample(labels, id_col, label_col, max_train, fold, folds)
    rows = pick(docs, id=id_col, text=text_col).join(F.broadcast(sample), "id")
    rows = rows.withColumn("text", F.coalesce("text", F.lit(""))).groupBy("id", "label").agg(
        F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    rows = scratch.keep(rows, "labelled")  # at most max_train rows
    upto = Window.orderBy(F.xxhash64("id"), "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = scratch.again(rows).select("id", F.octet_length("text").cast("bigint").alias("size"))
    few = sizes.withColumn("upto", F.sum("size").over(upto)).where(
        (F.col("upto") <= max_train_bytes) | (F.col("upto") == F.col("size"))).select("id")
    rows = rows.join(F.broadcast(few), "id", "left_semi").select("id", "label", "text")
    schema = T.StructType([rows.schema["id"], rows.schema["label"], T.StructField("n", T.IntegerType()),
                           T.StructField("x", T.BinaryType())])

    def work():
        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            n, x = [], []
            for _, held in chunks(b.column(2).to_pylist()):
                coded, bags = encode_chunk(held)
                n += bags.tolist()
                x += [part.tobytes() for part in np.split(coded, np.cumsum(bags)[:-1])]
            return pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int32()), pa.array(x, pa.binary())],
                                              names=["id", "label", "n", "x"])
        return step

    got = per_batch(rows, work, schema, text_at=2).collect()  # bounded by max_train and max_train_bytes
    got.sort(key=lambda r: str(r["id"]))
    bags = [np.frombuffer(r["x"], np.float32).reshape(r["n"], DIM) for r in got]
    return AttentionMIL.new().fit(bags, np.array([r["label"] for r in got], dtype=np.float32))


def score_texts(model: AttentionMIL, texts: list[str | None]) -> np.ndarray:
    out = np.zeros(len(texts))
    for first, held in chunks(texts):
        x, bags = encode_chunk(held)
        out[first:first + len(held)] = model.score(x, bags)
    return out


def scores(docs: DataFrame, model: AttentionMIL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for every row; a null text scores like an empty one."""
    rows = pick(docs, id=id_col, text=text_col)
    schema = T.StructType([rows.schema["id"], T.StructField("score", T.DoubleType())])
    params = model.p

    def work():
        net = AttentionMIL(params)

        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(score_texts(net, b.column(1).to_pylist()))], names=["id", "score"])
        return step

    return per_batch(rows, work, schema, text_at=1)


def keep_good(docs: DataFrame, model: AttentionMIL, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Pipeline stage: the rows of ``docs`` that score ``threshold`` or more, as they were."""
    names = [f"c{k}" for k in range(len(docs.columns))]
    at, params = docs.columns.index(text_col), model.p

    def work():
        net = AttentionMIL(params)

        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            return b.filter(pa.array(score_texts(net, b.column(at).to_pylist()) >= threshold))
        return step

    rows = docs.toDF(*names)
    return per_batch(rows, work, rows.schema, text_at=at).toDF(*docs.columns)
