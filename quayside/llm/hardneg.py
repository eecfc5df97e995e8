"""Hard negatives by a secondary-sort shuffle.

1. Rows are dealt by hash to slices and anchors to blocks, both bounded in bytes; a task
   scores one block of anchors against one slice of rows.
2. Pass one: of each anchor a slice sends on its best ``positives`` rows of the same label,
   no later one can be among the anchor's. Pass two: for each of the anchor's windows a
   slice sends on its best ``negatives`` rows in it. So little crosses the network,
   however many rows there are, and it holds all that can be in the result.
3. What is sent on is packed into one key of bytes whose order is (anchor, descending
   score, positives before negatives, id). ``repartitionAndSortWithinPartitions`` deals
   the keys by anchor and sorts them.
4. An iterator streams over the sorted keys. A positive opens its window, a negative is
   emitted for every open window it lies in, and a window ends with its last negative or
   once scores are below it. It holds ``positives`` windows, never an anchor's rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import Scratch

#: Bytes of a slice's vectors and of a block's, anchors scored at a time, least rows of either.
SLICE_BYTES, BLOCK_BYTES, SIDE, FEW = 4 << 20, 4 << 20, 128, 64

#: anchor id, anchor content, score (complemented), kind, id, content; integers with the sign bit turned.
KEY = ">QQQBQQ"
_KEY = np.dtype([("anchor", ">u8"), ("a", ">u8"), ("score", ">u8"), ("kind", "u1"), ("id", ">u8"), ("c", ">u8")])
POSITIVE, NEGATIVE = 0, 1
SIGN = 1 << 63


def turned(x: np.ndarray) -> np.ndarray:
    """Signed integers as unsigned ones of the same order."""
    return x.astype(np.int64).view(np.uint64) ^ np.uint64(SIGN)


def pack(kind: int, anchor: np.ndarray, a: np.ndarray, score: np.ndarray, ids: np.ndarray, content: np.ndarray) -> pa.Table:
    keys = np.zeros(len(ids), _KEY)
    keys["anchor"], keys["a"], keys["score"], keys["kind"] = turned(anchor), turned(a), ~turned(score), kind
    keys["id"], keys["c"] = turned(ids), turned(content)
    at = np.arange(len(ids) + 1, dtype=np.int32) * _KEY.itemsize
    return pa.table({"key": pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(at), pa.py_buffer(keys.tobytes())])})


def unpack(key: bytes) -> tuple[int, int, int, int]:
    """(anchor id, score, kind, id)."""
    anchor, _, score, kind, other, _ = struct.unpack(KEY, key)
    back = lambda x: x - SIGN
    return back(anchor), back(score ^ 0xFFFFFFFFFFFFFFFF), kind, back(other)


def matrix(t: pa.Table, width: int) -> np.ndarray:
    return t.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, width)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in doubles while no sum can pass 2**53, in 64-bit
    integers while a hundredfold can't pass 2**63, else in Python's integers."""
    most = lambda x: int(max(x.max(initial=0), -int(x.min(initial=0))))
    bound = most(a) * most(b) * max(1, a.shape[1])
    if bound < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T if 100 * bound < 1 << 63 else a.astype(object) @ b.T.astype(object)


def best(score: np.ndarray, at: np.ndarray, most: int) -> np.ndarray:
    """Those of ``at`` with the ``most`` highest scores, ties by place."""
    s = score[at]
    if len(s) > most:
        floor = -np.partition(-s, most - 1)[most - 1]
        at = at[s >= floor]
        at = at[np.argsort(-score[at], kind="stable")][:most]
    return at


def scored(rows: pa.Table, anchors: pa.Table, choose) -> list[tuple]:
    """(anchor id, anchor content, scores, ids, contents) of the rows that ``choose`` takes of each anchor;
    vectors of different length aren't compared."""
    rows = rows.sort_by([("id", "ascending"), ("content", "ascending")])
    out = []
    for width in sorted(set(anchors.column("width").to_pylist())):
        r, a = (t.filter(pa.compute.equal(t.column("width"), width)) for t in (rows, anchors))
        if not r.num_rows:
            continue
        ids, content, label = (r.column(c).to_numpy() for c in ("id", "content", "label"))
        vecs = matrix(r, width)
        for k in range(0, a.num_rows, SIDE):
            part = a.slice(k, SIDE)
            score = products(matrix(part, width), vecs)
            more = part.column("windows").to_pylist() if "windows" in part.column_names else [None] * part.num_rows
            for row, i, c, own, w in zip(score, *(part.column(x).to_pylist() for x in ("id", "content", "label")), more, strict=True):
                at = choose(row, own == label, ids != i, w)
                out.append((i, c, row[at], ids[at], content[at]))
    return out


def as_keys(found: list[tuple], kind: int) -> pa.Table:
    each = [len(f[2]) for f in found]
    cat = lambda k: np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64)
    return pack(kind, np.repeat(np.array([f[0] for f in found], np.int64), each),
                np.repeat(np.array([f[1] for f in found], np.int64), each), cat(2), cat(3), cat(4))


def sorted_keys(keys: DataFrame, partitions: int):
    """The secondary sort: dealt by anchor, in the order of the whole key."""
    return (keys.rdd.map(lambda r: (bytes(r[0]), None))
            .repartitionAndSortWithinPartitions(partitions, lambda k: zlib.crc32(k[:16])))


def first_positives(most: int):
    def stream(keys: Iterator[tuple[bytes, None]]) -> Iterator[tuple]:
        anchor, seen = b"", 0
        for key, _ in keys:
            if key[:16] != anchor:
                anchor, seen = key[:16], 0
            if seen < most:
                seen += 1
                _, score, _, _ = unpack(key)
                yield key, unpack(key)[0], struct.unpack(">Q", key[8:16])[0] - SIGN, score
    return stream


def emit(low: int, high: int, positives: int, negatives: int):
    def stream(keys: Iterator[tuple[bytes, None]]) -> Iterator[tuple]:
        anchor, opened, windows = b"", 0, []
        for key, _ in keys:
            if key[:16] != anchor:
                anchor, opened, windows = key[:16], 0, []
            a, score, kind, other = unpack(key)
            if kind == POSITIVE:
                if opened < positives:
                    opened += 1
                    windows.append([other, score, 0])
                continue
            for w in windows:
                if low * w[1] <= 100 * score <= high * w[1]:
                    w[2] += 1
                    yield a, w[0], w[2], other, w[1], score
            windows = [w for w in windows if w[2] < negatives and low * w[1] <= 100 * score]
    return stream


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
         id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(anchor, positive, rank, negative, positive_score, negative_score): for each anchor and
    each of its first ``positives`` other rows of the same label, the first ``negatives`` rows
    of other labels with low * positive_score <= 100 * negative_score <= high * positive_score.

    Scores are integer inner products of the components' floor(256 * x); higher ones come
    first, ties by smaller id. A score or component that doesn't fit a long fails the job.
    Rows with a null id, label or vector, or a null or non-finite component take no part.
    Equal rows count once. Rows that share an id but differ all take part, each an anchor of its own if
    chosen, never another's positive or negative. Vectors of different length aren't compared.
    No anchor, no positive or no row in a window: no rows. Ids are integers; columns beside
    the three and those that ``is_anchor`` names aren't read.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark, "hardneg")
    x = rows.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{label_col}`").alias("_l"),
                    F.col(f"`{vec_col}`").alias("_v"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    odd = F.exists("_v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    x = x.where(F.col("id").isNotNull() & F.col("_l").isNotNull() & F.col("_v").isNotNull() & ~odd)
    x = x.select("id", F.xxhash64("_l").alias("label"), F.transform("_v", lambda c: F.floor(256 * c.cast("double"))).alias("vec"), "anchor")
    x = x.distinct().withColumns({"content": F.xxhash64("label", "vec"), "width": F.size("vec")})
    x = scratch.keep(x, "rows")
    n, chosen, width = x.agg(F.count(F.lit(1)), F.count_if("anchor"), F.max("width")).first()
    result = "anchor long, positive long, rank int, negative long, positive_score long, negative_score long"
    if not chosen:
        return spark.createDataFrame([], result)
    per = lambda size: max(FEW, size // (8 * max(1, width)))
    blocks, slices = -(-chosen // per(BLOCK_BYTES)), -(-n // per(SLICE_BYTES))
    partitions = max(1, min(blocks * slices, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    dealt = lambda seed, k: F.pmod(F.xxhash64("id", "content", F.lit(seed)), F.lit(k))
    every = lambda k: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(k - 1).cast("bigint")))
    right = x.withColumn("slice", dealt(1, slices)).withColumn("block", every(blocks))
    anchors = scratch.again(x).where("anchor")

    def meet(left: DataFrame, choose, kind: int) -> DataFrame:
        own = left.withColumn("block", dealt(2, blocks)).withColumn("slice", every(slices))
        return right.groupBy("block", "slice").cogroup(own.groupBy("block", "slice")).applyInArrow(
            lambda r, a: as_keys(scored(r, a, choose), kind), "key binary")

    def same_label(score, same, other, _):
        return best(score, np.flatnonzero(same & other), positives)

    def in_windows(score, same, other, tops):
        free, hundred = ~same & other, 100 * score
        found = [best(score, np.flatnonzero(free & (low * p <= hundred) & (hundred <= high * p)), negatives) for p in set(tops)]
        return np.unique(np.concatenate(found))

    firsts = sorted_keys(meet(anchors, same_label, POSITIVE), partitions).mapPartitions(first_positives(positives))
    firsts = scratch.keep(spark.createDataFrame(firsts, "key binary, id long, content long, score long", verifySchema=False), "positives")
    tops = firsts.groupBy("id", "content").agg(F.collect_list("score").alias("windows"))
    keys = meet(anchors.join(tops, ["id", "content"]), in_windows, NEGATIVE).union(firsts.select("key"))
    out = sorted_keys(keys, partitions).mapPartitions(emit(low, high, positives, negatives))
    return spark.createDataFrame(out, result, verifySchema=False)


ORACLE = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM r a JOIN r b ON b.vec_id <> a.vec_id AND len(b.v) = len(a.v) WHERE a.vec_id % 100 = 0),
p AS (
  SELECT * FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, p.other AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY n.score DESC, n.other) AS INTEGER) AS rank,
       n.other AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY rank <= 10
"""
