"""Periodic runs of words from the maximal pairs of an LCP-interval tree.

Spark partitions the documents; a task works on about a megabyte of text at a time, all its
documents together, their words numbered. Nothing is shuffled.

1. The suffixes that share words are ordered by prefix doubling (each round only those not
   told apart yet), and the rounds' ranks give the LCP of neighbours. A document's words
   are its own symbols, so no interval crosses two documents.
2. The LCP intervals are walked bottom-up. An interval keeps the starts of its repeated
   string in text order, each with its class, the word to its left. When two children of
   an interval of depth l meet, starts of different classes are maximal pairs: neither
   side can be extended.
3. A maximal pair (x, x + p) with p <= l is the run of period p that begins at x and has
   l + p words; nothing is extended or checked. Of the pairs with equal begin and length
   the least distance is the run's smallest period (the others are its multiples).

Starts within l of each other overlap or touch, so there they lie p apart, p being the
string's period: all but the first have one class, and all but the last are followed by
one word and lie in one child. Hence a start can pair with the farthest start within l on
each side only. The smaller child looks those up in the larger, which then takes it in: n
log n steps, whatever the number of classes or copies, and never the pairs of an interval.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.common import per_batch, pick

#: A run has this many words or more.
LEAST_WORDS = 12
RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
_RUN = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True


def words_of(texts: list[bytes]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(number of each word's text, the distinct texts, index of each document's first word and the end)."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    white = _WHITE[data]
    edge = np.flatnonzero(np.diff(white, prepend=True))
    begin, end = edge[::2], edge[1::2]
    at = np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int32)
    words = pa.Array.from_buffers(pa.string(), len(begin), [None, pa.py_buffer(at), pa.py_buffer(data[~white])])
    coded = words.dictionary_encode()
    starts = np.cumsum([0] + [len(t) + 1 for t in texts])
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary, np.searchsorted(begin, starts)


def suffixes(symbol: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(begins of suffixes in an order where equal beginnings are neighbours, common symbols
    of each with the one before), for suffixes that share ``least`` symbols with another;
    the number is 0 where it is below ``least``. Numbers of symbols stand for their order."""
    n = len(symbol)
    order = np.argsort(symbol, kind="stable")
    rank = np.zeros(n, np.int64)
    slots, new = np.arange(n), np.diff(symbol[order], prepend=-1) != 0
    levels, h = [], 1
    while True:
        first = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        rank[order[slots]] = first
        levels.append(rank.astype(np.int32))
        alone = new & np.append(new[1:], True)
        slots, first = slots[~alone], first[~alone]
        if h <= least:
            kept = slots  # those that share h symbols
        if not len(slots):
            break
        at = order[slots]
        ahead = at + h
        key = first * (n + 1) + np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        by = np.argsort(key, kind="stable")
        order[slots], key = at[by], key[by]
        new = np.diff(key, prepend=-1) != 0
        h *= 2
    at = order[kept]
    common = np.zeros(len(at), np.int64)
    x, y = at[:-1], at[1:]
    for k in range(len(levels) - 1, -1, -1):
        a, b = x + common[1:], y + common[1:]
        same = (np.maximum(a, b) < n) & (levels[k][np.minimum(a, n - 1)] == levels[k][np.minimum(b, n - 1)])
        common[1:][same] += 1 << k
    common[common < least] = 0
    return at, common


def near_segments(at: np.ndarray, common: np.ndarray) -> list[tuple[list[int], list[int]]]:
    """The trees under ``common`` = 0 that can hold a pair: two begins at most as far
    apart as the longest common beginning in the tree."""
    head = np.flatnonzero(common == 0)
    if not len(head):
        return []
    tree = np.cumsum(common == 0) - 1
    by = np.lexsort((at, tree))
    gap = np.where(np.diff(tree[by], prepend=-1) == 0, np.diff(at[by], prepend=0), np.iinfo(np.int64).max)
    near = np.minimum.reduceat(gap, head) <= np.maximum.reduceat(common, head)
    end = np.append(head[1:], len(at))
    return [(at[a:b].tolist(), common[a:b].tolist()) for a, b in zip(head[near].tolist(), end[near].tolist(), strict=True)]


def maximal_pairs(at: list[int], common: list[int], left: np.ndarray, out: list[tuple[int, int, int]]) -> None:
    """Walk one tree bottom-up and append (begin, length, distance) of every maximal pair
    whose distance is at most the length of what is repeated."""

    def meet(a: list[int], b: list[int], depth: int) -> list[int]:
        small, large = (a, b) if len(a) <= len(b) else (b, a)
        for e in small:
            k = bisect_left(large, e - depth)
            if k < len(large) and (x := large[k]) < e and left[x] != left[e]:
                out.append((x, depth + e - x, e - x))
            k = bisect_right(large, e + depth) - 1
            if k >= 0 and (y := large[k]) > e and left[y] != left[e]:
                out.append((e, depth + y - e, y - e))
        if small[0] > large[-1]:
            large += small
        elif len(small) * 8 > len(large):
            large = sorted(large + small)
        else:
            for e in small:
                insort(large, e)
        return large

    open_: list[tuple[int, list[int]]] = []  # (depth, starts so far) of the intervals not ended
    now = [at[0]]
    for k in range(1, len(at) + 1):
        depth = common[k] if k < len(at) else 0
        while open_ and open_[-1][0] > depth:
            d, starts = open_.pop()
            now = meet(starts, now, d)
        if k == len(at):
            break
        if open_ and open_[-1][0] == depth:
            open_[-1] = (depth, meet(open_[-1][1], now, depth))
        else:
            open_.append((depth, now))
        now = [at[k]]


def all_runs(code: np.ndarray, first: np.ndarray, least: int = LEAST_WORDS) -> np.ndarray:
    """Rows (begin, length, period) of the runs of ``least`` or more words, by begin and period."""
    if len(code) < 2:
        return np.zeros((0, 3), np.int64)
    doc = np.searchsorted(first, np.arange(len(code)), side="right") - 1
    left = np.append(-1, code[:-1])
    left[first[:-1][np.diff(first) > 0]] = -1
    found: list[tuple[int, int, int]] = []
    # a repeat of l words at a distance of at most l makes a run of at most 2 l words
    for at, common in near_segments(*suffixes(doc * (int(code.max()) + 1) + code, max(1, (least + 1) // 2))):
        maximal_pairs(at, common, left, found)
    rows = np.array(found, np.int64).reshape(-1, 3)
    rows = rows[rows[:, 1] >= least]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    rows = rows[(np.diff(rows[:, 0], prepend=-1) != 0) | (np.diff(rows[:, 1], prepend=-1) != 0)]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def find_runs(docs: DataFrame, least: int = LEAST_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, runs array<struct<start, length, period>>, collapsed) of every row.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. A run is a stretch of ``least`` or
    more words, at least twice its smallest period, that can't be extended; runs are in the
    order of start and period. ``collapsed`` are the words that lie in no run after that
    run's first period, joined by one space. A null text, like one without words, has no
    words, no runs and an empty ``collapsed``. Repeated rows and rows with null ids are
    worked out each; an empty table gives no rows; other columns aren't read. A text of
    any length is worked on whole, in memory of some 4 bytes x words x log2(longest repeat).
    """
    rows = pick(docs, id=id_col, text=text_col)
    schema = T.StructType([rows.schema["id"], T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])

    def work():
        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            code, texts, first = words_of([t or b"" for t in b.column(1).cast(pa.binary()).to_pylist()])
            found = all_runs(code, first, least)
            begin, length, period = found.T
            owner = np.searchsorted(first, begin, side="right") - 1
            change = np.zeros(len(code) + 1, np.int64)
            np.add.at(change, begin + period, 1)
            np.add.at(change, begin + length, -1)
            kept = np.cumsum(change[:-1]) == 0
            kept_at = np.concatenate([[0], np.cumsum(kept)])[first]
            lists = pa.ListArray.from_arrays(pa.array(kept_at, pa.int32()), texts.take(pa.array(code[kept])))
            runs_at = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=b.num_rows))])
            runs = pa.StructArray.from_arrays([pa.array(c) for c in (begin - first[owner], length, period)], fields=list(_RUN))
            return pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.diff(first), pa.int64()), pa.ListArray.from_arrays(pa.array(runs_at, pa.int32()), runs),
                 pc.binary_join(lists, " ")], names=["id", "n_words", "runs", "collapsed"])
        return step

    return per_batch(rows, work, schema, text_at=1)


def digests(found: DataFrame) -> DataFrame:
    """(id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of
    :func:`find_runs`' rows: the longest run (ties: smallest start, then period) and digests of all."""
    most = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("shorter"))))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.select("id", F.size("runs").cast("bigint").alias("n_runs"), most.alias("m"),
                        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return rows.select("id", "n_runs", (-F.col("m.before")).alias("start"), F.col("m.length").alias("length"),
                       (-F.col("m.shorter")).alias("period"),
                       F.expr("1000 * m.length div -m.shorter").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
