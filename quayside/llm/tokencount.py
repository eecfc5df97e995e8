"""Token counts by byte-pair merging with a heap and a linked list; no ids are made.

Spark partitions the documents; a task cuts its texts into the pattern's matches and
counts each distinct one once. A match begins as its bytes in a linked list, its adjacent
pairs that merge wait in a heap by (rank, position). The least is popped again and again:
if both its ends still stand as they did, they become one symbol, and the pairs with the
new neighbours are pushed. A match has as many tokens as it had bytes, less its merges.

Two bytes that follow each other inside no token of the vocabulary are never merged over,
whatever stands around them, so a match is cut there first: the parts count by themselves.
That keeps long unbroken matches (base64, text without spaces) in short, often equal parts.
Nothing is shuffled; the work is n log n in the longest part.
"""

from __future__ import annotations

import heapq
import json
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.common import per_batch, pick

OTHER, LETTER, NUMBER, WHITE = range(4)
#: Parts a Python worker remembers, and the longest it does.
REMEMBERED, SHORT = 400_000, 32


@cache
def character_classes() -> bytes:
    """A byte for each code point: its class as the library's own pattern engine, whose
    Unicode version is the library's, sees it in a text of all code points."""
    from tokenizers import Regex, pre_tokenizers

    points = np.array([c for c in range(0x110000) if not 0xD800 <= c < 0xE000])
    every = "".join(map(chr, points.tolist()))
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (WHITE, r"\s+")):
        found = np.ones(len(points), bool)
        for _, (a, b) in pre_tokenizers.Split(Regex(pattern), "removed").pre_tokenize_str(every):
            found[a:b] = False  # what stands between the matches
        out[points[found]] = kind
    return out.tobytes()


def match_heads(cp: np.ndarray, cls: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Which code points begin a match, for texts that begin at ``bounds``: contractions
    ('s 't 're 've 'm 'll 'd), then runs of one class with a space before them if there
    is one; of white space with something after it, the last character stays apart."""
    n = len(cp)
    begins = np.zeros(n + 1, bool)
    begins[bounds] = True
    inside = ~begins[1:n]  # position k + 1 goes on the text of position k
    head = begins[:n].copy()
    head[1:] |= cls[1:] != cls[:-1]
    ends_white = np.flatnonzero((cls[:-1] == WHITE) & (cls[1:] != WHITE) & inside)
    head[ends_white] = True
    head[ends_white[cp[ends_white] == 0x20] + 1] = False
    marks = np.flatnonzero((cp == 0x27) & head)
    text = np.searchsorted(bounds, marks, side="right")
    end = np.append(bounds, n)[text]
    get = lambda k: np.where(marks + k < end, cp[np.minimum(marks + k, n - 1)], 0)
    one, two = get(1), get(2)
    long = np.isin(one * 0x10000 + two, [ord(a) * 0x10000 + ord(b) for a, b in ("re", "ve", "ll")])
    short = np.isin(one, [ord(c) for c in "stmd"])
    for which, size in ((short, 2), (long, 3)):
        head[marks[which] + 1] = False
        after = marks[which] + size
        after = after[after < n]
        head[after] = True
    return head


class Counter:
    """The merges of one tokenizer file and the counts of the parts met so far."""

    def __init__(self, content: bytes, classes: bytes):
        spec = json.loads(content)
        check(spec)
        to_byte = {c: b for b, c in byte_letters().items()}
        vocab, self.pairs = spec["model"]["vocab"], {}
        self.joins = np.zeros((256, 256), bool)
        self.byte = [vocab.get(c, -1) for c in byte_letters().values()]
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.pairs.setdefault((vocab[a] << 32) | vocab[b], (rank << 32) | vocab[a + b])
            token = np.array([to_byte[c] for c in a + b])
            self.joins[token[:-1], token[1:]] = True
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.classes = np.frombuffer(classes, np.uint8)
        self.known: dict[bytes, int] = {}

    def merges(self, part: bytes) -> int:
        """How many merges the bytes of ``part`` undergo."""
        n, pairs, push, pop = len(part), self.pairs, heapq.heappush, heapq.heappop
        symbol = [self.byte[c] for c in part]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m >> 32 << 32) | k for k in range(n - 1) if (m := pairs.get((symbol[k] << 32) | symbol[k + 1])) is not None]
        heapq.heapify(heap)
        done = 0
        while heap:
            least = pop(heap)
            k = least & 0xFFFFFFFF
            j = after[k]
            if symbol[k] < 0 or j >= n:
                continue
            met = pairs.get((symbol[k] << 32) | symbol[j])
            if met is None or met >> 32 != least >> 32:  # an end has become another symbol since
                continue
            symbol[k], symbol[j] = met & 0xFFFFFFFF, -1
            after[k] = far = after[j]
            done += 1
            if far < n:
                before[far] = k
                if (m := pairs.get((symbol[k] << 32) | symbol[far])) is not None:
                    push(heap, (m >> 32 << 32) | k)
            if (near := before[k]) >= 0 and (m := pairs.get((symbol[near] << 32) | symbol[k])) is not None:
                push(heap, (m >> 32 << 32) | near)
        return done

    def tokens(self, part: bytes) -> int:
        if len(part) == 1:
            return 1
        found = self.known.get(part)
        if found is None:
            found = len(part) - self.merges(part)
            if len(self.known) < REMEMBERED and len(part) <= SHORT:
                self.known[part] = found
        return found

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text; a special string is one token and parts its text."""
        pieces, owner, extra = [], [], np.zeros(len(texts), np.int64)
        for k, t in enumerate(texts):
            own = self.special.split(t) if self.special else [t]
            extra[k] = len(own) - 1
            pieces += own
            owner += [k] * len(own)
        one = "".join(pieces)
        if not one:
            return extra
        sizes = np.array([len(p) for p in pieces], np.int64)
        starts = np.cumsum(sizes) - sizes
        cp = np.frombuffer(one.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        head = match_heads(cp, self.classes[cp], np.unique(starts[sizes > 0]))
        width = 1 + (cp > 0x7F).astype(np.int8) + (cp > 0x7FF) + (cp > 0xFFFF)
        at = np.concatenate([[0], np.cumsum(width, dtype=np.int64)])
        raw = one.encode()
        data = np.frombuffer(raw, np.uint8)
        cut = np.zeros(len(data) + 1, bool)
        cut[at[:-1][head]] = True
        cut[1:-1] |= ~self.joins[data[:-1], data[1:]]
        cut[-1] = True
        begin = np.flatnonzero(cut)
        parts = pa.Array.from_buffers(pa.binary(), len(begin) - 1, [None, pa.py_buffer(begin.astype(np.int32)), pa.py_buffer(raw)])
        coded = parts.dictionary_encode()
        each = np.array([self.tokens(p) for p in coded.dictionary.to_pylist()], np.int64)[coded.indices.to_numpy()]
        total = np.concatenate([[0], np.cumsum(each)])
        from_, to = (np.searchsorted(begin, at[x]) for x in (starts, starts + sizes))
        return extra + np.bincount(owner, weights=total[to] - total[from_], minlength=len(texts)).astype(np.int64)


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in the file: itself if it is
    printable Latin-1, else the next free one from 256."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)}


def check(spec: dict) -> None:
    """Refuse files whose counts would need more than the merges of bytes."""
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (model.get("type") == "BPE" and not any(model.get(k) for k in (
        "dropout", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges"))
        and spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
        and not pre.get("add_prefix_space") and not any(
            t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"])
        and all(c in model["vocab"] for c in byte_letters().values()))
    if not plain:
        raise ValueError("only byte-level BPE without a normalizer, prefixes, suffixes or stripping special tokens")


#: One counter a Python worker and file, so that parts stay known from task to task.
_COUNTERS: dict[int, Counter] = {}


def counter(content: bytes, classes: bytes) -> Counter:
    key = hash(content)
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = Counter(content, classes)
    return _COUNTERS[key]


def count_tokens(docs: DataFrame, tokenizer: bytes, limit: int = 512, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row: UTF-8 bytes and tokens of the whole
    text, and whether it has more than ``limit``.

    ``tokenizer`` is the content of a byte-level BPE file (some megabytes), which is
    broadcast. A null or empty text has no bytes and no tokens; repeated rows and rows with
    null ids are counted each; an empty table gives no rows; other columns aren't read.
    """
    rows = pick(docs, id=id_col, text=text_col)
    schema = T.StructType([rows.schema["id"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    sent = docs.sparkSession.sparkContext.broadcast((tokenizer, character_classes()))

    def work():
        tool = counter(*sent.value)

        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            size = pc.fill_null(pc.binary_length(b.column(1)), 0).cast(pa.int64())
            found = tool.count([t or "" for t in b.column(1).to_pylist()])
            return pa.RecordBatch.from_arrays([b.column(0), size, pa.array(found)], names=["id", "n_bytes", "n_tokens"])
        return step

    return per_batch(rows, work, schema, text_at=1).withColumn("over_limit", F.col("n_tokens") > limit)
