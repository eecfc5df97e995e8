"""Byte-level BPE encoding and decoding with DuckDB recursive queries inside tasks.

Spark partitions the documents; each task splits its texts into the pattern's
matches, takes the distinct ones it hasn't encoded yet (a bounded memory of
frequent ones outlives a batch) and hands them to DuckDB as one row per token
position. A recursive query joins neighbouring positions with the merge table
and contracts every word's leftmost pair of least rank, all words at once, until
no pair is left. Decoding joins the ids with the vocabulary and aggregates the
bytes in the order of their positions. Nothing is shuffled.

Words over ``LONG`` bytes take a second form of the query that contracts all
occurrences of the least pair in one round where that is the same as one after
the other: the merged token is *settled*, that is no token that extends it by a
neighbour has a smaller rank. Both forms run ``ROUNDS`` rounds at a time, which
bounds the rows that a recursive query holds.
"""

from __future__ import annotations

import base64

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.common import per_batch, pick

LONG = 96
ROUNDS = 48
#: Bytes of the words of one query, and the words remembered in a Python worker.
QUERY_BYTES, REMEMBERED = 100_000, 150_000

STEP = """
WITH RECURSIVE t AS (
  SELECT w, pos, id, lead(id) OVER (PARTITION BY w ORDER BY pos) AS next_id,
         lead(pos) OVER (PARTITION BY w ORDER BY pos) AS next_pos, 0 AS k FROM start
  UNION ALL
  (WITH best AS (
     SELECT t.w, min((m.merged::BIGINT << 32) | t.pos) AS b, arg_min(t.next_pos, (m.merged::BIGINT << 32) | t.pos) AS gone
     FROM t JOIN merges m ON m.pair = (t.id::BIGINT << 32) | t.next_id WHERE t.k < {rounds} GROUP BY t.w),
   pick AS (
     SELECT best.w, (b & 4294967295)::INT AS spot, (b >> 32)::INT AS merged, gone, t.next_id AS far_id, t.next_pos AS far_pos
     FROM best JOIN t ON t.w = best.w AND t.pos = best.gone)
   SELECT t.w, t.pos, CASE WHEN t.pos = spot THEN merged ELSE t.id END,
          CASE WHEN t.pos = spot THEN far_id WHEN t.next_pos = spot THEN merged ELSE t.next_id END,
          CASE WHEN t.pos = spot THEN far_pos ELSE t.next_pos END, t.k + 1
   FROM t JOIN pick ON t.w = pick.w WHERE t.pos <> gone)
)"""

LONG_STEP = """
WITH RECURSIVE t AS (
  SELECT w, pos, id, 0 AS k FROM start
  UNION ALL
  (WITH pairs AS (SELECT w, pos, id, k, lead(id) OVER (PARTITION BY w ORDER BY pos) AS next_id FROM t WHERE k < {rounds}),
   ranked AS (SELECT p.*, m.merged, m.settled FROM pairs p LEFT JOIN merges m ON m.pair = (p.id::BIGINT << 32) | p.next_id),
   best AS (SELECT w, min(merged) AS least, arg_min(pos, (merged::BIGINT << 32) | pos) AS spot
            FROM ranked WHERE merged IS NOT NULL GROUP BY w),
   marked AS (SELECT r.*, least, spot, coalesce(merged = least, false) AS met FROM ranked r JOIN best ON best.w = r.w),
   runs AS (SELECT *, sum(CASE WHEN met THEN 0 ELSE 1 END) OVER (PARTITION BY w ORDER BY pos ROWS UNBOUNDED PRECEDING) AS run FROM marked),
   hits AS (SELECT *, met AND CASE WHEN settled THEN row_number() OVER (PARTITION BY w, run, met ORDER BY pos) % 2 = 1
                                   ELSE pos = spot END AS hit FROM runs),
   gone AS (SELECT *, coalesce(lag(hit) OVER (PARTITION BY w ORDER BY pos), false) AS out FROM hits)
   SELECT w, pos, CASE WHEN hit THEN least ELSE id END, k + 1 FROM gone WHERE NOT out)
)"""
LAST = " SELECT w, pos, id, k FROM t SEMI JOIN (SELECT w, max(k) AS k FROM t GROUP BY w) USING (w, k) ORDER BY w, pos"


def read_ranks(content: bytes) -> dict[bytes, int]:
    """A rank file: base64 token and rank on each line."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}


#: Classes of code points: 0 other, 1 letter, 2 number, 3 white space.
_CLASSES: list[np.ndarray] = []


def classes() -> np.ndarray:
    if not _CLASSES:
        out = np.zeros(0x110000, dtype=np.uint8)
        every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
        for k, pattern in ((1, r"\p{L}"), (2, r"\p{N}"), (3, r"\s")):
            found = "".join(regex.findall(pattern, every))
            out[np.frombuffer(found.encode("utf-32-le"), "<u4")] = k
        _CLASSES.append(out)
    return _CLASSES[0]


def split(texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """(UTF-8 of all texts, byte offsets of the matches and the end, matches per text).

    The matches are those of the pattern of the rank files: contractions
    ('s 't 're 've 'm 'll 'd), runs of letters, of numbers and of other characters,
    each with one space before it if there is one, and white space, of which a run's
    last character stays apart if anything follows.
    """
    one = "".join(texts)
    raw = one.encode()
    lens = np.array([len(t) for t in texts], dtype=np.int64)
    bounds = np.concatenate([[0], np.cumsum(lens)])
    cp = np.frombuffer(one.encode("utf-32-le"), "<u4")
    n = len(cp)
    if not n:
        return raw, np.zeros(1, dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
    cls = classes()[cp]
    first = np.zeros(n + 1, dtype=bool)
    first[bounds] = True  # a text's first character (and the end)
    head = first.copy()
    head[1:n] |= cls[1:] != cls[:-1]
    white = cls == 3
    # the last white-space character of a run with something after it is cut off; a space joins what follows
    last = np.flatnonzero(white[:-1] & ~white[1:] & ~first[1:n])
    head[last] = True
    head[last[cp[last] == 32] + 1] = False
    # contractions: an apostrophe that begins a match and has letters after it
    quote = np.flatnonzero((cp == 39) & head[:n])
    quote = quote[quote + 1 < n]
    quote = quote[(cls[quote + 1] == 1) & ~first[quote + 1]]
    after = np.where(first[np.minimum(quote + 2, n)], 0, cp[np.minimum(quote + 2, n - 1)])
    now = cp[quote + 1]
    two = ((now == 114) & (after == 101)) | ((now == 118) & (after == 101)) | ((now == 108) & (after == 108))
    short = np.isin(now, (115, 116, 109, 100))
    head[quote[two | short] + 1] = False
    head[quote[short] + 2] = True
    head[quote[two] + 3] = True
    at = np.flatnonzero(head)  # ends with n
    per_text = np.diff(np.searchsorted(at, bounds))
    width = 1 + (cp > 0x7F) + (cp > 0x7FF) + (cp > 0xFFFF)
    byte_at = np.concatenate([[0], np.cumsum(width, dtype=np.int64)])
    return raw, byte_at[at], per_text


class Codec:
    """Encoder and decoder of one rank file, with its own DuckDB connection."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        left, right, merged = [], [], []
        unsettled = set()
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
                    unsettled.update(c for c in (a, b) if c > rank)
        pair = (np.array(left, dtype=np.int64) << 32) | np.array(right, dtype=np.int64)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        self.put("m", pair=pair, merged=np.array(merged, np.int32), settled=np.array([c not in unsettled for c in merged], bool))
        self.db.execute("CREATE TABLE merges AS SELECT * FROM m")
        self.put("v", id=np.array(list(ranks.values()), np.int32), hex=pa.array([t.hex() for t in ranks]))
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM v")
        self.byte = np.array([ranks.get(bytes([c]), -1) for c in range(256)], dtype=np.int32)
        self.known: dict[bytes, tuple[bytes, bytes]] = {}

    def put(self, name: str, **columns) -> None:
        self.db.register(name, pa.table(columns))

    def contract(self, words: list[bytes], query: str) -> list[np.ndarray]:
        """Ids of words that aren't tokens themselves."""
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(words)
        size = np.array([len(w) for w in words])
        raw = np.frombuffer(b"".join(words), np.uint8)
        w = np.repeat(np.arange(len(words), dtype=np.int32), size)
        pos = (np.arange(len(raw)) - np.repeat(np.cumsum(size) - size, size)).astype(np.int32)
        ids = self.byte[raw]
        while len(w):
            self.put("start", w=w, pos=pos, id=ids)
            got = self.db.sql(query.format(rounds=ROUNDS) + LAST).to_arrow_table()
            w, pos, ids, k = (got.column(c).to_numpy() for c in ("w", "pos", "id", "k"))
            done = k < ROUNDS
            edge = np.flatnonzero(np.diff(w[done], prepend=-1))
            for word, part in zip(w[done][edge], np.split(ids[done], edge)[1:], strict=True):
                out[word] = part
            w, pos, ids = w[~done], pos[~done], ids[~done]
        return out

    def encode_words(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each (distinct) word: its own rank if it is a token, else by contraction."""
        out: list[np.ndarray | None] = []
        rest: dict[str, list[int]] = {STEP: [], LONG_STEP: []}
        for k, w in enumerate(words):
            rank = self.ranks.get(w)
            out.append(None if rank is None else np.array([rank], np.int32))
            if rank is None:
                rest[STEP if len(w) <= LONG else LONG_STEP].append(k)
        for query, ks in rest.items():
            block, size = [], 0
            for k in [*ks, None]:
                if block and (k is None or size + len(words[k]) > QUERY_BYTES):
                    for i, ids in zip(block, self.contract([words[i] for i in block], query), strict=True):
                        out[i] = ids
                    block, size = [], 0
                if k is not None:
                    block.append(k)
                    size += len(words[k])
        return out

    def decode_lists(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes | None]:
        """Bytes of lists of ids (all lists' ids, their lengths); None for a list with an unknown id."""
        out: list[bytes | None] = []
        ends = np.cumsum(counts)
        k = 0
        while k < len(counts):  # about a million ids a query, a longer list alone
            begin = int(ends[k] - counts[k])
            stop = max(k + 1, int(np.searchsorted(ends, begin + (1 << 20), side="right")))
            part, n = ids[begin:int(ends[stop - 1])], counts[k:stop]
            w = np.repeat(np.arange(len(n), dtype=np.int32), n)
            self.put("tokens", w=w, pos=np.arange(len(part), dtype=np.int64), id=part)
            got = self.db.sql("""
                SELECT w, CASE WHEN count(hex) = count(*) THEN string_agg(hex, '' ORDER BY pos) END AS h
                FROM tokens LEFT JOIN vocabulary USING (id) GROUP BY w""").to_arrow_table()
            texts: list[bytes | None] = [b""] * len(n)
            for at, h in zip(got.column("w").to_pylist(), got.column("h").to_pylist(), strict=True):
                texts[at] = None if h is None else bytes.fromhex(h)
            out += texts
            k = stop
        return out

    def pairs(self, words: list[bytes]) -> list[tuple[bytes, bytes | None]]:
        """(ids as int32 in bytes, the bytes they decode to) of distinct words; the first ``REMEMBERED``
        words that this worker meets, the frequent ones among them, are worked out once."""
        out = [self.known.get(w) for w in words]
        new = [k for k, p in enumerate(out) if p is None]
        if new:
            ids = self.encode_words([words[k] for k in new])
            back = self.decode_lists(np.concatenate(ids), np.array([len(x) for x in ids], dtype=np.int64))
            for k, i, b in zip(new, ids, back, strict=True):
                out[k] = (i.tobytes(), b)
                if len(self.known) < REMEMBERED and len(words[k]) <= LONG:
                    self.known[words[k]] = out[k]
        return out

    def round_trip(self, texts: list[str]) -> tuple[pa.Array, pa.Array]:
        """(ids, decoded bytes) per text. Equal words of the batch are encoded, and
        their ids decoded, once; a text's ids and bytes are its words', in order."""
        raw, at, per_text = split(texts)
        begin, size = at[:-1], np.diff(at)
        code, words = distinct(raw, begin, size)
        pool = self.pairs(words)
        n_ids = np.array([len(p) // 4 for p, _ in pool], dtype=np.int64)
        flat = np.frombuffer(b"".join([p for p, _ in pool]), np.int32)
        back = pa.array([b for _, b in pool], pa.large_binary())
        lists = pa.LargeListArray.from_arrays(np.concatenate([[0], np.cumsum(n_ids)]), pa.array(flat, pa.int32()))
        code = pa.array(code)
        texts_at = np.concatenate([[0], np.cumsum(per_text)])
        ids, decoded = lists.take(code), back.take(code)
        id_at, byte_at = (np.frombuffer(x.buffers()[1], np.int64)[x.offset:x.offset + len(x) + 1][texts_at] for x in (ids, decoded)) \
            if len(code) else (np.zeros(len(texts) + 1, np.int64),) * 2
        values = ids.values if len(code) else pa.array([], pa.int32())
        data = decoded.buffers()[2] if len(code) else pa.py_buffer(b"")
        return (pa.ListArray.from_arrays(pa.array(id_at, pa.int32()), values),
                pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(id_at_bytes(byte_at)), data]))


def id_at_bytes(offsets: np.ndarray) -> bytes:
    return offsets.astype(np.int32).tobytes()


def distinct(raw: bytes, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """(number of each match's word, the distinct words) by 64-bit hashes of the
    matches, compared byte by byte with the word they were taken for."""
    if not len(begin):
        return np.zeros(0, np.int32), []
    data = np.frombuffer(raw, np.uint8)
    base, table = np.uint64(0x9E3779B97F4A7C15), np.random.default_rng(3).integers(1, 1 << 63, 256, dtype=np.uint64)
    power = np.full(len(data) + 1, base, dtype=np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    total = np.concatenate([[np.uint64(0)], np.cumsum(table[data] * power[:-1], dtype=np.uint64)])
    h = (total[begin + size] - total[begin]) * power[len(data) - begin] + size.astype(np.uint64)
    coded = pa.array(h).dictionary_encode()
    code = coded.indices.to_numpy()
    rep = np.zeros(len(coded.dictionary), dtype=np.int64)
    rep[code[::-1]] = np.arange(len(code))[::-1]  # first match of each word
    same = size == size[rep[code]]
    if same.all():
        shift = np.repeat(begin[rep[code]] - begin, size)
        at = np.arange(int(begin[0]), int(begin[-1] + size[-1]))
        same = np.array([(data[at] == data[at + shift]).all()])
    if same.all():
        return code, [raw[b:b + s] for b, s in zip(begin[rep].tolist(), size[rep].tolist(), strict=True)]
    seen: dict[bytes, int] = {}  # two words share a hash: go by the words themselves
    code = np.array([seen.setdefault(raw[b:b + s], len(seen)) for b, s in zip(begin.tolist(), size.tolist(), strict=True)])
    return code.astype(np.int32), list(seen)


#: One codec a Python worker and rank file, so that words stay known from task to task.
_CODECS: dict[int, Codec] = {}


def codec(content: bytes) -> Codec:
    key = hash(content)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(read_ranks(content))
    return _CODECS[key]


def encode(docs: DataFrame, rank_file: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>, decoded binary) for every row: the token ids of the whole
    text and the bytes those ids decode to. A null text counts as empty: no ids,
    no bytes. Special tokens are ordinary text.

    ``rank_file`` is the content of a rank file (under a megabyte): it is broadcast,
    so executors need no copy of the file.
    """
    rows = pick(docs, id=id_col, text=text_col)
    schema = T.StructType([rows.schema["id"], T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("decoded", T.BinaryType())])
    sent = docs.sparkSession.sparkContext.broadcast(rank_file)

    def work():
        tool = codec(sent.value)

        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            ids, decoded = tool.round_trip([t or "" for t in b.column(1).to_pylist()])
            return pa.RecordBatch.from_arrays([b.column(0), ids, decoded], names=["id", "ids", "decoded"])
        return step

    return per_batch(rows, work, schema, text_at=1)


def decode(tokens: DataFrame, rank_file: bytes, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded binary) of lists of ids. A null list decodes to no bytes, a
    list with an id that isn't in the vocabulary (or null) to null."""
    rows = pick(tokens, id=id_col, ids=ids_col).select("id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    schema = T.StructType([rows.schema["id"], T.StructField("decoded", T.BinaryType())])
    sent = tokens.sparkSession.sparkContext.broadcast(rank_file)

    def work():
        tool = codec(sent.value)

        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            ids = b.column(1)
            counts = pc.list_value_length(ids).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = pc.fill_null(ids.flatten(), -1).to_numpy(zero_copy_only=False).astype(np.int32)
            return pa.RecordBatch.from_arrays([b.column(0), pa.array(tool.decode_lists(flat, counts), pa.binary())],
                                              names=["id", "decoded"])
        return step

    return per_batch(rows, work, schema)


def digests(encoded: DataFrame) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of :func:`encode`'s rows."""
    return encoded.select("id", F.size("ids").cast("bigint").alias("n_tokens"),
                          F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))
