"""Language identification of mixed-language text.

Words are runs of letters. Script ranges say which of the learned languages can
have written a word; character n-grams, hashed, score those. Viterbi over the
words, with a penalty for every change of language, labels spans. A document's
language is the one with the most letters.

The n-gram counts come from a bounded sample of labelled texts (about
``per_language`` documents of each language, whole texts); what reaches the
driver are a few count tables. Labelling runs in Arrow batches without a shuffle;
all documents of a batch step through Viterbi together.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.bpe import classes, distinct
from quayside.llm.common import doc_bucket, per_batch, pick, slices

BUCKETS, ORDERS = 1 << 16, (1, 2, 3, 4)
#: Weight of a word's log-likelihoods, the least log-probability of a word, the cost of changing language.
TEMPER, FLOOR, SWITCH = 0.6, -6.0, 8.0
#: A language can write a script if that holds at least this share of the sampled letters of the language.
SCRIPT_SHARE = 0.002

# First code points of Unicode blocks, each with the script of its letters up to the next.
SCRIPT_STARTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"),
    (0x0A80, "gujarati"), (0x0B00, "oriya"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"),
    (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"),
    (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"),
    (0x1780, "khmer"), (0x1800, "other"), (0x1C80, "cyrillic"), (0x1C90, "georgian"), (0x1CC0, "other"),
    (0x1D00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"),
    (0x2DE0, "cyrillic"), (0x2E00, "han"), (0x3040, "kana"), (0x3100, "han"), (0x3130, "hangul"), (0x3190, "han"),
    (0x31F0, "kana"), (0x3200, "han"), (0xA000, "other"), (0xA640, "cyrillic"), (0xA6A0, "other"), (0xA720, "latin"),
    (0xA800, "other"), (0xAC00, "hangul"), (0xD800, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB13, "other"),
    (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFE70, "arabic"), (0xFF00, "latin"), (0xFF66, "kana"),
    (0xFFA0, "hangul"), (0xFFE0, "other"), (0x1B000, "kana"), (0x1B170, "other"), (0x20000, "han")]
SCRIPTS = sorted({s for _, s in SCRIPT_STARTS})
_STARTS = np.array([a for a, _ in SCRIPT_STARTS])
_SCRIPT_OF = np.array([SCRIPTS.index(s) for _, s in SCRIPT_STARTS])


def words_of(texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
    """(number of each word's spelling, spellings, words per text, first and end
    code point of each word within its text)."""
    one = "".join(texts)
    lens = np.array([len(t) for t in texts], dtype=np.int64)
    bounds = np.concatenate([[0], np.cumsum(lens)])
    cp = np.frombuffer(one.encode("utf-32-le"), "<u4")
    letter = np.concatenate([[False], classes()[cp] == 1, [False]])
    begin, end = np.flatnonzero(~letter[:-1] & letter[1:]), np.flatnonzero(letter[:-1] & ~letter[1:])
    # a word doesn't run from one text into the next
    cuts = bounds[1:-1][(bounds[1:-1] > 0) & (bounds[1:-1] < len(cp))]
    cuts = np.unique(cuts[letter[cuts] & letter[cuts + 1]])
    begin, end = np.sort(np.concatenate([begin, cuts])), np.sort(np.concatenate([end, cuts]))
    per_text = np.diff(np.searchsorted(begin, bounds))
    width = 1 + (cp > 0x7F) + (cp > 0x7FF) + (cp > 0xFFFF)
    byte_at = np.concatenate([[0], np.cumsum(width, dtype=np.int64)])
    code, words = distinct_words(one.encode(), byte_at[begin], byte_at[end] - byte_at[begin])
    start = np.repeat(bounds[:-1], per_text)
    return code, [w.decode() for w in words], per_text, begin - start, end - start


def distinct_words(raw: bytes, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """:func:`distinct` for words with gaps between them, which it wants closed up."""
    if not len(begin):
        return np.zeros(0, np.int32), []
    data = np.frombuffer(raw, np.uint8)
    keep = np.zeros(len(data) + 1, dtype=np.int8)
    np.add.at(keep, begin, 1)
    np.add.at(keep, begin + size, -1)
    closed = data[np.cumsum(keep[:-1], dtype=np.int8) > 0]
    return distinct(closed.tobytes(), np.cumsum(size) - size, size)


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buckets, grams per word, script of each word, letters of each word) of lower-cased spellings."""
    low = [f"\x02{w.lower()}\x03" for w in words]
    cp = np.frombuffer("".join(low).encode("utf-32-le"), "<u4").astype(np.uint64)
    size = np.array([len(w) for w in low], dtype=np.int64)
    of = np.repeat(np.arange(len(low)), size)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(cp))  # characters from here to the word's end
    h, found, at = np.zeros(len(cp), dtype=np.uint64), [], []
    for n in range(1, max(ORDERS) + 1):
        ahead = np.zeros(len(cp), dtype=np.uint64)
        ahead[:len(cp) - n + 1] = cp[n - 1:]
        h = (h ^ ahead) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)
        if n in ORDERS:
            ok = left >= n
            found.append(((h[ok] ^ (h[ok] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(48))
            at.append(of[ok])
    at, found = np.concatenate(at), np.concatenate(found).astype(np.int64)
    order = np.argsort(at, kind="stable")
    first = np.cumsum(size) - size + 1
    script = _SCRIPT_OF[np.searchsorted(_STARTS, cp[first], side="right") - 1]
    return found[order], np.bincount(at, minlength=len(words)), script, np.array([len(w) for w in words])


class Model:
    """Languages, log-probabilities of the buckets and the scripts of each language."""

    def __init__(self, langs: list[str], table: np.ndarray, scripts: np.ndarray):
        self.langs, self.table, self.scripts = langs, table, scripts

    @classmethod
    def of_counts(cls, langs: list[str], counts: np.ndarray, letters: np.ndarray) -> Model:
        """counts: (languages, BUCKETS), letters: (languages, scripts)."""
        share = (counts + 0.5) / (counts.sum(1, keepdims=True) + 0.5 * BUCKETS)
        allowed = letters >= np.maximum(1, SCRIPT_SHARE * letters.sum(1, keepdims=True))
        return cls(langs, np.log(share).T.astype(np.float32).copy(), allowed.T)

    def word_scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(log-probability of each language, at least FLOOR, or -inf if the language can't
        write the word's script; letters) of spellings."""
        found, n, script, letters = grams(words)
        at = np.cumsum(n) - n
        like = TEMPER * np.add.reduceat(self.table[found], at, axis=0)
        can = self.scripts[script]
        can = can | ~can.any(1, keepdims=True)  # a script that nobody was seen to write says nothing
        like = np.where(can, like, -np.inf)
        like = like - like.max(1, keepdims=True)
        like = like - np.log(np.exp(like).sum(1, keepdims=True))
        like[~self.scripts[script].any(1)] = -np.log(len(self.langs))
        return np.where(can, np.maximum(like, FLOOR), -np.inf), letters

    def label(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """Per text its spans: (first code point, end, language number)."""
        code, words, per_text, begin, end = words_of(texts)
        if not words or not self.langs:
            return [[] for _ in texts]
        score, _ = self.word_scores(words)
        path = viterbi(score, code, per_text, SWITCH)
        out, at = [], 0
        for n in per_text.tolist():
            p = path[at:at + n]
            cut = np.flatnonzero(np.diff(p, prepend=-1)) if n else np.zeros(0, np.int64)
            stop = np.append(cut[1:], n) - 1 if n else cut
            out.append(list(zip(begin[at + cut].tolist(), end[at + stop].tolist(), p[cut].tolist(), strict=True)))
            at += n
        return out


def viterbi(score: np.ndarray, code: np.ndarray, per_text: np.ndarray, switch: float) -> np.ndarray:
    """The best path (a language number for every word) of each text: the sum of its
    words' scores less ``switch`` for each change. All texts take a step at a time,
    the long ones going on alone. Ties go to staying, then to the first language."""
    path = np.zeros(len(code), dtype=np.int64)
    order = np.argsort(-per_text, kind="stable")
    start = (np.cumsum(per_text) - per_text)[order]
    size = per_text[order]
    going = np.searchsorted(-size, -np.arange(1, (size[0] if len(size) else 0) + 1), side="right")
    value, back = None, []
    ends = np.zeros(len(size), dtype=np.int64)
    for t, n in enumerate(going.tolist()):
        s = score[code[start[:n] + t]]
        if value is None:
            value = s.copy()
            back.append(None)
        else:
            if n < len(value):
                ends[n:len(value)] = value[n:].argmax(1)
                value = value[:n]
            top = value.argmax(1)
            jump = value[np.arange(n), top][:, None] - switch
            stay = value >= jump
            back.append((stay, top))
            value = np.where(stay, value, jump) + s
    if value is None:
        return path
    ends[:len(value)] = value.argmax(1)
    for t in range(len(going) - 1, -1, -1):
        n = going[t]
        path[start[:n] + t] = ends[:n]
        if t:
            stay, top = back[t]
            ends[:n] = np.where(stay[np.arange(n), ends[:n]], ends[:n], top)
    return path


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", fold: int = 0,
          folds: int = 5, per_language: int = 1500, tasks: int = 8) -> Model:
    """Learn from about ``per_language`` texts of each language whose crc32(id) mod
    ``folds`` isn't ``fold``. No labelled text: a model without languages (all und)."""
    rows = pick(docs, id=id_col, text=text_col, lang=lang_col).where("lang is not null and text is not null")
    rows = rows.where(doc_bucket(F.col("id"), folds) != fold)
    have = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(have)
    if not langs:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((len(SCRIPTS), 0), bool))
    # ids below a hash bound that leaves about per_language of each
    bound = F.element_at(F.create_map(*[F.lit(x) for lang in langs for x in (
        lang, int(min(1.0, per_language / have[lang]) * (1 << 40)))]), F.col("lang"))
    few = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 40)) < bound).select("lang", "text").repartition(tasks)
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("counts", T.BinaryType()),
                           T.StructField("letters", T.BinaryType())])

    def count(batches):
        total: dict[str, list[np.ndarray]] = {}
        for b in batches:
            for part in slices(b, 1):
                names, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
                for lang in set(names):
                    code, words, *_ = words_of([t for t, x in zip(texts, names, strict=True) if x == lang])
                    if not words:
                        continue
                    found, n, script, letters = grams(words)
                    often = np.bincount(code, minlength=len(words))
                    c, s = total.setdefault(lang, [np.zeros(BUCKETS), np.zeros(len(SCRIPTS))])
                    c += np.bincount(found, weights=np.repeat(often, n), minlength=BUCKETS)
                    s += np.bincount(script, weights=often * letters, minlength=len(SCRIPTS))
        for lang, (c, s) in total.items():
            yield pa.RecordBatch.from_pydict({"lang": [lang], "counts": [c.tobytes()], "letters": [s.tobytes()]})

    counts, letters = np.zeros((len(langs), BUCKETS)), np.zeros((len(langs), len(SCRIPTS)))
    for r in few.mapInArrow(count, schema).collect():  # tasks x languages rows of half a megabyte
        k = langs.index(r["lang"])
        counts[k] += np.frombuffer(r["counts"])
        letters[k] += np.frombuffer(r["letters"])
    return Model.of_counts(langs, counts, letters)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang, score, spans): for every row its language (``und``: null text or
    no letter), the share of letters labelled so, and the labelled spans as
    array<struct<start, end, lang>> in code points, end exclusive."""
    rows = pick(docs, id=id_col, text=text_col)
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                         T.StructField("lang", T.StringType())])
    schema = T.StructType([rows.schema["id"], T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("spans", T.ArrayType(span))])
    sent = docs.sparkSession.sparkContext.broadcast((model.langs, model.table, model.scripts))
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def work():
        tool = Model(*sent.value)

        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            langs, scores, spans = [], [], []
            for found in tool.label([t or "" for t in b.column(1).to_pylist()]):
                got = np.zeros(max(1, len(tool.langs)))
                for a, z, k in found:
                    got[k] += z - a
                most = int(got.argmax())
                langs.append(tool.langs[most] if found else "und")
                scores.append(float(got[most] / got.sum()) if found else 0.0)
                spans.append([{"start": a, "end": z, "lang": tool.langs[k]} for a, z, k in found])
            return pa.RecordBatch.from_arrays([b.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                                               pa.array(spans, kind)], names=["id", "lang", "score", "spans"])
        return step

    return per_batch(rows, work, schema, text_at=1)
