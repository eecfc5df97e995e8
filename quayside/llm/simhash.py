"""SimHash near-duplicates with pivot distance tables.

1. Fingerprints: 64 bits a text from its 3-word shingles, in Arrow batches
   (a text's shingles never leave its task; per byte position a histogram of
   the 256 byte values replaces counting 64 bits a shingle).
2. One row per distinct fingerprint: exact and same-print copies, however many,
   become one row before anything is compared.
3. Pivot table: Hamming distances to ``PIVOTS`` fixed reference fingerprints.
   By the triangle inequality two fingerprints within ``max_bits`` differ by no
   more than ``max_bits`` in any coordinate.
4. Pairs: two of the ``max_bits + 2`` bit blocks must agree for a pair within
   ``max_bits`` (pigeonhole), so every pair of blocks is a join key; no link can
   be missed. Within a key, pairs whose largest coordinate difference exceeds
   ``max_bits`` are discarded, survivors are verified bit by bit.
5. A key that holds more than ``bucket_cap`` distinct fingerprints isn't
   joined with itself. Its fingerprints instead meet at every fingerprint
   within ``ceil(max_bits / 2)`` bits. Two fingerprints at most ``max_bits`` apart
   share one that is within ``floor(max_bits / 2)`` bits of the one and
   ``ceil(max_bits / 2)`` of the other. The least of those at a meeting point's
   floor distance is at most ``max_bits`` from all that meet there and gets a link to
   each: a star, not pairs, so the work is linear in the size of the group and exact.
6. Components of the links; the smallest doc_id stands for each.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.common import Scratch, per_batch, pick, text_key
from quayside.llm.components import connected_components, least_of_component

#: Number of reference fingerprints; each discards about two thirds of unrelated pairs.
PIVOTS = 16
SEED = 42
#: Bits of every byte value, lowest first.
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def shingle_hashes(text: str | None, words: int = 3) -> np.ndarray:
    """XXH64 (seed 42) of every shingle of ``words`` words, repeats included.

    Only A-Z change case; words are split at ASCII white space, which is what
    ``bytes.lower`` and ``bytes.split`` do to UTF-8.
    """
    w = (text or "").encode().lower().split()
    if not w:
        return np.zeros(0, dtype="<u8")
    if len(w) <= words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(w), SEED)], dtype="<u8")
    h, join = xxhash.xxh64_intdigest, b" ".join
    shingles = zip(*(w[k:] for k in range(words)), strict=False)
    return np.fromiter((h(join(s), SEED) for s in shingles), dtype="<u8", count=len(w) - words + 1)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit b is set if it is set in over half of the hashes; none: zero. Signed."""
    n = len(hashes)
    if not n:
        return 0
    lanes = hashes.view(np.uint8).reshape(n, 8) + np.arange(0, 2048, 256)
    counts = np.bincount(lanes.ravel(), minlength=2048).reshape(8, 256) @ BITS
    return int(np.packbits((2 * counts > n).ravel(), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(id, key, fp bigint) for every row; key is a digest of the text. A null or
    empty text has fingerprint zero."""
    rows = pick(docs, id=id_col, text=text_col).select("id", text_key(F.col("text")).alias("key"), "text")
    schema = T.StructType([rows.schema["id"], rows.schema["key"], T.StructField("fp", T.LongType())])

    def work():
        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            fps = [fingerprint(shingle_hashes(t.as_py(), words)) for t in b.column(2)]
            return pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps, pa.int64())],
                                              names=["id", "key", "fp"])
        return step

    return per_batch(rows, work, schema, text_at=2)


def pivots(n: int = PIVOTS) -> list[int]:
    """The reference fingerprints: XXH64 of 0..n-1, signed."""
    return [int(np.uint64(xxhash.xxh64_intdigest(str(i).encode(), SEED)).astype(np.int64)) for i in range(n)]


def pivot_table(prints: DataFrame, n: int = PIVOTS) -> DataFrame:
    """``prints`` (fp) with the distances to the reference fingerprints, d0..d{n-1}."""
    return prints.select("fp", *[F.bit_count(F.col("fp").bitwiseXOR(F.lit(p))).cast("tinyint").alias(f"d{i}")
                                 for i, p in enumerate(pivots(n))])


def _blocks(max_bits: int) -> list[int]:
    """Masks of max_bits + 2 blocks of the 64 bits, as equal as can be, signed."""
    n = max_bits + 2
    at = [64 * k // n for k in range(n + 1)]
    masks = [sum(1 << b for b in range(at[k], at[k + 1])) for k in range(n)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def links(prints: DataFrame, max_bits: int = 2, bucket_cap: int = 2000, scratch: Scratch | None = None) -> DataFrame:
    """(a, b) over distinct fingerprints: pairs at most ``max_bits`` apart, enough
    of them to connect whatever such pairs connect. Inside keys of up to
    ``bucket_cap`` fingerprints all pairs are there; denser keys give stars.
    """
    scratch = scratch or Scratch(prints.sparkSession, "simhash")
    table = pivot_table(prints)
    masks = _blocks(max_bits)
    keyed = scratch.keep(table.select("*", F.posexplode(F.array(
        *[F.xxhash64(F.col("fp").bitwiseAND(F.lit(x)), F.col("fp").bitwiseAND(F.lit(y)))
          for x, y in combinations(masks, 2)])).alias("part", "key")), "keys")
    sizes = keyed.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = scratch.keep(sizes, "sizes")
    cold = sizes.where(F.col("n") <= bucket_cap).select("part", "key")
    hot = sizes.where(F.col("n") > bucket_cap).select("part", "key")
    met = scratch.keep(keyed.join(cold, ["part", "key"], "left_semi"), "met")
    far = F.greatest(*[F.abs(F.col(f"l.d{i}") - F.col(f"r.d{i}")) for i in range(PIVOTS)])
    apart = F.bit_count(F.col("l.fp").bitwiseXOR(F.col("r.fp")))
    pairs = met.alias("l").join(
        met.alias("r"), (F.col("l.part") == F.col("r.part")) & (F.col("l.key") == F.col("r.key"))
        & (F.col("l.fp") < F.col("r.fp")) & (far <= max_bits) & (apart <= max_bits))
    found = pairs.select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b"))
    if not hot.isEmpty():
        crowd = scratch.keep(keyed.join(hot, ["part", "key"], "left_semi").select("fp").distinct(), "crowd")
        found = found.union(midpoint_stars(crowd, max_bits))
    return found


def midpoint_stars(crowd: DataFrame, max_bits: int) -> DataFrame:
    """Links (a, b) of the fingerprints that meet at a fingerprint near both."""
    reach, near = (max_bits + 1) // 2, max_bits // 2
    flips = [sum(1 << b for b in c) for r in range(reach + 1) for c in combinations(range(64), r)]
    flips = F.array(*[F.lit(x - (1 << 64) if x >= 1 << 63 else x) for x in flips])
    at = crowd.select("fp", F.explode(flips).alias("flip")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("mid"), (F.bit_count("flip") <= near).alias("near"))
    hub = at.groupBy("mid").agg(F.min(F.when(F.col("near"), F.col("fp"))).alias("hub"), F.count(F.lit(1)).alias("n"))
    met = at.join(hub.where("n > 1 AND hub IS NOT NULL").select("mid", "hub"), "mid").where("hub <> fp")
    return met.select(F.least("hub", "fp").alias("a"), F.greatest("hub", "fp").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                    max_bits: int = 2, bucket_cap: int = 2000) -> DataFrame:
    """(id, key, fp, component): one row per row of ``docs``.

    ``component`` is the smallest id reachable over links of at most ``max_bits``
    differing bits, the row's own included. Rows with equal fingerprints (all
    empty texts among them) are linked like any others. A null id is kept; it
    stands for a component only if no member has an id. Empty table: no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "simhash")
    marked = scratch.keep(fingerprints(docs, id_col, text_col, words), "prints")
    classes = scratch.keep(marked.groupBy("fp").agg(F.min("id").alias("first")), "classes")
    pairs = links(classes.select("fp"), max_bits, bucket_cap, scratch)
    labels = scratch.keep(connected_components(pairs, "a", "b"), "labels")
    nodes = classes.select(F.col("fp").alias("node"), "first")
    least = least_of_component(labels, nodes, "first").select(F.col("node").alias("fp"), "least")
    whole = scratch.keep(classes.join(least, "fp", "left").select(
        "fp", F.coalesce("least", "first").alias("component")), "whole")
    return marked.join(whole, "fp").select("id", "key", "fp", "component")


def hex_print(fp: Column) -> Column:
    """16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
               max_bits: int = 2) -> DataFrame:
    """Pipeline stage: one row of each component stays, with the columns of ``docs``.

    It is the one with the smallest id (ids before null; of several texts under
    that id, the one with the smallest digest); an exact repetition of that row's
    id and text goes too. Rows are found again by id and text digest, so the texts
    themselves are shuffled once, in the last join, on keys that are all but unique.
    """
    found = near_duplicates(docs, id_col, text_col, words, max_bits)
    # A component whose members have no id has a null one: its rows differ by fingerprint class only.
    group = F.coalesce(F.col("component").cast("string"), F.concat(F.lit("fp:"), F.col("fp")))
    first = Scratch(docs.sparkSession, "simhash").keep(
        found.groupBy(group.alias("g")).agg(
            F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "key")).alias("m"))
        .select("m.id", "m.key").distinct(), "first")
    names = [f"c{k}" for k in range(len(docs.columns))]
    rows = docs.toDF(*names)
    at = {c: n for c, n in zip(docs.columns, names, strict=True)}
    rows = rows.withColumn("id", F.col(at[id_col])).withColumn("key", text_key(F.col(at[text_col])))
    same = rows["id"].eqNullSafe(first["id"]) & (rows["key"] == first["key"])
    kept = rows.join(first, same, "left_semi")
    often = found.groupBy("id", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id", "key")
    again = Scratch(docs.sparkSession, "simhash").keep(often, "again")
    if not again.isEmpty():
        same = kept["id"].eqNullSafe(again["id"]) & (kept["key"] == again["key"])
        kept = kept.join(again, same, "left_anti").union(
            kept.join(again, same, "left_semi").dropDuplicates(["id", "key"]))
    return kept.select(*names).toDF(*docs.columns)
