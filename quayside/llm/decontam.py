"""Benchmark decontamination: size-partitioned MinHash containment search.

An item is found in a document if at least ``threshold`` of the item's distinct
5-word shingles are in the document, however long that is (containment, not
Jaccard, which a long document would drown).

* Items are partitioned by size: by the length of their shingles and by the power of two
  under the number of shingles they need (``need`` = ceil(threshold * n) of n).
* An item's sketch are its n - need + 1 least MinHash values: a document without any of
  these misses too many shingles to reach the threshold, so the search loses nothing.
* A partition has a floor, the least ``need`` of its items, and a ceiling, the largest
  MinHash value in its sketches. A document passes over partitions whose floor is above its
  number of shingles, and a shingle is looked up only if its hash is under the ceiling of a
  partition that is left: of large items a sketch holds the least fifth of the hashes only.
* Documents are cut into words and read once for all partitions.
* Candidates are verified exactly: shared distinct shingles, as text, over n.

Everything is built from SQL functions. Sketches, items, candidates and found
rows are written once and measured; a side is broadcast only if its rows and bytes are
within ``BROADCAST_ROWS`` and ``BROADCAST_BYTES``, else it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.common import Scratch, pick

WORDS = 5
THRESHOLD = 0.8
#: Rows and bytes (uncompressed, as counted by ``width``) of a broadcast side.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64 << 20


def words(text: Column) -> Column:
    """Lower-case runs of letters, marks and digits; null: none."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+")
    return F.filter(parts, lambda w: w != "")


def shingles(w: Column, size: Column | int, hashed: bool) -> Column:
    """All runs of ``size`` words, as text or as 64-bit hashes; fewer words: none."""
    size = F.lit(size) if isinstance(size, int) else size
    text = lambda i: F.array_join(F.slice(w, i, size), " ")
    each = (lambda i: F.xxhash64(text(i))) if hashed else text
    n = F.size(w) - size + 1
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), each))


def width(c: Column, kind: T.DataType) -> Column:
    """Bytes a value takes, roughly: 16 for what has a fixed size, texts and arrays by their content."""
    if isinstance(kind, T.StructType):
        return sum((width(c[f.name], f.dataType) for f in kind.fields), F.lit(16))
    if isinstance(kind, T.ArrayType):
        each = F.aggregate(c, F.lit(0).cast("bigint"), lambda n, x: n + width(x, kind.elementType))
        return F.coalesce(each, F.lit(0)) + 16
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)).cast("bigint") + 16
    return F.lit(16)


def small(df: DataFrame) -> DataFrame:
    """``df``, to be broadcast if it has few enough rows and bytes. It must be a written table."""
    size = sum((width(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(0).cast("bigint"))
    rows, total = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return F.broadcast(df) if rows <= BROADCAST_ROWS and total <= BROADCAST_BYTES else df


def sketches(items: DataFrame, item_col: str, text_col: str, threshold: float, scratch: Scratch) -> DataFrame:
    """Per item: id, its shingle length, its distinct shingles, n, the shingles it
    needs, the power of two under that (its partition with the length) and its sketch. Items without words have no row: they match nothing.
    Items of fewer than five words are one shingle of all their words."""
    w = pick(items, item=item_col, text=text_col).select("item", words(F.col("text")).alias("w"))
    w = w.where(F.size("w") > 0).withColumn("size", F.least(F.size("w"), F.lit(WORDS))).distinct()
    w = w.withColumn("grams", F.array_distinct(shingles(F.col("w"), F.col("size"), hashed=False))).drop("w")
    n = F.size("grams")
    w = w.select("*", n.alias("n"), F.ceil(n * F.lit(threshold) - F.lit(1e-9)).cast("int").alias("need"))
    low = F.array_sort(F.transform("grams", lambda g: F.xxhash64(g)))
    w = w.withColumn("band", F.floor(F.log2(F.col("need"))).cast("int"))
    return scratch.keep(w.withColumn("sketch", F.slice(low, 1, F.col("n") - F.col("need") + 1))
                         .withColumn("key", F.xxhash64("item", F.array_join("grams", "|"))), "items")


def partitions(known: DataFrame) -> dict[int, list[tuple[int, int]]]:
    """Shingle length -> (floor, ceiling) of its partitions: at most 5 x 31 rows reach the driver."""
    bounds = known.groupBy("size", "band").agg(F.min("need"), F.max(F.array_max("sketch"))).collect()
    out: dict[int, list[tuple[int, int]]] = {}
    for size, _, floor, ceiling in sorted(bounds):
        out.setdefault(size, []).append((floor, ceiling))
    return out


def lookups(w: Column, bounds: dict[int, list[tuple[int, int]]]) -> Column:
    """(size, have, h): the hashes of a document's shingles that a partition of items may know."""
    out = []
    for size, parts in bounds.items():
        have = F.size(w) - size + 1
        top = F.greatest(*[F.when(have >= floor, F.lit(ceiling)) for floor, ceiling in parts], F.lit(None).cast("bigint"))
        known = F.filter(F.array_distinct(shingles(w, size, hashed=True)), lambda h: h <= top)  # noqa: B023
        out.append(F.transform(known, lambda h: F.struct(  # noqa: B023
            F.lit(size).alias("size"), have.alias("have"), h.alias("h"))))  # noqa: B023
    none = F.array().cast("array<struct<size:int,have:int,h:bigint>>")
    return F.concat(none, *[F.coalesce(x, none) for x in out])


def find_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, text_hash, item, n_shingles, n_found, containment): one row per document
    and item found in it; clean documents have none.

    Repeated rows of one id and text give one row; so do repeated items. A null
    id or item id is carried like any other. Null or empty texts: no row.
    """
    scratch = Scratch(docs.sparkSession, "decontam")
    known = sketches(items, item_col, item_text_col, threshold, scratch)
    rows = pick(docs, id=id_col, text=text_col)
    rows = rows.select("id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), words(F.col("text")).alias("w"))
    probe = small(scratch.keep(known.select("key", "size", "need", F.explode("sketch").alias("h")), "sketches"))
    grams = rows.select("id", "text_hash", F.explode(lookups(F.col("w"), partitions(known))).alias("g")).select("id", "text_hash", "g.*")
    hits = grams.join(probe, ["size", "h"]).where("have >= need").select("id", "text_hash", "key").distinct()
    cand = scratch.keep(hits, "candidates")
    pairs = cand.join(small(known.select("key", "item", "size", "grams", "n", "need")), "key")
    docs_at = scratch.keep(rows.join(small(scratch.keep(cand.select("id", "text_hash").distinct(), "suspects")),
                                     ["text_hash"], "left_semi").distinct(), "texts")
    both = pairs.join(docs_at.withColumnsRenamed({"id": "doc", "text_hash": "hash"}),
                      F.col("id").eqNullSafe(F.col("doc")) & (F.col("text_hash") == F.col("hash")))
    grams = F.array_distinct(shingles(F.col("w"), F.col("size"), hashed=False))
    found = both.select("id", "text_hash", "item", "n", "need", F.size(F.array_intersect(grams, "grams")).alias("n_found"))
    found = found.where("n_found >= need").groupBy("id", "text_hash", "item").agg(
        F.max(F.struct((F.col("n_found") / F.col("n")).alias("containment"), F.col("n"), F.col("n_found"))).alias("m"))
    return found.select("id", "text_hash", "item", F.col("m.n").alias("n_shingles"), F.col("m.n_found").alias("n_found"),
                        F.col("m.containment").alias("containment"))


def drop_found(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """Pipeline stage: ``docs`` without those that hold an item."""
    scratch = Scratch(docs.sparkSession, "decontam")
    bad = find_items(docs, items, id_col, text_col, **how).select("id", "text_hash").distinct()
    bad = small(scratch.keep(bad, "found"))
    names = [f"c{k}" for k in range(len(docs.columns))]
    at = dict(zip(docs.columns, names, strict=True))
    rows = docs.toDF(*names)
    return rows.join(bad, F.col(at[id_col]).eqNullSafe(bad["id"])
                     & (F.xxhash64(F.coalesce(F.col(at[text_col]), F.lit(""))) == bad["text_hash"]),
                     "left_anti").toDF(*docs.columns)


ORACLE = r"""
WITH items AS (
  SELECT DISTINCT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') AS w
  FROM benchmark WHERE text IS NOT NULL),
grams AS (
  SELECT item_id, least(len(w), 5) AS size,
         list_distinct(list_transform(range(1, len(w) - least(len(w), 5) + 2),
             lambda i: array_to_string(w[i:i + least(len(w), 5) - 1], ' '))) AS g
  FROM items WHERE len(w) > 0),
item_rows AS (SELECT item_id, size, len(g) AS n, unnest(g) AS s FROM grams),
docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') AS w
  FROM documents WHERE text IS NOT NULL),
doc_rows AS (
  SELECT DISTINCT doc_id, size, unnest(list_transform(range(1, greatest(len(w) - size + 2, 1)),
         lambda i: array_to_string(w[i:i + size - 1], ' '))) AS s
  FROM docs, (SELECT DISTINCT size FROM item_rows)),
counted AS (
  SELECT doc_id, item_id, n, count(*) AS found FROM doc_rows JOIN item_rows USING (size, s) GROUP BY ALL)
SELECT doc_id, item_id, CAST(n AS INT) AS n_shingles, CAST(found AS INT) AS n_found, found / n AS containment
FROM counted WHERE found >= ceil(n * 0.8 - 1e-9)
"""
