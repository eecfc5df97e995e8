"""Sharding by a hierarchical weighted hash tree, in SQL functions only.

Shards are leaves of racks, racks of regions; a node weighs what its shards weigh
together. At each level a row draws an exponential variate -ln(u) / weight for every
child of the node it is in, u from the hash of (id, level, child's number), and goes to
the least draw. So a row costs one digest a child on its way (regions + racks of one
region + shards of one rack), not one a shard.

A draw depends on nothing but the child's number and weight. A changed weight moves rows
only into or out of the subtrees it is in: a row that stays in a rack without a change
stays in its shard. A new shard opens a region of its own, so it takes rows only into itself.

Slots number the rows of a shard from 0 without a gap. Rows that repeat id, size and text
hash are one class with a count until the end, so however often a row repeats, it is never
a group of rows in one task. Classes are ordered by a hash and cut by it into blocks of about
``rows_per_block`` rows; block counts give each block's first slot. A class is written out
in pieces of ``rows_per_block`` slots that are dealt to tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import Scratch, pick
from quayside.llm.decontam import small

RACK_SHARDS, REGION_RACKS = 4, 2
ROWS_PER_BLOCK = 50_000
#: Draws take 13 hex digits of a digest.
RANGE = float(1 << 52)

#: Per region its racks, per rack its (shard, weight).
Tree = list[list[list[tuple[int, float]]]]


def number(digest: Column) -> Column:
    """The first 13 hex digits, a whole number under 2**52."""
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")


def tree(weights: list[float], rack_shards: int = RACK_SHARDS, region_racks: int = REGION_RACKS) -> Tree:
    """Shards in racks and regions, filled in order."""
    leaves = list(enumerate(weights))
    racks = [leaves[k:k + rack_shards] for k in range(0, len(leaves), rack_shards)]
    return [racks[k:k + region_racks] for k in range(0, len(racks), region_racks)]


def grown(regions: Tree, weight: float) -> Tree:
    """The tree with one more shard, the only one of a new region."""
    return [*regions, [[(sum(len(rack) for racks in regions for rack in racks), weight)]]]


def _step(key: Column, level: str, children: list[int], weights: list[float]) -> Column:
    """The child, by its number, with the least draw. The smaller number wins a tie."""
    if len(children) == 1:
        return F.lit(children[0])
    return F.array_min(F.array(*[F.struct(
        (-F.log((number(F.md5(F.concat(key, F.lit(f":{level}:{c}")))) + 0.5) / RANGE) / w).alias("d"), F.lit(c).alias("c"))
        for c, w in zip(children, weights, strict=True)]))["c"]


def _choose(at: Column, options: dict[int, Column]) -> Column:
    """The option of the number ``at``; only that one is evaluated."""
    (first, out), *others = options.items()
    if not others:
        return out
    case = F.when(at == first, out)
    for k, option in others:
        case = case.when(at == k, option)
    return case


def place(rows: DataFrame, regions: Tree, key: str, out: str) -> DataFrame:
    """``rows`` with the column ``out``: the shard they descend to. Regions and racks are
    numbered over the whole tree, so no node's draw depends on the nodes beside it."""
    weight = lambda rack: sum(w for _, w in rack)
    first = 0
    numbered: dict[int, dict[int, list[tuple[int, float]]]] = {}
    for r, racks in enumerate(regions):
        numbered[r] = dict(enumerate(racks, first))
        first += len(racks)
    k = F.col(key)
    rows = rows.withColumn("_region", _step(k, "region", list(numbered), [
        sum(map(weight, racks.values())) for racks in numbered.values()]))
    rows = rows.withColumn("_rack", _choose(F.col("_region"), {
        r: _step(k, "rack", list(racks), list(map(weight, racks.values()))) for r, racks in numbered.items()}))
    shard = _choose(F.col("_rack"), {c: _step(k, "shard", [s for s, _ in rack], [w for _, w in rack])
                                     for racks in numbered.values() for c, rack in racks.items()})
    return rows.withColumn(out, shard.cast("int")).drop("_region", "_rack")


def shard_rows(docs: DataFrame, shards: int, weights: list[float] | None = None, grow_by: float = 1.0,
               id_col: str = "doc_id", text_col: str = "text", rows_per_block: int = ROWS_PER_BLOCK,
               rack_shards: int = RACK_SHARDS, region_racks: int = REGION_RACKS) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard): one row per row.

    ``weights``: one per shard, above 0 (default all 1); ``grow_by``: the weight of
    the one more shard of ``grown_shard``, a region of its own. Rows of one id share a shard; a null id
    counts as an empty one, a null text as no text. Empty table: no rows.
    """
    weights = [1.0] * shards if weights is None else list(weights)
    if shards < 1 or len(weights) != shards or min(weights) <= 0 or grow_by <= 0:
        raise ValueError("needs one positive weight per shard and at least one shard")
    scratch = Scratch(docs.sparkSession, "sharding")
    text = F.coalesce("text", F.lit(""))
    now = tree(weights, rack_shards, region_racks)
    rows = pick(docs, id=id_col, text=text_col).select(
        "id", (F.octet_length(text) + 8).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = rows.groupBy("id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.withColumn("key", F.coalesce(F.col("id").cast("string"), F.lit("")))
    rows = place(place(rows, now, "key", "shard"), grown(now, grow_by), "key", "grown_shard")
    rows = rows.withColumn("k", number(F.md5(F.concat("key", F.lit(":"), F.col("text_crc32"))))).drop("key")
    rows = scratch.keep(rows, "placed")
    blocks = max(1, -(-rows.count() // rows_per_block))
    rows = rows.withColumn("block", F.floor(F.col("k") / RANGE * blocks))
    counts = rows.groupBy("shard", "block").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = scratch.keep(counts.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")), "starts")
    inside = Window.partitionBy("shard", "block").orderBy("k", "id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("i", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(small(starts), ["shard", "block"])
    rows = rows.withColumn("first", F.col("start") + F.col("i")).withColumn("stop", F.col("first") + F.col("n") - 1)
    out = ["id", "size", "text_crc32", "shard", "grown_shard"]
    every = lambda d: d.select(*out, F.explode(F.sequence("first", "stop")).alias("slot"))
    often = rows.where(F.col("n") > rows_per_block).select(*out, "stop", F.explode(F.sequence(
        F.col("first"), F.col("stop"), F.lit(rows_per_block).cast("bigint"))).alias("first"))
    often = often.withColumn("stop", F.least("stop", F.col("first") + rows_per_block - 1)).repartition("shard", "first")
    rows = every(rows.where(F.col("n") <= rows_per_block)).union(every(often))
    return rows.select("id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def _crc_table() -> list[int]:
    out = []
    for c in range(256):
        for _ in range(8):
            c = (c >> 1) ^ 0xEDB88320 if c & 1 else c >> 1
        out.append(c)
    return out


def _sql_least(level: str, numbers: str, weight: str) -> str:
    """The least draw among children, numbered by the SQL list ``numbers``, each of weight ``weight``."""
    return f"""(SELECT arg_min(c, -ln((('0x' || substr(md5(k || ':{level}:' || c), 1, 13))::BIGINT + 0.5) / {RANGE:.1f}) / {weight})
        FROM (SELECT unnest({numbers}) AS c))"""


ORACLE = f"""
WITH docs AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, coalesce(CAST(doc_id AS VARCHAR), '') AS k FROM documents),
crc AS (
  SELECT doc_id, k, length(h) // 2 AS bytes, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(0, length(h), 2),
      lambda i: ((position(substr(h, i + 1, 1) IN '0123456789ABCDEF') - 1) * 16
                 + position(substr(h, i + 2, 1) IN '0123456789ABCDEF') - 1)::BIGINT)),
    lambda c, b: xor(list_extract({_crc_table()}::BIGINT[], (xor(c, b) & 255) + 1), c >> 8))) AS crc FROM docs),
entered AS (
  SELECT *, {_sql_least("region", "[0, 1, 2]", "8")} AS region,
    {_sql_least("region", "[0, 1, 2, 3]", "CASE c WHEN 3 THEN 1 ELSE 8 END")} AS grown FROM crc),
racked AS (SELECT *, {_sql_least("rack", "[2 * region, 2 * region + 1]", "4")} AS rack FROM entered),
placed AS (
  SELECT doc_id, CAST(bytes + 8 AS BIGINT) AS size, crc AS text_crc32, grown,
    CAST({_sql_least("shard", "[4 * rack, 4 * rack + 1, 4 * rack + 2, 4 * rack + 3]", "1")} AS INT) AS shard,
    md5(k || ':' || crc) AS o FROM racked)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY substr(o, 1, 13), doc_id, text_crc32, size) - 1 AS slot,
  CAST(CASE grown WHEN 3 THEN 24 ELSE shard END AS INT) AS grown_shard
FROM placed
"""
