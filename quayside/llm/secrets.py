"""Secret scan with corpus-wide ownership frequency, in SQL functions only.

1. Candidates: per kind, leftmost non-overlapping matches with their places. The
   text is split at the matches; a running sum over the lengths of the parts and
   the matches (a window over one document's matches) gives code point offsets.
2. Ownership: candidate values, hashed, are counted by distinct repositories and
   owners over the whole corpus, pre-aggregated to distinct (hash, repository,
   owner) before the counts, so a value copied a million times is a few rows.
3. A value with ``example_owners`` owners or more is a widely copied example;
   what fewer hold is owner-specific and looks live. Base kinds (assign, access,
   hex) keep every span and learn their class; the extra kind ``opaque`` (mixed
   upper, lower and digits, no keyword in front) counts only if owner-specific.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import Scratch
from quayside.llm.decontam import small

# Fixed values of the base kinds, in their listed order: name, pattern, least length, group that is measured.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = [("assign", ASSIGN, 6, 2), ("access", r"AKIA[A-Z0-9]+", 20, 0), ("hex", r"[0-9a-f]{24,}", 24, 0),
         ("opaque", r"[A-Za-z0-9_]{24,}", 24, 0)]
BASE = 3
EXAMPLE_OWNERS = 5


def _numbered(kind: int):
    return lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), F.length(x["p"]).alias("before"),
                                 x["m"].alias("value"))


def matches(docs: DataFrame, id_col: str, text_col: str, owner_cols: list[str], repo_cols: list[str]) -> DataFrame:
    """One row per row of ``docs``: id, text_hash, owner, repo and per kind an array
    of (length of the text before, since the last match; the match)."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    name = lambda cols: F.when(F.coalesce(*[F.col(f"`{c}`").isNotNull() for c in cols]),
                               F.to_json(F.array(*[F.col(f"`{c}`").cast("string") for c in cols])))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"),
                       name(owner_cols).alias("owner"), name(repo_cols).alias("repo"))
    for kind, pattern, _, _ in KINDS:
        rows = rows.withColumn(f"m_{kind}", F.regexp_extract_all("text", F.lit(pattern), 0))
    found = []
    for k, (kind, pattern, _, _) in enumerate(KINDS):
        parts = F.split("text", pattern, -1)
        each = F.transform(F.arrays_zip(F.slice(parts, 1, F.size(f"m_{kind}")).alias("p"), F.col(f"m_{kind}").alias("m")),
                           _numbered(k))
        found.append(F.when(F.size(f"m_{kind}") > 0, each))
    none = F.array().cast("array<struct<kind:int,i:int,before:int,value:string>>")
    return rows.select("id", "text_hash", "owner", "repo", F.concat(*[F.coalesce(f, none) for f in found]).alias("found"))


def candidates(found: DataFrame) -> DataFrame:
    """One row per span of each distinct (id, text, owner, repository): kind, start,
    stop (code points, end exclusive) and the digest of the secret's value."""
    rows = found.where(F.size("found") > 0).dropDuplicates(["id", "text_hash", "owner", "repo"])
    rows = rows.select("id", "text_hash", "owner", "repo", F.explode("found").alias("f")).select("*", "f.*").drop("f")
    doc = ["id", "text_hash", "owner", "repo", "kind"]
    till = Window.partitionBy(*doc).orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("stop", F.sum(F.col("before") + F.length("value")).over(till).cast("int"))
    rows = rows.withColumn("start", F.col("stop") - F.length("value"))
    value = F.when(F.col("kind") == 0, F.regexp_extract("value", ASSIGN, 2)).otherwise(F.col("value"))
    least = F.element_at(F.array(*[F.lit(n) for _, _, n, _ in KINDS]), F.col("kind") + 1)
    mixed = value.rlike("[A-Z]") & value.rlike("[a-z]") & value.rlike("[0-9]")
    rows = rows.withColumn("secret", value).where((F.length("secret") >= least) & ((F.col("kind") < BASE) | mixed))
    return rows.select("id", "text_hash", "owner", "repo", "kind", "start", "stop", F.md5("secret").alias("hash"))


def ownership(spans: DataFrame) -> DataFrame:
    """(hash, owners, repos): distinct owners and repositories of every value."""
    held = spans.select("hash", "owner", "repo").distinct()
    return held.groupBy("hash").agg(F.count_distinct("owner").alias("owners"), F.count_distinct("repo").alias("repos"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_cols: tuple[str, ...] = ("source",),
         repo_cols: tuple[str, ...] = ("source", "lang"), example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """(id, text_hash, spans): one row per row of ``docs``; spans is an array of
    (start, kind number, stop, owners, repos, live), ordered, empty where nothing
    is found (null and empty texts). Rows that repeat id and text get equal spans.
    A null owner is no owner; a null id is carried.
    """
    scratch = Scratch(docs.sparkSession, "secrets")
    found = scratch.keep(matches(docs, id_col, text_col, list(owner_cols), list(repo_cols)), "matches")
    spans = scratch.keep(candidates(found), "spans")
    counted = scratch.keep(ownership(spans), "ownership")
    rated = spans.join(counted, "hash").withColumn("live", F.col("owners") < example_owners)
    rated = rated.where((F.col("kind") < BASE) | F.col("live"))
    rated = scratch.keep(rated.groupBy("id", "text_hash").agg(F.array_sort(F.collect_set(
        F.struct("start", "kind", "stop", "owners", "repos", "live"))).alias("spans")), "rated")
    hit = found.where(F.size("found") > 0).select("id", "text_hash")
    at = hit["id"].eqNullSafe(rated["id"]) & (hit["text_hash"] == rated["text_hash"])
    none = F.array().cast(rated.schema["spans"].dataType)
    hit = hit.join(rated, at, "left").select(hit["id"], hit["text_hash"], F.coalesce("spans", none).alias("spans"))
    return hit.union(found.where(F.size("found") == 0).select("id", "text_hash", none.alias("spans")))


def as_text(spans, least_kind: int = len(KINDS)):
    """``kind:start:end`` of the spans whose kind number is under ``least_kind``, comma-joined."""
    names = F.array(*[F.lit(k) for k, *_ in KINDS])
    return F.array_join(F.transform(F.filter(spans, lambda s: s["kind"] < least_kind), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"], s["stop"])), ",")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars",
           mark: str = "[secret]", **how) -> DataFrame:
    """Pipeline stage: every span that looks live is replaced by ``mark`` (spans
    that overlap or touch, by one); widely copied examples stay. All rows stay, with the
    columns of ``docs``; ``length_col``, if it is there, is the new text's length."""
    scratch = Scratch(docs.sparkSession, "secrets")
    live = scan(docs, id_col, text_col, **how).select("id", "text_hash", F.filter(
        "spans", lambda s: s["live"]).alias("live")).where(F.size("live") > 0).dropDuplicates(["id", "text_hash"])
    live = small(scratch.keep(live, "live"))
    names = [f"c{k}" for k in range(len(docs.columns))]
    at = dict(zip(docs.columns, names, strict=True))
    rows = docs.toDF(*names)
    text = F.col(at[text_col])
    rows = rows.join(live, F.col(at[id_col]).eqNullSafe(live["id"])
                     & (F.xxhash64(F.coalesce(text, F.lit(""))) == live["text_hash"]), "left")
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    step = lambda a, s: F.struct(
        F.when((s["start"] <= a["at"]) & (a["at"] > 0), a["out"]).otherwise(
            F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit(mark))).alias("out"),
        F.greatest(a["at"], s["stop"]).alias("at"))
    clean = F.aggregate("live", start, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    rows = rows.withColumn("clean", F.when(F.size("live") > 0, clean).otherwise(text))
    out = {c: F.col(n) for c, n in at.items()}
    out[text_col] = F.col("clean")
    if length_col in out:
        kind = docs.schema[length_col].dataType
        out[length_col] = F.when(F.size("live") > 0, F.length("clean").cast(kind)).otherwise(out[length_col])
    return rows.select(*[c.alias(n) for n, c in out.items()])


_SQL_ASSIGN = ("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in "(password|passwd|secret|token|api_?key)")
               + r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""")
_SQL_KINDS = [(k, _SQL_ASSIGN if k == "assign" else p, n) for k, p, n, _ in KINDS]
ORACLE = rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, source, lang FROM documents),
hits AS ({" UNION ALL ".join(f'''
  SELECT rid, {k} AS kind, {n} AS least, unnest(regexp_extract_all(text, '{p}')) AS v,
    unnest(list_slice(regexp_split_to_array(text, '{p}'), 1, len(regexp_extract_all(text, '{p}')))) AS before,
    generate_subscripts(regexp_extract_all(text, '{p}'), 1) AS i FROM docs''' for k, (_, p, n) in enumerate(_SQL_KINDS))}),
placed AS (
  SELECT *, CASE WHEN kind = 0 THEN regexp_extract(v, '{_SQL_ASSIGN}', 2) ELSE v END AS secret,
    sum(length(before) + length(v)) OVER (PARTITION BY rid, kind ORDER BY i) AS stop FROM hits),
spans AS (
  SELECT rid, kind, CAST(stop - length(v) AS INT) AS start, CAST(stop AS INT) AS stop, secret FROM placed
  WHERE length(secret) >= least AND (kind < {BASE} OR (regexp_matches(secret, '[A-Z]')
    AND regexp_matches(secret, '[a-z]') AND regexp_matches(secret, '[0-9]')))),
owned AS (
  SELECT secret, count(DISTINCT source) AS owners FROM spans JOIN docs USING (rid) GROUP BY secret),
rated AS (
  SELECT rid, kind, start, stop, owners < {EXAMPLE_OWNERS} AS live,
    list_extract(['{"', '".join(k for k, *_ in KINDS)}'], kind + 1) || ':' || start || ':' || stop AS s
  FROM spans JOIN owned USING (secret) WHERE kind < {BASE} OR owners < {EXAMPLE_OWNERS})
SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
  count(*) FILTER (kind = 2) AS n_hex,
  sha256(coalesce(string_agg(s, ',' ORDER BY start, kind) FILTER (kind < {BASE}), '')) AS base_sha256,
  coalesce(string_agg(s, ',' ORDER BY start, kind), '') AS spans,
  count(*) FILTER (live) AS n_live
FROM docs LEFT JOIN rated USING (rid) GROUP BY rid, doc_id
"""
