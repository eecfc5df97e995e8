"""Small-file detection and compaction of partitioned Parquet tables."""

from __future__ import annotations

import math
import re
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quayside.sinks.lake_write import delete_path, make_directory, rename_path
from quayside.sources.lake_scan import scan_file_inventory

MB = 1024 * 1024
DEFAULT_TARGET_MB = 128


def partition_file_stats(inventory: DataFrame) -> DataFrame:
    """File count, total and average bytes per (dataset, partition)."""
    parts = inventory.where(F.col("partition") != "")
    return (parts.groupBy("dataset", "partition", "partition_path")
            .agg(F.count(F.lit(1)).alias("file_count"),
                 F.sum("bytes").alias("total_bytes"),
                 F.avg("bytes").alias("average_bytes")))


def small_partitions(spark: SparkSession, root: str, threshold_mb: int = DEFAULT_TARGET_MB) -> DataFrame:
    """Partitions whose files average below the threshold, sorted by path.

    ``needs_compaction`` only when the partition has more files than its bytes
    fill at the threshold size, so a rewritten partition isn't flagged again.
    """
    stats = partition_file_stats(scan_file_inventory(spark, root))
    enough = F.ceil(F.col("total_bytes") / F.lit(float(threshold_mb * MB)))
    return (stats.where(F.col("average_bytes") < threshold_mb * MB)
            .select(F.col("partition_path").alias("partition"), "file_count", "total_bytes",
                    F.floor("average_bytes").cast("bigint").alias("average_bytes"),
                    (F.col("file_count") > F.greatest(enough, F.lit(1))).alias("needs_compaction"))
            .orderBy("partition"))


def compact_partitions(spark: SparkSession, root: str, threshold_mb: int = DEFAULT_TARGET_MB,
                       target_mb: int = DEFAULT_TARGET_MB, apply: bool = False) -> DataFrame:
    """Detect, and with ``apply`` rewrite, fragmented partitions of one table.

    All flagged partitions are rewritten by ONE job, to as many files each as
    their bytes fill at the target size. Partition columns, however many levels
    and whatever their text, are never read: rows are grouped by the directory
    they come from and go back into a directory of the same name. Row counts per
    directory are compared; only then each directory is swapped (original to a
    backup outside the table, staged to original), a failed rename is undone,
    and the backups go last.
    """
    # One row per partition of one table: small, and materialised before any
    # file moves so no lazy plan re-lists swapped directories.
    candidates = small_partitions(spark, root, threshold_mb).collect()
    flagged = {r["partition"]: int(r["total_bytes"]) for r in candidates if r["needs_compaction"]}
    outcome: dict[str, tuple] = {}
    if apply and flagged:
        outcome = _rewrite_partitions(spark, root.rstrip("/"), flagged, target_mb)
    results = [(r["partition"], int(r["file_count"]), int(r["total_bytes"]), int(r["average_bytes"]),
                bool(r["needs_compaction"]), *outcome.get(r["partition"], (None, None)))
               for r in candidates]
    return spark.createDataFrame(
        results, "partition string, file_count long, total_bytes long, average_bytes long, "
                 "needs_compaction boolean, rows_before long, rows_after long").withColumn(
        "compacted", F.col("rows_after").isNotNull())


def _directory():
    """The directory of the file a row comes from, as Spark writes it (URL-encoded)."""
    return F.regexp_extract(F.col("_metadata.file_path"), r"^(.*)/[^/]+$", 1)


def _plain(path: str) -> str:
    """A path without its scheme, for comparing a listing's with a (decoded) file URL's."""
    return re.sub(r"^[a-z0-9+.-]+:/*(?=/)", "", path)


def _files_of(sizes: dict[str, int], target_mb: int) -> dict[str, int]:
    return {p: max(1, math.ceil(b / (target_mb * MB))) for p, b in sizes.items()}


def _write_in_files(rows: DataFrame, group: str, files: dict[str, int], path: str, columns) -> None:
    """Write ``columns`` of ``rows`` partitioned by ``group``, ``files`` of it (at
    most) per value: a value's rows are dealt out to that many tasks by an
    arbitrary number, so no value, however large, is one task's."""
    spark = rows.sparkSession
    counts = spark.createDataFrame(list(files.items()), f"{group} string, _files long")  # a row per partition
    dealt = rows.join(F.broadcast(counts) if len(files) <= 100_000 else counts, group)
    dealt = dealt.withColumn("_file", F.pmod(F.monotonically_increasing_id(), F.col("_files")))
    (dealt.repartition(max(1, sum(files.values())), group, "_file").select(*columns, group)
     .write.mode("overwrite").partitionBy(group).parquet(path))


def _rewrite_partitions(spark: SparkSession, root: str, parts: dict[str, int], target_mb: int) -> dict:
    """``parts``: path -> bytes. Returns path -> (rows before, rows after)."""
    staging = f"{root}_compacting_{uuid.uuid4().hex[:8]}"
    flat = spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true").option(
        "pathGlobFilter", "*.parquet").parquet(*parts)
    columns = flat.columns
    rows = flat.withColumn("_dir", F.md5(_directory())).withColumn("_from", _directory())
    before = {r["_dir"]: r for r in rows.groupBy("_dir", "_from").agg(F.count(F.lit(1)).alias("n")).collect()}
    path_of = {_plain(p): p for p in parts}
    where = {d: path_of[_plain(unquote(r["_from"]))] for d, r in before.items()}  # a directory per partition
    _write_in_files(rows.drop("_from"), "_dir", {d: f for d, f in zip(where, _files_of(
        {d: parts[p] for d, p in where.items()}, target_mb).values(), strict=True)}, staging, columns)
    after = {r["_d"]: r["n"] for r in spark.read.option("recursiveFileLookup", "true").parquet(staging).groupBy(
        F.regexp_extract(F.col("_metadata.file_path"), r"/_dir=([0-9a-f]{32})/[^/]+$", 1).alias("_d")).agg(
        F.count(F.lit(1)).alias("n")).collect()}
    bad = {p: (before[d]["n"], after.get(d)) for d, p in where.items() if before[d]["n"] != after.get(d)}
    if bad:
        delete_path(spark, staging)
        raise RuntimeError(f"compaction changed row counts: {bad}")
    backups = f"{root}_precompact_{uuid.uuid4().hex[:8]}"
    make_directory(spark, backups)
    for d, part in where.items():
        if not rename_path(spark, part, f"{backups}/{d}"):
            raise RuntimeError(f"can't move {part}; nothing of it was changed")
        if not rename_path(spark, f"{staging}/_dir={d}", part):
            back = rename_path(spark, f"{backups}/{d}", part)
            raise RuntimeError(f"can't move the rewritten {part}; " + (
                "its files are back" if back else f"its files are in {backups}/{d}"))
    delete_path(spark, backups)
    delete_path(spark, staging)
    return {p: (before[d]["n"], after[d]) for d, p in where.items()}


def compact_table(spark: SparkSession, source: str, destination: str, partition_col: str,
                  target_mb: int = DEFAULT_TARGET_MB) -> dict:
    """Rewrite a whole partitioned table into ~target-sized files.

    Input bytes per partition come from a recursive inventory (a partitioned
    table has no files at its top level) and say how many files it becomes; a
    hot day is split among that many tasks. Rows are counted on the way into the
    write and against what the written files hold.
    """
    inventory = scan_file_inventory(spark, source)
    sizes = inventory.groupBy("partition_path").agg(F.sum("bytes").alias("b")).collect()  # a row per partition
    total = sum(r["b"] for r in sizes)
    flat = spark.read.parquet(source)
    files = _files_of({_plain(r["partition_path"]): r["b"] for r in sizes}, target_mb)
    seen = Observation("compaction")
    rows = flat.observe(seen, F.count(F.lit(1)).alias("rows"))
    by_path = rows.withColumn("_from", _directory())
    paths = {u: files[_plain(unquote(u))] for u in (r[0] for r in flat.select(_directory().alias("u")).distinct().collect())}
    counts = spark.createDataFrame(list(paths.items()), "_from string, _files long")
    dealt = by_path.join(F.broadcast(counts) if len(paths) <= 100_000 else counts, "_from").withColumn(
        "_file", F.pmod(F.monotonically_increasing_id(), F.col("_files")))
    (dealt.repartition(max(1, sum(paths.values())), "_from", "_file").drop("_from", "_file", "_files")
     .write.mode("overwrite").partitionBy(partition_col).parquet(destination))
    rows_before = seen.get["rows"]
    rows_after = spark.read.parquet(destination).count()
    if rows_after != rows_before:
        raise RuntimeError(f"compaction changed row count: {rows_before} -> {rows_after}")
    return {"input_bytes": int(total), "rows_before": rows_before, "rows_after": rows_after,
            "target_files": sum(paths.values())}


def compaction_report(spark: SparkSession, files_before: int, files_after: int,
                      rows_before: int, rows_after: int, detected: bool) -> DataFrame:
    """One row: detection, files and rows before/after, preservation, reduction %."""
    fb, fa = files_before, files_after
    pct = round((1 - fa / fb) * 100, 2) if fb else 0.0
    return spark.createDataFrame(
        [(detected, fb, fa, rows_before, rows_after, rows_before == rows_after, pct)],
        "detected boolean, files_before long, files_after long, rows_before long, rows_after long, "
        "rows_preserved boolean, reduction_percent double")
