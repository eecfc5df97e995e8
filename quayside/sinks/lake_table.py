"""A lake table as a chain of snapshots.

Layout under the table's root::

    data/_commit=<n>/<column>=<value>/...   rows that commit n wrote (Hive layout below a version); <column> is
                                            the partition column, or with a grain <column>_month, its month
    keys/_commit=<n>/_bucket=<b>/...        key locator: key -> partition, hash-bucketed by key
    zones/_commit=<n>/                      per file of data/_commit=<n>: rows, bytes, least and greatest event time
    rejected/_commit=<n>/                   rows that the contract refused in commit n
    snapshots/<n>.json                what snapshot n consists of: one entry per partition and bucket

A commit writes new directories only, then renames its manifest into ``snapshots``:
that one rename publishes it. Readers take the greatest manifest and open the directories
it names, so they see the table before or after a commit, whole. What a crash leaves behind
is named by no manifest and goes with the next commit, as do directories that neither the
new snapshot nor the one before it names (a reader may still be on that one).

A keyed merge asks the locator, not the table, where its keys are: it reads the buckets of
its keys, rewrites the partitions that hold them, and those buckets. Partitions that only
get keys get new files, and are rewritten once they have about ``MOST_FILES`` more than their bytes
fill. The driver handles one entry per partition, commit and bucket; buckets hold about
``BUCKET_KEYS`` keys each.

A day of a long feed is far less than a file should hold, and every directory costs each commit
and reader a few calls to the storage. The contracts of such feeds have the grain ``month``: a directory a
month, whose rows are sorted by the day, which stays a column of the files. A new snapshot of ``MOST_DAYS`` days or
fewer is laid out by day; merges go on with the layout that there is.

One writer per table at a time is a precondition.
"""

from __future__ import annotations

import datetime as _dt
import json
import math
import re
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.contracts import KEYS, NOT_NULL, ON_BROKEN, PARTITION_BY, PARTITION_GRAIN, SCHEMAS
from quayside.functions.time import epoch_micros
from quayside.sinks import lake_write as fs
from quayside.sinks.lake_write import CODEC, MAX_RECORDS_PER_FILE, ROW_GROUP_BYTES, upsert_keyed

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
BUCKET_KEYS = 1_000_000
MOST_FILES, FULL_FILE_BYTES = 8, 128 * 1024 * 1024
SLICE_ROWS, MOST_SLICES = 4_000_000, 6  # a merge moves about as many rows at a time; each slice adds a file to a partition
MOST_DAYS = 31  # a new table of no more days has a directory a day, whatever its grain
LEAST_BUCKETS, MOST_BUCKETS = 16, 65_536

#: Column of each dataset by whose range its files are looked up.
EVENT_TIME = {"events": "event_ts", "events_bots": "event_ts", "transactions": "created_at",
              "quarantine_transactions": "created_at", "payments": "event_ts"}


class ContractBroken(ValueError):
    """A batch breaks its table's contract; nothing of it was published. ``broken``: rule -> rows."""

    def __init__(self, table: str, broken: dict[str, int]):
        super().__init__(f"{table}: " + ", ".join(f"{k} in {n} rows" for k, n in broken.items()))
        self.broken = broken


def observed(seen: Observation, *names: str) -> dict[str, int]:
    """What was observed; zeros where the planner found that there are no rows and dropped the observation."""
    try:
        return {n: seen.get[n] or 0 for n in names}
    except Py4JJavaError as e:
        if "AssertionError" not in str(e.java_exception):
            raise
        return dict.fromkeys(names, 0)


def _micros(value) -> int:
    if not isinstance(value, _dt.datetime):
        value = _dt.datetime.fromisoformat(str(value))
    return int((value - _dt.datetime(1970, 1, 1)) / _dt.timedelta(microseconds=1))


class LakeTable:
    """``keys`` identify a row, ``partition_by`` (date, text or integer; '' is stored as null) lays it out,
    ``event_time`` gets zones; ``grain`` "month": by the month of that date. ``not_null`` columns and unique keys are the contract; ``on_broken``: what
    to do with a row that breaks it, rule by rule: "fail" the commit (the default), "reject" the row to
    ``rejected/`` or "warn", that is, count it."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys=(), partition_by: str | None = None,
                 event_time: str | None = None, not_null=(), on_broken: dict[str, str] | None = None, grain: str | None = None):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.keys, self.partition_by, self.event_time = list(keys), partition_by, event_time
        self.not_null, self.on_broken = list(not_null), dict(on_broken or {})
        if partition_by and not isinstance(schema[partition_by].dataType, (T.DateType, T.StringType, T.IntegralType)):
            raise TypeError(f"can't partition by {partition_by}")
        if grain and (grain != "month" or not partition_by or not isinstance(schema[partition_by].dataType, T.DateType)):
            raise TypeError(f"can't partition by {grain} of {partition_by}")
        self.grain = self.contract_grain = grain
        if wrong := set(self.on_broken.values()) - {"fail", "reject", "warn"}:
            raise ValueError(f"unknown policy {wrong}")

    @classmethod
    def of(cls, spark: SparkSession, root: str, dataset: str, on_broken: dict[str, str] | None = None) -> LakeTable:
        """The table of one of the contracts."""
        base = {"events_bots": "events", "quarantine_transactions": "transactions", "quarantine_partners": "partners"}.get(dataset, dataset)
        return cls(spark, root, SCHEMAS[dataset], KEYS[base], PARTITION_BY.get(dataset), EVENT_TIME.get(dataset),
                   NOT_NULL[base], ON_BROKEN.get(base, {}) | (on_broken or {}), PARTITION_GRAIN.get(dataset))

    @classmethod
    def opened(cls, spark: SparkSession, root: str) -> LakeTable:
        """An existing table by what its manifest says of it."""
        m = cls(spark, root, T.StructType()).manifest()
        return cls(spark, root, T.StructType.fromJson(m["schema"]), m["keyed_by"], m["partition_by"], m["event_time"], m["not_null"], m["on_broken"], m.get("grain"))

    # ---- snapshots -----------------------------------------------------------

    def _versions(self, sub: str) -> list[int]:
        names = fs.list_names(self.spark, f"{self.root}/{sub}")
        return sorted(int(m[1]) for n in names if (m := re.fullmatch(r"(?:_commit=)?(\d+)(?:\.json)?", n)))

    def exists(self) -> bool:
        return bool(self._versions("snapshots"))

    def manifest(self, version: int | None = None) -> dict:
        """Of the given or the current snapshot; of a table never written, one without rows."""
        if version is None:
            version = max(self._versions("snapshots"), default=0)
        if not version:
            return {"version": 0, "parts": [], "buckets": LEAST_BUCKETS, "keys": {}, "written": {}, "properties": {}}
        return json.loads(fs.read_text(self.spark, f"{self.root}/snapshots/{version:08d}.json"))

    def _next_version(self) -> int:
        """Above everything on storage, so a crashed commit's directories are never written to again."""
        return 1 + max([0, *(v for sub in ("snapshots", "data", "keys", "zones", "rejected") for v in self._versions(sub))])

    def _publish(self, manifest: dict) -> None:
        name = f"{manifest['version']:08d}"
        staged, final = f"{self.root}/snapshots/.{name}", f"{self.root}/snapshots/{name}.json"
        fs.write_text(self.spark, staged, json.dumps(manifest))
        if fs.path_exists(self.spark, final) or not fs.rename_path(self.spark, staged, final):
            raise RuntimeError(f"snapshot {final} can't be published")
        self._clean(manifest)

    def _clean(self, now: dict) -> None:
        """Delete what neither ``now`` nor the snapshot before it names."""
        numbers = self._versions("snapshots")
        kept = [now, *(self.manifest(v) for v in numbers[-2:-1])]
        named = {p["dir"] for m in kept for p in m["parts"]} | {f"keys/_commit={v}/_bucket={b}" for m in kept for b, v in m["keys"].items()}
        old = [v for v in numbers if v not in {m["version"] for m in kept}]
        for m in map(self.manifest, old):
            for d in {p["dir"] for p in m["parts"]} | {f"keys/_commit={v}/_bucket={b}" for b, v in m["keys"].items()}:
                if d not in named:
                    fs.delete_path(self.spark, f"{self.root}/{d}")
        for sub, live in (("data", {int(d.split("=", 2)[1].split("/")[0]) for d in named if d.startswith("data/")}),
                          ("keys", {v for m in kept for v in m["keys"].values()}),
                          ("zones", {p["v"] for m in kept for p in m["parts"]})):
            for v in set(self._versions(sub)) - live - {now["version"]}:
                fs.delete_path(self.spark, f"{self.root}/{sub}/_commit={v}")
        for v in old:
            fs.delete_path(self.spark, f"{self.root}/snapshots/{v:08d}.json")

    # ---- reading ---------------------------------------------------------------

    def _open(self, manifest: dict, parts: list[dict]) -> DataFrame:
        """Rows of the given partitions; a version that is live as a whole is one path."""
        by_version: dict[int, list[str]] = {}
        for p in parts:
            by_version.setdefault(p["v"], []).append(f"{self.root}/{p['dir']}")
        paths = [p for v, dirs in by_version.items()
                 for p in ([f"{self.root}/data/_commit={v}"] if len(dirs) == manifest["written"][str(v)] else sorted(dirs))]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return (self.spark.read.schema(self.schema).option("basePath", f"{self.root}/data").parquet(*paths)
                .select(*self.schema.names))

    def parts_between(self, low, high, manifest: dict | None = None) -> list[dict]:
        """Partitions with an event time in [low, high): by their zones, without opening a file."""
        lo, hi = _micros(low), _micros(high)
        return [p for p in (manifest or self.manifest())["parts"] if p["lo"] is not None and p["lo"] < hi and p["hi"] >= lo]

    def read(self, low=None, high=None, version: int | None = None) -> DataFrame:
        """The current (or an older kept) snapshot; with ``low`` and ``high`` only rows whose event time
        lies in [low, high), from the partitions whose zone meets that range."""
        manifest = self.manifest(version)
        if low is None:
            return self._open(manifest, manifest["parts"])
        rows = self._open(manifest, self.parts_between(low, high, manifest))
        text = lambda x: F.lit(str(x)).cast("timestamp_ntz")
        return rows.where((F.col(self.event_time) >= text(low)) & (F.col(self.event_time) < text(high)))

    def of_partitions(self, values) -> DataFrame:
        """Rows of the partitions of these values (as text; None: the null partition)."""
        manifest = self.manifest()
        return self._open(manifest, [p for p in manifest["parts"] if p["at"] in set(values)])

    def zones(self) -> DataFrame:
        """One row per live file: file, bytes, rows, low, high (event time in microseconds)."""
        manifest = self.manifest()
        versions = sorted({p["v"] for p in manifest["parts"]})
        if not versions:
            return self.spark.createDataFrame([], ZONE_SCHEMA)
        live = self.spark.createDataFrame([(p["dir"],) for p in manifest["parts"]], "dir string")  # a row per partition
        return (self.spark.read.schema(ZONE_SCHEMA).parquet(*[f"{self.root}/zones/_commit={v}" for v in versions])
                .join(live, "dir", "left_semi"))

    # ---- writing ---------------------------------------------------------------

    def _conform(self, df: DataFrame) -> DataFrame:
        types = {f.name: f.dataType for f in df.schema}
        wrong = [f"{f.name} is {types[f.name].simpleString() if f.name in types else 'missing'}, not {f.dataType.simpleString()}"
                 for f in self.schema if types.get(f.name) != f.dataType]
        if wrong:
            raise TypeError(f"{self.root}: " + "; ".join(wrong))
        return df.select(*self.schema.names, *[c for c in ("_seq",) if c in types])

    def _policy(self, rule: str) -> str:
        return self.on_broken.get(rule, "fail")

    def _admit(self, rows: DataFrame, version: int) -> tuple[DataFrame, int]:
        """``rows`` without those whose nulls the contract rejects; these go to ``rejected/``."""
        rules = [c for c in self.not_null if self._policy(f"null_{c}") == "reject"]
        if not rules:
            return rows, 0
        bad = F.lit(False)
        for c in rules:
            bad = bad | F.col(c).isNull()
        seen, path = Observation(f"rejected-{version}"), f"{self.root}/rejected/_commit={version}"
        reasons = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(f"null_{c}")) for c in rules]), lambda x: x.isNotNull())
        (rows.where(bad).select(*self.schema.names, reasons.alias("reasons")).observe(seen, F.count(F.lit(1)).alias("n"))
         .write.parquet(path))
        if not (n := observed(seen, "n")["n"]):
            fs.delete_path(self.spark, path)
        return rows.where(~bad), n

    def _write_rows(self, rows: DataFrame, version: int, name: str, mode: str) -> dict[str, int]:
        """Write rows into ``data/_commit=<version>``; returns what was observed."""
        seen = Observation(name)
        rows = rows.select(*self.schema.names).observe(
            seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in self.not_null])
        by = self._directory()
        if self.grain:
            rows = rows.withColumn(by, F.trunc(self.partition_by, self.grain))
        rows = rows.hint("rebalance", by) if by else rows.hint("rebalance")
        if self.grain:
            rows = rows.sortWithinPartitions(by, self.partition_by)
        writer = (rows.write.mode(mode).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).option("parquet.block.size", ROW_GROUP_BYTES)
                  .option("compression", CODEC))
        (writer.partitionBy(by) if by else writer).parquet(f"{self.root}/data/_commit={version}")
        return observed(seen, "rows", *[f"null_{c}" for c in self.not_null])

    def _slices(self, rows: int) -> int:
        """In how many slices of the keys a merge of so many rows is written: it holds the shuffled rows of one slice at a time."""
        return min(MOST_SLICES, max(1, math.ceil(rows / SLICE_ROWS)))

    def _write(self, rows: DataFrame, version: int, slices: int = 1) -> tuple[list[dict], dict]:
        """Write ``data/_commit=<version>`` and its zones. Returns (partition entries, what was observed). ``slices``: rows go by
        so many slices of their keys, one after the other; the planner filters what ``rows`` are merged from."""
        path = f"{self.root}/data/_commit={version}"
        saw: dict[str, int] = {}
        for k in range(slices):
            mine = rows.where(F.pmod(F.xxhash64(*self.keys), F.lit(slices)) == k) if slices > 1 else rows
            for name, n in self._write_rows(mine, version, f"commit-{version}-{k}", "append" if k else "error").items():
                saw[name] = saw.get(name, 0) + n
        if not saw["rows"]:
            return [], saw
        back = self.spark.read.schema(self.schema).parquet(path)
        time = epoch_micros(F.col(self.event_time)) if self.event_time else F.lit(None).cast("bigint")
        within = F.regexp_extract("file", rf"/(data/_commit={version}(?:/[^/]+=[^/]*)?)/[^/]+$", 1)
        decode = lambda c: F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))
        files = back.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"), time.alias("t"))
        zones = files.groupBy("file", "bytes").agg(F.count(F.lit(1)).alias("rows"), F.min("t").alias("low"), F.max("t").alias("high"))
        zones.select(decode(within).alias("dir"), *ZONE_SCHEMA.names[1:]).write.parquet(f"{self.root}/zones/_commit={version}")
        per_dir = (self.spark.read.schema(ZONE_SCHEMA).parquet(f"{self.root}/zones/_commit={version}").groupBy("dir").agg(
            F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"),
            F.min("low").alias("lo"), F.max("high").alias("hi")).collect())  # a row per partition
        parts = [dict(r.asDict(), v=version, at=self._value(r["dir"])) for r in per_dir]
        if sum(p["rows"] for p in parts) != saw["rows"]:
            raise RuntimeError(f"{self.root}: {saw['rows']} rows went into the write, its files hold {sum(p['rows'] for p in parts)}")
        return parts, saw

    @staticmethod
    def _value(directory: str) -> str | None:
        """Partition value of a directory, as text: None is the null partition (or no partitioning)."""
        last = directory.rsplit("/", 1)[-1]
        if last.startswith("_commit=") or last.endswith(f"={NULL_PARTITION}"):
            return None
        return unquote(last.split("=", 1)[1])

    def _directory(self) -> str | None:
        """The column that names the directories."""
        return f"{self.partition_by}_{self.grain}" if self.grain else self.partition_by

    def _current(self) -> dict:
        """The current manifest, to commit upon: the table goes on with the grain that it has."""
        before = self.manifest()
        if before["version"]:
            self.grain = before.get("grain")
        return before

    def _at(self) -> Column:
        if not self.partition_by:
            return F.lit(None).cast("string")
        if self.grain:
            return F.trunc(self.partition_by, self.grain).cast("string")
        return F.nullif(F.col(self.partition_by).cast("string"), F.lit(""))

    def _check(self, saw: dict, version: int) -> dict[str, int]:
        """Rows per broken rule; raises, after deleting what was written, if one of them fails the commit."""
        broken = {k: n for k, n in saw.items() if k != "rows" and n}
        if fatal := {k: n for k, n in broken.items() if self._policy(k) == "fail"}:
            for sub in ("data", "keys", "zones", "rejected"):
                fs.delete_path(self.spark, f"{self.root}/{sub}/_commit={version}")
            raise ContractBroken(self.root, fatal)
        return broken

    def _entry(self, version: int, parts: list[dict], keys: dict, buckets: int, written: dict, properties: dict) -> dict:
        live = {str(p["v"]) for p in parts}
        return {"version": version, "schema": self.schema.jsonValue(), "keyed_by": self.keys, "partition_by": self.partition_by, "grain": self.grain,
                "event_time": self.event_time, "not_null": self.not_null, "on_broken": self.on_broken, "properties": properties, "parts": parts, "buckets": buckets, "keys": keys,
                "written": {v: n for v, n in written.items() if v in live}}

    def replace(self, rows: DataFrame, properties: dict | None = None, days_of: DataFrame | None = None, slices: int = 1) -> dict:
        """A new snapshot of ``rows`` alone: rows of null partition values and no rows at all included.
        ``days_of``: the staged rows that ``rows`` were made of, to count days; ``slices``: see :meth:`_write`."""
        version = self._next_version()
        if self.contract_grain:
            days = (rows if days_of is None else days_of).select(self.partition_by).distinct().limit(MOST_DAYS + 1).count()
            self.grain = self.contract_grain if days > MOST_DAYS else None
        rows, rejected = self._admit(self._conform(rows), version)
        parts, saw = self._write(rows, version, slices)
        buckets = self._bucket_count(saw["rows"])
        keys, repeated = self._build_keys(version, parts, buckets)
        broken = self._check(saw | {"repeated_keys": repeated}, version)
        self._publish(self._entry(version, parts, keys, buckets, {str(version): len(parts)}, properties or {}))
        return {"version": version, "rows": saw["rows"], "batch_rows": saw["rows"], "rejected": rejected, "broken": broken,
                "partitions_written": len(parts), "partitions_read": 0, "buckets_read": 0, "buckets": buckets}

    def merge(self, delta: DataFrame, order=None, keep: Column | None = None, properties: dict | None = None) -> dict:
        """Upsert ``delta`` by key (see :func:`upsert_keyed` for ``order`` and ties); rows that then fail
        ``keep`` leave the table. ``delta`` is read several times: stage it. ``batch_rows`` of the result
        are the delta's keys that stand in the table afterwards. ``properties``, small values kept in the
        manifest from commit to commit, change with it (and alone, if the delta has no rows)."""
        before = self._current()
        version = self._next_version()
        delta, rejected = self._admit(self._conform(delta), version)
        kept = F.lit(True) if keep is None else keep
        buckets = before["buckets"]
        at = F.struct(F.when(kept, self._at()).alias("at"), kept.alias("k"))
        asked_buckets, wanted, broken, n = self._asked(delta, buckets, at, version)
        if not before["parts"]:
            fresh = upsert_keyed(None, delta, self.keys, order).where(kept)
            return self.replace(fresh, before["properties"] | (properties or {}), delta, self._slices(n)) | {"rejected": rejected, "broken": broken}
        if not asked_buckets:
            return self._unchanged(before, rejected, properties)
        mine = delta.select(*self.keys).distinct()
        known = self._known(before, asked_buckets)
        located = [r[0] for r in known.join(mine, self._same_key(known, mine), "left_semi").select("_at").distinct().collect()]
        touched = {x["at"] for x in wanted if x["k"]} | set(located)
        if not touched:
            return self._unchanged(before, rejected, properties)
        anew = set(located) | (touched & self._crowded(before))
        old = [p for p in before["parts"] if p["at"] in anew]
        merged = upsert_keyed(self._open(before, old), delta, self.keys, order).where(kept)
        parts, saw = self._write(merged, version, self._slices(n + sum(p["rows"] for p in old)))
        written = before["written"] | {str(version): len(parts)}
        parts = [p for p in before["parts"] if p["at"] not in anew] + parts
        total = sum(p["rows"] for p in parts)
        if self._bucket_count(total) > 4 * buckets:  # outgrown: all keys once anew
            keys, batch = self._rebuild(version, parts, written, self._bucket_count(total), mine)
            buckets = self._bucket_count(total)
        else:
            keys, batch = self._move_keys(version, before, known, mine, asked_buckets)
        self._publish(self._entry(version, parts, keys, buckets, written, before["properties"] | (properties or {})))
        return {"version": version, "rows": saw["rows"], "batch_rows": batch, "rejected": rejected, "broken": broken,
                "partitions_written": len(touched), "partitions_read": len({p["at"] for p in old}), "buckets_read": len(asked_buckets), "buckets": buckets}

    @staticmethod
    def _crowded(manifest: dict) -> set:
        """Partitions with many more files than their bytes fill."""
        spare: dict[str | None, float] = {}
        for p in manifest["parts"]:
            spare[p["at"]] = spare.get(p["at"], 0) + p["files"] - p["bytes"] / FULL_FILE_BYTES
        return {at for at, n in spare.items() if n > MOST_FILES - 1}

    def _asked(self, delta: DataFrame, buckets: int, at: Column, version: int) -> tuple[list[int], list, dict[str, int], int]:
        """Buckets of ``delta``'s keys, where it wants its rows, its rows per broken rule, and all its rows, in one pass over
        the batch; raises before anything is written if a rule fails the commit."""
        rows = delta.select(self._bucket(buckets).alias("_bucket"), at.alias("_want"), *[F.col(c).isNull().alias(f"_null_{c}") for c in self.not_null])
        found = rows.agg(F.collect_set("_bucket").alias("buckets"), F.collect_set("_want").alias("want"), F.count(F.lit(1)).alias("rows"), *[
            F.count_if(f"_null_{c}").alias(f"null_{c}") for c in self.not_null]).first()  # a number per bucket, a value per partition
        broken = self._check({f"null_{c}": found[f"null_{c}"] for c in self.not_null}, version)
        return sorted(found["buckets"]), found["want"], broken, found["rows"]

    def _unchanged(self, before: dict, rejected: int, properties: dict | None = None) -> dict:
        if properties:
            self._publish(before | {"version": self._next_version(), "properties": before["properties"] | properties})
        return {"version": before["version"], "rows": 0, "batch_rows": 0, "rejected": rejected, "broken": {},
                "partitions_written": 0, "partitions_read": 0, "buckets_read": 0, "buckets": before["buckets"]}

    def insert(self, delta: DataFrame) -> dict:
        """Add the rows of ``delta`` whose key the table doesn't have (one row of a key that recurs);
        no partition is rewritten. ``delta`` is read several times: stage it."""
        before = self._current()
        version = self._next_version()
        delta, rejected = self._admit(self._conform(delta), version)
        fresh = upsert_keyed(None, delta, self.keys)
        asked, _, broken, _ = self._asked(delta, before["buckets"], F.lit(0), version)
        if not before["parts"]:
            return self.replace(fresh, before["properties"], delta) | {"rejected": rejected, "broken": broken}
        if not asked:
            return self._unchanged(before, rejected)
        known = self._known(before, asked)
        parts, saw = self._write(fresh.join(known, self._same_key(fresh, known), "left_anti"), version)
        if not parts:
            fs.delete_path(self.spark, f"{self.root}/data/_commit={version}")
            return self._unchanged(before, rejected)
        keys, batch = self._move_keys(version, before, known, None, asked)
        written = before["written"] | {str(version): len(parts)}
        self._publish(self._entry(version, before["parts"] + parts, keys, before["buckets"], written, before["properties"]))
        return {"version": version, "rows": saw["rows"], "batch_rows": batch, "rejected": rejected, "broken": broken,
                "partitions_written": len(parts), "partitions_read": 0, "buckets_read": len(asked), "buckets": before["buckets"]}

    def compact(self, threshold_mb: int = 128, target_mb: int = 128, apply: bool = True) -> list[dict]:
        """Rewrite, as one commit, the partitions of more files than their bytes fill whose files average
        under the threshold. One entry per partition under the threshold."""
        before, mb = self._current(), 1024 * 1024
        by_value: dict[str | None, list[dict]] = {}
        for p in before["parts"]:
            by_value.setdefault(p["at"], []).append(p)
        found, flagged = [], []
        for at, parts in sorted(by_value.items(), key=lambda x: str(x[0])):
            files, size, rows = (sum(p[c] for p in parts) for c in ("files", "bytes", "rows"))
            if size / files < threshold_mb * mb:
                need = files > max(1, math.ceil(size / (target_mb * mb)))
                flagged += [at] if need else []
                found.append({"partition": f"{self._directory()}={at}" if self.partition_by else "", "at": at, "file_count": files,
                              "total_bytes": size, "average_bytes": size // files, "needs_compaction": need, "rows_before": rows})
        after = {}
        if apply and flagged:
            version = self._next_version()
            parts, _ = self._write(self._open(before, [p for at in flagged for p in by_value[at]]), version)
            after = {p["at"]: p["rows"] for p in parts}
            if bad := [f["partition"] for f in found if f["at"] in flagged and f["rows_before"] != after.get(f["at"])]:
                raise RuntimeError(f"compaction changed row counts of {bad}")
            kept = [p for p in before["parts"] if p["at"] not in after]
            self._publish(self._entry(version, kept + parts, before["keys"], before["buckets"],
                                      before["written"] | {str(version): len(parts)}, before["properties"]))
        return [{k: v for k, v in f.items() if k != "at"} | {"compacted": f["at"] in after, "rows_after": after.get(f["at"])} for f in found]

    # ---- key locator -------------------------------------------------------------

    def _bucket_count(self, rows: int) -> int:
        need = max(1, math.ceil(rows / BUCKET_KEYS))
        return min(MOST_BUCKETS, max(LEAST_BUCKETS, 1 << (need - 1).bit_length()))

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("int")

    def _key_schema(self) -> T.StructType:
        return T.StructType([*(self.schema[k] for k in self.keys), T.StructField("_at", T.StringType())])

    def _same_key(self, a: DataFrame, b: DataFrame) -> Column:
        same = F.lit(True)
        for k in self.keys:
            same = same & a[k].eqNullSafe(b[k])
        return same

    def _known(self, manifest: dict, buckets: list[int]) -> DataFrame:
        """Keys and partitions of the given buckets."""
        dirs = [f"{self.root}/keys/_commit={manifest['keys'][str(b)]}/_bucket={b}" for b in buckets if str(b) in manifest["keys"]]
        if not dirs:
            return self.spark.createDataFrame([], self._key_schema())
        return self.spark.read.schema(self._key_schema()).parquet(*dirs)

    def _write_keys(self, rows: DataFrame, version: int, buckets: int, count: Column, once: bool = False) -> int:
        """Write (keys, _at) rows as ``keys/_commit=<version>``, each bucket sorted by key; ``once``: a row per key, after
        they moved to their bucket, whose ``_n`` counts its rows. Returns ``count`` over the rows."""
        seen = Observation(f"keys-{version}")
        rows = rows.withColumn("_bucket", self._bucket(buckets)).repartition("_bucket")
        if once:
            rows = rows.groupBy("_bucket", *self.keys).agg(F.min("_at").alias("_at"), F.count(F.lit(1)).alias("_n"))
        (rows.sortWithinPartitions("_bucket", *self.keys)
         .observe(seen, count.alias("n")).select(*self.keys, "_at", "_bucket")
         .write.option("compression", CODEC).partitionBy("_bucket").parquet(f"{self.root}/keys/_commit={version}"))
        return observed(seen, "n")["n"]

    def _buckets_of(self, version: int) -> dict[str, int]:
        names = fs.list_names(self.spark, f"{self.root}/keys/_commit={version}")
        return {n.split("=", 1)[1]: version for n in names if n.startswith("_bucket=")}

    def _build_keys(self, version: int, parts: list[dict], buckets: int) -> tuple[dict, int]:
        """Locator of a whole new snapshot: (bucket -> version, rows whose key came before)."""
        if not self.keys or not parts:
            return {}, 0
        rows = self.spark.read.schema(self.schema).parquet(f"{self.root}/data/_commit={version}")
        rows = rows.select(*self.keys, self._at().alias("_at"))
        repeated = self._write_keys(rows, version, buckets, F.sum(F.col("_n") - 1), once=True)
        return self._buckets_of(version), repeated

    def _rebuild(self, version: int, parts: list[dict], written: dict, buckets: int, mine: DataFrame) -> tuple[dict, int]:
        rows = self._open({"written": written}, parts).select(*self.keys, self._at().alias("_at"))
        asked = mine.withColumn("_mine", F.lit(1))
        tagged = rows.join(asked, self._same_key(rows, asked), "left").select(*[rows[k] for k in self.keys], "_at", "_mine")
        batch = self._write_keys(tagged, version, buckets, F.count("_mine"))
        return self._buckets_of(version), batch

    def _move_keys(self, version: int, before: dict, known: DataFrame, mine: DataFrame | None, asked: list[int]) -> tuple[dict, int]:
        """The asked buckets with the batch's keys where the commit has put them. ``mine`` are these keys;
        None: all rows of the commit are new ones."""
        moved = self.spark.createDataFrame([], self._key_schema())
        if fs.has_parquet(self.spark, f"{self.root}/data/_commit={version}"):
            moved = self.spark.read.schema(self.schema).parquet(f"{self.root}/data/_commit={version}").select(*self.keys, self._at().alias("_at"))
        stay = known
        if mine is not None:
            stay = known.join(mine, self._same_key(known, mine), "left_anti")
            moved = moved.join(mine, self._same_key(moved, mine), "left_semi")
        stay = stay.withColumn("_mine", F.lit(None).cast("int"))
        batch = self._write_keys(stay.unionByName(moved.withColumn("_mine", F.lit(1))), version, before["buckets"], F.count("_mine"))
        gone = {str(b) for b in asked}
        return {b: v for b, v in before["keys"].items() if b not in gone} | self._buckets_of(version), batch


ZONE_SCHEMA = T.StructType([T.StructField("dir", T.StringType()), T.StructField("file", T.StringType()),
                            *[T.StructField(c, T.LongType()) for c in ("bytes", "rows", "low", "high")]])


def read_lake(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """The current snapshot of a table of one of the contracts."""
    return LakeTable.of(spark, root, dataset).read()
