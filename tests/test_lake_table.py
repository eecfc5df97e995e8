"""Snapshots, crashes, the key locator, zones and the contract gate."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.sinks import lake_table as lt
from quayside.sinks import lake_write as fs

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.StringType()),
                       T.StructField("t", T.TimestampNTZType()), T.StructField("d", T.DateType())])


def day(n):
    return None if n is None else dt.date(2025, 3, n)


def frame(spark, *rows):
    """(key, value, ingest day[, event day])"""
    return spark.createDataFrame([(r[0], r[1], None if r[-1] is None else dt.datetime(2025, 3, r[-1], 12), day(r[2])) for r in rows], SCHEMA)


def content(table):
    return sorted(((r.k, r.v, r.d and r.d.day) for r in table.read().collect()), key=str)


@pytest.fixture
def table(spark, scratch):
    return lt.LakeTable(spark, scratch("table"), SCHEMA, ["k"], "d", "t", ["k"])


def test_a_snapshot_has_null_partitions_and_no_rows_too(spark, table):
    assert not table.exists() and table.read().count() == 0
    first = table.replace(frame(spark, ("a", "1", 1), ("b", "1", None), ("c", "1", 2)))
    assert (first["rows"], first["partitions_written"]) == (3, 3)
    assert content(table) == [("a", "1", 1), ("b", "1", None), ("c", "1", 2)]
    table.replace(frame(spark, ("z", "2", None)))
    assert content(table) == [("z", "2", None)]
    table.replace(frame(spark, ("z", "2", 1)).where("false"))
    assert table.exists() and content(table) == [] and table.read().schema.names == SCHEMA.names
    table.merge(frame(spark, ("q", "1", None)))
    assert content(table) == [("q", "1", None)]


def test_a_merge_moves_evicts_and_leaves_other_partitions_alone(spark, table):
    table.replace(frame(spark, ("a", "1", 1), ("b", "1", 1), ("c", "1", 2), ("n", "1", None), ("x", "1", 5)))
    untouched = {p["dir"] for p in table.manifest()["parts"] if p["at"] in ("2025-03-02", "2025-03-05")}
    done = table.merge(frame(spark, ("a", "2", 3), ("b", "2", 3), ("n", "2", 4)))
    assert content(table) == [("a", "2", 3), ("b", "2", 3), ("c", "1", 2), ("n", "2", 4), ("x", "1", 5)]
    parts = table.manifest()["parts"]
    assert untouched <= {p["dir"] for p in parts} and {p["at"] for p in parts} == {f"2025-03-0{k}" for k in (2, 3, 4, 5)}
    assert (done["partitions_read"], done["batch_rows"]) == (2, 3)
    assert table.merge(frame(spark, ("x", "3", 6), ("new", "3", 6)), keep=F.col("v") != "3")["batch_rows"] == 0
    assert content(table) == [("a", "2", 3), ("b", "2", 3), ("c", "1", 2), ("n", "2", 4)]


def test_merges_in_any_order_are_one_upsert(spark, table):
    import random
    r = random.Random(4)
    want = {}
    for batch in range(6):
        rows = {f"k{r.randrange(30)}": (f"v{batch}", r.choice([1, 2, 3, None])) for _ in range(12)}
        drop = batch == 4
        table.merge(frame(spark, *[(k, v, d) for k, (v, d) in rows.items()]), keep=F.col("v") != "v4")
        want |= rows
        want = {k: x for k, x in want.items() if not (drop and k in rows)}
        assert content(table) == sorted(((k, v, d) for k, (v, d) in want.items()), key=str)


def test_a_small_batch_reads_its_buckets_and_no_other_partition(spark, table):
    rows = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("k"), F.lit("1").alias("v"),
                                    F.lit("2025-03-01 00:00:00").cast("timestamp_ntz").alias("t"),
                                    F.date_add(F.lit("2025-03-01").cast("date"), (F.col("id") % 20).cast("int")).alias("d"))
    table.replace(rows)
    manifest = table.manifest()
    assert manifest["buckets"] == 16 == len(manifest["keys"])
    known = table._known(manifest, [3]).inputFiles()
    assert known and all("_bucket=3/" in f for f in known)
    opened = []
    real = table._open
    table._open = lambda m, parts: opened.append([p["at"] for p in parts]) or real(m, parts)
    done = table.merge(frame(spark, ("k7", "2", 30)))
    assert (done["buckets_read"], done["partitions_read"], opened) == (1, 1, [["2025-03-08"]])
    table._open = real
    after = table.manifest()
    assert sum(v == done["version"] for v in after["keys"].values()) == 1  # one bucket written anew
    assert table.read().count() == 4000 and [r.v for r in table.read().where("k = 'k7'").collect()] == ["2"]


def test_the_locator_grows_with_the_table(spark, table, monkeypatch):
    monkeypatch.setattr(lt, "BUCKET_KEYS", 1)
    table.replace(frame(spark, ("a", "1", 1), ("b", "1", 2)))
    table.merge(spark.range(200).select(F.col("id").cast("string").alias("k"), F.lit("2").alias("v"),
                                        F.lit("2025-03-01 00:00:00").cast("timestamp_ntz").alias("t"), F.lit("2025-03-03").cast("date").alias("d")))
    assert table.manifest()["buckets"] == 256
    done = table.merge(frame(spark, ("a", "3", 9), ("7", "3", 9)))
    assert done["batch_rows"] == 2 and table.read().count() == 202 == table.read().select("k").distinct().count()


STEPS = ["write_text", "rename_path", "delete_path"]


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("what", ["replace", "merge"])
def test_a_crash_between_any_steps_leaves_the_old_or_the_new_table(spark, scratch, monkeypatch, step, what):
    """Every call of a storage step is made to fail in turn, until a commit gets through."""
    table = lt.LakeTable(spark, scratch("crash"), SCHEMA, ["k"], "d", "t")
    table.replace(frame(spark, ("0", "x", 9)))
    table.replace(frame(spark, ("a", "1", 1), ("b", "1", None)))
    old = content(table)
    delta = frame(spark, ("a", "2", None), ("c", "2", 1))
    new = [("a", "2", None), ("c", "2", 1)] if what == "replace" else [("a", "2", None), ("b", "1", None), ("c", "2", 1)]
    real, fail_at, seen = getattr(fs, step), 1, set()
    while fail_at < 20:
        calls = []

        def fails(*a, calls=calls, fail_at=fail_at):
            calls.append(a)
            if len(calls) == fail_at:
                raise OSError("crash")
            return real(*a)

        monkeypatch.setattr(fs, step, fails)
        try:
            getattr(table, what)(delta)
            crashed = False
        except OSError:
            crashed = True
        monkeypatch.setattr(fs, step, real)
        got = content(table)
        assert got in (old, new)
        seen.add(got == new)
        if not crashed:
            break
        if got == new:  # the commit was out: go back for the next crash
            table.replace(frame(spark, ("0", "x", 9)))
            table.replace(frame(spark, ("a", "1", 1), ("b", "1", None)))
        fail_at += 1
    assert not crashed and content(table) == new and len(calls) < fail_at
    kept = [f"{table.root}/{p['dir']}" for p in table.manifest()["parts"]]
    assert all(fs.path_exists(spark, d) for d in kept)


def test_what_a_crash_left_is_cleaned_by_the_next_commit(spark, table, monkeypatch):
    table.replace(frame(spark, ("a", "1", 1)))
    monkeypatch.setattr(fs, "rename_path", lambda *a: False)
    with pytest.raises(RuntimeError):
        table.replace(frame(spark, ("b", "1", 2)))
    monkeypatch.undo()
    assert table._versions("data") == [1, 2]
    table.merge(frame(spark, ("c", "1", 3)))
    assert table._versions("data") == [1, 3] and content(table) == [("a", "1", 1), ("c", "1", 3)]


def test_readers_of_the_previous_snapshot_keep_their_files(spark, table):
    table.replace(frame(spark, ("a", "1", 1)))
    before = table.read()
    table.replace(frame(spark, ("b", "1", 1)))
    assert [r.k for r in before.collect()] == ["a"] and content(table) == [("b", "1", 1)]
    assert [r.k for r in table.read(version=1).collect()] == ["a"]


def test_a_broken_contract_changes_nothing(spark, table, scratch):
    table.replace(frame(spark, ("a", "1", 1)))
    before = table.manifest()
    for act, broken in ((lambda: table.merge(frame(spark, (None, "2", 1), ("b", "2", 2))), {"null_k": 1}),
                        (lambda: table.replace(frame(spark, ("q", "1", 1), ("q", "2", 2), ("r", "1", 1))), {"repeated_keys": 1}),
                        (lambda: table.insert(frame(spark, (None, "2", 1))), {"null_k": 1})):
        with pytest.raises(lt.ContractBroken) as e:
            act()
        assert e.value.broken == broken and table.manifest() == before and content(table) == [("a", "1", 1)]
    for bad in (frame(spark, ("a", "2", 1)).drop("v"), frame(spark, ("a", "2", 1)).withColumn("v", F.lit(1))):
        with pytest.raises(TypeError):
            table.merge(bad)
    lenient = lt.LakeTable(spark, scratch("lenient"), SCHEMA, ["k"], "d", "t", ["k", "v"], {"null_k": "reject", "null_v": "warn"})
    done = lenient.replace(frame(spark, (None, "2", 1), ("b", None, 2), ("c", "1", 2)))
    assert (done["rows"], done["rejected"], done["broken"]) == (2, 1, {"null_v": 1})
    gone = spark.read.parquet(f"{lenient.root}/rejected/_commit=1").collect()
    assert [(r.k, r.v, r.reasons) for r in gone] == [(None, "2", ["null_k"])]
    assert content(lenient) == [("b", None, 2), ("c", "1", 2)]


def test_inserts_ignore_known_keys_and_rewrite_nothing(spark, table):
    assert table.insert(frame(spark, ("a", "1", 1), ("a", "2", 2)))["rows"] == 1
    first = content(table)
    dirs = {p["dir"] for p in table.manifest()["parts"]}
    done = table.insert(frame(spark, ("a", "9", 1), ("b", "9", 1), ("c", "9", None)))
    assert done["batch_rows"] == 2 and dirs <= {p["dir"] for p in table.manifest()["parts"]}
    assert content(table) == sorted([*first, ("b", "9", 1), ("c", "9", None)], key=str)
    assert table.insert(frame(spark, ("b", "0", 5)))["batch_rows"] == 0
    assert table.merge(frame(spark, ("b", "2", 5)))["batch_rows"] == 1 and ("b", "2", 5) in content(table)


def test_compaction_is_one_commit_and_keeps_rows(spark, table):
    for k in range(5):
        table.insert(frame(spark, (f"k{k}", "1", 1), (f"j{k}", "1", 1 + k), (f"n{k}", "1", None)))
    before, listed = content(table), table.compact(apply=False)
    assert {x["partition"]: x["file_count"] for x in listed if x["needs_compaction"]} == {"d=2025-03-01": 5, "d=None": 5}
    assert all(not x["compacted"] for x in listed)
    done = [x for x in table.compact() if x["compacted"]]
    assert len(done) == 2 and all(x["rows_before"] == x["rows_after"] for x in done)
    assert content(table) == before and not any(x["needs_compaction"] for x in table.compact())
    assert table.merge(frame(spark, ("k1", "2", 2)))["batch_rows"] == 1 and len(content(table)) == len(before)


def test_a_time_range_opens_only_the_partitions_that_can_hold_it(spark, table):
    """Rows that came in a day or more after their event: the zones go by the event."""
    table.replace(frame(spark, ("a", "1", 10, 1), ("b", "1", 10, 9), ("c", "1", 11, 10), ("e", "1", 12, 20), ("n", "1", None, None)))
    low, high = dt.datetime(2025, 3, 9), dt.datetime(2025, 3, 11)
    got = table.read(low, high)
    assert sorted(r.k for r in got.collect()) == ["b", "c"]
    assert {f.split("/d=")[1].split("/")[0] for f in got.inputFiles()} == {"2025-03-10", "2025-03-11"}
    assert table.read(dt.datetime(2025, 3, 21), dt.datetime(2025, 3, 30)).count() == 0
    zones = {(r.dir.split("=")[-1], r.rows) for r in table.zones().collect()}
    assert zones == {("2025-03-10", 2), ("2025-03-11", 1), ("2025-03-12", 1), (lt.NULL_PARTITION, 1)}
    assert table.read(dt.datetime(2025, 3, 9, 12), dt.datetime(2025, 3, 9, 12, 0, 0, 1)).count() == 1
    assert table.read(dt.datetime(2025, 3, 9), dt.datetime(2025, 3, 9, 12)).count() == 0


def test_partition_texts_with_special_characters(spark, scratch):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("p", T.StringType())])
    table = lt.LakeTable(spark, scratch("odd"), schema, ["k"], "p")
    texts = ["a b", "x/y:z", "100%", "ü+é", "q=1", None, "", "a%20b"]
    table.replace(spark.createDataFrame(list(enumerate(texts)), schema))
    rows = lambda: sorted(((r.k, r.p) for r in table.read().collect()), key=str)
    assert rows() == sorted(((k, t or None) for k, t in enumerate(texts)), key=str)
    table.merge(spark.createDataFrame([(0, "x/y:z"), (6, "100%"), (99, "")], schema))
    want = {k: t or None for k, t in enumerate(texts)} | {0: "x/y:z", 6: "100%", 99: None}
    assert rows() == sorted(want.items(), key=str)
    assert lt.LakeTable.opened(spark, table.root).read().count() == 9


def months(spark, scratch):
    return lt.LakeTable(spark, scratch("months"), SCHEMA, ["k"], "d", "t", ["k"], grain="month")


def test_a_table_by_month_has_a_directory_a_month_and_keeps_the_days(spark, scratch):
    table = months(spark, scratch)
    rows = spark.range(300).select(F.concat(F.lit("k"), "id").alias("k"), F.lit("1").alias("v"),
                                   F.lit("2025-03-01 00:00:00").cast("timestamp_ntz").alias("t"),
                                   F.date_add(F.lit("2025-03-01").cast("date"), (F.col("id") % 60).cast("int")).alias("d"))
    table.replace(rows.unionByName(frame(spark, ("none", "1", None))))
    assert {p["at"] for p in table.manifest()["parts"]} == {"2025-03-01", "2025-04-01", None}
    assert table.read().select("d").distinct().count() == 61
    done = table.merge(frame(spark, ("k0", "2", 9), ("none", "2", 3), ("new", "2", 2)))
    assert (done["partitions_read"], done["batch_rows"]) == (2, 3)  # April isn't touched
    got = {r.k: (r.v, r.d) for r in table.read().collect()}
    assert len(got) == 302 and got["k0"] == ("2", day(9)) and got["none"] == ("2", day(3))
    assert lt.LakeTable.opened(spark, table.root).grain == "month"
    by_day = lt.LakeTable(spark, table.root, SCHEMA, ["k"], "d", "t", ["k"])  # goes on by month, as the table is
    assert by_day.merge(frame(spark, ("k1", "3", 2)))["batch_rows"] == 1 and table.read().count() == 302
    assert {p["at"] for p in table.manifest()["parts"]} == {"2025-03-01", "2025-04-01"}


def test_new_keys_rewrite_no_partition_until_it_has_many_files(spark, table):
    table.replace(frame(spark, ("a", "1", 1)))
    for n in range(lt.MOST_FILES):
        done = table.merge(frame(spark, (f"n{n}", "1", 1)))
        assert (done["partitions_read"], done["batch_rows"]) == (n // (lt.MOST_FILES - 1), 1)
    assert len(content(table)) == 1 + lt.MOST_FILES and len(table.manifest()["parts"]) == 1
    assert table.merge(frame(spark, ("a", "2", 1)))["partitions_read"] == 1 and ("a", "2", 1) in content(table)


def test_long_feeds_have_few_directories(spark, scratch):
    """Payments, transactions and their quarantine: some 2,500 days each in the fixtures."""
    for dataset in ("payments", "transactions", "quarantine_transactions"):
        assert lt.LakeTable.of(spark, scratch(dataset), dataset)._directory().endswith("_date_month")


def test_the_locator_of_a_new_snapshot_counts_repeated_keys_and_files_are_zstd(spark, scratch):
    """The locator of a new snapshot: a row per key, null too, at the least of its partitions."""
    table = lt.LakeTable(spark, scratch("once"), SCHEMA, ["k"], "d", "t", on_broken={"repeated_keys": "warn"})
    done = table.replace(frame(spark, ("a", "1", 2), ("a", "2", 1), ("a", "3", 3), (None, "1", 4), (None, "2", 4), ("b", "1", None)))
    assert (done["rows"], done["broken"]) == (6, {"repeated_keys": 3})
    keys = spark.read.parquet(f"{table.root}/keys/_commit=1")
    assert sorted(((r.k, r._at) for r in keys.collect()), key=str) == [("a", "2025-03-01"), ("b", None), (None, "2025-03-04")]
    for frame_read in (keys, spark.read.parquet(f"{table.root}/data/_commit=1"), fs.stage(table.read(), "tight")):
        assert frame_read.inputFiles() and all(f.endswith(".zstd.parquet") for f in frame_read.inputFiles())


def test_the_locator_of_a_new_snapshot_is_grouped_after_its_only_shuffle(spark, scratch, monkeypatch):
    sc, write, stages = spark.sparkContext, lt.LakeTable._write_keys, set()

    def watched(self, *args, **kwargs):
        sc.setJobGroup("locator", "the keys of one commit")
        out, jobs = write(self, *args, **kwargs), sc.statusTracker()
        stages.update(s for j in jobs.getJobIdsForGroup("locator") for s in jobs.getJobInfo(j).stageIds)
        sc.setLocalProperty("spark.jobGroup.id", None)
        return out

    monkeypatch.setattr(lt.LakeTable, "_write_keys", watched)
    lt.LakeTable(spark, scratch("moved"), SCHEMA, ["k"], "d", "t", ["k"]).replace(frame(spark, *[(f"k{i}", "1", 1 + i % 5) for i in range(50)]))
    assert 0 < len(stages) <= 3  # the map side, and the write, whose job names the map side again


def test_a_large_merge_goes_by_slices_of_its_keys(spark, scratch, monkeypatch):
    """Each slice is merged by itself, so that is what is shuffled at a time; rows, keys and contract are as without."""
    old = [(f"k{i}" if i else None, "1", 1 + i % 3) for i in range(60)] + [("n", "1", None)]
    new = [(f"k{i}" if i else None, "2", 1 + i % 4) for i in range(0, 90, 2)] + [("n", "2", 3), ("m", "2", None), ("k2", "3", 2)]
    write, wrote = lt.LakeTable._write_rows, []

    def watched(self, *args, **kwargs):
        wrote.append(write(self, *args, **kwargs)["rows"])
        return {"rows": wrote[-1]}

    monkeypatch.setattr(lt.LakeTable, "_write_rows", watched)

    def merged(name, slice_rows, many):
        monkeypatch.setattr(lt, "SLICE_ROWS", slice_rows)
        table = lt.LakeTable(spark, scratch(name), SCHEMA, ["k"], "d", "t")
        done = [table.merge(frame(spark, *rows), [F.col("v")], keep=F.coalesce(F.col("k") != "k4", F.lit(True))) for rows in (old, new)]
        assert len(wrote) == many
        one, each = done[1], list(wrote)
        wrote.clear()
        return content(table), sorted(map(str, table._known(table.manifest(), range(lt.LEAST_BUCKETS)).collect())), \
            [{k: x for k, x in d.items() if k not in ("version", "partitions_read")} for d in done], one, each

    whole, sliced = merged("whole", 1000, 2), merged("sliced", 40, 2 + 3)
    assert whole[:3] == sliced[:3] and len(whole[0]) > 70
    assert max(sliced[4]) < 60 and sum(sliced[4]) == sum(whole[4])
    assert lt.LakeTable(spark, scratch("none"), SCHEMA, ["k"])._slices(10 ** 9) == lt.MOST_SLICES


def test_a_slice_filters_what_a_merge_reads(spark, scratch):
    both = fs.upsert_keyed(fs.stage(frame(spark, ("a", "1", 1)), "old"), fs.stage(frame(spark, ("a", "2", 1)), "new"), ["k"])
    plan = both.where(F.pmod(F.xxhash64("k"), F.lit(3)) == 1)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("pmod(xxhash64(k") == 2 and plan.rindex("Window [") < plan.index("pmod(xxhash64(k")
