import hashlib
import math
import zlib

import pytest

from quayside.llm import sharding as S


def draw(doc, level, child, weight):
    digest = hashlib.md5(f"{'' if doc is None else doc}:{level}:{child}".encode()).hexdigest()
    return -math.log((int(digest[:13], 16) + 0.5) / 2**52) / weight


def plain(doc, weights, rack_shards=4, region_racks=2, extra=None):
    """Descend level by level; ``extra`` is the weight of a shard in a region of its own."""
    shards = list(range(len(weights)))
    racks = [shards[k:k + rack_shards] for k in range(0, len(shards), rack_shards)]
    regions = [list(range(k, min(k + region_racks, len(racks)))) for k in range(0, len(racks), region_racks)]
    if extra is not None:
        racks.append([len(weights)])
        regions.append([len(racks) - 1])
        weights = [*weights, extra]
    rack_weight = lambda c: sum(weights[s] for s in racks[c])
    region = min(range(len(regions)), key=lambda r: draw(doc, "region", r, sum(map(rack_weight, regions[r]))))
    rack = min(regions[region], key=lambda c: draw(doc, "rack", c, rack_weight(c)))
    return min(racks[rack], key=lambda s: draw(doc, "shard", s, weights[s]))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, ["same text", f"text {k} é"][k % 3 > 0]) for k in range(6000)] + [(None, None), (None, "x"), (5, "again"), (5, "again")]
    return spark.createDataFrame([(i, t, 0, "z") for i, t in rows], "doc_id long, text string, shard int, k string")


def test_places_slots_and_growth(docs):
    got = S.shard_rows(docs, 24, rows_per_block=300).collect()
    assert len(got) == 6004 and all(r.shard == plain(r.id, [1] * 24) for r in got)
    assert all(r.grown_shard == plain(r.id, [1] * 24, extra=1) for r in got)
    flat = [min(range(24), key=lambda s: draw(r.id, "shard", s, 1)) for r in got]
    assert sum(f != r.shard for f, r in zip(flat, got, strict=True)) > 3000  # the levels decide, not the leaves alone
    assert all(r.grown_shard in (r.shard, 24) for r in got) and any(r.grown_shard == 24 for r in got)
    for s in range(24):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots))) and abs(len(slots) - 250) < 100
    text = {r.doc_id: r.text for r in docs.where("doc_id > 5").collect()}
    for r in got:
        if r.id is not None and r.id > 5:
            raw = text[r.id].encode()
            assert (r["size"], r.text_crc32) == (len(raw) + 8, zlib.crc32(raw))
    assert sorted((r["size"], r.text_crc32) for r in got if r.id is None) == [(8, 0), (9, zlib.crc32(b"x"))]


def test_weights_move_rows_only_where_they_change(docs):
    even, more = [1.0] * 10, [1.0] * 9 + [4.0]
    shards = lambda w: {r.id: r.shard for r in S.shard_rows(docs, 10, w).collect()}
    before, after = shards(even), shards(more)
    assert all(after[k] == plain(k, more) for k in after)
    moved = [k for k in before if before[k] != after[k]]
    assert moved and all(after[k] in (8, 9) for k in moved)  # into the last region, the only one that weighs more
    assert all(after[k] == 9 for k in moved if before[k] in (8, 9))
    assert abs(sum(s == 9 for s in after.values()) / len(after) - 4 / 13) < 0.03
    assert abs(sum(s == 8 for s in after.values()) / len(after) - 1 / 13) < 0.02


def test_a_lighter_rack_keeps_other_subtrees(docs):
    """Racks of one shard each in two regions: rows leave shard 0's region and rack, nothing else moves."""
    shape = {"rack_shards": 1, "region_racks": 3}
    shards = lambda w: {r.id: r.shard for r in S.shard_rows(docs, 6, w, **shape).collect()}
    before, after = shards([1.0] * 6), shards([0.2] + [1.0] * 5)
    assert all(after[k] == plain(k, [0.2] + [1.0] * 5, 1, 3) for k in after)
    moved = [(before[k], after[k]) for k in before if before[k] != after[k]]
    assert moved and all(a < 3 for a, _ in moved) and all(a == 0 for a, z in moved if z < 3)


def test_a_row_repeated_often_is_written_in_pieces(spark):
    docs = spark.range(5000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "'same' AS text", "id AS slot").union(
        spark.range(50).selectExpr("id", "'x'", "id"))
    got = S.shard_rows(docs, 3, rows_per_block=300).collect()
    assert len(got) == 5050 and sum(r.id is None for r in got) == 5000
    for s in range(3):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))


def test_a_very_long_text(spark):
    text = "é" * 500_000
    (r,) = S.shard_rows(spark.createDataFrame([(1, text)], "doc_id long, text string"), 5).collect()
    assert (r["size"], r.text_crc32, r.slot) == (1_000_008, zlib.crc32(text.encode()), 0)


def test_arguments_and_empty_table(docs):
    for bad in ({"shards": 0}, {"shards": 2, "weights": [1.0]}, {"shards": 1, "weights": [0.0]}):
        with pytest.raises(ValueError):
            S.shard_rows(docs, **bad)
    assert S.shard_rows(docs.limit(0), 24).count() == 0
    assert {r.shard for r in S.shard_rows(docs, 1).collect()} == {0}
