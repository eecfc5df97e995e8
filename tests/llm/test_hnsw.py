import math
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from quayside.llm import hnsw as H


def plain(rows, least=0.98):
    def fine(v, lab):
        return lab is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    n = len(rows)
    near = [set() for _ in rows]
    u = [None if not fine(v, lab) else np.array(v, float) / np.linalg.norm(np.array(v, float)) for _, v, lab in rows]
    for a in range(n):
        for b in range(a):
            if u[a] is not None and u[b] is not None and rows[a][2] == rows[b][2] and len(u[a]) == len(u[b]) and u[a] @ u[b] >= least:
                near[a].add(b)
                near[b].add(a)
    out = []
    for k in range(n):
        seen, todo = set(), [k]
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += near[x]
        comp = min((rows[x][0] for x in seen if rows[x][0] is not None), default=None)
        out.append((rows[k][0], len(near[k]), comp, comp is not None and rows[k][0] == comp))
    return out


@pytest.fixture(scope="module")
def rows():
    r = np.random.default_rng(2)
    out, k = [], 0
    for lab in (1, 2, None):
        for _ in range(12):
            c = r.standard_normal(16)
            for _ in range(r.integers(1, 9)):
                out.append((k, (c + r.standard_normal(16) * r.choice([0, 0.03, 0.1, 0.3])).astype(np.float32).tolist(), lab))
                k += 1
    v = out[0][1]
    out += [(1000, None, 1), (1001, [], 1), (1002, [0.0] * 16, 1), (1003, [None] + v[1:], 1), (1004, [math.nan] + v[1:], 1),
            (1005, [math.inf] + v[1:], 1), (1006, v[:8], 1), (1007, v, None), (None, v, 1), (None, v, 1), (1008, [1e-38] * 16, 2),
            (1009, [3e38] * 16, 2), (1009, [3e38] * 16, 2)]
    return out


@pytest.mark.parametrize("capacity", [8192, 20])
def test_as_brute_force(spark, rows, capacity):
    df = spark.createDataFrame([(i, v, lab, "k", 1) for i, v, lab in rows],
                               "vec_id long, embedding array<float>, label int, key string, shard int")
    got = [tuple(x) for x in H.near_duplicates(df, capacity=capacity).collect()]
    assert sorted(got, key=repr) == sorted(plain(rows), key=repr)


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert H.near_duplicates(df).count() == 0


def test_graph_recall_in_scattered_and_dense_data():
    r = np.random.default_rng(3)
    centre = r.standard_normal(32)
    v = np.concatenate([r.standard_normal((1500, 32)), centre + 0.02 * r.standard_normal((300, 32))])
    ids = r.permutation(len(v))
    order = np.lexsort((ids, -H.levels(ids)))
    u = H.unit(v[order])
    graph = H.Graph.build(u.astype(np.float32), H.levels(ids[order]))
    assert len(graph.layers) > 1 and all((links < len(links)).all() for links in graph.layers)
    assert graph.audit(0.98) >= H.AUDIT_RECALL
    q, node = graph.links(u.astype(np.float32), 0.98)
    got, truth = set(zip(q.tolist(), node.tolist(), strict=True)), u.astype(np.float32) @ u.astype(np.float32).T >= 0.98
    assert len(got) >= 0.99 * truth.sum() and all(truth[a, b] for a, b in got)
    again = H.Graph.unpack(graph.x, graph.pack())
    assert again.beam == graph.beam and all((a == b).all() for a, b in zip(graph.layers, again.layers, strict=True))


@pytest.mark.parametrize("same", [False, True])
def test_two_shards_of_near_copies_meet_in_little_memory(same):
    n, r = 2048, np.random.default_rng(5)
    centre = r.standard_normal(16)

    def shard(k):
        x = centre + 0.02 * r.standard_normal((n, 16))
        x[:5] = r.standard_normal((5, 16))  # a few that link with nothing
        graph = H.Graph(H.unit(x).astype(np.float32), [np.full((n, H.LINKS), -1)], n)
        return x, pa.table({"shard": [k], "cid": [(2 * np.arange(n) + k).tobytes()], "n": [np.full(n, k + 1).tobytes()],
                            "x": [x.tobytes()], "graph": [graph.pack()]})

    (x, left), (y, right) = shard(0), shard(1)
    tracemalloc.start()
    try:
        got = H._meet(left, left if same else right, 0.98)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    near = H.unit(x) @ H.unit(x if same else y).T >= 0.98
    if same:
        np.fill_diagonal(near, False)
        want = dict(zip((2 * np.arange(n)).tolist(), near.sum(1).tolist(), strict=True))
    else:
        want = dict(zip((2 * np.arange(n)).tolist(), (2 * near.sum(1)).tolist(), strict=True))
        want |= dict(zip((2 * np.arange(n) + 1).tolist(), near.sum(0).tolist(), strict=True))
    assert dict(zip(*(got.column(c).to_pylist() for c in ("cid", "links")), strict=True)) == {k: v for k, v in want.items() if v}
    assert set(got.column("hub").to_pylist()) == {10}
    assert peak < 150e6


def test_long_vectors_make_smaller_shards(spark):
    sizes = spark.createDataFrame([(1,), (64,), (256,), (1024,), (4096,), (100_000,)], "size int")
    got = {r.size: r.n for r in sizes.select("size", H.shard_size(sizes["size"], H.CAPACITY).alias("n")).collect()}
    assert got == {1: 8192, 64: 8192, 256: 8192, 1024: 2048, 4096: 512, 100_000: 256}
    assert {r.n for r in sizes.select(H.shard_size(sizes["size"], 20).alias("n")).collect()} == {20}


def test_a_shard_that_fails_its_audit_fails_the_job(monkeypatch):
    x = np.random.default_rng(3).standard_normal((40, 8))
    group = pa.table({"label": [1] * 40, "size": pa.array([8] * 40, pa.int32()), "shard": pa.array([0] * 40, pa.int32()),
                      "cid": np.arange(40), "n": np.ones(40, np.int64), "vector": x.tolist()})
    assert H._build(group, 0.98).column("recall")[0].as_py() >= H.AUDIT_RECALL
    monkeypatch.setattr(H.Graph, "audit", lambda self, least: 0.98)
    with pytest.raises(RuntimeError, match="recall"):
        H._build(group, 0.98)
