"""Embedding near-dedup with one hierarchical navigable small-world graph a shard.

1. Equal vectors of a label become one class first, however many rows have them.
2. Classes of a label (and length) are dealt by hash to shards of about ``capacity``, or
   of fewer where the vectors are so long that they would fill ``SHARD_BYTES`` before.
   Each shard builds its graph in one task: layers of geometrically fewer nodes, every
   node linked to near and diverse neighbours, searched with a beam from the layer above.
3. Audit: for a sample of the shard's vectors what the beam links is held against all of
   the shard, and so is a link planted at the least cosine for each; the beam is doubled
   until the recall passes, in the end to the whole shard. The graph carries that beam.
   A shard whose audit doesn't pass even so fails the job rather than lose links.
4. Every class queries every shard of its label, shard by shard as blocks: the task of
   two shards searches both ways. A query whose beam is full of links is repeated with a
   wider beam. What is found is verified by cosine in double precision.
5. A task returns per class the number of rows linked to it and one edge to the least of
   its component there; components of all those edges follow. It never holds the pairs
   either: blocks of ``SIDE`` classes are searched, verified and dropped, and a bit for
   each pair of the two shards keeps those found from both sides from counting twice.

The work is classes x (label's classes / capacity) searches of logarithmic length; a
capacity is chosen by the memory of a task, not by the data.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.common import Scratch, pick
from quayside.llm.components import connected_components, least_of_component
from quayside.llm.decontam import small

CAPACITY = 8192
#: Bytes of the vectors of a shard in double precision; fewer vectors than LEAST_CAPACITY are no shard.
SHARD_BYTES, LEAST_CAPACITY = 16 << 20, 256
#: Links a node may have below (half of them its own choice) and above; beams; nodes expanded at a time.
LINKS, UPPER_LINKS, BUILD_BEAM, FIRST_BEAM, EXPAND = 24, 12, 48, 32, 4
#: A beam that has to be wider than this is as wide as the shard.
WIDEST = 256
#: Vectors audited a shard, recall asked for.
AUDIT, AUDIT_RECALL = 256, 0.99
#: Queries that search side by side; double and single precision differ by less than SLACK.
SIDE, SLACK = 512, 1e-4


def search(x: np.ndarray, links: np.ndarray, q: np.ndarray, entry: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Beam search of a layer: (nodes, similarities), best first, -1 where the beam
    isn't full. ``entry``: (queries, some) nodes to begin at."""
    n, rows = len(q), np.arange(len(q))[:, None]
    seen = np.zeros((n, len(links)), dtype=bool)
    seen[rows, entry] = True
    node = np.full((n, beam), -1, dtype=np.int64)
    sim = np.full((n, beam), -np.inf, dtype=np.float32)
    open_ = np.zeros((n, beam), dtype=bool)
    k = min(beam, entry.shape[1])
    first = np.einsum("qmd,qd->qm", x[entry], q)
    best = np.argsort(-first, axis=1, kind="stable")[:, :k]
    node[:, :k], sim[:, :k] = np.take_along_axis(entry, best, 1), np.take_along_axis(first, best, 1)
    open_[:, :k] = True
    open_[:, 1:k] &= node[:, 1:k] != node[:, :k - 1]
    live = np.arange(n)
    while len(live):
        o = open_[live]
        rank = np.cumsum(o, axis=1)
        take = o & (rank <= EXPAND)
        r, c = np.nonzero(take)
        open_[live[r], c] = False
        near = np.full((len(live), EXPAND, links.shape[1]), -1, dtype=np.int64)
        near[r, rank[r, c] - 1] = links[node[live[r], c]]
        near = np.sort(near.reshape(len(live), -1), axis=1)
        fresh = near >= 0
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        fresh &= ~seen[live[:, None], np.maximum(near, 0)]
        r, c = np.nonzero(fresh)
        seen[live[r], near[r, c]] = True
        s = np.full(near.shape, -np.inf, dtype=np.float32)
        s[r, c] = np.einsum("md,md->m", x[near[r, c]], q[live[r]])
        both = np.concatenate([sim[live], s], axis=1)
        top = np.argsort(-both, axis=1, kind="stable")[:, :beam]
        sim[live] = np.take_along_axis(both, top, 1)
        node[live] = np.take_along_axis(np.concatenate([node[live], np.where(fresh, near, -1)], axis=1), top, 1)
        open_[live] = np.take_along_axis(np.concatenate([open_[live], fresh], axis=1), top, 1) & (sim[live] > -np.inf)
        live = live[open_[live].any(1)]
    return node, sim


def diverse(x: np.ndarray, node: np.ndarray, sim: np.ndarray, most: int) -> np.ndarray:
    """Of each row's candidates (best first), up to ``most``: those nearer to the row's
    own vector than to any chosen before, then the nearest of the rest; -1 fills."""
    n, c = node.shape
    between = np.einsum("qcd,qed->qce", x[np.maximum(node, 0)], x[np.maximum(node, 0)])
    chosen = np.zeros((n, c), dtype=bool)
    for k in range(c):
        clash = (chosen & (between[:, k, :] > sim[:, k, None])).any(1)
        chosen[:, k] = (node[:, k] >= 0) & ~clash & (chosen.sum(1) < most)
    order = np.argsort(np.where(node < 0, 2, ~chosen), axis=1, kind="stable")[:, :most]
    out = np.full((n, most), -1, dtype=np.int64)
    out[:, :order.shape[1]] = np.take_along_axis(node, order, 1)
    return out


class Graph:
    """Unit vectors ``x`` in the order of their layers (highest first), ``layers``
    (base first) of links, and the beam that passed the audit."""

    def __init__(self, x: np.ndarray, layers: list[np.ndarray], beam: int = FIRST_BEAM):
        self.x, self.layers, self.beam = x, layers, beam

    @classmethod
    def build(cls, x: np.ndarray, level: np.ndarray) -> Graph:
        """``level`` of each vector, not rising."""
        sizes = [int((level >= k).sum()) for k in range(int(level[0]) + 1)]
        graph = cls(x, [])
        for k in range(len(sizes) - 1, -1, -1):
            graph.layers.insert(0, graph.layer(sizes[k], LINKS if k == 0 else UPPER_LINKS))
        return graph

    def layer(self, n: int, width: int) -> np.ndarray:
        """Links of the first n vectors, added in batches that at most double."""
        x, half = self.x, width // 2
        links = np.full((n, width), -1, dtype=np.int64)
        strength = np.full((n, width), -np.inf, dtype=np.float32)
        done = 0
        while done < n:
            stop = min(n, done + min(max(64, done), 2 * SIDE))
            new = np.arange(done, stop)
            among = x[new] @ x[new].T
            np.fill_diagonal(among, -np.inf)
            few = min(half, len(new) - 1)
            near = np.argsort(-among, axis=1, kind="stable")[:, :few]
            node, sim = new[near], np.take_along_axis(among, near, 1)
            if done:
                found = [self.reach(links[:done], x[new[a:a + SIDE]], min(BUILD_BEAM, done), done)
                         for a in range(0, len(new), SIDE)]
                node = np.concatenate([np.concatenate([f[0] for f in found]), node], axis=1)
                sim = np.concatenate([np.concatenate([f[1] for f in found]), sim], axis=1)
                order = np.argsort(-sim, axis=1, kind="stable")
                node, sim = np.take_along_axis(node, order, 1), np.take_along_axis(sim, order, 1)
            if node.shape[1]:
                own = diverse(x, node, sim, half)
                links[new, :half] = own
                r, c = np.nonzero(own >= 0)
                to, who = own[r, c], new[r]
                self.back(links, strength, to, who, np.einsum("md,md->m", x[to], x[who]), half)
            done = stop
        return links

    @staticmethod
    def back(links: np.ndarray, strength: np.ndarray, to: np.ndarray, who: np.ndarray, sim: np.ndarray, half: int) -> None:
        """Links from ``to`` back to ``who`` in the second half of the places, the strongest stay."""
        at, c = np.nonzero(strength[:, half:] > -np.inf)
        at, c = at[np.isin(at, to)], c[np.isin(at, to)]
        to = np.concatenate([at, to])
        sim = np.concatenate([strength[at, half + c], sim])
        who = np.concatenate([links[at, half + c], who])
        order = np.lexsort((who, -sim, to))
        to, who, sim = to[order], who[order], sim[order]
        first = np.flatnonzero(np.diff(to, prepend=-1))
        place = np.arange(len(to)) - np.repeat(first, np.diff(np.append(first, len(to))))
        ok = place < links.shape[1] - half
        links[to[ok], half + place[ok]], strength[to[ok], half + place[ok]] = who[ok], sim[ok]

    def reach(self, base: np.ndarray, q: np.ndarray, beam: int, below: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Search ``base`` from what the layers above it lead to (nodes under ``below``)."""
        entry = np.zeros((len(q), 1), dtype=np.int64)
        above = self.layers if below is not None else self.layers[1:]
        for links in reversed(above):
            entry, _ = search(self.x, links, q, np.maximum(entry, 0), 4)
            entry = np.where(entry < 0, entry[:, :1], entry)
        if below is not None:
            entry = np.where(entry < below, entry, 0)
        return search(self.x, base, q, entry, beam)

    def audit(self, least: float) -> float:
        """Widen ``beam`` until the recall passes; that recall. Asked are the shard's own
        links of a sample of its vectors, and a planted one for each: a query turned away
        from the vector by the largest angle that still links must find it."""
        some = np.unique(np.linspace(0, len(self.x) - 1, min(AUDIT, len(self.x))).astype(int))
        q = self.x[some].astype(np.float64)
        turn = np.random.default_rng(1).standard_normal(q.shape)
        turn -= (turn * q).sum(1, keepdims=True) * q
        norm = np.sqrt((turn * turn).sum(1, keepdims=True))
        away = np.divide(turn, norm, out=np.zeros_like(turn), where=norm > 1e-9)
        cos = least + SLACK
        away = np.where(norm > 1e-9, cos * q + np.sqrt(1 - cos * cos) * away, q).astype(np.float32)
        q = np.concatenate([self.x[some], away])
        truth = q @ self.x.T >= least
        self.beam = min(self.beam, len(self.x))
        while True:
            r, c = self.links(q, least)
            got = np.zeros_like(truth)
            got[r, c] = True
            planted = got[len(some) + np.arange(len(some)), some].mean()
            recall = float(min(planted, (got & truth).sum() / max(1, truth.sum())))
            if recall >= AUDIT_RECALL or self.beam >= len(self.x):
                return recall
            self.beam = 2 * self.beam if self.beam < WIDEST else len(self.x)

    def links(self, q: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) of all found with a similarity of ``least`` or more. Beams that
        hold nothing else are widened, in the end to the whole shard."""
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for a in range(0, len(q), SIDE):
            todo, beam = np.arange(a, min(len(q), a + SIDE)), self.beam
            while len(todo):
                if beam >= len(self.x):  # as wide as the shard: all of it, in no order
                    r, c = np.nonzero(q[todo] @ self.x.T >= least)
                    out.append((todo[r], c))
                    break
                node, sim = self.reach(self.layers[0], q[todo], beam)
                hit = (sim >= least) & (node >= 0)
                full = hit.all(1)
                r, c = np.nonzero(hit & ~full[:, None])
                out.append((todo[r], node[r, c]))
                todo, beam = todo[full], 4 * beam if beam < WIDEST else len(self.x)
        return tuple(np.concatenate([o[k] for o in out]) if out else np.zeros(0, np.int64) for k in (0, 1))

    def pack(self) -> bytes:
        return b"".join([np.array([self.beam, len(self.layers)], "<i8").tobytes(),
                         *[np.array(k.shape, "<i8").tobytes() + k.astype("<i4").tobytes() for k in self.layers]])

    @classmethod
    def unpack(cls, x: np.ndarray, data: bytes) -> Graph:
        beam, count = np.frombuffer(data, "<i8", 2).tolist()
        at, layers = 16, []
        for _ in range(count):
            a, b = np.frombuffer(data, "<i8", 2, at).tolist()
            layers.append(np.frombuffer(data, "<i4", a * b, at + 16).reshape(a, b).astype(np.int64))
            at += 16 + 4 * a * b
        return cls(x, layers, beam)


def unit(v: np.ndarray) -> np.ndarray:
    """Rows of length one in double precision; scaled first, so that no square over- or underflows."""
    v = v.astype(np.float64)
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def levels(ids: np.ndarray) -> np.ndarray:
    """Geometric layer of each id, by a hash of it."""
    h = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    u = ((h >> np.uint64(11)).astype(np.float64) + 1) / float(1 << 53)
    return np.floor(-np.log(u) / np.log(UPPER_LINKS)).astype(int)


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least node of each node's component, for edges (a, b) over 0..n-1."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _build(group: pa.Table, least: float) -> pa.Table:
    cid = group.column("cid").to_numpy()
    order = np.lexsort((cid, -levels(cid)))
    cid, weight = cid[order], group.column("n").to_numpy()[order]
    size = group.column("size")[0].as_py()
    raw = group.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    raw = raw.reshape(-1, size)[order]
    graph = Graph.build(unit(raw).astype(np.float32), levels(cid))
    recall = graph.audit(least - SLACK)
    if recall < AUDIT_RECALL:
        raise RuntimeError(f"shard {group.column('shard')[0]} of label {group.column('label')[0]}: the audit of "
                           f"{len(cid)} vectors ended at a recall of {recall:.4f}, under {AUDIT_RECALL}")
    return pa.table({"label": group.column("label")[:1], "size": group.column("size")[:1], "shard": group.column("shard")[:1],
                     "cid": [cid.astype("<i8").tobytes()], "n": [weight.astype("<i8").tobytes()], "x": [raw.astype("<f8").tobytes()],
                     "graph": [graph.pack()], "beam": [graph.beam], "recall": [recall]}, schema=_SHARDS(group.schema))


def _SHARDS(schema: pa.Schema) -> pa.Schema:
    return pa.schema([schema.field("label"), ("size", pa.int32()), ("shard", pa.int32()), ("cid", pa.binary()), ("n", pa.binary()),
                      ("x", pa.binary()), ("graph", pa.binary()), ("beam", pa.int32()), ("recall", pa.float64())])


def _found(one: Graph, two: Graph, x: np.ndarray, y: np.ndarray, least: float) -> np.ndarray:
    """A bit for every pair (row of x, row of y) that a search of one in the other's graph
    found, from either side; whole bytes a row. The queries go by blocks of ``SIDE``, so
    the searches hold a block's pairs and the rest is a bit a pair."""
    bits = np.zeros((len(x), -(-len(y) // 8)), dtype=np.uint8)
    for a in range(0, len(x), SIDE):
        q, node = two.links(x[a:a + SIDE], least)
        hit = np.zeros((min(SIDE, len(x) - a), len(y)), dtype=bool)
        hit[q, node] = True
        bits[a:a + SIDE] |= np.packbits(hit, axis=1)
        if one is two:  # the same search answers the other side
            bits[:, a // 8:(a + SIDE) // 8] |= np.packbits(hit.T, axis=1)
    if one is not two:
        for a in range(0, len(y), SIDE):
            q, node = one.links(y[a:a + SIDE], least)
            hit = np.zeros((len(x), min(SIDE, len(y) - a)), dtype=bool)
            hit[node, q] = True
            bits[:, a // 8:(a + SIDE) // 8] |= np.packbits(hit, axis=1)
    return bits


def _meet(left: pa.Table, right: pa.Table, least: float) -> pa.Table:
    """Links between two shards (or within one), both ways. Pairs are verified, counted
    and joined to components by blocks of ``SIDE`` classes and then dropped."""
    def load(t: pa.Table):
        cid, weight, size = (np.frombuffer(t.column(c)[0].as_py(), "<i8") for c in ("cid", "n", "cid"))
        u = unit(np.frombuffer(t.column("x")[0].as_py(), "<f8").reshape(len(size), -1))
        return cid, weight, u, Graph.unpack(u.astype(np.float32), t.column("graph")[0].as_py())

    one = load(left)
    same = left.column("shard")[0] == right.column("shard")[0]
    two = one if same else load(right)
    cid = one[0] if same else np.concatenate([one[0], two[0]])
    weight = one[1] if same else np.concatenate([one[1], two[1]])
    away = 0 if same else len(one[0])
    bits = _found(one[3], two[3], one[3].x, two[3].x, least - SLACK)
    count = np.zeros(len(cid))
    label = np.arange(len(cid))
    step = max(1, (1 << 22) // one[2].shape[1])
    for k in range(0, len(bits), SIDE):
        a, b = np.nonzero(np.unpackbits(bits[k:k + SIDE], axis=1, count=len(two[0])))
        a = a + k
        if same:
            a, b = a[a < b], b[a < b]
        ok = [np.einsum("md,md->m", one[2][a[j:j + step]], two[2][b[j:j + step]]) >= least for j in range(0, len(a), step)]
        ok = np.concatenate(ok) if ok else np.zeros(0, bool)
        a, b = a[ok], b[ok] + away
        count += np.bincount(a, weights=weight[b], minlength=len(cid)) + np.bincount(b, weights=weight[a], minlength=len(cid))
        new = label[a] != label[b]
        label = local_components(len(cid), label[a[new]], label[b[new]])[label]
    hub = cid[label]
    some = count > 0
    return pa.table({"cid": cid[some], "links": count[some].astype(np.int64), "hub": hub[some]})


def shard_size(size: Column, capacity: int) -> Column:
    """Vectors of ``size`` components that a shard holds."""
    return F.least(F.lit(capacity), F.greatest(F.lit(LEAST_CAPACITY), F.floor(F.lit(SHARD_BYTES) / (8 * size)).cast("int")))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    least: float = 0.98, capacity: int = CAPACITY) -> DataFrame:
    """(id, n_links, component, kept): one row per row of ``vectors``.

    Vectors link if their labels are equal and not null, their lengths are equal and
    their cosine is ``least`` or more. A vector that is null, empty, zero or holds a null,
    NaN or infinite component links with nothing. Rows with equal vectors and labels link
    with each other. ``component``: the smallest id reachable (an id before null);
    ``kept``: whether that is the row's own id, false for a null id.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "hnsw")
    rows = pick(vectors, id=id_col, vector=vector_col, label=label_col)
    fine = F.size("vector") > 0
    fine &= F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    fine &= F.exists("vector", lambda v: v != 0)
    rows = rows.withColumn("fine", F.coalesce(fine & F.col("label").isNotNull(), F.lit(False)))
    rows = rows.withColumn("key", F.when(F.col("fine"), F.xxhash64("label", "vector")))
    good = rows.where("fine")
    classes = good.groupBy("label", "key", "vector").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    classes = scratch.keep(classes.withColumn("cid", F.monotonically_increasing_id())
                           .withColumn("size", F.size("vector").cast("int")), "classes")
    counts = scratch.keep(classes.groupBy("label", "size").agg(
        F.ceil(F.count(F.lit(1)) / shard_size(F.col("size"), capacity)).cast("int").alias("shards")), "counts")
    dealt = classes.join(small(counts), ["label", "size"]).withColumn(
        "shard", F.pmod(F.xxhash64("cid"), F.col("shards")).cast("int"))
    label = classes.schema["label"]
    out = T.StructType([T.StructField("label", label.dataType), T.StructField("size", T.IntegerType()),
                        T.StructField("shard", T.IntegerType()), *[T.StructField(c, T.BinaryType()) for c in ("cid", "n", "x", "graph")],
                        T.StructField("beam", T.IntegerType()), T.StructField("recall", T.DoubleType())])
    shards = scratch.keep(dealt.select("label", "size", "shard", "cid", "n", "vector").groupBy("label", "size", "shard")
                          .applyInArrow(lambda g: _build(g, least), out), "shards")
    # every pair of shards of a label, each shard's row copied once per pair it is in
    per, per_left = (x.join(small(scratch.again(counts)), ["label", "size"]) for x in (shards, scratch.again(shards)))
    side = F.explode(F.sequence(F.lit(0), F.col("shards") - 1))
    to_right = per.withColumn("other", side).where("other >= shard").withColumnsRenamed({"shard": "i", "other": "j"})
    to_left = per_left.withColumn("other", side).where("other <= shard").withColumnsRenamed({"shard": "j", "other": "i"})
    met = T.StructType([T.StructField(c, T.LongType()) for c in ("cid", "links", "hub")])
    keys = ["label", "size", "i", "j"]
    found = scratch.keep(
        to_right.withColumn("shard", F.col("i")).groupBy(*keys).cogroup(to_left.withColumn("shard", F.col("j")).groupBy(*keys))
        .applyInArrow(lambda a, b: _meet(a, b, least), met), "found")
    linked = found.groupBy("cid").agg(F.sum("links").alias("links"))
    nodes = classes.select(F.col("cid").alias("node"), "first")
    labels = scratch.keep(connected_components(found, "cid", "hub"), "labels")
    least_id = least_of_component(labels, nodes, "first").select(F.col("node").alias("cid"), "least")
    whole = classes.join(linked, "cid", "left").join(least_id, "cid", "left").select(
        "key", F.col("label").alias("of"), F.col("vector").alias("same"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("least", "first").alias("component"))
    whole = scratch.keep(whole, "whole")
    good = good.join(whole, (good["key"] == whole["key"]) & (F.col("label") == F.col("of")) & (F.col("vector") == F.col("same")))
    good = good.select("id", "n_links", "component")
    alone = rows.where("not fine").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component"))
    return good.union(alone).select("id", "n_links", "component", F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
good AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
least AS (SELECT a, min(b) AS c FROM reach GROUP BY a),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(n, 0) AS n_links, c AS component_id, v.vec_id = c AS kept
FROM v JOIN least ON least.a = v.vec_id LEFT JOIN counted ON counted.a = v.vec_id
"""
