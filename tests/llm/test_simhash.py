import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quayside.llm import simhash
from quayside.llm.components import connected_components, least_of_component

U64 = 1 << 64


def plain_fingerprint(text):
    words = [w for w in (text or "").encode().lower().split() if w]
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def plain_components(prints, bits):
    left, out = set(prints), {}
    while left:
        todo, seen = [left.pop()], set()
        while todo:
            x = todo.pop()
            seen.add(x)
            near = {y for y in left if (x ^ y).bit_count() <= bits}
            left -= near
            todo += near
        for x in seen:
            out[x] = min(seen)
    return out


def signed(x):
    return x - U64 if x >= U64 >> 1 else x


TEXTS = [None, "", "   \t\n", "one", "One TWO", "ONE two", "a b c", "a b c d e", "É é è", "a b c d e",
         "x\x00y z\x0b w", "word " * 5000, "Word\x0cword " * 2500]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint_is_the_plain_one(text):
    assert simhash.fingerprint(simhash.shingle_hashes(text)) % U64 == plain_fingerprint(text)


def crowd(n, seed=1):
    """Fingerprints in chains and dense balls round a few centres."""
    r = random.Random(seed)
    out = {r.getrandbits(64) for _ in range(n)}
    for c in list(out)[:4]:
        x = c
        for _ in range(n // 8):
            out.add(c ^ (1 << r.randrange(64)))
            x ^= (1 << r.randrange(64)) | (1 << r.randrange(64))
            out.add(x)
    return sorted(out)


@pytest.mark.parametrize("bits,cap", [(2, 2000), (2, 3), (1, 2), (3, 2000), (3, 2), (0, 2000)])
def test_links_connect_what_brute_force_connects(spark, bits, cap):
    prints = crowd(120)
    df = spark.createDataFrame([(signed(x),) for x in prints], "fp long")
    got = simhash.links(df, bits, cap)
    rows = got.collect()
    assert all(((a % U64) ^ (b % U64)).bit_count() <= bits for a, b in rows)
    nodes = df.select(F.col("fp").alias("node"), F.col("fp").alias("v"))
    least = {x % U64: y % U64 for x, y in least_of_component(connected_components(got, "a", "b"), nodes, "v").collect()}
    want = plain_components(prints, bits)
    groups = lambda of: {frozenset(k for k in prints if of(k) == g) for g in map(of, prints)}
    assert groups(lambda k: least.get(k, k)) == groups(want.get)


def test_a_long_chain_and_a_star_are_one_component_each(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 2000 + i) for i in range(300)]
    edges = spark.createDataFrame(chain + star + [(5, 5), (None, 7), (7, 6)], "a long, b long")
    nodes = spark.range(3000).select(F.col("id").alias("node"), F.col("id").alias("v"))
    got = dict(least_of_component(connected_components(edges, "a", "b"), nodes, "v").collect())
    assert {got[i] for i in range(301)} == {0} and {got[i] for i in range(2000, 2300)} == {1000}
    assert len(got) == 602


def test_near_duplicates_nulls_repeats_and_clashing_columns(spark):
    base = [f"w{i}" for i in range(400)]
    near = list(base)
    near[7] = "other"
    rows = [(5, None), (3, ""), (9, " ".join(base)), (8, " ".join(near)), (2, "alone in the world"),
            (None, " ".join(base)), (9, " ".join(base)), (None, "nobody knows me"), (None, "nobody knows me")]
    docs = spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows],
                                 "doc_id long, text string, fp int, key string, component string")
    got = simhash.near_duplicates(docs).collect()
    prints = {t: plain_fingerprint(t) for _, t in rows}
    want = plain_components(set(prints.values()), 2)
    assert len(got) == len(rows)
    for g in got:
        texts = [i for i, t in rows if i is not None and want[prints[t]] == want[g.fp % U64]]
        assert g.component == min(texts, default=None)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=lambda x: (x is None, x))
    assert ids[:2] == [2, 3] and ids.count(None) == 1 and 5 not in ids and ids.count(9) <= 1


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 0 and simhash.keep_first(docs).count() == 0


def test_pivot_filter_never_drops_a_link():
    r = random.Random(3)
    pivots = [p % U64 for p in simhash.pivots()]
    for _ in range(500):
        x = r.getrandbits(64)
        y = x ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64))
        assert max(abs((x ^ p).bit_count() - (y ^ p).bit_count()) for p in pivots) <= 2
    assert len(set(pivots)) == simhash.PIVOTS and np.array(pivots, dtype="<u8").dtype == "<u8"
