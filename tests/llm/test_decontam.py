import random
import re

from quayside.llm import decontam as D


def plain(docs, items, bar=0.8):
    words = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    out = set()
    for item, text in items:
        w = words(text)
        n = min(5, len(w))
        grams = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set()
        for doc, body in docs:
            b = words(body)
            if grams and len(grams & {tuple(b[i:i + n]) for i in range(len(b) - n + 1)}) >= bar * len(grams) - 1e-9:
                out.add((doc, item))
    return out


def test_as_brute_force(spark):
    r = random.Random(4)
    vocab = [f"w{i}" for i in range(60)]
    items = [(k, " ".join(r.choices(vocab, k=r.choice([1, 2, 4, 5, 6, 9, 20, 40])))) for k in range(30)]
    docs = []
    for k in range(150):
        body = r.choices(vocab, k=r.choice([0, 3, 30, 300]))
        if r.random() < 0.7:
            passage = r.choice(items)[1].split()
            if r.random() < 0.5:
                passage[r.randrange(len(passage))] = "Changed!"
            at = r.randrange(len(body) + 1)
            body[at:at] = [", ".join(passage).upper()]
        docs.append((k, " ".join(body)))
    docs += [(3, docs[3][1]), (None, items[5][1]), (900, None), (901, ""), (902, " . ")]
    items += [(77, None), (78, "..."), (None, items[6][1]), items[7]]
    left = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, item string, need int")
    right = spark.createDataFrame(items, "item_id long, text string")
    got = [(x.id, x["item"]) for x in D.find_items(left, right).collect()]
    want = plain(docs, items)
    assert set(got) == want and len(got) == len(set(got)) and len(want) > 40
    kept = D.drop_found(left, right)
    assert kept.columns == left.columns
    bad = {d for d, _ in want}
    assert sorted(str(x.doc_id) for x in kept.collect()) == sorted(str(i) for i, _ in docs if i not in bad)


def test_without_broadcast_and_empty_tables(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "x")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "A b, c d e f!")], "item_id long, text string")
    monkeypatch.setattr(D, "BROADCAST_ROWS", -1)
    assert [r.id for r in D.find_items(docs, items).collect()] == [1]
    assert [r.doc_id for r in D.drop_found(docs, items).collect()] == [2]
    assert D.find_items(docs.limit(0), items).count() == 0 and D.find_items(docs, items.limit(0)).count() == 0
    assert D.drop_found(docs, items.limit(0)).count() == 2


def test_a_very_long_text(spark):
    body = " ".join(f"n{i}" for i in range(60000))
    docs = spark.createDataFrame([(1, body)], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(f"n{i}" for i in range(59000, 59040)))], "item_id long, text string")
    (row,) = D.find_items(docs, items).collect()
    assert (row.n_shingles, row.n_found, row.containment) == (36, 36, 1.0)


def test_partitions_bound_what_is_looked_up(spark):
    """Long items: shingles over the ceiling and texts under the floor are never looked up."""
    r = random.Random(9)
    text = lambda n: " ".join(f"v{r.randrange(10**6)}" for _ in range(n))
    items = [(k, text(n)) for k, n in enumerate([40] * 20 + [200] * 20 + [3])]
    right = spark.createDataFrame(items, "item_id long, text string")
    known = D.sketches(right, "item_id", "text", 0.8, D.Scratch(spark, "test-partitions"))
    bounds = D.partitions(known)
    assert sorted(bounds) == [3, 5] and [f for f, _ in bounds[5]] == [29, 157]
    rows = {k.item: k for k in known.collect()}
    assert all(len(k.sketch) == k.n - k.need + 1 and k.band == k.need.bit_length() - 1 for k in rows.values())
    assert all(max(k.sketch) <= max(c for _, c in bounds[k["size"]]) for k in rows.values())
    bodies = [(1, text(2)), (2, text(20)), (3, text(100)), (4, text(4000)), (5, items[25][1])]
    docs = spark.createDataFrame(bodies, "doc_id long, text string")
    looked = docs.select("doc_id", D.lookups(D.words(D.F.col("text")), bounds).alias("g")).collect()
    count = {d.doc_id: sum(g["size"] == 5 for g in d.g) for d in looked}
    assert count[1] == count[2] == 0 and 0 < count[3] < 70 and 0 < count[4] < 2500
    assert [(x.id, x["item"]) for x in D.find_items(docs, right).collect()] == [(5, 25)]


def test_a_side_is_broadcast_by_rows_and_bytes(spark, monkeypatch):
    items = spark.createDataFrame([(1, ["é" * 100, None], "x"), (None, None, None)], "a long, b array<string>, c string")
    size = sum((D.width(D.F.col(f.name), f.dataType) for f in items.schema.fields), D.F.lit(0))
    assert sorted(r[0] for r in items.select(size).collect()) == [48, 16 + (16 + 200 + 16 + 16) + 17]
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(D.small(items))
    monkeypatch.setattr(D, "BROADCAST_BYTES", 100)
    assert not hinted(D.small(items))
