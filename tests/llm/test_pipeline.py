"""The stages, one by one and together, on the small tables."""

import hashlib

import corpus_pipeline as P
import pytest
from quayside.llm import decontam, quality, secrets, simhash
from quayside.llm.common import table

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """What each stage kept, each fed with its predecessor's rows."""
    docs, out = table(spark, DIR, "documents"), []
    for name, stage in P.STAGES:
        docs = stage(spark, docs, DIR)
        out.append((name, spark.createDataFrame(docs.collect(), docs.schema)))
        docs = out[-1][1]
    return out


def test_stages_do_what_their_operators_say(spark, kept):
    assert [name for name, _ in kept] == ["quality classifier", "SimHash near-dedup", "benchmark decontamination", "secret scans", "byte-level BPE"]
    docs = table(spark, DIR, "documents")
    steps = [docs, *[df for _, df in kept]]
    assert all(df.columns == docs.columns for df in steps[:-1])
    ids = [{r.doc_id for r in df.select("doc_id").collect()} for df in steps]
    model = quality.train(docs, table(spark, DIR, "labels"))
    assert ids[1] == {r.id for r in quality.scores(docs, model).where("score >= 0.5").collect()}
    assert ids[2] == {r.component for r in simhash.near_duplicates(steps[1]).collect()}
    assert ids[3] == ids[2] - {r.id for r in decontam.find_items(steps[2], table(spark, DIR, "benchmark")).collect()}
    assert ids[4] == ids[3] == ids[5] and ids[5] < ids[0]
    assert secrets.scan(steps[4]).selectExpr("explode(filter(spans, s -> s.live and s.kind < 3)) s").count() == 0
    text = {r.doc_id: r.text for r in steps[4].collect()}
    assert all(r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest() for r in kept[-1][1].collect())


def test_run_is_the_stages_in_turn(spark, kept):
    assert sorted(P.run(spark, DIR).collect()) == sorted(kept[-1][1].collect())
