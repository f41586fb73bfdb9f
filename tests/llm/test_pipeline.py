import shutil
from collections import Counter

import pytest
from helpers import awkward, components, shingle_set

import __spark_entry__ as contract
import corpus_pipeline as pipeline
from cityviews.llm.mixing import plan
from cityviews.llm.toxicity import fit, held_out, score

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in pipeline.STAGES:
        before, docs = docs, pipeline.saved(stage(spark, docs, SF), f"test-{name}")
        out[name] = before, docs
    return out


def test_toxicity_drops_what_it_rejects(spark, stages):
    before, after = stages["toxicity"]
    model = fit(before, spark.read.parquet(f"{SF}/labels.parquet").where(~held_out()))
    scored = score(before, model, before["doc_id"]).collect()
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in scored if r.score < 0.7}
    assert after.columns == before.columns


def test_one_of_each_near_duplicate_stays(stages):
    before, after = stages["near_duplicates"]
    docs = sorted(before.collect(), key=lambda r: r.doc_id)
    top = components([shingle_set(r.text, 5) for r in docs], 80)
    assert sorted(r.doc_id for r in after.collect()) == [r.doc_id for r, t, i in zip(docs, top, range(len(docs))) if t == i]


def test_mixing_repeats_within_the_limit(stages):
    before, after = stages["mixing"]
    times = Counter(r.doc_id for r in after.collect())
    passes = {r.source: (r.passes, r.rest) for r in plan(before).collect()}
    for r in before.collect():
        least, rest = passes[r.source]
        assert least <= times[r.doc_id] <= least + (rest > 0) and 1 <= times[r.doc_id] <= 5
    assert after.select(*sorted(before.columns)).distinct().count() == before.count()


def test_run_packs_every_copy(spark, stages):
    before, after = stages["packing"]
    key = lambda df: Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert key(pipeline.run(spark, SF)) == key(after)
    assert Counter(r.doc_id for r in after.collect() if r.piece == 0) == Counter(r.doc_id for r in before.collect())


def test_awkward_documents_pass_every_stage(spark, tmp_path):
    shutil.copy(f"{SF}/labels.parquet", tmp_path / "labels.parquet")
    for empty in (False, True):
        docs = awkward(spark, empty)
        n = docs.count()
        for _, stage in pipeline.STAGES:
            docs = pipeline.saved(stage(spark, docs, str(tmp_path)), "awkward")
        assert (docs.count() > 0) == (n > 0)


def test_registered_queries():
    names = contract.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
