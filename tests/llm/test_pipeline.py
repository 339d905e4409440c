"""The pipeline's stages on planted documents and on odd rows."""

import corpus_pipeline as C
from beaconry.llm import simhash as S
from tests.llm.cases import docs_frame

FOLDER = "/root/testdata/sf0.01"


def test_stages_filter_and_mask_whole_tables(spark):
    docs = C.table(spark, FOLDER, "documents")
    truth = {r.doc_id: (r.quality, r.toxic) for r in C.table(spark, FOLDER, "labels").collect()}
    columns, seen = docs.columns, {r.doc_id for r in docs.collect()}
    for name, stage in C.STAGES[:-1]:
        docs = C.store(stage(spark, docs, FOLDER), name)
        assert docs.columns == columns
        now = [r.doc_id for r in docs.select("doc_id").collect()]
        assert len(set(now)) == len(now) and set(now) <= seen
        gone, seen = seen - set(now), set(now)
        if name == "quality":
            assert sum(truth.get(i, (0, 0))[0] == 1 for i in gone) <= 5 and sum(truth[i][0] == 0 for i in now if i in truth) <= 3
        if name == "personal_data":
            assert not gone
    fps = {r.doc_id: S.fingerprint(r.text) for r in docs.collect()}
    assert len(set(fps.values())) == len(fps)
    packed = C.STAGES[-1][1](spark, docs, FOLDER)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == seen


def test_stages_survive_odd_rows(spark):
    docs = docs_frame(spark)
    for name, stage in C.STAGES:
        out = stage(spark, docs, FOLDER)
        assert name == "packing" or out.columns == docs.columns
        assert stage(spark, docs.limit(0), FOLDER).count() == 0
        out.collect()
