"""Registered corpus queries, and the pipeline's stages checked one by one on the smallest table."""

import corpus_pipeline
from tabloom.llm import catalog
from tabloom.llm.common import table
from tests.llm.test_dedup import components_by_force, removed_by_force

FOLDER = "/root/testdata/sf0.001"


def test_all_operators_and_the_pipeline_are_registered():
    assert {int(q[2:].split("_")[0]) for q in catalog.QUERIES if q.startswith("op")} == set(range(1, 14))
    assert "pipeline" in catalog.QUERIES and set(catalog.SQL) <= set(catalog.QUERIES)


def test_pipeline_stages_by_hand(spark):
    docs = table(spark, FOLDER, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == columns
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        found = out.collect()
        kept = {r.doc_id: r.text for r in found}
        assert len(kept) > 0.5 * len(rows)
        if name == "line_dedup":
            gone = removed_by_force(rows, 10)
            left = {i: [x for k, x in enumerate(t.split("\n")) if (i, k) not in gone] for i, t in rows}
            assert kept == {i: "\n".join(x) for i, x in left.items() if x}
        elif name == "ngram_jaccard_join":
            roots = components_by_force(rows)
            assert kept == {i: t for i, t in rows if roots[i][1] == i}
        else:
            assert all(dict(rows)[i] == t for i, t in kept.items())
        docs = spark.createDataFrame(found, out.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in docs.collect()}
