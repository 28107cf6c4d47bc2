"""The pipeline against its stages' operators, row by row, and the entry points."""

from __future__ import annotations

import __spark_entry__ as entry
import corpus_pipeline
from strata.llm import near_dedup, quality_classifier, quality_rules
from strata.llm.common import table, written

SF = "/root/testdata/sf0.001"


def test_stages_and_queries():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "quality_rules", "near_dedup", "packing"]
    names = [k for k in entry.queries() if k.startswith("op") or k == "pipeline"]
    assert len(names) == 14


def test_pipeline_equals_its_operators(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    good = {r["doc_id"] for r in quality_classifier.classify(docs, labels).where("predicted = 1").collect()}
    rest = written(docs.where(docs["doc_id"].isin(sorted(good))), "test")
    good = {r["doc_id"] for r in quality_rules.score(rest, labels).where("kept").collect()}
    rest = written(rest.where(rest["doc_id"].isin(sorted(good))), "test")
    good = {r["doc_id"] for r in near_dedup.classes(rest, 5).where("kept").collect()}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in rows} == good
    assert all(r["length"] <= 1024 for r in rows)


def test_filtering_stages_return_the_columns_of_documents(spark, documents, no_documents):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, documents, SF).columns == documents.columns
        assert stage(spark, no_documents, SF).count() == 0
