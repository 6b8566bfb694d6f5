"""A stage that filters on what Python told runs that Python once."""

import numpy as np

import corpus_pipeline
from tallyscope.llm import language


def evaluations(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython")


def test_filters_do_not_tell_or_cut_a_text_twice(spark):
    docs = spark.createDataFrame(
        [(1, "the cat sat on the mat", "en", "a", 22), (2, "der hund lag auf der matte", "de", "a", 26)],
        "doc_id long, text string, lang string, source string, n_chars long")
    assert evaluations(corpus_pipeline.language_stage(spark, docs, "")) == 1
    assert evaluations(corpus_pipeline.passage_stage(spark, docs, "")) == 1


def test_counts_do_not_depend_on_the_length_of_a_step(monkeypatch):
    texts = ["the cat sat", "", "x" * 500, "der hund, 12", "é" * 30] * 5
    whole = language.sparse_counts(texts)
    monkeypatch.setattr(language, "_STEP", 40)
    for a, b in zip(whole, language.sparse_counts(texts), strict=True):
        assert all(np.array_equal(x, y) for x, y in zip(a, b, strict=True))
