"""The stage of exact copies against brute force, with repeats and clashing names."""

import corpus_pipeline
from pyspark.sql import functions as F


def test_one_longest_row_of_equal_texts_stays(spark):
    rows = [(1, "a b"), (2, "a  b"), (2, "ab"), (2, "a   b"), (None, "ab "), (3, ""), (4, None), (None, "z"), (None, "z "), (5, "ß"),
            (6, "x" * 40_000), (7, "x" * 39_999 + " x")]
    docs = spark.createDataFrame([(*r, "s", "en", i) for i, r in enumerate(rows)],
                                 "doc_id long, text string, source string, lang string, n_chars int")
    docs = docs.withColumns({c: F.lit(1) for c in ("_key", "text_sha256_", "kept", "group_size")})
    found = corpus_pipeline.drop_copies(spark, docs, "")
    assert found.columns == docs.columns
    assert {(r.doc_id, r.text) for r in found.collect()} == {
        (2, "a   b"), (3, ""), (None, "z "), (5, "ß"), (7, "x" * 39_999 + " x")}
    assert found.count() == 5
    assert corpus_pipeline.drop_copies(spark, docs.limit(0), "").count() == 0
