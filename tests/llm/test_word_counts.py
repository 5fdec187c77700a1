"""Words of documents are counted without taking out every match of a pattern."""

import re

from rawlake.llm import contamination

TEXTS = ["", None, " ", ",a,B,", "Ab9-é ü\x00x", " a\u0085b", "a", "-a", "a-", "A b\nc"]


def test_word_counts(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    found = contamination.find(docs, spark.createDataFrame([("i", "a b c")], "item_id string, text string"))
    want = [len(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t or "")) for t in TEXTS]
    assert [r["n_words"] for r in found.orderBy("doc_id").collect()] == want
    plan = found._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "regexp_count" not in plan and "regexp_extract_all" not in plan
