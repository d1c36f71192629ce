"""op8: an item without an id is still an item."""

from __future__ import annotations

from contrail.llm import decontaminate


def test_item_without_id(spark):
    item = "the quick brown fox jumps over the lazy dog near the river bank"
    docs = spark.createDataFrame([(1, f"before {item} after"), (2, "nothing of the kind")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, item), (7, "some other passage of the benchmark"), (None, None)], "item_id long, text string")
    got = [(r.doc_id, r.item_id, r.edits) for r in decontaminate.matches(docs, bench).collect()]
    assert got == [(1, None, 0)]
    assert [r.doc_id for r in decontaminate.clean(docs, bench).collect()] == [2]
