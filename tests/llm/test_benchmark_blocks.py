"""op8: a benchmark of several blocks, and the rows that its docstrings name."""

from __future__ import annotations

import pytest

from contrail.llm import decontaminate

ITEMS = list(enumerate((
    "how many boats came back to the harbour before the storm broke in the spring",
    "name the three rivers that meet below the old stone bridge at the market town",
    "a train leaves at noon and a second one an hour later, when do they meet again",
    "which of these metals melts at the lowest temperature under ordinary pressure",
    "translate the following sentence and explain why the verb stands at its end"), 1))
DOCS = [(1, f"so {ITEMS[0][1]} it goes", "x"), (2, "clean text", "y"), (2, f"{ITEMS[4][1].upper()}", "z"), (3, None, "n"), (4, "", "e"),
        (None, f"{ITEMS[2][1]}", "q"), (None, "clean too", "r"), (5, "word " * 50_000 + ITEMS[3][1], "long"), (1, f"so {ITEMS[0][1]} it goes", "x")]


def tables(spark, docs, items):
    return (spark.createDataFrame(docs, "doc_id long, text string, item_id string"),
            spark.createDataFrame(items, "item_id long, text string"))


@pytest.mark.parametrize("block", [10, 150, decontaminate.BLOCK_CHARS])
def test_blocks(spark, block):
    docs, items = tables(spark, DOCS, ITEMS)
    found = decontaminate.matches(docs, items, block_chars=block).collect()
    assert sorted(((r.doc_id or 0, r.item_id, r.edits) for r in found)) == [(0, 3, 0), (1, 1, 0), (1, 1, 0), (2, 5, 0), (5, 4, 0)]
    left = decontaminate.clean(docs, items, block_chars=block)
    assert left.columns == docs.columns
    assert sorted(r.item_id for r in left.collect()) == ["e", "n", "r", "y"]


def test_empty(spark):
    docs, items = tables(spark, DOCS, ITEMS)
    assert decontaminate.matches(docs.limit(0), items).collect() == [] == decontaminate.clean(docs.limit(0), items).collect()
    assert decontaminate.matches(docs, items.limit(0)).collect() == []
    assert decontaminate.clean(docs, items.limit(0)).count() == len(DOCS)
