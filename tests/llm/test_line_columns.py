"""Columns of the input that are named like the operator's own."""

from contrail.llm import line_dedup


def test_clashing_columns(spark):
    line = "one two three four five six seven eight nine ten"
    rows = [(1, f"{line}\nfirst", 7, [0], "a", 1), (2, f"second\n{line}", 8, [1], "b", 2), (None, line, 9, None, "c", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _doc long, _gone array<int>, Removed_Lines string, removed_doc_id int")
    out = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted([rows[0], (2, "second", 8, [1], "b", 2), rows[2]], key=str)


def test_least_words_is_exact():
    for threshold in (50, 75, 90, 95):
        least = line_dedup.least_words(threshold)
        for n in range(1, 40):   # the closest different set has one more word
            assert (100 * n >= threshold * (n + 1)) == (n >= least)
