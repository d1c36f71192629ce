"""The pipeline on a planted table, stage by stage, against plain Python."""

from __future__ import annotations

import random

import corpus_pipeline
from contrail.llm import decontaminate

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def planted():
    """A table of two invented languages, each with its own letters; one kind of fault in each group of ids."""
    rng = random.Random(11)
    vocabulary = {lang: ["".join(rng.choice(letters) for _ in range(rng.randrange(3, 9))) for _ in range(300)]
                  for lang, letters in (("aa", "abcdefghij"), ("bb", "qrstuvwxyz"))}

    def text(lang, lines=6, size=14):
        return "\n".join(" ".join(rng.choice(vocabulary[lang]) for _ in range(size)) for _ in range(lines))

    item = " ".join(rng.choice(vocabulary["aa"]) for _ in range(20))
    rows = [(i, text(lang), lang) for i, lang in enumerate(["aa", "bb"] * 20)]
    rows += [(100, None, "aa"), (101, "", "aa"), (102, "12 34 !!", "bb")]  # no language
    rows += [(110 + k, f"{text('aa')}\nhaabc jihgf\n\n{rows[k][1].splitlines()[2]}", "aa") for k in (0, 2)]  # repeated lines
    base = [text("bb", 1, 60) for _ in range(3)]
    rows += [(120 + k, t, "bb") for k, t in enumerate(base)]
    rows += [(130 + k, " ".join([*t.split()[:-3], "qqq", "rrr", "sss"]), "bb") for k, t in enumerate(base)]  # near copies
    rows += [(140, f"{text('aa', 2)}\n{item}\n{text('aa', 2)}", "aa")]  # benchmark
    return rows, item


def test_stages_on_planted_table(spark, tmp_dir):
    rows, item = planted()
    docs = spark.createDataFrame([(i, t, lang, "s", len(t) if t is not None else None) for i, t, lang in rows], SCHEMA)
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    now, seen = docs, {}
    for name, function in corpus_pipeline.STAGES:
        now = function(spark, now, tmp_dir).cache()
        seen[name] = now.collect()
        if name == "packing":
            break
    text = {i: t for i, t, _ in rows}

    # language: every clean document passes, those without a language go
    want = {i: t for i, t in text.items() if i not in (100, 101, 102)}
    assert {r.doc_id: r.text for r in seen["language_id"]} == want

    # lines: sets of words, brute force
    lines = [(i, k, set(x.lower().split())) for i in sorted(want) for k, x in enumerate(want[i].split("\n"))]
    gone = {x[:2] for n, x in enumerate(lines) if x[2] and any(
        100 * len(x[2] & y[2]) >= 90 * len(x[2] | y[2]) for y in lines[:n])}
    assert {(110, 8), (112, 6), (112, 8)} <= gone
    want = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone) for i, t in want.items()}
    assert {r.doc_id: (r.text, r.n_chars) for r in seen["line_dedup"]} == {i: (t, len(t)) for i, t in want.items()}

    # near copies: the earliest of each group stays (planted pairs, so no chains)
    sets = {i: shingles(t) for i, t in want.items()}
    copies = {j for i in sets for j in sets if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])}
    assert copies
    want = {i: t for i, t in want.items() if i not in copies}
    assert {r.doc_id: r.text for r in seen["near_dedup"]} == want

    # benchmark: only the document with the passage goes
    held = {i for i, t in want.items() if decontaminate.normal(item) in decontaminate.normal(t)}
    assert held == {140}
    want = {i: t for i, t in want.items() if i not in held}
    assert {r.doc_id: r.text for r in seen["decontaminate"]} == want

    # packing: every document that is left, whole; run() gives the same pieces
    ends = {}
    for r in seen["packing"]:
        ends[r.doc_id] = max(ends.get(r.doc_id, 0), r.start + r.length)
    assert set(ends) == set(want) and min(ends.values()) > 1
    pieces = lambda found: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found)
    assert pieces(corpus_pipeline.run(spark, tmp_dir).collect()) == pieces(seen["packing"])
