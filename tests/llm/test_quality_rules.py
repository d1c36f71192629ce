"""Quality rules: measures and selection against plain Python, the certified risk on drawn labels."""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from contrail.llm import quality_rules as q
from tests.llm.test_llm import AWKWARD, table, words


def brute(text):
    text = text or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(found[i:i + 8]) for i in range(len(found) - 7)]
    counts = Counter(windows)
    inside = {j for i, w in enumerate(windows) if counts[w] > 1 for j in range(i, i + 8)}
    seen, lines = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += line in seen
            seen.add(line)
    failed = len(found) < 20 or 100 * len(inside) > 30 * len(found)
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), lines, len(inside), failed


def test_measures(spark):
    rng = random.Random(2)
    texts = [words(rng, rng.randrange(0, 120), 5 if i % 3 else 300) for i in range(60)]
    texts += ["a b c d e f g h " * 3, "same line é\n" * 4 + " same line é\n\x0b\n", "x|y <b> #1 & 100% $5 **", "    \x1c \x85", "ñandú çà " * 12,
              " ".join(map(str, range(80))) + " one two three four five six seven eight" * 2, None, ""]
    found = {r.doc_id: r for r in q.quality(table(spark, list(enumerate(texts))), spark.createDataFrame([], "doc_id long, quality int")).collect()}
    for i, text in enumerate(texts):
        assert tuple(found[i][c] for c in (*q.BASE, "base_failed")) == brute(text), text
        assert found[i].kept == (not brute(text)[-1]) and found[i].rejected_by == []  # no labels: the base rules alone


@pytest.mark.parametrize("k, n, p", [(0, 10, 0.05), (3, 10, 0.3), (10, 10, 0.5), (0, 300, 0.05), (7, 300, 0.05), (40, 300, 0.05), (299, 300, 0.9), (2, 1000, 0.001)])
def test_binomial_tail(k, n, p):
    exact = sum(math.comb(n, i) * Fraction(p) ** i * (1 - Fraction(p)) ** (n - i) for i in range(k + 1))
    assert math.isclose(q.binomial_tail(k, n, p), float(exact), rel_tol=1e-9)


def test_risk_is_held():
    """Over many drawn label sets the true risk passes the bound in at most the stated share, though rules overlap with clean texts."""
    rng = np.random.default_rng(4)
    most, bad_runs, used_runs = len(q.RULES[0][4]), 0, 0
    true = 0.02 * np.arange(1, most + 1)  # a clean text is beyond the j strictest cutoffs of the first rule with these probabilities
    for _ in range(400):
        n = 500
        clean = rng.random(n) < 0.7
        steps = np.zeros((n, len(q.RULES)), np.int64)
        draw = rng.random(n)
        steps[:, 0] = np.where(clean, (draw[:, None] < true[::-1][None, :]).sum(axis=1), rng.integers(0, most + 1, n))
        used, holdout, rejected, p = q.certified(steps, clean, rng.random(n) < 0.3, np.ones(n, np.int64), 0.08, 0.05)
        if used[0]:
            used_runs += 1
            assert p <= 0.05 and rejected <= 0.08 * holdout
            bad_runs += true[used[0] - 1] > 0.08 + 1e-12
    assert used_runs > 150 and bad_runs <= 0.05 * 400 + 3 * math.sqrt(400 * 0.05 * 0.95)


def planted(rng, n, lang):
    docs = []
    for i in range(n):
        bad = i % 4 == 0
        text = words(rng, 60)
        docs.append((text.replace("w", "$$$w") if bad else text, lang, bad))
    return docs


def test_cutoffs_by_stratum(spark):
    rng = random.Random(8)
    rows = planted(rng, 800, "en") + planted(rng, 800, "de") + planted(rng, 40, "fr") + planted(rng, 8, None)
    docs = spark.createDataFrame([(i, t, lang, "s") for i, (t, lang, _) in enumerate(rows)], "doc_id long, text string, lang string, cutoffs string")
    # German labels call symbols clean; French has too few labels; a row without id or quality is no label
    labels = [(i, 0 if bad and lang != "de" else 1 if lang != "de" else int(rng.random() < 0.5), 1) for i, (_, lang, bad) in enumerate(rows)]
    labels += [(None, 0, 1), (1, None, 0), (5, 1, 0)]
    labelled = spark.createDataFrame(labels, "doc_id long, quality int, n_words int")
    chosen = {r.stratum: r for r in q.thresholds(q.measures(docs), labelled).collect()}
    assert set(chosen) == {"en", "de", "fr", ""}
    assert chosen["en"].cutoffs[0] != q.OFF and chosen["en"].holdout_rejected == 0 and chosen["en"].p_value < q.ERROR / 4
    assert all(c == q.OFF for s in ("de", "fr", "") for c in chosen[s].cutoffs)
    found = {r.doc_id: r for r in q.quality(docs, labelled).collect()}
    assert len(found) == len(rows)
    for i, (_, lang, bad) in enumerate(rows):
        assert found[i].kept == (not (bad and lang == "en")) and ("symbols" in found[i].rejected_by) == (bad and lang == "en")


def test_awkward_and_empty(spark):
    labels = spark.createDataFrame([(4, 1), (4, 0), (None, 1), (5, 1)], "doc_id long, quality int")
    rows = q.quality(table(spark, AWKWARD), labels).collect()
    got = sorted(((r.doc_id, *(r[c] for c in (*q.BASE, "base_failed"))) for r in rows), key=str)
    assert got == sorted(((i, *brute(t)) for i, t in AWKWARD), key=str)
    assert q.quality(table(spark, []), labels).collect() == []
    assert q.quality(table(spark, []), labels.limit(0)).collect() == []
