"""Ranked lexical search against plain Python."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from contrail.llm import lexical_search
from tests.llm.test_llm import AWKWARD, table

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=50):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n, total = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc_id, c in counts:
            m = 50 + (50 * c.total() * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 20 * m))
                        for t in set(terms(text)) if c[t])
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored, key=lambda s: s[:3])[:k], 1)]
    return out


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(5000)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 80)))) for i in range(n)]
    docs += [(n + i, docs[3][1].upper()) for i in range(60)]  # more copies than a query has places
    docs += [(2 * n, None), (2 * n + 1, ""), (2 * n + 2, "?! --"), (2 * n + 3, "Ünïcode w1 W1;w1_w2"), (7, docs[9][1]), (None, docs[3][1])]
    rng.shuffle(docs)
    items = [(i, " ".join(rng.choices(words, k=12))) for i in range(6)]
    items += [(6, docs[0][1]), (6, "w1"), (None, "w2 w3"), (8, None), (9, "--"), (10, "nowhere"), (11, "ünïcode Ünïcode"), (12, " ".join(words))]
    items += [(13, next(t for i, t in docs if i == 3))]
    return docs, items


@pytest.mark.parametrize("block_chars", [lexical_search.BLOCK_CHARS, 200])
def test_ranked(spark, block_chars):
    docs, items = corpus(1, 400)
    found = lexical_search.ranked(table(spark, docs).repartition(3), spark.createDataFrame(items, "item_id long, text string"), block_chars=block_chars)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    low = lambda rows: sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))
    assert low(map(tuple, found.collect())) == low(brute(docs, items))


@pytest.mark.parametrize("seed", range(6))
def test_segments(seed):
    """Searches over several segments, the results of one bounding the next, equal scoring everything."""
    rng = np.random.default_rng(seed)
    vocabulary, k = 12, 5
    weights = rng.integers(0, 4 if seed % 2 else 9000, vocabulary)  # small weights give many equal scores
    found, every = lexical_search._NONE, []
    query = np.sort(rng.choice(vocabulary, 7, replace=False))
    for size in (1, 40, 300, 7):
        ids, null = rng.integers(0, 200, size), rng.random(size) < 0.1
        ids = np.where(null, np.iinfo(np.int64).max, ids)
        length = rng.integers(1, 50, size)
        held = [np.flatnonzero(rng.random(vocabulary) < 0.3) for _ in range(size)]
        counts = [rng.integers(1, 5, len(h)) for h in held]
        segment = lexical_search.Segment(ids, null, length, np.concatenate(held), np.concatenate(counts), np.array([len(h) for h in held]), weights, 348, 9000)
        found = segment.search(query, k, found)
        for i in range(size):
            m = 50 + (50 * int(length[i]) * 348) // 9000
            score = sum(int(weights[t]) * ((10 ** 9 * int(c)) // (1000 * int(c) + 20 * m)) for t, c in zip(held[i], counts[i]) if t in query)
            if score:
                every.append((-score, int(ids[i]), bool(null[i])))
    assert list(zip((-found[0]).tolist(), found[1].tolist(), found[2].tolist())) == sorted(every)[:k]


def test_search_leaves_most_documents_unscored(monkeypatch):
    """A rare term's few documents bound the rest away."""
    n = 4000
    held = [np.array([0, 1]) if i % 500 == 0 else np.array([0]) for i in range(n)]
    ids = np.arange(n)
    segment = lexical_search.Segment(ids, np.zeros(n, bool), np.full(n, 10), np.concatenate(held), np.ones(sum(map(len, held)), np.int64),
                                     np.array([len(h) for h in held]), np.array([3, 9000]), n, 10 * n)
    scored = []
    plain = lexical_search.best_of
    monkeypatch.setattr(lexical_search, "best_of", lambda k, score, *rest: scored.append(len(score)) or plain(k, score, *rest))
    found = segment.search(np.array([0, 1]), 5, lexical_search._NONE)
    assert found[1].tolist() == [0, 500, 1000, 1500, 2000] and sum(scored) < 200


def test_term_counts_of_long_text(monkeypatch):
    text = " ".join(f"T{i % 37},é{i % 5}" for i in range(3000))
    whole = lexical_search.term_counts(text.encode())
    monkeypatch.setattr(lexical_search, "TEXT_BYTES", 100)
    assert lexical_search.term_counts(text.encode()) == whole == Counter(t.encode() for t in terms(text))


def test_awkward_and_empty(spark):
    items = [(1, "a b c"), (None, "other é"), (2, None)]
    queries = spark.createDataFrame([(i, t, 5, 6) for i, t in items], "item_id long, text string, doc_id long, score long")
    assert sorted(map(tuple, lexical_search.ranked(table(spark, AWKWARD), queries).collect()), key=str) == sorted(brute(AWKWARD, items), key=str)
    assert lexical_search.ranked(table(spark, []), queries).collect() == []
    assert lexical_search.ranked(table(spark, AWKWARD), queries.limit(0)).collect() == []
