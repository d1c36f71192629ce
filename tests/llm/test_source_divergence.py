"""Source divergence against plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from contrail.llm import source_divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
SCHEMA = "doc_id long, text string, lang string, source string, term string, n long, docs long, p double"


def frame(spark, rows):
    return spark.createDataFrame([(i, *r, "x", 1, 2, 0.5) for i, r in enumerate(rows)], SCHEMA)


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, min_docs, top=50):
    group, lang_counts, held, out = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter), []
    for text, lang, source in rows:
        c = Counter(terms(text))
        group[lang or "", source or ""].update(c)
        lang_counts[lang or ""].update(c)
        held[lang or ""].update(c.keys())
    for (lang, source), counts in group.items():
        kept = [t for t in lang_counts[lang] if held[lang][t] >= min_docs]
        share = lambda c: {t: 1 + 10 ** 9 * (c[t] + 5) // (sum(c[x] for x in kept) + 5 * len(kept)) for t in kept}
        p, q = share(counts), share(lang_counts[lang])
        others = [(s, share(c)) for (k, s), c in group.items() if k == lang and s != source]
        pairs = sorted(((-sum(abs(p[t] - o[t]) for t in kept), s.encode()) for s, o in others))
        most = sorted((q[t] - p[t], t.encode()) for t in kept if counts[t] and p[t] > q[t])[:top]
        for part, found in (("pair", pairs), ("term", most)):
            out += [(lang, source, part, item.decode(), -value, rank) for rank, (value, item) in enumerate(found, 1)]
    return sorted(out)


def rows(seed):
    rng = random.Random(seed)
    out = []
    for i in range(240):
        lang, source = rng.choice(("en", "en", "de", None)), rng.choice(("a", "a", "a", "b", "é", "z", None))
        words = [f"{rng.choice('abcdeé')}{rng.choice('XYz')}" + rng.choice("ab" if source == "b" else "cd") for _ in range(rng.randrange(0, 30))]
        out.append((rng.choice((" ", "1", "\n", "_")).join(words), lang, source))
    out += [(None, "en", "silent"), ("", "fr", "only"), ("rare words here", "nl", "x"), ("other words", "nl", "y"), ("9 9 9", "nl", "z")]
    return out + out[:20]


@pytest.mark.parametrize("shards", [(source_divergence.SHARD_TERMS, source_divergence.BLOCK_SOURCES), (5, 2), (3, 1)])
def test_divergences(spark, shards):
    data = rows(3)
    found = source_divergence.divergences(frame(spark, data).repartition(4), min_docs=8, top_terms=9, shard_terms=shards[0], block_sources=shards[1])
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    want = brute(data, 8, 9)
    assert {r[2] for r in want} == {"pair", "term"} and any(r[:3] == ("nl", "x", "pair") and r[4] == 0 for r in want)
    assert sorted(map(tuple, found.collect())) == want


def test_empty_and_long(spark):
    assert source_divergence.divergences(frame(spark, [])).collect() == []
    data = [("wörter " * 40_000 + "x" * 100_000, "en", "a"), ("a " * 5, "en", "b"), (None, None, None)]
    assert sorted(map(tuple, source_divergence.divergences(frame(spark, data), min_docs=1).collect())) == brute(data, 1)


def test_long_texts_in_parts(monkeypatch):
    data = [t or "" for t, _, _ in rows(5)] + ["one two " * 400, "y" * 900]
    monkeypatch.setattr(source_divergence, "SLICE_BYTES", 64)
    found = Counter()
    for part in source_divergence._document_counts(pa.array(data, pa.large_string())):
        for r in part.to_pylist():
            assert (r["owner"], r["term"]) not in found  # a document is counted whole
            found[r["owner"], r["term"]] = r["n"]
    assert found == Counter((i, t) for i, text in enumerate(data) for t in terms(text))


def test_counts_beyond_64_bits(spark):
    row = spark.range(1).select(source_divergence._share("cast(5000000000000 as bigint)", "cast(7000000000001 as bigint)", "cast(3 as bigint)").alias("p")).first()
    assert row.p == 1 + 10 ** 9 * (5_000_000_000_000 + 5) // (7_000_000_000_001 + 15)
