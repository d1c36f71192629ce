"""Near-dedup gives the same components whatever the lots of a centre's pairs and the way texts are picked."""

import random

from contrail.llm import near_dedup


def _rows():
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    texts = []
    for size in (40, 6, 2):  # near copies of one text each
        base = [word() for _ in range(120)]
        for _ in range(size):
            copy = list(base)
            copy[rng.randrange(120)] = word()
            texts.append(" ".join(copy))
    texts += [" ".join(word() for _ in range(60)) for _ in range(20)] + [texts[0], "", None]
    return list(enumerate(texts))


def test_lots_and_shuffled_texts(spark, monkeypatch):
    rows = _rows()
    rows.append((0, "another text under a doc_id that is there already " * 3))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    columns = ("doc_id", "n_shingles", "component_id", "kept")
    result = lambda: sorted(near_dedup.near_components(docs).select(*columns).collect(), key=str)
    whole = result()
    assert sum(r.kept for r in whole) < len(rows) - 35
    monkeypatch.setattr(near_dedup, "LOT", 2)
    monkeypatch.setattr(near_dedup, "BROADCAST_NODES", 0)
    assert result() == whole


def test_lots_split_one_centre(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "LOT", 4)
    pairs = spark.range(1, 101).selectExpr("0L as a", "id as b")
    facts = spark.range(0, 101).selectExpr("id as node", "id * 10 as fact")
    got = near_dedup.attached(pairs, facts, "a", facts["fact"], "x")
    assert sorted((r.a, r.b, r.x) for r in got.collect()) == [(0, b, 0) for b in range(1, 101)]


def test_near_misses_are_settled_before_they_are_pairs(spark, monkeypatch):
    """Near copies of one text, most pairs at a similarity of about 0.68: their parity bits tell, and no link is lost."""
    rng = random.Random(8)
    base, texts = [f"w{i}" for i in range(300)], []
    for k in range(70):
        copy = list(base)
        for at in rng.sample(range(6, 294), 6):
            copy[at] = f"x{k}_{at}"
        texts.append(" ".join(copy))
    texts.append(texts[3] + " end")  # linked with one of them
    sets = [{tuple(t.split()[i:i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    low = list(range(len(texts)))
    linked = [(a, b) for b in low for a in range(b) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    for _ in low:
        for a, b in linked:
            low[a] = low[b] = min(low[a], low[b])
    counts, base_stage = {}, near_dedup.stage

    def counting(df, name, held=None):
        out = base_stage(df, name, held)
        counts[name] = out.count()
        return out

    monkeypatch.setattr(near_dedup, "stage", counting)
    docs = spark.createDataFrame(list(enumerate(texts)) + [(5, "another text under a doc_id that is there already")],
                                 "doc_id long, text string")
    got = near_dedup.near_components(docs).where("n_shingles > 50").collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == [(i, len(s), low[i]) for i, s in enumerate(sets)]
    assert counts["rest"] <= 2 * len(texts), counts


def test_parity_never_overstates_the_distance():
    import numpy as np

    rng = np.random.default_rng(4)
    for n in (1, 7, 150, 5000):
        whole = rng.integers(0, 2 ** 63, n + n // 5 + 1, dtype=np.uint64)
        a, b = np.unique(whole[:n]), np.unique(whole[-n:])
        differ = sum(int(x).bit_count() for x in (near_dedup.parity(a) ^ near_dedup.parity(b)).view(np.uint64))
        assert differ <= len(np.setxor1d(a, b)) and (differ - len(a) - len(b)) % 2 == 0
    assert not near_dedup.parity(np.empty(0, np.uint64)).any()
