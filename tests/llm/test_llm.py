"""Dealt operators against brute force on small tables, and on awkward input."""

from __future__ import annotations

import hashlib
import itertools
import random
import zlib

import duckdb
import numpy as np
import pytest

from contrail.llm import (decontaminate, exact_dedup, language_id, license_scan, line_dedup, lm_score, near_dedup,
                          packing, pii, substring_dedup)

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, hash long, row string, id int"


def table(spark, texts, lang="en"):
    rows = [(i, t, lang, "s", len(t) if t is not None else None, 1, 2, "r", 3) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def words(rng, n, kinds=400):
    return " ".join(f"w{rng.randrange(kinds)}" for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    out = []
    for g in range(12):
        base = words(rng, rng.randrange(20, 160)).split()
        for _ in range(rng.randrange(1, 7)):
            t = list(base)
            for _ in range(rng.randrange(0, 5)):
                t[rng.randrange(len(t))] = f"x{rng.randrange(50)}"
            out.append("\n".join(" ".join(t[i:i + 17]) for i in range(0, len(t), 17)))
    out += ["", None, " \n\t", "a b c", "A B c", "one", "one", out[0].upper(), out[3], words(rng, 9000)]
    return list(enumerate(out, start=10))


AWKWARD = [(1, None), (2, ""), (3, "\n\n"), (None, "a b c d e f g"), (None, None), (4, "a b c d e f g"), (4, "a b c d e f g"),
           (4, "other text"), (5, "é " * 3000), (6, "x" * 100_000), (7, "1 " * 20_000), (8, "@" * 500 + "1" * 500)]


def pairs(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_near_components_brute(spark, texts):
    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())

    sets = {i: shingles(t) for i, t in texts}
    low = {i: i for i in sets}
    changed = True
    links = [(a, b) for a, b in itertools.combinations(sets, 2)
             if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    got = near_dedup.near_components(table(spark, texts))
    assert pairs(got, "doc_id", "n_shingles", "component_id", "kept") == sorted((i, len(sets[i]), low[i], low[i] == i) for i in sets)
    kept = near_dedup.keep_one(table(spark, texts))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i in sets if low[i] == i)


def test_registers_estimate():
    rng = np.random.default_rng(1)
    both = np.unique(rng.integers(0, 2**63, 900, dtype=np.uint64) * np.uint64(2))
    a, b = np.unique(both[:800]), np.unique(both[100:])
    same = (near_dedup.registers(a) == near_dedup.registers(b)).mean()
    assert abs(same - len(np.intersect1d(a, b)) / len(np.union1d(a, b))) < 0.12
    assert (near_dedup.registers(a[:3]) == near_dedup.registers(a[:3])).all()


@pytest.mark.parametrize("bits", [64, 3])
def test_exact_groups_brute(spark, texts, bits):
    fold = {i: (t or "").encode().lower() for i, t in texts}
    want = []
    for i, t in fold.items():
        group = [j for j, u in fold.items() if u == t]
        want.append((i, max(group), len(group), i == max(group), hashlib.sha256(t).hexdigest()))
    got = exact_dedup.exact_groups(table(spark, texts), bits)
    assert pairs(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(want)


def test_strip_repeats_brute(spark, texts):
    size = 20
    split = {i: (t or "").encode().split() for i, t in texts}
    first = {}
    for i in sorted(split):
        for k in range(len(split[i]) - size + 1):
            first.setdefault(tuple(split[i][k:k + size]), i)
    want = []
    for i, w in split.items():
        gone = {k + j for k in range(len(w) - size + 1) if first[tuple(w[k:k + size])] < i for j in range(size)}
        left = b" ".join(x for k, x in enumerate(w) if k not in gone)
        want.append((i, len(w), len(gone), hashlib.sha256(left).hexdigest()))
    got = substring_dedup.strip_repeats(table(spark, texts), size)
    assert pairs(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(want)


def test_cover_and_windows():
    for period, remainders in substring_dedup.COVERS.items():
        for shift in range(period):
            assert any((r + shift) % period in remainders for r in remainders)
    h = np.arange(1, 60, dtype=np.uint64)
    for size in (1, 5, 20, 50):
        runs = substring_dedup.window_hashes(np.concatenate([h, h]), size)
        assert len(runs) == 119 - size and (runs[:60 - size] == runs[59:119 - size]).all()


def test_removed_lines_brute(spark, texts):
    lines = [(i, k, set(x.lower().split())) for i, t in texts for k, x in enumerate((t or "").split("\n"))]
    lines = [x for x in lines if len(x[2]) >= 3]
    want = []
    for n, (i, k, s) in enumerate(lines):
        hit = [x[:2] for x in lines[:n] if 100 * len(x[2] & s) >= 90 * len(x[2] | s)]
        if hit:
            want.append((i, k, *min(hit)))
    got = line_dedup.removed_lines(table(spark, texts))
    assert pairs(got, "doc_id", "line_no") == sorted(x[:2] for x in want)
    out = {r.doc_id: r for r in line_dedup.dedup_lines(table(spark, texts)).collect()}
    gone = {x[:2] for x in want}
    for i, t in texts:
        left = None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone)
        assert out[i].text == left and out[i].row == "r"


def test_short_repeats_removed(spark, texts, tmp_dir):
    import corpus_pipeline
    from contrail.llm.queries import QUERIES

    more = [(200, "Read more\n\n欢迎访问我们的网站\nread  MORE\n---"), (201, "Read more\n\nRead\n欢迎访问我们的网站\n欢迎\n---"), (202, "\n \nread")]
    docs = table(spark, [*texts, *more])
    lines = [(i, k, set(x.lower().split())) for i, t in [*texts, *more] for k, x in enumerate((t or "").split("\n"))]
    want = []
    for n, (i, k, s) in enumerate(lines):
        hit = [x[:2] for x in lines[:n] if s and 100 * len(x[2] & s) >= 90 * len(x[2] | s)]
        if hit:
            want.append((i, k, *min(hit)))
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    got = QUERIES["op6_line_dedup"](spark, tmp_dir)
    assert pairs(got, "doc_id", "line_no", "first_doc_id", "first_line_no") == sorted(want)
    out = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, docs, tmp_dir).collect()}
    assert (out[200], out[201], out[202]) == ("Read more\n\n欢迎访问我们的网站\n---", "\nRead\n欢迎", "\n ")


def test_ppm_brute(spark):
    rng = random.Random(2)
    texts = [(i, words(rng, rng.randrange(0, 40), 30)) for i in range(40)] + [(50, None), (51, "ß€\x00 odd")]
    order = 2
    train = [(t or "").encode() for i, t in texts if zlib.crc32(str(i).encode()) % 5 != 1]
    counts = [{} for _ in range(order + 1)]
    for t in train:
        sym = [256] * order + list(t) + [256]
        for at in range(order, len(sym)):
            for k in range(order + 1):
                row = counts[k].setdefault(tuple(sym[at - k:at]), {})
                row[sym[at]] = row.get(sym[at], 0) + 1

    def score(t):
        sym, total = [256] * order + list(t) + [256], 0.0
        for at in range(order, len(sym)):
            out, p, found = set(), 1.0, False
            for k in range(order, -1, -1):
                row = counts[k].get(tuple(sym[at - k:at]))
                if row is None:
                    continue
                left = {s: n for s, n in row.items() if s not in out}
                if left:
                    n, q = sum(left.values()), len(left)
                    if sym[at] in left:
                        p *= left[sym[at]] / (n + q)
                        found = True
                        break
                    p *= q / (n + q)
                out |= set(row)
            total += np.log10(p if found else p / (257 - len(out)))
        return total

    got = {r.doc_id: r for r in lm_score.ppm_scores(table(spark, texts), order, head=7).collect()}
    tokens = [w for t in train for w in [*t.lower().split(), None]]
    spread = len(tokens) + 0.5 * (len(set(tokens)) + 1)
    for i, t in texts:
        raw = (t or "").encode()
        w = [*raw.lower().split(), None]
        assert got[i].score == pytest.approx(score(raw), rel=1e-9)
        assert got[i].base_score == pytest.approx(sum(np.log10((tokens.count(x) + 0.5) / spread) for x in w), rel=1e-9)
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(w), sum(x in tokens for x in w), len(tokens))
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 1)
    # the score does not depend on how much of the model is broadcast
    for max_entries in (20, 60, 200):
        small = lm_score.ppm_scores(table(spark, texts), order, max_entries=max_entries).collect()
        assert sorted(r.doc_id for r in small) == sorted(got)
        for r in small:
            assert r.score == pytest.approx(got[r.doc_id].score, rel=1e-9)


def test_packing_round_trip(spark, texts):
    from tokenizers import Tokenizer

    size = 128
    got = packing.pack(table(spark, texts), size).collect()
    coder = Tokenizer.from_file(packing.vocabulary_path())
    coder.encode_special_tokens = True
    want = []
    for i, t in texts:
        ids = [*coder.encode(t or "", add_special_tokens=False).ids, 0]
        want += [(i, k, s, len(ids[s:s + size]), zlib.crc32(np.array(ids[s:s + size], "<u4").tobytes()))
                 for k, s in enumerate(range(0, len(ids), size))]
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size


def test_solve_small_instances():
    def least(items, size):
        best = [len(items)]

        def go(k, rooms):
            if len(rooms) >= best[0]:
                return
            if k == len(items):
                best[0] = len(rooms)
                return
            for r in range(len(rooms)):
                if rooms[r] >= items[k] and rooms[r] not in rooms[:r]:
                    go(k + 1, [*rooms[:r], rooms[r] - items[k], *rooms[r + 1:]])
            go(k + 1, [*rooms, size - items[k]])

        go(0, [])
        return best[0]

    rng = random.Random(3)
    for _ in range(60):
        size = 20
        items = sorted((rng.randrange(1, size + 1) for _ in range(rng.randrange(1, 10))), reverse=True)
        counts = np.bincount(items, minlength=size + 1)
        patterns = packing.solve(counts)
        held = sorted((x for lengths, n in patterns for _ in range(n) for x in lengths), reverse=True)
        assert held == items and all(sum(p) <= size for p, _ in patterns)
        used, fixed_counts = sum(n for _, n in patterns), counts.copy()
        fixed = packing.reduce_instance(fixed_counts)
        rest = sorted(np.repeat(np.arange(size + 1), fixed_counts).tolist(), reverse=True)
        assert sum(n for _, n in fixed) + least(rest, size) == least(items, size)  # the reduction loses nothing
        assert used <= least(items, size) + 1


def test_personal_data(spark):
    import re

    rng = random.Random(4)
    parts = ["a.b@c.de", "x@y", "1.2.3.4", "1.2.3.400", "001.02.3.255", "4111 1111 1111 1111", "4111111111111112", "+1 (449) 555-7462",
             "+12", "word", "é", "a@b.c_d@e.f", "5.6.7.8.9.10.11.12", "++44 20 7946 0958 ", "\n"]
    texts = [(i, rng.choice([" ", ""]).join(rng.choice(parts) for _ in range(rng.randrange(0, 9)))) for i in range(150)]
    forms = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def luhn(d):
        return sum(x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for k, x in enumerate(map(int, reversed(d)))) % 10 == 0

    def ok(kind, v):
        d = re.sub("[^0-9]", "", v)
        return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in v.split(".")),
                "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]

    got = {r.doc_id: r for r in pii.personal_data(table(spark, [*texts, (900, None)])).collect()}
    for i, t in [*texts, (900, "")]:
        spans = sorted((m.start(), k, m.end(), kind) for k, kind in enumerate(forms) for m in re.finditer(forms[kind], t) if ok(kind, m[0]))
        base = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)
        assert got[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest(), t
        assert [got[i][f"n_{k}"] for k in forms] == [sum(s[3] == k for s in spans) for k in forms]
        assert set(base.split(",")) - {""} <= set(got[i].spans.split(","))


def test_bootstrap_finds_unseen(spark):
    texts = [(i, f"please call me at +1 449 555 74{i:02d} today") for i in range(10, 20)]
    texts += [(50, "please call me at 449-555-7777 today"), (51, "the sum of 449-555-7778 items")]
    got = {r.doc_id: r for r in pii.personal_data(table(spark, texts)).collect()}
    assert got[50].spans == "phone:18:30" and got[50].n_phone == 0 and got[50].n_added == 1
    assert got[51].spans == ""


def test_licenses(spark):
    from contrail.llm.license_texts import KNOWN

    mit = KNOWN[0][1]
    texts = [(1, mit.replace("Software", "software").replace("<year> <holders>", "2024 Somebody")),
             (2, "intro\nreleased   under the MIT Licence\nend"), (3, "# " + mit.replace("\n", "\n# ") + "\n\nmore text"), (4, "nothing"),
             (5, None), (6, "Licensed under CC BY-NC 4.0")]
    got = pairs(license_scan.licenses(table(spark, texts)), "doc_id", "unit", "license_id")
    assert (1, "text", "MIT") in got and (2, "line", "MIT") in got and (6, "line", "CC-BY-NC-4.0") in got
    assert not {g[0] for g in got} & {4, 5}


def test_every_license_wrapped(spark):
    import re
    import textwrap

    from contrail.llm.license_texts import KNOWN

    def wrapped(text, width):
        parts = re.split("\n[ \t\f]*\n", text)
        return "\n\n".join(p if re.search("(?im)^ *(copyright [(\\[]|all rights reserved)", p) else textwrap.fill(" ".join(p.split()), width,
                           break_long_words=False)
                           for p in parts)

    assert {"MIT", "ISC", "Zlib", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0",
            "MPL-2.0", "Unlicense", "BSL-1.0"} <= {i for i, t in KNOWN if len(t) > 600}
    texts, ids = [], []
    for license_id, text in KNOWN:
        forms = [wrapped(text, w) for w in (72, 60, 45)]
        forms += [re.sub("(?m)^", mark, forms[0]) for mark in ("# ", " * ", "// ")]
        ids += [license_id] * len(forms)
        texts += forms
    got = {}
    for doc_id, _, license_id in pairs(license_scan.licenses(table(spark, list(enumerate(texts)))), "doc_id", "unit", "license_id"):
        got.setdefault(doc_id, set()).add(license_id)
    assert [(i, texts[i][:200]) for i, k in enumerate(ids) if k not in got.get(i, ())] == []


def test_notice_lines(spark):
    isc = next(t for i, t in license_scan.KNOWN if i == "ISC")
    cut = isc.replace("above copyright", "above\ncopyright")
    notices = ["Copyright (c) 2024 Some Body", "Copyright 2024, Some Body", "(c) 2024 Some Body", "(C) Some Body", "© Some Body",
               "Copyright Some Body and others", "Copyright The Some Authors", "Copyright: 2001-2004 Some Body", "Copyright <year> <owner>"]
    texts = [(0, cut), *((k, f"ISC License\n\n{n}\n\n{cut}") for k, n in enumerate(notices, 1)), (50, cut.replace("fee", "charge"))]
    got = pairs(license_scan.licenses(table(spark, texts)), "doc_id", "unit", "license_id")
    assert got == [(k, "text", "ISC") for k in range(len(notices) + 1)]


def test_decontaminate_brute(spark):
    def distance(item, text):
        row = [0] * (len(text) + 1)
        for i, c in enumerate(item, 1):
            new = [i]
            for j, d in enumerate(text, 1):
                new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (c != d)))
            row = new
        return min(row)

    rng = random.Random(6)
    items = [(k, words(rng, 15, 60)) for k in range(6)] + [(9, None), (10, "")]
    texts = []
    for i in range(40):
        t = list(words(rng, 30, 60) + " " + items[i % 6][1] + " " + words(rng, 10, 60))
        for _ in range(i % 8):
            t[rng.randrange(len(t))] = rng.choice("abz ")
        texts.append((i, "".join(t)))
    texts += [(90, None), (91, ""), (92, words(rng, 50, 60))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = []
    for i, t in texts:
        for k, item in items:
            a, b = decontaminate.normal(item or ""), decontaminate.normal(t or "")
            if a and b and (d := distance(a, b)) <= len(a) // 20:
                want.append((i, k, d))
    for block in (100, 10_000):
        got = pairs(decontaminate.matches(table(spark, texts), bench, block_chars=block), "doc_id", "item_id", "edits")
        assert got == sorted(want)
    left = decontaminate.clean(table(spark, texts), bench)
    assert sorted(r.doc_id for r in left.collect()) == sorted({i for i, _ in texts} - {w[0] for w in want})


def test_language_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = [r for r in language_id.languages(docs).collect() if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in rows) / len(rows) > 0.97
    odd = {r.doc_id: r for r in language_id.languages(docs.select("doc_id", "text", "lang").limit(200).unionByName(
        table(spark, [(-1, None), (-2, "12 34 !!"), (-3, "")]).select("doc_id", "text", "lang"))).collect()}
    assert all(odd[i].lang_pred == "und" and odd[i].score == 0 for i in (-1, -2, -3))


OPERATORS = {
    "near": near_dedup.near_components, "near_keep": near_dedup.keep_one, "lm": lm_score.ppm_scores, "pack": packing.pack,
    "exact": exact_dedup.exact_groups, "pii": pii.personal_data, "lines": line_dedup.dedup_lines,
    "license": license_scan.licenses, "substring": substring_dedup.strip_repeats, "language": language_id.languages,
    "accepted": language_id.accepted,
}


@pytest.mark.parametrize("name", OPERATORS)
@pytest.mark.parametrize("rows", [AWKWARD, []], ids=["awkward", "empty"])
def test_awkward_input(spark, name, rows):
    out = OPERATORS[name](table(spark, rows)).collect()
    if not rows:
        assert out == []
    elif name in ("near", "lm", "exact", "pii", "lines", "substring", "language"):
        assert len(out) == len(rows)  # a row per row, NULL and repeated ids included


@pytest.mark.parametrize("name", ["op1_near_dedup", "op4_exact_dedup", "op10_substring_dedup", "op11_lexical_search", "op12_source_divergence"])
def test_oracle(spark, name):
    from contrail.llm.queries import ORACLE, QUERIES

    got = QUERIES[name](spark, SF)
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(f"select {', '.join(got.columns)} from ({ORACLE[name]})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_pipeline(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 100
