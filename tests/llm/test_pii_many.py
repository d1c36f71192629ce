"""op5: texts with very many finds, and the cut of a find's context at the pieces of a long text."""

from __future__ import annotations

import hashlib
import time

from contrail.llm import pii


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_many_finds_in_one_text(spark):
    n = 100_000
    began = time.monotonic()
    got = pii.personal_data(table(spark, [(1, "1.2.3.4 " * n), (2, "é" + "a@b.cd, " * n), (3, "no find")])).orderBy("doc_id").collect()
    assert time.monotonic() - began < 120
    ips = ",".join(f"ip:{8 * i}:{8 * i + 7}" for i in range(n))
    mails = ",".join(f"email:{8 * i + 1}:{8 * i + 7}" for i in range(n))
    assert [(r.n_email, r.n_ip, r.n_card, r.n_phone) for r in got] == [(0, n, 0, 0), (n, 0, 0, 0), (0, 0, 0, 0)]
    assert [r.base_sha256 for r in got] == [hashlib.sha256(x.encode()).hexdigest() for x in (ips, mails, "")]
    assert [r.spans for r in got] == [ips, mails, ""]


def test_context_across_pieces_of_a_text(spark):
    """A find anywhere around the end of a piece has the same context as in a short text."""
    texts = [(i, f"please call me at +1 449 555 74{i:02d} today") for i in range(10, 20)]
    shifts = [*range(pii.CHUNK - 30, pii.CHUNK + 3), 3 * pii.CHUNK - 17]
    texts += [(100 + i, "é" * (k - 1) + " please call me at 449-555-7777 today") for i, k in enumerate(shifts)]
    got = {r.doc_id: r for r in pii.personal_data(table(spark, texts)).collect()}
    assert [got[100 + i].spans for i in range(len(shifts))] == [f"phone:{k + 18}:{k + 30}" for k in shifts]


def test_candidates_next_to_strict_matches(spark):
    """Candidates that a strict match overlaps are no further spans, those beside one are."""
    texts = [(i, f"from host 10.1.2.{i} and host 10[.]1[.]2[.]{i} tonight") for i in range(10, 40)]
    got = {r.doc_id: r for r in pii.personal_data(table(spark, texts)).collect()}
    for i in range(10, 40):
        assert got[i].n_ip == 1 and got[i].spans.split(",")[0] == "ip:10:19"


def test_loose_ip_at_registered_settings(spark):
    """Enough seeds in a pattern for the registered confidence of 0.8."""
    texts = [(i, f"please log in from host 10.1.2.{i} tonight") for i in range(10, 60)]
    texts += [(90, "please log in from host 10[.]0[.]0[.]5 tonight"), (91, "the parts 10[.]0[.]0[.]6 of it")]
    got = {r.doc_id: r for r in pii.personal_data(table(spark, texts)).collect()}
    assert got[90].spans == "ip:24:38" and got[90].n_added == 1 and got[91].spans == ""
