"""op5: the bootstrapped search adds IP addresses in looser forms."""

from __future__ import annotations

from contrail.llm import pii


def test_bootstrap_adds_ip(spark):
    loose = ["10[.]0[.]0[.]5", "10 . 0 . 0 . 5", "10(dot)0(dot)0(dot)5", "2001:db8::ff00:42:8329", "fe80:0:0:0:1:2:3:4"]
    never = ["10[.]0[.]0[.]500", "1[.]2[.]3", "12:30:45", "1:2:3:4:5::6:7:8:9"]
    texts = [(i, f"please log in from host 10.1.2.{i} tonight") for i in range(10, 20)]
    texts += [(k, f"please log in from host {v} tonight") for k, v in enumerate(loose, 50)]
    texts += [(k, f"please log in from host {v} tonight") for k, v in enumerate(never, 70)]
    texts += [(90, "the parts 10[.]0[.]0[.]6 of it")]
    got = {r.doc_id: r for r in pii.personal_data(spark.createDataFrame(texts, "doc_id long, text string"), sure=0.6).collect()}
    for k, v in enumerate(loose, 50):
        assert got[k].spans == f"ip:24:{24 + len(v)}" and got[k].n_ip == 0 and got[k].n_added == 1, v
    assert all("ip:" not in got[k].spans for k in (*range(70, 70 + len(never)), 90))
