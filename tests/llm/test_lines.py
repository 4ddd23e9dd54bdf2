"""Operator 5 against its SQL, a plain count, and edge cases."""

import re
from collections import defaultdict

import pytest
from compare import differences
from pyspark.sql import functions as F

from clicktide.llm.lines import drop_wide_lines
from clicktide.llm.registry import ORACLES, op5_line_sites


def normal(line):
    return re.sub(r"[ \t\n\x0b\f\r]+", " ", line).strip(" ").lower()


def plain(docs, min_sites):
    sites, texts = defaultdict(set), defaultdict(set)
    for _, text, site in docs:
        for line in (text or "").split("\n"):
            sites[normal(line)].add(site)
            texts[normal(line)].add(text)
    wide = {n for n, s in sites.items() if n and len(s) >= min_sites and len(texts[n]) >= min_sites}
    out = []
    for doc, text, site in docs:
        lines = [] if text is None else text.split("\n")
        kept = [x for x in lines if normal(x) not in wide]
        out.append((doc, site, None if text is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def corpus():
    docs = []
    for i in range(240):
        own = [f"Own line number {i * 10 + k} of this text, and long enough." for k in range(4)]
        shared = ["Accept  all cookies" if i % 2 else "accept all COOKIES "] if i % 3 else []
        rare = [f"On {i % 40} sites é"] if i % 5 == 0 else []
        docs.append((i, "\n".join(own[:2] + shared + ["", *rare] + own[2:]), f"s{i % 60}"))
    docs += [(1000 + i, "A copied text\nwith two lines", f"s{i}") for i in range(70)]
    docs += [(2000, None, "s1"), (2001, "", "s2"), (2002, "\n\n", None), (None, "no id\nagain", None),
             (2003, "accept all cookies\n" * 30_000 + "x" * 900_000, "s3"),
             (2004, "Accept all cookies", "s4"), (5, "same", "s5"), (5, "same", "s5")]
    return docs


@pytest.mark.parametrize("min_sites", [1, 2, 12, 39, 41, 1000])
def test_against_plain(spark, min_sites):
    docs = corpus()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    out = drop_wide_lines(frame, min_sites=min_sites).select(
        "doc_id", "source", "text", "n_lines", "n_removed"
    )
    assert sorted((tuple(r) for r in out.collect()), key=str) == plain(docs, min_sites)


def test_a_notice_longer_than_the_own_text_goes(spark):
    notice = "We and our partners use cookies and similar methods; read on and agree to all of them."
    docs = [(i, f"Own words {i} of a short page.\n{notice}", f"s{i}") for i in range(12)]
    docs += [(100 + i, "one text\nof two lines", f"s{i}") for i in range(12)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    out = {r["doc_id"]: (r["text"], r["n_removed"]) for r in drop_wide_lines(frame).collect()}
    assert all(out[i] == (f"Own words {i} of a short page.", 1) for i in range(12))
    assert all(out[100 + i] == ("one text\nof two lines", 0) for i in range(12))


def test_edges(spark):
    frame = spark.createDataFrame(corpus(), "doc_id bigint, text string, source string").withColumns(
        {"N_Lines": F.lit("x"), "hash": F.lit(1), "_doc": F.lit(2), "site": F.lit(3), "line": F.lit(4)}
    )
    out = drop_wide_lines(frame)
    assert out.columns == ["doc_id", "text", "source", "hash", "_doc", "site", "line",
                           "n_lines", "n_removed"]
    assert out.count() == frame.count()
    assert drop_wide_lines(frame.limit(0)).count() == 0


def test_native(spark):
    frame = spark.createDataFrame(corpus(), "doc_id bigint, text string, source string")
    plan = drop_wide_lines(frame)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, data, sf):
    folder = data.replace("sf0.001", sf)
    assert differences(op5_line_sites(spark, folder), ORACLES["op5_line_sites"], folder) == ""
