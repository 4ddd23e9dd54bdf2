"""Operator 2 against a plain scan, its expression parser, and edge cases."""

import re

import pytest
from pyspark.sql import functions as F

from clicktide.llm import licenses as lic
from clicktide.llm.registry import op2_license_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(doc, text):
    w = WORD.findall((text or "").translate(UPPER))
    places = [
        (i, label) for phrase, label in lic.BASE_PHRASES.items() for i in range(len(w))
        if w[i : i + len(phrase.split())] == phrase.split()
    ]
    at = [i for i, _ in places]
    return (doc, len(w), len(at), min(at, default=None), max(at, default=None),
            sorted({label for _, label in places}))


BASE = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
DOCS = [
    (1, "Released under the MIT License."), (2, "under the mit"), (3, "license"), (4, None),
    (5, ""), (6, "Apache  License,\nVersion 2.0 ... CC-BY-NC 4.0; cc by ncx"),
    (7, "x" * 300_000 + " under the MIT license" * 3), (7, "Under\tthe mit-license é"),
    (None, "sunder the mit license; under the mit licenses"), (9, "é " * 50_000 + "CC BY NC"),
    (10, "// SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH "
         "Classpath-exception-2.0 */\nmore"),
    (11, "SPDX-License-Identifier: AND"), (12, "SPDX-License-Identifier"),
    (13, "This is under the GNU General Public License, version 3. All rights reserved."),
]


def test_against_plain_and_edges(spark):
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string").withColumns(
        {"Labels": F.lit(1), "score": F.lit("s"), "kind": F.lit("k")}
    )
    out = lic.license_scan(docs)
    assert out.columns == ["doc_id", "text", "kind", *(f.name for f in lic.ADDED)]
    rows = out.collect()
    assert sorted((tuple(r[c] for c in BASE) for r in rows), key=str) == sorted(
        (plain(*d) for d in DOCS), key=str
    )
    by = {r["doc_id"]: r for r in rows}
    assert by[10]["labels"] == ["apache-2.0", "gpl-2.0-only", "mit"]
    assert by[10]["expressions"] == [
        "(mit or apache-2.0) and gpl-2.0-only with classpath-exception-2.0"
    ]
    assert by[10]["freedom"] == pytest.approx(0.6)
    assert by[13]["labels"] == ["all-rights-reserved", "gpl", "gpl-3"]
    assert all(by[i]["score"] == 0 and by[i]["labels"] == [] for i in (2, 3, 4, 5, 11, 12))
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert lic.license_scan(docs.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("text", "tokens", "normal", "free"),
    [
        ("MIT", ["MIT"], "mit", 1.0),
        ("MIT. More words", ["MIT"], "mit", 1.0),
        ("mit or gpl-3.0 and bsd-3-clause", None, "mit or gpl-3.0 and bsd-3-clause", 1.0),
        ("(mit or gpl-3.0) and cc-by-nc-4.0", None, "(mit or gpl-3.0) and cc-by-nc-4.0", 0.1),
        ("GPL-2.0+ WITH a OR (MIT", ["GPL-2.0+", "WITH", "a"], "gpl-2.0+ with a", 0.6),
        ("(((mit)))", None, "mit", 1.0),
    ],
)
def test_expressions(text, tokens, normal, free):
    got = lic.leading_expression(text)
    if tokens:
        assert got == tokens
    shown, _, value = lic.evaluate(got)
    assert (shown, value) == (normal, pytest.approx(free))


@pytest.mark.parametrize("text", ["", "and mit", "(", ")", "(mit", "or"])
def test_no_expression(text):
    assert lic.leading_expression(text) == []


def test_query(spark, data):
    docs = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet")
            .select("doc_id", "text").collect()]
    rows = op2_license_scan(spark, data).collect()
    join = lambda r: (*r[:5], ",".join(r[5]))
    assert sorted(tuple(r[c] for c in BASE) for r in rows) == sorted(join(plain(*d)) for d in docs)
    assert sum(r["n_base"] for r in rows) > 0
    assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
               for r in rows)
