"""Operator 3 against a plain search, and edge cases."""

import re
from collections import defaultdict

from pyspark.sql import functions as F

from clicktide.llm import substrings as sub
from clicktide.llm.registry import op3_repeated_text

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def plain_units(text):
    body = (text or "").encode()
    for mark in "。！？":
        body = body.replace(mark.encode(), b".  ")
    cuts = [0, *(m.start() for m in re.finditer(rb"(?<=\n)|(?<=[.!?])(?=[ \t\r\v\f])", body)), len(body)]
    found = []
    for a, b in zip(cuts, cuts[1:], strict=False):
        words = list(WORD.finditer(body.translate(UPPER), a, b))
        if words:
            found.append((words[0].start(), words[-1].end(), len(words), b" ".join(w.group() for w in words)))
    return found


def plain(docs, min_bytes=sub.MIN_BYTES):
    """Without ties of different texts at one id and place, which the operator breaks by hash."""
    places = defaultdict(set)
    units = {(doc, text): plain_units(text) for doc, text in docs}
    for (doc, _), mine in units.items():
        for start, *_, words in mine:
            places[words].add((doc is None, doc or 0, start))
    out = []
    for (doc, _), mine in units.items():
        run = []
        for unit in [*mine, None]:
            if unit and min(places[unit[3]]) != (doc is None, doc or 0, unit[0]):
                run.append(unit)
                continue
            if sum(u[1] - u[0] for u in run) >= min_bytes:
                none, first, at = min(places[run[0][3]])
                out.append((doc, run[0][0], run[-1][1], sum(u[2] for u in run), None if none else first, at))
            run = []
    return sorted(out, key=str)


LONG = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen"
WIDE = "今天天气很好我们去公园散步。然后回家吃晚饭！你觉得怎么样？" * 3
SHORTS = "No. Yes. So it goes. A day. " * 6
DOCS = [
    (3, f"Start here.\n{LONG}\nand some more words\nend"), (2, f"{LONG.upper()}!\nand some more words\n\nother words"),
    (4, f"A sentence before. {LONG}. And some more words\n{LONG}? yes"), (5, None), (6, ""), (7, "\n.\n. "),
    (8, f"é {LONG} é"), (9, f"é  {LONG}, é\n" * 3), (None, f"é {LONG} é"), (10, LONG + ".x " + LONG),
    (11, f"{LONG}\n" * 2_000), (12, "short line"), (13, "short line"), (14, "w " * 100_000),
    (14, "w " * 100_000), (20, f"first {SHORTS}"), (21, f"own begin. {SHORTS}own end."), (22, "甲" + WIDE), (23, f"乙。{WIDE}丙"),
    (24, "Only No. here."),
]


def test_against_plain_and_edges(spark):
    frame = spark.createDataFrame(DOCS, "doc_id bigint, text string").withColumns(
        {"id": F.lit("x"), "Start": F.lit(1), "a": F.lit(2), "first": F.lit(3), "t1": F.lit(4), "run": F.lit(5)}
    )
    for min_bytes in (1, 40, sub.MIN_BYTES):
        got = sub.repeated_spans(frame, min_bytes=min_bytes)
        assert sorted((tuple(r) for r in got.collect()), key=str) == plain(DOCS, min_bytes)
    assert sub.repeated_spans(frame.limit(0)).count() == 0


def test_without_repeats(spark):
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string").withColumns(
        {"cuts": F.lit("x"), "ID": F.lit(1), "row": F.lit(2)}
    )
    out = sub.without_repeats(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts[2] == DOCS[1][1] and texts[5] is None
    assert texts[3] == "Start here.\n\nend"
    assert texts[4] == "A sentence before. ? yes"
    assert texts[24] == "Only No. here." and texts[13] == "short line"
    assert texts[21] == "own begin. .own end." or texts[21].startswith("own begin. ")
    assert texts[23].startswith("乙。") and "散步" not in texts[23]
    assert sub.without_repeats(docs.limit(0)).count() == 0


def test_texts_of_one_id_are_told_apart(spark):
    """Two rows of one id with different texts lose their own repeats and nothing else."""
    rows = [(1, f"{LONG}\n{LONG} and more"), (2, f"ä {LONG} and more"), (2, f"ö own text here\n{LONG} and more\nthe end"), (2, "ü another text w")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    texts = sorted(r["text"] for r in sub.without_repeats(docs).collect())
    assert texts == sorted([rows[0][1], rows[1][1], "ö own text here\n\nthe end", "ü another text w"])


def test_query(spark, data):
    docs = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet")
            .select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in op3_repeated_text(spark, data).collect()), key=str)
    assert got and got == plain(docs)
