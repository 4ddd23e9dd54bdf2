"""Operator 2, license scan: Aho-Corasick for tags and notices, shunting-yard for expressions.

One automaton holds the base phrases, further notice phrases and the words of
the SPDX tag. It runs over words joined by single blanks, so any punctuation or
white space may stand between the words of a phrase. Behind a tag the original
text holds an expression such as ``(MIT OR Apache-2.0) AND GPL-2.0 WITH X``; it
is parsed into licenses and rated.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from clicktide.llm.arrow import ALNUM, LOWER, add_columns, row_groups, text_buffers

# Phrases that the base count takes, with their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Further notices in lower-case words, and the label each one gives.
NOTICES = {
    "gnu general public license": "gpl",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd 2 clause": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause",
    "permission is hereby granted free of charge": "mit-text",
    "redistribution and use in source and binary forms": "bsd-text",
    "creative commons attribution": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "dedicated to the public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
TAG = "spdx license identifier"
#: How freely a license lets text be used, by the start of its id; the longest start counts.
FREEDOM = {
    "mit": 1.0, "apache": 1.0, "bsd": 1.0, "isc": 1.0, "zlib": 1.0, "unlicense": 1.0,
    "cc0": 1.0, "public-domain": 1.0, "cc-by": 0.9, "cc-by-sa": 0.6, "mpl": 0.6, "epl": 0.6,
    "lgpl": 0.6, "gpl": 0.3, "agpl": 0.2, "cc-by-nd": 0.1, "cc-by-nc": 0.1,
    "all-rights-reserved": 0.0,
}
UNKNOWN_FREEDOM = 0.5
EXCEPTION_GAIN = 0.3
#: Probability that a finding of this kind states a license of the text.
WEIGHTS = {"tag": 0.9, "base": 0.8, "notice": 0.5}
PRECEDENCE = {"or": 1, "and": 2, "with": 3}
TOKEN = re.compile(r"\s*([()]|[A-Za-z0-9](?:[A-Za-z0-9.+:-]*[A-Za-z0-9+])?)")
GROUP_BYTES = 4 << 20

ADDED = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_base", T.LongType()),
    T.StructField("first_word", T.LongType()),
    T.StructField("last_word", T.LongType()),
    T.StructField("base_labels", T.ArrayType(T.StringType())),
    T.StructField("labels", T.ArrayType(T.StringType())),
    T.StructField("expressions", T.ArrayType(T.StringType())),
    T.StructField("freedom", T.DoubleType()),
    T.StructField("score", T.DoubleType()),
]


def freedom(license_id: str) -> float:
    starts = [k for k in FREEDOM if license_id.startswith(k)]
    return FREEDOM[max(starts, key=len)] if starts else UNKNOWN_FREEDOM


def leading_expression(text: str) -> list[str]:
    """The longest run of tokens at the start of ``text`` that is a whole expression."""
    tokens: list[str] = []
    whole = depth = at = 0
    operand = True
    while found := TOKEN.match(text, at):
        token, at = found[1], found.end()
        if token == "(" and operand:
            depth += 1
        elif token == ")" and not operand and depth:
            depth -= 1
        elif token.lower() in PRECEDENCE and not operand:
            operand = True
        elif token not in "()" and token.lower() not in PRECEDENCE and operand:
            operand = False
        else:
            break
        tokens.append(token)
        if not operand and not depth:
            whole = len(tokens)
    return tokens[:whole]


def postfix(tokens: list[str]) -> list[str]:
    """Shunting-yard: operators after their operands, ``with`` before ``and`` before ``or``."""
    out: list[str] = []
    waiting: list[str] = []
    for token in tokens:
        name = token.lower()
        if name == "(":
            waiting.append(name)
        elif name == ")":
            while waiting[-1] != "(":
                out.append(waiting.pop())
            waiting.pop()
        elif name in PRECEDENCE:
            while waiting and waiting[-1] != "(" and PRECEDENCE[waiting[-1]] >= PRECEDENCE[name]:
                out.append(waiting.pop())
            waiting.append(name)
        else:
            out.append(name)
    return out + waiting[::-1]


def evaluate(tokens: list[str]) -> tuple[str, set[str], float]:
    """A parsed expression as text, its licenses, and its freedom.

    A choice (or) is as free as its freest part, a conjunction as its least free;
    an exception (with) adds ``EXCEPTION_GAIN`` to its license.
    """
    stack: list[tuple[str, int, set[str], float]] = []
    for token in postfix(tokens):
        if token not in PRECEDENCE:
            stack.append((token, 9, {token}, freedom(token)))
            continue
        (b, b_rank, b_ids, b_free), (a, a_rank, a_ids, a_free) = stack.pop(), stack.pop()
        rank = PRECEDENCE[token]
        a, b = (f"({x})" if r < rank else x for x, r in ((a, a_rank), (b, b_rank)))
        if token == "with":
            ids, free = a_ids, min(1.0, a_free + EXCEPTION_GAIN)
        else:
            ids, free = a_ids | b_ids, (max if token == "or" else min)(a_free, b_free)
        stack.append((f"{a} {token} {b}", rank, ids, free))
    text, _, ids, free = stack[0]
    return text, ids, free


@lru_cache(maxsize=4)
def _automaton(base: tuple, notices: tuple) -> ahocorasick.Automaton:
    built = ahocorasick.Automaton()
    kinds: dict[str, list] = {}
    for kind, phrases in (("base", base), ("notice", notices), ("tag", ((TAG, ""),))):
        for phrase, label in phrases:
            kinds.setdefault(phrase, []).append((kind, label))
    for phrase, found in kinds.items():
        built.add_word(phrase, (len(phrase), found))
    built.make_automaton()
    return built


class _Row:
    """What was found in one text."""

    def __init__(self) -> None:
        self.base_words: list[int] = []
        self.base: set[str] = set()
        self.labels: set[str] = set()
        self.expressions: set[str] = set()
        self.free: list[float] = []
        self.doubt = 1.0

    def add(self, kind: str, labels: set[str], free: float) -> None:
        self.labels |= labels
        self.free.append(free)
        self.doubt *= 1 - WEIGHTS[kind]


def _scan(texts: pa.Array, base: tuple, notices: tuple) -> list[pa.Array]:
    buf, offsets = text_buffers(texts)
    automaton = _automaton(base, notices)
    rows: dict[int, _Row] = {}
    n_words = np.zeros(len(offsets) - 1, np.int64)
    for a, b in row_groups(offsets, GROUP_BYTES):
        part, bounds = buf[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        # Every row ends in a line feed, all other separators are one blank.
        spread = np.insert(LOWER[part], bounds[1:], 10)
        row_ends = bounds[1:] + np.arange(b - a)
        inside = ALNUM[spread]
        before = np.concatenate([[False], inside[:-1]])
        keep = inside | before
        keep[row_ends] = True
        spread[~inside] = 32
        spread[row_ends] = 10
        starts = np.flatnonzero(inside & ~before)
        place = np.cumsum(keep) - 1
        joined = spread[keep].tobytes().decode("latin-1")
        word_at, row_at = place[starts], place[row_ends]
        first = np.concatenate([[0], np.searchsorted(starts, row_ends)])
        n_words[a:b] = np.diff(first)
        for end, (size, found) in automaton.iter(joined):
            at = end - size + 1
            if (at and joined[at - 1] not in " \n") or joined[end + 1] not in " \n":
                continue
            r = int(np.searchsorted(row_at, at))
            word = int(np.searchsorted(word_at, at))
            row = rows.setdefault(a + r, _Row())
            for kind, label in found:
                if kind == "tag":
                    tail = int(starts[word + 2]) - r + len("identifier")
                    line = part[tail : bounds[r + 1]].tobytes().decode("utf-8").split("\n", 1)[0]
                    if tokens := leading_expression(line.lstrip(" \t:")):
                        text, ids, free = evaluate(tokens)
                        row.expressions.add(text)
                        row.add(kind, ids, free)
                    continue
                if kind == "base":
                    row.base_words.append(word - int(first[r]))
                    row.base.add(label)
                row.add(kind, {label}, freedom(label))
    every = [rows.get(i) for i in range(len(n_words))]
    column = lambda pick, kind: pa.array([pick(x) if x else None for x in every], kind)
    names = lambda pick: pa.array(
        [sorted(pick(x)) if x else [] for x in every], pa.list_(pa.string())
    )
    return [
        pa.array(n_words),
        pa.array([len(x.base_words) if x else 0 for x in every], pa.int64()),
        column(lambda x: min(x.base_words, default=None), pa.int64()),
        column(lambda x: max(x.base_words, default=None), pa.int64()),
        names(lambda x: x.base), names(lambda x: x.labels), names(lambda x: x.expressions),
        column(lambda x: min(x.free, default=None), pa.float64()),
        pa.array([1 - x.doubt if x else 0.0 for x in every], pa.float64()),
    ]


def license_scan(
    docs: DataFrame,
    text_col: str = "text",
    base: dict[str, str] | None = None,
    notices: dict[str, str] | None = None,
) -> DataFrame:
    """Documents with the licenses they name.

    Adds ``n_words``; ``n_base``, ``first_word``, ``last_word`` and ``base_labels``
    of the base phrases (words from 0; null without any); ``labels`` of all
    phrases and expressions; ``expressions`` behind tags, normalised; ``freedom``,
    that of the least free finding (null without any); and ``score``, the
    probability that the text states a license. Phrases are lower-case words
    with single blanks. A null or empty text has no words and score 0; a tag
    without a valid expression counts for nothing. Rows are judged one by one,
    so repeated rows get equal results; a column that has the name of an added
    one is replaced.
    """
    phrases = tuple((BASE_PHRASES if base is None else base).items())
    others = tuple((NOTICES if notices is None else notices).items())
    text = [n.lower() for n in docs.columns].index(text_col.lower())
    return add_columns(docs, ADDED, lambda batch: _scan(batch.column(text), phrases, others))
