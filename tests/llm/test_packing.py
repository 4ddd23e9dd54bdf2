"""Operator 6: ids against the tokenizer, sequences against the rules, and edge cases."""

import struct
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clicktide.llm import packing as pk
from clicktide.llm.registry import op6_pack

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
TOKENIZER.encode_special_tokens = True


def plain_ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [2]


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(), st.text(alphabet=" \t\n\r  ab'sé<|endoftext>1½.,中\x1c\x85")))
def test_encoder_equals_tokenizer(text):
    ids = pk.encode(text, pk.RANKS)
    assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == plain_ids(text)


def check(rows, docs, tokens=1024, max_docs=10**9, max_cost=float("inf")):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    want = defaultdict(list)
    for doc, text in docs:
        want[doc].append(plain_ids(text))
    assert set(pieces) == set(want)
    for doc, found in pieces.items():
        expected = []
        for ids in want[doc]:
            first = len(ids) % tokens or min(len(ids), tokens)
            cuts = [0, *range(first, len(ids) + 1, tokens)]
            for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                digest = zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))
                expected.append((k, a, b - a, digest))
        assert sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == sorted(expected)
    for found in sequences.values():
        at = 0
        for r in sorted(found, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= tokens and len(found) <= max_docs
        assert sum(r["length"] ** 2 for r in found) <= max_cost
    return len(sequences), sum(r["length"] for r in rows)


DOCS = [(i, f"word {i} " * (i % 400) + "end") for i in range(300)] + [
    (1000, None), (1001, ""), (1002, "x " * 30_000), (1003, " leading  and trailing "),
    (None, "no id"), (None, None), (7, "again"), (7, "again"), (1004, "ü" * 5000),
]


@pytest.mark.parametrize("limits", [{}, {"max_docs": 3, "rule": "dot"}, {"max_cost": 1.2 * 1024**2}])
def test_edges(spark, limits):
    frame = spark.createDataFrame(DOCS, "doc_id bigint, text string").withColumns(
        {"Piece": F.lit("x"), "offset": F.lit(1), "draw": F.lit(2), "extra": F.lit("e")}
    )
    out = pk.pack_documents(frame, **limits)
    assert out.columns == [
        "doc_id", "extra", "piece", "start", "length", "ids_crc32", "sequence_id", "offset",
    ]
    limits = {k: v for k, v in limits.items() if k != "rule"}
    sequences, total = check(out.collect(), DOCS, **limits)
    if not limits:
        assert sequences <= total / 1024 * 1.02 + 2
    assert pk.pack_documents(frame.limit(0)).count() == 0


def test_with_ids(spark):
    frame = spark.createDataFrame(DOCS[:5], "doc_id bigint, text string")
    for r in pk.pack_documents(frame, with_ids=True).collect():
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=80), st.integers(1, 6), st.integers(2500, 4000),
       st.sampled_from(["norm", "dot"]))
def test_every_constraint_holds(lengths, max_docs, max_cost, rule):
    lengths = np.array(lengths, np.int64)
    chosen, offset = pk.best_fit(lengths, 50, max_docs, max_cost, (1, 1, 1), rule)
    for b in set(chosen.tolist()):
        mine = chosen == b
        assert lengths[mine].sum() <= 50 and mine.sum() <= max_docs
        assert (lengths[mine] ** 2).sum() <= max_cost
        order = np.argsort(offset[mine])
        assert (offset[mine][order] == np.cumsum(lengths[mine][order]) - lengths[mine][order]).all()


def test_query(spark, data):
    docs = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet")
            .select("doc_id", "text").collect()]
    sequences, total = check(op6_pack(spark, data).collect(), docs)
    assert sequences <= total / 1024 * 1.02 + 1
