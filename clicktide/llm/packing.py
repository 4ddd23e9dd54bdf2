"""Operator 6, packing token pieces into sequences by vector best-fit.

A bin (sequence) has three capacities: tokens, documents and attention cost, the
sum of squared piece lengths. Pieces go from the longest to the shortest; each
goes to the open bin that has room under every constraint and is best by the
rule: the smallest weighted norm of what the bin has left afterwards, or the
smallest weighted dot product of the piece and what the bin has left. A bin is
opened only if none has room.

Full pieces are bins of their own. The others are dealt at random into groups
of about ``GROUP`` pieces, each packed in one task; a group leaves about one bin
partly empty.
"""

from __future__ import annotations

import base64
import struct
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktide.llm.arrow import add_columns
from clicktide.session import new_scratch_dir

GROUP = 8192
END_ID = 2
RANKS = "byte_bpe_50k.tiktoken"
PIECES = T.ArrayType(T.StructType([
    T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    T.StructField("ids", T.BinaryType()),
]))


@lru_cache(maxsize=2)
def encoder(ranks: str) -> tiktoken.Encoding:
    """Byte-level BPE from a file of ranks; it gives the ids that the ``tokenizers`` library gives
    for the same vocabulary, and takes the text of special tokens as plain text."""
    with open(public_tokenizers.path(ranks), "rb") as lines:
        known = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(
        ranks, pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={}
    )


def encode(text: str, ranks: str) -> bytes:
    """Token ids and the end id, as little-endian 32-bit numbers."""
    ids = encoder(ranks).encode_to_numpy(text, disallowed_special=())
    return ids.astype("<u4").tobytes() + struct.pack("<I", END_ID)


def cut(ids: bytes, tokens: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces: all but the first are full."""
    n = len(ids) // 4
    first = n % tokens or min(n, tokens)
    ends = [first, *range(first + tokens, n + 1, tokens)]
    return list(zip([0, *ends[:-1]], ends, strict=True))


def best_fit(lengths: np.ndarray, tokens: int, max_docs: int, max_cost: float,
             weights: tuple[float, float, float], rule: str) -> tuple[np.ndarray, np.ndarray]:
    """The bin of each piece and its offset there."""
    order = np.argsort(-lengths, kind="stable")
    limit = np.array([tokens, max_docs, max_cost], float)
    scale = np.array(weights) / limit**2
    least = lengths.min() if len(lengths) else 0
    chosen, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    left, number = np.empty((3, len(lengths))), np.empty(len(lengths), np.int64)
    open_bins = bins = 0
    for turn, i in enumerate(order.tolist()):
        if turn % 128 == 0:
            keep = np.flatnonzero((left[0, :open_bins] >= least) & (left[1, :open_bins] >= 1)
                                  & (left[2, :open_bins] >= least**2))
            left[:, : len(keep)] = left[:, keep]
            number[: len(keep)] = number[keep]
            open_bins = len(keep)
        size = float(lengths[i])
        need = np.array([size, 1.0, size * size])
        now = left[:, :open_bins]
        room = np.flatnonzero((now[0] >= size) & (now[1] >= 1) & (now[2] >= need[2]))
        if len(room):
            some = now[:, room]
            if rule == "norm":
                score = scale @ (some - need[:, None]) ** 2
            else:
                score = (scale * need) @ some
            at = int(room[np.argmin(score)])
        else:
            at = open_bins
            left[:, at], number[at] = limit, bins
            open_bins, bins = open_bins + 1, bins + 1
        chosen[i], offset[i] = number[at], tokens - left[0, at]
        left[:, at] -= need
    return chosen, offset


def token_pieces(
    docs: DataFrame, text_col: str = "text", tokens: int = 1024, vocabulary: str = RANKS,
    with_ids: bool = False,
) -> DataFrame:
    """One row for each piece, with the columns of its document but for the text.

    Adds ``piece``, ``start``, ``length``, ``ids_crc32``, ``ids`` (little-endian
    32-bit, null unless asked for) and ``draw``, a hash of the place of the row.
    """
    text = [n.lower() for n in docs.columns].index(text_col.lower())

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        bodies = [t or "" for t in batch.column(text).to_pylist()]
        part = TaskContext.get().partitionId()
        out = []
        for body in bodies:
            ids = encode(body, vocabulary)
            out.append([
                {"piece": k, "start": a, "length": b - a,
                 "ids_crc32": zlib.crc32(ids[4 * a : 4 * b]),
                 "ids": ids[4 * a : 4 * b] if with_ids else None}
                for k, (a, b) in enumerate(cut(ids, tokens))
            ])
        kind = pa.list_(pa.struct([("piece", pa.int32()), ("start", pa.int64()),
                                   ("length", pa.int64()), ("ids_crc32", pa.int64()),
                                   ("ids", pa.binary())]))
        return [pa.array(out, kind), pa.array([part] * len(out), pa.int32())]

    added = [T.StructField("_pieces", PIECES), T.StructField("_part", T.IntegerType())]
    names = {"piece", "start", "length", "ids_crc32", "ids", "draw", text_col.lower()}
    cut_up = add_columns(docs, added, compute)
    kept = [c for c in docs.columns if c.lower() not in names]
    rows = cut_up.select(*kept, F.explode("_pieces").alias("_p"), "_part")
    draw = F.xxhash64("_part", F.monotonically_increasing_id())
    return rows.select(*kept, "_p.*", draw.alias("draw"))


def pack_documents(
    docs: DataFrame,
    text_col: str = "text",
    tokens: int = 1024,
    max_docs: int | None = None,
    max_cost: float | None = None,
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05),
    rule: str = "norm",
    vocabulary: str = RANKS,
    with_ids: bool = False,
) -> DataFrame:
    """All documents as pieces, each with its ``sequence_id`` and ``offset`` there.

    A document is its token ids and the id 2. One of more than ``tokens`` ids is cut
    into pieces of that many, the first may be shorter. No sequence holds more than
    ``tokens`` ids, ``max_docs`` pieces or ``max_cost`` in squared lengths (by
    default the last two never bind). A null or empty text is the id 2 alone;
    repeated rows are packed each. Columns of the documents other than the text
    stay; one that has the name of an added one is replaced. An empty table packs
    into nothing.
    """
    if rule not in ("norm", "dot") or (max_cost is not None and max_cost < tokens**2):
        raise ValueError("the rule is norm or dot, and a full piece must fit into max_cost")
    spark = docs.sparkSession
    path = new_scratch_dir(spark, "pieces")
    clear = docs.select(*[c for c in docs.columns if c.lower() not in ("sequence_id", "offset")])
    token_pieces(clear, text_col, tokens, vocabulary, with_ids).write.parquet(path)
    pieces = spark.read.parquet(path)
    if not with_ids:
        pieces = pieces.drop("ids")
    full = pieces.where(F.col("length") == tokens).drop("draw").select(
        "*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
    )
    rest = pieces.where(F.col("length") < tokens)
    groups = max(1, -(-rest.count() // GROUP))
    rest = rest.withColumn("draw", F.pmod("draw", F.lit(groups)))
    schema = T.StructType([f for f in rest.schema.fields if f.name != "draw"] + [
        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    docs_limit, cost_limit = max_docs or tokens, max_cost or float(tokens**2)

    def pack(group: pa.Table) -> pa.Table:
        chosen, offset = best_fit(
            group["length"].to_numpy(), tokens, docs_limit, cost_limit, weights, rule
        )
        number = group["draw"][0].as_py() * (1 << 20) + chosen
        return group.drop_columns(["draw"]).append_column(
            "sequence_id", pa.array(number)
        ).append_column("offset", pa.array(offset))

    return full.unionByName(rest.groupBy("draw").applyInArrow(pack, schema))
