"""Operator 1, benchmark decontamination by Wu-Manber multi-pattern search.

Texts and benchmark items are words, and each word is a 64-bit symbol. A pattern
is a window of consecutive item words. Patterns of one length form a group with
three tables: shifts by the hash of a block of words, buckets by the hashes of
a pattern's last block and first word, and the words themselves. A scan looks
at the last block below the window, skips as far as the shift allows, and only
where the shift is zero opens a bucket and compares the words byte by byte.
Many windows (lanes) advance together, so that each step is one numpy call.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktide.llm.arrow import (
    ALNUM, LOWER, Words, add_columns, find_words, list_array, mix, row_groups, text_buffers,
)
from clicktide.session import new_scratch_dir

LANE = 64
GROUP_BYTES = 4 << 20
SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()),
                                  T.StructField("end", T.IntegerType())]))
ADDED = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("hit_items", T.ArrayType(T.StringType())),
    T.StructField("hit_words", SPANS),
]


class Group(NamedTuple):
    """Patterns of ``length`` words."""

    length: int
    block: int
    symbols: np.ndarray
    texts: list[bytes]
    shift: np.ndarray
    bits: int
    buckets: np.ndarray
    order: np.ndarray


def _block_hash(symbols: np.ndarray, ends: np.ndarray, block: int) -> np.ndarray:
    h = symbols[ends]
    for back in range(1, block):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + symbols[ends - back])
    return h


def _bucket(suffix: np.ndarray, first: np.ndarray) -> np.ndarray:
    return suffix ^ mix(first + np.uint64(0x632BE59BD9B4E019))


def build_group(texts: list[bytes], symbols: np.ndarray) -> Group:
    """Tables for the patterns ``texts``, whose words have the symbols of each row."""
    count, length = symbols.shape
    block = min(3, length)
    bits = int(min(22, max(10, np.ceil(np.log2(count * length + 1)) + 4)))
    shift = np.full(1 << bits, length - block + 1, np.uint16)
    flat = symbols.ravel()
    for last in range(block - 1, length):
        h = _block_hash(flat, np.arange(count) * length + last, block)
        np.minimum.at(shift, h >> np.uint64(64 - bits), length - 1 - last)
    suffix = _block_hash(flat, np.arange(count) * length + length - 1, block)
    keys = _bucket(suffix, symbols[:, 0])
    order = np.argsort(keys, kind="stable")
    return Group(length, block, symbols, texts, shift, bits, keys[order], order)


def find(group: Group, words: Words, lower: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places of the last word of each occurrence, and which pattern occurs."""
    low, stop = words.first[:-1] + group.length - 1, words.first[1:]
    lanes = np.maximum(0, -((low - stop) // LANE))
    row = np.repeat(np.arange(len(lanes)), lanes)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    at = low[row] + nth * LANE
    end = np.minimum(at + LANE, stop[row])
    places, suffixes = [], []
    while at.size:
        h = _block_hash(words.hashes, at, group.block)
        step = group.shift[h >> np.uint64(64 - group.bits)].astype(np.int64)
        zero = step == 0
        places.append(at[zero])
        suffixes.append(h[zero])
        at = at + np.maximum(step, 1)
        more = at < end
        at, end = at[more], end[more]
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    place, suffix = np.concatenate(places), np.concatenate(suffixes)
    key = _bucket(suffix, words.hashes[place - group.length + 1])
    left = np.searchsorted(group.buckets, key, "left")
    size = np.searchsorted(group.buckets, key, "right") - left
    nth = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    place, pattern = np.repeat(place, size), group.order[np.repeat(left, size) + nth]
    for i in range(group.length):
        same = words.hashes[place - group.length + 1 + i] == group.symbols[pattern, i]
        place, pattern = place[same], pattern[same]
    same = np.fromiter(
        (
            b" ".join(lower[s:e] for s, e in zip(words.starts[p - group.length + 1 : p + 1],
                                                 words.ends[p - group.length + 1 : p + 1],
                                                 strict=True)) == group.texts[q]
            for p, q in zip(place.tolist(), pattern.tolist(), strict=True)
        ),
        bool, len(place),
    )
    return place[same], pattern[same]


class Tables(NamedTuple):
    """Groups of patterns by length; ``items`` has the item ids of each pattern."""

    groups: list[Group]
    items: list[list[list[str]]]


def build_tables(items: list[tuple[str, str]], window: int) -> Tables:
    """Tables for windows of ``window`` words, or of all words of a shorter item."""
    column = pa.array([text for _, text in items], pa.string())
    buf, offsets = text_buffers(column)
    words = find_words(buf, offsets, ALNUM)
    lower = LOWER[buf].tobytes()
    found: dict[int, dict[bytes, tuple[int, set[str]]]] = {}
    for r, (item, _) in enumerate(items):
        a, b = int(words.first[r]), int(words.first[r + 1])
        length = min(window, b - a)
        for i in range(a, b - length + 1) if length else ():
            text = b" ".join(lower[words.starts[j] : words.ends[j]] for j in range(i, i + length))
            found.setdefault(length, {}).setdefault(text, (i, set()))[1].add(item)
    groups, owners = [], []
    for length, patterns in sorted(found.items()):
        starts = np.array([i for i, _ in patterns.values()])
        symbols = words.hashes[starts[:, None] + np.arange(length)]
        groups.append(build_group(list(patterns), symbols))
        owners.append([sorted(ids) for _, ids in patterns.values()])
    return Tables(groups, owners)


def _scan(tables: Tables, texts: pa.Array, before: tuple[list, list] | None) -> list[pa.Array]:
    buf, offsets = text_buffers(texts)
    rows = len(offsets) - 1
    n_words, n_hit = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    spans, starts, ends = np.zeros(rows, np.int64), [], []
    items: list[set[str]] = [set() for _ in range(rows)]
    for a, b in row_groups(offsets, GROUP_BYTES):
        part = buf[offsets[a] : offsets[b]]
        words = find_words(part, offsets[a : b + 1] - offsets[a], ALNUM)
        lower = LOWER[part].tobytes()
        change = np.zeros(len(words.starts) + 1, np.int64)
        for group, owners in zip(tables.groups, tables.items, strict=True):
            place, pattern = find(group, words, lower)
            np.add.at(change, place - group.length + 1, 1)
            np.add.at(change, place + 1, -1)
            row = np.searchsorted(words.first, place, "right") - 1
            for r, q in np.unique(np.stack([row, pattern], 1), axis=0).tolist():
                items[a + r].update(owners[q])
        if before:
            for r in range(a, b):
                items[r].update(before[0][r])
                for span in before[1][r]:
                    change[words.first[r - a] + span["start"]] += 1
                    change[words.first[r - a] + span["end"]] -= 1
        hit = np.cumsum(change[:-1]) > 0
        total = np.concatenate([[0], np.cumsum(hit)])
        n_words[a:b] = np.diff(words.first)
        n_hit[a:b] = total[words.first[1:]] - total[words.first[:-1]]
        of = np.repeat(np.arange(b - a), np.diff(words.first))
        joined = hit[1:] & hit[:-1] & (of[1:] == of[:-1])
        first = np.flatnonzero(hit & ~np.concatenate([[False], joined])[: len(hit)])
        last = np.flatnonzero(hit & ~np.concatenate([joined, [False]])[: len(hit)])
        spans[a:b] = np.bincount(of[first], minlength=b - a)
        starts.append(first - words.first[of[first]])
        ends.append(last + 1 - words.first[of[first]])
    names = [sorted(x) for x in items]
    flat = lambda parts: pa.array(np.concatenate(parts) if parts else [], pa.int32())
    pairs = pa.StructArray.from_arrays([flat(starts), flat(ends)], names=["start", "end"])
    return [pa.array(n_words), pa.array(n_hit), pa.array(names, pa.list_(pa.string())),
            list_array(spans, pairs)]


def benchmark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    block_bytes: int = 16 << 20,
) -> DataFrame:
    """Documents with the words that occur in a window of a benchmark item.

    Adds ``n_words``, ``n_hit`` (words inside any occurrence), ``hit_items``
    (ids as text, sorted) and ``hit_words`` (runs of hit words, from word 0, end
    exclusive). An item of fewer than ``window`` words is one pattern. A null or
    empty text has no words, an item with a null id has the id ''. Repeated
    items and documents are each judged alike; other columns pass through, and
    a column with the name of an added one is replaced.

    The patterns go to the executors in blocks of about ``block_bytes`` of item
    text. There is one block for each so many bytes; the documents run through
    one block after the other, and their hits are kept in a table in between.
    """
    items = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
        F.coalesce(F.col(item_text_col), F.lit("")).alias("body"),
    ).distinct()
    size = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    blocks = -(-size // block_bytes) or 1
    spark = docs.sparkSession
    result = docs
    for block in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item", "body"), F.lit(blocks)) == block)
        tables = spark.sparkContext.broadcast(
            build_tables([(r["item"], r["body"]) for r in mine.toLocalIterator()], window)
        )
        if block:
            path = new_scratch_dir(spark, "benchmark-hits")
            result.write.parquet(path)
            result = spark.read.parquet(path)
        result = _with_block(result, text_col, tables, block > 0)
    return result


def _with_block(docs: DataFrame, text_col: str, tables, again: bool) -> DataFrame:
    names = [n.lower() for n in docs.columns]
    text, items, spans = (
        names.index(n) if n in names else -1 for n in (text_col.lower(), "hit_items", "hit_words")
    )

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        before = (batch.column(items).to_pylist(), batch.column(spans).to_pylist())
        return _scan(tables.value, batch.column(text), before if again else None)

    def first(batch: pa.RecordBatch) -> list[pa.Array]:
        return _scan(tables.value, batch.column(text), None)

    return add_columns(docs, ADDED, compute if again else first)
