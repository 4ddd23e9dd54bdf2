"""Words of Arrow text columns as numpy arrays, and rows passed through with new columns.

Texts stay UTF-8 bytes. A word is a run of word bytes inside one row; bytes of
128 and above always belong to a class as a whole, so no character is split.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType

SLICE = 1 << 18
MULTIPLIER = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Digits, letters of either case and every byte of a non-ASCII character.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True

#: Everything but the six ASCII white-space bytes.
VISIBLE = np.ones(256, bool)
VISIBLE[[32, 9, 10, 11, 12, 13]] = False


class Words(NamedTuple):
    """``starts`` and ``ends`` are byte places; row r owns words first[r]:first[r + 1]."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows in one array, and where each row begins; null is empty."""
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return bytes_[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_groups(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` bytes, or of one longer row."""
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1
        high = min(max(high, low + 1), rows)
        yield low, high
        low = high


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) <= n:
        size = max(n, SLICE) + 1
        for name, base in (("up", MULTIPLIER), ("down", pow(MULTIPLIER, -1, 1 << 64))):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _powers[name] = np.multiply.accumulate(factors)
    return _powers["up"], _powers["down"]


def _cut(buf: np.ndarray, offsets: np.ndarray, table: np.ndarray, low: int) -> int:
    """The end of a slice from ``low`` that divides no word."""
    high = low + SLICE
    if high >= len(buf):
        return len(buf)
    gaps = np.flatnonzero(~table[buf[low:high]])
    if gaps.size:
        return low + int(gaps[-1]) + 1
    row = int(offsets[np.searchsorted(offsets, high, "left")])
    while high < row:
        gaps = np.flatnonzero(~table[buf[high : min(high + SLICE, row)]])
        if gaps.size:
            return high + int(gaps[0]) + 1
        high += SLICE
    return row


def find_words(buf: np.ndarray, offsets: np.ndarray, table: np.ndarray = ALNUM) -> Words:
    """All words, with a 64-bit hash of each word's bytes in lower case (A-Z only)."""
    starts, ends, hashes = [], [], []
    low = 0
    while low < len(buf):
        high = _cut(buf, offsets, table, low)
        part = buf[low:high]
        inside = table[part]
        edges = offsets[np.searchsorted(offsets, low) : np.searchsorted(offsets, high)] - low
        before = np.empty_like(inside)
        before[0], before[1:] = False, inside[:-1]
        before[edges] = False
        after = np.empty_like(inside)
        after[-1], after[:-1] = False, inside[1:]
        after[edges[edges > 0] - 1] = False
        start = np.flatnonzero(inside & ~before)
        end = np.flatnonzero(inside & ~after) + 1
        up, down = _power_tables(len(part))
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((LOWER[part].astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=total[1:])
        hashes.append(mix((total[end] - total[start]) * down[start]))
        starts.append(start + low)
        ends.append(end + low)
        low = high
    join = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, kind)
    all_starts = join(starts, np.int64)
    return Words(
        all_starts, join(ends, np.int64), join(hashes, np.uint64),
        np.searchsorted(all_starts, offsets),
    )


def add_columns(
    docs: DataFrame,
    added: list[StructField],
    compute: Callable[[pa.RecordBatch], list[pa.Array]],
) -> DataFrame:
    """Rows of ``docs`` with the columns that ``compute`` returns for each batch.

    A column of ``docs`` that bears the name of an added one (in any case) gives way.
    """
    names = {field.name.lower() for field in added}
    kept = [field for field in docs.schema.fields if field.name.lower() not in names]
    places = [i for i, field in enumerate(docs.schema.fields) if field.name.lower() not in names]
    schema = StructType(kept + added)
    out_names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                arrays = [batch.column(i) for i in places] + compute(batch)
                yield pa.RecordBatch.from_arrays(arrays, names=out_names)

    return docs.mapInArrow(run, schema)


def list_array(counts: np.ndarray, values: pa.Array) -> pa.Array:
    """One list for each row: row r takes the next counts[r] values."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
