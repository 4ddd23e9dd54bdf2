"""Operator 10, document fingerprints of improbable features.

A window of 64 bytes has an entropy. Windows of very low or very high entropy
are common in all texts, those in between tell texts apart; ``RANK`` puts
entropies in order of rarity. Where a window has the best rank among its
neighbours for long enough, it is a feature. Features go into a chain of Bloom
filters of 2048 bits, a new one for each 160 features, and two fingerprints are
compared filter by filter: the bits they share, less those that chance explains.

Entropies of all windows come from counts of equal bytes at each distance, in a
few vector operations over slices of the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktide.llm.arrow import mix, row_groups, text_buffers

WINDOW = 64
NEIGHBOURS = 64
POPULARITY = 16
BITS = 2048
HASHES = 5
FEATURES = 160
#: Share of the bits beyond chance that is still taken for chance.
NOISE = 0.1
SLICE = 1 << 16
GROUP_BYTES = 1 << 20
PARTITION_BYTES = 32 << 20

#: p log p in thousandths of a bit for a byte that occurs so often in a window.
TERM = np.zeros(WINDOW + 1, np.int64)
_share = np.arange(1, WINDOW + 1) / WINDOW
TERM[1:] = np.round(-1000 * WINDOW * _share * np.log2(_share))

#: Rank by entropy, in steps of a hundredth of the possible range: best for text
#: well below the usual entropy of prose, none for runs and near-random bytes.
STEPS = 1000
_levels = np.arange(STEPS + 1) / STEPS
RANK = np.full(STEPS + 1, STEPS + 1, np.int64)
_usable = np.flatnonzero((_levels >= 0.15) & (_levels <= 0.97))
RANK[_usable[np.argsort(np.abs(_levels[_usable] - 0.45), kind="stable")]] = np.arange(len(_usable))
NO_RANK = STEPS + 1


def window_ranks(text: np.ndarray) -> np.ndarray:
    """The rank of the window that begins at each byte of ``text``; only its bytes matter."""
    n = len(text) - WINDOW + 1
    if n <= 0:
        return np.empty(0, np.int64)
    before, after = np.ones(len(text), np.uint8), np.ones(len(text), np.uint8)
    for distance in range(1, WINDOW):
        same = text[distance:] == text[:-distance]
        before[distance:] += same
        after[:-distance] += same
    # Moving on by one byte takes one from the count of the byte that leaves, and adds one
    # to the count of the byte that comes in. ``after`` counts the leaving byte in its window;
    # ``before`` counts the new byte in the 63 bytes before it and itself.
    first = TERM[np.bincount(text[:WINDOW], minlength=256)].sum()
    leaving, coming = after[: n - 1], before[WINDOW:]
    step = TERM[leaving - 1] - TERM[leaving] + TERM[coming] - TERM[coming - 1]
    entropy = np.concatenate([[first], first + np.cumsum(step)])
    return RANK[np.clip(entropy * STEPS // (1000 * WINDOW * 6), 0, STEPS)]


def _edge(offsets: np.ndarray, size: int) -> np.ndarray:
    """The last ``size`` places of each row, or all of a shorter one."""
    places = offsets[1:, None] - size + np.arange(size)
    return places[places >= offsets[:-1, None]]


def features(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the features of all rows in order, and the row of each.

    A feature is the leftmost best window of at least ``POPULARITY`` runs of
    ``NEIGHBOURS`` windows (fewer where a text has fewer runs). A text without any,
    short or even, is one feature as a whole; an empty text has none.
    """
    n, size = len(buf), np.diff(offsets)
    ranks, wins = np.full(n, NO_RANK, np.int16), np.zeros(n, np.uint8)
    runs = np.ones(n, bool)
    for low in range(0, n - WINDOW + 1, SLICE):
        part = window_ranks(buf[low : low + SLICE + WINDOW - 1])
        ranks[low : low + len(part)] = part
    ranks[_edge(offsets, WINDOW - 1)] = NO_RANK
    runs[_edge(offsets, WINDOW + NEIGHBOURS - 2)] = False
    for low in range(0, n, SLICE):
        part = ranks[low : low + SLICE + NEIGHBOURS - 1].astype(np.int64)
        best = (part << 32) + np.arange(len(part))
        reach = 1
        while reach < NEIGHBOURS and len(best) > reach:
            best = np.minimum(best[:-reach], best[reach:])
            reach *= 2
        if reach < NEIGHBOURS:
            continue
        won = best[runs[low : low + len(best)]] & ((1 << 32) - 1)
        wins[low : low + len(part)] += np.bincount(won, minlength=len(part)).astype(np.uint8)
    needed = np.clip(size - WINDOW - NEIGHBOURS + 2, 1, POPULARITY)
    for row in np.flatnonzero((size >= WINDOW) & (size < WINDOW + NEIGHBOURS - 1)).tolist():
        at = offsets[row] + np.argmin(ranks[offsets[row] : offsets[row] + size[row] - WINDOW + 1])
        wins[at] = 1
    place = np.flatnonzero((wins > 0) & (ranks < NO_RANK))
    row = np.searchsorted(offsets, place, "right") - 1
    chosen = wins[place] >= needed[row]
    place, row = place[chosen], row[chosen]
    hashes = np.zeros(len(place), np.uint64)
    if len(place):
        windows = np.lib.stride_tricks.sliding_window_view(buf, WINDOW)[place]
        words = np.ascontiguousarray(windows).view(np.uint64)
        for k in range(WINDOW // 8):
            hashes = mix(hashes * np.uint64(0x9E3779B97F4A7C15) + words[:, k])
    plain = np.setdiff1d(np.flatnonzero(size), row)
    if len(plain):
        whole = [hashlib.blake2b(buf[offsets[r] : offsets[r + 1]], digest_size=8).digest()
                 for r in plain.tolist()]
        hashes = np.concatenate([hashes, np.frombuffer(b"".join(whole), np.uint64)])
        row = np.concatenate([row, plain])
        order = np.argsort(row, kind="stable")
        hashes, row = hashes[order], row[order]
    return hashes, row


def digests(buf: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """For each row the chain of Bloom filters, one row of bytes each; none for an empty text."""
    parts = []
    for low, high in row_groups(offsets, GROUP_BYTES):
        hashes, row = features(buf[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
        # A feature that repeats in a text would only set bits that are set already.
        order = np.lexsort((np.arange(len(row)), hashes, row))
        again = (np.diff(row[order]) == 0) & (hashes[order][1:] == hashes[order][:-1])
        kept = np.sort(order[np.concatenate([[True], ~again])[: len(order)]])
        hashes, row = hashes[kept], row[kept]
        each = np.bincount(row, minlength=high - low)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
        chain = -(-each // FEATURES)
        begin = np.concatenate([[0], np.cumsum(chain)])
        bits = np.zeros((begin[-1], BITS), np.uint8)
        link = begin[row] + nth // FEATURES
        for k in range(HASHES):
            bits[link, (hashes >> np.uint64(11 * k)).astype(np.int64) & (BITS - 1)] = 1
        packed = np.packbits(bits, axis=1, bitorder="little")
        parts += [packed[a:b] for a, b in zip(begin[:-1], begin[1:], strict=True)]
    return parts


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1: each filter of the shorter chain against its best match in the longer one.

    Shared bits count from the number that chance explains (two deviations above
    the mean), up to the smaller of both filters. Two empty chains are alike, an empty and another are not.
    """
    if a.shape == b.shape and (a == b).all():
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    if len(a) > len(b):
        a, b = b, a
    x = np.unpackbits(a, axis=1).astype(np.float32)
    best = np.full(len(a), -1.0)
    weight = x.sum(1)
    for low in range(0, len(b), 256):
        y = np.unpackbits(b[low : low + 256], axis=1).astype(np.float32)
        shared = x @ y.T
        sizes = y.sum(1)
        share = sizes[None, :] / BITS
        chance = weight[:, None] * share
        chance = chance + 2 * np.sqrt(chance * (1 - share))
        most = np.minimum(weight[:, None], sizes[None, :])
        chance = np.minimum(chance + NOISE * (most - chance), most - 1e-6)
        best = np.maximum(best, ((shared - chance) / (most - chance)).max(1))
    return float((np.clip(best, 0, 1) * weight).sum() / weight.sum())


def _bounds(docs: DataFrame, partition_bytes: int) -> np.ndarray:
    """Ids that cut the documents into ranges of about equal counts."""
    size = docs.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    parts = -(-size // partition_bytes) or 1
    if parts == 1:
        return np.empty(0, np.int64)
    shares = (np.arange(1, parts) / parts).tolist()
    cuts = docs.select(F.col("_order").cast("double")).approxQuantile("_order", shares, 0.1 / parts)
    return np.unique(np.array(cuts, np.float64)).astype(np.int64)


def _in_ranges(docs: DataFrame, bounds: np.ndarray) -> DataFrame:
    """Documents in id order, one range in each partition, and behind the last document of a
    range, marked ``_edge``, the one that follows it."""
    shared = docs.sparkSession.sparkContext.broadcast(bounds)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.searchsorted(shared.value, batch.column(0).to_numpy(), "right")
            yield pa.RecordBatch.from_arrays(
                [pa.array(place.astype(np.int32)), *batch.columns], names=["_range", *batch.schema.names]
            )

    keys = docs.select("_order", "_tie").mapInArrow(number, "_range int, _order bigint, _tie bigint")
    firsts = sorted(
        (r["_range"], r["first"]["_order"], r["first"]["_tie"])
        for r in keys.groupBy("_range").agg(F.min(F.struct("_order", "_tie")).alias("first")).collect()
    )
    # The first document of each range also goes to the range before it, that of the first to the last.
    before = {(o, t): firsts[i - 1][0] for i, (_, o, t) in enumerate(firsts)}
    lead = docs.sparkSession.sparkContext.broadcast(before)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in number(batches):
            names = ["_range", "_edge", *batch.schema.names[1:]]
            no = pa.array(np.zeros(batch.num_rows, bool))
            yield pa.RecordBatch.from_arrays([batch.column(0), no, *batch.columns[1:]], names=names)
            pairs = zip(batch.column("_order").to_pylist(), batch.column("_tie").to_pylist(), strict=True)
            if found := [(i, lead.value[p]) for i, p in enumerate(pairs) if p in lead.value]:
                rows = batch.take(pa.array([i for i, _ in found]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r for _, r in found], pa.int32()),
                     pa.array(np.ones(len(found), bool)), *rows.columns[1:]], names=names,
                )

    kind = T.StructType([T.StructField("_range", T.IntegerType()),
                         T.StructField("_edge", T.BooleanType()), *docs.schema.fields])
    dealt = docs.mapInArrow(deal, kind)
    return dealt.repartitionById(len(bounds) + 1, "_range").sortWithinPartitions(
        "_range", "_edge", "_order", "_tie"
    )


def _judge(rows: list[dict]) -> pa.RecordBatch:
    """Results for all rows but the last, which is only the next of the one before it."""
    texts = [r["_text"] or "" for r in rows]
    edited = []
    for text, following in zip(texts, texts[1:], strict=False):
        half = len(text) // 2
        edited.append(text[: len(text) - half] + following[:half])
    own = digests(*text_buffers(pa.array(texts, pa.string())))
    other = digests(*text_buffers(pa.array(edited, pa.string())))
    n = len(edited)
    return pa.RecordBatch.from_arrays([
        pa.array([r["_id"] for r in rows[:n]], pa.int64()),
        pa.array([len(t) for t in texts[:n]], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
        pa.array([d.tobytes().hex() for d in own[:n]], pa.string()),
        pa.array([d.tobytes().hex() for d in other], pa.string()),
        pa.array([likeness(a, b) for a, b in zip(own, other, strict=False)], pa.float64()),
        pa.array([likeness(a, b) for a, b in zip(own, own[1:], strict=False)], pa.float64()),
    ], names=["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
              "near_next"])


def _follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting: list[dict] = []
    done = False
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            for row in batch.slice(at, 64).to_pylist():
                if not done:
                    waiting.append(row)
                done = done or row["_edge"]
            if len(waiting) > 1:
                yield _judge(waiting)
                waiting = waiting[-1:]


def fingerprint_pairs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    partition_bytes: int = PARTITION_BYTES,
) -> DataFrame:
    """The fingerprint of each document beside those of its edited text and its next document.

    The next document has the next larger id (a bigint); the smallest follows the
    largest. Null ids come first, equal ids go by a hash of the text. The edited
    text has its last half, in code points, replaced by as much of the start of the
    next document. Returns the id, ``n_chars``, ``edited_sha256``, both fingerprints
    in hex (empty for an empty or null text), ``near_edited`` and ``near_next``. A
    single document is its own next; an empty table gives no rows. Other columns
    are not returned.
    """
    named = docs.select(
        F.col(id_col).cast("bigint").alias("_id"),
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(2**63))).alias("_order"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_tie"),
        F.col(text_col).alias("_text"),
    ).select("_order", "_tie", "_id", "_text")
    ordered = _in_ranges(named, _bounds(named, partition_bytes))
    schema = ("id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")
    return ordered.select("_edge", "_id", "_text").mapInArrow(_follow, schema).withColumnRenamed(
        "id", id_col
    )
