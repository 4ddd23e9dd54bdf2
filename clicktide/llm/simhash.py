"""Operator 4, SimHash near-duplicates by multi-index hashing.

A fingerprint takes the majority of the hashes of a text's word shingles, bit by
bit. Equal fingerprints are one node. The bits are cut into segments, and a table for
each segment holds every fingerprint under its value there. Two fingerprints at most d
bits apart are at most d // m apart in one of m segments, so a fingerprint looks into each
table under all values of the small Hamming ball of that radius around its own, and
the complete distance of what it meets is verified.

A value that many fingerprints share is split by further segments: what agrees in one
agrees in one of d + 1 pieces of the remaining bits too, so the bucket of such a value is cut
into buckets of a value and a piece, and these again while they are large. Fingerprints are
distinct, so a bucket in which few bits are left free is small.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktide.llm.arrow import LOWER, VISIBLE, add_columns, find_words, mix, row_groups, text_buffers
from clicktide.llm.components import connected
from clicktide.session import new_scratch_dir

SEED = 42
GROUP_BYTES = 4 << 20
BITS = 64
#: A bucket of more fingerprints is split by further bits.
BUCKET = 256
LANES = T.ArrayType(T.LongType())

#: For each byte value, a 64-bit word whose byte j is bit j of the value.
SPREAD = (
    np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
    .view(np.uint64).ravel()
)


def shingle_hashes(buf: np.ndarray, offsets: np.ndarray, ngram: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of each shingle, and how many each row has.

    A row with fewer words than ``ngram``, but not none, is one shingle.
    """
    words = find_words(buf, offsets, VISIBLE)
    size = words.ends - words.starts
    at = np.cumsum(size + 1) - (size + 1)
    # The words in lower case, each followed by one blank.
    joined = np.full(int((size + 1).sum()), 32, np.uint8)
    letters = np.ones(len(joined), bool)
    letters[at + size] = False
    joined[letters] = LOWER[buf[VISIBLE[buf]]]
    text = joined.tobytes()
    n = np.diff(words.first)
    count = np.where(n >= ngram, n - ngram + 1, np.minimum(n, 1))
    row = np.repeat(np.arange(len(n)), count)
    first = words.first[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    last = first + np.minimum(ngram, n[row]) - 1
    digest = xxhash.xxh64_intdigest
    hashes = [
        digest(text[a:b], SEED)
        for a, b in zip(at[first].tolist(), (at[last] + size[last]).tolist(), strict=True)
    ]
    return np.array(hashes, np.uint64), count


def majority(hashes: np.ndarray, count: np.ndarray) -> np.ndarray:
    """One 64-bit fingerprint for each row of ``count`` hashes: bits set in over half of them."""
    out = np.zeros(len(count), np.uint64)
    rows = np.flatnonzero(count)
    if not len(rows):
        return out
    # Byte counters hold up to 255, so rows are summed in blocks of that many hashes.
    blocks = -(-count[rows] // 255)
    owner = np.repeat(np.arange(len(rows)), blocks)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    begin = (np.cumsum(count) - count)[rows][owner] + nth * 255
    spread = SPREAD[hashes.view(np.uint8).reshape(-1, 8)]
    sums = np.add.reduceat(spread, begin, axis=0).view(np.uint8).reshape(len(begin), 64)
    ones = np.add.reduceat(sums.astype(np.int64), np.cumsum(blocks) - blocks, axis=0)
    bits = (2 * ones > count[rows][:, None]).astype(np.uint8)
    out[rows] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def with_fingerprints(docs: DataFrame, text_col: str, ngram: int, lanes: int = 1) -> DataFrame:
    """Add ``lanes``, the fingerprint in parts of 64 bits; without words all bits are zero.

    The first part takes the XXH64 of the shingles, the others mix it further.
    """
    column = [n.lower() for n in docs.columns].index(text_col.lower())

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        buf, offsets = text_buffers(batch.column(column))
        parts = []
        for a, b in row_groups(offsets, GROUP_BYTES):
            hashes, count = shingle_hashes(
                buf[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], ngram
            )
            turned = [hashes] + [mix(hashes + np.uint64(i * 0x9E3779B9)) for i in range(1, lanes)]
            parts.append(np.stack([majority(h, count) for h in turned], 1))
        flat = np.concatenate(parts).ravel().view(np.int64)
        places = pa.array(np.arange(0, len(flat) + 1, lanes), pa.int32())
        return [pa.ListArray.from_arrays(places, pa.array(flat))]

    return add_columns(docs, [T.StructField("lanes", LANES)], compute)


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def pieces_of(mask: int, count: int) -> list[int]:
    """The bits of a mask as masks of ``count`` runs of about equal length; fewer where bits are few."""
    places = [b for b in range(BITS) if mask >> b & 1]
    edges = [len(places) * i // count for i in range(count + 1)]
    return [sum(1 << b for b in places[x:y]) for x, y in itertools.pairwise(edges) if x < y]


def ball(mask: int, radius: int) -> list[int]:
    """All ways to turn up to ``radius`` of the bits of a mask."""
    places = [b for b in range(BITS) if mask >> b & 1]
    chosen = itertools.chain.from_iterable(itertools.combinations(places, n) for n in range(radius + 1))
    return [sum(1 << b for b in some) for some in chosen]


def segment_count(rows: int, max_distance: int) -> int:
    """Segments about as wide as the logarithm of the rows, so that a value has few fingerprints by chance.

    One more than the distance is enough: then the balls have radius 0.
    """
    width = max(1, math.ceil(math.log2(max(rows, 2))))
    return max(1, min(BITS // width, max_distance + 1))


def _keyed(rows: DataFrame, masks: list[int], turns: dict[int, list[int]]) -> DataFrame:
    """Rows (mask, value, fingerprint): under each mask, with each way to turn its bits."""
    ways = [
        F.struct(F.lit(_signed(m)).cast("bigint").alias("mask"), F.lit(_signed(t)).cast("bigint").alias("turn"))
        for m in masks for t in turns[m]
    ]
    probes = rows.select("fingerprint", F.explode(F.array(*ways)).alias("way"))
    turned = F.col("fingerprint").bitwiseXOR(F.col("way.turn"))
    return probes.select(
        F.col("way.mask").alias("mask"), turned.bitwiseAND(F.col("way.mask")).alias("value"),
        turned.alias("turned"), "fingerprint",
    )


def _split(rows: DataFrame, finer: list[tuple[int, int]]) -> DataFrame:
    """The rows under each of their masks with each piece of its free bits; ``finer`` has (mask, finer mask)."""
    pairs = [(_signed(m), _signed(f)) for m, f in finer]
    wider = rows.sparkSession.createDataFrame(pairs, "mask bigint, finer bigint")
    cut = rows.join(F.broadcast(wider), "mask")  # a few masks at each depth, whatever the rows
    value = F.col("turned").bitwiseAND(F.col("finer")).alias("value")
    return cut.select(F.col("finer").alias("mask"), value, "turned", "fingerprint")


def close_links(fingerprints: DataFrame, max_distance: int = 2, segments: int | None = None) -> DataFrame:
    """All pairs (a, b) of distinct values of ``fingerprint`` that differ in ``max_distance`` bits or fewer."""
    if not 0 <= max_distance < BITS:
        raise ValueError("a distance is from 0 to 63 bits")
    spark = fingerprints.sparkSession
    path = new_scratch_dir(spark, "close-links")
    m = segments or segment_count(fingerprints.count(), max_distance)
    masks = pieces_of((1 << BITS) - 1, m)
    table = _keyed(fingerprints, masks, {mask: [0] for mask in masks})
    probes = _keyed(fingerprints, masks, {mask: ball(mask, max_distance // m) for mask in masks})
    # Without turned bits a fingerprint alone in its bucket meets none.
    least = 1 if max_distance // m else 2
    bucket, apart = ["mask", "value"], F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    depth = 0
    while True:
        sizes = table.groupBy(*bucket).agg(F.count("*").alias("n"))
        sizes.where(F.col("n") >= least).write.parquet(f"{path}/{depth}/sizes")
        sizes = spark.read.parquet(f"{path}/{depth}/sizes")
        # With so few free bits a bucket holds no more distinct fingerprints than that.
        few_bits = F.bit_count("mask") >= BITS - int(math.log2(BUCKET))
        small = (F.col("n") <= BUCKET) | few_bits
        index = table.join(sizes.where(small).select(*bucket), bucket).select(*bucket, F.col("fingerprint").alias("b"))
        seen = probes.select(*bucket, F.col("fingerprint").alias("a")).join(index, bucket)
        pairs = seen.where((F.col("a") < F.col("b")) & (apart <= max_distance)).select("a", "b").distinct()
        pairs.write.parquet(f"{path}/links/depth={depth}")
        large = sizes.where(~small).select(*bucket)
        if large.isEmpty():
            break
        table.join(large, bucket).write.parquet(f"{path}/{depth}/table")
        probes.join(large, bucket).write.parquet(f"{path}/{depth}/probes")
        left = [r["mask"] % (1 << BITS) for r in large.select("mask").distinct().collect()]
        finer = [(m, m | p) for m in left for p in pieces_of(((1 << BITS) - 1) & ~m, max_distance + 1)]
        table, probes = (
            _split(spark.read.parquet(f"{path}/{depth}/{kind}"), finer) for kind in ("table", "probes")
        )
        depth += 1
    return spark.read.parquet(f"{path}/links").select("a", "b").distinct()


def _roots(rows: DataFrame, max_distance: int) -> DataFrame:
    """Each distinct ``fingerprint`` of the rows (id, fingerprint) with ``root`` and ``component_id``."""
    spark = rows.sparkSession
    path = new_scratch_dir(spark, "simhash-roots")
    nodes = rows.groupBy("fingerprint").agg(F.min("id").alias("first"))
    nodes.write.parquet(f"{path}/nodes")
    nodes = spark.read.parquet(f"{path}/nodes")
    linked = connected(close_links(nodes.select("fingerprint"), max_distance))
    known = nodes.join(linked.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    known = known.withColumn("root", F.coalesce("root", "fingerprint"))
    least = known.groupBy("root").agg(F.min("first").alias("component_id"))
    # Read from a table, a later join meets two plain shuffles and Spark can split a hot fingerprint.
    known.join(least, "root").select("fingerprint", "root", "component_id").write.parquet(f"{path}/roots")
    return spark.read.parquet(f"{path}/roots")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       ngram: int = 3, max_distance: int = 2) -> DataFrame:
    """``id_col`` of each row with ``fingerprint`` (bigint) and ``component_id``.

    Rows whose fingerprints are within ``max_distance`` bits are linked; ``component_id`` is
    the smallest id that links reach, null if all of them are null. Texts that are
    null, empty or blank have fingerprint 0 and link like any other. Repeated
    rows and ids give a row each. Other columns are not returned.
    """
    spark = docs.sparkSession
    path = new_scratch_dir(spark, "simhash")
    with_fingerprints(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text", ngram
    ).select("id", F.col("lanes")[0].alias("fingerprint")).write.parquet(path)
    rows = spark.read.parquet(path)
    return rows.join(_roots(rows, max_distance), "fingerprint").select(
        F.col("id").alias(id_col), "fingerprint", "component_id"
    )


def hex_digits(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = 3, max_distance: int = 2
) -> DataFrame:
    """The documents, with one row left of each component of ``simhash_components``.

    The row with the smallest id stays; null ids come last, and of rows of one id the one that
    stands first in the input. Texts without words are one component. All columns are
    returned as they are, whatever their names; an empty table stays empty.
    """
    spark = docs.sparkSession
    path = new_scratch_dir(spark, "near-duplicates")
    lower = [c.lower() for c in docs.columns]
    names = [f"c{i}" for i in range(len(lower))]
    id_, text = (names[lower.index(c.lower())] for c in (id_col, text_col))
    with_fingerprints(docs.toDF(*names), text, ngram).select(
        *names, F.col("lanes")[0].alias("fingerprint"), F.monotonically_increasing_id().alias("row")
    ).write.parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows")
    ids = rows.select(F.col(id_).alias("id"), "fingerprint", "row")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    grouped = ids.join(_roots(ids, max_distance), "fingerprint").select("root", "row", order.alias("place"))
    grouped.write.parquet(f"{path}/groups")
    grouped = spark.read.parquet(f"{path}/groups")
    chosen = grouped.groupBy("root").agg(F.min("place").alias("place")).select(F.col("place.row").alias("row"))
    # The rows that go are few beside those that stay, so these move only where the former are many.
    gone = grouped.select("row").join(chosen, "row", "left_anti")
    gone.write.parquet(f"{path}/gone")
    return rows.join(spark.read.parquet(f"{path}/gone"), "row", "left_anti").select(*names).toDF(*docs.columns)
