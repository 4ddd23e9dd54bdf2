"""Operator 12, hard negatives by rotated one-bit codes.

Each vector is rotated (sign flips and Walsh-Hadamard transforms, the same everywhere) and
kept as a few one-bit codes: the first has the signs of the vector, each further one the
signs of what the codes before it leave. With a code its alignment with what it stands for
is stored, here multiplied by that vector's length, and at the end the length of the rest.

A query is rotated likewise and cut to whole numbers of a few bits, so that its product with
a code is a sum of population counts. Codes and alignments give an estimate of the inner
product. The rest is orthogonal to the last code, so by Cauchy and Schwarz its part is at most
its length times that of the query beside that code; with the query's own rounding this is an
interval that holds the exact product without exception. Only rows whose interval reaches
what is asked for are scored, in integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktide.session import new_scratch_dir

SEED = 42
ROUNDS = 3
LEVELS = 4
QUERY_BITS = 6
#: Anchors that one pass over all rows answers; the driver holds no more.
ANCHORS_PER_PASS = 4096
#: Rows and anchors that are compared at a time, and pairs that are scored at a time.
ROWS, ANCHORS, PAIRS = 1024, 256, 1 << 16
SHARES_PER_CORE = 2


def rotate(vectors: np.ndarray) -> np.ndarray:
    """The rows turned by one orthogonal map; their length is a power of two."""
    size = vectors.shape[1]
    draw = np.random.default_rng(SEED)
    out = vectors.astype(np.float64)
    for _ in range(ROUNDS):
        out = out * draw.choice((-1.0, 1.0), size)
        step = 1
        while step < size:
            pairs = out.reshape(len(out), -1, 2, step)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(len(out), size)
            step *= 2
        out /= np.sqrt(size)
    return out


def padded(vectors: list[np.ndarray], size: int) -> np.ndarray:
    out = np.zeros((len(vectors), size), np.int64)
    for i, one in enumerate(vectors):
        out[i, : len(one)] = one
    return out


def encode(vectors: np.ndarray, levels: int = LEVELS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (row, level, word), their alignments (row, level) and the length of the rest."""
    rest = rotate(vectors)
    root = np.sqrt(vectors.shape[1])
    codes, scales = [], []
    for _ in range(levels):
        bits = rest >= 0
        scale = np.abs(rest).sum(1) / root
        codes.append(np.packbits(bits, axis=1, bitorder="little").view(np.uint64))
        scales.append(scale)
        rest = rest - np.where(bits, 1.0, -1.0) * (scale / root)[:, None]
    return np.stack(codes, 1), np.stack(scales, 1), np.linalg.norm(rest, axis=1)


class Queries:
    """Vectors as whole numbers of ``QUERY_BITS`` bits, in planes of one bit."""

    def __init__(self, vectors: np.ndarray):
        turned = rotate(vectors)
        self.root = np.sqrt(vectors.shape[1])
        self.length = np.linalg.norm(turned, axis=1)
        self.low = turned.min(1)
        top = (1 << QUERY_BITS) - 1
        self.step = np.maximum((turned.max(1) - self.low) / top, 1e-300)
        units = np.clip(np.rint((turned - self.low[:, None]) / self.step[:, None]), 0, top).astype(np.int64)
        near = self.low[:, None] + units * self.step[:, None]
        self.total = near.sum(1)
        #: By this much the product with any code of length one can be wrong.
        self.error = np.abs(turned - near).sum(1) / self.root
        self.planes = np.stack(
            [np.packbits(units >> b & 1, axis=1, bitorder="little").view(np.uint64) for b in range(QUERY_BITS)], 1
        )

    def products(self, codes: np.ndarray, part: slice) -> np.ndarray:
        """The product of each code with each query of the part, by population counts."""
        planes = self.planes[part]
        ones = np.bitwise_count(codes).sum(1, dtype=np.int64)
        units = np.zeros((len(codes), len(planes)), np.int64)
        for b in range(QUERY_BITS):
            for word in range(codes.shape[1]):
                units += np.bitwise_count(codes[:, word, None] & planes[None, :, b, word]).astype(np.int64) << b
        inside = ones[:, None] * self.low[part] + units * self.step[part]
        return (2 * inside - self.total[part]) / self.root

    def intervals(
        self, codes: np.ndarray, scales: np.ndarray, rest: np.ndarray, part: slice
    ) -> tuple[np.ndarray, np.ndarray]:
        """Whole numbers between which the inner product of each row with each query lies."""
        estimate = np.zeros((len(codes), len(self.planes[part])))
        for level in range(codes.shape[1]):
            product = self.products(codes[:, level], part)
            estimate += scales[:, level, None] * product
        error = self.error[part]
        beside = np.maximum(self.length[part] ** 2 - np.maximum(np.abs(product) - error, 0) ** 2, 0)
        width = rest[:, None] * np.sqrt(beside) + scales.sum(1)[:, None] * error
        # Beyond all rounding of the sums above.
        width += 1e-9 * (scales.sum(1) + rest)[:, None] * self.length[part] + 1e-6
        return np.ceil(estimate - width).astype(np.int64), np.floor(estimate + width).astype(np.int64)


@dataclass
class Best:
    """The k best entries of each of many groups: highest score, least id, null ids last, then row."""

    k: int
    groups: int

    def __post_init__(self):
        self.group, self.score, self.id, self.row = (np.empty(0, np.int64) for _ in range(4))
        self.known = np.empty(0, bool)
        #: A score below it is not among the k best of its group.
        self.least = np.full(self.groups, np.iinfo(np.int64).min)

    def put(self, group, score, id_, known, row) -> None:
        near = score >= self.least[group]
        old = (self.group, self.score, self.id, self.known, self.row)
        new = (group[near], score[near], id_[near], known[near], row[near])
        group, score, id_, known, row = (np.concatenate(pair) for pair in zip(old, new, strict=True))
        order = np.lexsort((row, id_, ~known, -score, group))
        first = np.searchsorted(group[order], np.arange(self.groups))
        nth = np.arange(len(order)) - first[group[order]]
        kept = order[nth < self.k]
        self.group, self.score, self.id, self.known, self.row = (
            column[kept] for column in (group, score, id_, known, row)
        )
        last = order[nth == self.k - 1]
        self.least[group[last]] = score[last]


@dataclass
class Rows:
    """Some rows of the prepared table as arrays."""

    row: np.ndarray
    id: np.ndarray
    known: np.ndarray
    label: np.ndarray
    ints: np.ndarray
    codes: np.ndarray
    scales: np.ndarray
    rest: np.ndarray


PREPARED = "vec_id bigint, label bigint, ints binary, codes binary, scales binary, rest double"


def _prepared(vectors: DataFrame, size: int) -> DataFrame:
    """Rows (vec_id, label, vector) with whole components, codes and alignments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                lists = batch.column(2)
                flat = np.floor(256.0 * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
                places = lists.offsets.to_numpy() - lists.offsets[0].as_py()
                each = [flat[a:b] for a, b in zip(places[:-1], places[1:], strict=True)]
                if any(float(np.dot(one, one)) >= 2.0**61 for one in each):
                    raise ValueError("a vector is too long for 64-bit inner products")
                ints = padded(each, size)
                codes, scales, rest = encode(ints)
                narrow = ints.astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array([v.tobytes() for v in narrow], pa.binary()),
                     pa.array([c.tobytes() for c in codes], pa.binary()),
                     pa.array([s.tobytes() for s in scales], pa.binary()), pa.array(rest)],
                    names=["vec_id", "label", "ints", "codes", "scales", "rest"],
                )

    return vectors.mapInArrow(run, PREPARED)


def _read(batch: pa.RecordBatch, size: int) -> Rows:
    column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
    whole = lambda name, kind: np.frombuffer(b"".join(column[name].to_pylist()), kind)
    n, ids = batch.num_rows, column["vec_id"]
    return Rows(
        column["_row"].to_numpy(), ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False),
        column["label"].to_numpy(), whole("ints", np.int32).reshape(n, size).astype(np.int64),
        whole("codes", np.uint64).reshape(n, LEVELS, size // 64),
        whole("scales", np.float64).reshape(n, LEVELS), column["rest"].to_numpy(),
    )


@dataclass
class Anchors:
    """The anchors of a pass, and for the second step the scores of their positives."""

    row: np.ndarray
    label: np.ndarray
    ints: np.ndarray
    lowest: np.ndarray | None = None
    highest: np.ndarray | None = None


def _scored(rows: Rows, anchors: Anchors, r: np.ndarray, a: np.ndarray) -> np.ndarray:
    """The exact inner products of pairs of rows and anchors."""
    parts = [
        np.einsum("ij,ij->i", rows.ints[r[i : i + PAIRS]], anchors.ints[a[i : i + PAIRS]])
        for i in range(0, len(r), PAIRS)
    ]
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def _positives(rows: Rows, anchors: Anchors, queries: Queries, best: Best) -> None:
    for low in range(0, len(anchors.row), ANCHORS):
        part = slice(low, min(low + ANCHORS, len(anchors.row)))
        _, high = queries.intervals(rows.codes, rows.scales, rows.rest, part)
        wanted = (rows.label[:, None] == anchors.label[part]) & (rows.row[:, None] != anchors.row[part])
        r, a = np.nonzero(wanted & (high >= best.least[part]))
        a += low
        best.put(a, _scored(rows, anchors, r, a), rows.id[r], rows.known[r], rows.row[r])


def _negatives(rows: Rows, anchors: Anchors, queries: Queries, best: Best) -> None:
    """Groups are numbered anchor by anchor, one for each positive."""
    n = anchors.lowest.shape[1]
    for low in range(0, len(anchors.row), ANCHORS):
        part = slice(low, min(low + ANCHORS, len(anchors.row)))
        least, most = queries.intervals(rows.codes, rows.scales, rows.rest, part)
        reach = np.zeros(least.shape, bool)
        floor = np.maximum(anchors.lowest, best.least.reshape(-1, n))[part]
        for j in range(n):
            reach |= (most >= floor[:, j]) & (least <= anchors.highest[part][:, j])
        r, a = np.nonzero(reach & (rows.label[:, None] != anchors.label[part]))
        a += low
        score = _scored(rows, anchors, r, a)
        for j in range(n):
            fits = (score >= anchors.lowest[a, j]) & (score <= anchors.highest[a, j])
            k = r[fits]
            best.put(a[fits] * n + j, score[fits], rows.id[k], rows.known[k], rows.row[k])


def _over_rows(prepared: DataFrame, size: int, anchors: Anchors, step, k: int, groups: int) -> DataFrame:
    """The best entries of each task: (group, score, vec_id, row)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, best = Queries(anchors.ints), Best(k, groups)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                step(_read(whole.slice(at, ROWS), size), anchors, queries, best)
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.group), pa.array(best.score), pa.array(best.id, mask=~best.known), pa.array(best.row)],
            names=["group", "score", "vec_id", "row"],
        )

    return prepared.mapInArrow(run, "group bigint, score bigint, vec_id bigint, row bigint")


def _first(entries: DataFrame, k: int) -> DataFrame:
    """The k best of all tasks, with their rank."""
    order = [F.desc("score"), F.col("vec_id").asc_nulls_last(), F.col("row")]
    place = F.row_number().over(Window.partitionBy("group").orderBy(*order))
    return entries.withColumn("rank", place).where(F.col("rank") <= k)


def _takes_part(label: Column, vector: Column) -> Column:
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return label.isNotNull() & vector.isNotNull() & F.coalesce(sound, F.lit(False))


def hard_negatives(
    vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
    every: int = 100, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90,
) -> DataFrame:
    """For each anchor and each of its positives the nearest rows of other labels.

    Components are floor(256 x); a row's score is its integer inner product with the anchor,
    higher ones first, equal ones by id (null ids last). Anchors are the rows whose id is a
    multiple of ``every``; an anchor's positives are its first ``positives`` other rows of the
    same label. The negatives are the first ``negatives`` rows of another label whose score
    is from ``least`` to ``most`` percent of the positive's.

    Gives anchor_id, positive_id, rank, negative_id, positive_score, negative_score. Rows with
    a null label, a null vector or a component that is null or not finite take no part; a null
    id is no anchor. Repeated rows are rows of their own, also as anchors. A shorter vector
    counts as one that ends in zeros. Vectors too long for 64-bit products are an error.
    Empty tables and tables without anchors have no result; other columns are not read.
    """
    spark = vectors.sparkSession
    path = new_scratch_dir(spark, "hard-negatives")
    named = vectors.select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("bigint").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    ).where(_takes_part(F.col("label"), F.col("vector")))
    longest = named.agg(F.max(F.size("vector"))).first()[0] or 0
    size = max(64, 1 << (longest - 1).bit_length() if longest else 64)
    shares = spark.sparkContext.defaultParallelism * SHARES_PER_CORE
    # Vectors are small beside the work on them, so they are dealt out to all cores.
    _prepared(named, size).withColumn("_row", F.monotonically_increasing_id()).repartition(
        shares, "_row"
    ).write.parquet(f"{path}/rows")
    prepared = spark.read.parquet(f"{path}/rows")
    chosen = prepared.where(F.col("vec_id") % every == 0).select("_row", "vec_id", "label", "ints")
    last, found = -1, 0
    while block := chosen.where(F.col("_row") > last).orderBy("_row").limit(ANCHORS_PER_PASS).collect():
        last = block[-1]["_row"]
        anchors = Anchors(
            np.array([b["_row"] for b in block]), np.array([b["label"] for b in block]),
            np.stack([np.frombuffer(b["ints"], np.int32) for b in block]).astype(np.int64),
        )
        folder = f"{path}/found/{found}"
        _first(_over_rows(prepared, size, anchors, _positives, positives, len(block)), positives).write.parquet(
            f"{folder}/positives"
        )
        near = spark.read.parquet(f"{folder}/positives")
        score = np.zeros((len(block), positives), np.int64)
        known = np.zeros(score.shape, bool)
        for row in near.select("group", "rank", "score").collect():
            score[row["group"], row["rank"] - 1], known[row["group"], row["rank"] - 1] = row["score"], True
        # A missing positive asks for nothing.
        anchors.lowest = np.where(known, -((-least * score) // 100), 1)
        anchors.highest = np.where(known, (most * score) // 100, 0)
        entries = _over_rows(prepared, size, anchors, _negatives, negatives, score.size)
        ids = spark.createDataFrame([(i, b["vec_id"]) for i, b in enumerate(block)], "anchor bigint, anchor_id bigint")
        of = near.select(
            (F.col("group") * positives + F.col("rank") - 1).alias("group"), F.col("group").alias("anchor"),
            F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
        )
        _first(entries, negatives).join(of, "group").join(ids, "anchor").select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score"),
        ).write.parquet(f"{folder}/negatives")
        found += 1
    if not found:
        return spark.createDataFrame(
            [], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint,"
            " positive_score bigint, negative_score bigint"
        )
    return spark.read.parquet(*[f"{path}/found/{i}/negatives" for i in range(found)])
