"""Operator 11, ranked lexical search by Block-Max MaxScore.

``build_index`` cuts the documents into shards of bounded text and writes, for each shard
and term, a postings list in blocks of 256 neighbouring documents: a byte for the place in
the block, and the frequency in as few bytes as the shard allows. Every block carries the pairs (frequency, document length)
that no other of its pairs dominates, so its greatest score is exact for any corpus
statistics, which are sums over the finished index.

``search`` brings the lists of the query terms of each shard together. For each query the
lists' bounds over the shard part them into essential lists and lists whose bounds together
stay below the score of the k-th best document found so far. Windows of blocks are taken in
the order of their bounds, those that cannot reach that score not at all. In a window the
essential lists are unpacked and scored; for the others the maximum of the one block that
could hold a candidate rejects it, and only blocks of surviving candidates are unpacked. A
task keeps one heap for each query over all its shards; the heaps are merged at the end.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clicktide.llm.arrow import ALNUM, LOWER, text_buffers
from clicktide.session import new_scratch_dir

#: Documents of a block; a place in it takes a byte.
BLOCK = 256
WINDOW_BLOCKS = 4
#: A shard ends at so many bytes of text or documents; a longer text is a shard of its own.
SHARD_BYTES, SHARD_DOCS = 8 << 20, 1 << 15
#: Query items that one pass over the index answers.
ITEMS_PER_PASS = 2000

INDEX_SCHEMA = (
    "shard bigint, term string, n_docs bigint, n_terms bigint, ids array<bigint>, "
    "blocks binary, sizes binary, places binary, tfs binary, "
    "front_sizes binary, front_tfs binary, front_lengths binary"
)
#: Types of the frequencies of a shard by their bytes.
_WIDTHS = {1: np.uint8, 2: np.uint16, 8: np.int64}
_NAMES = [column.split()[0] for column in INDEX_SCHEMA.split(", ")]


def _terms(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """For each term its number and row, and the distinct terms, in lower case (A-Z only)."""
    inside = ALNUM[buf]
    before = np.zeros(len(buf), bool)
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(buf)]] = False
    starts = np.flatnonzero(inside & ~before)
    ends_of_rows = np.searchsorted(starts, offsets)
    at = np.append(np.cumsum(inside, dtype=np.int32)[starts] - 1, int(inside.sum())) if len(starts) else np.zeros(1, np.int64)
    data = LOWER[buf[inside]]
    words = pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(at.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())
    ).dictionary_encode()
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(ends_of_rows))
    return words.indices.to_numpy().astype(np.int64), words.dictionary, row


def _front(tf: np.ndarray, length: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Which postings no other of their block dominates by a higher frequency and a shorter document."""
    order = np.lexsort((-tf, length, block))
    key = (block[order] << 32) + tf[order]
    best = np.maximum.accumulate(key)
    keep = np.ones(len(key), bool)
    keep[1:] = key[1:] > best[:-1]
    return order[keep]


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """One binary value for each list, of the bytes of its values."""
    places = np.concatenate([[0], ends]).astype(np.int32) * values.itemsize
    return pa.Array.from_buffers(
        pa.binary(), len(ends), [None, pa.py_buffer(places.astype(np.int32)), pa.py_buffer(values.tobytes())]
    )


def _index_rows(shard: int, ids: pa.Array, buf: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
    """The lists of one shard, ordered by term, after a row that holds its documents."""
    number, names, row = _terms(buf, offsets)
    n_rows = len(offsets) - 1
    length = np.bincount(row, minlength=n_rows)
    order = pc.sort_indices(names).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    key, tf = np.unique(rank[number] * n_rows + row, return_counts=True)
    term, doc = np.divmod(key, max(n_rows, 1))
    n_blocks = n_rows // BLOCK + 1
    cell = term * n_blocks + doc // BLOCK
    cells, cell_first, sizes = np.unique(cell, return_index=True, return_counts=True)
    front = _front(tf, length[doc], cell)
    front_sizes = np.bincount(np.searchsorted(cells, cell[front]), minlength=len(cells))
    lists = np.arange(len(order))
    term_of_cell = cells // n_blocks
    cell_ends = np.searchsorted(term_of_cell, lists, "right")
    posting_ends = np.searchsorted(term, lists, "right")
    front_ends = np.cumsum(front_sizes)[cell_ends - 1] if len(lists) else lists
    front_tf, front_length = tf[front], length[doc[front]]
    width = next(w for w in (np.uint8, np.uint16, np.int64) if tf.max(initial=0) <= np.iinfo(w).max)
    none = pa.nulls(len(order), pa.int64())
    lists_of = lambda values, kind, ends: _binary(values.astype(kind), ends)
    columns = [
        pa.array(np.full(len(order), shard)), names.take(pa.array(order)).cast(pa.string()),
        pa.array(np.diff(posting_ends, prepend=0)), none, pa.nulls(len(order), pa.list_(pa.int64())),
        lists_of(cells % n_blocks, np.int32, cell_ends), lists_of(sizes, np.int32, cell_ends),
        lists_of(doc % BLOCK, np.uint8, posting_ends), lists_of(tf, width, posting_ends),
        lists_of(front_sizes, np.int32, cell_ends), lists_of(front_tf, np.int64, front_ends),
        lists_of(front_length, np.int64, front_ends),
    ]
    of_docs = [
        pa.array([shard]), pa.nulls(1, pa.string()), pa.array([int((length > 0).sum())]), pa.array([int(length.sum())]),
        pa.ListArray.from_arrays(pa.array([0, n_rows], pa.int32()), ids.cast(pa.int64())), pa.nulls(1, pa.binary()),
        pa.array([length.astype(np.int64).tobytes()]), *[pa.nulls(1, pa.binary())] * 5,
    ]
    return pa.RecordBatch.from_arrays(
        [pa.concat_arrays(pair) for pair in zip(of_docs, columns, strict=True)], names=_NAMES
    )


def build_index(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the index of all ``docs`` to ``path``. ``id_col`` holds whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId() << 32
        ids: list[pa.Array] = []
        texts: list[np.ndarray] = []
        lengths: list[np.ndarray] = []
        held = rows = 0

        def flush() -> pa.RecordBatch:
            places = np.concatenate([[0], np.cumsum(np.concatenate(lengths))])
            return _index_rows(shard, pa.concat_arrays(ids), np.concatenate(texts), places)

        for batch in batches:
            buf, offsets = text_buffers(batch.column(1))
            low = 0
            while low < batch.num_rows:
                room = offsets[low] + SHARD_BYTES - held
                high = int(np.searchsorted(offsets, room, "right")) - 1
                high = min(high, low + SHARD_DOCS - rows, batch.num_rows)
                if high <= low and not rows:
                    high = low + 1
                if high > low:
                    ids.append(batch.column(0).slice(low, high - low))
                    texts.append(buf[offsets[low] : offsets[high]])
                    lengths.append(np.diff(offsets[low : high + 1]))
                    held, rows = held + int(offsets[high] - offsets[low]), rows + high - low
                    low = high
                if low < batch.num_rows:
                    yield flush()
                    shard += 1
                    ids, texts, lengths, held, rows = [], [], [], 0, 0
        if rows:
            yield flush()

    docs.select(F.col(id_col).cast("bigint"), F.col(text_col)).mapInArrow(run, INDEX_SCHEMA).write.parquet(path)


def item_terms(text: Column) -> Column:
    """The distinct terms of a text; null has none."""
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.regexp_extract_all(lower, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), F.lit(0))
    return F.array_distinct(words)


@dataclass(frozen=True)
class Statistics:
    """``n_docs`` with terms, all their terms, and the documents that hold each query term."""

    n_docs: int
    n_terms: int
    held: dict[str, int]

    def weight(self, term: str) -> int:
        return math.floor(1000 * math.log((2 * self.n_docs + 2) / (2 * self.held[term] + 1)))

    def norms(self, lengths: np.ndarray) -> np.ndarray:
        return 100 - 50 + (50 * lengths.astype(np.int64) * self.n_docs) // max(self.n_terms, 1)


def _impact(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 20 * norm)


def _spans(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... of count[i] numbers, one after another."""
    ends = np.cumsum(count)
    return np.repeat(first - (ends - count), count) + np.arange(int(ends[-1]) if len(ends) else 0)


class Shard:
    """The lists of one shard for the terms of all queries, still packed."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, lists: list[dict], stats: Statistics):
        self.ids, self.norms = ids, stats.norms(lengths)
        self.n_blocks = len(ids) // BLOCK + 1
        self.terms = {one["term"]: i for i, one in enumerate(lists)}
        self.weights = np.array([stats.weight(one["term"]) for one in lists], np.int64)
        read = lambda name, kind: np.frombuffer(b"".join(one[name] for one in lists), kind)
        n_cells = np.array([len(one["blocks"]) // 4 for one in lists], np.int64)
        owner = np.repeat(np.arange(len(lists)), n_cells)
        block = read("blocks", np.int32).astype(np.int64)
        sizes = read("sizes", np.int32).astype(np.int64)
        self.places = read("places", np.uint8)
        self.tfs = np.concatenate(
            [np.frombuffer(one["tfs"], _WIDTHS[len(one["tfs"]) // len(one["places"])]) for one in lists]
            or [np.empty(0, np.uint8)]
        )
        #: Where the postings of a block of a list begin, how many there are and their greatest score.
        self.first = np.zeros((len(lists), self.n_blocks), np.int64)
        self.count = np.zeros((len(lists), self.n_blocks), np.int64)
        self.most = np.zeros((len(lists), self.n_blocks), np.int64)
        self.first[owner, block] = np.cumsum(sizes) - sizes
        self.count[owner, block] = sizes
        if len(sizes):
            best = _impact(read("front_tfs", np.int64), stats.norms(read("front_lengths", np.int64)))
            front = read("front_sizes", np.int32).astype(np.int64)
            self.most[owner, block] = np.maximum.reduceat(best, np.cumsum(front) - front) * self.weights[owner]
        self.unpacked = 0

    def scores(self, lists: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the postings in these cells, unpacked."""
        count = self.count[lists, blocks]
        at = _spans(self.first[lists, blocks], count)
        doc = np.repeat(blocks * BLOCK, count) + self.places[at]
        self.unpacked += len(at)
        return doc, np.repeat(self.weights[lists], count) * _impact(self.tfs[at].astype(np.int64), self.norms[doc])


class Heap:
    """The k best documents of a query so far: highest score first, then least id, null last."""

    def __init__(self, k: int):
        self.k, self.score, self.id, self.known = k, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    @property
    def least(self) -> int:
        """A document of a lower score is not among the k best."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def put(self, score: np.ndarray, id_: np.ndarray, known: np.ndarray) -> None:
        score, id_, known = (
            np.concatenate(pair) for pair in ((self.score, score), (self.id, id_), (self.known, known))
        )
        best = np.lexsort((id_, ~known, -score))[: self.k]
        self.score, self.id, self.known = score[best], id_[best], known[best]


def rank(shard: Shard, known: np.ndarray, lists: np.ndarray, heap: Heap) -> None:
    """Put the best documents of a shard for the terms of ``lists`` into the heap."""
    most = shard.most[lists]
    bound = most.max(axis=1)
    order = np.argsort(bound, kind="stable")
    lists, most, reach = lists[order], most[order], np.cumsum(bound[order])
    edges = np.arange(0, shard.n_blocks, WINDOW_BLOCKS)
    top = np.maximum.reduceat(most, edges, axis=1)
    window_bound = top.sum(axis=0)
    for window in np.argsort(-window_bound, kind="stable"):
        least = heap.least
        if window_bound[window] < least:
            break
        essential = int(np.searchsorted(reach, least))  # the lists before it stay below the k-th score together
        low = int(edges[window])
        blocks = np.arange(low, min(low + WINDOW_BLOCKS, shard.n_blocks))
        rows, columns = np.nonzero(shard.count[lists[essential:]][:, blocks])
        doc, score = shard.scores(lists[essential:][rows], blocks[columns])
        total = np.zeros(len(blocks) * BLOCK, np.int64)
        np.add.at(total, doc - low * BLOCK, score)
        found = np.flatnonzero(total)
        rest = np.cumsum(top[:essential, window])
        for i in range(essential - 1, -1, -1):
            if not len(found):
                break
            block = found // BLOCK
            others = rest[i - 1] if i else 0
            found = found[total[found] + most[i, low + block] + others >= least]
            cells = low + np.unique(found // BLOCK)
            cells = cells[shard.count[lists[i], cells] > 0]
            doc, score = shard.scores(np.full(len(cells), lists[i]), cells)
            total[doc - low * BLOCK] += score
        found = found[total[found] >= least]
        if len(found):
            at = low * BLOCK + found
            heap.put(total[found], shard.ids[at], known[at])


def _shards(batches: Iterator[pa.RecordBatch], stats: Statistics) -> Iterator[tuple[Shard, np.ndarray]]:
    """The shards of rows sorted by shard and term; the documents of a shard come first."""
    held: list[dict] = []

    def whole() -> tuple[Shard, np.ndarray]:
        ids = held[0]["ids"]
        known = np.array([i is not None for i in ids], bool)
        values = np.array([0 if i is None else i for i in ids], np.int64)
        return Shard(values, np.frombuffer(held[0]["sizes"], np.int64), held[1:], stats), known

    for batch in batches:
        for row in batch.to_pylist():
            if held and row["shard"] != held[0]["shard"]:
                yield whole()
                held = []
            held.append(row)
    if held:
        yield whole()


def _pass(index: DataFrame, items: list[tuple[int, list[str]]], stats: Statistics, k: int) -> DataFrame:
    """The best documents by task: (number of the item, id, score)."""
    wanted = index.sparkSession.createDataFrame([(t,) for t in sorted(stats.held)], "term string")
    lists = index.join(F.broadcast(wanted), "term", "left_semi")  # the terms of ITEMS_PER_PASS items
    rows = lists.unionByName(index.where("term IS NULL")).select(_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = {number: Heap(k) for number, _ in items}
        for shard, known in _shards(batches, stats):
            for number, terms in items:
                lists = np.array([shard.terms[t] for t in terms if t in shard.terms], np.int64)
                if len(lists):
                    rank(shard, known, lists, heaps[number])
        for number, heap in heaps.items():
            if len(heap.score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(heap.id), number)), pa.array(heap.id, mask=~heap.known),
                     pa.array(heap.score)],
                    names=["_item", "doc_id", "score"],
                )

    dealt = rows.repartition("shard").sortWithinPartitions("shard", F.col("term").asc_nulls_first())
    return dealt.mapInArrow(run, "_item bigint, doc_id bigint, score bigint")


def _statistics(index: DataFrame, terms: list[str]) -> Statistics:
    docs = index.where("term IS NULL").agg(F.sum("n_docs"), F.sum("n_terms")).first()
    wanted = index.sparkSession.createDataFrame([(t,) for t in terms], "term string")
    held = index.join(F.broadcast(wanted), "term", "left_semi").groupBy("term").agg(F.sum("n_docs"))
    return Statistics(docs[0] or 0, docs[1] or 0, {t: n for t, n in held.collect()})


def search(
    spark: SparkSession, path: str, items: DataFrame, id_col: str = "item_id",
    text_col: str = "text", k: int = 50,
) -> DataFrame:
    """The ``k`` best documents of each row of ``items``: ``id_col``, ``rank``, ``doc_id``, ``score``.

    Items are read in passes of ``ITEMS_PER_PASS`` rows, so the driver holds no more than
    those. Null, empty and term-less items have no result; repeated items give their rows
    each. Equal scores stand by ascending id, null ids last.
    """
    index = spark.read.schema(INDEX_SCHEMA).parquet(path)
    scratch = new_scratch_dir(spark, "search")
    numbered = items.select(F.col(id_col).alias("_id"), item_terms(F.col(text_col)).alias("_terms"))
    numbered.where(F.size("_terms") > 0).withColumn("_item", F.monotonically_increasing_id()).write.parquet(
        f"{scratch}/items"
    )
    numbered = spark.read.parquet(f"{scratch}/items")
    last, found = -1, 0
    while block := numbered.where(F.col("_item") > last).orderBy("_item").limit(ITEMS_PER_PASS).collect():
        last = block[-1]["_item"]
        stats = _statistics(index, sorted({t for row in block for t in row["_terms"]}))
        _pass(index, [(row["_item"], row["_terms"]) for row in block], stats, k).write.parquet(
            f"{scratch}/found/{found}"
        )
        found += 1
    columns = [F.col("_id").alias(id_col), F.col("rank").cast("int").alias("rank"), "doc_id", "score"]
    if not found:
        none = numbered.select("_id", F.lit(0).alias("rank"), F.lit(0).cast("bigint").alias("doc_id"),
                               F.lit(0).cast("bigint").alias("score"))
        return none.select(*columns).limit(0)
    heaps = spark.read.parquet(*[f"{scratch}/found/{i}" for i in range(found)])
    place = F.row_number().over(
        Window.partitionBy("_item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    )
    best = heaps.withColumn("rank", place).where(F.col("rank") <= k)
    return best.join(numbered.select("_item", "_id"), "_item").select(*columns)


def ranked_search(
    docs: DataFrame, items: DataFrame, doc_id_col: str = "doc_id", doc_text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", k: int = 50,
) -> DataFrame:
    """Index ``docs`` in the shared folder and search it for all ``items``.

    Null and empty documents have no terms and are in no result; repeated documents are
    ranked each. Columns other than the named ones are not read.
    """
    spark = docs.sparkSession
    path = f"{new_scratch_dir(spark, 'lexical-index')}/index"
    build_index(docs, path, doc_id_col, doc_text_col)
    return search(spark, path, items, item_id_col, item_text_col, k)
