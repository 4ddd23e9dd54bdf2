"""Operator 13, exact join of documents by the Jaccard distance of their shingle sets.

The Jaccard distance is a metric, so a pivot's distances bound all others. Pivots alone
do not part a corpus: unrelated texts lie at distances of 0.95 to 1 from every pivot, and
a window of twice the radius takes each of them into every Voronoi region. Regions are
therefore cut first where two texts must meet whatever the data are: the shingles are
dealt by hash into more slices than two linked sets can differ in, so that at least one
slice is equal, and a region holds the sets of one such slice. Then

1. each region has a pivot, whose distance to every member is taken; members within the
   radius are linked to it. A set belongs to the Voronoi cell of the nearest of its pivots;
2. the members of regions in which two are still apart go through the same once more, in
   smaller regions: one around each of a set's rarest shingles, as many as a linked set can
   lack, and one more. Members that links have joined are not compared, nor those that sizes,
   the places of the shared shingle or, within a cell, the triangle inequality exclude:
   distances to one pivot differ by the radius at most. All others are, exactly.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktide.llm.arrow import VISIBLE, add_columns, find_words, mix, row_groups, text_buffers
from clicktide.llm.components import connected
from clicktide.session import new_scratch_dir

GROUP_BYTES = 4 << 20
#: A size class spans sizes whose ratio is the threshold to this power.
CLASS_STEPS = 3
#: Texts are chosen by a broadcast of so many hashes (32 bytes each) at most, and by a shuffle beyond.
BROADCAST_MARKS = 1 << 20
#: The shingles that are set apart as frequent, and the share of the sets that they are counted in.
FREQUENT, COUNTED = 1 << 17, 8

_LONGS = T.ArrayType(T.LongType())


def _shingles(buf: np.ndarray, offsets: np.ndarray, ngram: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of the shingles of each row."""
    words = find_words(buf, offsets, VISIBLE)
    n = np.diff(words.first)
    length = np.minimum(n, ngram)
    count = np.where(n >= ngram, n - ngram + 1, length > 0)
    ends = np.cumsum(count)
    row = np.repeat(np.arange(len(n)), count)
    first = words.first[row] + np.arange(len(row)) - np.repeat(ends - count, count)
    total = length[row].astype(np.uint64)
    for i in range(ngram):
        at = np.minimum(first + i, max(len(words.hashes) - 1, 0))
        step = mix(total * np.uint64(0x9E3779B97F4A7C15) + words.hashes[at])
        total = np.where(i < length[row], step, total)
    return [np.unique(total[e - c : e]) for e, c in zip(ends.tolist(), count.tolist(), strict=True)]


def size_classes(threshold: Fraction, top: int = 1 << 40) -> tuple[np.ndarray, np.ndarray]:
    """The least size of each class, and the slices of its regions.

    Two sets of sizes up to s that are linked differ in at most 2 s (1 - t) / (1 + t)
    shingles; there is one slice more than that.
    """
    starts = [1]
    while starts[-1] < top:
        starts.append(max(starts[-1] + 1, -int(-starts[-1] // threshold**CLASS_STEPS)))
    differ = [int(2 * (above - 1) * (1 - threshold) / (1 + threshold)) for above in starts[1:]]
    return np.array(starts[:-1]), np.array(differ) + 1


def _slices(
    sets: list[np.ndarray], threshold: Fraction, starts: np.ndarray, slices: np.ndarray
) -> list[np.ndarray]:
    """For each set the hashes of its slices, in its own size class and, near its end, the next."""
    size = np.array([len(one) for one in sets])
    flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    turn = mix(flat + np.uint64(0xD6E8FEB86659FD93))
    content = mix(flat ^ np.uint64(0xA0761D6478BD642F))
    owner = np.repeat(np.arange(len(sets)), size)
    own = np.searchsorted(starts, size, "right") - 1
    parts: list[list[np.ndarray]] = [[] for _ in sets]
    for step in (0, 1):
        kind = np.clip(own + step, 0, len(starts) - 1)
        due = size > 0
        if step:
            due &= size * threshold.denominator >= starts[kind] * threshold.numerator
        # With a single slice only equal sets meet, and these are one node already.
        due &= slices[kind] > 1
        n = np.where(due, slices[kind], 0)
        base = np.cumsum(n) - n
        inside = due[owner]
        at = base[owner[inside]] + (turn[inside] % np.maximum(n, 1)[owner[inside]].astype(np.uint64)).astype(np.int64)
        sums = np.zeros(int(n.sum()), np.uint64)
        np.add.at(sums, at, content[inside])
        nth = np.arange(len(sums)) - np.repeat(base, n)
        place = np.repeat(kind, n).astype(np.uint64) << np.uint64(40) | nth.astype(np.uint64)
        keys = mix(sums + mix(place + np.uint64(1)))
        for i in np.flatnonzero(n):
            parts[i].append(keys[base[i] : base[i] + n[i]])
    return [np.concatenate(p) if p else np.empty(0, np.uint64) for p in parts]


def _lists(values: list[np.ndarray]) -> pa.Array:
    places = np.cumsum([0, *(len(v) for v in values)])
    flat = np.concatenate(values) if values else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(flat.view(np.int64)))


def with_sets(
    docs: DataFrame, text_col: str, ngram: int, threshold: Fraction, whole: bool
) -> DataFrame:
    """Add the set's digest (a, b), its size n, and its ``slices`` or, if ``whole``, its ``shingles``."""
    column = [c.lower() for c in docs.columns].index(text_col.lower())
    starts, slices = size_classes(threshold)
    added = [T.StructField(name, T.LongType()) for name in ("a", "b", "n")]
    added.append(T.StructField("shingles" if whole else "slices", _LONGS))

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        buf, offsets = text_buffers(batch.column(column))
        parts = []
        for low, high in row_groups(offsets, GROUP_BYTES):
            sets = _shingles(buf[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], ngram)
            digests = np.frombuffer(
                b"".join(xxhash.xxh3_128_digest(one.tobytes()) for one in sets), np.int64
            ).reshape(-1, 2)
            last = sets if whole else _slices(sets, threshold, starts, slices)
            parts.append([pa.array(digests[:, 0]), pa.array(digests[:, 1]),
                          pa.array([len(one) for one in sets], pa.int64()), _lists(last)])
        return [pa.concat_arrays(same) for same in zip(*parts, strict=True)]

    return add_columns(docs, added, compute)


def _rarest(sets: DataFrame, frequent: list[int], counts: list[int], threshold: Fraction) -> DataFrame:
    """Rows (node, n, shingle, place): the first shingles of each set, frequent ones last.

    Two linked sets of which the larger has n shingles lack at most (1 - t) n of each other's,
    so the first ones, one more than that, have one in common.
    """
    order = np.argsort(np.array(frequent, np.int64))
    values, amount = np.array(frequent, np.int64)[order], np.array(counts, np.int64)[order]

    def run(batches):
        for batch in batches:
            lists = batch.column("shingles")
            places = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False)
            at = np.minimum(np.searchsorted(values, flat), max(len(values) - 1, 0))
            often = np.where(values[at] == flat, amount[at], 0) if len(values) else np.zeros(len(flat), np.int64)
            size = np.diff(places)
            owner = np.repeat(np.arange(len(size)), size)
            inside = slice(places[0], places[-1])
            ranked = np.lexsort((flat[inside], often[inside], owner))
            nth = np.arange(len(ranked)) - np.repeat(places[:-1] - places[0], size) + 1
            lacking = size * (threshold.denominator - threshold.numerator) // threshold.denominator
            first = nth <= (lacking + 1)[owner]
            nodes = batch.column("node").take(pa.array(owner[first]))
            yield pa.RecordBatch.from_arrays(
                [nodes, pa.array(size[owner[first]].astype(np.int64)), pa.array(flat[inside][ranked[first]]),
                 pa.array(nth[first])],
                names=["node", "n", "shingle", "place"],
            )

    return sets.select("node", "shingles").mapInArrow(run, "node bigint, n bigint, shingle bigint, place bigint")


class _Store:
    """Numbered tables below one scratch folder."""

    def __init__(self, like: DataFrame, label: str):
        self.spark, self.folder, self.count = like.sparkSession, new_scratch_dir(like.sparkSession, label), 0

    def put(self, frame: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.folder}/{self.count}"
        frame.write.parquet(path)
        return self.spark.read.parquet(path)


def _distances(pairs: DataFrame, sets: DataFrame, threshold: Fraction) -> DataFrame:
    """The pairs (x, y) of nodes with their shared shingles, size of union and whether they are linked."""
    left = sets.select(F.col("node").alias("x"), F.col("shingles").alias("p"))
    right = sets.select(F.col("node").alias("y"), F.col("shingles").alias("q"))
    shared = F.size(F.array_intersect("p", "q")).cast("bigint")
    found = pairs.join(left.hint("merge"), "x").join(right.hint("merge"), "y").select(
        "x", "y", shared.alias("shared"), (F.size("p") + F.size("q")).cast("bigint").alias("total")
    )
    union = F.col("total") - F.col("shared")
    linked = F.col("shared") * threshold.denominator >= union * threshold.numerator
    return found.select("x", "y", "shared", union.alias("joint"), linked.alias("linked"))


class _Join:
    """The links between nodes, found region by region."""

    def __init__(self, texts: DataFrame, nodes: DataFrame, ngram: int, threshold: Fraction):
        self.texts, self.nodes, self.ngram, self.threshold = texts, nodes, ngram, threshold
        self.store = _Store(texts, "jaccard-join")
        self.links: DataFrame | None = None
        self.sets: DataFrame | None = None

    def _sets(self, wanted: DataFrame) -> DataFrame:
        """(node, shingles) of the wanted nodes, made anew from one text of each."""
        chosen = self.store.put(
            self.nodes.select("node", "a", "b", "mark").join(wanted, "node", "left_semi")
        )
        whole, marks = chosen.select("node", "a", "b"), chosen.select("mark").distinct()
        if chosen.count() <= BROADCAST_MARKS:
            whole, marks = F.broadcast(whole), F.broadcast(marks)
        # Different texts of one mark give sets of their own, of which the wanted are told by 128 bits.
        made = with_sets(
            self.texts.join(marks, "mark", "left_semi").select("text"), "text", self.ngram, self.threshold, True
        )
        wanted_sets = made.select("a", "b", "shingles").join(whole, ["a", "b"])
        return wanted_sets.groupBy("node").agg(F.any_value("shingles").alias("shingles"))

    def _tested(self, pairs: DataFrame) -> DataFrame:
        """The distances of all pairs; links among them join the others."""
        done = self.store.put(_distances(pairs, self.sets, self.threshold))
        found = done.where("linked").select(F.col("x").alias("a"), F.col("y").alias("b"))
        self.links = found if self.links is None else self.links.union(found)
        return done

    def run(self) -> DataFrame:
        members = self.nodes.select(F.explode("slices").alias("region"), "node")
        sizes = members.groupBy("region").agg(F.count("*").alias("n_members")).where("n_members > 1")
        # A small table of regions joins without moving members; else two plain shuffles, which can be split.
        shared = self.store.put(members.join(self.store.put(sizes), "region"))
        # A set that meets many others is near the middle of them.
        met = shared.groupBy("node").agg(F.sum("n_members").alias("met"))
        best = F.max(F.struct("met", "node"))["node"].alias("pivot")
        weighed = self.store.put(shared.join(met, "node").drop("n_members"))
        placed = self.store.put(
            weighed.drop("met").join(weighed.groupBy("region").agg(best), "region")
        )
        # All that is compared later is in a region.
        self.sets = self.store.put(self._sets(placed.select("node").distinct()))
        stars = placed.where("node <> pivot").select(F.col("pivot").alias("x"), F.col("node").alias("y"))
        tested = self._tested(stars.distinct())
        roots = self.store.put(connected(self.links))
        rest = self._rest(self._open(placed, roots), roots, tested)
        self._tested(self._unlike(rest).join(tested, ["x", "y"], "left_anti"))
        return self.links

    def _open(self, placed: DataFrame, roots: DataFrame) -> DataFrame:
        """The nodes of regions in which two members besides the pivot are still apart."""
        grouped = placed.where("node <> pivot").join(roots, "node", "left")
        grouped = self.store.put(grouped.select("region", "node", F.coalesce("root", "node").alias("root")))
        apart = (
            grouped.groupBy("region").agg(F.min("root").alias("low"), F.max("root").alias("high"))
            .where("low <> high").select("region")
        )
        return grouped.join(apart, "region", "left_semi").select("node").distinct()

    def _rest(self, nodes: DataFrame, roots: DataFrame, tested: DataFrame) -> DataFrame:
        """The rarest shingles of each node, as many as decide, with their place in its order.

        Rarity is that in a share of these nodes; any one order of all shingles would be exact.
        """
        alike = F.col("shared") / F.col("joint")
        cells = tested.select(F.col("y").alias("node"), F.col("x").alias("cell"), alike.alias("alike")).union(
            tested.select("x", "x", F.lit(1.0)).distinct()
        ).groupBy("node").agg(F.max_by("cell", "alike").alias("cell"), F.max("alike").alias("alike"))
        sets = self.store.put(self.sets.join(nodes, "node", "left_semi"))
        counted = sets.where(F.pmod(F.xxhash64("node"), F.lit(COUNTED)) == 0)
        counts = counted.select(F.explode("shingles").alias("shingle")).groupBy("shingle").count()
        top = counts.where("count > 1").orderBy(F.desc("count"), "shingle").limit(FREQUENT).collect()
        known = _rarest(sets, [r["shingle"] for r in top], [r["count"] for r in top], self.threshold)
        known = known.join(roots, "node", "left").join(cells, "node", "left")
        return self.store.put(known.withColumn("root", F.coalesce("root", "node")))

    def _unlike(self, rare: DataFrame) -> DataFrame:
        """Pairs around a shingle that are still apart and that no bound excludes."""
        sizes = rare.groupBy("shingle", "root").agg(F.count("*").alias("n_same")).groupBy("shingle").agg(
            F.max_by("root", "n_same").alias("top"), F.count("*").alias("n_roots")
        )
        held = self.store.put(rare.join(sizes.where("n_roots > 1").drop("n_roots"), "shingle"))
        side = lambda end: held.select(
            "shingle", "top", *[F.col(c).alias(f"{end}_{c}") for c in ("node", "root", "n", "place", "cell", "alike")]
        )
        above, below = self.threshold.numerator, self.threshold.denominator
        x, y = (lambda c: F.col(f"x_{c}")), (lambda c: F.col(f"y_{c}"))
        left = 1 + F.least(x("n") - x("place"), y("n") - y("place"))
        # The margin is far above the rounding of the quotients and only lets more pairs pass.
        window = F.abs(x("alike") - y("alike")) <= float(1 - self.threshold) + 1e-9
        # The few nodes outside the largest group meet all others; within it none are apart.
        few = side("x").where("x_root <> top").drop("top")
        fits = (
            (F.col("few.shingle") == F.col("all.shingle")) & (x("root") != y("root"))
            & ((y("root") == F.col("top")) | (x("node") < y("node")))
            & (x("n") * below >= y("n") * above) & (y("n") * below >= x("n") * above)
            & (left * (above + below) >= (x("n") + y("n")) * above)
            & ((x("cell") != y("cell")) | window)
        )
        return few.alias("few").join(side("y").alias("all"), fits).select(
            F.least(x("node"), y("node")).alias("x"), F.greatest(x("node"), y("node")).alias("y")
        ).distinct()


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = 3,
    threshold: Fraction = Fraction(9, 10),
) -> DataFrame:
    """``id_col`` of each row with ``n_shingles`` and ``component_id``.

    Two texts are linked if their sets of distinct shingles share ``threshold`` of their
    union or more; ``component_id`` is the smallest id that links reach, the row's own
    included, null if all of them are null. A text of fewer words than ``ngram`` is one
    shingle. Null texts and texts without words have no shingles and are linked with
    nothing, not even one another. Rows repeated and ids repeated give a row each. Other
    columns are not returned; an empty table stays empty.

    Equal sets are one node, told by 128 bits; shingles are told apart by 64 bits.
    """
    store = _Store(docs, "jaccard")
    texts = docs.select(
        F.col(id_col).alias("_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("mark")
    )
    rows = store.put(with_sets(texts, "text", ngram, threshold, whole=False).drop("text"))
    distinct = rows.where("n > 0").groupBy("a", "b").agg(
        F.min("_id").alias("first"), F.min("mark").alias("mark"), F.any_value("slices").alias("slices")
    )
    nodes = store.put(distinct.withColumn("node", F.monotonically_increasing_id()))
    links = _Join(texts.select("text", "mark"), nodes, ngram, threshold).run()
    roots = store.put(connected(links))
    own = nodes.select("node", "a", "b", "first").join(roots, "node", "left")
    own = own.withColumn("root", F.coalesce("root", "node"))
    least = own.groupBy("root").agg(F.min("first").alias("component_id"))
    component = store.put(own.join(least, "root").select("a", "b", "component_id"))
    return rows.select("_id", "a", "b", "n").join(component, ["a", "b"], "left").select(
        F.col("_id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("_id")).alias("component_id"),
    )
