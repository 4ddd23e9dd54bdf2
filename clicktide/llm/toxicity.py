"""Operator 8, toxicity by class-conditional Kneser-Ney models.

Toxic and ordinary text have a model each, over pairs of words, words and beginnings of
words. A pair counts once for each different text that holds it. As Kneser and Ney have it, a
word counts as often as it follows a different word, so a word repeated in one text, or a
text copied a thousand times, adds little; a beginning counts as often as its words together. Each class takes ``DISCOUNT`` off its counts and hands what
it took to one backoff distribution shared by both, the counts of both classes
together; what is rare in either class is therefore rated alike by both. What the
shared counts of pairs were discounted goes to the words of each class:

    p(w | v, class) = (1 - b(v)) q(w | v, class) + b(v) p(w | class)

with q the discounted counts of the class behind v, smoothed by the shared ones, and b(v) the
discounted part of the shared counts behind v. So a pair that is rare in both classes
adds nothing to what its word says alone, and a phrase of ordinary words is rated as a phrase.

An expression's value is the difference of its two log-likelihoods beyond
``MARGIN``; a text's is the mean over its words. A logistic fit on labelled rows
that gave no counts turns it into a probability. All labelled rows outside the held-out fold give counts;
only the rows of the logistic fit are bounded.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktide.llm.arrow import ALNUM, LOWER, add_columns, find_words, mix, row_groups, text_buffers
from clicktide.session import new_scratch_dir

DISCOUNT = 3
MARGIN = 1.5
BEGINNING = 5
UPPER = np.uint64(0xFFFFFFFF00000000)
FOLDS = 5
HELD_OUT, CALIBRATION = 0, 4
GROUP_BYTES = 4 << 20
MAX_ROWS = 10_000
MAX_UNITS = 1 << 20
#: Labels go to all tasks up to so many rows (some 50 bytes each); beyond, texts are shuffled to them.
BROADCAST_LABELS = 1 << 20
ADDED = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]


class Table(NamedTuple):
    """An open hash table of 64-bit keys; key 0 marks a free place."""

    bits: int
    keys: np.ndarray
    values: np.ndarray
    probes: int


class Model(NamedTuple):
    """Values of expressions below ``path``, in ``blocks`` of which each fits a table, and the scale."""

    path: str
    blocks: int
    slope: float
    intercept: float

    def table(self, spark: SparkSession, block: int) -> Table:
        rows = spark.read.parquet(self.path).where(F.col("block") == block).select("unit", "value").toPandas()
        return make_table(
            rows["unit"].to_numpy(np.int64).view(np.uint64), rows["value"].to_numpy(np.float64)
        )


def _place(keys: np.ndarray, bits: int) -> np.ndarray:
    return (mix(keys) >> np.uint64(64 - bits)).astype(np.int64)


def make_table(keys: np.ndarray, values: np.ndarray) -> Table:
    bits = max(8, int(np.ceil(np.log2(4 * len(keys) + 1))))
    slots, held = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.float32)
    home, left, probes = _place(keys, bits), np.arange(len(keys)), 0
    while left.size:
        at = (home[left] + probes) & ((1 << bits) - 1)
        free = np.flatnonzero(slots[at] == 0)
        _, first = np.unique(at[free], return_index=True)
        won = free[first]
        slots[at[won]], held[at[won]] = keys[left[won]], values[left[won]]
        left = np.delete(left, won)
        probes += 1
    return Table(bits, slots, held, probes)


def look_up(table: Table, keys: np.ndarray) -> np.ndarray:
    """The value of each key, 0 if the table has none."""
    values = np.zeros(len(keys), np.float32)
    home, left = _place(keys, table.bits), np.arange(len(keys))
    for step in range(table.probes):
        at = (home[left] + step) & ((1 << table.bits) - 1)
        held = table.keys[at]
        same = held == keys[left]
        values[left[same]] = table.values[at[same]]
        left = left[~same & (held != 0)]
    return values


def expressions(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of all words, 32 bits of the word before, and the first word of each row.

    The upper half of a key are its first bytes, hashed; bit 0 marks a word, bit 1 one that is as long as a
    beginning. The first word of a row follows the row's edge.
    """
    words = find_words(buf, offsets, ALNUM)
    start = np.zeros(len(words.starts), np.uint64)
    for i in range(BEGINNING):
        at = words.starts + i
        inside = at < words.ends
        start = start << np.uint64(8)
        start[inside] |= LOWER[buf[at[inside]]]
    long = (words.ends - words.starts >= BEGINNING).astype(np.uint64) << np.uint64(1)
    word = mix(start) & UPPER | words.hashes & np.uint64(0xFFFFFFFC) | long | np.uint64(1)
    before = np.zeros(len(word), np.uint64)
    before[1:] = word[:-1]
    before[words.first[:-1][np.diff(words.first) > 0]] = 0
    before = (mix(before + np.uint64(77)) >> np.uint64(32)).astype(np.uint32)
    return word, before, words.first


def beginnings(word: np.ndarray) -> np.ndarray:
    """Keys of the beginnings of words; 0 for a shorter word, which would else count twice."""
    return np.where(word & np.uint64(2), word & UPPER | np.uint64(2), np.uint64(0))


def pair_keys(units: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Keys of units with the word before them; no word and no beginning has such a key."""
    return mix(units ^ mix(before.astype(np.uint64))) & ~np.uint64(3) | np.uint64(4)


def mean_values(table: Table, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the values of the words of each row over their number; 0 for a row without words."""
    word, before, first = expressions(buf, offsets)
    value = look_up(table, word) + look_up(table, beginnings(word)) + look_up(table, pair_keys(word, before))
    total = np.concatenate([[0.0], np.cumsum(value, dtype=np.float64)])
    return (total[first[1:]] - total[first[:-1]]) / np.maximum(1, np.diff(first))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and intercept by Newton's steps, with a weak pull towards 0.

    Without rows, or without a toxic one, nothing is ever called toxic.
    """
    if not (y > 0).any():
        return 0.0, -30.0
    fit = np.zeros(2)
    features = np.stack([x, np.ones(len(x))], 1)
    pull = np.array([1e-4, 1e-4])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(features @ fit, -30, 30)))
        slope = features.T @ (weight * (y - p)) - pull * fit
        curve = (features * (weight * p * (1 - p))[:, None]).T @ features + np.diag(pull)
        step = np.clip(np.linalg.solve(curve, slope), -50, 50)
        fit += step
        if np.abs(step).max() < 1e-6:
            break
    return float(fit[0]), float(fit[1])


def fold_of(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS


def _sample(labels: DataFrame, id_col: str, label_col: str, max_rows: int) -> DataFrame:
    """Labelled ids that may be learnt from: (_id, toxic, calibrates, weight).

    An id labelled more than once is toxic if any label says so. All rows that do not
    calibrate are kept; of those that do, about ``max_rows`` of each class are
    drawn by a hash of their id, and ``weight`` undoes it.
    """
    rows = (
        labels.where(F.col(label_col).isNotNull() & (fold_of(id_col) != HELD_OUT))
        .groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("toxic"))
        .withColumn("calibrates", fold_of("_id") == CALIBRATION)
    )
    draw = F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) / float(1 << 30)
    weight = F.when(~F.col("calibrates"), F.lit(1.0))
    for found in rows.where("calibrates").groupBy("toxic").count().collect():
        share = min(1.0, max_rows / found["count"])
        weight = weight.when((F.col("toxic") == found["toxic"]) & (draw < share), F.lit(1 / share))
    return rows.withColumn("weight", weight).where("weight IS NOT NULL")


def _once(rows: DataFrame, path: str) -> DataFrame:
    """One of the ``rows`` (_id, _text, toxic) for each different text of a class.

    Ids and digests choose the row, so texts are only shuffled where one row is there more than once.
    """
    text = F.coalesce("_text", F.lit(""))
    keyed = rows.withColumns({"_a": F.xxhash64(text), "_b": F.xxhash64(F.lit("text"), text)})
    named = keyed.groupBy("_a", "_b", "toxic", "_id").agg(F.count("*").alias("n"))
    least = named.groupBy("_a", "_b", "toxic").agg(F.min(F.struct("_id", "n")).alias("least"))
    least.select("_a", "_b", "toxic", "least.*").write.parquet(path)
    chosen = rows.sparkSession.read.parquet(path)
    if chosen.count() <= BROADCAST_LABELS:
        chosen = F.broadcast(chosen)
    key = ["_id", "_a", "_b", "toxic"]
    single = keyed.join(chosen.where("n = 1"), key)
    repeated = keyed.join(chosen.where("n > 1"), key).dropDuplicates(key)
    return single.select("_text", "toxic").union(repeated.select("_text", "toxic"))


def _contexts(batches):
    """Pairs of a word and the word before it, with the number of texts of each class that hold them.

    Summed over each group of a batch's texts.
    """
    for batch in batches:
        buf, offsets = text_buffers(batch.column(0))
        toxic = batch.column(1).to_numpy(zero_copy_only=False)
        for a, b in row_groups(offsets, GROUP_BYTES):
            word, before, first = expressions(
                buf[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            )
            row = np.repeat(np.arange(a, b), np.diff(first))
            pair = pair_keys(word, before)
            _, once = np.unique(mix(pair ^ mix(row.astype(np.uint64))), return_index=True)
            _, at, which = np.unique(pair[once], return_index=True, return_inverse=True)
            t = np.bincount(which, toxic[row[once]], len(at)).astype(np.int32)
            o = np.bincount(which, minlength=len(at)).astype(np.int32) - t
            at = once[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(word[at].view(np.int64)), pa.array(before[at].view(np.int32)),
                 pa.array(t), pa.array(o)],
                names=["unit", "before", "t", "o"],
            )


def _with_beginnings(words: DataFrame) -> DataFrame:
    """Counted words, and their beginnings with the counts of their words together."""
    unit = F.col("unit")
    begins = unit.bitwiseAND(-(1 << 32)).bitwiseOR(2).alias("unit")
    counts = [F.sum(c).alias(c) for c in ("t", "o")]
    return words.union(words.where(unit.bitwiseAND(2) == 2).groupBy(begins).agg(*counts))


def _beyond_margin(differs: Column) -> Column:
    return F.signum(differs) * F.greatest(F.abs(differs) - MARGIN, F.lit(0.0))


def _chances(counted: DataFrame) -> DataFrame:
    """Units with their probabilities ``p_t`` and ``p_o`` in the two classes; none if a class has no units."""
    kind = F.col("unit").bitwiseAND(1)
    totals = counted.groupBy(kind.alias("kind")).agg(
        *[F.sum(c).cast("double").alias(f"all_{c}") for c in ("t", "o")],
        *[F.sum(F.least(F.col(c), F.lit(DISCOUNT))).cast("double").alias(f"spare_{c}")
          for c in ("t", "o")],
    )
    shared = (F.col("t") + F.col("o")) / (F.col("all_t") + F.col("all_o"))
    chance = {
        c: (F.greatest(F.col(c) - DISCOUNT, F.lit(0)) + F.col(f"spare_{c}") * shared)
        / F.col(f"all_{c}")
        for c in ("t", "o")
    }
    return (
        counted.join(F.broadcast(totals), kind == F.col("kind"))
        .where("all_t > 0 AND all_o > 0")
        .select("unit", chance["t"].alias("p_t"), chance["o"].alias("p_o"))
    )


def _values(counted: DataFrame) -> DataFrame:
    """Units whose two log-likelihoods differ by more than the margin, with that difference."""
    value = _beyond_margin(F.log(F.col("p_t") / F.col("p_o")))
    return _chances(counted).select("unit", value.alias("value")).where("value <> 0")


def _pair_values(pairs: DataFrame, chances: DataFrame) -> DataFrame:
    """Pairs (unit, before) with what they add to the value of the unit alone.

    Pairs whose shared count is within the discount add nothing, by the formula above.
    """
    spare = lambda count: F.sum(F.least(count, F.lit(DISCOUNT)))
    both = F.col("t") + F.col("o")
    contexts = pairs.groupBy("before").agg(
        *[F.sum(c).alias(f"all_{c}") for c in ("t", "o")],
        *[spare(F.col(c)).alias(f"spare_{c}") for c in ("t", "o")],
        (spare(both) / F.sum(both)).alias("backoff"), (F.sum(both) - spare(both)).alias("mass"),
    )
    # A backoff of 1 means that no pair behind this word is beyond the discount.
    known = pairs.where(both > DISCOUNT).join(contexts, "before").join(chances, "unit")
    shared = (both - DISCOUNT) / F.col("mass")
    chance = {}
    for c in ("t", "o"):
        held = (F.greatest(F.col(c) - DISCOUNT, F.lit(0)) + F.col(f"spare_{c}") * shared) / F.col(f"all_{c}")
        behind = F.when(F.col(f"all_{c}") > 0, held).otherwise(shared)
        chance[c] = (1 - F.col("backoff")) * behind + F.col("backoff") * F.col(f"p_{c}")
    value = _beyond_margin(F.log(chance["t"] / chance["o"])) - _beyond_margin(F.log(F.col("p_t") / F.col("p_o")))
    return known.select("unit", "before", value.alias("value")).where("value <> 0")


def _keyed(batches):
    """(unit, before, value) as (unit, value), the unit now the key of the pair."""
    for batch in batches:
        unit, before = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        keys = pair_keys(unit.view(np.uint64), before.view(np.uint32))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.view(np.int64)), batch.column(2)], names=["unit", "value"]
        )


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_rows: int = MAX_ROWS,
    max_units: int = MAX_UNITS,
    order: int = 2,
) -> Model:
    """Learn from the labelled rows outside the held-out fold.

    Rows whose crc32 of the id modulo 5 is 4 fit the logistic scale, 1 to 3 give the
    counts, 0 gives nothing. ``max_rows`` bounds the rows of each class that fit the scale (as
    drawn by hash), ``max_units`` the expressions of one block of the model; a
    larger model has more blocks. ``order`` 1 leaves the pairs of words out. Labels with a null, and
    ids without a document, teach nothing.
    """
    spark = docs.sparkSession
    path = new_scratch_dir(spark, "toxicity")
    _sample(labels, id_col, label_col, max_rows).write.parquet(f"{path}/labels")
    chosen = spark.read.parquet(f"{path}/labels")
    if chosen.count() <= BROADCAST_LABELS:
        chosen = F.broadcast(chosen)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(chosen, "_id")
    texts = _once(rows.where("NOT calibrates").select("_id", "_text", "toxic"), f"{path}/texts")
    found = texts.mapInArrow(_contexts, "unit bigint, before int, t int, o int")
    # Read three times: for the counts of words, for what follows a word, and for the frequent pairs.
    found.groupBy("unit", "before").agg(F.sum("t").alias("t"), F.sum("o").alias("o")).write.parquet(
        f"{path}/pairs"
    )
    pairs = spark.read.parquet(f"{path}/pairs")
    follows = [F.sum((F.col(c) > 0).cast("int")).alias(c) for c in ("t", "o")]
    # Read again: for the beginnings, for the sums of all, and for each unit.
    pairs.groupBy("unit").agg(*follows).write.parquet(f"{path}/counts")
    counted = _with_beginnings(spark.read.parquet(f"{path}/counts"))
    values = _values(counted)
    if order > 1:
        added = _pair_values(pairs, _chances(counted)).mapInArrow(_keyed, "unit bigint, value double")
        values = values.union(added)
    values.write.parquet(f"{path}/values")
    values = spark.read.parquet(f"{path}/values")
    blocks = max(1, -(-values.count() // max_units))
    # A few more expressions than the bound may fall to a block by chance.
    block = F.pmod(F.xxhash64("unit"), F.lit(blocks)).alias("block")
    values.select("unit", "value", block).write.parquet(f"{path}/units")
    model = Model(f"{path}/units", blocks, 0.0, 0.0)
    held = _with_means(rows.where("calibrates").select("_text", "toxic", "weight"), "_text", model)
    seen = held.select("mean", "toxic", "weight").toPandas()
    slope, intercept = fit_logistic(
        seen["mean"].to_numpy(np.float64), seen["toxic"].to_numpy(np.float64),
        seen["weight"].to_numpy(np.float64),
    )
    return model._replace(slope=slope, intercept=intercept)


def _with_means(docs: DataFrame, text_col: str, model: Model, name: str = "mean") -> DataFrame:
    """The rows with the mean value of their words: each block of the model adds its part."""
    kept = docs.columns
    parts = []
    for i in range(model.blocks):
        parts.append(f"{name}_{i}_of_{model.blocks}")
        docs = _with_part(docs, text_col, model.table(docs.sparkSession, i), parts[-1])
    total = sum((F.col(p) for p in parts[1:]), F.col(parts[0]))
    return docs.select(*[F.col(f"`{c}`") for c in kept], total.alias(name))


def _with_part(docs: DataFrame, text_col: str, table: Table, name: str) -> DataFrame:
    column = [n.lower() for n in docs.columns].index(text_col.lower())
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        buf, offsets = text_buffers(batch.column(column))
        parts = [
            mean_values(shared.value, buf[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            for a, b in row_groups(offsets, GROUP_BYTES)
        ]
        return [pa.array(np.concatenate(parts))]

    return add_columns(docs, [T.StructField(name, T.DoubleType())], compute)


def score_toxicity(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Documents with ``score``, the probability of being toxic, and ``predicted`` (1 from 0.5 on).

    Only the text is used. Null and empty texts get the score of a text without
    evidence; repeated rows get equal scores. A column that has the name of an
    added one is replaced.
    """
    clear = docs.select(*[c for c in docs.columns if c.lower() not in ("score", "predicted")])
    mean = "_mean"
    while mean in {c.lower() for c in clear.columns}:
        mean += "_"
    means = _with_means(clear, text_col, model, mean)
    score = 1 / (1 + F.exp(-(F.lit(model.slope) * F.col(mean) + F.lit(model.intercept))))
    return (
        means.withColumn("score", score)
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
        .drop(mean)
    )
