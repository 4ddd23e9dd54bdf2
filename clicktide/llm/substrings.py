"""Operator 3, repeated text by hashing lines and sentences.

A unit is a sentence, or what a line has after its last: it ends at a line feed, at a full
stop, an exclamation or question mark before white space, or at one of their full-width
forms. Its words in lower case give a 128-bit digest. Digests are grouped over all documents;
the occurrence with the smallest (document, place) stays. Units of any length count, and those
of a document that repeat and adjoin are one run; a run as long as a passage goes as a whole,
with its place in the original text, and shorter ones, that meet by chance, stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktide.llm.arrow import ALNUM, find_words, mix, row_groups, text_buffers
from clicktide.session import new_scratch_dir

GROUP_BYTES = 2 << 20
#: A run of so many bytes of units is a passage: some twenty English words, forty Chinese characters.
MIN_BYTES = 120
LINE_FEED = 10
STOPS = np.zeros(256, bool)
STOPS[[ord(c) for c in ".!?"]] = True
WHITE = np.zeros(256, bool)
WHITE[[32, 9, 13, 11, 12]] = True
#: The UTF-8 bytes of the full-width full stop, exclamation and question mark.
WIDE_STOPS = [(0xE3, 0x80, 0x82), (0xEF, 0xBC, 0x81), (0xEF, 0xBC, 0x9F)]


def _plain_stops(buf: np.ndarray) -> np.ndarray:
    """The bytes with a full-width stop as a full stop and two blanks, all places unchanged."""
    wide = np.zeros(max(len(buf) - 2, 0), bool)
    for a, b, c in WIDE_STOPS:
        wide |= (buf[:-2] == a) & (buf[1:-1] == b) & (buf[2:] == c)
    if not wide.any():
        return buf
    out, at = buf.copy(), np.flatnonzero(wide)
    out[at], out[at + 1], out[at + 2] = ord("."), 32, 32
    return out


def cut_units(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, number in its row, start, end, words, digest a, digest b) of each unit with words."""
    buf = _plain_stops(buf)
    words = find_words(buf, offsets, ALNUM)
    lines = np.flatnonzero(buf == LINE_FEED) + 1
    after_stop = np.flatnonzero(STOPS[buf[:-1]] & WHITE[buf[1:]]) + 1 if len(buf) else lines
    rows = np.diff(words.first)
    row_of = np.repeat(np.arange(len(rows)), rows)
    cuts = np.unique(np.concatenate([offsets[1:], lines, after_stop]))
    unit = np.searchsorted(cuts, words.starts, "right")
    first = np.flatnonzero(np.diff(unit, prepend=-1))
    if not len(first):
        none = np.empty(0, np.int64)
        return (*[none] * 5, none.astype(np.uint64), none.astype(np.uint64))
    count = np.diff(np.append(first, len(unit)))
    nth = np.arange(len(unit)) - np.repeat(first, count)
    # Sums of word hashes turned by the word's place in the unit.
    turned = words.hashes + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    a = np.add.reduceat(mix(turned), first)
    b = np.add.reduceat(mix(turned ^ np.uint64(0x5851F42D4C957F2D)), first)
    row = row_of[first]
    number = np.arange(len(first)) - np.searchsorted(row, row)
    start, end = words.starts[first] - offsets[row], words.ends[first + count - 1] - offsets[row]
    return row, number, start, end, count, a, b


def _text_key(text_col: str) -> list[Column]:
    return [F.xxhash64(text_col).alias("t1"), F.xxhash64(F.lit("text"), text_col).alias("t2")]


def _units(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = text_buffers(batch.column(3))
            for low, high in row_groups(offsets, GROUP_BYTES):
                row, nth, start, end, count, a, b = cut_units(
                    buf[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
                )
                keys = [batch.column(i).slice(low, high - low).take(pa.array(row)) for i in range(3)]
                places = [pa.array(x.astype(np.int32)) for x in (nth, start, end, count)]
                yield pa.RecordBatch.from_arrays(
                    [*keys, *places, pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
                    names=["id", "t1", "t2", "nth", "start", "end", "n_words", "a", "b"],
                )

    return docs.mapInArrow(
        run, "id bigint, t1 bigint, t2 bigint, nth int, start int, end int, n_words int, a bigint, b bigint"
    )


def _spans(docs: DataFrame, id_col: str, text_col: str, min_bytes: int) -> DataFrame:
    """Runs to remove, by document id and the hashes (t1, t2) of its text."""
    spark = docs.sparkSession
    path = new_scratch_dir(spark, "units")
    named = docs.select(F.col(id_col).cast("bigint").alias("id"), *_text_key(text_col), F.col(text_col).alias("text"))
    _units(named).write.parquet(f"{path}/units")
    units = spark.read.parquet(f"{path}/units")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "start", "t1", "t2")
    firsts = (
        units.groupBy("a", "b").agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where("first <> last").select("a", "b", "first")
    )
    firsts.write.parquet(f"{path}/firsts")
    firsts = spark.read.parquet(f"{path}/firsts")
    # A row repeated in full has the places of the first one.
    repeats = units.join(firsts, ["a", "b"]).where(place != F.col("first")).select(
        "id", "t1", "t2", "nth", "start", "end", "n_words", "first"
    ).dropDuplicates(["id", "t1", "t2", "nth"])
    in_text = Window.partitionBy("id", "t1", "t2").orderBy("nth")
    runs = repeats.withColumn("run", F.col("nth") - F.row_number().over(in_text)).groupBy("id", "t1", "t2", "run")
    return runs.agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n_words").cast("int").alias("n_words"),
        F.sum(F.col("end") - F.col("start")).alias("n_bytes"), F.min_by("first", "nth").alias("first"),
    ).where(F.col("n_bytes") >= min_bytes)


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = MIN_BYTES
) -> DataFrame:
    """Spans to remove: runs of adjoining units that stand in an earlier document or place too.

    ``start`` and ``end`` are places in the UTF-8 bytes of the original text, from
    the first word of the run to the end of its last; ``first_doc_id`` and
    ``first_start`` tell which occurrence of the run's first unit stays, the smallest by id and
    place (null ids come last). A run has ``min_bytes`` of units or more. Null and empty texts
    have no units. Rows repeated in full are one text, whose spans come once; texts that differ
    are told apart, whatever their ids. Other columns are not returned.
    """
    return _spans(docs, id_col, text_col, min_bytes).select(
        F.col("id").alias(id_col), "start", "end", "n_words",
        F.col("first.id").alias("first_doc_id"), F.col("first.start").alias("first_start"),
    )


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = MIN_BYTES
) -> DataFrame:
    """The documents with their ``repeated_spans`` cut out of the text; what lies around them stays."""
    cuts = _spans(docs, id_col, text_col, min_bytes).groupBy("id", "t1", "t2").agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("cuts")
    )
    names = docs.columns
    column = [n.lower() for n in names].index(text_col.lower())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(column).to_pylist()
            for i, found in enumerate(batch.column(len(names)).to_pylist()):
                body, out, at = (texts[i] or "").encode(), [], 0
                for span in found or ():
                    out.append(body[at : span["start"]])
                    at = span["end"]
                if found:
                    texts[i] = (b"".join(out) + body[at:]).decode()
            columns = batch.columns[: len(names)]
            columns[column] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).cast("bigint").alias("id"), *_text_key(text_col))
    same = rows["id"].eqNullSafe(cuts["id"]) & (rows["t1"] == cuts["t1"]) & (rows["t2"] == cuts["t2"])
    joined = rows.join(cuts, same, "left").select(
        *[F.col("row")[c].alias(f"c{i}") for i, c in enumerate(names)], "cuts"
    )
    return joined.mapInArrow(cut, docs.schema)
