"""Dealing out rows of which one key may hold a large part."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: One row in so many is a sample; so many samples of a key at most are kept.
ROWS_PER_SAMPLE, SAMPLES = 64, 1000
#: Samples of a chunk: of a key whose samples are all kept, and of a key that has more.
CHUNK, HOT_CHUNK = 16, 4


def row_chunks(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Add ``chunk``, which cuts the rows of a long key into runs in the order of ``order``.

    Cuts are values, not places: rows are sampled by a hash of what they hold, and a
    row's chunk is the number of its key's cuts before it. However often and wherever this
    is evaluated, a row has the same chunk. A short key is one chunk; a long one has about
    ROWS_PER_SAMPLE * CHUNK rows in each, or a 250th of the key where that is more. Rows
    equal in all of ``order`` share a chunk.
    """
    at = F.struct(*order)
    drawn = (
        df.select(key, at.alias("_at"), F.xxhash64(key, *order).alias("_draw"))
        .where(F.pmod("_draw", F.lit(ROWS_PER_SAMPLE)) == 0)
        .withColumn("_nth", F.row_number().over(Window.partitionBy(key).orderBy("_draw")))
        .where(F.col("_nth") <= SAMPLES)
    )
    samples = drawn.groupBy(key).agg(F.sort_array(F.collect_list("_at")).alias("_all"))
    step = F.when(F.size("_all") < SAMPLES, CHUNK).otherwise(HOT_CHUNK)
    cuts = samples.select(
        key, F.filter("_all", lambda _, i: (i + 1) % step == 0).alias("_cuts")
    ).where(F.size("_cuts") > 0)
    before = F.size(F.filter("_cuts", lambda cut: cut < at))
    return (
        df.join(cuts, key, "left")
        .withColumn("chunk", F.when(F.col("_cuts").isNull(), 0).otherwise(before)).drop("_cuts")
    )
