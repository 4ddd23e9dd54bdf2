"""Operator 9, sharding by longest-processing-time scheduling.

Documents of equal text stay together. The schedule takes the largest group
first and gives it to the least loaded shard, held in a heap. Groups smaller
than a thousandth of a shard are bundled by hash first, so the schedule has a
bounded number of items whatever the size of the corpus: at most
``shards * parts`` large groups (their sizes sum to the total) and
``shards * parts`` bundles.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLOT_ROWS = 4096


def longest_first(items: list[tuple[int, tuple]], shards: int) -> dict[tuple, int]:
    """The shard of each (size, key); equal sizes go in the order of their keys."""
    heap = [(0, shard) for shard in range(shards)]
    chosen = {}
    for size, key in sorted(items, key=lambda x: (-x[0], x[1])):
        load, shard = heapq.heappop(heap)
        chosen[key] = shard
        heapq.heappush(heap, (load + size, shard))
    return chosen


def assign_shards(
    docs: DataFrame,
    shards: int = 24,
    text_col: str = "text",
    order_col: str = "doc_id",
    overhead: int = 8,
    parts: int = 500,
) -> DataFrame:
    """Documents with ``size``, ``text_crc32``, ``shard`` and ``slot``.

    ``size`` is the UTF-8 length of the text (null: 0) plus ``overhead``. Shards
    are near equal in size; a group of equal texts larger than a shard still
    stays whole. Null and empty texts are one group, repeated rows belong to one
    group, and ties of size go by hash. ``slot`` counts from 0 without gaps in
    each shard, in buckets of hashed ``order_col`` and text. An empty table gives
    no rows. A column with the name of an added one is replaced.
    """
    added = {"size", "text_crc32", "shard", "slot"}
    body = F.coalesce(F.col(text_col), F.lit(""))
    sized = docs.select(
        F.struct(*[docs[c] for c in docs.columns if c.lower() not in added]).alias("_row"),
        F.col(order_col).alias("_order"),
        (F.octet_length(body) + overhead).cast("bigint").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.xxhash64(body).alias("_group"),
    )
    total, rows = sized.agg(F.sum("size"), F.count("*")).first()
    limit = (total or 0) / (shards * parts)
    bundle = F.pmod("_group", F.lit(shards * parts))
    groups = sized.groupBy("_group").agg(F.sum("size").alias("bytes"))
    large = F.col("bytes") >= limit
    items = (
        groups.groupBy(large.alias("large"), F.when(large, F.col("_group")).otherwise(bundle)
                       .alias("key"))
        .agg(F.sum("bytes").alias("bytes"))
    )
    chosen = longest_first(
        [(r["bytes"], (r["large"], r["key"])) for r in items.toLocalIterator()], shards
    )
    placed = sized.withColumn("_bundle", bundle)
    for flag, key in ((True, "_group"), (False, "_bundle")):
        table = docs.sparkSession.createDataFrame(
            [(k, s) for (is_large, k), s in chosen.items() if is_large == flag],
            f"{key} bigint, _shard_{key} int",
        )
        placed = placed.join(F.broadcast(table), key, "left")
    placed = placed.withColumn("shard", F.coalesce("_shard__group", "_shard__bundle"))
    return _with_slots(placed, shards, rows).select(
        "_row.*", "size", "text_crc32", "shard", "slot"
    )


def _with_slots(placed: DataFrame, shards: int, rows: int) -> DataFrame:
    """Number the rows of each shard: buckets are counted first, then numbered one by one."""
    buckets = max(1, rows // (shards * SLOT_ROWS))
    bucket: Column = F.pmod(F.xxhash64("_order", "_group"), F.lit(buckets))
    placed = placed.withColumn("_bucket", bucket)
    earlier = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    begins = (
        placed.groupBy("shard", "_bucket").agg(F.count("*").alias("_n"))
        .select("shard", "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_from"))
    )
    inside = Window.partitionBy("shard", "_bucket").orderBy("_order", "_group")
    return (
        placed.withColumn("_nth", F.row_number().over(inside) - 1)
        .join(begins, ["shard", "_bucket"])
        .withColumn("slot", F.col("_from") + F.col("_nth"))
    )
