"""Operator 5, removal of boilerplate lines by the number of sites they stand on.

Native: DataFrame functions only. Each line is hashed after trimming and lower
case; a HyperLogLog sketch of the sites is kept for each line hash and merged by
aggregation. A line whose estimate is well below ``min_sites`` stays; of one well above only
the different texts that hold it are still counted; for lines near the threshold the sites
are counted exactly.

Copies of one text on many sites are one text and make none of its lines boilerplate: a line
goes if it stands on ``min_sites`` sites and in as many different texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktide.session import new_scratch_dir

LG_K = 12
#: Ten standard errors of a sketch of 2 ** 12 registers (1.04 / 64 each).
BAND = 0.17


def _normal(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, r"\s+", " ")))


def _hash(normal: Column) -> Column:
    """128 bits of a line, as text-free columns a and b."""
    return F.struct(
        F.xxhash64(normal).alias("a"), F.xxhash64(F.lit("line"), normal, F.length(normal)).alias("b")
    )


def _lines(docs: DataFrame) -> DataFrame:
    """Every line with words: (hash, site, doc), the document known by a hash of its text."""
    lines = docs.select(
        F.col("_site"), F.col("_doc"), F.explode(F.split("_text", "\n")).alias("line")
    ).select("_site", "_doc", _normal(F.col("line")).alias("normal"))
    return lines.where("normal <> ''").select(
        _hash(F.col("normal")).alias("hash"), F.col("_site").alias("site"), F.col("_doc").alias("doc")
    )


def wide_lines(docs: DataFrame, min_sites: int) -> DataFrame:
    """(hash, doc) of lines on ``min_sites`` sites, in as many texts, once for each text that has one."""
    spark = docs.sparkSession
    path = new_scratch_dir(spark, "line-sites")
    lines = _lines(docs)
    sketches = lines.groupBy("hash").agg(
        F.hll_sketch_agg(F.coalesce("site", F.lit("\0")), F.lit(LG_K)).alias("sites")
    )
    spread = sketches.select("hash", F.hll_sketch_estimate("sites").alias("estimate"))
    low, high = min_sites * (1 - BAND), min_sites * (1 + BAND)
    spread.where(F.col("estimate") >= low).write.parquet(f"{path}/near")
    near = spark.read.parquet(f"{path}/near")
    lines.join(near, "hash").write.parquet(f"{path}/places")
    places = spark.read.parquet(f"{path}/places").distinct()
    exact = (
        places.where(F.col("estimate") < high).select("hash", "site").distinct()
        .groupBy("hash").agg(F.count("*").alias("n")).where(F.col("n") >= min_sites)
    )
    held = places.select("hash", "doc", (F.col("estimate") >= high).alias("sure")).distinct()
    held.write.parquet(f"{path}/held")
    held = spark.read.parquet(f"{path}/held")
    texts = held.groupBy("hash", "sure").agg(F.count("*").alias("n")).where(F.col("n") >= min_sites)
    wide = texts.where("sure").select("hash").union(
        texts.where("NOT sure").join(exact, "hash", "left_semi").select("hash")
    )
    return held.join(wide, "hash", "left_semi").select("hash", "doc")


def drop_wide_lines(
    docs: DataFrame,
    text_col: str = "text",
    site_col: str = "source",
    min_sites: int = 8,
) -> DataFrame:
    """Documents without the lines that stand on ``min_sites`` sites or more.

    Lines are equal after trimming, joining white space and lower case. All their
    occurrences go, however much of a text that is; a text may become empty. Lines that stand
    in fewer than ``min_sites`` different texts stay, on however many sites these are copied.
    Adds ``n_lines`` and ``n_removed``;
    a column with the name of an added one is replaced. Empty lines are never
    removed; a null site counts as one site, a null text stays null with no lines,
    an empty one has one line; repeated rows are treated alike.
    """
    added = {"n_lines", "n_removed"}
    names = [c for c in docs.columns if c.lower() not in added]
    others = [docs[c] for c in names if c.lower() != text_col.lower()]
    row = F.struct(*others, F.lit(0).alias("_"))
    named = docs.select(
        row.alias("_row"), F.col(text_col).alias("_text"), F.col(site_col).cast("string").alias("_site"),
        F.struct(F.xxhash64(text_col).alias("a"), F.xxhash64(F.lit("text"), text_col).alias("b")).alias("_doc"),
    )
    path = new_scratch_dir(docs.sparkSession, "line-removals")
    wide_lines(named.select("_text", "_site", "_doc"), min_sites).groupBy(
        F.col("doc").alias("_doc")
    ).agg(F.collect_list("hash").alias("_gone")).write.parquet(path)
    removals = docs.sparkSession.read.parquet(path)
    parts = F.split("_text", "\n")
    kept = F.filter(
        parts,
        lambda line: (_normal(line) == "") | ~F.array_contains("_gone", _hash(_normal(line))),
    )
    # Always a sort-merge join: one plan, whether few texts carry wide lines or most do.
    joined = named.join(removals.hint("merge"), "_doc", "left").withColumn(
        "_kept", F.when(F.col("_gone").isNotNull(), kept)
    )
    changed = F.col("_kept").isNotNull()
    text = F.when(changed, F.array_join("_kept", "\n")).otherwise(F.col("_text"))
    total = F.when(F.col("_text").isNull(), 0).otherwise(F.size(parts))
    removed = F.when(changed, F.size(parts) - F.size("_kept")).otherwise(0)
    return joined.select(
        *[(text if c.lower() == text_col.lower() else F.col("_row")[c]).alias(c) for c in names],
        total.cast("bigint").alias("n_lines"), removed.cast("bigint").alias("n_removed"),
    )
