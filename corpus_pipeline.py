"""A training corpus in five stages: from documents to packed sequences.

Every stage takes what the one before kept, as Parquet, and its decisions take
effect. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktide.llm.decontaminate import benchmark_hits
from clicktide.llm.lines import drop_wide_lines
from clicktide.llm.packing import pack_documents
from clicktide.llm.simhash import one_of_each
from clicktide.llm.toxicity import fit_toxicity, score_toxicity
from clicktide.session import new_scratch_dir, set_local_scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

MIN_SITES = 8
SHINGLE_WORDS, MAX_DISTANCE = 3, 2
SEQUENCE_TOKENS = 1024


def _columns(found: DataFrame, docs: DataFrame) -> DataFrame:
    return found.select(*docs.columns)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the models find more likely toxic than not go."""
    model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _columns(score_toxicity(docs, model).where("predicted = 0"), docs)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand on many sites go; ``n_chars`` follows the text."""
    found = drop_wide_lines(docs, min_sites=MIN_SITES)
    if "n_chars" in docs.columns:
        length = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
        found = found.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))
    return _columns(found, docs)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates by SimHash stays."""
    return one_of_each(docs, ngram=SHINGLE_WORDS, max_distance=MAX_DISTANCE)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go."""
    hits = benchmark_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _columns(hits.where("n_hit = 0"), docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining document as token pieces, each at its place in a sequence."""
    return pack_documents(docs.select("doc_id", "text"), tokens=SEQUENCE_TOKENS)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("line_dedup", without_boilerplate),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: The stages learn a model, take fingerprints and run a tokenizer, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents; each result is written to the shared folder and read again."""
    set_local_scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = new_scratch_dir(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
