"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a table, which is written as Parquet and read as the docs
of the next; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from biblioscope.llm import bpe, decontam, jaccard, rules, surrogates
from biblioscope.llm.queries import SURROGATE_KEY, tokenizer
from biblioscope.llm.shared import Work

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base limits, or that the label model holds for bad, go."""
    return rules.filtered(docs, rules.fit(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of texts that links of Jaccard similarity connect, one row with the smallest id stays.

    Rows that share an id but not their text are apart: each belongs to the group of its own text.  Of rows of one
    id and group one stays, the one with the smallest hash of its text; rows without an id link with nothing and stay.
    """
    # Ids in their order, and then texts by their hash; null for a null id.
    keyed = docs.withColumn("_key", F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text"))))
    found = jaccard.similar(Work(spark), keyed.select("_key", "text"), key="_key", ids=False)
    first = found.where("_key = component_id").select("_key").distinct()
    one = F.row_number().over(Window.partitionBy("_key").orderBy("_key"))
    kept = keyed.join(first, "_key", "left_semi").withColumn("_one", one).where("_one = 1").drop("_one", "_key")
    return kept.unionByName(docs.where("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark item in them go."""
    return decontam.clean(Work(spark), docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced; n_chars of such documents follows the new text."""
    new = surrogates.replaced(docs, surrogates.fit(Work(spark), docs, SURROGATE_KEY), counted="_entities")
    n_chars = F.when(F.col("_entities") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars").cast("long"))
    return new.withColumn("n_chars", n_chars).select(*docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, the token ids, how many, and whether decoding them gives the text again."""
    # Encoded and decoded by one worker: a second Python step would hold a second vocabulary and its texts.
    coded = bpe.encode(docs.select("doc_id", "source", "lang", "text"), tokenizer(spark), checked="round_trip")
    return coded.select("doc_id", "source", "lang", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip")


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("byte-level BPE", byte_bpe),
]

#: The label model, surrogates and tokens are not expressible in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written and read again."""
    work = Work(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = work.stage(stage(spark, docs, sf_dir))
    return docs
