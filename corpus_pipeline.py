"""Corpus preparation in five stages, each over all that its predecessor kept.

1. quality classifier: documents that it rejects go;
2. line dedup: lines that many documents share go from all of them;
3. SimHash near-dedup: of each group of near-duplicates the document with the smallest id stays;
4. benchmark decontamination: documents that hold enough of a test item go;
5. BPE encoding: the token ids of every document left, checked by decoding them again.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet to the
shared folder and reads it again as the next stage's documents.  All but the last keep the columns of
``documents``.  ``n_chars`` is brought up to date where a stage changes texts.

Repeated rows and null ids: of rows that share an id and a text all stay or go together until near-dedup,
which keeps one of them; a null id ranks after all others of its group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.llm import decontam, lines, quality, simhash, wordbpe
from corpusprep.llm.common import saved, source
from corpusprep.llm.plans import VOCABULARY, crc_of


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold."""
    weights = quality.train(docs, source(spark, sf_dir, "labels"), usable=crc_of("doc_id") % 5 != 0)
    return quality.score(docs, weights).where(F.col("predicted") == 1).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without its frequent lines; one that loses all of them stays with an empty text, and the next
    stage keeps one of those."""
    out = lines.drop_frequent_lines(docs, min_docs=10, min_chars=1)
    n_chars = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs, shingle=3, distance=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by a test item."""
    return decontam.drop_contaminated(docs, source(spark, sf_dir, "benchmark"), width=13, share=20)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256): ids of every text, and digests after decoding them."""
    return wordbpe.encode_checked(docs, VOCABULARY)


STAGES = [
    ("quality classifier", quality_filter),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("BPE encoding and decoding", encoding),
]

# The classifier and the tokenizer have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = source(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
