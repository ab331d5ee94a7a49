"""A training corpus from ``documents``: quality rules, near-duplicates, decontamination, mixing, token files.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's input, so a lost executor costs no more than the running stage. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm import decontamination, mixing, quality, simhash, token_files
from plumbline.llm.common import shared_folder, table
from plumbline.llm.queries import tokenizer_file


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that a rule rejects go, NULL and empty texts among them; repeated rows are judged alike."""
    return quality.quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: of each group of linked fingerprints (its own shingle length and radius) one document stays.

    Texts without words are one group; NULL ids lose against others; an empty table stays empty.
    """
    return simhash.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that hold a benchmark item go; NULL and empty texts and an empty benchmark drop nothing."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: a row for each document and epoch that the mix takes, with the words it takes.

    Texts without words are never taken; a NULL source is a source; an empty table stays empty.
    """
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: token files; a row for each document of them (doc_id, start, n_tokens, ids_crc32).

    NULL and empty texts hold the end id alone; rows with a NULL doc_id come first; no rows, no files.
    """
    return token_files.tokenize(docs, tokenizer_file())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("token_files", tokens),
]

#: Tokenizing and fingerprint groups have no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``, each from what its predecessor wrote."""
    folder = shared_folder(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{name}")
    return docs
