"""Registered queries of the package, each over its whole table with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import (
    decontamination,
    licences,
    mixing,
    pieces,
    quality,
    secrets,
    sharding,
    simhash,
    spelling,
    token_files,
    urls,
    vector_codes,
    warc,
)
from plumbline.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf_dir, "pages"), urls.rules_frame(spark))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("file", "offset")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.tokenize(table(spark, sf_dir, "documents"), tokenizer_file())


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.mark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op10_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"), licences.known_digests(spark))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.digest(table(spark, sf_dir, "embeddings"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def queries() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_url_filters": urls.oracle(),
        "op2_sharding": sharding.oracle(),
        "op3_warc": warc.oracle(),
        "op6_quality_rules": quality.oracle(),
        "op8_mixing": mixing.oracle(),
        "op10_licence_scan": licences.oracle(),
        "op11_vector_codes": vector_codes.oracle(),
        "op12_spelling_variants": spelling.oracle(),
    }
