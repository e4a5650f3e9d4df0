"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casepulse.llm import (
    chat,
    decontamination,
    langid,
    licenses,
    maxent,
    packing,
    pii,
    quality,
    resampling,
    secrets,
    simhash,
    simplex,
    topk,
)

Query = Callable[[SparkSession, str], DataFrame]
#: The key of the registered queries; whoever replaces real values chooses and keeps another.
PSEUDONYM_KEY = "corpus-pseudonyms-1"
#: The tokenizer files the queries use, in the folder that ``public_tokenizers`` names.
TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    held_out = langid.held_out("doc_id", 5)
    model = langid.learn(docs.where(~held_out))
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def op2_maxent(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return maxent.score(docs, langid.held_out("doc_id", 10))


def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return docs.select("doc_id", pii.pseudonymise(F.col("text"), PSEUDONYM_KEY).alias("text"), pii.count(F.col("text")).alias("n_values"))


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(_table(spark, folder, "documents"), tokenizer_path())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return quality.judge(docs, quality.references(docs))


def op7_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Each document is a file in the directory of its language in that of its source."""
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    files = _table(spark, folder, "documents").select("doc_id", path.alias("path"), "text")
    found = licenses.scan(files, carried=("doc_id",))
    return found.select("row.doc_id", "path", "own", "like", "licence", "origin")


def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find_secrets(_table(spark, folder, "documents"), tokenizer_path(RANKS))
    numbers = [secrets.number(F.col("spans"), kind).alias(f"n_{kind}") for kind in secrets.KINDS]
    base = secrets.listed(secrets.base_only(F.col("spans")))
    return found.select("doc_id", *numbers, F.sha2(base, 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"))


def op9_chat(spark: SparkSession, folder: str) -> DataFrame:
    return chat.repair(_table(spark, folder, "conversations"))


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op11_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.resample(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op12_topk(spark: SparkSession, folder: str) -> DataFrame:
    """Queries are the vectors whose id is divisible by 100."""
    return topk.search(_table(spark, folder, "embeddings"), F.pmod("vec_id", F.lit(100)) == 0)


def op13_centroids(spark: SparkSession, folder: str) -> DataFrame:
    found = simplex.cluster(_table(spark, folder, "embeddings"))
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))


QUERIES: dict[str, Query] = {
    "op1_language": op1_language,
    "op2_maxent": op2_maxent,
    "op3_pii": op3_pii,
    "op4_simhash": op4_simhash,
    "op5_packing": op5_packing,
    "op6_quality": op6_quality,
    "op7_licenses": op7_licenses,
    "op8_secrets": op8_secrets,
    "op9_chat": op9_chat,
    "op10_decontamination": op10_decontamination,
    "op11_resampling": op11_resampling,
    "op12_topk": op12_topk,
    "op13_centroids": op13_centroids,
}
