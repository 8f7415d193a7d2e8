"""The registered queries of the subpackage: each applies its operator to its whole table.

Every callable takes (spark, sf_dir), uses production parameters, and derives the digest columns
of its contract from the operator's own output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import hmm, lz, quality, spm, toxicity
from .collocations import collocations
from .common import fold_of, table
from .jaccard import jaccard_components
from .linededup import drop_common_lines
from .mixing import mix
from .reputation import Rule, judge_urls
from .search import search
from .simhash import simhash_components
from .warc import archive_round_trip

#: A SentencePiece model file that the driver can read.
SENTENCEPIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"

URL_RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return simhash_components(docs, width=4, radius=4).select("doc_id", "fingerprint", "component_id")


def op2_lz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lz.edit_likeness(table(spark, sf_dir, "documents"))


def op3_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's outcome is labels.quality of the row with its id: 1 good, 0 bad."""
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    judged = judge_urls(table(spark, sf_dir, "pages"), outcomes, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    index = toxicity.fit(docs, toxicity.training_fold(table(spark, sf_dir, "labels")))
    scored = toxicity.score(docs, index)
    return scored.select(
        "doc_id", (fold_of(F.col("doc_id")) == 0).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"), weights=(1, 2, 3), cap=3.0)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op6_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_common_lines(table(spark, sf_dir, "documents"), min_chars=1, min_docs=10)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes every whole text, decodes the ids again, and compares."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.char_length(text).cast("long").alias("chars"), F.sha2(text.cast("binary"), 256).alias("sha256"))
    vocabulary = spm.load_vocabulary(SENTENCEPIECE_MODEL)
    coded = spm.encode(docs, vocabulary, keep=("chars", "sha256"))
    back = F.sha2(spm.decode(F.col("token_ids"), vocabulary, spark).cast("binary"), 256)
    return coded.select(
        "doc_id", F.col("chars").alias("n_chars"), F.size("token_ids").cast("long").alias("n_tokens"),
        F.xxhash64("token_ids").alias("ids_xxh64"), back.alias("decoded_sha256"), (back == F.col("sha256")).alias("round_trip"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op9_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = hmm.score_texts(docs, fold_of(F.col("doc_id")) != 1)
    return scored.select(
        "doc_id", (fold_of(F.col("doc_id")) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = archive_round_trip(table(spark, sf_dir, "pages"), min_revisit=1000)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=50)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"), min_count=10, top=2000)


def op13_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), width=5, percent=80)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_lz": op2_lz,
    "op3_reputation": op3_reputation,
    "op4_toxicity": op4_toxicity,
    "op5_mixing": op5_mixing,
    "op6_linededup": op6_linededup,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_quality": op8_quality,
    "op9_hmm": op9_hmm,
    "op10_warc": op10_warc,
    "op11_search": op11_search,
    "op12_collocations": op12_collocations,
    "op13_jaccard": op13_jaccard,
}
