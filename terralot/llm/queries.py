"""The queries opN_<name>: each applies its operator, with production parameters, to whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import encode_decode
from .common import in_training, table
from .jaccard_join import jaccard_join
from .packing import pack
from .quality_crf import fit_quality, score_quality
from .quality_rules import quality_rules
from .sql import SQL as SQL
from .token_store import read_tokens, write_tokens
from .topk import top_k
from .toxicity import fit_toxicity, score_toxicity
from .url_graph import judge_urls
from .zip_warc import read_archives, write_archives


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed by deficit round-robin at the corpus's own mixture."""
    return pack(table(spark, sf_dir, "documents"))


def held_out(scores: DataFrame) -> DataFrame:
    return scores.select("doc_id", F.coalesce(~in_training("doc_id"), F.lit(False)).alias("held_out"), "score", "predicted")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text, restored through the noisy channel."""
    docs = table(spark, sf_dir, "documents")
    return held_out(score_toxicity(docs, fit_toxicity(docs, table(spark, sf_dir, "labels"))))


def op3_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best of all vectors for each vector whose id is divisible by 50."""
    return top_k(table(spark, sf_dir, "embeddings"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts and verdicts of all documents, with their hosts' shrunk failure rates taken in."""
    rows = quality_rules(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded by merge ranks over a segment tree, and decoded again."""
    return encode_decode(table(spark, sf_dir, "documents"))


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as directly addressable codes in ascending doc_id, and read back."""
    return read_tokens(write_tokens(table(spark, sf_dir, "documents")))


def op7_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole text from the marginals of its lines."""
    docs = table(spark, sf_dir, "documents")
    return held_out(score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels"))))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents linked by 3-word shingles at a Jaccard similarity of 90 % or more."""
    rows = jaccard_join(table(spark, sf_dir, "documents"), n=3, percent=90)
    return rows.select("doc_id", "n_shingles", "component_id")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for every page's url, by rule or by its host's trust and distrust."""
    return judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op10_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record in ZIP packages, and read back by range."""
    rows = read_archives(write_archives(table(spark, sf_dir, "pages")))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = {f.__name__: f for f in (op1_packing, op2_toxicity, op3_pivot_topk, op4_quality_rules, op5_byte_bpe, op6_token_store, op7_quality_crf, op8_jaccard_join, op9_url_filter, op10_zip_warc)}
