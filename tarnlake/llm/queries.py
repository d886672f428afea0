"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.llm import sql
from tarnlake.llm.ann import nearest_neighbours
from tarnlake.llm.bpe import decode_documents, encode_documents
from tarnlake.llm.centroids import cluster_vectors
from tarnlake.llm.chat import fit_model, format_chats
from tarnlake.llm.codes import compress_vectors
from tarnlake.llm.html import extract_main_text
from tarnlake.llm.lines import dedup_lines
from tarnlake.llm.multiindex import near_duplicate_vectors
from tarnlake.llm.packing import pack_documents
from tarnlake.llm.quality import compression_quality
from tarnlake.llm.simhash import near_duplicate_components
from tarnlake.llm.substring import dedup_substrings
from tarnlake.llm.urls import filter_urls, page_outcomes


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_wrapper_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(_read(spark, sf_dir, "pages"), keep=["page_id", "url"])


def op2_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(_read(spark, sf_dir, "documents"), keep=["doc_id"])


def op4_segment_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_documents(_read(spark, sf_dir, "documents"), keep=["doc_id"])
    both = decode_documents(coded)
    digests = F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    return both.select("doc_id", "n_tokens", *digests)


def op5_simhash_covering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicate_components(_read(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("doc_id", "fingerprint", "component_id")


def op6_hmm_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each half of the conversations is read by a model fitted on the other."""
    talks = _read(spark, sf_dir, "conversations")
    half = F.pmod(F.xxhash64("conv_id"), F.lit(2))
    halves = [format_chats(talks.where(half == i), fit_model(talks.where(half != i))) for i in (0, 1)]
    turns = halves[0].unionByName(halves[1])
    digest = F.sha2("rendered", 256).alias("rendered_sha256")
    return turns.select("conv_id", "turn", "part", "role", "n_lines", digest)


def op7_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_quality(_read(spark, sf_dir, "documents"), keep=["doc_id"])


def op8_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_read(spark, sf_dir, "documents"))


def op9_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages")
    found = filter_urls(pages.select("page_id", "url"), page_outcomes(pages))
    return found.select("page_id", "host", "path", "rule", "verdict")


def op10_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed_lines", F.sha2("text", 256).alias("kept_sha256"))


def op11_vantage_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(_read(spark, sf_dir, "embeddings"))


def op12_multi_index_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(_read(spark, sf_dir, "embeddings"))


def op13_gnat_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress_vectors(_read(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_wrapper_extraction,
        op2_learned_partitions,
        op3_substring_dedup,
        op4_segment_tree_bpe,
        op5_simhash_covering,
        op6_hmm_chat_format,
        op7_compression_quality,
        op8_bin_completion,
        op9_url_reputation,
        op10_line_windows,
        op11_vantage_clustering,
        op12_multi_index_dedup,
        op13_gnat_codes,
    )
}
#: The other queries have no SQL form (compression ratios, XXH64 votes, token
#: merges, learned partitions, wrappers, Viterbi); tests hold them against
#: brute force or the public library instead.
ORACLE_SQL = {
    "op3_substring_dedup": sql.SUBSTRING,
    "op9_url_reputation": sql.URLS,
    "op10_line_windows": sql.LINES,
    "op11_vantage_clustering": sql.CLUSTERS,
    "op12_multi_index_dedup": sql.NEAR_VECTORS,
    "op13_gnat_codes": sql.CODES,
}
