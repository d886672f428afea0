"""A corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs. All but the last return the
columns of ``documents``, with ``n_chars`` brought up to date with the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.llm.lines import dedup_lines
from tarnlake.llm.packing import pack_documents
from tarnlake.llm.quality import compression_quality
from tarnlake.llm.simhash import near_duplicate_groups
from tarnlake.llm.substring import dedup_substrings
from tarnlake.session import materialize, release, ship_package


def _like(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, n_chars counted anew."""
    size = F.length("text").cast("long")
    return found.select(*[size.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; null and empty texts fail the rules,
    repeated rows are judged alike, very long texts are judged whole."""
    ship_package(spark)
    return compression_quality(docs, only_kept=True).select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows go from the texts.

    Null texts stay null, empty ones empty; of repeated rows the later places
    go like any others, and a row whose lines all go keeps an empty text. Lines
    of very long texts are rows of their own.
    """
    return _like(dedup_lines(docs), docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document of least (id, text hash) stays.

    A document is an id with a text: different texts under one id are linked,
    kept and dropped on their own. Rows equal in id and text are one document;
    the row whose other columns hash least stands for it. Rows without an id
    stay: no group can name them. Null and empty texts link like any other,
    with one another; very long texts are read whole.
    """
    ship_package(spark)
    key = ["id", "text_hash", "rest_hash"]
    # Rows travel whole in one column, so that no name of theirs can clash.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rest = [F.col(f"row.`{c}`") for c in docs.columns if c not in ("doc_id", "text")] or [F.lit(0)]
    marked = rows.where("row.doc_id is not null").select(
        "row", F.col("row.doc_id").alias("id"), F.col("row.text").alias("text"),
        F.coalesce(F.sha2("row.text", 256), F.lit("")).alias("text_hash"), F.sha2(F.to_json(F.struct(*rest)), 256).alias("rest_hash"),
    )
    groups = near_duplicate_groups(marked.select(*key, "text"), keep=key)
    least = groups.groupBy("group").agg(F.min(F.struct(*key)).alias("least"))
    stay = materialize(least.select("least.*"), "stay")
    # Equal rows are folded inside the tasks first, so copies of one row never meet in one task.
    named = marked.dropDuplicates(key).join(stay, key, "left_semi")
    return named.select("row.*").unionByName(docs.where("doc_id is null"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more stay in the document of least id only.

    Null texts stay null, empty ones empty; repeated rows of one id keep their
    words, and rows without an id name no passage. Very long texts are whole.
    """
    ship_package(spark)
    return _like(dedup_substrings(docs, keep=docs.columns), docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in sequences of 1024 tokens; null and empty
    texts are a document of the end token, repeated rows documents of their own,
    very long texts are cut into pieces and lose nothing."""
    ship_package(spark)
    return pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: Compression ratios and fingerprints have no SQL form; tests hold the result
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
        release(*before)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
