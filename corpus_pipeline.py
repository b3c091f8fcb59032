"""A corpus pipeline of five operators; each stage's rows are stored and read by the next."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlytics.llm import best_fit, line_dedup, line_rules, mixing, signature_trees
from adlytics.llm.common import shared_folder, table, words

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _with_text(rows: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """The columns of ``docs`` with another text, and ``n_chars`` where they have it."""
    changed = {"text": F.col(text), "n_chars": F.char_length(text).cast("bigint")}
    return rows.select(
        *(
            changed.get(c, F.col("__doc").getField(c)).cast(docs.schema[c].dataType).alias(c)
            for c in docs.columns
        )
    )


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; those kept lose their failed lines.

    NULL and empty texts fail the base rules and go; equal rows share one verdict. A short
    document fails the base rules too (fewer than 50 words), however clean it is.
    """
    kept = line_rules.kept_documents(line_rules.clean_lines(docs))
    return _with_text(kept, docs, "cleaned")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go; every document stays, a full copy empty.

    NULL text becomes empty; rows with one id count as one document and keep their lines.
    """
    return _with_text(line_dedup.dedup_lines(docs), docs, "kept_text")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 0.8 of their five-word shingles the one with the smallest id stays.

    Of equal rows one stays; documents without words are linked with nothing and all stay.
    """
    found = signature_trees.similar_documents(docs, width=5, percent=80)
    keepers = found.where("keeper").select("doc", "row").distinct()
    content = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(
        F.struct("*").alias("__doc"),
        F.col("doc_id").cast("bigint").alias("of_doc"),
        F.xxhash64(F.col("doc_id").cast("bigint"), content).alias("of_row"),
        F.size(words(content)).alias("n"),
    )
    same = (F.col("of_row") == F.col("row")) & F.col("of_doc").eqNullSafe(F.col("doc"))
    worded = keyed.where("n > 0").join(keepers, same, "left_semi")
    one_each = worded.groupBy("of_row", "of_doc").agg(F.first("__doc").alias("__doc"))
    empty = keyed.where("n = 0").select("__doc")
    return one_each.select("__doc").union(empty).select("__doc.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix takes them: taken twice, a document comes twice; words that the
    mix leaves out are gone.

    NULL, empty and blank texts have no words to take and go; a NULL source is one source;
    rows with one id and different texts are separate documents, and equal rows each give
    what the mix takes of them.
    """
    return _with_text(mixing.mixed_documents(docs), docs, "mixed_text")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of at most 1024 tokens.

    NULL text is empty and gives its end token alone; equal rows are packed each on their own.
    """
    path = public_tokenizers.path("byte_bpe_50k.json")
    return best_fit.pack(best_fit.token_pieces(docs, path, 2, 1024), 1024)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("best_fit", pack_sequences),
]

#: The mix draws its blocks at random numbers that SQL cannot repeat.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; every stage but the last is stored as Parquet."""
    root = f"{shared_folder(spark).rstrip('/')}/pipeline/{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
