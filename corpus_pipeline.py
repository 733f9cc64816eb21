"""A corpus pipeline: raw documents to packed training sequences.

Each stage gets the documents that the one before has kept and, but for the last, returns the
columns of ``documents``. Tables between stages are written as Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.llm import (
    find_contamination,
    first_rows,
    identify_languages,
    pack,
    remove_repeats,
)
from assayer.llm.frames import Workspace, pick
from assayer.llm.queries import byte_tokenizer, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told go: those without a letter, null texts among them, and those
    that lie between languages by the prediction. Where no language could be learned, the others stay all the same."""
    found = identify_languages(pick(docs, *COLUMNS), columns=COLUMNS[1:])
    return found.where("not letterless and not ambiguous").select(*COLUMNS)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays, null last. Rows are told
    apart by all their columns, not by the id; of rows equal in all of them one stays."""
    docs = pick(docs, *COLUMNS)
    # Nulls get another mark than any text, and every part has the same length, so that no two rows look alike.
    parts = [F.coalesce(F.sha2(F.col(c).cast("string").cast("binary"), 256), F.lit("-")) for c in COLUMNS]
    keyed = docs.withColumn("_row", F.sha2(F.concat_ws(",", *parts).cast("binary"), 256))
    firsts = first_rows(keyed, "_row", shingle=3, max_bits=2, seed=42)
    return keyed.join(firsts, "_row", "left_semi").dropDuplicates(["_row"]).select(*COLUMNS)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated strings of 200 bytes go from the texts; documents that were nothing else go with them."""
    docs = pick(docs, *COLUMNS)
    cut = remove_repeats(docs.withColumn("had", F.length("text") > 0), 200, ("lang", "source", "n_chars", "had"))
    kept = cut.where(~F.col("had") | F.col("had").isNull() | (F.length("text") > 0))
    return kept.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    docs = pick(docs, *COLUMNS)
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"), window=10, columns=COLUMNS[1:])
    return found.where("not contaminated").select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences."""
    pieces = pack(docs, byte_tokenizer(), size=1024)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language id", known_language),
    ("simhash near-dedup", one_of_near_duplicates),
    ("suffix-array dedup", without_repeats),
    ("benchmark decontamination", without_benchmark),
    ("packing", packed),
]

#: Models, hashes and tokenizers have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    work = Workspace(spark)
    for _, stage in STAGES[:-1]:
        docs = work.stage(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
