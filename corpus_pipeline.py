"""From raw documents to packed training sequences, in five stages.

Each stage takes all that its predecessor kept, and its rows are written to the shared folder and
read again before the next one.  All but the last return the columns of `documents`.

Odd inputs: null and empty texts and texts without a letter go in the first stage; a null doc_id counts
as one after all others; repeated rows are alike in all stages; an empty table gives no rows; further
columns pass untouched whatever their names, but for n_chars, which follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from toolloom.llm import decontaminate, langid, line_dedup, packing, simhash
from toolloom.llm.common import cut, table

#: A document stays if its language is known with at least this probability, above an even chance among many.
LANGUAGE_SCORE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network knows; those without letters, or without a likely language, go.  With no labelled rows only those without letters go."""
    return langid.keep_known(docs, langid.train(docs), LANGUAGE_SCORE)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One line of each group of alike lines; documents that lose every line with a word go."""
    # the row as one column: names of its own beside it clash with none
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    out = line_dedup.dedup_lines(docs.select("doc_id", "text", row)).where((F.col("n_removed") == 0) | F.col("kept").rlike(r"[^\x20\x09-\x0D]"))
    return rewritten(out.select("row", F.col("kept").alias("text")), docs)


def rewritten(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs from `row`, with `text` and its length in place of theirs."""
    own = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return rows.select(*(own.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_first(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not benchmark text; shorter passages of it are cut out of the others."""
    out = decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    return packing.pack(docs)


STAGES = [("language", language), ("lines", lines), ("near_duplicates", near_duplicates), ("benchmark", benchmark), ("packed", packed)]

#: Trained networks, hashes and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
