"""A corpus pipeline of five stages, each of which works on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canonlake.llm.common import staged
from canonlake.llm.decontaminate import decontaminate
from canonlake.llm.line_dedup import line_dedup
from canonlake.llm.near_text import one_of_each
from canonlake.llm.packing import pack_documents
from canonlake.llm.quality_rules import kept_documents, quality_rules
from canonlake.llm.queries import tokenizer_file

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _rewritten(docs: DataFrame) -> DataFrame:
    """The columns of documents, with the length of texts as they are now."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the robust outlier test reject go; the others are unchanged.

    Null and empty texts have no words and go. Rows that repeat an id are judged by their own texts. Null ids, languages and
    sources are values like others. Texts of any length are read whole.
    """
    return kept_documents(docs, quality_rules(docs)).select(*COLUMNS)


def shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that five documents share stay in the one with the largest id.

    Null texts stay null; null ids are no documents, and their lines stay. Rows that repeat an id count as one document.
    """
    return _rewritten(line_dedup(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that link by SimHash fingerprints, at two differing bits or fewer, or by five-word shingles, at a similarity of 0.8 or more, the one with the least id stays.

    Two bits miss most texts of similarity 0.8, so shingles add links to those of the fingerprints; they take none away.
    Texts without a word, null ones too, are alike. Rows without an id stay. Rows that repeat an id stay or go together.
    """
    return one_of_each(docs, bits=2).select(*COLUMNS)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items go, and documents of which they cover half.

    Null texts and ids stay as they are; rows that repeat an id are judged by their own texts.
    """
    return _rewritten(decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2,048 tokens and their places in sequences; a null text is an end token alone, repeated rows are packed one by one."""
    return pack_documents(docs, tokenizer_file())


STAGES = [("quality_rules", quality), ("line_dedup", shared_lines), ("simhash", near_duplicates), ("decontamination", benchmark), ("packing", packing)]
#: Robust estimates, near copies and packing are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other over ``documents``.

    Columns besides those of documents are left out by the first stage, whatever their names. An empty table gives an empty table.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, f"stage-{name}")
    return docs
