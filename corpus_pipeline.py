"""The corpus pipeline: documents in, packed token sequences out.

Each stage takes (spark, documents, folder of the tables), calls one operator and lets its decisions take effect; what it
returns is written as Parquet and read again for the next one.  All stages but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftspark.llm import decontamination, jaccard_join, packing, substring_dedup, toxicity
from siftspark.llm.common import keyed, written


def _rows(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents with a column that tells rows apart, so that rows of a repeated or null key are judged each, and its name."""
    name = next(f"_row{n}" for n in range(10_000) if f"_row{n}" not in docs.columns)
    return keyed(docs, "doc_id", name), name


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are judged toxic go.

    Every row is judged by its own text, those of null and repeated keys too; null and empty texts stay.  Extra columns may
    have any names; an empty table stays empty, and without labels all stay."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, Jaccard 0.8) the document of the smallest key stays.

    Rows of a null or repeated key are documents of their own, after all others in order; of equal ones one stays.  Null and
    empty texts are near nothing and stay.  Extra columns may have any names; an empty table stays empty."""
    rows, row = _rows(docs)
    groups = jaccard_join.join_groups(rows, key=row, k=5, top=80)
    gone = groups.where(F.col("component_id") != F.col(row)).select(row)
    return jaccard_join.of_ids(rows, gone, row, "left_anti").select(docs.columns)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand in an earlier document are cut out; a document of which nothing remains goes.

    Every row is a document, those of null and repeated keys too (after all others in order); null and empty texts stay.
    Extra columns may have any names; an empty table stays empty."""
    rows, row = _rows(docs)
    found = written(substring_dedup.passages(rows, key=row))
    return substring_dedup.cut_passages(rows, found, key=row).select(docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Every row is judged by its own text, those of null and repeated keys too; null and empty texts stay.  Extra columns may
    have any names; an empty table stays empty, and without items all stay."""
    rows, row = _rows(docs)
    found = decontamination.contaminated(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), key=row)
    gone = found.select(F.col("doc_id").alias(row)).distinct()
    return jaccard_join.of_ids(rows, gone, row, "left_anti").select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokenised documents as pieces of packed sequences.  Every row is packed; a null text counts as empty and a null key
    stays null; an empty table gives no rows."""
    return packing.pack(docs, packing.tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("jaccard_join", one_of_each_group),
    ("substring_dedup", without_repeats),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: No stage before the last can be written in SQL; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
