"""The corpus pipeline: five stages from raw documents to packed sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from granary.llm import decontamination, line_dedup, ngram_join, packing, toxicity
from granary.llm.common import as_bytes, free_name, table
from granary.session import stage

#: No SQL can express stages that tokenise or learn; a brute-force version is in tests/llm.
ORACLE_SQL = None


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores below 0.5."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), 5, 0)
    return docs.where(toxicity.predict(model, as_bytes("text")) < 0.5)


def remove_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand on ten sites or more; a document of which nothing is left goes."""
    # Its counts are called so whatever else the table has; columns of these names are put aside.
    aside = {c: free_name(docs, f"aside_{c}") for c in ("lines_before", "lines_removed") if c in docs.columns}
    found = line_dedup.remove_boilerplate(docs.withColumnsRenamed(aside))
    kept = found.where((F.col("lines_removed") == 0) | F.col("text").rlike(r"\S")).drop("lines_before", "lines_removed")
    kept = kept.withColumnsRenamed({new: old for old, new in aside.items()})
    # n_chars tells the length of the text, where the table has it.
    return kept.withColumn("n_chars", F.length("text").cast(kept.schema["n_chars"].dataType)) if "n_chars" in kept.columns else kept


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 on 5-word shingles: the one with the smallest id.

    Rows with the same id are one document, of which the first row by text
    stays. Rows with a null id all stay.
    """
    found = ngram_join.similar_documents(docs, 5, 80)
    others = found.where(F.col("component") < F.col("doc_id")).select("doc_id").distinct()
    named, row = docs.where("doc_id is not null").join(others, "doc_id", "left_anti").select(docs.columns), free_name(docs, "row")
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
    return named.withColumn(row, first).where(F.col(row) == 1).drop(row).unionByName(docs.where("doc_id is null"))


def remove_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, in its own or another wording of its slots."""
    leaks = decontamination.find_leaks(docs, table(spark, sf_dir, "benchmark")).select(F.col("id").alias("doc_id")).distinct()
    return docs.join(leaks, "doc_id", "left_anti").select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents' pieces in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", remove_toxic),
    ("line dedup", remove_boilerplate_lines),
    ("n-gram Jaccard join", keep_one_of_similar),
    ("benchmark decontamination", remove_benchmark_leaks),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each gives is written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
