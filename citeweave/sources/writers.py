"""Sinks for references, records and audit rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.functions.text import safe_file_name


def write_references(references: DataFrame, path: str, per_document: bool = False) -> None:
    """References in order of document and line: as Parquet, sorted over all files, or as text in a folder per document.

    Folders per document are for as many documents as a file system can list.
    """
    rows = references.select("doc_id", "line_no", "text")
    if per_document:
        rows.repartition("doc_id").sortWithinPartitions("doc_id", "line_no").select("doc_id", "text").write.mode("overwrite").partitionBy("doc_id").text(path)
    else:
        rows.orderBy("doc_id", "line_no").write.mode("overwrite").parquet(path)


def write_sections(sections: DataFrame, path: str) -> None:
    """A snapshot of the sections (doc_id, text) that were read, before lines are cut."""
    sections.select("doc_id", "text").write.mode("overwrite").parquet(path)


def write_by_doi(references: DataFrame, path: str, doi: str = "doi", after: str = "first") -> None:
    """A folder per DOI, named like a file, whose text starts with the DOI."""
    head = references.select(F.col(doi).alias("doi"), F.lit(0).alias("line_no"), F.col(doi).alias("text")).distinct()
    rows = head.unionByName(references.select(F.col(doi).alias("doi"), "line_no", "text")).withColumn("name", safe_file_name(F.col("doi"), after))
    rows.repartition("name").sortWithinPartitions("name", "line_no").select("name", "text").write.mode("overwrite").partitionBy("name").text(path)


def write_xml(records: DataFrame, path: str) -> None:
    """Column xml as text, a row a line."""
    records.select("xml").write.mode("overwrite").text(path)


def audit(before: DataFrame, after: DataFrame, stage: str) -> DataFrame:
    """doc_id, stage, lines before and after: what a stage did, per document. lines.line_audit has the lines that cleaning leaves out, with reasons."""
    counted = before.select("doc_id", F.lit(1).alias("b"), F.lit(0).alias("a")).unionByName(after.select("doc_id", F.lit(0).alias("b"), F.lit(1).alias("a")))
    return counted.groupBy("doc_id").agg(F.lit(stage).alias("stage"), F.sum("b").alias("lines_before"), F.sum("a").alias("lines_after"))
