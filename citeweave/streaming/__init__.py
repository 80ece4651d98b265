"""Structured Streaming over documents.

Every operator is about one document, so a stream of documents needs no state: each
micro-batch is parsed like a batch, and results do not depend on how documents arrive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from citeweave.functions import doi as D
from citeweave.functions import text as T
from citeweave.operators.lines import BREAKS, section
from citeweave.plans.references import ParseOptions, references


def read_text_stream(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """doc_id and full_text of text files as they arrive."""
    stream = spark.readStream.format("text").option("wholetext", True).option("maxFilesPerTrigger", files_per_trigger).load(path)
    return stream.select(F.col("_metadata.file_path").alias("doc_id"), F.col("value").alias("full_text"))


def line_stream(documents: DataFrame) -> DataFrame:
    """Normalised section lines with their DOIs; stateless, so it runs in append mode."""
    split = documents.select("doc_id", F.posexplode(F.split(section(F.col("full_text")), BREAKS)).alias("line_no", "text"))
    normal = split.select("doc_id", (F.col("line_no") + 1).alias("line_no"), T.normalize_line(F.col("text")).alias("text")).where("text <> ''")
    return normal.withColumn("doi_ids", D.extract_simple(F.col("text")))


def reference_stream(documents: DataFrame, path: str, checkpoint: str, options: ParseOptions = ParseOptions()) -> StreamingQuery:
    """Whole reference lists, appended as Parquet: the batch plan on a stream, as it has no state, exactly once by the sink's log."""
    return references(documents, options).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
