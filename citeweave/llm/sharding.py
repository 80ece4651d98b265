"""Contiguous shards of equal byte size from global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.llm.shared import bucket_of, documents, range_bounds, shuffle_partitions, staged, with_positions


def shard_by_bytes(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Cut docs, in ascending id order, into contiguous shards whose byte sizes are near equal.

    A row's size is the UTF-8 bytes of its text plus 1. Sizes are summed per id range,
    the range totals are summed globally, and a row goes to the shard that holds the
    middle of its bytes, so a shard is off its share by one text at most. Only ids,
    sizes and checksums are shuffled, never texts.

    Returns id, size, text_crc32, law ('bytes'), shard, slot (gapless from 0 in each
    shard, ascending id) and grown_shard (null: this law moves rows when shards grow).
    A null text counts as no bytes (size 1, checksum 0). Null ids come first. Rows with
    one id lie side by side by checksum and size; fully equal rows take any order
    among themselves. Extra columns are ignored, whatever their names. Empty in, empty
    out; shards may be empty where there are fewer rows than shards.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = staged(docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.lit(1).cast("long").alias("one")))
    bounds = range_bounds(rows, "doc_id", 4 * shuffle_partitions(docs.sparkSession))
    placed = with_positions(rows.withColumn("bucket", bucket_of(F.col("doc_id"), bounds)), {"start": "size", "row": "one"}, ["doc_id", "text_crc32", "size"], "bucket")
    middle = F.expr(f"((2 * start + size) * {shards}) div (2 * start_total)")
    placed = placed.withColumn("shard", F.least(F.lit(shards - 1), middle).cast("int")).select("doc_id", "size", "text_crc32", "shard", "row")
    firsts = placed.groupBy("shard").agg(F.min("row").alias("first_row"))  # one row a shard, so it may be broadcast
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("row") - F.col("first_row")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(documents(spark, sf_dir), 8)


#: The checksum is worked out four bits at a time, with a table of 16 steps.
SQL = """
WITH t AS (SELECT list_transform(range(16), lambda n: list_reduce([n, 0, 0, 0, 0], lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS steps),
h AS (SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 1 AS bigint) AS size, lower(hex(encode(coalesce(text, '')))) AS digits FROM documents),
n AS (SELECT doc_id, size, list_transform(range(0, size - 1), lambda i: (instr('0123456789abcdef', digits[2 * i + 1]) - 1) * 16 + instr('0123456789abcdef', digits[2 * i + 2]) - 1) AS bytes FROM h),
c AS (SELECT doc_id, size, xor(list_reduce(list_prepend(CAST(4294967295 AS bigint), bytes),
    lambda c, x: xor(xor(xor(c, x) // 16, steps[xor(c, x) % 16 + 1]) // 16, steps[xor(xor(c, x) // 16, steps[xor(c, x) % 16 + 1]) % 16 + 1])), 4294967295) AS text_crc32 FROM n, t),
p AS (SELECT *, coalesce(sum(size) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start, sum(size) OVER () AS total FROM c),
s AS (SELECT *, CAST(least(7, (2 * start + size) * 8 // (2 * total)) AS int) AS shard FROM p)
SELECT doc_id, size, CAST(text_crc32 AS bigint) AS text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, CAST(NULL AS int) AS grown_shard FROM s
"""
