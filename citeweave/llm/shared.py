"""Staging, balanced ranges and distributed prefix sums shared by the operators."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows of an Arrow batch of texts.
ROWS, BATCH_ROWS = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"
#: White space of the word contracts: space and the controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stage_dir(spark: SparkSession) -> str:
    """A folder that driver and executors share: that of spark.checkpoint.dir. Only a session of one process (tests) may do without."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="citeweave-"))
    return sc.getCheckpointDir()


def clear_stages(spark: SparkSession) -> None:
    """Delete what this application has staged. Results that are not written yet can't be read any more."""
    if spark.sparkContext.getCheckpointDir():
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{spark.sparkContext.getCheckpointDir()}/stage-*")
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for found in files.globStatus(path) or []:
            files.delete(found.getPath(), True)


def staged(df: DataFrame) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back.

    This cuts the lineage like checkpoint() does, but stays columnar, so later
    reads prune columns, and lost executors cost no recomputation.
    """
    path = f"{stage_dir(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """A name that no column of df has, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType | str) -> DataFrame:
    """df.mapInArrow with batches of ROWS rows, unless the session asks for another number than Spark's own.

    Texts are long: Spark's 10,000 rows a batch may be hundreds of MB outside the heap, in
    the executor and in its Python workers, for each task.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_ROWS) == "10000":
        conf.set(BATCH_ROWS, ROWS)
    return df.mapInArrow(run, schema)


def range_bounds(df: DataFrame, column: str, buckets: int) -> list[int]:
    """At most buckets-1 values of an integer column that cut its rows into near-equal ranges.

    One aggregation with a mergeable quantile sketch over all rows; the driver gets
    one number per bucket. Empty tables and all-null columns give no bounds.
    """
    if buckets < 2:
        return []
    row = df.agg(F.percentile_approx(column, [i / buckets for i in range(1, buckets)], max(10_000, 20 * buckets))).first()
    return sorted(set(row[0] or []))


def bucket_of(column: Column, bounds: Sequence[int]) -> Column:
    """How many bounds are <= column, found in two levels. Nulls go to bucket 0."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    longs = lambda xs: F.split(F.lit(",".join(map(str, xs))), ",").cast("array<bigint>")
    coarse = bounds[step - 1 :: step]
    high = F.size(F.filter(longs(coarse), lambda b: b <= column)) * step
    low = F.size(F.filter(F.slice(longs(bounds), high + 1, step), lambda b: b <= column))
    return high + low


def with_positions(df: DataFrame, sums: dict[str, str], order: Sequence[str], bucket: str, groups: Sequence[str] = (), attach: DataFrame | None = None) -> DataFrame:
    """Exclusive prefix sums over all rows of a group in (bucket, order) order.

    sums maps a new column to the column it sums. Each bucket is summed by itself,
    the totals per bucket (one row each) are summed across buckets and added, so no
    group is ever in one task. Adds `<new>_total`, the sum over the whole group.
    Group columns must not be null; rows that tie in order get positions in any order.
    attach has a row per group whose other columns are added, by way of the totals.
    """
    keys = [*groups, bucket]
    totals = df.groupBy(*keys).agg(*[F.sum(c).alias(f"{new}_t") for new, c in sums.items()])
    over = Window.partitionBy(*groups) if groups else Window.partitionBy()
    before = over.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        *keys,
        *[F.coalesce(F.sum(f"{new}_t").over(before), F.lit(0)).alias(f"{new}_base") for new in sums],
        *[F.sum(f"{new}_t").over(over).alias(f"{new}_total") for new in sums],
    )
    bases = bases.join(attach, list(groups)) if attach is not None else bases
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = df.join(bases, keys)
    for new, c in sums.items():
        out = out.withColumn(new, F.col(f"{new}_base") + F.sum(c).over(inside) - F.col(c)).drop(f"{new}_base")
    return out
