"""Aggregations over lines, journal rows and character spans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeweave.functions import predicates as Q
from citeweave.functions import text as T
from citeweave.functions.patterns import NUMBER_STYLES

#: Numbered lines that make a list, per style, and in texts read to their end.
LEAST = {"bracket": 15, "paren": 15, "bare": 10}
LEAST_TO_END = {"bracket": 15, "paren": 15, "bare": 30}


def numbered_style(lines: DataFrame, until_end: bool = False) -> DataFrame:
    """doc_id, counts per style and the style of a numbered list, or null: the first of bracket, paren, bare with enough lines."""
    least = LEAST_TO_END if until_end else LEAST
    counts = lines.groupBy("doc_id").agg(*[F.count_if(Q.has_number_style(F.col("text"), s)).alias(f"n_{s}") for s in NUMBER_STYLES])
    style = F.coalesce(*[F.when(F.col(f"n_{s}") >= least[s], s) for s in NUMBER_STYLES])
    return counts.withColumn("style", style)


def standalone_number_share(lines: DataFrame) -> DataFrame:
    """doc_id and the share of its lines that are a list number alone."""
    alone = Q.matches(F.col("text"), r"^\s*(?:\[\d{1,3}\]|\(\d{1,3}\)|\d{1,3}\.?)\s*$")
    return lines.groupBy("doc_id").agg((F.count_if(alone) / F.count("*")).alias("share"))


JOURNAL_KEYS = ["JOURNAL", "YEAR", "ISSUE"]


def conform(rows: DataFrame, columns: list[str]) -> DataFrame:
    """rows with missing columns as null strings, and row_no in input order where it is absent."""
    have = set(rows.columns)
    out = rows.select("*", *[F.lit(None).cast("string").alias(c) for c in columns if c not in have])
    return out if "row_no" in have else out.withColumn("row_no", F.monotonically_increasing_id())


def journal_issues(rows: DataFrame, article: Column | None = None) -> DataFrame:
    """One row per (JOURNAL, YEAR, ISSUE, VOL) that has a DOI; null keys are groups too.

    Abbreviation, ISSN and issue title are those of the group's first row, with a DOI or
    not. The date is the only distinct publication date, else null (the YEAR key counts).
    articles holds an entry per row with a DOI, in input order.
    """
    rows = conform(rows, [*JOURNAL_KEYS, "VOL", "ABBRIVIATION", "ISSN", "ISSUE TITLE", "DOI", "PUBLICATION DATE"])
    doi, date = T.clean(F.col("DOI")), T.clean(F.col("PUBLICATION DATE"))
    entry = F.struct(F.col("row_no"), (article if article is not None else F.struct(doi.alias("doi"))).alias("article"))
    dates = F.count_distinct(date)
    return (
        rows.groupBy(*JOURNAL_KEYS, "VOL")
        .agg(
            F.count(doi).alias("n_articles"),
            T.clean(F.min_by("ABBRIVIATION", "row_no")).alias("abbreviation"), T.issn(F.min_by("ISSN", "row_no")).alias("issn"), T.clean(F.min_by("ISSUE TITLE", "row_no")).alias("issue_title"),
            F.when(dates == 1, F.min(date)).alias("issue_date"),
            F.transform(F.array_sort(F.collect_list(F.when(doi.isNotNull(), entry))), lambda e: e["article"]).alias("articles"),
        )
        .where("n_articles > 0")
    )


def merge_spans(spans: Column) -> Column:
    """Of an array of (start, end): sorted, with overlapping and touching ones merged."""
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def add(merged: Column, s: Column) -> Column:
        last = F.try_element_at(merged, F.lit(-1))
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when(last.isNotNull() & (s["start"] <= last["end"]), F.concat(F.slice(merged, 1, F.size(merged) - 1), F.array(joined))).otherwise(F.concat(merged, F.array(s)))

    return F.aggregate(F.array_sort(spans.cast("array<struct<start:int,end:int>>")), empty, add)


def merge_span_rows(spans: DataFrame, keys: list[str]) -> DataFrame:
    """The same over rows with keys, start and end: a span starts a new one where all before it end earlier."""
    order = Window.partitionBy(*keys).orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.withColumn("_new", F.when(F.col("start") <= reach, 0).otherwise(1))
    numbered = marked.withColumn("_no", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return numbered.groupBy(*keys, "_no").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_no")


def stop_cut(lines: DataFrame, stop: Column | None = None) -> DataFrame:
    """Each document's lines before its first stop line."""
    stop = Q.is_stop_token(F.col("text")) if stop is None else stop
    first = F.min(F.when(stop, F.col("line_no"))).over(Window.partitionBy("doc_id"))
    return lines.withColumn("_stop", first).where(F.col("_stop").isNull() | (F.col("line_no") < F.col("_stop"))).drop("_stop")
