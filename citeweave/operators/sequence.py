"""Operators over ordered lines (doc_id, line_no, text): attach, consume, run until, fill forward, fold.

Rows are put back together inside their document only. All kernels use the window
(doc_id, line_no) and aggregate by doc_id, so after one hash exchange on doc_id a chain
of them needs no other. Other columns are dropped; line_no is numbered anew from 1.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from citeweave.functions import predicates as Q
from citeweave.functions import text as T

DOC, LINE, TEXT = "doc_id", "line_no", "text"


def _order() -> WindowSpec:
    return Window.partitionBy(DOC).orderBy(LINE)


def _so_far() -> WindowSpec:
    return _order().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _before() -> WindowSpec:
    return _order().rowsBetween(Window.unboundedPreceding, -1)


Predicate = Callable[[Column], Column]
#: Predicates of a line and the next one.
Predicate2 = Callable[[Column, Column], Column]


def following() -> Column:
    return F.lead(TEXT).over(_order())


def previous() -> Column:
    return F.lag(TEXT).over(_order())


def in_documents(lines: DataFrame) -> DataFrame:
    """The lines dealt by document, once for all operators that follow."""
    return lines.select(DOC, LINE, TEXT).repartition(DOC)


def islands(lines: DataFrame, attach: Column, separator: str = " ") -> DataFrame:
    """Each line for which attach is true goes to the end of the one before; a document's first line never does.

    Joined ends lose their white space, the separator comes between. A null attach is false.
    """
    marked = lines.withColumn("_attach", F.coalesce(attach, F.lit(False)))
    marked = marked.withColumn("_start", F.when(F.col("_attach") & F.lag(F.lit(1)).over(_order()).isNotNull(), 0).otherwise(1))
    numbered = marked.withColumn("_island", F.sum("_start").over(_so_far()).cast("int"))
    grouped = numbered.groupBy(DOC, "_island").agg(F.array_sort(F.collect_list(F.struct(LINE, TEXT))).alias("_parts"))
    piece = lambda p, i: F.when((i > 0) & (i < F.size("_parts") - 1), F.trim(p[TEXT])).when(i > 0, F.ltrim(p[TEXT])).when(F.size("_parts") > 1, F.rtrim(p[TEXT])).otherwise(p[TEXT])
    return grouped.select(DOC, F.col("_island").alias(LINE), F.array_join(F.transform("_parts", piece), separator).alias(TEXT))


def attach_where(lines: DataFrame, predicate: Predicate, separator: str = " ") -> DataFrame:
    return islands(lines, predicate(F.col(TEXT)), separator)


def consume_next(lines: DataFrame, takes: Predicate, blocked: Predicate = Q.is_government) -> DataFrame:
    """Each line for which takes is true swallows the next one, unless that is blocked; a swallowed line takes nothing.

    In a run of lines that could take their next, it is the odd ones that do.
    """
    able = takes(F.col(TEXT)) & following().isNotNull() & ~blocked(F.coalesce(following(), F.lit("")))
    marked = lines.withColumn("_able", F.coalesce(able, F.lit(False)))
    marked = marked.withColumn("_run", F.sum(F.when(F.col("_able"), 0).otherwise(1)).over(_so_far()))
    place = F.row_number().over(Window.partitionBy(DOC, "_run").orderBy(LINE)) - F.when(F.first("_able").over(Window.partitionBy(DOC, "_run").orderBy(LINE)), 0).otherwise(1)
    marked = marked.withColumn("_takes", F.col("_able") & (place % 2 == 1))
    return islands(marked.withColumn("_taken", F.lag("_takes").over(_order())), F.col("_taken"))


def run_until(lines: DataFrame, ends: Predicate = Q.year_found, cap: int = 25) -> DataFrame:
    """Lines gathered up to one for which ends is true, it included, and cap lines after the first at most."""
    marked = lines.withColumn("_group", F.coalesce(F.sum(ends(F.col(TEXT)).cast("int")).over(_before()), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy(DOC, "_group").orderBy(LINE)) - 1
    return islands(marked.withColumn("_inside", inside), F.col("_inside") % (cap + 1) != 0)


def collapse_runs(lines: DataFrame, starts: Predicate, goes_on: Predicate2) -> DataFrame:
    """From a line for which starts is true, the lines after it join while goes_on(line, next line) is true of them."""
    marked = lines.withColumn("_on", goes_on(F.col(TEXT), following())).withColumn("_s", starts(F.col(TEXT)))
    marked = marked.withColumn("_run", F.sum(F.when(F.col("_on"), 0).otherwise(1)).over(_so_far()))
    run = Window.partitionBy(DOC, "_run").orderBy(LINE).rowsBetween(Window.unboundedPreceding, -1)
    started = F.coalesce(F.max((F.col("_s") & F.col("_on")).cast("int")).over(run), F.lit(0)) == 1
    return islands(marked.withColumn("_in", F.col("_on") & started), F.col("_in"))


def hyphen_join(lines: DataFrame) -> DataFrame:
    """A line after one that ends in a hyphen or underscore joins it without a space; the hyphen stays."""
    return islands(lines, Q.matches(F.rtrim(previous()), r"[-_­‐-―−]\z"), "")


def attach_non_year(lines: DataFrame) -> DataFrame:
    return attach_where(lines, lambda t: ~Q.has_bare_year(t))


def merge_short(lines: DataFrame, spaces: int = 2) -> DataFrame:
    return attach_where(lines, lambda t: Q.is_short_fragment(t, spaces) & ~Q.is_government(t))


def attach_paren_or_year_start(lines: DataFrame) -> DataFrame:
    return attach_where(lines, lambda t: Q.matches(t, r"^\s*\(") | Q.matches(t, rf"^\s*{Q.P.YEAR}(?!\d)"))


def year_end_consume(lines: DataFrame) -> DataFrame:
    return consume_next(lines, Q.ends_with_paren_year)


def attach_single_tokens(lines: DataFrame) -> DataFrame:
    return attach_where(lines, Q.is_single_token)


def attach_initials_year(lines: DataFrame) -> DataFrame:
    starts = Q.starts_with_initials_and_year(F.col(TEXT)) | Q.starts_with_initials_near_year(F.col(TEXT))
    return islands(lines, starts & Q.ends_with_comma_or_initial(previous()))


def ampersand_consume(lines: DataFrame) -> DataFrame:
    return consume_next(lines, Q.ends_with_ampersand)


def append_non_year(lines: DataFrame) -> DataFrame:
    return attach_where(lines, lambda t: ~Q.has_paren_year(t) & ~Q.is_government(t))


def append_non_year_bare(lines: DataFrame, full_names: bool = False) -> DataFrame:
    """Lines without a year go to the one before, but an author's start that is no author line stays."""
    start = Q.P.AUTHOR_START_FULL if full_names else Q.P.AUTHOR_START
    t = F.col(TEXT)
    kept = Q.matches(t, start) & ~Q.is_author_line(t, following(), full_names)
    return islands(lines, ~Q.year_found(t) & ~kept)


def collapse_authors(lines: DataFrame, full_names: bool = False) -> DataFrame:
    """Author lines that follow one another become one."""
    return collapse_runs(lines, lambda t: Q.is_author_line(t, F.lit(None).cast("string"), full_names), lambda t, n: Q.is_author_line(t, n, full_names))


def attach_year_start(lines: DataFrame) -> DataFrame:
    return attach_where(lines, Q.line_starts_with_year)


def bare_year_end_consume(lines: DataFrame) -> DataFrame:
    return consume_next(lines, Q.line_ends_with_year)


def attach_digits(lines: DataFrame) -> DataFrame:
    return attach_where(lines, lambda t: Q.has_digit(t) & ~Q.year_found(t))


def append_until_year(lines: DataFrame, cap: int = 25) -> DataFrame:
    return run_until(lines, Q.year_found, cap)


def attach_leading_links(lines: DataFrame) -> DataFrame:
    return attach_where(lines, Q.starts_with_link)


def short_join(lines: DataFrame, full_names: bool = False) -> DataFrame:
    return islands(lines, Q.is_short_fragment(F.col(TEXT), 2) & ~Q.is_author_line(F.col(TEXT), following(), full_names))


def attach_numeric_fragments(lines: DataFrame) -> DataFrame:
    return attach_where(lines, Q.is_numeric_fragment)


def attach_initials_bare(lines: DataFrame) -> DataFrame:
    """As attach_initials_year with a bare year after the initials."""
    return islands(lines, Q.matches(F.col(TEXT), rf"^\s*(?:[A-Z]\.?\s+){{1,3}}{Q.P.YEAR}(?!\d)") & Q.ends_with_comma_or_initial(previous()))


def fill_dashes(lines: DataFrame, placeholder: str = "---,") -> DataFrame:
    """A line that starts with the placeholder gets the authors of the last line before it that has some."""
    dashed = F.ltrim(F.col(TEXT)).startswith(placeholder)
    prefix = F.when(~dashed, F.nullif(T.author_prefix(F.col(TEXT)), F.lit("")))
    last = F.last("_prefix", ignorenulls=True).over(_before())
    rest = F.ltrim(F.substring(F.ltrim(F.col(TEXT)), F.lit(len(placeholder) + 1), F.length(TEXT)))
    marked = lines.withColumn("_prefix", prefix).withColumn("_dashed", dashed).withColumn("_last", last)
    return marked.select(DOC, LINE, F.when(F.col("_dashed") & F.col("_last").isNotNull(), F.concat("_last", F.lit(" "), rest)).otherwise(F.col(TEXT)).alias(TEXT))


# ---- splits -------------------------------------------------------------------------


def split_each(lines: DataFrame, pieces: Column) -> DataFrame:
    """Each line as the pieces of an array column, numbered anew."""
    out = lines.select(DOC, LINE, F.posexplode(pieces).alias("_at", TEXT)).where(F.trim(TEXT) != "")
    return out.select(DOC, F.row_number().over(Window.partitionBy(DOC).orderBy(LINE, "_at")).alias(LINE), TEXT)


def split_accessed(lines: DataFrame) -> DataFrame:
    """Cut after every access date."""
    return split_each(lines, F.transform(F.split(F.regexp_replace(TEXT, f"({Q.P.ACCESSED})", "$1\u0001"), "\u0001"), lambda x: F.trim(x)))


def split_trailers(lines: DataFrame, least_years: int = 2) -> DataFrame:
    """Two references run together at '].' are cut if an author without digits follows and there are years enough."""
    whole = r"^(.*\]\.)\s+(.+)$"
    left, right = (F.regexp_extract(TEXT, "(?s)" + whole, k) for k in (1, 2))
    author = Q.matches(right, Q.P.AUTHOR_START) & ~Q.matches(F.regexp_extract(right, Q.P.java(Q.P.AUTHOR_START), 0), r"\d")
    cut = (left != "") & author & (F.regexp_count(F.col(TEXT), F.lit(rf"(?<!\d){Q.P.YEAR}(?!\d)")) >= least_years)
    return split_each(lines, F.when(cut, F.array(left, right)).otherwise(F.array(F.col(TEXT))))


def attach_parentheticals(lines: DataFrame) -> DataFrame:
    """A bracket that starts a line (with a full stop after it) goes to the line before; what follows it is a line of its own."""
    bracket = r"^\s*((?:\([^)]*\)|\[[^\]]*\])\.?)\s*(.*)$"
    first, rest = F.regexp_extract(TEXT, bracket, 1), F.regexp_extract(TEXT, bracket, 2)
    pieces = F.when(first != "", F.array(F.struct(F.lit(True).alias("a"), first.alias("t")), F.struct(F.lit(False).alias("a"), rest.alias("t")))).otherwise(F.array(F.struct(F.lit(False).alias("a"), F.col(TEXT).alias("t"))))
    out = lines.select(DOC, LINE, F.posexplode(pieces).alias("_at", "_p")).where(F.trim("_p.t") != "")
    out = out.select(DOC, F.row_number().over(Window.partitionBy(DOC).orderBy(LINE, "_at")).alias(LINE), F.col("_p.t").alias(TEXT), F.col("_p.a").alias("_a"))
    return islands(out, F.col("_a"))


# ---- folds --------------------------------------------------------------------------


def to_arrays(lines: DataFrame) -> DataFrame:
    """One row per document with its lines in order."""
    return lines.groupBy(DOC).agg(F.transform(F.array_sort(F.collect_list(F.struct(LINE, TEXT))), lambda x: x[TEXT]).alias("lines"))


def to_rows(arrays: DataFrame) -> DataFrame:
    return arrays.select(DOC, F.posexplode("lines").alias("_at", TEXT)).select(DOC, (F.col("_at") + 1).alias(LINE), TEXT)


def fold(lines: DataFrame, step: Callable[[list[str]], list[str]]) -> DataFrame:
    """step over each document's list of lines, for rules that look at all that was joined so far."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda x: step(list(x)))

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    folded = F.pandas_udf(run, "array<string>").asNondeterministic()  # else the optimizer runs it again in a filter on its size
    return to_rows(to_arrays(lines).select(DOC, folded("lines").alias("lines")))
