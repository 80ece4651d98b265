"""From a document's text to the clean lines of its reference section."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeweave.functions import patterns as P
from citeweave.functions import predicates as Q
from citeweave.functions import text as T
from citeweave.operators.aggregates import stop_cut

#: Where a text breaks into lines.
BREAKS = "\r\n|[\n\r\u000b\u000c\u001c-\u001e\u0085  ]"


def section(text: Column, keep_heading: bool = False, stop_at_capitals: bool = False) -> Column:
    """The text after its first reference heading; all of it without one."""
    heading = "(?ium)" + P.HEADING.replace(r"\s*$", r"[^\S\n]*$").replace(r"^\s*", r"^[^\S\n]*")
    at = F.regexp_instr(text, F.lit(heading))
    found = F.regexp_substr(text, F.lit(heading))
    start = at if keep_heading else at + F.length(found)
    out = F.when(at > 0, F.substring(text, start, F.length(text))).otherwise(text)
    return F.regexp_replace(out, r"(?s)(?<=\n)[A-Z][A-Z -]{5,}\n.*$", "") if stop_at_capitals else out


def look_back(text: Column, non_blank: int = 2000) -> Column:
    """The section with up to so many non-blank characters before its heading."""
    heading = "(?ium)" + P.HEADING.replace(r"\s*$", r"[^\S\n]*$").replace(r"^\s*", r"^[^\S\n]*")
    at = F.regexp_instr(text, F.lit(heading))
    before = F.regexp_substr(F.substring(text, F.lit(1), at - 1), F.lit(rf"(?s)(?:\s*\S){{0,{non_blank}}}\s*\z"))
    return F.when(at > 0, F.concat(F.coalesce(before, F.lit("")), F.substring(text, at, F.length(text)))).otherwise(text)


def physical_lines(documents: DataFrame, text: Column | str = "full_text") -> DataFrame:
    """doc_id, line_no from 1, text: every line of a text, blank ones too. Null texts have none."""
    text = F.col(text) if isinstance(text, str) else text
    return documents.select("doc_id", F.posexplode(F.split(text, BREAKS)).alias("_at", "text")).select("doc_id", (F.col("_at") + 1).alias("line_no"), "text")


def clean_lines(lines: DataFrame, until_eof: bool = False, low_page: int = 50, high_page: int = 400) -> DataFrame:
    """Normalised lines without blank ones, cut at the first stop token (unless until_eof), without artefacts.

    The cut sees normalised lines and comes before artefacts are dropped; both come before
    any joining, as they change which lines are neighbours.
    """
    normal = lines.select("doc_id", "line_no", T.normalize_line(F.col("text")).alias("text")).where("text <> ''")
    kept = normal if until_eof else stop_cut(normal)
    t = F.col("text")
    return kept.where(~(Q.is_hyphen_only(t) | Q.is_cid(t) | Q.is_ui_timestamp(t) | Q.is_page_number(t, low_page, high_page)))


def clean_line_array(text: Column, until_eof: bool = False, low_page: int = 50, high_page: int = 400) -> Column:
    """clean_lines of one text as an array, so that a document's lines are never apart; null for a null text."""
    lines = F.filter(F.transform(F.split(text, BREAKS), T.normalize_line), lambda t: t != "")
    if not until_eof:
        stop = lambda x: F.array_position(F.transform(x, Q.is_stop_token), F.lit(True))
        lines = T.bound(lines, lambda x: T.bound(stop(x), lambda at: F.when(at > 0, F.slice(x, F.lit(1), (at - 1).cast("int"))).otherwise(x)))
    return F.filter(lines, lambda t: ~(Q.is_hyphen_only(t) | Q.is_cid(t) | Q.is_ui_timestamp(t) | Q.is_page_number(t, low_page, high_page)))


def line_audit(lines: DataFrame, until_eof: bool = False, low_page: int = 50, high_page: int = 400) -> DataFrame:
    """doc_id, line_no, text, reason of every line that clean_lines leaves out, one reason each: the first that holds."""
    t = F.col("text")
    normal = lines.select("doc_id", "line_no", T.normalize_line(t).alias("text"))
    marked = normal.withColumn("_stop", F.min(F.when(Q.is_stop_token(t), F.col("line_no"))).over(Window.partitionBy("doc_id")))
    cut = F.col("line_no") >= F.col("_stop") if not until_eof else F.lit(False)
    reason = (
        F.when(t == "", "blank").when(cut, F.when(F.col("line_no") == F.col("_stop"), "stop token").otherwise("after a stop token"))
        .when(Q.is_hyphen_only(t), "hyphens only").when(Q.is_cid(t), "character id").when(Q.is_ui_timestamp(t), "time stamp").when(Q.is_page_number(t, low_page, high_page), "page number")
    )
    return marked.select("doc_id", "line_no", "text", reason.alias("reason")).where("reason is not null")
