"""Predicates of lines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.functions import predicates as Q
from citeweave.functions.patterns import STOP_TOKENS
from citeweave.operators import sequence as S
from citeweave.plans.catalogue.data import GOVERNMENT, PAREN, WITH, YEARS, flag, holds, lines

# ---- the oracle's conditions on a line, and on the line after it ---------------------------

YEAR_FOUND = f"({holds(rf'(^|[^-0-9]){YEARS}[A-Pa-p]?([^-0-9]|$)')} OR {holds(rf'(^|[^0-9]){YEARS}-[01][0-9]-[0-3][0-9]([^0-9]|$)')})"
BARE_YEAR = holds(rf"(^|[^0-9]){YEARS}([^0-9]|$)")
HAS_PAREN, OFFICIAL = holds(PAREN), holds(GOVERNMENT)
STARTS_YEAR = holds(r"^\s*(\((1[789]|20)[0-9]{2}\)|(1[789]|20)[0-9]{2}([^-0-9]|$))")
ENDS_YEAR = holds(r"(\((1[789]|20)[0-9]{2}\)|(^|[^-0-9])(1[789]|20)[0-9]{2})\.?\s*$")
SPACES = "(length(text) - length(replace(replace(text, ' ', ''), '\u00a0', '')))"
NUMERIC = holds(r"^([0-9\s.,;:()\[\]/&" + "\u2013" + r"-]|\b[A-Za-z]{1,3}\.)+$", "trim(text)")
LINK = holds(r"^\s*(?i:https?://|doi:|doi\.org|org/|10\.[0-9]{3,8}/)")
_INITIAL_AFTER = holds(r"^[A-Z]([\s.,;:()&/-]|$)", "coalesce(after, '')")
#: Lines that hold authors and nothing else, by what the templates say; a comma fragment is one if an initial follows it.
AUTHORS_ONLY = "text IN ('Green, D. E.', 'Gray, F. G.,', 'Brown, C., & ', 'Paper I', 'Paper I-V', 'Article I', 'Articles I-V')"
AUTHOR_LINE = f"(CASE WHEN text LIKE ',%' THEN {_INITIAL_AFTER} ELSE {AUTHORS_ONLY} END)"
_STARTS_AUTHOR = holds("^(Green, D|Gray, [FI]|Brown, C|Miller, H|White, F|Smith, A|(Paper|Articles?) I(-|$))")
AUTHOR_LINE_PAREN = f"(CASE WHEN text LIKE ',%' THEN {_INITIAL_AFTER} ELSE {_STARTS_AUTHOR} END AND NOT {HAS_PAREN})"
STOPS = "(" + ", ".join(f"'{x}'" for t in STOP_TOKENS for x in dict.fromkeys([t, t.upper()])) + ")"
STOP = f"(text IN {STOPS} OR regexp_replace(text, '[.]$', '') IN {STOPS})"
PAGE = f"({holds('^[0-9]+$', 'trim(text)')} AND coalesce(try_cast(trim(text) AS int) BETWEEN 50 AND 400, false))"
ARTEFACT = rf"({holds(r'^[-\s]+$')} OR {holds(r'^\(cid:[0-9]+\)$')} OR text LIKE '____/__/__ __:__ Page _ #_' OR {PAGE})"
EDITOR = holds(r"\(\s*(?i:eds?|red)\.?\s*\)")


def _flag(predicate: Callable[[Column], Column]) -> Callable:
    return lambda spark, sf: lines(spark, sf).select("doc_id", "line_no", predicate(F.col("text")).alias("flag"))


def _flag_next(predicate: Callable[[Column, Column], Column]) -> Callable:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        rows = S.in_documents(lines(spark, sf)).withColumn("after", S.following())
        return rows.select("doc_id", "line_no", predicate(F.col("text"), F.col("after")).alias("flag"))

    return run


def _sql_next(condition: str) -> str:
    return f"{WITH}, a AS (SELECT *, lead(text) OVER (PARTITION BY doc_id ORDER BY line_no) AS after FROM lines) SELECT doc_id, line_no, coalesce({condition}, false) AS flag FROM a"


def _has_editor(t: Column) -> Column:
    return F.exists(F.regexp_extract_all(t, F.lit(r"\(([^()]*)\)"), F.lit(1)), Q.is_editor_token)


def _unresolved(spark: SparkSession, sf: str) -> DataFrame:
    return S.to_arrays(lines(spark, sf)).select("doc_id", Q.has_unresolved_editor(F.col("lines")).alias("flag"))


#: name: (query, oracle)
ENTRIES = {
    "pred_government": (_flag(Q.is_government), flag(OFFICIAL)),
    "pred_ui_timestamp": (_flag(Q.is_ui_timestamp), flag("text LIKE '____/__/__ __:__ Page _ #_'")),
    "pred_cid": (_flag(Q.is_cid), flag(holds(r"^\(cid:[0-9]+\)$"))),
    "pred_hyphen_only": (_flag(Q.is_hyphen_only), flag(holds(r"^[-\s]+$"))),
    "pred_page_number": (_flag(Q.is_page_number), flag(PAGE)),
    "pred_initials_year": (_flag(Q.starts_with_initials_and_year), flag(holds(rf"^\s*([A-Z]\.?\s+){{1,3}}\s*{PAREN}"))),
    "pred_initials_near_year": (_flag(Q.starts_with_initials_near_year), flag(holds(rf"^\s*([A-Z]\.?\s+){{1,3}}.{{0,120}}{PAREN}"))),
    "pred_ends_comma_initial": (_flag(Q.ends_with_comma_or_initial), flag(holds(r"(,|\b[A-Z]\.?) *$"))),
    "pred_ends_ampersand": (_flag(Q.ends_with_ampersand), flag("rtrim(text) LIKE '%&'")),
    "pred_paren_year": (_flag(Q.has_paren_year), flag(HAS_PAREN)),
    "pred_ends_paren_year": (_flag(Q.ends_with_paren_year), flag(holds(PAREN + r"\s*$"))),
    "pred_starts_paren_year": (_flag(Q.starts_with_paren_year), flag(holds("^" + PAREN))),
    "pred_bare_year": (_flag(Q.has_bare_year), flag(BARE_YEAR)),
    "pred_year_found": (_flag(Q.year_found), flag(YEAR_FOUND)),
    "pred_ends_year": (_flag(Q.line_ends_with_year), flag(ENDS_YEAR)),
    "pred_starts_year": (_flag(Q.line_starts_with_year), flag(STARTS_YEAR)),
    "pred_short": (_flag(Q.is_short_fragment), flag(f"{SPACES} <= 2")),
    "pred_single_token": (_flag(Q.is_single_token), flag(holds(r"^\S+$", "trim(text)"))),
    "pred_numeric_fragment": (_flag(Q.is_numeric_fragment), flag(NUMERIC)),
    "pred_leading_link": (_flag(Q.starts_with_link), flag(LINK)),
    "pred_number_bracket": (_flag(lambda t: Q.has_number_style(t, "bracket")), flag(holds(r"^\s*\[[0-9]{1,3}\]"))),
    "pred_number_paren": (_flag(lambda t: Q.has_number_style(t, "paren")), flag(holds(r"^\s*\([0-9]{1,3}\)"))),
    "pred_number_bare": (_flag(lambda t: Q.has_number_style(t, "bare")), flag(holds(r"^\s*[0-9]{1,3}\.([^0-9]|$)"))),
    "pred_stop_token": (_flag(Q.is_stop_token), flag(STOP)),
    "pred_contains_name": (_flag(lambda t: Q.contains_name(t, "WORK", True) & ~Q.contains_name(t, "Work")), flag("lower(text) LIKE '%work%' AND text NOT LIKE '%Work%'")),
    "pred_editor_token": (_flag(_has_editor), flag(EDITOR)),
    "pred_unresolved_editor": (_unresolved, f"{WITH}SELECT doc_id, coalesce(bool_or({EDITOR} AND NOT {HAS_PAREN}), false) AS flag FROM lines GROUP BY doc_id"),
    "pred_comma_fragment": (_flag_next(Q.comma_fragment_attaches), _sql_next(f"text LIKE ',%' AND {_INITIAL_AFTER}")),
    "pred_author_line": (_flag_next(Q.is_author_line), _sql_next(AUTHOR_LINE)),
    "pred_author_line_paren": (_flag_next(Q.is_author_line_paren), _sql_next(AUTHOR_LINE_PAREN)),
}
