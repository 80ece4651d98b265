"""Functions of one text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.functions import doi as D
from citeweave.functions import text as T
from citeweave.plans.catalogue.data import JOURNAL_WITH, PAREN, WITH, YEARS, journal_rows, lines, table, value

_ID = r"10\.[0-9]{4,9}/[^\s)\],;]+"
_IDS = rf"list_distinct(list_transform(regexp_extract_all(text, '{_ID}'), lambda x: regexp_replace(x, '[.,;()\[\]]+$', '')))"
#: The oracle's list of DOIs: none that is a part of another.
DOIS = f"list_filter({_IDS}, lambda x: len(list_filter({_IDS}, lambda y: y <> x AND contains(y, x))) = 0)"
_MENDED = "text"
for _pattern, _new in ((r"doi\.\s+org", "doi.org"), (r"doi\s+\.org", "doi.org"), (r"doi\.org\s*/\s*10\.", "doi.org/10."), (r"doi\.org10\.", "doi.org/10.")):
    _MENDED = f"regexp_replace({_MENDED}, '{_pattern}', '{_new}', 'gi')"
_BARE_OF_DOI = rf"regexp_replace(rtrim(regexp_replace(text, '(?i)[,\s]*(?:(?:https?://)?(?:dx\.)?doi\.org/|doi:\s*)?{_ID}', '', 'g')), '\.+$', '')"
#: What stands before the first year of either kind: the shorter of two.
_BEFORE_PAREN, _BEFORE_BARE = rf"regexp_extract(text, '^(.*?){PAREN}', 1)", f"regexp_extract(text, '^(|.*?[^0-9]){YEARS}(?:[^0-9]|$)', 1)"
_IS_PAREN, _IS_BARE = f"regexp_matches(text, '{PAREN}')", f"regexp_matches(text, '(^|[^0-9]){YEARS}([^0-9]|$)')"
_SHORTER = f"CASE WHEN {_IS_PAREN} AND {_IS_BARE} THEN CASE WHEN length({_BEFORE_PAREN}) < length({_BEFORE_BARE}) THEN {_BEFORE_PAREN} ELSE {_BEFORE_BARE} END WHEN {_IS_PAREN} THEN {_BEFORE_PAREN} WHEN {_IS_BARE} THEN {_BEFORE_BARE} END"
AUTHOR_PREFIX = f"regexp_replace(rtrim({_SHORTER}), '[,(]$', '')"
_CODES = {"eng": "en", "swe": "sv", "nor": "no", "dan": "da", "fin": "fi", "deu": "de", "nld": "nl", "spa": "es", "ita": "it", "por": "pt", "rus": "ru", "fra": "fr", "ara": "ar"}
_HINTS = "WITH p AS (SELECT p_partkey, CAST(p_partkey % 1200 AS int) AS e FROM part), q AS (SELECT p_partkey, greatest(30, least(800, e)) AS hi, greatest(30, e - 50) AS lo FROM p) SELECT p_partkey, least(lo, hi) AS low, hi AS high FROM q"


def _value(function: Callable[[Column], Column]) -> Callable:
    return lambda spark, sf: lines(spark, sf).select("doc_id", "line_no", function(F.col("text")).alias("value"))


def _languages(spark: SparkSession, sf: str) -> DataFrame:
    codes = F.array(*[F.lit(x) for x in [*_CODES, "xxx"]])
    return table(spark, sf, "nation").select("n_nationkey", T.language(F.element_at(codes, F.col("n_nationkey") % 14 + 1)).alias("value"))


def _hints(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", T.page_hints((F.col("p_partkey") % 1200).cast("string")).alias("h")).select("p_partkey", "h.low", "h.high")


def _dates(spark: SparkSession, sf: str) -> DataFrame:
    return journal_rows(spark, sf).select("row_no", T.date_parts(F.col("PUBLICATION DATE")).alias("d")).select("row_no", "d.year", "d.month", "d.day")


#: name: (query, oracle)
ENTRIES = {
    "normalize_line": (_value(T.normalize_line), value("trim(regexp_replace(replace(replace(replace(text, '\u00a0', ' '), '\u2013', '-'), '\u200b', ''), '\\s{2,}', ' ', 'g'))")),
    "fix_diaeresis": (_value(T.fix_diaeresis), value("replace(replace(replace(replace(replace(replace(text, '¨o', 'ö'), '¨a', 'ä'), '¨u', 'ü'), '¨O', 'Ö'), '¨A', 'Ä'), '¨U', 'Ü')")),
    "doi_extract_simple": (_value(lambda t: F.array_join(D.extract_simple(t), " ")), value(f"array_to_string({DOIS}, ' ')")),
    "doi_extract_exact": (_value(lambda t: F.array_join(D.extract_exact(t), " ")), value(f"CASE WHEN text LIKE '%doi.org10%' THEN '' ELSE array_to_string({DOIS}, ' ') END")),
    "doi_fix_broken": (_value(D.fix_broken), value(_MENDED)),
    "doi_to_end_simple": (_value(D.simple_to_end), value(f"CASE WHEN len({DOIS}) = 1 THEN {_BARE_OF_DOI} || '. https://doi.org/' || {DOIS}[1] ELSE text END")),
    "doi_move_to_end": (_value(D.to_end), None),
    "doi_normalize_fragment": (
        _value(D.normalize_fragment),
        value("CASE WHEN text LIKE 'one 10.%' THEN replace(text, '10.1234/', 'doi.org/10.1234/') WHEN text LIKE 'split 1 0.%' THEN replace(text, '1 0.', 'doi.org/10.') ELSE replace(text, 'doi.org/ without', 'doi.org/without') END"),
    ),
    "doi_remove_stray": (_value(D.remove_stray_prefixes), value("trim(regexp_replace(CASE WHEN text LIKE 'stray %' THEN 'stray and without one' ELSE text END, ' {2,}', ' ', 'g'))")),
    "doi_clean_dangling": (_value(lambda t: D.clean_dangling(F.concat(t, F.lit(" with and.")))), value("replace(replace(text, '(with and)', '(with)'), 'for & .', 'for .') || ' with.'")),
    "doi_space_after": (_value(D.space_after), value("replace(text, '5Next', '5 Next')")),
    "split_links": (
        _value(lambda t: F.array_join(D.split_links(t), "|")),
        value(r"array_to_string(list_filter(list_transform(string_split(regexp_replace(text, '((?:https?://|(?:dx\.)?doi\.org/|doi:)\S+)\s*', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> ''), '|')"),
    ),
    "strip_number": (_value(T.strip_list_number), value(r"regexp_replace(text, '^\s*([0-9]+\.|\[[0-9]+\]|[0-9]+(\s|$))\s*', CASE WHEN regexp_matches(text, '^\s*[0-9]+$') THEN text ELSE '' END)")),
    "author_prefix": (_value(T.author_prefix), value(AUTHOR_PREFIX)),
    "year_count": (_value(T.year_count), value(rf"CAST(len(regexp_extract_all(text, '{PAREN}')) AS int)")),
    "safe_file_name_first": (_value(lambda t: T.safe_file_name(t)), value(r"regexp_replace(regexp_replace(text, '^[^/]*/', ''), '[^\w.-]', '_', 'g')")),
    "safe_file_name_last": (_value(lambda t: T.safe_file_name(t, "last")), value(r"regexp_replace(regexp_replace(text, '^.*/', ''), '[^\w.-]', '_', 'g')")),
    "strip_html": (_value(lambda t: T.strip_html(F.concat(F.lit("<i>"), t, F.lit("</i> x < y")))), value("text || ' x '")),
    "language_map": (_languages, "SELECT n_nationkey, CASE n_nationkey % 14 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(_CODES.values())) + " END AS value FROM nation"),
    "page_hints": (_hints, _HINTS),
    "output_name": (
        lambda s, sf: table(s, sf, "pages").select("page_id", T.output_name(F.col("url")).alias("value")),
        r"SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*', ''), '[?#].*$', ''), '^.*/', ''), '^(.+)\.[^.]*$', '\1') || '.txt' AS value FROM pages",
    ),
    "clean_sentinel": (lambda s, sf: journal_rows(s, sf).select("row_no", T.clean(F.col("DOI")).alias("doi")), f"{JOURNAL_WITH} SELECT row_no, CASE WHEN trim(\"DOI\") NOT IN ('', 'nan') THEN trim(\"DOI\") END AS doi FROM j"),
    "date_split": (_dates, f"{JOURNAL_WITH}, d AS (SELECT row_no, \"PUBLICATION DATE\" AS d FROM j) SELECT row_no, split_part(d, '-', 1) AS year, split_part(d, '-', 2) AS month, split_part(d, '-', 3) AS day FROM d"),
    "isbn_digits": (_value(T.isbn_digits), value("replace(text, '-', '')")),
    "orcid_id": (_value(lambda t: T.orcid_id(F.concat(F.lit("see orcid.org="), t))), value("text")),
}

__all__ = ["AUTHOR_PREFIX", "DOIS", "ENTRIES", "WITH"]
