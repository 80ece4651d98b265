"""Scalar string functions. Null in, null out unless stated."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from citeweave.functions import patterns as P


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value worked out once however often body uses it."""
    return F.transform(F.array(value), body).getItem(0)


def normalize_line(t: Column) -> Column:
    """Odd spaces to spaces, zero-width characters out, hyphens of all kinds to '-', runs of white space to one space, trimmed."""
    plain = F.translate(t, P.ODD_SPACES + P.HYPHENS + P.ZERO_WIDTH, " " * len(P.ODD_SPACES) + "-" * len(P.HYPHENS))
    return F.regexp_replace(F.regexp_replace(plain, P.java(r"\s{2,}"), " "), P.java(r"^\s+|\s+\z"), "")


# A spacing diaeresis before a vowel is that vowel with one.
DIAERESES = {"¨o": "ö", "¨a": "ä", "¨u": "ü", "¨O": "Ö", "¨A": "Ä", "¨U": "Ü"}


def fix_diaeresis(t: Column) -> Column:
    for broken, whole in DIAERESES.items():
        t = F.replace(t, F.lit(broken), F.lit(whole))
    return t


def strip_list_number(t: Column, style: str | None = None, max_digits: int | None = None) -> Column:
    """Without the number that starts a list item: of a style ('bracket', 'paren', 'bare'), else '1.', '[1]' or '1 '."""
    digits = r"\d+" if max_digits is None else rf"\d{{1,{max_digits}}}"
    one = {"bracket": rf"\[{digits}\]", "paren": rf"\({digits}\)", "bare": rf"{digits}\."}
    pattern = one[style].replace(r"\d+", r"\d{1,3}") if style else rf"(?:{digits}\.|\[{digits}\]|{digits}(?=\s))"
    return F.regexp_replace(t, P.java(rf"^\s*{pattern}\s*"), "")


def author_prefix(t: Column) -> Column:
    """What stands before the first year (in parentheses or bare), without a last comma; null without a year."""
    bare = rf"(?<!\d){P.YEAR}(?!\d)"
    at = [F.nullif(F.regexp_instr(t, F.lit(P.java(p))), F.lit(0)) for p in (P.YEAR_PAREN, bare)]
    first = F.least(*at)
    return F.regexp_replace(F.rtrim(F.substring(t, F.lit(1), first - 1)), r"[,(]$", "")


def safe_file_name(doi: Column, after: str = "first") -> Column:
    """The part of a DOI after its first or last slash, with all but letters, digits, _ - . as _."""
    part = F.regexp_replace(doi, "^[^/]*/", "") if after == "first" else F.substring_index(doi, "/", -1)
    return F.regexp_replace(part, P.java(r"[^\w\-.]"), "_")


def output_name(source: Column) -> Column:
    """A text file's name from a URL's last path part or a path."""
    path = F.regexp_replace(F.regexp_replace(source, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*", ""), r"[?#].*$", "")
    return F.concat(F.regexp_replace(F.substring_index(path, "/", -1), r"(?<=.)\.[^.]*$", ""), F.lit(".txt"))


def clean(t: Column) -> Column:
    """Trimmed; null if blank or 'nan' in any case."""
    trimmed = F.trim(t)
    return F.when((trimmed != "") & (F.lower(trimmed) != "nan"), trimmed)


def date_parts(t: Column) -> Column:
    """Struct of year, month, day as text of YYYY-MM-DD; null if there are not three parts."""
    parts = F.split(clean(t), "-")
    return F.when(F.size(parts) == 3, F.struct(parts[0].alias("year"), F.try_element_at(parts, F.lit(2)).alias("month"), F.try_element_at(parts, F.lit(3)).alias("day")))


def strip_html(t: Column) -> Column:
    """Without tags; a '<' that nothing closes ends the text."""
    return F.regexp_replace(F.regexp_replace(t, "<[^>]*>", ""), "(?s)<.*$", "")


def paragraphs(t: Column) -> Column:
    """Contents of <p>...</p>, as one line each, without blank ones; other tags stay."""
    return F.filter(F.transform(F.regexp_extract_all(t, F.lit("(?s)<p>(.*?)</p>"), F.lit(1)), one_line), lambda p: p != "")


def one_line(t: Column) -> Column:
    """Trimmed, with no-break spaces and runs of white space as one space."""
    return F.trim(F.regexp_replace(F.translate(t, "\u00a0", " "), r"\s+", " "))


# Three-letter to two-letter language codes.
LANGUAGES = {
    "eng": "en", "swe": "sv", "nor": "no", "dan": "da", "fin": "fi", "deu": "de", "nld": "nl", "spa": "es", "ita": "it", "por": "pt", "rus": "ru", "fra": "fr", "ara": "ar",
}


def language(t: Column, codes: dict[str, str] | None = None) -> Column:
    table = F.create_map(*[F.lit(x) for kv in (codes or LANGUAGES).items() for x in kv])
    return F.try_element_at(table, t)


def orcid_id(t: Column) -> Column:
    """The identifier after 'orcid.org='; null if there is none."""
    return F.nullif(F.substring(t, F.instr(t, "orcid.org=") + 10, F.length(t)), F.when(F.instr(t, "orcid.org=") == 0, F.substring(t, F.lit(10), F.length(t))))


def orcid_url(t: Column) -> Column:
    return F.concat(F.lit("https://orcid.org/"), clean(t))


def isbn_digits(t: Column) -> Column:
    return F.translate(t, "-", "")


def issn(t: Column) -> Column:
    return F.upper(clean(t))


def page_hints(extent: Column) -> Column:
    """Struct of the least and largest number that is taken for a page number, from a record's extent."""
    pages = F.when(F.trim(extent).rlike("^[0-9]+$"), F.trim(extent).try_cast("int"))
    high = F.greatest(F.lit(30), F.least(F.lit(800), pages))
    low = F.greatest(F.lit(30), pages - 50)
    return F.when(pages.isNotNull(), F.struct(F.least(low, high).alias("low"), high.alias("high")))


def year_of(t: Column) -> Column:
    """A year written as a number of any kind ('2001', '2001.0')."""
    return clean(t).try_cast("double").try_cast("int")


def year_count(t: Column) -> Column:
    return F.regexp_count(t, F.lit(P.java(P.YEAR_PAREN)))
