"""Boolean columns about one line (or a line and the next one). Null text is false throughout."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from citeweave.functions import patterns as P


def matches(text: Column, pattern: str, ignore_case: bool = False) -> Column:
    return F.coalesce(text.rlike(P.java(pattern, ignore_case)), F.lit(False))


def is_government(t: Column) -> Column:
    return matches(t, P.GOVERNMENT)


def is_ui_timestamp(t: Column) -> Column:
    parts = [r"\d{4}/\d{1,2}/\d{1,2}", r"\b\d{1,2}:\d{2}\b", r"\b(?i:page)\b", r"#\d+"]
    return reduce(lambda a, b: a & b, [matches(t, p) for p in parts])


def is_cid(t: Column) -> Column:
    return matches(t, P.CID)


def is_hyphen_only(t: Column) -> Column:
    return matches(t, P.HYPHEN_ONLY)


def is_page_number(t: Column, low: int = 50, high: int = 400) -> Column:
    return F.coalesce(matches(t, r"^\s*[0-9]+\s*$") & F.trim(t).try_cast("int").between(low, high), F.lit(False))


def starts_with_initials_and_year(t: Column) -> Column:
    return matches(t, P.INITIALS_THEN_YEAR)


def starts_with_initials_near_year(t: Column) -> Column:
    return matches(t, P.INITIALS_NEAR_YEAR)


def ends_with_comma_or_initial(t: Column) -> Column:
    return matches(F.rtrim(t), r",\z|\b[A-Z]\.?\z")


def ends_with_ampersand(t: Column) -> Column:
    return matches(F.rtrim(t), r"&\z")


def starts_with_ampersand(t: Column) -> Column:
    return matches(t, r"^\s*&")


def has_paren_year(t: Column) -> Column:
    return matches(t, P.YEAR_PAREN)


def ends_with_paren_year(t: Column) -> Column:
    return matches(t, P.YEAR_PAREN + r"\s*$")


def starts_with_paren_year(t: Column) -> Column:
    return matches(t, "^" + P.YEAR_PAREN)


def has_bare_year(t: Column) -> Column:
    return matches(t, P.BARE_YEAR)


def year_found(t: Column) -> Column:
    return matches(t, P.YEAR_FOUND)


def line_ends_with_year(t: Column) -> Column:
    return matches(t, P.ENDS_IN_YEAR)


def line_starts_with_year(t: Column) -> Column:
    return matches(t, P.STARTS_WITH_YEAR)


def comma_fragment_attaches(t: Column, following: Column, full_names: bool = False) -> Column:
    """A line that starts with a comma goes to the author line before it if the next one starts like an author."""
    start = matches(F.ltrim(following), rf"^{P.INITIALS}\b?")
    if full_names:
        start = start | matches(F.ltrim(following), P.AUTHOR_START_FULL)
    return matches(t, r"^\s*,") & start


def is_editor_token(t: Column) -> Column:
    return matches(F.trim(t), P.EDITOR)


def has_unresolved_editor(lines: Column, year: str = P.YEAR_PAREN) -> Column:
    """Of an array of lines: one without a year has an editor token in parentheses."""
    token = lambda t: F.exists(F.regexp_extract_all(t, F.lit(r"\(([^()]*)\)"), F.lit(1)), is_editor_token)
    return F.exists(lines, lambda t: ~matches(t, year) & token(t))


def is_short_fragment(t: Column, spaces: int = 2) -> Column:
    return F.coalesce(F.regexp_count(t, F.lit("[ \u00a0]")) <= spaces, F.lit(False))


def is_single_token(t: Column) -> Column:
    return matches(F.trim(t), r"^\S+$")


def is_numeric_fragment(t: Column) -> Column:
    return matches(F.trim(t), P.NUMERIC_FRAGMENT)


def starts_with_link(t: Column) -> Column:
    return matches(t, P.LEADING_LINK)


def has_number_style(t: Column, style: str) -> Column:
    return matches(t, P.NUMBER_STYLES[style])


def has_digit(t: Column) -> Column:
    return matches(t, r"\d")


def is_stop_token(t: Column) -> Column:
    """Whole line equal to a stop token, with or without a last full stop; hyphens of any kind count as one."""
    return F.coalesce(t.isin(P.stop_tokens()) | F.regexp_replace(t, r"\.$", "").isin(P.stop_tokens()), F.lit(False))


def contains_name(t: Column, name: str, ignore_case: bool = False) -> Column:
    return F.coalesce(F.contains(F.lower(t), F.lit(name.lower())) if ignore_case else F.contains(t, F.lit(name)), F.lit(False))


def is_author_line(t: Column, following: Column, full_names: bool = False) -> Column:
    """A line of authors only, in bibliographies with bare years; following is the next line or null.

    A leading comma is decided by the next line. A trailing comma after an author and
    before initials counts. Otherwise the author pattern must match without digits, with
    nothing but punctuation after it, or initials in it and a go-on of names after it; a
    match of an author's start alone must span the line. No year may occur.
    """
    whole, start = (P.AUTHORS_FULL, P.AUTHOR_START_FULL) if full_names else (P.AUTHORS, P.AUTHOR_START)
    t = F.trim(t)
    found = F.regexp_extract(t, P.java(whole), 0)
    rest = F.trim(F.substring(t, F.length(found) + 1, F.length(t)))
    goes_on = matches(found, rf"(?:^|[\s,.&-]){P.INITIALS}") & matches(rest, r"^(?:[A-Za-z](?:\.|\b)|,|&|(?i:and)\b)")
    strict = ~matches(found, r"\d") & (matches(rest, r"^\W*$") | goes_on)
    spans = matches(t, start + r"\W*$") & ~has_digit(t)
    plain = F.when(found != "", strict).otherwise(spans)
    trailing = matches(t, r",$") & matches(t, start) & matches(F.ltrim(following), rf"^{P.INITIALS}") & ~year_found(t)
    plain = plain & ~matches(t, r"(?:1[789]|20)\d{2}") & ~year_found(t)
    return F.coalesce(F.when(matches(t, r"^,"), comma_fragment_attaches(t, following, full_names)).otherwise(trailing | plain), F.lit(False))


def is_author_line_paren(t: Column, following: Column, full_names: bool = False) -> Column:
    """As is_author_line where years stand in parentheses: what follows a match is free, and an author's start needs a last comma."""
    whole, start = (P.AUTHORS_FULL, P.AUTHOR_START_FULL) if full_names else (P.AUTHORS, P.AUTHOR_START)
    t = F.trim(t)
    found = F.regexp_extract(t, P.java(whole), 0)
    rest = F.trim(F.substring(t, F.length(found) + 1, F.length(t)))
    strict = ~matches(found, r"\d") & (matches(rest, r"^\W*$") | matches(found, rf"(?:^|[\s,.&-]){P.INITIALS}"))
    loose = matches(t, start) & matches(t, r",$") & ~has_digit(t)
    return F.coalesce(F.when(matches(t, r"^,"), comma_fragment_attaches(t, following, full_names)).otherwise(F.when(found != "", strict).otherwise(loose)) & ~has_paren_year(t), F.lit(False))
