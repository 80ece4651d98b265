"""The line operators of sequence.py over one document's list of lines, and whole chains of them.

A chain of operators over documents that are rows with an array of lines needs no window,
sort or exchange: it is one pass of one function. These are the forms that
plans/references.py runs; sequence.py has those for lines that are rows, and tests hold
each against the other.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from citeweave.functions import doi as D
from citeweave.functions import patterns as P
from citeweave.functions.text import DIAERESES
from citeweave.operators.folds import Lines, attach_leading_ampersand, author_append, editor_merge, join_on_url_end, numbered_join

#: A test of a line, the one before it and the one after it ("" where there is none).
Test = Callable[[str, str, str], bool]


def found(pattern: str) -> Callable[[str], bool]:
    search = re.compile(pattern).search
    return lambda t: search(t) is not None


# ---- predicates: those of functions/predicates.py ---------------------------------------

government, has_paren_year, ends_with_paren_year = found(P.GOVERNMENT), found(P.YEAR_PAREN), found(P.YEAR_PAREN + r"\s*$")
has_bare_year, year_found, starts_with_year, ends_with_year = found(P.BARE_YEAR), found(P.YEAR_FOUND), found(P.STARTS_WITH_YEAR), found(P.ENDS_IN_YEAR)
has_digit, single_token, starts_with_link, numeric_fragment = found(r"\d"), found(r"^\S+$"), found(P.LEADING_LINK), found(P.NUMERIC_FRAGMENT)
_starts_paren_or_year, _ends_hyphen = found(rf"^\s*(?:\(|{P.YEAR}(?!\d))"), found(rf"[-_{P.HYPHENS}]\Z")
_initials_year, _initials_near_year, _initials_bare = found(P.INITIALS_THEN_YEAR), found(P.INITIALS_NEAR_YEAR), found(rf"^\s*(?:[A-Z]\.?\s+){{1,3}}{P.YEAR}(?!\d)")
_ends_comma_or_initial, _starts_initial, _own_initial = found(r",\Z|\b[A-Z]\.?\Z"), found("^" + P.INITIALS), found(rf"(?:^|[\s,.&-]){P.INITIALS}")
_goes_on, _only_signs, _century = found(r"^(?:[A-Za-z](?:\.|\b)|,|&|(?i:and)\b)"), found(r"^\W*$"), found(r"(?:1[789]|20)\d{2}")
_AUTHORS, _STARTS = (re.compile(P.AUTHORS), re.compile(P.AUTHORS_FULL)), (re.compile(P.AUTHOR_START), re.compile(P.AUTHOR_START_FULL))
_YEARS, _TRAILER = re.compile(rf"(?<!\d){P.YEAR}(?!\d)"), re.compile(r"^(.*\]\.)\s+(.+)$")
_ACCESSED, _LINK, _BRACKET = re.compile(f"({P.ACCESSED})"), re.compile(f"({P.URL_TOKEN})\\s*"), re.compile(r"^\s*((?:\([^)]*\)|\[[^\]]*\])\.?)\s*(.*)$")


def ends_comma_or_initial(t: str) -> bool:
    return _ends_comma_or_initial(t.rstrip(" "))


def short_fragment(t: str, spaces: int = 2) -> bool:
    return t.count(" ") + t.count("\u00a0") <= spaces


def author_line(t: str, following: str, full: bool = False) -> bool:
    """A line of authors only, in bibliographies with bare years; see predicates.is_author_line."""
    t, following = t.strip(" "), following.lstrip(" ")
    start = _STARTS[full].search(t)
    if t.startswith(","):
        return _starts_initial(following) or full and _STARTS[1].search(following) is not None
    if year_found(t):
        return False
    if t.endswith(",") and start and _starts_initial(following):
        return True
    if _century(t):
        return False
    m = _AUTHORS[full].search(t)
    if not m:
        return bool(start) and _only_signs(t[start.end() :]) and not has_digit(t)
    rest = t[m.end() :].strip(" ")
    return not has_digit(m[0]) and (_only_signs(rest) or _own_initial(m[0]) and _goes_on(rest))


# ---- kernels ----------------------------------------------------------------------------


def attach(lines: Lines, test: Test, separator: str = " ") -> Lines:
    """Each line for which the test holds goes to the end of the one before; the first never does."""
    out: Lines = []
    for i, line in enumerate(lines):
        if out and test(line, lines[i - 1], lines[i + 1] if i + 1 < len(lines) else ""):
            out[-1] = out[-1].rstrip(" ") + separator + line.lstrip(" ")
        else:
            out.append(line)
    return out


def consume(lines: Lines, takes: Callable[[str], bool]) -> Lines:
    """Each line for which takes holds swallows the next one, unless that is a government marker; a swallowed line takes nothing."""
    out: Lines = []
    i = 0
    while i < len(lines):
        two = i + 1 < len(lines) and takes(lines[i]) and not government(lines[i + 1])
        out.append(f"{lines[i].rstrip(' ')} {lines[i + 1].lstrip(' ')}" if two else lines[i])
        i += 1 + two
    return out


def hyphen_join(lines: Lines) -> Lines:
    return attach(lines, lambda t, before, after: _ends_hyphen(before.rstrip(" ")), "")


def append_until_year(lines: Lines, cap: int = 25) -> Lines:
    out: Lines = []
    room = 0  # lines that the open one may still take
    for line in lines:
        if room:
            out[-1] = f"{out[-1].rstrip(' ')} {line.lstrip(' ')}"
            room -= 1
        else:
            out.append(line)
            room = cap
        if year_found(line):
            room = 0
    return out


def collapse_authors(lines: Lines, full: bool = False) -> Lines:
    """From an author line on, lines that are author lines before their next one join."""
    out: Lines = []
    started = False
    for i, line in enumerate(lines):
        on = author_line(line, lines[i + 1] if i + 1 < len(lines) else "", full)
        if on and started:
            out[-1] = f"{out[-1].rstrip(' ')} {line.lstrip(' ')}"
        else:
            out.append(line)
        started = on and (started or author_line(line, "", full))
    return out


def split_each(lines: Lines, pieces: Callable[[str], list[str]]) -> Lines:
    return [p for line in lines for p in pieces(line) if p.strip(" ")]


def split_accessed(line: str) -> list[str]:
    return [p.strip(" ") for p in _ACCESSED.sub("\\1\u0001", line).split("\u0001")]


def split_links(line: str) -> list[str]:
    return [p.strip(" ") for p in _LINK.sub("\\1\u0001", line).split("\u0001")]


def split_trailer(line: str, least_years: int) -> list[str]:
    """Two references run together at '].', if an author without digits follows and there are years enough."""
    m = _TRAILER.match(line)
    author = _STARTS[0].search(m[2]) if m else None
    return [m[1], m[2]] if author and not has_digit(author[0]) and len(_YEARS.findall(line)) >= least_years else [line]


def attach_parentheticals(lines: Lines) -> Lines:
    out: Lines = []
    for line in lines:
        m = _BRACKET.match(line)
        for piece, joins in ((m[1], True), (m[2], False)) if m else ((line, False),):
            if not piece.strip(" "):
                continue
            if joins and out:
                out[-1] = f"{out[-1].rstrip(' ')} {piece.lstrip(' ')}"
            else:
                out.append(piece)
    return out


# ---- chains -----------------------------------------------------------------------------


_STYLE_NUMBER = {"bracket": r"\[\d{1,3}\]", "paren": r"\(\d{1,3}\)", "bare": r"\d{1,3}\."}


def numbers_stripped(lines: Lines, style: str | None = None, max_digits: int | None = None) -> Lines:
    """Without the number that starts a list item: of a style, else '1.', '[1]' or '1 '."""
    digits = r"\d+" if max_digits is None else rf"\d{{1,{max_digits}}}"
    number = re.compile(rf"^\s*(?:{_STYLE_NUMBER[style] if style else rf'{digits}\.|\[{digits}\]|{digits}(?=\s)'})\s*")
    return [number.sub("", t) for t in lines]


def finished(lines: Lines, strip_numbers: bool, max_digits: int | None = None) -> Lines:
    """Vowels with their diaeresis and, if asked for, without the numbers of a list."""
    for broken, whole in DIAERESES.items():
        lines = [t.replace(broken, whole) for t in lines]
    return numbers_stripped(lines, None, max_digits) if strip_numbers else lines


def paren_year_list(lines: Lines, editor_rounds: int = 3, author_rounds: int = 10) -> Lines:
    """Clean lines to references of a bibliography whose years are in parentheses."""
    lines = attach(hyphen_join(lines), lambda t, before, after: _starts_paren_or_year(t))
    lines = consume(lines, ends_with_paren_year)
    lines = attach(lines, lambda t, before, after: single_token(t.strip(" ")))
    lines = attach(lines, lambda t, before, after: (_initials_year(t) or _initials_near_year(t)) and ends_comma_or_initial(before))
    lines = consume(lines, lambda t: t.rstrip(" ").endswith("&"))
    lines = author_append(editor_merge(attach_leading_ampersand(lines), rounds=editor_rounds), rounds=author_rounds)
    lines = attach(lines, lambda t, before, after: not has_paren_year(t) and not government(t))
    return [D.moved(t) for t in split_each(lines, lambda t: split_trailer(t, 2))]


def numbered_list(lines: Lines, style: str) -> Lines:
    """Clean lines of a document with one numbering style to the list's items."""
    return numbered_join(hyphen_join(lines), style)


def bare_year_list(lines: Lines, authors_first: bool, full: bool, max_append: int = 25, initials_merge: bool = False, numeric_fragments: bool = False, editor_rounds: int = 3, author_rounds: int = 10) -> Lines:
    """Clean lines to references of a bibliography whose years are bare: after the authors, else at the end."""
    lines = collapse_authors(lines, full)
    if authors_first:
        lines = consume(attach(lines, lambda t, before, after: starts_with_year(t)), ends_with_year)
        lines = author_append(editor_merge(lines, paren=False, rounds=editor_rounds), paren=False, rounds=author_rounds)
        lines = attach(lines, lambda t, before, after: not year_found(t) and not (_STARTS[full].search(t) and not author_line(t, after, full)))
        lines = attach(lines, lambda t, before, after: has_digit(t) and not year_found(t))
    else:
        lines = append_until_year(lines, max_append)
    if initials_merge:
        lines = attach(lines, lambda t, before, after: _initials_bare(t) and ends_comma_or_initial(before))
        lines = consume(lines, lambda t: t.rstrip(" ").endswith("&"))
    if numeric_fragments:
        lines = attach(lines, lambda t, before, after: numeric_fragment(t.strip(" ")))
    lines = attach(lines, lambda t, before, after: not has_bare_year(t))
    lines = attach(lines, lambda t, before, after: short_fragment(t) and not government(t))
    lines = attach(join_on_url_end(lines), lambda t, before, after: starts_with_link(t))
    lines = split_each(split_each(lines, split_accessed), split_links)
    lines = split_each([D.broken_mended(D.moved(t)) for t in lines], lambda t: split_trailer(t, 0))
    lines = attach(lines, lambda t, before, after: short_fragment(t) and not author_line(t, after, full))
    return attach_parentheticals(lines)


# ---- kind of list -------------------------------------------------------------------------

_NUMBERED = {style: found(pattern) for style, pattern in P.NUMBER_STYLES.items()}
_ALONE = found(r"^\s*(?:\[\d{1,3}\]|\(\d{1,3}\)|\d{1,3}\.?)\s*$")


def list_kind(lines: Lines, least: dict[str, int]) -> str:
    """'paren_year', 'bare_year' or the style of a numbered list: the first with lines enough, whose numbers mostly don't stand alone."""
    style = next((s for s, test in _NUMBERED.items() if sum(map(test, lines)) >= least[s]), None)
    if style is None:
        return "paren_year"
    return "bare_year" if sum(map(_ALONE, lines)) > 0.5 * len(lines) else style
