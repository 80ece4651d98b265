"""Rules over a document's list of lines that look at all that was joined so far. Run by sequence.fold()."""

from __future__ import annotations

import re
from collections.abc import Callable

from citeweave.functions import patterns as P

Lines = list[str]

_GOVERNMENT, _PAREN_YEAR, _BARE_YEAR = re.compile(P.GOVERNMENT), re.compile(P.YEAR_PAREN), re.compile(P.YEAR_FOUND)
_EDITOR, _AUTHORS, _AUTHOR_START = re.compile(P.EDITOR), re.compile(P.AUTHORS), re.compile(P.AUTHOR_START)
_PARENS = re.compile(r"\(([^()]*)\)")
_SUFFIX = re.compile(r"(?i)(?:https?://(?:www\.)?|(?:dx\.)?doi\.org/?|doi[.:]|www\.)$")


def _joined(a: str, b: str) -> str:
    return f"{a.rstrip()} {b.lstrip()}"


def has_year(paren: bool) -> Callable[[str], bool]:
    return lambda t: bool((_PAREN_YEAR if paren else _BARE_YEAR).search(t))


def author_line(t: str) -> bool:
    """Plain form of the author-line predicates, for text that was joined before."""
    t = t.strip()
    m = _AUTHORS.match(t)
    if not m or re.search(r"\d", m[0]):
        return bool(_AUTHOR_START.match(t)) and t.endswith(",") and not re.search(r"\d", t)
    rest = t[m.end() :].strip()
    return not re.sub(r"\W", "", rest) or bool(re.match(r"[A-Za-z](?:\.|\b)|,|&|and\b", rest))


def join_on_url_end(lines: Lines) -> Lines:
    """A line that ends in the start of a URL or DOI takes the first token of the next; the rest of that stays a line and may do the same."""
    out: Lines = []
    for i, line in enumerate(lines):
        after = lines[i + 1] if i + 1 < len(lines) else ""
        current = line
        if out and _SUFFIX.search(out[-1].rstrip()) and current.strip() and not current.lstrip().startswith(("(", "[")) and not (author_line(current) and after):
            token, _, rest = current.strip().partition(" ")
            out[-1] = out[-1].rstrip() + token
            current = rest.lstrip()
            if not current:
                continue
        out.append(current)
    return out


def numbered_join(lines: Lines, style: str = "bracket") -> Lines:
    """Lines of a numbered list joined from number to number.

    A number without text continues an open item unless it is the next one; a government
    marker starts an item without number; anything else continues.
    """
    number = re.compile({"bracket": r"\s*\[(\d{1,3})\]", "paren": r"\s*\((\d{1,3})\)", "bare": r"\s*(\d{1,3})\.(?!\d)"}[style])
    out: Lines = []
    last: int | None = None
    for line in lines:
        m = number.match(line)
        if m:
            alone = not line[m.end() :].strip()
            if alone and last is not None and int(m[1]) != last + 1:
                out[-1] = _joined(out[-1], line)
            else:
                out.append(line)
                last = int(m[1])
        elif not out or _GOVERNMENT.match(line):
            out.append(line)
            last = None
        else:
            out[-1] = _joined(out[-1], line)
    return out


def attach_leading_ampersand(lines: Lines) -> Lines:
    out: Lines = []
    for line in lines:
        if out and line.lstrip().startswith("&") and author_line(out[-1]):
            out[-1] = _joined(out[-1], line)
        else:
            out.append(line)
    return out


def editor_merge(lines: Lines, paren: bool = True, rounds: int = 3) -> Lines:
    """'(Eds.)' on a line without a year goes to the line before, and what follows it comes behind it."""
    year = has_year(paren)
    token = lambda s: bool(_EDITOR.match(s.strip()))

    def attached(line: str) -> bool:
        first = _PARENS.search(line)
        return not year(line) and not _GOVERNMENT.match(line) and bool(first) and token(first[1])

    def goes_on(before: str, line: str) -> bool:
        found = list(_PARENS.finditer(before))
        ends = bool(found) and token(found[-1][1]) and not re.search(r"\w", before[found[-1].end() :])
        return ends and not year(line) and not _GOVERNMENT.match(line) and not _AUTHORS.match(line.strip())

    for _ in range(rounds):
        if not any(not year(x) and any(token(p) for p in _PARENS.findall(x)) for x in lines):
            break
        for rule in (lambda before, line: attached(line), goes_on):
            out: Lines = []
            for line in lines:
                if out and rule(out[-1], line):
                    out[-1] = _joined(out[-1], line)
                else:
                    out.append(line)
            lines = out
    return lines


def author_append(lines: Lines, paren: bool = True, rounds: int = 10) -> Lines:
    """A line of authors without year or digit takes the next one, until nothing changes."""
    year = has_year(paren)

    def open_authors(t: str) -> bool:
        if year(t) or re.search(r"\d", t) or len(re.findall(r"\s", t.strip())) < 2:
            return False
        return author_line(t) or paren and t.rstrip().endswith(",") and t.count(",") >= 2

    for _ in range(rounds):
        out: Lines = []
        i = 0
        while i < len(lines):
            takes = open_authors(lines[i]) and i + 1 < len(lines) and not _GOVERNMENT.match(lines[i + 1])
            out.append(_joined(lines[i], lines[i + 1]) if takes else lines[i])
            i += 2 if takes else 1
        if out == lines:
            break
        lines = out
    return lines
