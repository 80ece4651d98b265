"""DOIs in text: extraction, repair, canonical placement.

Native columns cover a DOI written in one piece; the Arrow functions at the end also
put together what line breaks and spaces have broken.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from citeweave.functions import patterns as P

_EDGE = ".,;()[]"


def not_inside_others(ids: Column) -> Column:
    """Ids that are no part of another id of the array."""
    return F.filter(ids, lambda x: ~F.exists(ids, lambda y: (y != x) & F.contains(y, x)))


def extract_simple(t: Column) -> Column:
    """Distinct DOIs written in one piece, in order of appearance, without punctuation at their ends."""
    found = F.regexp_extract_all(F.coalesce(t, F.lit("")), F.lit(r"10\.[0-9]{4,9}/[^\s)\],;]+"), F.lit(0))
    return not_inside_others(F.array_distinct(F.transform(found, lambda x: F.regexp_replace(x, r"[.,;()\[\]]+$", ""))))


def fix_broken(t: Column) -> Column:
    """Spaces and a missing slash inside 'doi.org/10.'."""
    for pattern, new in ((r"(?i)doi\.\s+org", "doi.org"), (r"(?i)doi\s+\.org", "doi.org"), (r"(?i)doi\.org\s*/\s*10\.", "doi.org/10."), (r"(?i)doi\.org10\.", "doi.org/10.")):
        t = F.regexp_replace(t, pattern, new)
    return t


def normalize_fragment(t: Column) -> Column:
    """'1 0.' to '10.', no space after 'doi.org/' and '10.x/', '{_}' to '_', and doi.org/ before a naked DOI unless a marker is near."""
    t = F.regexp_replace(t, r"\b1 0\.(?=\d)", "10.")
    t = F.regexp_replace(t, r"(?i)(doi\.org/)\s+(?=\S)", "$1")
    t = F.regexp_replace(t, r"\{_\}", "_")
    t = F.regexp_replace(t, r"(10\.\d{4,9}/)\s+(?=\S)", "$1")
    return F.regexp_replace(t, r"(?i)(?<!(?:doi|https?:|www)[^\n]{0,30})\b(?=10\.\d{4,9}/\S)", "doi.org/")


def remove_stray_prefixes(t: Column) -> Column:
    """'doi.org/' and 'doi:' that no DOI follows."""
    t = F.regexp_replace(t, r"(?i)(?:https?://)?(?:dx\.)?doi\.org/(?!\s*10\.\d)|\bdoi:(?!\s*(?:10\.\d|https?:))", "")
    return F.trim(F.regexp_replace(t, " {2,}", " "))


def clean_dangling(t: Column) -> Column:
    """A conjunction that lost its second part: '(with and' to '(with', 'and.' to '.'."""
    t = F.regexp_replace(t, r"(?i)\b(with|for|in|via),?\s+(?:and|&)(?=\s*(?:[.,;:)]|$))", "$1")
    return F.regexp_replace(t, r"(?i)\s+and(?=\s*[.,;:])", "")


def space_after(t: Column) -> Column:
    """A space between a canonical DOI and a capitalised word glued to it."""
    return F.regexp_replace(t, r"(https://doi\.org/10\.\d{4,9}/[^\s)\],;]*\d)(?=[A-Z][a-z]{2,})", "$1 ")


def split_links(t: Column) -> Column:
    """The text cut after every URL and DOI token, as an array of trimmed, non-empty pieces."""
    marked = F.regexp_replace(t, f"({P.URL_TOKEN})\\s*", "$1\u0001")
    return F.filter(F.transform(F.split(marked, "\u0001"), lambda x: F.trim(x)), lambda x: x != "")


def simple_to_end(t: Column) -> Column:
    """A line's single DOI moved behind it as a URL; lines with none or several stay."""
    ids = extract_simple(t)
    bare = F.regexp_replace(t, r"(?i)[,\s]*(?:(?:https?://)?(?:dx\.)?doi\.org/|doi:\s*)?10\.[0-9]{4,9}/[^\s)\],;]+", "")
    bare = F.regexp_replace(F.rtrim(bare), r"\.+$", "")
    return F.when(F.size(ids) == 1, F.concat(bare, F.lit(". https://doi.org/"), F.try_element_at(ids, F.lit(1)))).otherwise(t)


# ---- exact path ---------------------------------------------------------------------

_URL, _BARE_URL, _COLON, _ID, _TWO = (re.compile(p) for p in (P.DOI_URL, P.DOI_BARE_URL, P.DOI_COLON, P.DOI_ID, P.DOI_TWO_TOKENS))
_VALID = re.compile(r"10\.\d{2,9}/.*[^.\-_]", re.S)
_NAME_LIKE = re.compile(r"(?:[A-ZÅÄÖ][a-zåäö]+|[A-Z]\.?|&|and)$")
_BREAKS = (".", "-", "_")


def _mend_urls(text: str) -> str:
    """A doi.org URL that ends in a break takes what follows, up to 12 tokens, unless that reads like a name."""

    def mend(m: re.Match) -> str:
        tokens = m[0].split()
        if len(tokens) < 2 or not tokens[0].endswith(_BREAKS) or _NAME_LIKE.match(tokens[1].strip(_EDGE)):
            return m[0]
        return "".join(tokens).rstrip(_EDGE)

    text = re.sub(r"(?i)(?:https?://doi\.org/){2,}", "https://doi.org/", text)
    return re.sub(r"(?i)https?://(?:dx\.)?doi\.org/\S+(?:\s+\S+){0,11}", mend, text)


def extract_ids(text: str | None) -> list[str]:
    """All DOIs of a text in the order URL, 'doi:', bare, broken in two; distinct, valid and none a part of another."""
    text = _mend_urls(text or "")
    found = [m[1] for m in _URL.finditer(text)] + [m[1] for m in _BARE_URL.finditer(text)]
    for m in _COLON.finditer(text):
        first, second = m[1], m[2]
        inner = _URL.search(first)
        found.append(inner[1] if inner else first + second if second and first.endswith(_BREAKS) else first)
    found += _ID.findall(text)
    found += [a + b for a, b in _TWO.findall(text) if a.endswith(_BREAKS)]
    ids = dict.fromkeys(x.strip(_EDGE) for x in found)
    valid = [x for x in ids if _VALID.fullmatch(x)]
    return [x for x in valid if not any(x != y and x in y for y in valid)]


def attach_split_dois(pieces: Sequence[str]) -> list[str]:
    """Pieces with a DOI's rest put back to its start.

    A piece that starts like a DOI takes the next one if that begins with a token of DOI
    characters which has a digit, an underscore or an inner dot; so does one that ends
    after a prefix or slash, if a DOI number follows.
    """
    out: list[str] = []
    for piece in pieces:
        before = out[-1].rstrip() if out else ""
        token = piece.split()[0] if piece.split() else ""
        prefix = re.search(r"(?i)(?:doi\.org/?|doi:|/)$", before) and re.match(r"(?i)10\.\d|doi\.org/", token)
        starts = re.match(r"(?i)(?:https?://)?(?:dx\.)?doi\.org/|doi:|10\.\d{4,9}/", before) and not before.endswith((",", ";", ":"))
        plain = re.fullmatch(r"[A-Za-z0-9._/-]+", token) and (token == "/" or re.search(r"\d|_|.\..", token))
        closed = token.endswith(".") and not ("_" in token or "/" in token or token.count(".") > 1)
        if out and (prefix or starts and plain and not closed):
            out[-1] = before + piece.lstrip()
        else:
            out.append(piece)
    return out


def _fixed(text: str) -> str:
    text = re.sub(r"(?i)doi\.\s+org", "doi.org", text)
    text = re.sub(r"(?i)doi\.org\s*/?\s*(?=10\.\d)", "doi.org/", text)
    text = re.sub(r"\b1 0\.(?=\d)", "10.", text).replace("{_}", "_")
    return re.sub(r"(10\.\d{4,9}/)\s+(?=\S)", r"\1", text)


def _split(text: str) -> list[str]:
    marked = re.sub(f"({P.URL_TOKEN})\\s*", "\\1\u0001", text)
    return [p.strip() for p in marked.split("\u0001") if p.strip()]


def move_to_end(text: str | None) -> str | None:
    """A reference with its DOIs as URLs behind it, and without their other mentions. Without a DOI only 'doi: ' loses its space."""
    if text is None:
        return None
    first = re.sub(r"(?i)\b(doi:)(?:\s*doi:)*\s*", r"\1", text)
    joined = " ".join(attach_split_dois(_split(_fixed(first))))
    ids = extract_ids(joined)
    if not ids:
        return first
    rest = joined
    for x in sorted(ids, key=len, reverse=True):
        broken = "".join(re.escape(c) + (r"\s*" if c in _BREAKS else "") for c in x)
        rest = re.sub(rf"(?i)[(\[]?(?:(?:https?://)?(?:dx\.)?doi\.org/|doi:\s*)*\[?{broken}[.,;]?[)\]]?", " ", rest)
    rest = re.sub(r"(?i)(?:https?://)?(?:dx\.)?doi\.org/(?!10\.\d)|\bdoi:(?!\s*10\.\d)", " ", rest)
    rest = re.sub(r"(?i)\b(with|for|in|via),?\s+(?:and|&)(?=\s*(?:[.,;:)]|$))", r"\1", rest)
    rest = re.sub(r"\s+([.,;:])", r"\1", re.sub(r"\s{2,}", " ", rest)).strip().rstrip(".").rstrip()
    urls = " ".join(f"https://doi.org/{x}" for x in ids)
    return f"{rest}. {urls}" if rest else urls


def extract_exact(t: Column) -> Column:
    """extract_ids as an Arrow function."""

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(extract_ids)

    return F.pandas_udf(run, ArrayType(StringType()))(t)


def to_end_exact(t: Column) -> Column:
    """move_to_end as an Arrow function."""

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(move_to_end)

    return F.pandas_udf(run, StringType())(t)


#: What every DOI, broken or not, has in it.
SIGN = r"(?i)1 ?0\.|doi"
_SIGN = re.compile(SIGN)
_MEND = [(re.compile(p), new) for p, new in ((r"(?i)doi\.\s+org", "doi.org"), (r"(?i)doi\s+\.org", "doi.org"), (r"(?i)doi\.org\s*/\s*10\.", "doi.org/10."), (r"(?i)doi\.org10\.", "doi.org/10."))]


def moved(text: str) -> str:
    """move_to_end for texts with a sign of a DOI; others are left as they are."""
    return move_to_end(text) if _SIGN.search(text) else text


def broken_mended(text: str) -> str:
    """fix_broken of a Python string."""
    for pattern, new in _MEND:
        text = pattern.sub(new, text)
    return text


def to_end(t: Column) -> Column:
    """As to_end_exact, but texts without a sign of a DOI are left as they are and cost Python a search only.

    An Arrow function sees every row of its batch, whatever condition is around it, so all
    texts travel.
    """

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(moved, na_action="ignore")

    return F.pandas_udf(run, StringType())(t)
