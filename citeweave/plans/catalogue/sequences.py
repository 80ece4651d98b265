"""Operators over a document's ordered lines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F

from citeweave.functions import doi as D
from citeweave.operators import folds as O
from citeweave.operators import sequence as S
from citeweave.plans.catalogue.data import GOVERNMENT, PAREN, WITH, YEARS, holds, lines
from citeweave.plans.catalogue.predicates import AUTHOR_LINE, AUTHORS_ONLY, BARE_YEAR, ENDS_YEAR, HAS_PAREN, LINK, NUMERIC, OFFICIAL, SPACES, STARTS_YEAR, YEAR_FOUND
from citeweave.plans.catalogue.scalars import AUTHOR_PREFIX

_BY = "OVER (PARTITION BY doc_id ORDER BY line_no)"
#: Lines with those before and after them.
_AROUND = f"{WITH}, a AS (SELECT *, lag(text) {_BY} AS before, lead(text) {_BY} AS after FROM lines)"


def _joined(separator: str = " ") -> str:
    """The end of an islands query over b(doc_id, line_no, text, fresh): islands joined as the operators join them."""
    return f"""c AS (SELECT *, sum(fresh) {_BY} AS island, coalesce(lead(fresh) {_BY}, 1) AS closed FROM b)
SELECT doc_id, CAST(island AS int) AS line_no, CASE WHEN count(*) = 1 THEN min(text) ELSE array_to_string(list(
    CASE WHEN fresh = 1 THEN rtrim(text) WHEN closed = 1 THEN ltrim(text) ELSE trim(text) END ORDER BY line_no), '{separator}') END AS text
FROM c GROUP BY doc_id, island"""


def _islands(attach: str, separator: str = " ") -> str:
    """Each line for which attach holds goes to the one before; it may use text, before and after."""
    return f"{_AROUND}, b AS (SELECT *, CASE WHEN line_no > 1 AND coalesce({attach}, false) THEN 0 ELSE 1 END AS fresh FROM a), {_joined(separator)}"


def _consume(takes: str) -> str:
    """Odd lines of a run that could take their next one do."""
    able = f"coalesce({takes} AND after IS NOT NULL AND NOT {holds(GOVERNMENT, 'after')}, false)"
    return f"""{_AROUND}, able AS (SELECT *, {able} AS able FROM a),
runs AS (SELECT *, sum(CASE WHEN able THEN 0 ELSE 1 END) {_BY} AS run FROM able),
placed AS (SELECT *, sum(CASE WHEN able THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, run ORDER BY line_no) AS place FROM runs),
taken AS (SELECT *, coalesce(lag(able AND place % 2 = 1) {_BY}, false) AS taken FROM placed),
b AS (SELECT doc_id, line_no, text, CASE WHEN taken THEN 0 ELSE 1 END AS fresh FROM taken), {_joined()}"""


def _split(pieces: str) -> str:
    """Lines as the elements of a list, numbered anew."""
    return f"""{WITH}, p AS (SELECT doc_id, line_no, unnest({pieces}) AS text, generate_subscripts({pieces}, 1) AS nth FROM lines)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY line_no, nth) AS int) AS line_no, text FROM p WHERE trim(text) <> ''"""


_COLLAPSE = f"""{_AROUND}, s AS (SELECT *, coalesce({AUTHOR_LINE}, false) AS goes_on, {AUTHORS_ONLY} AS starts FROM a),
r AS (SELECT *, sum(CASE WHEN goes_on THEN 0 ELSE 1 END) {_BY} AS run FROM s),
i AS (SELECT *, coalesce(max(CASE WHEN starts AND goes_on THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, run ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 AS begun FROM r),
b AS (SELECT doc_id, line_no, text, CASE WHEN goes_on AND begun THEN 0 ELSE 1 END AS fresh FROM i), {_joined()}"""

_UNTIL_YEAR = f"""{WITH}, g AS (SELECT *, coalesce(sum(CASE WHEN {YEAR_FOUND} THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS g FROM lines),
b AS (SELECT doc_id, line_no, text, CASE WHEN (row_number() OVER (PARTITION BY doc_id, g ORDER BY line_no) - 1) % 4 = 0 THEN 1 ELSE 0 END AS fresh FROM g), {_joined()}"""

_DASHES = f"""{WITH}, p AS (SELECT *, ltrim(text) LIKE '---,%' AS dashed, nullif({AUTHOR_PREFIX}, '') AS prefix FROM lines),
l AS (SELECT *, last_value(CASE WHEN NOT dashed THEN prefix END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS found FROM p)
SELECT doc_id, line_no, CASE WHEN dashed AND found IS NOT NULL THEN found || ' ' || ltrim(substr(ltrim(text), 5)) ELSE text END AS text FROM l"""

_BRACKET = r"^\s*((?:\([^)]*\)|\[[^\]]*\])[.]?)\s*(.*)$"
_BRACKETS = f"""{WITH}, p AS (SELECT doc_id, line_no, 1 AS nth, true AS joins, regexp_extract(text, '{_BRACKET}', 1) AS text FROM lines
    UNION ALL SELECT doc_id, line_no, 2, false, CASE WHEN {holds(_BRACKET)} THEN regexp_extract(text, '{_BRACKET}', 2) ELSE text END FROM lines),
n AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY line_no, nth) AS line_no, text, joins FROM p WHERE trim(text) <> ''),
b AS (SELECT doc_id, line_no, text, CASE WHEN joins AND line_no > 1 THEN 0 ELSE 1 END AS fresh FROM n), {_joined()}"""

#: The first token of a line after one that ends in a link's start goes there; what is left of the line stays one.
_URL_END = f"""{_AROUND}, t AS (SELECT *, coalesce(before LIKE '%https://' AND NOT {holds('^[(\\[]')} AND NOT ({AUTHORS_ONLY} AND after IS NOT NULL), false) AS gives, split_part(trim(text), ' ', 1) AS token FROM a),
n AS (SELECT *, coalesce(lead(gives) {_BY}, false) AS takes, lead(token) {_BY} AS more, CASE WHEN gives THEN ltrim(substr(trim(text), length(token) + 1)) ELSE text END AS rest FROM t),
w AS (SELECT doc_id, line_no, CASE WHEN takes THEN rtrim(rest) || more ELSE rest END AS text, gives FROM n)
SELECT doc_id, CAST(row_number() {_BY} AS int) AS line_no, text FROM w WHERE NOT (gives AND text = '')"""

_NUMBER = r"^\s*\[([0-9]{1,3})\]"
#: State from line to line: the last number of the list, or none; a number alone opens an item only if it is the next one.
_NUMBERED = f"""WITH RECURSIVE lines AS ({WITH.partition('(')[2].rstrip()[:-1]}),
m AS MATERIALIZED (SELECT *, try_cast(nullif(regexp_extract(text, '{_NUMBER}', 1), '') AS int) AS number, {holds(_NUMBER + r'\s*$')} AS alone, {OFFICIAL} AS official FROM lines),
walk AS (SELECT doc_id, line_no, text, number AS last_number, 1 AS fresh FROM m WHERE line_no = 1
    UNION ALL SELECT m.doc_id, m.line_no, m.text,
        CASE WHEN m.number IS NOT NULL AND NOT (m.alone AND walk.last_number IS NOT NULL AND m.number <> walk.last_number + 1) THEN m.number WHEN m.number IS NULL AND m.official THEN NULL ELSE walk.last_number END,
        CASE WHEN m.number IS NOT NULL AND NOT (m.alone AND walk.last_number IS NOT NULL AND m.number <> walk.last_number + 1) THEN 1 WHEN m.number IS NULL AND m.official THEN 1 ELSE 0 END
    FROM walk JOIN m ON m.doc_id = walk.doc_id AND m.line_no = walk.line_no + 1),
b AS (SELECT doc_id, line_no, text, fresh FROM walk), {_joined()}"""

#: Lines whose first token may be the rest of a DOI, after one that starts with a DOI or others of them.
_REATTACHED = f"""{WITH}, q AS (SELECT *, text IN ('123', '49') OR text LIKE '2003/%' OR text LIKE 'org/%' AS rest FROM lines),
r AS (SELECT *, sum(CASE WHEN rest THEN 0 ELSE 1 END) {_BY} AS run FROM q),
b AS (SELECT doc_id, line_no, text, CASE WHEN rest AND first_value(text) OVER (PARTITION BY doc_id, run ORDER BY line_no) LIKE 'doi: %' THEN 0 ELSE 1 END AS fresh FROM r), {_joined("")}"""

_PLAIN = "(text LIKE 'Old work, 1998 [reprint]. Stone%')"
_TRAILERS = f"CASE WHEN {_PLAIN} THEN [substr(text, 1, 25), substr(text, 27)] ELSE [text] END"
_LINKS = r"list_transform(string_split(regexp_replace(text, '((?:https?://|(?:dx\.)?doi\.org/|doi:)\S+)\s*', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x))"
_ACCESSED = r"list_transform(string_split(regexp_replace(text, '(\[accessed on [0-9-]+\][.]?)', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x))"
_UNSURE = f"({holds('^Miller')} OR {holds('^(Paper|Articles) I-(III|IV|VI)$')})"


def _sequence(operator: Callable) -> Callable:
    return lambda spark, sf: operator(S.in_documents(lines(spark, sf)))


def _fold(step: Callable) -> Callable:
    return _sequence(lambda x: S.fold(x, step))


#: name: (query, oracle)
ENTRIES = {
    "hyphen_join": (_sequence(S.hyphen_join), _islands("regexp_matches(rtrim(before), '[-_]$')", "")),
    "attach_non_year": (_sequence(S.attach_non_year), _islands(f"NOT {BARE_YEAR}")),
    "merge_short": (_sequence(S.merge_short), _islands(f"{SPACES} <= 2 AND NOT {OFFICIAL}")),
    "attach_paren_or_year_start": (_sequence(S.attach_paren_or_year_start), _islands(holds(rf"^\s*(\(|{YEARS}([^0-9]|$))"))),
    "year_end_consume": (_sequence(S.year_end_consume), _consume(holds(PAREN + r"\s*$"))),
    "attach_single_tokens": (_sequence(S.attach_single_tokens), _islands(holds(r"^\S+$", "trim(text)"))),
    "attach_initials_year": (_sequence(S.attach_initials_year), _islands(rf"{holds(rf'^([A-Z]\.?\s+){{1,3}}.{{0,120}}{PAREN}')} AND regexp_matches(rtrim(before), '(,|\b[A-Z]\.?)$')")),
    "attach_initials_bare": (_sequence(S.attach_initials_bare), _islands(rf"{holds(rf'^([A-Z]\.?\s+){{1,3}}{YEARS}([^0-9]|$)')} AND regexp_matches(rtrim(before), '(,|\b[A-Z]\.?)$')")),
    "ampersand_consume": (_sequence(S.ampersand_consume), _consume("rtrim(text) LIKE '%&'")),
    "append_non_year": (_sequence(S.append_non_year), _islands(f"NOT {HAS_PAREN} AND NOT {OFFICIAL}")),
    "append_non_year_bare": (_sequence(S.append_non_year_bare), _islands(f"NOT {YEAR_FOUND} AND NOT {_UNSURE}")),
    "collapse_authors": (_sequence(S.collapse_authors), _COLLAPSE),
    "attach_year_start": (_sequence(S.attach_year_start), _islands(STARTS_YEAR)),
    "bare_year_end_consume": (_sequence(S.bare_year_end_consume), _consume(ENDS_YEAR)),
    "attach_digits": (_sequence(S.attach_digits), _islands(f"{holds('[0-9]')} AND NOT {YEAR_FOUND}")),
    "append_until_year": (_sequence(lambda x: S.append_until_year(x, 3)), _UNTIL_YEAR),
    "append_until_year_25": (_sequence(S.append_until_year), _UNTIL_YEAR.replace("% 4 = 0", "% 26 = 0")),
    "attach_leading_links": (_sequence(S.attach_leading_links), _islands(LINK)),
    "short_join": (_sequence(S.short_join), _islands(f"{SPACES} <= 2 AND NOT coalesce({AUTHOR_LINE}, false)")),
    "attach_numeric_fragments": (_sequence(S.attach_numeric_fragments), _islands(NUMERIC)),
    "fill_dashes": (_sequence(S.fill_dashes), _DASHES),
    "split_accessed": (_sequence(S.split_accessed), _split(_ACCESSED)),
    "split_trailers": (_sequence(S.split_trailers), _split(_TRAILERS)),
    "split_link_rows": (_sequence(lambda x: S.split_each(x, D.split_links(F.col("text")))), _split(_LINKS)),
    "attach_parentheticals": (_sequence(S.attach_parentheticals), _BRACKETS),
    "fold_url_end": (_fold(O.join_on_url_end), _URL_END),
    "fold_numbered_join": (_fold(O.numbered_join), _NUMBERED),
    "fold_leading_ampersand": (_fold(O.attach_leading_ampersand), _islands(f"text LIKE '&%' AND {AUTHORS_ONLY.replace('text', 'before')}")),
    "fold_reattach_dois": (_fold(D.attach_split_dois), _REATTACHED),
    "fold_editor_merge": (_fold(O.editor_merge), None),
    "fold_author_append": (_fold(O.author_append), None),
    "fold_author_append_bare": (_fold(lambda x: O.author_append(x, paren=False)), None),
}
