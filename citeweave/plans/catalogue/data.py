"""Tables of the registered queries, made from the driver's tables by SQL that Spark and the oracle both run.

The driver's tables hold no bibliographies, so lines are made from orders: a document is
the orders of three customers. One document in eight is a numbered list of each style,
the rest are a mixture of lines that every operator has something to do with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from citeweave.functions.patterns import STOP_TOKENS

#: Line templates; y is the order's year, k its key, n the line's number. Grouped by what they exercise.
TEMPLATES = [
    # references, authors, continuations
    "'Smith, A. B. (' || y || '). Title number ' || k || ' of a work. https://doi.org/10.1234/' || k",
    "'Brown, C., & '",
    "'Green, D. E.'",
    "'Gray, F. G.,'",
    "', and H. Hill'",
    "'H. Hill and others'",
    "'continued line of text ' || k",
    "'Journal of Things, 12, 3-4.'",
    "'White, F. Work in a bare year, ' || y",
    "'& Black, K. (' || y || ')'",
    "'Lonely'",
    "'short bit'",
    "'ends with a hyphen-'",
    "'ends with a sign_'",
    # years
    "'(' || y || '). Another title.'",
    "y || '. Starts with its year'",
    "'A. (' || y || '). Initial first.'",
    "'A. Ek (' || y || '). Initial near.'",
    "'B. ' || y || ' after an initial'",
    "'Gray, I. (' || y || ')'",
    "'Dated (' || y || ', May 3rd) inside'",
    "'Dated (3 May ' || y || ') inside'",
    "'Printed again (' || y || ' [1950]).'",
    "'Two years (' || y || '/1999) of it'",
    "'On ' || y || '-05-06 it began'",
    "'From 1990-' || y || ' it went on'",
    "'Not yet (in press), by all'",
    "'Of no date (n.d.)'",
    "'The number 12' || y || '34 is none'",
    # official documents, and what is none
    "'Prop. ' || y || '/99:123'",
    "'Proposition (' || y || '/99:1)'",
    "'SOU:' || y || ':12 report'",
    "'SFS ' || y || ':1234'",
    "'Ds (' || y || ':5)'",
    "'Prop ' || y || '/99:1'",
    "'SOU' || y || ':12'",
    # artefacts
    "'(cid:12)'",
    "'123'",
    "'49'",
    "'- -'",
    "'2003/04/05 12:30 Page 3 #4'",
    "'odd\u00a0sp\u200bace\u2013here  twice'",
    "'¨o and ¨a ¨u ¨O ¨A ¨U'",
    # DOIs and links
    "'doi: 10.5555/abc.' || k || ' and doi: 10.5555/abc.' || k",
    "'one 10.1234/ab' || k || ' in 10.1234/ab' || k || '7 is left'",
    "'broken doi. org/10.1234/' || k || ' here'",
    "'broken doi .org/10.1234/' || k",
    "'broken doi.org / 10.1234/' || k",
    "'broken doi.org10.1234/' || k || ' too'",
    "'split 1 0.1234/' || k || ' at its one'",
    "'glued https://doi.org/10.1234/5' || 'Next word'",
    "'https://example.org/' || k || ' tail words'",
    "'ends at https://'",
    "'org/' || k || ' starts as a link'",
    "'stray doi: and doi.org/ without one'",
    "'kept (with and), for & . And of it'",
    "'text [accessed on 2020-01-02]. Black, G. More text'",
    # trailers, brackets, editors, dashes, fragments
    "'Old work, 1998 [reprint]. Stone, L. M. (' || y || '). Newer work'",
    "'Old work [reprint]. Stone, L. M. Newer work'",
    "'Old work, 1998 [reprint]. lower case (' || y || ')'",
    "'(c). rest of it'",
    "'[note] rest of it'",
    "'Miller, H. (Eds.)'",
    "'(red.) Collected works'",
    "'---, (' || y || '). Same author again ' || k",
    "'---, no year'",
    "'12-13.'",
    "'pp. 12\u201313, vol. 2.'",
    "'[' || k || '] Numbered item.'",
    "'(7) numbered so'",
    "'8. numbered so'",
    "'MANY CAPITALS HERE'",
]
#: One line in so many is a stop token.
STOPS = 97

_MIXED = " ".join(f"WHEN {i} THEN {t}" for i, t in enumerate(TEMPLATES))
_STOP = " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate([*STOP_TOKENS, "APPENDIX", "Appendix."]))
_NUMBERED = {0: "'[' || n || ']'", 1: "'(' || n || ')'", 2: "n || '.'"}
LINES_SQL = f"""
SELECT doc_id, line_no, CASE
    WHEN doc_id % 8 IN (0, 1, 2) THEN CASE
        WHEN line_no % 5 = 4 THEN 'goes on with words ' || k
        WHEN line_no % 7 = 6 THEN 'Prop. ' || y || '/99:12'
        ELSE CASE doc_id % 8 {' '.join(f"WHEN {i} THEN {t}" for i, t in _NUMBERED.items())} END || CASE WHEN line_no % 6 = 3 OR doc_id % 24 = 0 THEN '' ELSE ' Item ' || k || ', ' || y END END
    WHEN key % {STOPS} = 5 THEN CASE key % {len(STOP_TOKENS) + 2} {_STOP} END
    ELSE CASE (key * 7 + doc_id * 3) % {len(TEMPLATES)} {_MIXED} END END AS text
FROM (SELECT *, CAST(line_no AS string) AS n FROM (SELECT CAST(floor(o_custkey / 3.0) AS bigint) AS doc_id, CAST(row_number() OVER (PARTITION BY CAST(floor(o_custkey / 3.0) AS bigint) ORDER BY o_orderkey) AS int) AS line_no,
    o_orderkey AS key, CAST(year(o_orderdate) AS string) AS y, CAST(o_orderkey AS string) AS k FROM orders) AS numbered) AS named
"""
#: Head of the oracle's queries over lines.
WITH = f"WITH lines AS ({LINES_SQL}) "

#: Patterns of the oracle, written for what the lines hold: years, years in parentheses, official documents, authors.
YEARS = "(?:17[5-9][0-9]|1[89][0-9][0-9]|20[0-2][0-9]|2030)"
PAREN = rf"\((?:{YEARS}[A-Za-z]?|{YEARS}, May 3rd|3 May {YEARS}|{YEARS} \[{YEARS}\]|{YEARS}/{YEARS}|in press|n\.d\.)\)"
GOVERNMENT = rf"^(?:Prop\.|Proposition) \(?{YEARS}/[0-9]{{2}}:[0-9]{{1,3}}|^SOU:{YEARS}:[0-9]|^SFS {YEARS}:[0-9]|^Ds \({YEARS}:[0-9]"
AUTHOR = r"^(?:Smith, A\. B\.|Brown, C\.|Green, D\. E\.|Gray, [FI]\.(?: G\.)?|White, F\.|Miller, H\.)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of bibliographies: doc_id, line_no, text."""
    return spark.sql(LINES_SQL.replace("FROM orders", "FROM {orders}"), orders=table(spark, sf_dir, "orders"))


#: Rows of a journal table: missing and blank values, two dates in a group, organisations and people.
JOURNAL_SQL = """
SELECT o_orderkey AS row_no, 'J' || CAST(o_custkey % 20 AS string) AS `JOURNAL`, CAST(year(o_orderdate) AS string) AS `YEAR`, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderkey % 4 AS string) END AS `ISSUE`, CAST(NULL AS string) AS `VOL`,
    CASE WHEN o_orderkey % 3 = 0 THEN 'nan' WHEN o_orderkey % 7 = 0 THEN ' ' ELSE '10.1/' || CAST(o_orderkey AS string) END AS `DOI`, '1234-567' || CASE WHEN o_orderkey % 2 = 0 THEN 'x' ELSE '8' END AS `ISSN`,
    CASE WHEN o_custkey % 2 = 0 THEN '2001-02-03' WHEN o_orderkey % 11 = 0 THEN NULL ELSE '2001-02-0' || CAST(1 + o_orderkey % 9 AS string) END AS `PUBLICATION DATE`,
    'On <A> & B ' || CAST(o_orderkey AS string) AS `TITLE`, CASE WHEN o_orderkey % 4 = 1 THEN 'sv' END AS `LANG`, CASE WHEN o_orderkey % 3 = 1 THEN 'What it says' END AS `ABSTRACT`, CAST(NULL AS string) AS `ABSTRACT LANG`,
    CASE WHEN o_orderkey % 2 = 1 THEN CAST(o_orderkey % 90 AS string) END AS `FIRST PAGE`, CASE WHEN o_orderkey % 4 = 1 THEN '99' END AS `LAST PAGE`, 'https://example.org/' || CAST(o_orderkey AS string) AS `LINK TO ARTICLE`, CASE WHEN o_orderkey % 5 = 2 THEN 'https://example.org/pdf' END AS `LINK TO PDF`,
    CASE WHEN o_orderkey % 4 = 0 THEN 'Org ' || CAST(o_custkey AS string) END AS `AU1 ORGANIZATION`, 'Ann' AS `AU1 FIRST NAME`, CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE 'Lee' END AS `AU1 LAST NAME`, CASE WHEN o_orderkey % 2 = 1 THEN 'Dept, HOME university' ELSE 'Elsewhere' END AS `AU1 AFFILIATION`, '0000-1' AS `AU1 ORCID`,
    'Bo' AS `AU2 FIRST NAME`, 'Ek' AS `AU2 LAST NAME`, CASE WHEN o_orderkey % 9 = 0 THEN 'Last' END AS `AU10 FIRST NAME`, 'Slot' AS `AU10 LAST NAME`
FROM orders"""
JOURNAL_WITH = "WITH j AS (" + JOURNAL_SQL.replace("`", '"') + ")"


def journal_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(JOURNAL_SQL.replace("FROM orders", "FROM {orders}"), orders=table(spark, sf_dir, "orders"))


def flag(condition: str) -> str:
    """SQL of a predicate: doc_id, line_no, flag."""
    return f"{WITH}SELECT doc_id, line_no, coalesce({condition}, false) AS flag FROM lines"


def value(expression: str) -> str:
    """SQL of a function: doc_id, line_no, value."""
    return f"{WITH}SELECT doc_id, line_no, {expression} AS value FROM lines"


def holds(pattern: str, column: str = "text") -> str:
    return f"regexp_matches({column}, '{pattern}')"
