"""Documents: sections, clean lines, kinds of lists, pages, and whole pipelines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.functions import doi as D
from citeweave.functions import text as T
from citeweave.operators import aggregates as A
from citeweave.operators import lines as L
from citeweave.operators import sequence as S
from citeweave.plans.catalogue.data import WITH, YEARS, lines, table
from citeweave.plans.catalogue.predicates import ARTEFACT, PAGE, STOP
from citeweave.plans.catalogue.scalars import DOIS
from citeweave.plans.references import ParseOptions, references
from citeweave.sources.readers import page_paragraphs, page_references, references_or

_HEAD = "Intro text\nReferences\n"


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    """A heading and a document's lines."""
    return S.to_arrays(lines(spark, sf)).select("doc_id", F.concat(F.lit(_HEAD), F.array_join("lines", "\n")).alias("full_text"))


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """DOIs and the first year in parentheses of each document's normalised lines."""
    rows = lines(spark, sf).select("doc_id", "line_no", T.normalize_line(F.col("text")).alias("text"))
    year = F.nullif(F.regexp_extract(F.col("text"), rf"\(({YEARS})[A-Za-z]?\)", 1), F.lit(""))
    found = rows.select("doc_id", "line_no", D.extract_simple(F.col("text")).alias("ids"), year.alias("year"))
    order = F.when(F.col("year").isNotNull(), F.col("line_no"))
    return found.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.sum(F.size("ids")).alias("n_dois"), F.min_by("year", order).alias("first_year"))


def _clean(spark: SparkSession, sf: str) -> DataFrame:
    return L.clean_lines(L.physical_lines(_documents(spark, sf), L.section(F.col("full_text"))))


def _audit(spark: SparkSession, sf: str) -> DataFrame:
    return L.line_audit(L.physical_lines(_documents(spark, sf), L.section(F.col("full_text")))).select("doc_id", "line_no", "reason")


def _real_lines(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("full_text"))
    return L.physical_lines(docs).select("doc_id", "line_no", T.normalize_line(F.col("text")).alias("text"))


def _linked(spark: SparkSession, sf: str) -> DataFrame:
    """References linked to the records of the DOIs they cite."""
    cited = lines(spark, sf).select("doc_id", "line_no", F.explode(D.extract_simple(F.col("text"))).alias("doi"))
    known = table(spark, sf, "orders").select(F.concat(F.lit("10.1234/"), F.col("o_orderkey").cast("string")).alias("doi"), "o_orderpriority")
    return cited.join(known, "doi").select("doc_id", "line_no", "doi", "o_orderpriority")


_HTML_SQL = """SELECT o_orderkey, CASE o_orderkey % 5
    WHEN 0 THEN '<h2>x</h2><div class="x references"><h6>Title</h6><p>Ref A ' || CAST(o_orderkey AS string) || '</p><div><p>Ref <b>B</b> &amp; C</p></div></div><p>not this</p>'
    WHEN 1 THEN '<p>no</p><h2>References</h2><p>One ' || CAST(o_orderkey AS string) || '</p><h6>Two</h6><h4>Next</h4><p>no</p>'
    WHEN 2 THEN '<h2>Other</h2><p>no</p>'
    WHEN 3 THEN '<h4>All references here</h4><p>open ' || CAST(o_orderkey AS string) || '<p>and more</div>'
    END AS html FROM orders"""


def _page_references(spark: SparkSession, sf: str) -> DataFrame:
    """References of pages, else of another source."""
    pages = spark.sql(_HTML_SQL.replace("FROM orders", "FROM {orders}"), orders=table(spark, sf, "orders"))
    own = page_references(F.col("html"))
    other = F.when(F.col("o_orderkey") % 2 == 0, F.array(F.concat(F.lit("file "), F.col("o_orderkey").cast("string"))))
    return pages.select("o_orderkey", own.alias("own"), other.alias("other")).select("o_orderkey", F.array_join(references_or(F.col("own"), F.col("other")), "|").alias("refs"))


def _parsed(kind: str | None, **options: object):  # noqa: ANN202
    return lambda spark, sf: references(_documents(spark, sf), ParseOptions(**options), kind).drop("doi_ids")


_DOCS = WITH + f", docs AS (SELECT doc_id, 'Intro text' || chr(10) || 'References' || chr(10) || string_agg(text, chr(10) ORDER BY line_no) AS full_text FROM lines GROUP BY doc_id) "
#: Normalised lines, the first stop token of each document, and why a line is left out.
_NORMAL = f"""{WITH}, normal AS (SELECT doc_id, line_no, trim(regexp_replace(replace(replace(replace(text, '\u00a0', ' '), '\u2013', '-'), '\u200b', ''), '\\s{{2,}}', ' ', 'g')) AS text FROM lines),
stops AS (SELECT doc_id, min(line_no) AS stop FROM normal WHERE {STOP} GROUP BY doc_id), cut AS (SELECT normal.*, coalesce(stop, 1000000) AS stop FROM normal LEFT JOIN stops USING (doc_id))"""
_REASON = f"""CASE WHEN line_no = stop THEN 'stop token' WHEN line_no > stop THEN 'after a stop token' WHEN regexp_matches(text, '^[-\\s]+$') THEN 'hyphens only' WHEN regexp_matches(text, '^\\(cid:[0-9]+\\)$') THEN 'character id'
    WHEN text LIKE '____/__/__ __:__ Page _ #_' THEN 'time stamp' WHEN {PAGE} THEN 'page number' END"""
_CAPITALS = f"""{WITH}, n AS (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n_lines FROM lines), f AS (SELECT *, min(CASE WHEN regexp_matches(text, '^[A-Z][A-Z -]{{5,}}$') AND line_no < n_lines THEN line_no END) OVER (PARTITION BY doc_id) AS first_line FROM n)
SELECT doc_id, chr(10) || coalesce(string_agg(CASE WHEN first_line IS NULL THEN text || CASE WHEN line_no < n_lines THEN chr(10) ELSE '' END WHEN line_no < first_line THEN text || chr(10) END, '' ORDER BY line_no), '') AS text FROM f GROUP BY doc_id"""
_STYLES = f"""{WITH}, c AS (SELECT doc_id, count(*) FILTER (regexp_matches(text, '^\\s*\\[[0-9]{{1,3}}\\]')) AS n_bracket, count(*) FILTER (regexp_matches(text, '^\\s*\\([0-9]{{1,3}}\\)')) AS n_paren,
    count(*) FILTER (regexp_matches(text, '^\\s*[0-9]{{1,3}}\\.([^0-9]|$)')) AS n_bare FROM lines GROUP BY doc_id)
SELECT *, CASE WHEN n_bracket >= 15 THEN 'bracket' WHEN n_paren >= 15 THEN 'paren' WHEN n_bare >= 10 THEN 'bare' END AS style FROM c"""

#: name: (query, oracle)
ENTRIES = {
    "doi_and_year": (
        flagship,
        f"{WITH}, x AS (SELECT doc_id, line_no, len({DOIS}) AS n, nullif(regexp_extract(text, '\\(({YEARS})[A-Za-z]?\\)', 1), '') AS y FROM lines) SELECT doc_id, count(*) AS n_lines, CAST(sum(n) AS bigint) AS n_dois, arg_min(y, line_no) FILTER (y IS NOT NULL) AS first_year FROM x GROUP BY doc_id",
    ),
    "section_extract": (lambda s, sf: _documents(s, sf).select("doc_id", L.section(F.col("full_text")).alias("text")), _DOCS + "SELECT doc_id, substr(full_text, length('Intro text') + length('References') + 2) AS text FROM docs"),
    "section_look_back": (lambda s, sf: _documents(s, sf).select("doc_id", L.look_back(F.col("full_text"), 5).alias("text")), _DOCS + "SELECT doc_id, 'o text' || substr(full_text, length('Intro text') + 1) AS text FROM docs"),
    "section_to_capitals": (lambda s, sf: _documents(s, sf).select("doc_id", L.section(F.col("full_text"), stop_at_capitals=True).alias("text")), _CAPITALS),
    "stop_token_cut": (lambda s, sf: A.stop_cut(lines(s, sf)), f"{WITH}, s AS (SELECT doc_id, min(line_no) AS stop FROM lines WHERE {STOP} GROUP BY doc_id) SELECT doc_id, line_no, text FROM lines LEFT JOIN s USING (doc_id) WHERE stop IS NULL OR line_no < stop"),
    "clean_lines": (_clean, f"{_NORMAL} SELECT doc_id, CAST(line_no + 1 AS int) AS line_no, text FROM cut WHERE line_no < stop AND NOT {ARTEFACT}"),
    "line_audit": (_audit, f"{_NORMAL}, r AS (SELECT doc_id, CAST(line_no + 1 AS int) AS line_no, {_REASON} AS reason FROM cut) SELECT * FROM r WHERE reason IS NOT NULL UNION ALL SELECT DISTINCT doc_id, 1, 'blank' FROM lines"),
    "numbered_style": (lambda s, sf: A.numbered_style(lines(s, sf)), _STYLES),
    "standalone_number_share": (
        lambda s, sf: A.standalone_number_share(lines(s, sf)),
        f"{WITH}SELECT doc_id, count(*) FILTER (regexp_matches(text, '^\\s*(\\[[0-9]{{1,3}}\\]|\\([0-9]{{1,3}}\\)|[0-9]{{1,3}}\\.?)\\s*$')) / CAST(count(*) AS double) AS share FROM lines GROUP BY doc_id",
    ),
    "documents_lines": (
        _real_lines,
        r"WITH p AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents) SELECT doc_id, CAST(line_no AS int) AS line_no, trim(regexp_replace(text, '\s{2,}', ' ', 'g')) AS text FROM p",
    ),
    "page_paragraphs": (
        lambda s, sf: table(s, sf, "pages").select("page_id", F.array_join(page_paragraphs(F.col("html")), "|").alias("paragraphs")),
        r"SELECT page_id, coalesce(array_to_string(list_filter(list_transform(regexp_extract_all(html, '(?is)<p(?:\s[^>]*)?>(.*?)</p>', 1), lambda x: trim(regexp_replace(regexp_replace(x, '<[^>]*>', '', 'g'), '\s+', ' ', 'g'))), lambda x: x <> ''), '|'), '') AS paragraphs FROM pages",
    ),
    "page_references": (
        _page_references,
        "SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'Title|Ref A ' || o_orderkey || '|Ref B & C' WHEN 1 THEN 'One ' || o_orderkey || '|Two' WHEN 3 THEN 'open ' || o_orderkey || '|and more' ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'file ' || o_orderkey ELSE '' END END AS refs FROM orders",
    ),
    "cited_records": (_linked, f"{WITH}, c AS (SELECT doc_id, line_no, unnest({DOIS}) AS doi FROM lines) SELECT doc_id, line_no, doi, o_orderpriority FROM c JOIN orders ON doi = '10.1234/' || o_orderkey"),
    "apa_pipeline": (_parsed("paren_year"), None),
    "nonapa_pipeline_a": (_parsed("bare_year"), None),
    "nonapa_pipeline_b": (_parsed("bare_year", layout="B"), None),
    "nonapa_pipeline_c": (_parsed("bare_year", layout="C", numeric_fragments=True), None),
    "nonapa_pipeline_d": (_parsed("bare_year", layout="D", initials_merge=True), None),
    "reference_lists": (lambda s, sf: references(_documents(s, sf), ParseOptions(strip_numbers=True)), None),
}
