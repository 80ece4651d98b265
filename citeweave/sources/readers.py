"""Text, PDF, CSV, XML and HTML sources as DataFrames."""

from __future__ import annotations

import http.client
import io
import subprocess
import urllib.request
from collections.abc import Callable, Iterator, Sequence
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from citeweave.operators.aggregates import JOURNAL_KEYS, conform
from citeweave.operators.records import ARTICLE_COLUMNS, AUTHOR_COLUMNS, MODS_SCHEMA


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """doc_id (the path), source and full_text of whole text files; bytes that are no UTF-8 become U+FFFD."""
    name = F.col("_metadata.file_path")
    return spark.read.text(path, wholetext=True).select(name.alias("doc_id"), name.alias("source"), F.col("value").alias("full_text"))


def read_journal_csv(spark: SparkSession, path: str) -> DataFrame:
    """Journal rows: ';' separated, quoted, all strings; missing columns are null and row_no keeps the input order."""
    rows = spark.read.csv(path, sep=";", header=True, quote='"', escape='"', multiLine=True, inferSchema=False)
    return conform(rows, [*JOURNAL_KEYS, "VOL", "ABBRIVIATION", "ISSN", "ISSUE TITLE", *[c for c in ARTICLE_COLUMNS if c != "YEAR"], *AUTHOR_COLUMNS])


def read_mods(spark: SparkSession, path: str) -> DataFrame:
    """MODS records; names come without their prefix."""
    return spark.read.format("xml").options(rowTag="mods", ignoreNamespace=True).schema(MODS_SCHEMA).load(path)


def read_pdfs(spark: SparkSession, path: str, backends: Sequence[str] = ("pymupdf", "pdftotext", "pdfminer")) -> DataFrame:
    """doc_id, source and full_text of PDF files: of the first backend that is installed and finds text."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.col("path").alias("doc_id"), F.col("path").alias("source"), extract_pdf(F.col("content"), backends).alias("full_text"))


def _pymupdf(data: bytes) -> str:
    import fitz

    with fitz.open(stream=data, filetype="pdf") as document:
        return "\n".join(page.get_text() for page in document)


def _pdfminer(data: bytes) -> str:
    from pdfminer.high_level import extract_text

    return extract_text(io.BytesIO(data))


def _pdftotext(data: bytes) -> str:
    """The command of that name, with the page's layout; it reads standard input, so nothing is written."""
    return subprocess.run(["pdftotext", "-layout", "-", "-"], input=data, capture_output=True, check=True, timeout=PDF_SECONDS).stdout.decode("utf-8", "replace")


#: Seconds that a command may take for a file.
PDF_SECONDS = 300
#: PDF text extractors by name; more may be added. A library or command is looked for where it runs.
PDF_BACKENDS: dict[str, Callable[[bytes], str]] = {"pymupdf": _pymupdf, "pdftotext": _pdftotext, "pdfminer": _pdfminer}


def fetch(urls: DataFrame, column: str = "url", kind: str | None = None, seconds: float = 10, most_bytes: int = 100 << 20) -> DataFrame:
    """The rows of urls with content (bytes) and error of what each URL answers.

    kind is a content type that the answer must have ("application/pdf"); an answer of another kind, one over most_bytes,
    a refusal or a time-out gives null content and an error, never a failure. Rows run in parallel, one request at
    a time per task; a lost task asks again.
    """
    known = [c for c in urls.columns if c not in ("content", "error")]

    def answer(url: str | None) -> tuple[bytes | None, str | None]:
        if not url or not url.lower().startswith(("http://", "https://")):
            return None, "no http address"
        try:
            with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": "Mozilla/5.0"}), timeout=seconds) as reply:
                found = reply.headers.get_content_type()
                if kind and found != kind:
                    return None, f"content is {found}"
                body = reply.read(most_bytes + 1)
            return (body, None) if len(body) <= most_bytes else (None, "content is too long")
        except (OSError, ValueError, http.client.HTTPException) as e:
            return None, f"{type(e).__name__}: {e}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # one body at a time
                row = batch.slice(i, 1)
                content, error = answer(row.column(column)[0].as_py())
                yield pa.RecordBatch.from_arrays([*row.columns, pa.array([content], pa.binary()), pa.array([error], pa.string())], [*known, "content", "error"])

    return urls.select(*known).mapInArrow(run, StructType([*(urls.schema[c] for c in known), StructField("content", BinaryType()), StructField("error", StringType())]))


def fetch_pdfs(urls: DataFrame, column: str = "url", backends: Sequence[str] = ("pymupdf", "pdftotext", "pdfminer"), seconds: float = 60) -> DataFrame:
    """doc_id (the URL), source, full_text and error of PDF files on the web."""
    got = fetch(urls.select(F.col(column).alias("url")), "url", "application/pdf", seconds)
    return got.select(F.col("url").alias("doc_id"), F.col("url").alias("source"), extract_pdf(F.col("content"), backends).alias("full_text"), "error")


def fetch_pages(urls: DataFrame, column: str = "url", seconds: float = 10) -> DataFrame:
    """url, html and error of web pages; bytes that are no UTF-8 become U+FFFD."""
    got = fetch(urls.select(F.col(column).alias("url")), "url", None, seconds)
    return got.select("url", _decoded(F.col("content")).alias("html"), "error")


def _decoded(content: Column) -> Column:
    @F.pandas_udf("string")
    def run(data: pd.Series) -> pd.Series:
        return data.map(lambda raw: bytes(raw).decode("utf-8", "replace"), na_action="ignore")

    return run(content)


def extract_pdf(content: Column, backends: Sequence[str]) -> Column:
    """Text by a cascade of backends, null if none is installed or finds any."""
    chosen = [(b, PDF_BACKENDS[b]) for b in backends]

    @F.pandas_udf("string")
    def run(data: pd.Series) -> pd.Series:
        def one(raw: bytes | None) -> str | None:
            for _, backend in chosen if raw is not None else ():
                try:
                    text = backend(bytes(raw))
                except Exception:  # noqa: BLE001  a broken file or a missing library: the next backend
                    continue
                if text.strip():
                    return text
            return None

        return data.map(one)

    return run(content)


class _References(HTMLParser):
    """Texts of p and h6: in a div of class references; else between the first h2 or h4 that says 'references' and the next heading."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.inside: list[str] = []
        self.after: list[str] = []
        self._depth = 0  # of the references div
        self._state = 0  # 0 before the heading, 1 in a heading, 2 after the right one, 3 done
        self._heading: list[str] = []
        self._text: list[str] | None = None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "div":
            if self._depth:
                self._depth += 1
            elif "references" in (dict(attrs).get("class") or "").split():
                self._depth = 1
        if tag in ("h2", "h4"):
            if self._state == 2:
                self._state = 3
            elif self._state == 0:
                self._state, self._heading = 1, []
        if tag in ("p", "h6"):
            self._close()
            self._text = []

    def handle_endtag(self, tag: str) -> None:
        if tag in ("p", "h6"):
            self._close()
        if tag == "div" and self._depth:
            self._close()
            self._depth -= 1
        if tag in ("h2", "h4") and self._state == 1:
            self._state = 2 if "references" in "".join(self._heading).lower() else 0

    def handle_data(self, data: str) -> None:
        if self._state == 1:
            self._heading.append(data)
        if self._text is not None:
            self._text.append(data)

    def _close(self) -> None:
        if self._text is not None and (text := " ".join("".join(self._text).split())):
            (self.inside if self._depth else self.after if self._state == 2 else []).append(text)
        self._text = None


def html_references(html: str | None) -> list[str]:
    parser = _References()
    parser.feed(html or "")
    parser.close()
    parser._close()
    return parser.inside or parser.after


def page_references(html: Column) -> Column:
    """Array of a page's references; malformed markup is read as far as it goes, null and plain pages give none."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(html_references)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "array<string>")(html)


def page_paragraphs(html: Column) -> Column:
    """Native form for well-formed pages: their <p> contents as plain lines."""
    found = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit("(?is)<p(?:\\s[^>]*)?>(.*?)</p>"), F.lit(1))
    plain = F.transform(found, lambda p: F.trim(F.regexp_replace(F.regexp_replace(p, "<[^>]*>", ""), r"\s+", " ")))
    return F.filter(plain, lambda p: p != "")


def references_or(*sources: Column) -> Column:
    """The first of several arrays of references that holds any; else an empty one."""
    return F.coalesce(*[F.when(F.size(s) > 0, s) for s in sources], F.array().cast("array<string>"))
