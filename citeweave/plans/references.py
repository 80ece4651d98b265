"""Reference lists from documents: years in parentheses, numbered lists, bare years.

A document's lines stay one array from its text to its references: they are cut and
cleaned by array expressions, and one Arrow function reads a document's lines and returns
its references as rows. So a plan has one scan and no exchange, and documents of all kinds run in one pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.functions import doi as D
from citeweave.operators import lists as I
from citeweave.operators import sequence as S
from citeweave.operators.aggregates import LEAST, LEAST_TO_END
from citeweave.operators.lines import clean_line_array, clean_lines, look_back, physical_lines, section


@dataclass(frozen=True)
class ParseOptions:
    """layout: A and C have the year at the end, B and D after the authors; C and D full first names.

    Numbered lists are found by counting unless numbered is False; canonicalize_numbered moves
    their DOIs and mends their vowels as it is done for other lists. max_prefix_digits bounds the digits of numbers that strip_numbers
    takes away. The rounds bound the passes that merge editors and append to authors.
    """

    layout: str = "A"
    full_names: bool = False
    until_eof: bool = False
    keep_heading: bool = False
    stop_at_capitals: bool = False
    low_page: int = 50
    high_page: int = 400
    max_append: int = 25
    look_back: int = 0
    strip_numbers: bool = False
    max_prefix_digits: int | None = None
    numbered: bool = True
    canonicalize_numbered: bool = False
    numeric_fragments: bool = False
    initials_merge: bool = False
    editor_rounds: int = 3
    author_rounds: int = 10


def section_text(options: ParseOptions) -> Column:
    text = F.col("full_text")
    return look_back(text, options.look_back) if options.look_back else section(text, options.keep_heading, options.stop_at_capitals)


def section_lines(documents: DataFrame, options: ParseOptions) -> DataFrame:
    """Clean lines as rows, for the operators of sequence.py."""
    return clean_lines(physical_lines(documents, section_text(options)), options.until_eof, options.low_page, options.high_page)


def section_arrays(documents: DataFrame, options: ParseOptions) -> DataFrame:
    """doc_id and its clean lines."""
    return documents.select("doc_id", clean_line_array(section_text(options), options.until_eof, options.low_page, options.high_page).alias("lines"))


def parse_list(lines: list[str], kind: str | None, options: ParseOptions) -> list[str]:
    """The references in a document's clean lines; kind None: by the kind of list it has."""
    kind = kind or (I.list_kind(lines, LEAST_TO_END if options.until_eof else LEAST) if options.numbered else "paren_year")
    if kind == "paren_year":
        found = I.paren_year_list(lines, options.editor_rounds, options.author_rounds)
    elif kind == "bare_year":
        full = options.full_names or options.layout in "CD"
        found = I.bare_year_list(lines, options.layout in "BD", full, options.max_append, options.initials_merge, options.numeric_fragments, options.editor_rounds, options.author_rounds)
    else:
        found = I.numbered_list(lines, kind)
        if options.canonicalize_numbered:
            found = I.finished([D.moved(t) for t in found], False)
        return I.numbers_stripped(found, kind) if options.strip_numbers else found
    return I.finished(found, options.strip_numbers, options.max_prefix_digits)


def parsed(arrays: DataFrame, kind: str | None = None, options: ParseOptions = ParseOptions()) -> DataFrame:
    """(doc_id, lines) to rows of references (doc_id, line_no, text). Ids pass untouched."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [parse_list(x, kind, options) if x else [] for x in batch.column("lines").to_pylist()]
            sizes = [len(x) for x in lists]
            owner, place = np.repeat(np.arange(len(lists)), sizes), np.concatenate([np.zeros(0, np.int32), *(np.arange(1, n + 1, dtype=np.int32) for n in sizes)])
            texts = pa.array([t for x in lists for t in x], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(owner)), pa.array(place, pa.int32()), texts], ["doc_id", "line_no", "text"])

    kind_of_id = arrays.schema["doc_id"].dataType.simpleString()
    return arrays.select("doc_id", "lines").mapInArrow(run, f"doc_id {kind_of_id}, line_no int, text string")


def paren_year_references(lines: DataFrame, options: ParseOptions = ParseOptions()) -> DataFrame:
    """Clean lines, as rows, to references of a bibliography whose years are in parentheses."""
    return parsed(S.to_arrays(lines), "paren_year", options)


def numbered_references(lines: DataFrame, style: str, options: ParseOptions = ParseOptions()) -> DataFrame:
    """Clean lines, as rows, of documents with one numbering style to the list's items."""
    return parsed(S.to_arrays(lines), style, options)


def bare_year_references(lines: DataFrame, options: ParseOptions = ParseOptions()) -> DataFrame:
    """Clean lines, as rows, to references of a bibliography whose years are bare."""
    return parsed(S.to_arrays(lines), "bare_year", options)


def references(documents: DataFrame, options: ParseOptions = ParseOptions(), kind: str | None = None) -> DataFrame:
    """doc_id, line_no, text, doi_ids of every document (doc_id, full_text), each by the kind of list it has, or as one kind.

    Numbered lists are found by counting; those whose numbers mostly stand alone are read
    as bare-year lists instead. All others have their years in parentheses. Documents with a null or
    empty text give no rows. documents may be a stream.
    """
    return parsed(section_arrays(documents, options), kind, options).withColumn("doi_ids", D.extract_simple(F.col("text")))
