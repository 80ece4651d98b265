import re

import pytest
from pyspark.sql import functions as F

from citeweave.functions import doi as D
from citeweave.functions import patterns as P
from citeweave.functions import predicates as Q
from citeweave.functions import text as T
from citeweave.operators.aggregates import merge_spans


def one(spark, column, *values):
    names = [chr(97 + i) for i in range(len(values))]
    return spark.createDataFrame([tuple(values)], ", ".join(f"{n} string" for n in names)).select(column.alias("x")).first()["x"]


def check(spark, function, cases):
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string").select("i", function(F.col("t")).alias("x")).collect()
    got = {r["i"]: r["x"] for r in rows}
    assert [(t, got[i]) for i, (t, _) in enumerate(cases)] == [(t, w) for t, w in cases]


PREDICATES = [
    (Q.is_government, [("Prop. 2001/02:123", True), ("SOU (1999:12)", True), ("sfs 2000:1234", True), ("SOU:1999:12", True), ("SOU 1999:1234", True), ("Prop.2001/02:1234", True), ("Proposition 2001/02:1", True), ("Prop 2001/02:1", False), ("SOU1999:12", False), ("Ds 1899:5", False), ("Ds 2031:5", False), ("Ds 2010:5 text", True), ("see Prop. 2001/02:1", False), ("Prop. 1850/51:1", False), (None, False), ("", False)]),
    (Q.is_ui_timestamp, [("2003/04/05 12:30 Page 3 #4", True), ("2003/04/05 Page 3 #4", False), (None, False)]),
    (Q.is_cid, [(" (CID: 12) ", True), ("x (cid:1)", False)]),
    (Q.is_hyphen_only, [("- – —", True), ("-a", False), ("", False)]),
    (Q.is_page_number, [("49", False), ("50", True), (" 400 ", True), ("401", False), ("12a", False), ("99999999999", False)]),
    (Q.starts_with_initials_and_year, [("A. B. (2001). T", True), ("AB (2001)", False), ("A. Smith (2001)", False)]),
    (Q.starts_with_initials_near_year, [("A. Smith, B., & Doe (2001a)", True), ("A. " + "x" * 130 + "(2001)", False)]),
    (Q.ends_with_comma_or_initial, [("Smith, A.", True), ("Smith,", True), ("Smith", False)]),
    (Q.has_paren_year, [("(2001)", True), ("(2001a)", True), ("(in press)", True), ("(1 May 2001)", True), ("(2001, May 3)", True), ("(1749)", False), ("(2031)", False), ("(1999 [1950])", True), ("(n.d.)", True), ("2001", False)]),
    (Q.year_found, [("x 2001.", True), ("12001", False), ("2001-2003", False), ("2001-05-06", True), ("no", False)]),
    (Q.line_ends_with_year, [("Title, 2001.", True), ("(1999)", True), ("1999-2001", False), ("2001 x", False)]),
    (Q.line_starts_with_year, [("2001. Title", True), ("(2001) T", True), ("2001-2002", False)]),
    (Q.is_single_token, [("word", True), ("two words", False), ("", False)]),
    (Q.is_stop_token, [("Appendix", True), ("APPENDIX.", True), ("Paper I-III", True), ("Articles 1-6", True), ("Appendixes", False)]),
    (Q.starts_with_link, [("https://a", True), ("doi:10", True), ("10.1234/x", True), ("see https://a", False)]),
    (Q.is_editor_token, [("Eds.", True), ("red", True), ("Editors", False)]),
]


def test_pattern_parts():
    """Ranges of numbers hold just their numbers; stop tokens are all there."""
    for low, high in (("1750", "2030"), ("1900", "2030"), ("01", "12"), ("01", "31"), ("0", "9"), ("17", "17"), ("099", "201")):
        got = re.compile(P.numbers(low, high))
        assert [n for n in range(10 ** len(low)) if got.fullmatch(f"{n:0{len(low)}}")] == list(range(int(low), int(high) + 1))
    assert len(set(P.STOP_TOKENS)) == 39 and {"ARTICLES I-VI", "Bilaga 1", "PART II"} <= set(P.stop_tokens())


@pytest.mark.parametrize("predicate, cases", PREDICATES, ids=lambda x: getattr(x, "__name__", ""))
def test_predicates(spark, predicate, cases):
    check(spark, predicate, cases)


def test_author_lines(spark):
    line = lambda t, n: one(spark, Q.is_author_line(F.col("a"), F.col("b")), t, n)
    assert line("Smith, A. B., & Jones, C.", "Title")
    assert not line("Smith, A. B. 2001", "Title")
    assert not line("A title of something", "x")
    assert line("Smith, A.,", "B. Jones")
    assert line(", and so", "A. B.") and not line(", and so", "lower")


FUNCTIONS = [
    (T.normalize_line, [("a  b​c–d  e ", "a bc-d e"), (None, None), ("", "")]),
    (T.fix_diaeresis, [("f¨or ¨Ara", "för Ära")]),
    (T.strip_list_number, [("12. Text", "Text"), ("[3] Text", "Text"), ("4 Text", "Text"), ("2001Text", "2001Text")]),
    (T.author_prefix, [("Smith, A. (2001). T", "Smith, A."), ("Smith, A., 2001", "Smith, A."), ("none", None)]),
    (T.safe_file_name, [("10.1/a b/c", "a_b_c")]),
    (T.clean, [(" x ", "x"), ("NaN", None), (" ", None), (None, None)]),
    (T.strip_html, [("<b>a</b> c", "a c"), ("a < b", "a ")]),
    (T.orcid_id, [("orcid.org=0000-1", "0000-1"), ("nothing", None)]),
    (T.output_name, [("https://x.org/a/b.pdf?q=1", "b.txt"), ("/tmp/c.pdf", "c.txt")]),
    (D.fix_broken, [("doi. org/10.1", "doi.org/10.1"), ("doi.org10.1/x", "doi.org/10.1/x")]),
    (D.simple_to_end, [("T. doi: 10.1234/ab. More", "T. More. https://doi.org/10.1234/ab"), ("none", "none")]),
]


@pytest.mark.parametrize("function, cases", FUNCTIONS, ids=lambda x: getattr(x, "__name__", ""))
def test_functions(spark, function, cases):
    check(spark, function, cases)


def test_structs(spark):
    assert tuple(one(spark, T.date_parts(F.col("a")), "2001-02-03")) == ("2001", "02", "03")
    assert one(spark, T.date_parts(F.col("a")), "2001-02") is None
    assert tuple(one(spark, T.page_hints(F.col("a")), "100")) == (50, 100)
    assert tuple(one(spark, T.page_hints(F.col("a")), "5")) == (30, 30)
    assert one(spark, T.page_hints(F.col("a")), "x p.") is None
    assert one(spark, T.paragraphs(F.col("a")), "<p>a&nbsp;</p><p> </p><p>b <i>c</i></p>")[-1] == "b <i>c</i>"
    assert one(spark, D.split_links(F.col("a")), "A https://x.org/1 B doi:10.1/2 C") == ["A https://x.org/1", "B doi:10.1/2", "C"]
    spans = spark.sql("select array(struct(1 as start, 3 as end), struct(8 as start, 9 as end), struct(3 as start, 5 as end)) as s").select(merge_spans(F.col("s")).alias("m")).first()["m"]
    assert [tuple(x) for x in spans] == [(1, 5), (8, 9)]


def test_exact_dois():
    assert D.extract_ids("x doi:10.1234/q and https://doi.org/10.1234/abc- 12.") == ["10.1234/abc-12", "10.1234/q"]
    assert D.extract_ids("https://doi.org/10.1234/abc. Smith, A.") == ["10.1234/abc.Smith"]  # two tokens of a broken DOI; names are no exception
    assert D.extract_ids(None) == [] and D.extract_ids("10.1234/ab 10.1234/abc") == ["10.1234/abc"]
    moved = D.move_to_end("Smith (2001). T. doi: 10.1234/abcd. 5678")
    assert moved == "Smith (2001). T. https://doi.org/10.1234/abcd.5678"
    assert D.move_to_end(moved) == moved
    assert D.move_to_end("no doi") == "no doi" and D.move_to_end(None) is None
