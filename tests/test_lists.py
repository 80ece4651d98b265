"""List forms of the line operators against their plans over rows, and one-pass plans over documents."""

import random

import pytest
from pyspark.sql import functions as F

from citeweave.functions import doi as D
from citeweave.functions import predicates as Q
from citeweave.functions import text as T
from citeweave.operators import aggregates as A
from citeweave.operators import folds as O
from citeweave.operators import lines as L
from citeweave.operators import lists as I
from citeweave.operators import sequence as S
from citeweave.plans.references import ParseOptions, bare_year_references, paren_year_references, references, section_arrays, section_lines

WORDS = [
    "Smith, A. B.", "Smith, A. B.,", "Title words here", "(2001). Text", "2001", "ends-", "one", "and &", "& Jones, C. (2001)", "x (1999)", "Prop. 2001/02:1", "SOU:1999:12", "A. (2005). T", "A. Ek (2005)", "https://x.org", "Brown, C.", "7 things 12",
    "y, 1998.", ", and B. C.", ", lower", "van der Ek, B., & Lee, C.", "Smith, John", "Smith, John A.", "C. 2001 x", "12-13.", "[accessed on 2001-02-03]. More text", "A 2001 [x]. Smith, B. (2002). T", "(c). d e", "[d] rest", "see doi: 10.1234/ab. x", "1999-2001", "2001-05-06 date", "a b c", "two words",
    "[1] item", "[2]", "(3) x", "4. y", "doi. org/10.1234/q", "(Eds.)", "Ek, D. (Eds.),", "¨ol", "w_",
]


def streams(seed, docs=80):
    rng = random.Random(seed)
    return {d: [rng.choice(WORDS) for _ in range(rng.randint(0, 12))] for d in range(docs)}


def rows(spark, data):
    return spark.createDataFrame([(d, i + 1, t) for d, x in data.items() for i, t in enumerate(x)], "doc_id int, line_no int, text string")


def result(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["doc_id"], r["line_no"])):
        out.setdefault(r["doc_id"], []).append(r["text"])
    return out


def on(test):
    return lambda x: I.attach(x, lambda t, before, after: test(t))


PAIRS = {
    "hyphen_join": (S.hyphen_join, I.hyphen_join),
    "attach_paren_or_year_start": (S.attach_paren_or_year_start, on(I._starts_paren_or_year)),
    "year_end_consume": (S.year_end_consume, lambda x: I.consume(x, I.ends_with_paren_year)),
    "attach_single_tokens": (S.attach_single_tokens, on(lambda t: I.single_token(t.strip(" ")))),
    "attach_initials_year": (S.attach_initials_year, lambda x: I.attach(x, lambda t, b, a: (I._initials_year(t) or I._initials_near_year(t)) and I.ends_comma_or_initial(b))),
    "ampersand_consume": (S.ampersand_consume, lambda x: I.consume(x, lambda t: t.rstrip(" ").endswith("&"))),
    "append_non_year": (S.append_non_year, on(lambda t: not I.has_paren_year(t) and not I.government(t))),
    "collapse_authors": (S.collapse_authors, I.collapse_authors),
    "collapse_authors_full": (lambda x: S.collapse_authors(x, True), lambda x: I.collapse_authors(x, True)),
    "attach_year_start": (S.attach_year_start, on(I.starts_with_year)),
    "bare_year_end_consume": (S.bare_year_end_consume, lambda x: I.consume(x, I.ends_with_year)),
    "append_non_year_bare": (S.append_non_year_bare, lambda x: I.attach(x, lambda t, b, a: not I.year_found(t) and not (I._STARTS[0].search(t) and not I.author_line(t, a)))),
    "attach_digits": (S.attach_digits, on(lambda t: I.has_digit(t) and not I.year_found(t))),
    "append_until_year": (lambda x: S.append_until_year(x, 3), lambda x: I.append_until_year(x, 3)),
    "attach_non_year": (S.attach_non_year, on(lambda t: not I.has_bare_year(t))),
    "merge_short": (S.merge_short, on(lambda t: I.short_fragment(t) and not I.government(t))),
    "attach_leading_links": (S.attach_leading_links, on(I.starts_with_link)),
    "attach_numeric_fragments": (S.attach_numeric_fragments, on(lambda t: I.numeric_fragment(t.strip(" ")))),
    "attach_initials_bare": (S.attach_initials_bare, lambda x: I.attach(x, lambda t, b, a: I._initials_bare(t) and I.ends_comma_or_initial(b))),
    "short_join": (S.short_join, lambda x: I.attach(x, lambda t, b, a: I.short_fragment(t) and not I.author_line(t, a))),
    "split_accessed": (S.split_accessed, lambda x: I.split_each(x, I.split_accessed)),
    "split_trailers": (S.split_trailers, lambda x: I.split_each(x, lambda t: I.split_trailer(t, 2))),
    "attach_parentheticals": (S.attach_parentheticals, I.attach_parentheticals),
}


@pytest.mark.parametrize("name", PAIRS)
def test_pairs(spark, name):
    plan, listed = PAIRS[name]
    data = streams(sum(map(ord, name)))
    assert result(plan(rows(spark, data))) == {d: y for d, x in data.items() if (y := listed(x))}


def paren_rows(x):
    """The chain of parenthesised years over rows."""
    x = S.attach_single_tokens(S.year_end_consume(S.attach_paren_or_year_start(S.hyphen_join(S.in_documents(x)))))
    x = S.ampersand_consume(S.attach_initials_year(x))
    x = S.fold(x, lambda t: O.author_append(O.editor_merge(O.attach_leading_ampersand(t))))
    x = S.split_trailers(S.append_non_year(x), 2)
    return x.withColumn("text", T.fix_diaeresis(D.to_end(D.to_end(F.col("text")))))


def bare_rows(x, layout, full):
    """The chain of bare years over rows."""
    x = S.collapse_authors(S.in_documents(x), full)
    if layout in "BD":
        x = S.bare_year_end_consume(S.attach_year_start(x))
        x = S.fold(x, lambda t: O.author_append(O.editor_merge(t, paren=False), paren=False))
        x = S.attach_digits(S.append_non_year_bare(x, full))
    else:
        x = S.append_until_year(x)
    x = S.ampersand_consume(S.attach_initials_bare(x))
    x = S.merge_short(S.attach_non_year(S.attach_numeric_fragments(x)))
    x = S.split_accessed(S.attach_leading_links(S.fold(x, O.join_on_url_end)))
    x = S.split_each(x, D.split_links(F.col("text")))
    x = S.split_trailers(x.withColumn("text", D.fix_broken(D.to_end(F.col("text")))), 0)
    return S.attach_parentheticals(S.short_join(x, full)).withColumn("text", T.fix_diaeresis(F.col("text")))


@pytest.mark.parametrize("layout", ["paren", "A", "B", "C", "D"])
def test_chains(spark, layout):
    """Whole pipelines: one pass over arrays is the chain of windows over rows."""
    data = rows(spark, streams(77, 150))
    if layout == "paren":
        want, got = paren_rows(data), paren_year_references(data)
    else:
        options = ParseOptions(layout=layout, initials_merge=True, numeric_fragments=True)
        want, got = bare_rows(data, layout, layout in "CD"), bare_year_references(data, options)
    assert result(got) == result(want)


def test_predicates_agree(spark):
    """Author lines and others, of each line before each other."""
    data = [(t, n) for t in WORDS for n in [*WORDS, None]]
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(data)], "i int, t string, n string")
    got = df.select("i", Q.is_author_line(F.col("t"), F.col("n")).alias("a"), Q.is_author_line(F.col("t"), F.col("n"), True).alias("f"), Q.is_government(F.col("t")).alias("g"), Q.year_found(F.col("t")).alias("y")).orderBy("i").collect()
    assert [(r["a"], r["f"], r["g"], r["y"]) for r in got] == [(I.author_line(t, n or ""), I.author_line(t, n or "", True), I.government(t), I.year_found(t)) for t, n in data]


def test_line_arrays(spark):
    """Cleaning as arrays is cleaning as rows."""
    rng = random.Random(4)
    junk = ["", "  ", "- -", "(cid:3)", "123", "401", "2003/04/05 12:30 Page 3 #4", "Appendix", "APPENDIX.", "Paper I–III", "a b​", "References"]
    docs = [(d, "Intro\nReferences\n" + "\n".join(rng.choice([*junk, *WORDS]) for _ in range(rng.randint(0, 9)))) for d in range(120)] + [(900, None), (901, ""), (902, "no heading here")]
    table = spark.createDataFrame(docs, "doc_id int, full_text string")
    for options in (ParseOptions(), ParseOptions(until_eof=True, low_page=100, high_page=500), ParseOptions(keep_heading=True)):
        arrays = {r["doc_id"]: r["lines"] for r in section_arrays(table, options).collect() if r["lines"]}
        assert arrays == result(section_lines(table, options))


def test_one_pass(spark):
    """No exchange, one Arrow pass, whatever kinds of lists there are."""
    docs = spark.createDataFrame([(1, "References\nSmith, A. (2001). T"), (2, "References\n" + "\n".join(f"[{i}] x" for i in range(20)))], "doc_id int, full_text string")
    plan = references(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("MapInArrow") == 1 and "ArrowEvalPython" not in plan and "Window" not in plan
    assert [r["n"] for r in references(docs).groupBy("doc_id").agg(F.count("*").alias("n")).orderBy("doc_id").collect()] == [1, 20]


def test_kinds(spark):
    data = {1: [f"[{i}] x" for i in range(15)], 2: [f"({i})" for i in range(15)], 3: [f"{i}. a" for i in range(10)], 4: [f"{i}. a" for i in range(9)], 5: ["x"]}
    assert {d: I.list_kind(x, A.LEAST) for d, x in data.items()} == {1: "bracket", 2: "bare_year", 3: "bare", 4: "paren_year", 5: "paren_year"}
    styles = {r["doc_id"]: r["style"] for r in A.numbered_style(rows(spark, data)).collect()}
    assert styles == {1: "bracket", 2: "paren", 3: "bare", 4: None, 5: None}
    assert [I.list_kind(data[3], A.LEAST_TO_END)] == ["paren_year"]


def test_options(spark):
    docs = spark.createDataFrame([(1, "Bibliography\n1234 Smith, A. (2001). T¨o\n[12] Ek, B. (2002). U")], "doc_id int, full_text string")
    text = lambda o: [r["text"] for r in references(docs, o).orderBy("line_no").collect()]
    assert text(ParseOptions()) == ["1234 Smith, A. (2001). Tö", "[12] Ek, B. (2002). U"]
    assert text(ParseOptions(strip_numbers=True)) == ["Smith, A. (2001). Tö", "Ek, B. (2002). U"]
    assert text(ParseOptions(strip_numbers=True, max_prefix_digits=2)) == ["1234 Smith, A. (2001). Tö", "Ek, B. (2002). U"]
    assert text(ParseOptions(keep_heading=True))[0].startswith("Bibliography")
    looked = spark.createDataFrame([(1, "One two\nthree\nReferences\nx (2001)\nNEXT PART HERE\ny (2002)")], "doc_id int, full_text string")
    assert looked.select(L.look_back(F.col("full_text"), 5).alias("t")).first()["t"].startswith("\nthree\nReferences")
    assert looked.select(L.section(F.col("full_text"), stop_at_capitals=True).alias("t")).first()["t"].strip() == "x (2001)"
