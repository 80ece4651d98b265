"""Window plans against small sequential models on random streams."""

import random
import re

import pytest

from citeweave.operators import aggregates as A
from citeweave.operators import folds as O
from citeweave.operators import sequence as S

WORDS = ["Smith, A. B.", "Title words here", "(2001). Text", "2001", "ends-", "one", "and &", "x (1999)", "Prop. 2001/02:1", "A. (2005). T", "https://x.org", "Brown, C.", "7 things 12", "y, 1998."]


def streams(seed, docs=60):
    rng = random.Random(seed)
    return {d: [rng.choice(WORDS) for _ in range(rng.randint(0, 12))] for d in range(docs)}


def rows(spark, data):
    return spark.createDataFrame([(d, i + 1, t) for d, x in data.items() for i, t in enumerate(x)], "doc_id int, line_no int, text string")


def result(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["doc_id"], r["line_no"])):
        out.setdefault(r["doc_id"], []).append(r["text"])
    return out


def attach(lines, test, sep=" "):
    out = []
    for i, t in enumerate(lines):
        if out and test(t, lines[i - 1], lines[i + 1] if i + 1 < len(lines) else None):
            out[-1] = out[-1].rstrip() + sep + t.lstrip()
        else:
            out.append(t)
    return out


def consume(lines, test):
    out, i = [], 0
    while i < len(lines):
        if test(lines[i]) and i + 1 < len(lines) and not lines[i + 1].startswith("Prop."):
            out.append(lines[i].rstrip() + " " + lines[i + 1].lstrip())
            i += 2
        else:
            out.append(lines[i])
            i += 1
    return out


def until(lines, test, cap):
    out, n = [], None
    for t in lines:
        if n is None or n > cap:
            out.append(t)
            n = 0
        else:
            out[-1] = out[-1].rstrip() + " " + t.lstrip()
        n += 1
        if test(t):
            n = None
    return out


YEAR = lambda t: bool(re.search(r"(?<![\d-])(1999|1998|200\d)(?![\d-])", t))
PAREN = lambda t: bool(re.search(r"\((1999|200\d)\)", t))
MODELS = [
    (S.hyphen_join, lambda x: attach(x, lambda t, b, n: b.endswith("-"), "")),
    (S.attach_single_tokens, lambda x: attach(x, lambda t, b, n: " " not in t)),
    (S.merge_short, lambda x: attach(x, lambda t, b, n: t.count(" ") <= 2 and not t.startswith("Prop."))),
    (S.append_non_year, lambda x: attach(x, lambda t, b, n: not PAREN(t) and not t.startswith("Prop."))),
    (S.attach_digits, lambda x: attach(x, lambda t, b, n: bool(re.search(r"\d", t)) and not YEAR(t))),
    (S.year_end_consume, lambda x: consume(x, lambda t: bool(re.search(r"\(1999\)$", t)))),
    (S.ampersand_consume, lambda x: consume(x, lambda t: t.endswith("&"))),
    (S.bare_year_end_consume, lambda x: consume(x, lambda t: bool(re.search(r"(\(1999\)|2001|1998)\.?$", t)))),
    (lambda x: S.append_until_year(x, 3), lambda x: until(x, YEAR, 3)),
    (lambda x: S.append_until_year(x), lambda x: until(x, YEAR, 25)),
]


@pytest.mark.parametrize("number", range(len(MODELS)))
def test_models(spark, number):
    plan, model = MODELS[number]
    data = streams(number)
    want = {d: model(x) for d, x in data.items() if x}
    assert result(plan(rows(spark, data))) == want


def test_one_exchange(spark):
    chained = S.append_non_year(S.year_end_consume(S.hyphen_join(S.in_documents(rows(spark, streams(1))))))
    plan = chained._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1
    physical = chained._jdf.queryExecution().sparkPlan().toString()
    executed = chained._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert executed.count("Exchange hashpartitioning(doc_id") == 1, physical


def test_fill_and_splits(spark):
    data = {1: ["Smith, A. (2001). One", "---, (2002). Two", "---, (2003). Three", "Doe, J. (2004). Four"], 2: ["---, (2001). None before"]}
    assert result(S.fill_dashes(rows(spark, data))) == {1: ["Smith, A. (2001). One", "Smith, A. (2002). Two", "Smith, A. (2003). Three", "Doe, J. (2004). Four"], 2: ["---, (2001). None before"]}
    assert result(S.split_accessed(rows(spark, {1: ["a [accessed on 2001-02-03]. b"]}))) == {1: ["a [accessed on 2001-02-03].", "b"]}
    assert result(S.split_trailers(rows(spark, {1: ["A 2001 [x]. Smith, B. (2002). T", "A [x]. Smith, B. T"]}))) == {1: ["A 2001 [x].", "Smith, B. (2002). T", "A [x]. Smith, B. T"]}
    assert result(S.attach_parentheticals(rows(spark, {1: ["a b", "(c). d e", "f"]}))) == {1: ["a b (c).", "d e", "f"]}
    assert result(S.collapse_authors(rows(spark, {1: ["Smith, A. B.", "Jones, C.", "A title here"]}))) == {1: ["Smith, A. B. Jones, C.", "A title here"]}


def test_folds(spark):
    assert O.numbered_join(["[1] a", "b", "[2]", "c", "[5]", "[3] d"]) == ["[1] a b", "[2] c [5]", "[3] d"]
    assert O.join_on_url_end(["see https://", "x.org/a rest", "more"]) == ["see https://x.org/a", "rest", "more"]
    assert O.editor_merge(["Smith, A.", "(Eds.),", "Book title (2001)"]) == ["Smith, A. (Eds.),", "Book title (2001)"]
    assert O.author_append(["Smith, A., & Jones, B.", "(2001). T"]) == ["Smith, A., & Jones, B. (2001). T"]
    assert O.attach_leading_ampersand(["Smith, A.", "& Doe, B. (2001)"]) == ["Smith, A. & Doe, B. (2001)"]
    data = {1: ["[1] a", "b", "[2] c"], 2: ["x"]}
    assert result(S.fold(rows(spark, data), O.numbered_join)) == {1: ["[1] a b", "[2] c"], 2: ["x"]}


def test_styles_and_cut(spark):
    data = {1: [f"[{i}] x" for i in range(15)], 2: ["1", "2", "3 x"], 3: ["a", "Appendix", "b"]}
    assert {r["doc_id"]: r["style"] for r in A.numbered_style(rows(spark, data)).collect()} == {1: "bracket", 2: None, 3: None}
    assert {r["doc_id"]: round(r["share"], 2) for r in A.standalone_number_share(rows(spark, data)).collect()}[2] == 0.67
    assert result(A.stop_cut(rows(spark, data)))[3] == ["a"]


def test_empty(spark):
    none = rows(spark, {1: ["x"]}).where("false")
    for plan, _ in MODELS:
        assert plan(none).count() == 0
