"""The pipeline's stages on the smallest tables, each against a plain version of what it has to do."""

import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from citeweave.llm.shared import documents, staged


def shingles(t, n):
    w = [x.encode().lower() for x in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
    return frozenset([tuple(w)]) if 0 < len(w) < n else frozenset(zip(*[w[i:] for i in range(n)], strict=False))


def test_stages(spark, sf):
    docs, results = documents(spark, sf), []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = staged(stage(spark, before, sf))
        results.append((name, before, docs))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == documents(spark, sf).columns
    rows = lambda df: [r.asDict() for r in df.collect()]

    _, before, after = results[0]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in rows(after)}
    known = [r["doc_id"] for r in rows(before) if r["doc_id"] in labels]
    assert sum((i in kept) == bool(labels[i]) for i in known) >= 0.9 * len(known)

    _, before, after = results[1]
    sets = {r["doc_id"]: shingles(r["text"], 5) for r in rows(before)}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            if j < i and sets[i] and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    assert {r["doc_id"] for r in rows(after)} == {i for i in ids if root(i) == i}

    _, before, after = results[2]
    texts = {r["doc_id"]: r["text"] for r in rows(after)}
    assert set(texts) == {r["doc_id"] for r in rows(before)}
    assert not any(re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9-]+", t) for t in texts.values())

    _, before, after = results[3]
    own = defaultdict(Counter)
    for r in rows(before):
        own[r["doc_id"]].update(r["text"].split())
    new = defaultdict(Counter)
    for r in rows(after):
        new[r["doc_id"]].update(r["text"].split())
    assert all(n <= 2 * own[i][w] for i in new for w, n in new[i].items())
    total = sum(sum(c.values()) for c in own.values())
    assert abs(sum(sum(c.values()) for c in new.values()) - 1.5 * total) <= 30

    _, before, after = results[4]
    pieces = rows(after)
    used = Counter()
    for r in pieces:
        used[r["sequence_id"]] += r["length"]
    assert max(used.values()) <= 2048 and len(used) <= -(-sum(used.values()) // 2048) + 2


ODD = "doc_id long, text string, lang string, source string, n_chars long, near_id string, label string, chance string, mixed_key string, mixed_text string, size long, row long, `key` string, shingles string, score double"


def odd_rows():
    long = " ".join(f"word{i} the and of" for i in range(4000))
    texts = [(1, "The cat of the house and the big dog in a small town by the sea"), (2, None), (3, ""), (4, "  \n\t "), (5, "word"), (6, long), (7, long + " end"), (None, "no id of this text here"), (None, "no id of this text here"), (8, "mail bob@example.com now"), (2**60 + 1, "a large id and a few words"), (5, "word"), (9, "WORD"), (5, "other words")]
    return [(i, t, None if k % 3 else "en", [None, "a", "b", ""][k % 4], None if t is None else len(t), "n", "l", "c", "k", "t", 1, 2, "key", "s", 0.5) for k, (i, t) in enumerate(texts)]


@pytest.mark.parametrize("rows", [odd_rows(), []], ids=["odd", "empty"])
def test_stages_on_odd_rows(spark, tmp_path, rows):
    """Nulls in any column, empty, long and repeated rows, extra columns with names of the stages' own, and no rows: one stage after the other."""
    labels = [(1, 1, 0), (6, 1, 0), (8, None, 1), (None, 1, 1), (99, 0, 0)] if rows else []
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = staged(spark.createDataFrame(rows, ODD).repartition(3))
    for name, stage in corpus_pipeline.STAGES:
        before = Counter((r["doc_id"], r["text"]) for r in docs.collect()) if "text" in docs.columns else None
        out = staged(stage(spark, docs, str(tmp_path)))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
            assert all(r["near_id"] == "n" and r["mixed_key"] == "k" and r["size"] == 1 and r["score"] == 0.5 for r in out.collect()), name
        after = Counter(r["doc_id"] for r in out.collect())
        if name == "n-gram Jaccard join" and rows:
            kept = Counter((r["doc_id"], r["text"]) for r in out.collect())
            assert max(kept.values()) == 1 and sum(t == odd_rows()[5][1] for _, t in kept) <= 1 and not any(t == "WORD" for _, t in kept)
        elif name == "personal data":
            assert after == Counter(i for i, _ in before.elements())
        assert rows or not after
        docs = out
    if rows:
        assert 2**60 + 1 in after and None in after


def test_entry_needs_no_llm(tmp_path):
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    shutil.copytree(root, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", "spark-warehouse"))
    os.remove(tmp_path / "r/corpus_pipeline.py")
    code = "import __spark_entry__ as e; q = e.queries(); assert q and set(e.oracle_sql()) <= set(q) and not any(k.startswith('op') and k[2].isdigit() for k in q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "r", check=True, env=os.environ | {"PYTHONPATH": ""})


def test_registered(spark):
    import __spark_entry__ as e

    names = [k for k in e.queries() if re.match(r"op\d+_", k)]
    assert sorted(int(re.match(r"op(\d+)", k)[1]) for k in names) == list(range(1, 11)) and "pipeline" in e.queries()



@pytest.mark.parametrize("name", ["op2_sharding", "op3_ngram_jaccard_join", "op4_url_filters"])
def test_oracle(spark, sf, name):
    import glob
    import os

    from citeweave.llm import registry

    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    got = registry.queries()[name](spark, sf)
    columns = sorted(got.columns)
    want = con.sql(f"select {', '.join(columns)} from ({registry.oracle_sql()[name]})")
    assert sorted(map(str, map(tuple, got.select(*columns).collect()))) == sorted(map(str, want.fetchall()))
