"""Every operator on tables with nulls, empty, long and repeated rows, ties, extra columns, and on empty tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from citeweave.llm import classify, components, media, mixing, ngramjoin, packing, pii, sharding, spotsigs, urlrules

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, bucket string, spots string, shard string, `key` string, id string, n string"
LONG = " ".join(f"word{i} the and of" for i in range(9000))
TEXTS = [
    (1, "The cat of the house and the big dog in a small town by the sea"), (2, None), (3, ""), (4, "  \n\t "), (5, "word"), (6, LONG), (7, "The cat of the house and the big dog in a small town by the sea"),
    (7, "The cat of the house and the big dog in a small town by the sea"), (8, "mail bob@example.com or +1 (555) 123-4567, ip 10.0.0.1 card 4111 1111 1111 1111"), (9, "éàü ñ 漢字 🙂 text of the day"), (None, "no id of the text here"), (10, "two words"),
    (11, LONG + " end"), (12, "TWO words"), (8, "other text with the same id of a row"),
]


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if k % 3 else "en", [None, "a", "b", ""][k % 4], None if t is None else len(t), 1, "x", "y", "z", "k", "i", "n") for k, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def order(i):
    return (i is not None, i or 0)


def test_staging(spark, docs):
    """Staged rows come back; a cluster without a shared folder is refused; staged folders can be deleted."""
    from types import SimpleNamespace

    from citeweave.llm import shared

    kept = shared.staged(docs.select("doc_id", "text"))
    assert kept.count() == len(TEXTS) and kept.schema == docs.select("doc_id", "text").schema
    path = kept.inputFiles()[0].removeprefix("file://").rpartition("/")[0]
    import os

    assert os.path.isdir(path)
    shared.clear_stages(spark)
    assert not os.path.isdir(path)
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="yarn", setCheckpointDir=None)
    with pytest.raises(RuntimeError, match="checkpoint"):
        shared.stage_dir(SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: None)))
    assert shared.free_name(docs, "Text") == "Text_" and shared.free_name(docs, "other") == "other"


def test_spotsigs(spark, docs, empty):
    assert spotsigs.with_next(empty.select("doc_id", "text")).count() == 0
    rows = spotsigs.with_next(docs.select("doc_id", "text")).collect()
    assert len(rows) == len(TEXTS)
    ranked = sorted(TEXTS, key=lambda x: (order(x[0]), x[1] is not None, (x[1] or "").encode()))
    after = Counter((ranked[k], ranked[(k + 1) % len(ranked)][1]) for k in range(len(ranked)))
    assert Counter(((r["doc_id"], r["text"]), r["next_text"]) for r in rows) == after
    got = defaultdict(set)
    for r in rows:
        got[r["text"]].add(tuple(r["spots"]))
    assert all(len(v) == 1 for v in got.values()) and got[None] == got[""] == {()} and len(next(iter(got["word"]))) == 1
    # a brute-force version of the signatures
    t = TEXTS[0][1].lower().split()
    chains = {(w, *[x for x in t[i + 1 :] if x not in spotsigs.ANCHORS][:2]) for i, w in enumerate(t) if w in spotsigs.ANCHORS}
    assert len(next(iter(got[TEXTS[0][1]]))) == len([c for c in chains if len(c) == 3])


def brute_fingerprint(text):
    """Signatures of a text as sets of word tuples."""
    import unicodedata

    t = "".join(c if unicodedata.category(c)[0] in "LN" else " " for c in text.lower()).split()
    others = [i for i, w in enumerate(t) if w not in spotsigs.ANCHORS]
    chains = set()
    for i, w in enumerate(t):
        after = [j for j in others if j > i][:2]
        if w in spotsigs.ANCHORS and len(after) == 2:
            chains.add((w, t[after[0]], t[after[1]]))
    return chains or {tuple(t[i : i + 3]) for i in range(len(t) - 2)} or ({("all", *t)} if t else set())


def brute_likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprint_query(spark, tmp_path):
    """The whole query against a brute-force version: edited texts, sizes and likenesses; no text's quarter may be lost."""
    rng = np.random.default_rng(4)
    vocabulary = [*spotsigs.ANCHORS[:30], *(f"wort{i}" for i in range(40)), "Ünï", "x-y", "🙂"]
    texts = [(int(i), " ".join(rng.choice(vocabulary, rng.integers(1, 60)))) for i in rng.permutation(70) * 3]
    texts += [(1000, None), (1001, ""), (1002, "the a of"), (1003, " . "), (1004, texts[3][1]), (1005, texts[3][1]), (-5, "the " * 500 + "cat sat")]
    spark.createDataFrame(texts, "doc_id long, text string").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r for r in spotsigs.op1_document_fingerprints(spark, str(tmp_path)).collect()}
    ordered = sorted(texts)
    assert set(rows) == {i for i, _ in texts}
    prints = defaultdict(set)
    for k, (i, t) in enumerate(ordered):
        t, following = t or "", ordered[(k + 1) % len(ordered)][1] or ""
        quarter = len(t) // 4
        edited, r = t[: len(t) - quarter] + following[:quarter], rows[i]
        own, new, other = map(brute_fingerprint, (t, edited, following))
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert [len(x.split(":")) if x else 0 for x in (r["fingerprint"], r["edited_fingerprint"])] == [len(own), len(new)]
        assert np.isclose(r["near_edited"], brute_likeness(own, new)) and np.isclose(r["near_next"], brute_likeness(own, other))
        prints[frozenset(own)].add(r["fingerprint"])
    assert all(len(x) == 1 for x in prints.values()) and len(set().union(*prints.values())) == len(prints)


def test_spotsigs_pairs(spark):
    base = [f"the w{i} of x{i} and y{i}" for i in range(40)]
    texts = [(1, " ".join(base)), (2, " ".join(base)), (3, " ".join([*base[:-1], "the other of things and more"])), (4, " ".join(base[:20])), (5, None), (6, "")]
    prints = spotsigs.fingerprints(spark.createDataFrame(texts, "doc_id long, text string"))
    members, pairs = spotsigs.near_pairs(prints)
    assert {(r["id"], r["rep"]) for r in members.collect()} == {(1, 1), (2, 1), (3, 3), (4, 4)}
    sets = {r["id"]: set(r["spots"]) for r in prints.collect()}
    want = {(a, b) for a in (1, 3, 4) for b in (1, 3, 4) if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert {tuple(sorted((r["a"], r["b"]))) for r in pairs.collect()} == want == {(1, 3)}


def test_spotsigs_pairs_large_group(spark):
    """A spot that many have, ids with two texts, and null ids."""
    rng = np.random.default_rng(2)
    base = [f"the w{i} of x{i}" for i in range(30)]
    texts = [(None if k == 7 else k // 2 if k < 6 else k, " ".join(w if rng.random() > 0.04 else f"the z{k} of y{i}" for i, w in enumerate(base))) for k in range(300)]
    prints = spotsigs.fingerprints(spark.createDataFrame(texts, "doc_id long, text string").repartition(4))
    sets, reps = {}, {}
    for r in prints.collect():
        key = tuple(r["spots"])
        sets[key] = set(r["spots"])
        reps[key] = min((i for i in (reps.get(key), r["id"]) if i is not None), default=None)
    keys = sorted(sets)
    want = Counter(tuple(sorted((reps[a], reps[b]), key=order)) for i, a in enumerate(keys) for b in keys[:i] if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-12)
    members, pairs = spotsigs.near_pairs(prints)
    assert Counter(tuple(sorted((r["a"], r["b"]), key=order)) for r in pairs.collect()) == want and len(want) > 1000
    assert members.count() == len(texts)


def test_sharding(docs, empty):
    assert sharding.shard_by_bytes(empty, 8).count() == 0
    rows = sorted(sharding.shard_by_bytes(docs, 3).collect(), key=lambda r: (r["shard"], r["slot"]))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in TEXTS)
    assert [order(r["doc_id"]) for r in rows] == sorted(order(i) for i, _ in TEXTS)
    for s in range(3):
        assert [r["slot"] for r in rows if r["shard"] == s] == list(range(sum(r["shard"] == s for r in rows)))
    total, start = sum(r["size"] for r in rows), 0
    for r in rows:
        assert r["shard"] == min(2, (2 * start + r["size"]) * 3 // (2 * total))
        start += r["size"]


def brute_join(texts, n, num, den):
    def shingles(t):
        w = [x.encode().lower() for x in words(t)]
        return frozenset([tuple(w)]) if 0 < len(w) < n else frozenset(zip(*[w[i:] for i in range(n)], strict=False))

    sets = [shingles(t) for _, t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(texts)
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and den * len(a & sets[j]) >= num * len(a | sets[j]):
                parent[root(i)] = root(j)
                links[i] += 1
                links[j] += 1
    return sets, [root(i) for i in range(len(texts))], links


@pytest.mark.parametrize("block", [256, 2])
def test_ngram_join(spark, docs, empty, block):
    if block == 2:
        rng = np.random.default_rng(3)
        base = [f"w{i}" for i in range(60)]
        texts = [(k, " ".join(w if rng.random() > 0.03 else f"z{k}" for w in base)) for k in range(14)] + [(20, None), (21, "w1 w2"), (22, "W1 w2"), (23, " ".join(base)), (24, " ".join(base))]
        table = spark.createDataFrame(texts, "doc_id long, text string")
    else:
        texts, table = [x for x in TEXTS if x[0] is not None], docs.where("doc_id is not null")
        assert ngramjoin.ngram_join(empty, 3, 90, 100).count() == 0
    sets, roots, links = brute_join(texts, 3, 80, 100)
    low = {r: min(texts[i][0] for i in range(len(texts)) if roots[i] == r) for r in set(roots)}
    want = Counter((texts[i][0], len(sets[i]), low[roots[i]], links[i]) for i in range(len(texts)))
    got = ngramjoin.ngram_join(table, 3, 80, 100, block=block).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["n_links"]) for r in got) == want


def test_ngram_join_large_group(spark):
    """Several hundred different near copies and the default block: pairs may meet at a frequent n-gram first and at one of few sets later."""
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in range(60)]
    texts = [(k, " ".join(w if rng.random() > 0.03 else f"z{k}x{i}" for i, w in enumerate(base))) for k in range(420)]
    sets, roots, links = brute_join(texts, 3, 80, 100)
    low = {r: min(texts[i][0] for i in range(len(texts)) if roots[i] == r) for r in set(roots)}
    got = ngramjoin.ngram_join(spark.createDataFrame(texts, "doc_id long, text string").repartition(3), 3, 80, 100).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in got} == {k: (len(sets[k]), low[roots[k]], links[k]) for k, _ in texts}


def test_ngram_join_null_ids(spark):
    """Rows without an id are linked as others are; their ids count as largest."""
    base = [f"w{i}" for i in range(40)]
    texts = [(None, " ".join(base)), (5, " ".join([*base[:-1], "end"])), (None, " ".join(["start", *base[1:]])), (9, "other words of a text"), (None, "x y z"), (None, "x y z")]
    got = ngramjoin.ngram_join(spark.createDataFrame(texts, "doc_id long, text string"), 3, 80, 100).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["class_id"], r["component_id"], r["n_links"]) for r in got) == Counter([(None, 38, None, 5, 2), (5, 38, 5, 5, 2), (None, 38, None, 5, 2), (9, 3, 9, 9, 0), (None, 1, None, None, 1), (None, 1, None, None, 1)])


def test_one_of_each(docs):
    kept = Counter((r["doc_id"], r["text"]) for r in ngramjoin.one_of_each(docs, 3, 8, 10).collect())
    assert kept[(7, TEXTS[0][1])] == 0 and kept[(1, TEXTS[0][1])] == 1 and kept[(2, None)] == 1 and kept[(8, TEXTS[8][1])] == 1 and kept[(8, TEXTS[-1][1])] == 1
    assert kept[(10, "two words")] == 1 and kept[(12, "TWO words")] == 0


@pytest.mark.parametrize("hub", [100_000, 3])
def test_components(spark, monkeypatch, hub):
    monkeypatch.setattr(components, "HUB", hub)
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 120, (70, 2))] + [(200 + i, 201 + i) for i in range(30)] + [(5, 5)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: root(x) for x in linked}


def test_url_rules(spark):
    urls = [(1, "http://A.example.com/en/7x"), (2, "https://example.com/en/8?q"), (3, "http://xexample.com/en/7"), (4, None), (5, "no scheme"), (6, "http://com/en/"), (6, "http://com/en/"), (7, "ftp://b.example.net/de/8#f"), (8, "http://example.net:80/de/8"), (9, "://"), (10, "http://a..com/en/"), (11, "http://é.org/es/é")]
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in urls], "page_id long, url string, host string, path string")
    rules = [*urlrules.RULES, ("org", "/es/é", "allow"), ("com", "/en/", "allow"), ("", "/x", "block")]
    got = urlrules.judge_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string"), default="none").collect()

    def brute(u):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fit = [(len(h + p), len(p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h) and h) and path.startswith(p)]
        best = max(fit, default=None)
        return host, path, best and best[2], best[3] if best else "none"

    assert Counter((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got) == Counter((i, *brute(u)) for i, u in urls)
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r["verdict"] for r in urlrules.judge_urls(pages, none).collect()} == {"allow"}
    assert urlrules.judge_urls(pages.where("false"), none).count() == 0


def test_url_rules_of_the_contract(spark):
    contract = "block com/en/, allow example.com/en/7, allow net/de/, block example.net/de/8, block org/es/"
    assert [f"{verdict} {host}{path}" for host, path, verdict in urlrules.RULES] == contract.split(", ")
    urls = {"http://a.com/en/1": ("com/en/", "block"), "http://example.com/en/71": ("example.com/en/7", "allow"), "http://a.net/de/1": ("net/de/", "allow"), "http://b.example.net/de/81": ("example.net/de/8", "block"), "http://a.org/es/": ("org/es/", "block"), "http://a.se/de/": (None, "allow")}
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in urlrules.judge_urls(pages, urlrules.rule_table(spark, urlrules.RULES)).collect()}
    assert got == dict(enumerate(urls.values()))


def test_packing(docs, empty):
    tokenizer = packing.word_ids(*paths())
    assert packing.pack_documents(empty).count() == 0
    rows = packing.pack_documents(docs, capacity=64, most_docs=5, most_attention=64 * 64).collect()
    whole = defaultdict(list)
    for r in rows:
        whole[r["doc_id"]].append(r)
    for i in {i for i, _ in TEXTS}:
        ids = sorted(tokenizer.encode(t or "") + b"\0\0\0\0" for k, t in TEXTS if k == i)
        want = Counter()
        for x in ids:
            n = len(x) // 4
            cuts = [0, *range((n - 1) % 64 + 1, n + 1, 64)]
            want.update((p, a, b - a, zlib.crc32(x[4 * a : 4 * b])) for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)))
        assert Counter((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in whole[i]) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        b.sort()
        assert len(b) <= 5 and sum(n for _, n in b) <= 64 and all(o == sum(n for _, n in b[:k]) for k, (o, _) in enumerate(b))


def paths():
    P = pytest.importorskip("public_tokenizers")
    return P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken")


def test_packing_groups():
    """Many groups: open bins are packed anew, so the number of sequences hardly depends on the groups."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    lengths = np.random.default_rng(2).integers(1, 200, 3000)
    pieces = spark.createDataFrame([(None if k == 5 else 2**60 + k, int(n)) for k, n in enumerate(lengths)], "doc_id long, length long")
    rows = packing.pack(pieces, 512, 512, 512 * 512, per_task=100).collect()
    assert Counter((r["doc_id"], r["length"]) for r in rows) == Counter((None if k == 5 else 2**60 + k, int(n)) for k, n in enumerate(lengths))
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        b.sort()
        assert sum(n for _, n in b) <= 512 and all(o == sum(n for _, n in b[:k]) for k, (o, _) in enumerate(b))
    assert len(bins) <= 1.02 * lengths.sum() / 512 + 1


def test_ids_pass_untouched(spark):
    """An id over 2^53 beside a null one comes back as it is, from every operator that runs Python."""
    big = 2**60 + 1
    table = spark.createDataFrame([(big, "some text of words", 1), (None, "more text", 0), (3, None, 1)], "doc_id long, text string, quality int").coalesce(1)
    want = {big, None, 3}
    assert {r["doc_id"] for r in packing.pack_documents(table).collect()} == want
    assert {r["doc_id"] for r in media.store_texts(table).collect()} == want
    assert {r["doc_id"] for r in pii.personal_data(table).collect()} == want
    assert {r["doc_id"] for r in classify._scored(table, lambda texts: np.zeros(len(texts)), ["doc_id"]).collect()} == want
    assert {r["doc_id"] for r in ngramjoin.ngram_join(table).collect()} == want


def test_word_ids():
    w = packing.WordIds(*paths())
    for t in ["a  b\n\n c d \t e\x1cf\x85g　h  ", "<|endoftext|>  x <|endoftext|>", "\n\na\n b", "don't it's  'll", " ", "", "\x00\x1f x", "é 漢字 字 🙂🙂 x", " a b", "a\n b \nc d\n\n\ne", "x y z  q \nr", LONG[:5000]]:
        assert w.of(t) == w.encode(t), t


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_best_fit(score):
    lengths = np.random.default_rng(1).integers(1, 90, 500)
    bins, offsets = packing.best_fit(lengths, 100, 7, 9000, score=score)
    for b in set(bins.tolist()):
        own = np.flatnonzero(bins == b)
        assert lengths[own].sum() <= 100 and len(own) <= 7 and (lengths[own] ** 2).sum() <= 9000
        at = own[np.argsort(offsets[own])]
        assert (offsets[at] == np.concatenate([[0], np.cumsum(lengths[at])[:-1]])).all()
    assert bins.max() + 1 <= 1.1 * max(lengths.sum() / 100, (lengths**2).sum() / 9000)
    assert packing.best_fit(np.zeros(0, int), 10, 1, 100)[0].size == 0
    with pytest.raises(ValueError, match="capacity"):
        packing.best_fit([11], 10, 1, 1000)


def test_mixing(spark, docs, empty):
    assert mixing.mix_sources(empty).count() == 0
    runs = [sorted(map(str, mixing.mix_sources(docs, block=8).collect())) for _ in range(2)]
    assert runs[0] == runs[1]
    rows = mixing.mix_sources(docs, block=8).collect()
    size, taken, per_row = Counter(), Counter(), Counter()
    for r in rows:
        taken[r["source"]] += r["taken"]
        per_row[r["skey"], r["row"]] += r["taken"]
    for k, (_, t) in enumerate(TEXTS):
        size[[None, "a", "b", ""][k % 4]] += len(words(t))
    sources = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sources)}
    want, target, free = 1.5 * sum(size.values()), {}, set(sources)
    while free:  # the excess is reshared until none is above
        level = (want - sum(target.values())) / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] > 2 * size[s]}
        target |= {s: 2.0 * size[s] for s in full} if full else {s: level * weight[s] for s in free}
        free = free - full if full else set()
    for r in rows:
        assert abs(r["target"] - target[r["source"]]) < 1e-6 and r["source_size"] == size[r["source"]]
    assert all(abs(taken[s] - target[s]) <= 1 for s in sources)
    sizes = {(r["skey"], r["row"]): r["size"] for r in rows}
    assert all(per_row[k] <= 2 * n for k, n in sizes.items()) and len(sizes) == len(TEXTS)
    slots = defaultdict(list)
    for r in rows:
        if r["slot"] is not None:
            slots[r["skey"], r["epoch"]].append((r["slot"], r["block_no"]))
    for pairs in slots.values():
        assert len({s for s, _ in pairs}) == len({b for _, b in pairs}) == len(set(pairs))


def test_permutations(spark):
    """Every place once, whatever n; no fixed stride; another key, another order."""
    from pyspark.sql import functions as F

    orders = {}
    for n in [1, 2, 3, 5, 7, 10, 48, 49, 50, 51, 1000, 2503]:
        for epoch in (0, 1):
            at = mixing.permuted(F.col("id"), F.lit(n).cast("long"), (F.lit("=a"), F.lit(epoch).cast("long")), 17)
            got = [r[0] for r in spark.range(n, numPartitions=1).select(at).collect()]
            assert sorted(got) == list(range(n))
            orders[n, epoch] = got
    steps = Counter((b - a) % 2503 for a, b in zip(orders[2503, 0], orders[2503, 0][1:], strict=False))
    assert max(steps.values()) < 15 and orders[1000, 0] != orders[1000, 1]


def test_shard_counts(spark, docs):
    """Counts of the shards add up to the slots of each target, and the mix has those slots; no shard is empty of large sources."""
    targets = spark.createDataFrame([("=a", 100_000, 150_000), ("=b", 37, 74), ("", 0, 0)], "skey string, source_size long, take long")
    counts = mixing.shard_counts(targets, 8, 16, 3)
    by = defaultdict(int)
    for r in counts.collect():
        by[r["skey"], r["epoch"]] += r["slots"]
    assert by == {("=a", 0): 12_500, ("=a", 1): 6_250, ("=b", 0): 5, ("=b", 1): 5}
    share = [r["slots"] for r in counts.collect() if (r["skey"], r["epoch"]) == ("=a", 0)]
    assert len(share) == 16 and 10 < np.std(share) < 50  # of a multinomial: the root of 12500 * 15 / 256, 27
    slots = mixing.mixture_slots(counts, 8, 3).collect()
    assert Counter((r["skey"], r["epoch"], r["shard"]) for r in slots) == {(r["skey"], r["epoch"], r["shard"]): r["slots"] for r in counts.collect()}
    assert sum(r["words"] for r in slots) == 150_074
    for key in by:
        own = [(r["slot"], r["block_no"]) for r in slots if (r["skey"], r["epoch"]) == key]
        assert sorted(s for s, _ in own) == list(range(by[key])) and len({b for _, b in own}) == by[key]


def test_mixed_documents(docs):
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    own = Counter()
    for _, t in TEXTS:
        own.update(words(t))
    got = Counter()
    for r in out.collect():
        got.update(words(r["text"]))
        assert r["n_chars"] == len(r["text"])
    assert set(got) <= set(own) and all(got[w] <= 2 * own[w] for w in got)
    assert abs(sum(got.values()) - 1.5 * sum(own.values())) <= 2


def test_media(spark, docs, empty):
    for t in ["", "abc", LONG[:5000], "é" * 700]:
        raw = t.encode()
        payload = raw + b"\xff" * (-len(raw) % 576 if raw else 576)
        stored = media.encode_pgm(payload, media.WIDTH)
        assert media.decode_image(stored).tobytes() == payload
    rows = media.store_texts(docs).collect()
    want = []
    for i, t in TEXTS:
        raw = (t or "").encode()
        payload = raw + b"\xff" * ((-len(raw)) % 576 or (0 if raw else 576))
        stored = b"P5\n24 %d\n255\n" % (len(payload) // 24) + payload
        grid = np.frombuffer(payload, np.uint8).reshape(-1, 24).astype(float)
        # area means by repeating every pixel as often as the new grid has rows and columns
        areas = lambda h, w: grid.repeat(h, axis=0).repeat(w, axis=1).reshape(h, len(grid), w, 24).mean(axis=(1, 3))  # noqa: B023, E731
        small, tile = np.round(areas(8, 9), 6), np.rint(areas(8, 8))
        bits = "".join("01"[int(x)] for x in (small[:, 1:] > small[:, :-1]).ravel())
        want.append((i, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(stored), hashlib.sha256(stored).hexdigest(), f"{int(bits, 2):016x}", tile))
    key = lambda r: (order(r[0]), r[3])
    for r, w in zip(sorted(rows, key=key), sorted(want, key=key), strict=True):
        assert tuple(r)[:7] == w[:7] and r["feature"].startswith(w[7] + ":")
        assert np.abs(np.load(__import__("io").BytesIO(r["tile"])) - w[8]).max() <= 1
    assert len({tuple(r)[1:] for r in rows if r["doc_id"] in (1, 7)}) == 1
    ascii_image = media.decode_image(b"P2\n# note\n2 2\n255\n1 2\n3 4\n")
    assert ascii_image.tolist() == [[1, 2], [3, 4]] and media.decode_image(b"P1\n3 1\n101").tolist() == [[0, 255, 0]]
    assert media.decode_image(b"P4\n3 1\n\xa0").tolist() == [[0, 255, 0]] and media.decode_image(b"P6\n1 1\n255\nabc").tolist() == [[[97, 98, 99]]]
    assert media.decode_image(b"P5\n1 1\n65535\n\x01\x02").tolist() == [[258]] and media.decode_image(b"P3 1 1 255 1 2 3").tolist() == [[[1, 2, 3]]]
    pixels = bytes([3, 2, 1, 6, 5, 4, 0, 0]) + bytes([9, 8, 7, 12, 11, 10, 0, 0])
    bmp = b"BM" + (54 + 16).to_bytes(4, "little") + bytes(4) + (54).to_bytes(4, "little") + (40).to_bytes(4, "little") + (2).to_bytes(4, "little") * 2 + (1).to_bytes(2, "little") + (24).to_bytes(2, "little") + bytes(24) + pixels
    assert media.decode_image(bmp).tolist() == [[[7, 8, 9], [10, 11, 12]], [[1, 2, 3], [4, 5, 6]]]
    image = np.arange(48, dtype=np.uint8).reshape(6, 8)
    assert np.allclose(media.area_resize(image, 3, 4), image.reshape(3, 2, 4, 2).mean(axis=(1, 3)))
    assert np.isclose(media.area_resize(image, 5, 3).mean(), image.mean())
    broken = [b"P2 1 1 255 " + b"9" * 20, b"P2 1 1 255 300", b"P2 1 1 255 -1", b"P2 2 1 255 3", b"P5 99999999999 1 255 a", b"P5 90000 90000 255 a", b"P6 1 1 255 ab", b"P1 3 1 10", b"P4 99 99 a", b"BM", bmp[:60]]
    flat = b"BM" + bytes(8) + (58).to_bytes(4, "little") + (40).to_bytes(4, "little") + (1).to_bytes(4, "little") * 2 + (1).to_bytes(2, "little") + (8).to_bytes(2, "little") + bytes(16) + (1).to_bytes(4, "little") + bytes(4) + bytes([1, 2, 3, 0])
    assert media.decode_image(flat + bytes([0, 0, 0, 0])).tolist() == [[[3, 2, 1]]]
    table = spark.createDataFrame([(2**60 + k, bytearray(x)) for k, x in enumerate([*broken, flat + bytes([7, 0, 0, 0])])] + [(None, None)], "k long, data binary")
    got = media.media_features(table, "k", "data").collect()
    assert [r["k"] for r in got if r["error"] is None] == [] and {r["k"] for r in got} == {2**60 + k for k in range(len(broken) + 1)} | {None}
    images = spark.createDataFrame([(1, bytearray(b"P5 2 2 255 abcd")), (2, None), (3, bytearray(b"junk"))], "k int, data binary")
    got = {r["k"]: r for r in media.media_features(images, "k", "data", (2, 2)).collect()}
    assert got[1]["width"] == 2 and np.load(__import__("io").BytesIO(got[1]["npy"])).tolist() == [[97, 98], [99, 100]] and got[2]["error"] and got[3]["error"] and got[3]["npy"] is None


def reference_spans(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    digits = lambda s: re.sub("[^0-9]", "", s)
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 16 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(digits(m[0])) <= 15]


def test_base_spans():
    import random

    rng = random.Random(3)
    for _ in range(20000):
        t = "".join(rng.choice("ab1.@+-() 9%é,") for _ in range(rng.randint(0, 50)))
        assert pii.base_spans(t) == reference_spans(t), t
    for t in ("1" * 200_000, "a" * 200_000 + "@", "@" * 100_000, "1." * 100_000, "+1" * 50_000):
        pii.base_spans(t)


def test_tagger_gradients():
    rng = np.random.default_rng(0)
    model = pii.Tagger(1)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    ids, tags = rng.integers(0, 90, (3, 7)), np.array([[0, 1, 2, 2, 0, 3, 4], [0] * 7, [5, 6, 0, 7, 8, 8, 0]])
    grads, _ = model.gradients(ids, tags)
    for k in ("wx", "wh", "b", "out", "bias", "move", "embed"):
        flat = model.p[k].reshape(-1)
        at = int(np.abs(grads[k]).argmax())
        old, step = flat[at], 1e-5
        flat[at] = old + step
        _, up = model.gradients(ids, tags)
        flat[at] = old - step
        _, down = model.gradients(ids, tags)
        flat[at] = old
        assert np.isclose((up - down) / (2 * step), grads[k].reshape(-1)[at], rtol=0.02, atol=1e-4), k


def test_personal_data(spark, docs, empty):
    tagger = pii.default_tagger(spark)
    examples = pii.labelled_examples(300, seed=5)
    right = total = 0
    for (text, spans), (own, more) in zip(examples, pii.find([t for t, _ in examples], tagger), strict=True):
        whole = [x for x in spans if x[1] > 0 and x[2] < len(text) and x not in own]
        right += sum(x in more for x in whole)
        total += len(whole)
    assert total > 100 and right >= 0.9 * total  # held-out spans that no pattern finds
    said = ["mail john.doe (at) example.com now", "call (555) 123-4567 now please", "call 555-123-4567."]
    assert pii.find(said, tagger) == [([], [("email", 5, 30)]), ([], [("phone", 5, 19)]), ([], [("phone", 5, 17)])]
    assert pii.find(["plain words only", ""], tagger) == [([], []), ([], [])]
    rows = pii.personal_data(docs, masked=True).collect()
    by = defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
    want = pii.listed(reference_spans(TEXTS[8][1]))
    hit = next(r for r in by[8] if r["n_email"])
    assert hit["base_sha256"] == hashlib.sha256(want.encode()).hexdigest() and set(want.split(",")) <= set(hit["spans"].split(","))
    assert (hit["n_email"], hit["n_ip"], hit["n_phone"]) == (1, 1, 1) and "[EMAIL]" in hit["masked"] and "bob@" not in hit["masked"]
    assert len(rows) == len(TEXTS) and by[2][0]["spans"] == by[3][0]["spans"] == "" and pii.personal_data(empty).count() == 0
    out = pii.masked_documents(docs)
    assert out.columns == docs.columns and Counter(r["doc_id"] for r in out.collect()) == Counter(i for i, _ in TEXTS)

def test_recall_in_prose(spark, sf):
    """Per kind, forms that no pattern finds, planted in documents: found at their place. Documents without any get nothing."""
    import random

    tagger, rng = pii.default_tagger(spark), random.Random(4)
    prose = [t for (t,) in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect() if t and len(t) > 300 and not pii._SIGN.search(t)]
    assert sum(bool(more) for _, more in pii.find(prose, tagger)) <= 0.02 * len(prose)
    forms = {k: [] for k in pii.KINDS}
    for text, spans in pii.labelled_examples(3000, seed=21):
        for k, s, e in spans:
            if s and e < len(text) and not pii.base_spans(f" {text[s:e]} "):
                forms[k].append(text[s:e])
    for k, some in forms.items():
        planted, want = [], []
        for form in some[:100]:
            t = rng.choice(prose)
            at = rng.choice([i for i, c in enumerate(t) if c == " "]) + 1
            planted.append(f"{t[:at]}{form} {t[at:]}")
            want.append((k, at, at + len(form)))
        assert sum(w in more for w, (_, more) in zip(want, pii.find(planted, tagger), strict=True)) >= 0.8 * len(want) > 50, k


def test_tagger_passes_agree():
    """The inference pass is the training pass; decoding is Viterbi over all paths."""
    model = pii.Tagger(3)
    ids = np.random.default_rng(1).integers(0, 98, (4, 6))
    h, _ = model._lstm(ids)
    e = (np.concatenate([h[0], h[1, ::-1]], axis=2) @ model.p["out"] + model.p["bias"]).transpose(1, 0, 2)
    assert np.allclose(model.emissions(ids), e, atol=1e-5)
    import itertools

    e = np.random.default_rng(2).normal(0, 2, (3, 4, pii.TAGS)).astype(np.float32)
    move = model.p["move"] + pii._PAIRS
    for row, tags in zip(e, model.decode(e), strict=True):
        worth = lambda p: pii._FIRST[p[0]] + sum(row[t, k] for t, k in enumerate(p)) + sum(move[a, b] for a, b in itertools.pairwise(p))  # noqa: B023, E731
        assert np.isclose(worth(tags.tolist()), max(map(worth, itertools.product(range(pii.TAGS), repeat=4))), atol=1e-4)


def test_passes_reuse_memory():
    """A pass takes no more new memory than about its result, and what an earlier one left there changes nothing."""
    import tracemalloc

    model, rng = pii.Tagger(3), np.random.default_rng(7)
    wide = rng.integers(0, 99, (pii.TOGETHER, pii.WINDOW)).astype(np.uint8)
    first = model.emissions(wide).copy()
    for shape in ((4, 32), (1, 96), (700, 32)):
        ids = rng.integers(0, 99, shape).astype(np.uint8)
        h, _ = model._lstm(ids)
        e = (np.concatenate([h[0], h[1, ::-1]], axis=2) @ model.p["out"] + model.p["bias"]).transpose(1, 0, 2)
        assert np.allclose(model.emissions(ids), e, atol=1e-5)
    tracemalloc.start()
    again = model.emissions(wide)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (again == first).all() and peak < 2 * again.nbytes


def test_open_windows_are_decoded_together(spark):
    """Spans far apart, one or so in a pass, are decoded at once and found at their places."""
    passes, decoded = [], []

    class Counting(pii.Tagger):
        def emissions(self, ids):
            passes.append(len(ids))
            return super().emissions(ids)

        def decode(self, e):
            decoded.append(len(e))
            return super().decode(e)

    model, own = Counting(1), pii.default_tagger(spark)
    model.p, model.sure = own.p, own.sure
    text, want = "", []
    for _ in range(6):
        text += "plain words only " * 7000
        want.append(("phone", len(text), len(text) + 14))
        text += "(555) 123-4567 "
    assert pii.find([text], model) == [([], want)]
    assert len(passes) > 5 and 0 < len(decoded) < len(passes) and sum(decoded) < 0.1 * sum(passes)


def test_best_spans():
    rng = np.random.default_rng(6)
    for _ in range(50):
        spans = {("ip", int(s), int(s + n)): float(w) for s, n, w in zip(rng.integers(0, 12, 7), rng.integers(1, 6, 7), rng.random(7), strict=True)}
        import itertools

        sets = [c for k in range(8) for c in itertools.combinations(spans, k) if all(a[2] <= b[1] or b[2] <= a[1] for a, b in itertools.combinations(c, 2))]
        got = pii._best(spans)
        assert np.isclose(sum(spans[x] for x in got), max(sum(spans[x] for x in c) for c in sets)) and tuple(sorted(got)) in {tuple(sorted(c)) for c in sets}


def test_long_spans_at_all_offsets():
    """A long obfuscated address is found whole wherever it starts in the windows. The tagger is a stand-in that is sure of all it sees."""

    class Sure(pii.Tagger):
        def emissions(self, ids):
            space, filler = ids == pii._CODES[" "], (ids == pii._CODES["z"]) | (ids == pii._PAD)
            own = np.pad(~space & ~filler, ((0, 0), (1, 1)), constant_values=True)
            own = own[:, 1:-1] | space & own[:, :-2] & own[:, 2:]
            begin = own & ~np.pad(own, ((0, 0), (1, 0)))[:, :-1]
            e = np.zeros((*ids.shape, pii.TAGS), np.float32)
            e[..., 0], e[..., 1], e[..., 2] = 20 * ~own, 20 * begin, 20 * (own & ~begin)
            return e

    for address in ("ann_lee [at] mail [dot] com", "friederike_montgomery [at] mail4 [dot] example [dot] com", "friederike_montgomery [at] mailhost4 [dot] example [dot] research [dot] org", "a_b [at] mail" + 60 * " [dot] example" + " [dot] org"):
        starts = [141 + offset for offset in range(pii.STRIDE)]
        found = pii.find(["zz " * (s // 3) + "z" * (s % 3 - 1) + " " * (s % 3 > 0) + address + " zz" * 200 for s in starts], Sure(1))
        assert [s % pii.STRIDE for s, (_, more) in zip(starts, found, strict=True) if ("email", s, s + len(address)) not in more] == [], len(address)


def test_long_text_edges():
    model = None
    t = "x" * 1000 + " bob@example.com " + "y" * 1000
    assert pii.find([t], model)[0][0] == reference_spans(t)
    assert pii.mask("a bob@x.org b", [("email", 2, 11)]) == "a [EMAIL] b"


def test_classifiers(spark, sf, docs, empty):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (2, None, None), (99, 1, 1)], "doc_id long, quality int, toxic int")
    for scorer in (classify.quality_scorer, classify.toxicity_scorer):
        for table in (docs, empty):
            score = scorer(table, labels, 1, 5)
            values = score([(t or "").encode() for _, t in TEXTS])
            assert len(values) == len(TEXTS) and ((values >= 0) & (values <= 1)).all() and score([]).size == 0
    none = labels.where("false")
    assert set(classify.quality_scorer(docs, none)([b"x", b""])) == {0.5}
    kept = classify.keep_good(docs, none, 0.4)
    assert kept.columns == docs.columns and kept.count() == len(TEXTS)


def test_held_out_accuracy(spark):
    import os

    d = "/root/testdata/sf0.01"
    if not os.path.isdir(d):
        pytest.skip("no test tables")
    labels = spark.read.parquet(f"{d}/labels.parquet").toPandas()
    for query, label, least in ((classify.op7_quality_classifier, "quality", 0.95), (classify.op10_toxicity, "toxic", 0.9)):
        rows = query(spark, d).toPandas().merge(labels, on="doc_id")
        held = rows[rows["held_out"]]
        assert (held["predicted"] == held[label]).mean() >= least
        ranks, ones = held["score"].rank(), held[label] == 1
        assert (ranks[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum()) > 0.9  # area under the curve
        fold = [zlib.crc32(str(i).encode()) % (5 if label == "quality" else 4) == (0 if label == "quality" else 2) for i in rows["doc_id"]]
        assert rows["held_out"].tolist() == fold


def test_class_prior():
    """Estimated from outputs of positives and unlabelled rows alone, whatever the true share."""
    from citeweave.llm import nnpu

    rng = np.random.default_rng(3)
    for share in (0.1, 0.5, 0.9):
        positive = rng.normal(2, 1, 2000)
        unlabelled = np.where(rng.random(6000) < share, rng.normal(2, 1, 6000), rng.normal(-2, 1, 6000))
        assert abs(nnpu.class_prior(positive, unlabelled) - share) < 0.05
    assert nnpu.class_prior(np.zeros(0), np.zeros(3)) == 0.5 and 0 < nnpu.class_prior(np.zeros(5), np.zeros(5)) <= 0.98


def test_labels_of_zero_are_not_used(spark):
    """Scores are the same with and without the rows labelled 0."""
    d = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    texts = [(t or "").encode() for (t,) in docs.select("text").collect()]
    for scorer, label in ((classify.quality_scorer, "quality"), (classify.toxicity_scorer, "toxic")):
        assert (scorer(docs, labels)(texts) == scorer(docs, labels.where(f"{label} = 1"))(texts)).all()


def test_nnpu_finds_the_negatives():
    rng = np.random.default_rng(2)
    from citeweave.llm import nnpu

    positive, negative = rng.normal(1.5, 1, (600, 3)), rng.normal(-1.5, 1, (600, 3))
    unlabelled = np.concatenate([positive[300:], negative])
    for hidden in (0, 8):
        model = nnpu.train(positive[:300], unlabelled, 1 / 3, hidden=hidden)
        right = np.concatenate([model.raw(positive[300:]) > 0, model.raw(negative) < 0]).mean()
        assert right > 0.93
