"""N-gram Jaccard self-join: rare-first prefixes with length, positional and suffix filters."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citeweave.llm.components import components
from citeweave.llm.hashing import SPACES, Buffer, chunks, mixed, summed
from citeweave.llm.shared import documents, free_name, map_batches, staged

#: Counters of the frequency sketch: rows, and counters in each (a power of two).
SKETCH_ROWS, SKETCH_WIDTH = 2, 1 << 18
#: Parts of a set that the suffix filter counts.
SUFFIX_PARTS = 64
#: Sets that meet at one n-gram are paired there up to this many, and compared in blocks of about as many beyond.
BLOCK = 256
#: Shingles that a task verifying pairs, or one block of sets, holds at about; a single longer set is held whole.
SHINGLES = 1 << 18
#: An n-gram is frequent if its estimate is over this many times the sketch's mean; others' groups are surely small.
FREQUENT = 4
#: Numbers (ids and the jobs they are needed in) that are sent to all workers at most; more are joined by shuffling the texts.
MOST_SENT = 1_000_000
#: Kinds of jobs: of many small groups of pairs, of two blocks of a large one, of two blocks of a cluster of frequent n-grams.
SMALL, LARGE, MANY = 0, 1, 2
_STEP = np.random.default_rng(7).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def shingle_sets(b: Buffer, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(owner, hash) of each text's distinct n-word shingles, sorted. A text of fewer words has all of them as one."""
    starts, ends = b.segments(SPACES)
    owner, words = b.owner(starts), b.hashes(starts, ends)
    if not len(words):
        return owner, words
    count = np.bincount(owner, minlength=b.count)
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    full = max(0, len(words) - n + 1)
    sums = np.zeros(full, np.uint64)
    for k in range(n):
        sums += words[k : k + full] * _STEP[k]
    whole = owner[:full] == owner[n - 1 : n - 1 + full]
    owners, hashes = [owner[:full][whole]], [mixed(sums[whole] + np.uint64(n))]
    for m in range(1, n):
        short = np.flatnonzero(count == m)
        sums = np.zeros(len(short), np.uint64)
        for k in range(m):
            sums += words[first[short] + k] * _STEP[k]
        owners.append(short)
        hashes.append(mixed(sums + np.uint64(m)))
    o, h = np.concatenate(owners), np.concatenate(hashes)
    order = np.lexsort((h, o))
    o, h = o[order], h[order]
    new = np.concatenate([[True], (o[1:] != o[:-1]) | (h[1:] != h[:-1])])
    return o[new], h[new]


def _slots(h: np.ndarray) -> list[np.ndarray]:
    return [((h >> np.uint64(20 * r)) & np.uint64(SKETCH_WIDTH - 1)).astype(np.int64) for r in range(SKETCH_ROWS)]


def frequency_sketch(texts: DataFrame, n: int) -> np.ndarray:
    """Count-min sketch of how many texts hold each shingle, over all of them.

    Its size is fixed, so that it may be sent to all workers; it only orders shingles, and
    any order gives the same result.
    """

    def count(b: Buffer) -> np.ndarray:
        return np.concatenate([np.bincount(at, minlength=SKETCH_WIDTH) for at in _slots(shingle_sets(b, n)[1])])

    return summed(texts.select("text"), lambda batch: (count(b) for _, b in chunks(batch)), SKETCH_ROWS * SKETCH_WIDTH).reshape(SKETCH_ROWS, SKETCH_WIDTH)


def set_keys(texts: DataFrame, n: int) -> DataFrame:
    """id, n and key (digest of the set; null if empty) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, b in chunks(batch):
                o, h = shingle_sets(b, n)
                cuts = np.searchsorted(o, np.arange(b.count + 1))
                keys = [_digest(h[cuts[i] : cuts[i + 1]]) for i in range(b.count)]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(np.diff(cuts), pa.int64()), pa.array(keys, pa.binary())], ["id", "n", "key"])

    return map_batches(texts, run, f"id {texts.schema['id'].dataType.simpleString()}, n long, key binary")


def _lists(values: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(values))


def _digest(s: np.ndarray) -> bytes | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def signatures(texts: DataFrame, n: int, num: int, den: int, sketch: np.ndarray) -> DataFrame:
    """As set_keys, with prefix (rarest n-grams first), rare (how many of it are no frequent ones) and parts (sizes of the set's parts by hash)."""
    frequent = FREQUENT * sketch.sum() / sketch.size
    shared = texts.sparkSession.sparkContext.broadcast(sketch)  # fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = shared.value
        for batch in batches:
            for part, b in chunks(batch):
                o, h = shingle_sets(b, n)
                size = np.bincount(o, minlength=b.count) if len(o) else np.zeros(b.count, np.int64)
                cuts = np.concatenate([[0], np.cumsum(size)])
                rarity = np.minimum.reduce([seen[r][at] for r, at in enumerate(_slots(h))])
                order = np.lexsort((h, rarity, o))
                parts = np.bincount(o * SUFFIX_PARTS + (h >> np.uint64(58)).astype(np.int64), minlength=b.count * SUFFIX_PARTS) if len(o) else np.zeros(b.count * SUFFIX_PARTS, np.int64)
                take = np.where(size > 0, size + num * size // -den + 1, 0)  # n - ceil(t * n) + 1
                place = np.arange(len(o)) - cuts[o]
                first = place < take[o]
                common = np.bincount(o[first], rarity[order][first] > frequent, b.count) if len(o) else np.zeros(b.count)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"), pa.array(size, pa.int64()), pa.array([_digest(h[cuts[i] : cuts[i + 1]]) for i in range(b.count)], pa.binary()), _lists(h[order][first].view(np.int64), take),
                        _lists(parts.astype(np.int32), np.full(b.count, SUFFIX_PARTS)), pa.array(take - common.astype(np.int64), pa.int64()),
                    ],
                    ["id", "n", "key", "prefix", "parts", "rare"],
                )

    return map_batches(texts, run, f"id {texts.schema['id'].dataType.simpleString()}, n long, key binary, prefix array<long>, parts array<int>, rare long")


def whole_sets(texts: DataFrame, n: int) -> DataFrame:
    """node, jobs and shingles of each text (key, node, jobs, text) whose set has that key (any, if null); digest is the set's key. A node comes once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in batches:
            for part, b in chunks(batch):
                o, h = shingle_sets(b, n)
                cuts = np.searchsorted(o, np.arange(b.count + 1))
                keys, nodes = part.column("key").to_pylist(), part.column("node").to_pylist()
                digests = [_digest(h[cuts[i] : cuts[i + 1]]) for i in range(b.count)]
                kept = []
                for i in range(b.count):
                    if nodes[i] is None or keys[i] == digests[i] and nodes[i] not in sent:
                        kept.append(i)
                        sent.add(nodes[i])
                rows = part.take(pa.array(kept, pa.int64()))
                flat = np.concatenate([h[cuts[i] : cuts[i + 1]] for i in kept]).view(np.int64) if kept else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([rows.column("node"), rows.column("jobs"), pa.array([digests[i] for i in kept], pa.binary()), _lists(flat, np.array([cuts[i + 1] - cuts[i] for i in kept], np.int64))], ["node", "jobs", "digest", "shingles"])

    fields = f"node long, jobs {texts.schema['jobs'].dataType.simpleString()}, digest binary, shingles array<long>"
    return map_batches(texts.select("key", "node", "jobs", "text"), run, fields)


def overlaps(left: Sequence[np.ndarray], right: Sequence[np.ndarray], rests: tuple[Sequence[np.ndarray], Sequence[np.ndarray]] | None = None, wanted: np.ndarray | None = None) -> np.ndarray:
    """Sizes of the intersections of each left with each right set.

    With rests, a number for each element of left and of right, only those elements count
    of which both numbers are as large as wanted of the pair.
    """
    out = np.zeros((len(left), len(right)), np.int64)
    if not left or not right:
        return out
    values = np.concatenate(right)
    owner = np.repeat(np.arange(len(right)), [len(s) for s in right])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    rest = np.concatenate(rests[1])[order] if rests else None
    for i, s in enumerate(left):
        low, high = np.searchsorted(values, s, "left"), np.searchsorted(values, s, "right")
        long = high - low
        at = np.repeat(low - np.concatenate([[0], np.cumsum(long)[:-1]]), long) + np.arange(long.sum()) if len(s) else np.zeros(0, np.int64)
        if rests:
            at = at[np.minimum(np.repeat(rests[0][i], long), rest[at]) >= wanted[i, owner[at]]]
        out[i] = np.bincount(owner[at], minlength=len(right))
    return out


def block_links(group: pd.DataFrame, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the linked pairs of two blocks of a cluster of frequent n-grams.

    A pair is treated here only if no n-gram that few sets meet makes it a candidate
    elsewhere, and this is the first cluster of both. The first n-gram of both may be a
    frequent one, so one of few sets counts only where the positional filter lets the pair
    through.
    """
    cluster, one, two = (group[c].iloc[0] for c in ("cluster", "low", "high"))
    left = np.flatnonzero(group["block"] == one)
    right = left if one == two else np.flatnonzero(group["block"] == two)
    lists = {c: [np.asarray(v if v is not None else [], np.int64) for v in group[c]] for c in ("shingles", "clusters", "met", "rest")}
    lists["clusters"] = [v[v < cluster] for v in lists["clusters"]]
    size = group["n"].to_numpy(np.int64)
    of = lambda c, rows: [lists[c][i] for i in rows]
    both, total = overlaps(of("shingles", left), of("shingles", right)), size[left][:, None] + size[right][None, :]
    linked = den * both >= num * (total - both)
    if linked.any():
        elsewhere = overlaps(of("met", left), of("met", right), (of("rest", left), of("rest", right)), -(-num * total // (num + den)))
        linked &= (elsewhere == 0) & (overlaps(of("clusters", left), of("clusters", right)) == 0)
    if one == two:
        linked = np.triu(linked, 1)
    i, j = np.nonzero(linked)
    return left[i], right[j]


def listed_links(group: pd.DataFrame, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the linked ones among the listed pairs: each set with its partners."""
    place = {int(x): i for i, x in enumerate(group["node"])}
    sets, ones, twos = [np.asarray(v, np.int64).view(np.uint64) for v in group["shingles"]], [], []
    for i, partners in enumerate(group["partners"]):
        if partners is None or not len(partners) or not len(sets[i]):
            continue
        at = np.array([place[int(x)] for x in partners])
        values, lengths = np.concatenate([sets[k] for k in at]), np.array([len(sets[k]) for k in at])
        hit = sets[i][np.minimum(np.searchsorted(sets[i], values), len(sets[i]) - 1)] == values
        both = np.bincount(np.repeat(np.arange(len(at)), lengths)[hit], minlength=len(at))
        linked = at[den * both >= num * (lengths + len(sets[i]) - both)]
        ones.append(np.full(len(linked), i))
        twos.append(linked)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *ones]), np.concatenate([none, *twos])


def job_links(jobs: pd.DataFrame, sets: pd.DataFrame, num: int, den: int) -> pd.DataFrame:
    """Links among the sets of one job: per set with links the copies it is linked with, and edges that connect what is linked."""
    group = jobs.merge(sets[["node", "shingles"]].drop_duplicates("node"), on="node")
    if not len(group):
        return pd.DataFrame({"a": [], "b": [], "links": []}, dtype=np.int64)
    ones, twos = (listed_links if group["kind"].iloc[0] < MANY else block_links)(group, num, den)
    copies, degree, parent = group["copies"].to_numpy(np.int64), np.zeros(len(group), np.int64), list(range(len(group)))
    np.add.at(degree, ones, copies[twos])
    np.add.at(degree, twos, copies[ones])

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, j in zip(ones.tolist(), twos.tolist(), strict=True):
        a, b = root(i), root(j)
        if a != b:
            parent[max(a, b)] = min(a, b)
    linked, nodes = np.flatnonzero(degree), group["node"].to_numpy(np.int64)
    return pd.DataFrame({"a": nodes[linked], "b": nodes[[root(int(i)) for i in linked]], "links": degree[linked]}, dtype=np.int64)


def sendable(ids: DataFrame, size: str = "1") -> DataFrame:
    """Rows of size numbers each, marked to be sent to all workers if they are counted to be few enough; else left to a shuffled join."""
    ids = staged(ids)
    return F.broadcast(ids) if (ids.agg(F.sum(F.expr(size))).first()[0] or 0) <= MOST_SENT else ids


def pair_jobs(pairs: DataFrame) -> DataFrame:
    """Deal candidate pairs (a, b, n_a, n_b) to jobs: kind, cluster, low, high, node, block, n, partners.

    A pair is at home with the least partner of its first set, so a group whose sets are
    all candidates of each other has one home and each of its sets one place. Small homes are put
    together into jobs of about SHINGLES; a larger home is cut into blocks, and every two
    blocks are a job.
    """
    ends = pairs.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(pairs.select(F.col("b").alias("node"), F.col("a").alias("other")))
    near = ends.groupBy(F.col("node").alias("a")).agg(F.min("other").alias("home"))
    homed = staged(pairs.join(near, "a").withColumn("home", F.least("a", "home")).select("home", "a", "b", "n_a", "n_b"))
    members = homed.select("home", F.col("a").alias("node"), F.col("n_a").alias("n")).unionByName(homed.select("home", F.col("b").alias("node"), F.col("n_b").alias("n"))).distinct()
    homes = staged(members.groupBy("home").agg(F.sum("n").alias("n")).withColumn("blocks", F.ceil(F.col("n") / SHINGLES).cast("int")))
    buckets = math.ceil((homes.where("blocks = 1").agg(F.sum("n")).first()[0] or 0) / SHINGLES) or 1
    place = lambda c: F.pmod(F.xxhash64(c, "home"), F.col("blocks")).cast("int")
    small = F.col("blocks") == 1
    dealt = homed.join(homes.select("home", "blocks"), "home").select(
        F.when(small, SMALL).otherwise(LARGE).alias("kind"), F.when(small, F.pmod(F.xxhash64("home"), F.lit(buckets))).otherwise(F.col("home")).alias("cluster"),
        F.least(place("a"), place("b")).alias("low"), F.greatest(place("a"), place("b")).alias("high"), "a", "b", "n_a", "n_b",
    )
    job = ["kind", "cluster", "low", "high"]
    both = dealt.select(*job, F.col("a").alias("node"), F.col("n_a").alias("n"), F.col("b").alias("partner")).unionByName(dealt.select(*job, F.col("b").alias("node"), F.col("n_b").alias("n"), F.lit(None).cast("long").alias("partner")))
    return both.groupBy(*job, "node", "n").agg(F.collect_list("partner").alias("partners")).withColumn("block", F.lit(0))


def ngram_join(docs: DataFrame, n: int = 5, num: int = 8, den: int = 10, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """Link texts whose sets of n-word shingles have a Jaccard similarity of num / den or more.

    Returns, per row: id, n_shingles, class_id (smallest id with the same set),
    component_id (smallest id reachable by links, its own included) and n_links (rows
    linked with it).

    Words are split at white space (space and controls 9 to 13), A-Z lower-cased. Texts of fewer than
    n words have one shingle of all of them; null texts and texts without words have none,
    are linked with nothing and are their own class. Rows with equal sets form a class and
    are compared as one. Rows may repeat, ids too; null ids count as largest. Extra columns are ignored.

    Classes meet at the rarest n-grams of their sets, in the order of a frequency sketch of
    all texts: if two sets are similar enough, the first n - ceil(t * n) + 1 have one in
    common. Up to `block` classes that meet are paired there if sizes (length filter), the
    places of the n-gram in both orders (positional filter) and the sizes of 64 parts of both
    sets (suffix filter) allow the similarity. Pairs are dealt to jobs, and each set is sent to
    the jobs that need it, straight from its text; a job verifies its pairs once. N-grams that
    more meet are clustered by the sets they meet in; a cluster's classes are cut into blocks,
    and every two blocks are a job, which returns links' counts and connecting edges instead of pairs.
    So no job gathers more than about SHINGLES of small groups or two blocks, and nothing is left out.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sigs = staged(set_keys(texts, n))
    first = lambda c: F.first(c).alias(c)
    classes = signatures(texts, n, num, den, frequency_sketch(texts, n)).where("n > 0").groupBy("key").agg(F.min("id").alias("low"), F.count("*").alias("copies"), first("n"), first("prefix"), first("parts"), first("rare"))
    classes = staged(classes.withColumn("node", F.monotonically_increasing_id()))

    # Rare n-grams are counted where they meet, frequent ones before.
    postings = classes.select("node", "n", "rare", F.posexplode("prefix").alias("pos", "token"))
    rare = postings.where("pos < rare").drop("rare").withColumn("sets", F.count("*").over(Window.partitionBy("token")))
    common = postings.where("pos >= rare").drop("rare")
    common = common.join(common.groupBy("token").agg(F.count("*").alias("sets")), "token")
    met = staged(rare.unionByName(common).where("sets > 1"))

    few = met.where(F.col("sets") <= block)
    a, b = few.alias("a"), few.alias("b")
    wanted = F.expr(f"ceil({num} * (a.n + b.n) / {num + den})")
    pairs = a.join(
        b,
        (F.col("a.token") == F.col("b.token")) & (F.col("a.node") < F.col("b.node")) & F.expr(f"least(a.n, b.n) * {den} >= greatest(a.n, b.n) * {num}") & (F.expr("least(a.n - a.pos, b.n - b.pos)") >= wanted),
    ).select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct()
    side = lambda c: classes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("parts").alias(f"parts_{c}"))
    most = F.aggregate(F.zip_with("parts_a", "parts_b", lambda x, y: F.least(x, y).cast("long")), F.lit(0).cast("long"), lambda s, x: s + x)
    pairs = staged(pairs.join(side("a"), "a").join(side("b"), "b").where(most * den >= num * (F.col("n_a") + F.col("n_b") - most)).select("a", "b", "n_a", "n_b"))

    # Frequent n-grams met by nearly the same sets get one cluster: that of the least of the sets by hash.
    many = met.where(F.col("sets") > block)
    groups = many.groupBy("token").agg(F.min(F.xxhash64("node")).alias("cluster"))
    clustered = staged(many.join(groups, "token").select("cluster", "node", "n").distinct())
    in_many = clustered.groupBy("node", "n").agg(F.collect_list("cluster").alias("clusters"))
    other_met = few.join(in_many.select("node"), "node", "left_semi").groupBy("node").agg(F.collect_list(F.struct("token", (F.col("n") - F.col("pos")).cast("int").alias("rest"))).alias("met")).select("node", F.col("met.token").alias("met"), F.col("met.rest").alias("rest"))
    blocks = clustered.groupBy("cluster").agg(F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum("n") / SHINGLES)).cast("int").alias("blocks"))
    dealt = clustered.join(blocks, "cluster").withColumn("block", F.pmod(F.xxhash64("node", "cluster"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(F.lit(MANY).alias("kind"), "cluster", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "node", "n", "block").join(in_many.drop("n").join(other_met, "node", "left"), "node")

    # Every set goes to its jobs straight from its text.
    job = ["kind", "cluster", "low", "high"]
    jobs = staged(pair_jobs(pairs).unionByName(dealt, allowMissingColumns=True).join(classes.select("node", "copies"), "node"))
    needed = jobs.groupBy("node").agg(F.collect_list(F.struct(*job)).alias("jobs")).join(classes.select("node", "key", "low"), "node")
    by_id = sendable(needed.where("low is not null").withColumnRenamed("low", "id"), "3 + 4 * size(jobs)")
    sets = whole_sets(texts.join(by_id, "id"), n).drop("digest")
    lost = staged(needed.where("low is null"))
    if not lost.isEmpty():  # classes without any id: found by their sets
        plain = texts.where("id is null").select("text", F.lit(None).cast("binary").alias("key"), F.lit(None).cast("long").alias("node"), F.lit(None).cast(lost.schema["jobs"].dataType).alias("jobs"))
        own = whole_sets(plain, n).select(F.col("digest").alias("key"), "shingles").join(lost.select("key", "node", "jobs"), "key")
        sets = sets.unionByName(own.select("node", "jobs", "shingles"))
    sets = sets.withColumn("job", F.explode("jobs")).select("job.*", "node", "shingles")
    run = lambda own, held: job_links(own, held, num, den)
    links = staged(jobs.groupBy(*job).cogroup(sets.groupBy(*job)).applyInPandas(run, "a long, b long, links long"))
    roots = components(links.select("a", "b"))
    nodes = roots.join(classes.select("node", "low"), "node")
    lowest = nodes.groupBy("root").agg(F.min("low").alias("component_id"))
    degree = links.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    known = nodes.join(lowest, "root").select("node", "component_id").join(degree, "node", "left")
    of_class = classes.select("node", "key", "low", "copies").join(known, "node", "left").drop("node")
    full = sigs.where("n > 0").select("id", "n", "key").join(of_class, "key")
    full = full.select("id", F.col("n").alias("n_shingles"), F.col("low").alias("class_id"), F.coalesce("component_id", "low").alias("component_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    empty = sigs.where("n = 0").select("id", F.col("n").alias("n_shingles"), F.col("id").alias("class_id"), F.col("id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    return full.unionByName(empty).withColumnRenamed("id", id_col)


def one_of_each(docs: DataFrame, n: int = 5, num: int = 8, den: int = 10) -> DataFrame:
    """The rows of docs (doc_id, text and others) but for near duplicates: of each component the row of its smallest id stays.

    Texts without words are no duplicates of anything, but a row that repeats another's id
    and text goes, as does one with the same id and a similar text. Null ids count as
    smallest. Columns are as in docs, whatever their names.
    """
    near = free_name(docs, "near_id")
    ident = lambda: F.struct(F.col("doc_id").alias("doc_id"), F.xxhash64("text").alias("digest"))
    joined = staged(ngram_join(docs.select(ident().alias(near), "text"), n, num, den, id_col=near).select(near, "component_id"))
    gone = sendable(joined.where(F.col(near) != F.col("component_id")).select(near).distinct())
    marked = docs.withColumn(near, ident())
    left = marked.join(gone, near, "left_anti")
    repeated = staged(joined.where(F.col(near) == F.col("component_id")).groupBy(near).count().where("count > 1").select(near))
    if not repeated.isEmpty():
        some = sendable(repeated)
        left = left.join(some, near, "left_anti").unionByName(left.join(some, near, "left_semi").dropDuplicates([near]))
    return left.select(*docs.columns)


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(documents(spark, sf_dir), 3, 90, 100).select("doc_id", "n_shingles", "component_id", "class_id", "n_links")


SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) END AS grams FROM d),
u AS (SELECT doc_id, unnest(grams) AS gram FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM u AS a JOIN u AS b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT a, b FROM p JOIN s AS x ON x.doc_id = a JOIN s AS y ON y.doc_id = b WHERE 100 * shared >= 90 * (len(x.grams) + len(y.grams) - shared)),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS root FROM s UNION SELECT e.b, r.root FROM r JOIN e ON r.doc_id = e.a),
c AS (SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id),
k AS (SELECT grams, min(doc_id) AS class_id FROM s WHERE len(grams) > 0 GROUP BY grams),
n AS (SELECT a AS doc_id, count(*) AS n_links FROM e GROUP BY a)
SELECT s.doc_id, CAST(len(s.grams) AS bigint) AS n_shingles, component_id, coalesce(class_id, s.doc_id) AS class_id, coalesce(n_links, 0) AS n_links FROM s JOIN c USING (doc_id) LEFT JOIN k ON k.grams = s.grams LEFT JOIN n ON n.doc_id = s.doc_id
"""
