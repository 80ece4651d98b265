"""Quality and toxicity scores from positive-unlabelled classifiers."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.llm import nnpu
from citeweave.llm.hashing import NEWLINES, NOT_ALNUM, SPACES, Buffer, buffers, chunks, stretches, summed
from citeweave.llm.shared import documents, map_batches

#: Rows that a classifier is fitted on at most: positives, and unlabelled ones.
LABELLED, UNLABELLED = 3000, 9000
THRESHOLD = 0.3

# ---- quality: shape of the text -------------------------------------------------

#: A class for each byte: each ASCII sign by itself, upper and lower case, digits, blanks, newlines, other controls, the rest.
_SIGNS = [c for c in range(33, 127) if not chr(c).isalnum()]
_CLASS = np.full(256, 6)
_CLASS[:32], _CLASS[127] = 5, 5
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[32], _CLASS[10] = 0, 1, 2, 3, 4
for _i, _c in enumerate(_SIGNS):
    _CLASS[_c] = 7 + _i
_CLASSES = 7 + len(_SIGNS)


def _distinct(owner: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    """Distinct values per owner."""
    if not len(values):
        return np.zeros(count)
    order = np.lexsort((values, owner))
    o, v = owner[order], values[order]
    new = np.concatenate([[True], (o[1:] != o[:-1]) | (v[1:] != v[:-1])])
    return np.bincount(o[new], minlength=count)


def shape_features(b: Buffer) -> np.ndarray:
    """Per text: shares of byte classes, words' lengths and repetition, lines' repetition."""
    n, size = b.count, np.maximum(1, b.ends - b.starts - 1).astype(np.float64)
    where = np.repeat(np.arange(n), b.ends - b.starts)
    shares = np.bincount(where * _CLASSES + _CLASS[b.raw], minlength=n * _CLASSES).reshape(n, _CLASSES) / size[:, None]
    starts, ends = b.segments(SPACES)
    owner, words = b.owner(starts), b.hashes(starts, ends)
    count = np.bincount(owner, minlength=n)
    many = np.maximum(1, count)
    long = ends - starts
    mean = np.bincount(owner, long, n) / many
    spread = np.sqrt(np.maximum(0, np.bincount(owner, long.astype(np.float64) ** 2, n) / many - mean**2))
    again = np.bincount(owner[1:][(owner[1:] == owner[:-1]) & (words[1:] == words[:-1])], minlength=n) / many if len(owner) else np.zeros(n)
    upper = np.isin(b.raw[starts], np.arange(65, 91)) & np.isin(b.raw[np.minimum(starts + 1, len(b.raw) - 1)], np.arange(65, 91))
    lstarts, lends = b.segments(NEWLINES)
    lowner = b.owner(lstarts)
    lines = np.maximum(1, np.bincount(lowner, minlength=n))
    distinct = _distinct(owner, words, n)
    more = [
        np.log1p(count), mean, spread, distinct / many, distinct / np.maximum(1, many**0.85), again, np.bincount(owner, long == 1, n) / many, np.bincount(owner, upper, n) / many,
        np.log1p(lines), 1 - _distinct(lowner, b.hashes(lstarts, lends), n) / lines, np.log1p(size / lines), (count == 0).astype(float),
    ]
    return np.sqrt(np.column_stack([shares, *more])).astype(np.float32)


# ---- toxicity: words and word beginnings -----------------------------------------

#: Hashed features, lengths of word beginnings in bytes, and features counted over the corpus.
SPACE, BEGINNINGS, CANDIDATES = 1 << 24, (3, 4, 5, 6), 1 << 14
#: Features of the models that are averaged, most significant first; their least significance, and the models' weight decay.
SIZES, LEAST, DECAY = (100, 400, 1500), 1.5, 1e-2


def word_features(b: Buffer) -> list[np.ndarray]:
    """Per text the distinct hashed words and word beginnings in it."""
    starts, ends = b.segments(NOT_ALNUM)
    owner = b.owner(starts)
    some = [b.hashes(starts, ends)]
    owners = [owner]
    for k in BEGINNINGS:
        longer = ends - starts > k
        some.append(b.hashes(starts[longer], starts[longer] + k) ^ np.uint64(k * 0x1F3D5B79))
        owners.append(owner[longer])
    keys = np.unique((np.concatenate(owners).astype(np.uint64) << np.uint64(24)) | (np.concatenate(some) & np.uint64(SPACE - 1)))
    cuts = np.searchsorted(keys >> np.uint64(24), np.arange(b.count + 1))
    ids = (keys & np.uint64(SPACE - 1)).astype(np.uint32)
    return [ids[cuts[i] : cuts[i + 1]] for i in range(b.count)]


def significance(seen: np.ndarray, ones: int, often: np.ndarray, rest: int) -> np.ndarray:
    """How many standard deviations the share of the positives with a feature is over that of the rest."""
    pooled = (seen + often + 1) / (ones + rest + 2)
    return (seen / max(1, ones) - often / max(1, rest)) / np.sqrt(pooled * (1 - pooled) * (1 / max(1, ones) + 1 / max(1, rest)) + 1e-12)


def counted(sets: list[np.ndarray], ids: np.ndarray) -> np.ndarray:
    """How many sets hold each of the sorted ids."""
    if not len(ids) or not sets:
        return np.zeros(len(ids), np.int64)
    found = np.concatenate(sets)
    at = np.minimum(np.searchsorted(ids, found), len(ids) - 1)
    return np.bincount(at[ids[at] == found], minlength=len(ids))


def candidates(positive: list[np.ndarray], rest: list[np.ndarray]) -> np.ndarray:
    """Sorted ids of the features of two positives or more; the CANDIDATES most significant ones in the samples."""
    if not positive:
        return np.zeros(0, np.uint32)
    ids, seen = np.unique(np.concatenate(positive), return_counts=True)
    ids, seen = ids[seen >= 2], seen[seen >= 2]
    z = significance(seen, len(positive), counted(rest, ids), len(rest))
    return np.sort(ids[np.argsort(-z, kind="stable")[:CANDIDATES]])


@dataclass
class Vocabulary:
    """Features that mark positives, with the logarithm of how much likelier positives have them."""

    ids: np.ndarray
    weight: np.ndarray

    @staticmethod
    def of(positive: list[np.ndarray], ids: np.ndarray, often: np.ndarray, rest: int, most: int) -> Vocabulary:
        """Of the candidate ids, of which often of the rest's documents have each, the most significant ones over LEAST."""
        seen = counted(positive, ids)
        z = significance(seen, len(positive), often, rest)
        best = np.argsort(-z, kind="stable")[:most]
        best = np.sort(best[z[best] > LEAST])
        p, q = (seen[best] + 0.5) / max(1, len(positive)), (often[best] + 0.5) / max(1, rest)
        return Vocabulary(ids[best], np.log(p / q).astype(np.float32))

    def inputs(self, sets: list[np.ndarray]) -> np.ndarray:
        """Weights of the features that each set has; their sum, its logarithm and that of the set's size last."""
        out = np.zeros((len(sets), len(self.ids) + 3), np.float32)
        for i, s in enumerate(sets):
            if len(self.ids) and len(s):
                at = np.minimum(np.searchsorted(self.ids, s), len(self.ids) - 1)
                hit = at[self.ids[at] == s]
                out[i, hit] = self.weight[hit]
                out[i, -3] = self.weight[hit].sum()
            out[i, -2:] = np.log1p(max(0.0, out[i, -3])), np.log(max(1, len(s)))
        return out


# ---- both --------------------------------------------------------------------------

Features = Callable[[list[bytes]], list[bytes]]


def shape_bytes(texts: list[bytes]) -> list[bytes]:
    return [row.tobytes() for _, b in buffers(texts) for row in shape_features(b)]


def word_bytes(texts: list[bytes]) -> list[bytes]:
    return [s.tobytes() for _, b in buffers(texts) for s in word_features(b)]


def _outside(doc_id: Column, folds: int, held: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds != held, F.lit(True))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, features: Features) -> tuple[list[bytes], list[bytes]]:
    """Features of bounded samples of the rows outside the held-out fold: LABELLED ones with label 1, about UNLABELLED of all.

    Samples are the first rows by a hash of the id, so they are spread over the table and
    the same in each run. Rows labelled twice count with the larger label. Label 0 is not used.
    """
    chance = F.pmod(F.xxhash64("doc_id", F.lit(label)), F.lit(1 << 30))
    ones = labels.where(_outside(F.col("doc_id"), folds, held) & (F.col(label) == 1)).select("doc_id").distinct()
    wanted = ones.orderBy(chance, "doc_id").limit(LABELLED)
    share = min(1.0, 1.2 * UNLABELLED / max(1, docs.count()))
    plain = docs.where(_outside(F.col("doc_id"), folds, held) & (chance < int(share * (1 << 30))))
    texts = docs.join(F.broadcast(wanted), "doc_id").select("doc_id", "text", F.lit(1).alias("label")).unionByName(plain.select("doc_id", "text", F.lit(0).alias("label")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, plain in (x for batch in batches for x in stretches(batch)):
            yield pa.RecordBatch.from_arrays([part.column("chance"), part.column("label"), pa.array(features([t.encode() for t in plain]), pa.binary())], ["chance", "label", "features"])

    rows = map_batches(texts.select(chance.alias("chance"), "label", "text"), run, "chance long, label int, features binary").toArrow()
    rows = rows.sort_by([("chance", "ascending"), ("features", "ascending")])
    known = rows.column("label").to_numpy() == 1
    pick = lambda mask, most: rows.filter(pa.array(mask)).column("features").slice(0, most).to_pylist()
    return pick(known, 2 * LABELLED), pick(~known, 2 * UNLABELLED)


def corpus_sums(docs: DataFrame, folds: int, held: int, add: Callable[[Buffer], np.ndarray], width: int) -> np.ndarray:
    """Sum of what add makes of the texts of all documents outside the held-out fold."""
    return summed(docs.where(_outside(F.col("doc_id"), folds, held)).select("text"), lambda batch: (add(b) for _, b in chunks(batch)), width)


def fit_quality(positive: list[bytes], unlabelled: list[bytes], sums: np.ndarray, threshold: float = THRESHOLD) -> nnpu.Scorer | None:
    """Quality model of both samples' features; sums are the number, sums and sums of squares of the features of all documents."""
    if not positive or not unlabelled:
        return None
    p, u = (np.stack([np.frombuffer(f, np.float32) for f in some]) for some in (positive, unlabelled))
    count, (mean, square) = max(1.0, sums[0]), sums[1:].reshape(2, -1) / max(1.0, sums[0])
    scale = np.sqrt(np.maximum(0, square - mean**2)) if count > 1 else np.ones_like(mean)
    fit = lambda p, u, prior, epochs: nnpu.train(p, u, prior, hidden=24, epochs=epochs, rate=0.005, mean=mean, scale=scale)
    (p1, p2), (u1, u2) = nnpu.halves(len(p)), nnpu.halves(len(u))
    guess = fit(p[p1], u[u1], 0.5, 20)
    prior = nnpu.class_prior(guess.raw(p[p2]), guess.raw(u[u2]))
    return nnpu.scored(fit(p, u, prior, 30), u, threshold)


@dataclass
class Blend:
    """Models over parts of one vocabulary, whose outputs are put on one scale and averaged; over 0 is the decision."""

    words: Vocabulary
    models: list[tuple[np.ndarray, nnpu.Scorer]]
    shift: float

    @staticmethod
    def part(x: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """Inputs of a smaller vocabulary from those of the whole one."""
        own = x[:, columns]
        total = own.sum(axis=1)
        return np.column_stack([own, total, np.log1p(np.maximum(0, total)), x[:, -1]])

    def score(self, sets: list[np.ndarray]) -> np.ndarray:
        x = self.words.inputs(sets)
        out = np.mean([model.slope * model.raw(self.part(x, columns)) for columns, model in self.models], axis=0)
        return nnpu.sigmoid(4 * out + self.shift)


def fit_toxicity(positive: list[np.ndarray], unlabelled: list[np.ndarray], ids: np.ndarray, often: np.ndarray, rest: int, threshold: float = THRESHOLD) -> Blend | None:
    """Toxicity model of both samples' sets; often counts the documents, of rest in all, that have each candidate feature.

    Few significant features tell a little for sure and many tell more with noise, and
    which is better depends on the number of positives; so a model is fitted for each of
    SIZES, and their outputs are averaged. Models on either half of both samples
    estimate the class prior on the other half.
    """
    if not positive or not unlabelled:
        return None

    def fit(p: np.ndarray, u: np.ndarray, prior: float, epochs: int) -> nnpu.Scorer:
        mean, scale = np.zeros(p.shape[1]), np.ones(p.shape[1])
        last = np.concatenate([p[:, -3:], u[:, -3:]])
        mean[-3:], scale[-3:] = last.mean(axis=0), last.std(axis=0)
        return nnpu.train(p, u, prior, epochs=epochs, rate=0.01, decay=DECAY, mean=mean, scale=scale)

    pick = lambda sets, at: [sets[i] for i in at]
    (p1, p2), (u1, u2) = nnpu.halves(len(positive)), nnpu.halves(len(unlabelled))
    words = Vocabulary.of(positive, ids, often, rest, max(SIZES))
    p, u = words.inputs(positive), words.inputs(unlabelled)
    models: list[tuple[np.ndarray, nnpu.Scorer]] = []
    for most in sorted(SIZES, reverse=True):
        columns = np.flatnonzero(np.isin(words.ids, Vocabulary.of(positive, ids, often, rest, most).ids))
        if models and len(columns) == len(models[-1][0]):
            continue
        priors = []
        for p_in, u_in, p_out, u_out in ((p1, u1, p2, u2), (p2, u2, p1, u1)):
            if len(p_in) and len(u_in):
                half = Vocabulary.of(pick(positive, p_in), ids, often, rest, most)
                guess = fit(half.inputs(pick(positive, p_in)), half.inputs(pick(unlabelled, u_in)), 0.5, 12)
                priors.append(nnpu.class_prior(guess.raw(half.inputs(pick(positive, p_out))), guess.raw(half.inputs(pick(unlabelled, u_out)))))
        own_p, own_u = Blend.part(p, columns), Blend.part(u, columns)
        model = fit(own_p, own_u, float(np.mean(priors)), 30)
        model.slope = float(1 / (model.raw(own_u).std() + 1e-6))
        models.append((columns, model))
    return Blend(words, models, math.log(threshold / (1 - threshold)))


def _scored(docs: DataFrame, score: Callable[[list[bytes]], np.ndarray], columns: list[str]) -> DataFrame:
    """columns of docs, untouched, and the score of their text; each row by itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in (x for batch in batches for x in stretches(batch)):
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), pa.array(score([t.encode() for t in texts]), pa.float64())], [*columns, "score"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    needed = columns if "text" in columns else [*columns, "text"]
    return map_batches(docs.select(*needed), run, f"{fields}, score double")


def quality_scorer(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> Callable[[list[bytes]], np.ndarray]:
    """A function from UTF-8 texts to quality scores, fitted outside the held-out fold.

    Trusted positives are rows labelled 1 and the unlabelled are plain documents; the class
    prior is estimated from both, and the threshold is the model's own decision, so rows labelled 0 are
    not used. Features are standardised by the mean and scale over all documents. Only the
    text is used. Without positives or documents every score is 0.5.
    """
    width = 1 + 2 * shape_features(Buffer([b""])).shape[1]

    def add(b: Buffer) -> np.ndarray:
        x = shape_features(b).astype(np.float64)
        return np.concatenate([[len(x)], x.sum(axis=0), (x * x).sum(axis=0)])

    model = fit_quality(*training_rows(docs, labels, "quality", folds, held, shape_bytes), corpus_sums(docs, folds, held, add, width))

    def score(texts: list[bytes]) -> np.ndarray:
        if model is None:
            return np.full(len(texts), 0.5)
        return np.concatenate([np.zeros(0), *(model.score(shape_features(b)) for _, b in buffers(texts))]).astype(float)

    return score


def toxicity_scorer(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2) -> Callable[[list[bytes]], np.ndarray]:
    """As quality_scorer, for toxicity: confirmed toxic rows against unlabelled text, by words and word beginnings, counted over all documents."""
    positive, unlabelled = ([np.frombuffer(f, np.uint32) for f in some] for some in training_rows(docs, labels, "toxic", folds, held, word_bytes))
    ids = candidates(positive, unlabelled)
    sums = corpus_sums(docs, folds, held, lambda b: np.concatenate([[b.count], counted(word_features(b), ids)]).astype(np.float64), 1 + len(ids)) if len(ids) else np.zeros(1)
    fitted = fit_toxicity(positive, unlabelled, ids, sums[1:], int(sums[0]))

    def score(texts: list[bytes]) -> np.ndarray:
        if fitted is None:
            return np.full(len(texts), 0.5)
        return np.concatenate([np.zeros(0), *(fitted.score(word_features(b)) for _, b in buffers(texts))]).astype(float)

    return score


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, all columns as they are, whose text's quality score reaches the threshold."""
    score = quality_scorer(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in (x for batch in batches for x in stretches(batch)):
            yield part.filter(pa.array(score([t.encode() for t in texts]) >= threshold))

    return map_batches(docs, run, docs.schema)


def _query(spark: SparkSession, sf_dir: str, scorer: Callable, folds: int, held: int) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = _scored(docs, scorer(docs, labels, folds, held), ["doc_id"])
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    return scored.select("doc_id", F.coalesce(fold == held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole text; null and empty texts are scored as empty. Repeated rows stay."""
    return _query(spark, sf_dir, quality_scorer, 5, 0)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text; null and empty texts are scored as empty. Repeated rows stay."""
    return _query(spark, sf_dir, toxicity_scorer, 4, 2)
