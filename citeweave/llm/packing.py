"""Packing tokenized documents into sequences by vector best fit."""

from __future__ import annotations

import base64
import functools
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.llm.hashing import stretches
from citeweave.llm.shared import documents, map_batches, staged

#: Characters for which both libraries' splitting patterns are known to agree; words of others are left to the first.
_PLAIN = re.compile("[\n\x21-\x7e\xa1-\u024f]*")
#: Words whose ids a worker remembers at a time.
REMEMBERED = 200_000
#: Pieces that a task packs at a time, share of the tokens over which a sequence is full, and rounds at most.
PER_TASK, FULL, MOST_TURNS = 16_384, 0.9, 12


class WordIds(dict):
    """Bytes of the little-endian 32-bit ids of a space and the word after it, each encoded on first use.

    The tokenizer's splitting always starts a new piece at a single space between other
    characters and merges only inside pieces, so a text's ids are those of its
    space-led words in turn. Texts with runs of spaces, a last space or a special token's
    string are encoded whole. ranks_path names the same vocabulary for the faster
    library, which then encodes words of plain characters.
    """

    def __init__(self, path: str, ranks_path: str | None = None) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.plain = None
        if ranks_path:
            import public_tokenizers
            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.plain = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        if self.plain and _PLAIN.fullmatch(word):
            ids = array("I", self.plain(" " + word)).tobytes()
        else:
            ids = self.encode(" " + word)
        self[word] = ids
        return ids

    def of(self, text: str) -> bytes:
        if "  " in text or text.endswith(" ") or any(s in text for s in self.special):
            return self.encode(text)
        if len(self) > REMEMBERED:
            self.clear()
        first, *rest = text.split(" ")
        return self.encode(first) + b"".join(map(self.__getitem__, rest))


@functools.lru_cache(maxsize=1)
def word_ids(path: str, ranks_path: str | None) -> WordIds:
    """One per worker process, kept across its tasks."""
    return WordIds(path, ranks_path)


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int, ranks_path: str | None = None, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: every text's ids and end_id, cut only if longer than capacity; the first piece takes the odd rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = word_ids(tokenizer_path, ranks_path), np.array([end_id], "<u4").tobytes()
        for part, texts in (x for batch in batches for x in stretches(batch)):
            rows, out = [], []
            for i, text in enumerate(texts):
                ids = words.of(text) + end
                n = len(ids) // 4
                start = 0
                for piece in range(-(-n // capacity)):
                    stop = (n - 1) % capacity + 1 + piece * capacity
                    rows.append(i)
                    out.append((piece, start, stop - start, zlib.crc32(ids[4 * start : 4 * stop])))
                    start = stop
            columns = zip(*out, strict=True) if out else [[]] * 4
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(rows, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: np.ndarray, capacity: int, most_docs: int, most_attention: int, weights: tuple[float, float, float] = (1.0, 0.02, 0.02), score: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item by vector best fit, longest first.

    An item of n tokens demands (n, 1, n * n) of a bin's tokens, documents and attention
    cost. Among the bins that hold it under every constraint, 'norm' takes the one whose
    weighted residual capacities have the least norm afterwards, 'dot' the one whose
    residuals have the largest weighted dot product with the demand. A new bin is opened
    only if none holds it; an item over a capacity on its own is an error. Ties go to the
    bin opened first. Bins too full for the smallest item are closed.
    """
    lengths = np.asarray(lengths, np.int64)
    order = np.argsort(-lengths, kind="stable")
    caps = np.array([capacity, most_docs, most_attention], np.float64)
    scale = np.asarray(weights) / caps
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    if not len(lengths):
        return bins, offsets
    least = int(lengths.min())
    if lengths.max() > capacity or int(lengths.max()) ** 2 > most_attention or most_docs < 1:
        raise ValueError("an item is over a capacity on its own")
    room, made, used = np.zeros((3, 1024)), 0, 0  # residuals of the open bins
    name = np.zeros(1024, np.int64)
    for i in order:
        n = int(lengths[i])
        left = room[:, :used] - np.array([[n], [1], [n * n]])
        fits = (left >= 0).all(axis=0)
        at = -1
        if used and fits.any():
            if score == "norm":
                points = np.where(fits, ((left * scale[:, None]) ** 2).sum(axis=0), np.inf)
                at = int(points.argmin())
            else:
                points = np.where(fits, (scale[0] ** 2 * n * room[0, :used] + scale[1] ** 2 * room[1, :used] + scale[2] ** 2 * n * n * room[2, :used]), -np.inf)
                at = int(points.argmax())
        if at < 0:
            if used == room.shape[1]:
                room, name = np.concatenate([room, np.zeros_like(room)], axis=1), np.concatenate([name, np.zeros_like(name)])
            at, used = used, used + 1
            room[:, at], name[at], made = caps, made, made + 1
        bins[i], offsets[i] = name[at], capacity - int(room[0, at])
        room[:, at] -= (n, 1, n * n)
        if room[0, at] < least or room[1, at] < 1 or room[2, at] < least * least:
            room[:, at : used - 1], name[at : used - 1] = room[:, at + 1 : used].copy(), name[at + 1 : used].copy()
            used -= 1
    return bins, offsets


def pack(pieces: DataFrame, capacity: int, most_docs: int, most_attention: int, per_task: int = PER_TASK) -> DataFrame:
    """Add sequence_id and offset (gapless from 0) to pieces with a length column.

    Pieces are spread over groups of about per_task, whatever their ids, and each group is
    packed by itself. Each leaves a few bins that are not FULL; the pieces of those are
    packed anew together, in far fewer groups each time, until one holds them all. So the
    number of sequences is that of packing all at once but for a few, and no task holds more
    than about per_task pieces.
    """
    todo, done, turn = staged(pieces), [], 0
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in todo.schema)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("length", "doc_id", "piece", "start", "ids_crc32") if c in table.column_names])
        lengths = table.column("length").to_numpy()
        bins, offsets = best_fit(lengths, capacity, most_docs, most_attention)
        filled = np.bincount(bins, lengths) if len(lengths) else np.zeros(0)
        spare = filled[bins] < FULL * capacity if len(lengths) else np.zeros(0, bool)
        own = table.column("pack").to_numpy() * 2**32 + bins
        for name, values in (("sequence_id", pa.array(own, pa.int64())), ("offset", pa.array(offsets, pa.int64())), ("spare", pa.array(spare, pa.bool_()))):
            table = table.append_column(name, values)
        return table.drop_columns(["pack"])

    while True:
        groups = max(1, round(todo.count() / per_task))
        spread = todo.withColumn("pack", F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(turn)), F.lit(groups)) + (turn << 24))  # of staged files, so stable
        packed = spread.groupBy("pack").applyInArrow(run, f"{fields}, sequence_id long, offset long, spare boolean")
        if groups == 1 or turn == MOST_TURNS:
            return functools.reduce(DataFrame.unionByName, [*done, packed.drop("spare")])
        packed = staged(packed)
        done.append(packed.where("not spare").drop("spare"))
        todo, turn = packed.where("spare").select(*pieces.columns), turn + 1


#: Of the registered query; the last two bind no sequence of its capacity.
CAPACITY, MOST_DOCS, MOST_ATTENTION = 2048, 2048, 2048 * 2048


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, ranks_path: str | None = None, capacity: int = CAPACITY, most_docs: int = MOST_DOCS, most_attention: int = MOST_ATTENTION) -> DataFrame:
    """Tokenize and pack documents.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset per piece. A null
    or empty text is its end id alone. Repeated rows and ids are packed one by one. Null
    ids are kept. Extra columns are ignored. Empty in, empty out.
    """
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path, ranks_path = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    return pack(token_pieces(docs, tokenizer_path, capacity, ranks_path), capacity, most_docs, most_attention)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))
