"""Vectorised splitting and hashing of many texts at once."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.llm.shared import map_batches

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: A random 64-bit value per byte, so that words are hashed by more than their byte values.
_TABLE = np.random.default_rng(20240601).integers(1, 2**64 - 1, 256, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Separators of the word contracts, of lines, and of plain words (everything ASCII but letters and digits).
SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
NEWLINES = np.arange(256) == 10
NOT_ALNUM = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
#: Bytes of text treated at a time; a longer text is treated by itself.
BATCH = 1 << 18


def mixed(h: np.ndarray) -> np.ndarray:
    """Bits of 64-bit values spread over the whole word."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Buffer:
    """Texts one after another, each followed by a newline, A-Z lower-cased for hashing."""

    def __init__(self, texts: Sequence[bytes]) -> None:
        self.raw = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        self.count = len(texts)
        self.ends = np.cumsum([len(t) + 1 for t in texts])
        self.starts = self.ends - np.array([len(t) + 1 for t in texts])
        n = len(self.raw) + 1
        powers, inverses = np.full(n, _BASE, np.uint64), np.full(n, _INVERSE, np.uint64)
        powers[0] = inverses[0] = 1
        self._inverses = np.cumprod(inverses)
        self._sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLE[_LOWER[self.raw]] * np.cumprod(powers)[:-1])])

    def segments(self, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end positions of the runs between separators. No run crosses texts, as a newline is a separator of all."""
        inside = np.concatenate([[False], ~separators[self.raw], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        return edges[::2], edges[1::2]

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of the bytes from starts to ends; equal bytes (but for case) hash alike anywhere."""
        return mixed((self._sums[ends] - self._sums[starts]) * self._inverses[starts] + (ends - starts).astype(np.uint64))

    def owner(self, starts: np.ndarray) -> np.ndarray:
        """Number of the text that holds each position."""
        return np.searchsorted(self.ends, starts, side="right")


def buffers(texts: Sequence[bytes]) -> Iterator[tuple[int, Buffer]]:
    """Buffers of about BATCH bytes, each with the number of its first text."""
    first = size = 0
    for i, text in enumerate(texts):
        size += len(text) + 1
        if size >= BATCH or i == len(texts) - 1:
            yield first, Buffer(texts[first : i + 1])
            first, size = i + 1, 0


def stretches(batch: pa.RecordBatch, column: str = "text", size: int = BATCH) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """A batch cut into stretches of about size bytes of a text column, each with its texts; a null text is empty.

    Whoever yields per stretch holds one of them at a time, however many rows a batch has.
    """
    texts = batch.column(column)
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy() + 1)
    first = 0
    while first < batch.num_rows:
        start = ends[first - 1] if first else 0
        stop = min(batch.num_rows, int(np.searchsorted(ends, start + size)) + 1)
        yield batch.slice(first, stop - first), [t or "" for t in texts.slice(first, stop - first).to_pylist()]
        first = stop


def chunks(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[pa.RecordBatch, Buffer]]:
    """stretches with the buffer of each one's texts in UTF-8."""
    for part, texts in stretches(batch, column):
        yield part, Buffer([t.encode() for t in texts])


#: Numbers of a summed array that travel as one row, and tasks whose arrays are first added up together.
PART, FAN = 4096, 128


def summed(rows: DataFrame, arrays: Callable[[pa.RecordBatch], Iterable[np.ndarray]], width: int) -> np.ndarray:
    """Sum over all batches of rows of the arrays, of `width` 64-bit numbers, that a function makes of a batch.

    Tasks add up their own, FAN tasks' sums are added together, then all; width must not
    grow with the table, as the driver gets one array. Empty tables give zeros.
    """
    size = -(-width // PART)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros(size * PART), False
        for batch in batches:
            for a in arrays(batch):
                total[:width] += a
                some = True
        if some:
            whole = (total == np.rint(total)).all() and np.abs(total).max() < 2**31
            parts = total.astype(np.int32 if whole else np.float64).reshape(size, PART)
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], ["part", "sums"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(PART)
        for c in group["sums"]:
            total += np.frombuffer(c, np.int32 if len(c) == 4 * PART else np.float64)
        return pd.DataFrame({"part": group["part"].iloc[:1], "sums": [total.tobytes()]})

    fields = "part int, sums binary"
    per_task = map_batches(rows, run, fields).withColumn("fan", F.expr(f"spark_partition_id() div {FAN}"))
    out = np.zeros((size, PART))
    for part, sums in per_task.groupBy("part", "fan").applyInPandas(add, fields).groupBy("part").applyInPandas(add, fields).collect():  # width numbers
        out[part] = np.frombuffer(sums)
    return out.reshape(-1)[:width]
