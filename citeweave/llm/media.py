"""Netpbm and BMP images: decoding, area resizing by integral images, NPY tiles, difference hashes."""

from __future__ import annotations

import hashlib
import io
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.llm.hashing import stretches
from citeweave.llm.shared import documents, map_batches

#: Images that a task holds decoded features of at a time.
IMAGES = 64
#: A header field of Netpbm, with the white space and comments before it.
_FIELD = re.compile(rb"(?:[ \t\r\n\v\f]|#[^\r\n]*[\r\n])*([0-9]+)")
_CHANNELS = {b"P1": 1, b"P2": 1, b"P3": 3, b"P4": 1, b"P5": 1, b"P6": 3}


def decode_netpbm(data: bytes) -> np.ndarray:
    """P1 to P6 as (height, width) or (height, width, 3); bitmaps as 0 and 255, samples over 8 bits as uint16."""
    kind = data[:2]
    if kind not in _CHANNELS:
        raise ValueError("not a Netpbm image")
    at, fields = 2, []
    for _ in range(2 if kind in (b"P1", b"P4") else 3):
        if not (m := _FIELD.match(data, at)):
            raise ValueError("broken Netpbm header")
        if len(m[1]) > 9:
            raise ValueError("broken Netpbm header")
        fields.append(int(m[1]))
        at = m.end()
    width, height, most = *fields[:2], fields[2] if len(fields) > 2 else 1
    if not (width and height and 0 < most < 65536):
        raise ValueError("broken Netpbm header")
    shape = (height, width, 3) if _CHANNELS[kind] == 3 else (height, width)
    count = height * width * _CHANNELS[kind]
    if count > 8 * len(data):
        raise ValueError("more pixels than data")
    if kind == b"P4":
        packed = np.frombuffer(data, np.uint8, height * -(-width // 8), at + 1)
        return (1 - np.unpackbits(packed.reshape(height, -1), axis=1)[:, :width]) * np.uint8(255)
    if kind == b"P1":
        bits = np.frombuffer(re.sub(rb"#[^\r\n]*|[^01]", b"", data[at:]), np.uint8)[:count] - 48
        if len(bits) < count:
            raise ValueError("a sample is missing or out of range")
        return ((1 - bits) * np.uint8(255)).reshape(shape)
    wide = np.dtype(">u2") if most > 255 else np.dtype(np.uint8)
    if kind in (b"P2", b"P3"):
        words = re.sub(rb"#[^\r\n]*", b"", data[at:]).split()[:count]
        if any(len(w) > 9 for w in words):
            raise ValueError("a sample is over the maximum")
        samples = np.array(words, dtype=np.int64)
    else:
        samples = np.frombuffer(data, wide, count, at + 1)
    if len(samples) < count or samples.min() < 0 or samples.max() > most:
        raise ValueError("a sample is missing or out of range")
    return samples.astype(np.uint16 if most > 255 else np.uint8).reshape(shape)


def decode_bmp(data: bytes) -> np.ndarray:
    """Uncompressed BMP of 1, 4, 8, 24 or 32 bits a pixel as (height, width, 3) in RGB."""
    if data[:2] != b"BM":
        raise ValueError("not a BMP image")
    start, header = (int.from_bytes(data[i : i + 4], "little") for i in (10, 14))
    if header < 40:
        raise ValueError("BMP header kind not supported")
    width, height = (int.from_bytes(data[i : i + 4], "little", signed=True) for i in (18, 22))
    depth, packing = int.from_bytes(data[28:30], "little"), int.from_bytes(data[30:34], "little")
    if packing or depth not in (1, 4, 8, 24, 32) or width <= 0 or not height:
        raise ValueError("BMP kind not supported")
    stride = (width * depth + 31) // 32 * 4
    if start + stride * abs(height) > len(data):
        raise ValueError("more pixels than data")
    rows = np.frombuffer(data, np.uint8, stride * abs(height), start).reshape(abs(height), stride)
    rows = rows if height < 0 else rows[::-1]
    if depth >= 24:
        return rows[:, : width * depth // 8].reshape(abs(height), width, depth // 8)[:, :, 2::-1].copy()
    bits = np.unpackbits(rows, axis=1).reshape(abs(height), -1, depth)[:, :width]
    index = (bits * (1 << np.arange(depth - 1, -1, -1))).sum(axis=2)
    colours = int.from_bytes(data[46:50], "little") or 1 << depth
    if 14 + header + 4 * colours > len(data):
        raise ValueError("broken BMP palette")
    palette = np.frombuffer(data, np.uint8, 4 * colours, 14 + header).reshape(-1, 4)
    if index.max() >= colours:
        raise ValueError("a pixel is outside the palette")
    return palette[index][:, :, 2::-1].copy()


def decode_image(data: bytes) -> np.ndarray:
    return decode_bmp(data) if data[:2] == b"BM" else decode_netpbm(data)


def encode_pgm(samples: bytes, width: int) -> bytes:
    """8-bit samples as a binary greyscale Netpbm image. Their number must be a positive multiple of width."""
    if not samples or len(samples) % width:
        raise ValueError("samples must fill whole rows")
    return b"P5\n%d %d\n255\n" % (width, len(samples) // width) + samples


def area_resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Mean of the area that each new pixel covers, from the integral image; parts of pixels count by their area."""
    if image.ndim == 3:
        return np.stack([area_resize(image[:, :, k], height, width) for k in range(image.shape[2])], axis=2)
    integral = np.zeros((image.shape[0] + 1, image.shape[1] + 1))
    np.cumsum(np.cumsum(image, axis=0, dtype=np.float64), axis=1, out=integral[1:, 1:])

    def at_edges(table: np.ndarray, parts: int) -> np.ndarray:
        edges = np.arange(parts + 1) * ((table.shape[0] - 1) / parts)
        low = np.minimum(edges.astype(np.int64), table.shape[0] - 2)
        return table[low] + (edges - low)[:, None] * (table[low + 1] - table[low])

    corners = at_edges(at_edges(integral, height).T, width).T
    sums = corners[1:, 1:] - corners[:-1, 1:] - corners[1:, :-1] + corners[:-1, :-1]
    return sums * (height * width / (image.shape[0] * image.shape[1]))


def grey(image: np.ndarray) -> np.ndarray:
    return image if image.ndim == 2 else image[:, :, :3] @ np.array([0.299, 0.587, 0.114])


def npy_tile(image: np.ndarray, height: int, width: int) -> bytes:
    """The image resized to height x width as the bytes of an NPY file of uint8."""
    out = io.BytesIO()
    scale = 255 / 65535 if image.dtype == np.uint16 else 1
    np.save(out, np.clip(np.rint(area_resize(image, height, width) * scale), 0, 255).astype(np.uint8), allow_pickle=False)
    return out.getvalue()


def difference_hash(image: np.ndarray) -> str:
    """64 bits, as 16 hex digits: whether each of 8 x 9 area means is over its left neighbour."""
    small = np.round(area_resize(grey(image), 8, 9), 6)
    return np.packbits(small[:, 1:] > small[:, :-1]).tobytes().hex()


def media_features(df: DataFrame, id_col: str, data_col: str, tile: tuple[int, int] = (32, 32)) -> DataFrame:
    """Decode a binary column of Netpbm and BMP images.

    Returns id, height, width, channels, npy (tile as NPY bytes), dhash and error. Null
    or broken images give null values and an error text, never a failure. Repeated rows
    stay; other columns are not carried. Rows are independent: nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, IMAGES):
                part, out = batch.slice(first, IMAGES), []
                for data in part.column("data"):
                    try:
                        image = decode_image(data.as_py() or b"")
                        out.append((*image.shape[:2], image.shape[2] if image.ndim == 3 else 1, npy_tile(image, *tile), difference_hash(image), None))
                    except ValueError as e:
                        out.append((None, None, None, None, None, str(e)))
                kinds = [pa.int64()] * 3 + [pa.binary(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([part.column("id"), *(pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True))], ["id", "height", "width", "channels", "npy", "dhash", "error"])

    kind = df.schema[id_col].dataType.simpleString()
    out = map_batches(df.select(F.col(id_col).alias("id"), F.col(data_col).alias("data")), run, f"id {kind}, height long, width long, channels long, npy binary, dhash string, error string")
    return out.withColumnRenamed("id", id_col)


#: Bytes that a payload is a multiple of, and the width of the stored image.
UNIT, WIDTH = 576, 24


#: Columns of store_texts.
STORED = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, tile binary"


def store_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text's bytes, padded, as a greyscale image: what is read back from it, its digests, difference hash and 8 x 8 NPY tile.

    Null and empty texts are one unit of padding. Equal texts give equal values; each row
    is treated by itself, repeated ones stay, ids (null ones too) pass untouched, other columns are not carried.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in (x for batch in batches for x in stretches(batch)):
            out = []
            for text in texts:
                raw = text.encode()
                payload = raw + b"\xff" * (-len(raw) % UNIT if raw else UNIT)
                stored = encode_pgm(payload, WIDTH)
                image = decode_image(stored)
                back, tile = image.tobytes(), npy_tile(image, 8, 8)
                feature = f"{difference_hash(image)}:{hashlib.sha256(tile).hexdigest()[:16]}"
                out.append((len(raw), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-32:]), len(stored), hashlib.sha256(stored).hexdigest(), feature, tile))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True))], ["doc_id", *(x.split()[0] for x in STORED.split(", "))])

    return map_batches(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, {STORED}")


def op8_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store_texts(documents(spark, sf_dir))
