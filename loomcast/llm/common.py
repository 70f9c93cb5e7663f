"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Bytes of text that a Python worker handles at once.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of a data folder, by any path that Spark reads."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds at most ``size`` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        first = 0
        while first < batch.num_rows:
            limit = (ends[first - 1] if first else 0) + size
            after = max(first + 1, int(np.searchsorted(ends, limit, side="right")))
            yield batch.slice(first, after - first)
            first = after
    release()


def release() -> None:
    """Give freed memory back to the system: this worker waits beside those of the next stage."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library only
    if trim:
        trim(0)


def byte_texts(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; null counts as the empty text."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def map_slices(df: DataFrame, work: Callable[[pa.RecordBatch], dict], schema: str, column: str = "text") -> DataFrame:
    """Rows of ``schema`` from ``work``, which gets a slice and returns its columns."""
    arrow = arrow_schema(schema)

    def run(batches):
        for part in slices(batches, column):
            made = work(part)
            yield pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def arrow_schema(schema: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(schema))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (public-domain splitmix64 constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))
#: Bytes that are hashed at once, but for longer words.
_PIECE = 1 << 15
_VALUE_OF = mixed(np.arange(1, 257, dtype=np.uint64) * _ODD)
_IN_WORD = np.ones(256, bool)
_IN_WORD[[9, 10, 11, 12, 13, 32]] = False


@lru_cache(maxsize=4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2 ** 64."""
    return tuple(np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size, x)])) for x in (_ODD, _INVERSE))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end byte of each word of a text's bytes; words end at ASCII white space."""
    inside = _IN_WORD[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(data) and inside[0]:
        edge = np.concatenate([[0], edge])
    if len(data) and inside[-1]:
        edge = np.concatenate([edge, [len(data)]])
    return edge[::2], edge[1::2]


def hashed_words(text: bytes) -> np.ndarray:
    """64-bit hash of each word of a text, A-Z lower-cased; words end at ASCII white space."""
    data = np.frombuffer(text.lower(), np.uint8)
    starts, ends = word_spans(data)
    if len(data) <= _PIECE:
        return _hashed(data, starts, ends)
    out, first = [], 0
    while first < len(starts):
        after = max(first + 1, int(np.searchsorted(ends, starts[first] + _PIECE, side="right")))
        at = starts[first]
        out.append(_hashed(data[at : ends[after - 1]], starts[first:after] - at, ends[first:after] - at))
        first = after
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes of stretches, from running sums."""
    power, back = _powers(max(_PIECE, len(data)))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE_OF[data] * power[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * back[starts])


def windows(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each window of ``width`` words; a shorter text counts as one window."""
    if not len(words):
        return words
    size = min(width, len(words))
    count = len(words) - size + 1
    weight = mixed(np.arange(1, size + 2, dtype=np.uint64) * _ODD + np.uint64(size)) | np.uint64(1)
    out = np.full(count, weight[size])
    for i in range(size):
        out += words[i : count + i] * weight[i]
    return mixed(out)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def crc32_joined(parts: list[tuple[int, int]]) -> int:
    """The crc32 of a text from (crc32, bytes) of its parts, in order."""
    out = 0
    for crc, size in parts:
        out = _shifted(out, size) ^ crc
    return out


def _shifted(crc: int, size: int) -> int:
    """The effect of ``size`` zero bytes on a crc32: one matrix for each bit of ``size``."""
    power = 0
    while size:
        if size & 1:
            crc = _times(_zero_bytes(power), crc)
        size >>= 1
        power += 1
    return crc


@lru_cache(maxsize=64)
def _zero_bytes(power: int) -> tuple[int, ...]:
    """The effect of 2 ** power zero bytes on each bit of a crc32, by squaring that of one bit."""
    if power > -3:
        half = _zero_bytes(power - 1)
        return tuple(_times(half, row) for row in half)
    return (0xEDB88320, *(1 << i for i in range(31)))


def _times(matrix: tuple[int, ...], vector: int) -> int:
    out = 0
    for row in matrix:
        if vector & 1:
            out ^= row
        vector >>= 1
    return out


def crc32_of(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
