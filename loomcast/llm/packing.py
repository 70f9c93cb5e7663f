"""Packing of documents into sequences along a space-filling curve.

Each document's ids are hashed into a vector and projected to a few dimensions;
its place on a Hilbert curve through them is a sort key. Documents are sorted by
key over ranges, and neighbours are packed into the same sequences.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.llm.common import arrow_schema, byte_texts, crc32_of, mixed, release, slices
from loomcast.llm.tokens import with_end, word_ids
from loomcast.session import checkpoint

DIMENSIONS = 4
_BITS = 8
_IDS = "doc_id long, key long, crc long, ids binary"
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


def hilbert_key(points: np.ndarray, bits: int = _BITS) -> np.ndarray:
    """Distance along the Hilbert curve of points (n, d) of ``bits``-bit integers.

    Gray-code form of the curve (Skilling 2004): undo excess work from the top
    bit down, then Gray-encode, then read the bits of all dimensions in turn.
    """
    x = points.astype(np.int64).T.copy()
    d = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(d):
            flip = (x[i] & q) > 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(flip, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = top
    while q > 1:
        turn ^= np.where(x[d - 1] & q, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def _projection() -> np.ndarray:
    """A direction for each hashed id: pseudo-random numbers from -1 to 1."""
    ids = np.arange(1 << 16, dtype=np.uint64)
    columns = [mixed(ids * np.uint64(2 * DIMENSIONS) + np.uint64(2 * i + 1)) for i in range(DIMENSIONS)]
    return np.column_stack([(c >> np.uint64(11)).astype(np.float64) / (1 << 52) - 1 for c in columns])


def curve_keys(ids: list[np.ndarray], projection: np.ndarray) -> np.ndarray:
    """Hilbert keys of documents: the mean direction of their ids, scaled by the root of their number."""
    ends = np.cumsum([len(x) for x in ids])
    sums = np.add.reduceat(projection[np.concatenate(ids)], np.concatenate([[0], ends[:-1]]), axis=0)
    scaled = np.tanh(sums / np.sqrt(np.diff(ends, prepend=0))[:, None])
    return hilbert_key(np.minimum((scaled + 1) / 2 * (1 << _BITS), (1 << _BITS) - 1).astype(np.int64))


def document_vectors(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, key, crc and ids (16-bit, with the end id) of every row of ``docs`` (doc_id, text)."""
    schema = arrow_schema(_IDS)

    def run(batches):
        projection = _projection()
        for part in slices(batches):
            ids = [with_end(x) for x in word_ids(path)(byte_texts(part.column("text")))]
            columns = (part.column("doc_id"), curve_keys(ids, projection), [crc32_of(x) for x in ids], [x.tobytes() for x in ids])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(run, _IDS)


def pack(docs: DataFrame, path: str, length: int = 2048, parts: int | None = None) -> DataFrame:
    """Pieces of documents in sequences of ``length`` ids; one row per piece.

    Neighbours on the curve follow each other and are cut wherever a sequence is
    full, so only the end of each part of the curve is short: it is cut into
    sequences whose lengths are powers of two and need no padding. Null and
    empty texts are the end id alone; null ids and repeated rows are documents of
    their own; an empty table has no pieces. ``ids`` holds the piece itself.
    """
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the ranges are found from a sample of the keys, so ids are made once and kept
    vectors = checkpoint(document_vectors(docs, path))
    order = [F.col("key"), F.col("crc"), F.col("doc_id").asc_nulls_first()]
    sorted_docs = vectors.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    schema = arrow_schema(_PIECES)

    def run(batches):
        sequence = TaskContext.get().partitionId() << 32
        waiting: list[tuple] = []  # (doc, first id, ids, doc's ids) of the sequence that is filling
        room = length
        for batch in batches:
            out = []
            for doc, raw in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                ids, at = np.frombuffer(raw, np.uint16), 0
                while at < len(ids):
                    size = min(room, len(ids) - at)
                    waiting.append((doc, at, ids[at : at + size], len(ids)))
                    at += size
                    room -= size
                    if not room:
                        out += rows(waiting, sequence)
                        sequence, waiting, room = sequence + 1, [], length
            yield made(out)
        out = []
        left = length - room
        while left:  # the end of this part, in powers of two
            size = 1 << (left.bit_length() - 1)
            head, waiting = split(waiting, size)
            out += rows(head, sequence)
            sequence += 1
            left -= size
        yield made(out)
        release()

    def split(pieces, size):
        head, tail = [], []
        for doc, at, ids, total in pieces:
            take = min(size, len(ids))
            if take:
                head.append((doc, at, ids[:take], total))
            if take < len(ids):
                tail.append((doc, at + take, ids[take:], total))
            size -= take
        return head, tail

    def rows(pieces, sequence):
        offset = 0
        for doc, at, ids, total in pieces:
            yield (doc, at, len(ids), crc32_of(ids), total, sequence, offset, ids.tobytes())
            offset += len(ids)

    def made(out):
        columns = list(zip(*out, strict=True)) or [()] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return sorted_docs.mapInArrow(run, _PIECES)
