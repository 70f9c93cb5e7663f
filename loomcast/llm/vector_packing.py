"""Best-fit packing of documents into sequences under several capacities at once.

A sequence has room for tokens, for documents, and for the cost of attention
within documents (the sum of squared lengths). A piece takes some of each; it
goes to the open sequence, among those where all three fit, that a score over
the residual capacities selects. Pieces are dealt into groups of bounded size,
each packed in one task in order of falling length.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.llm.byte_level import byte_level
from loomcast.llm.common import arrow_schema, byte_texts, crc32_of, slices
from loomcast.session import checkpoint

END_ID = 0
RULES = ("norm", "dot")
#: Short pieces of one group, on average; a group leaves about one sequence partly filled.
GROUP = 25_000
_CUT = "doc_id long, piece int, start long, length long, ids binary"
_PACKED = f"{_CUT}, sequence_id long, offset long"
_REPORT = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def best_fit(lengths: np.ndarray, capacities: tuple[int, int, int], weights: tuple[float, float, float], rule: str) -> np.ndarray:
    """Sequence of each piece, numbered from 0.

    Pieces are placed by falling length (ties in the given order). ``norm`` takes
    the sequence with the least weighted square norm of what is left after the
    piece, ``dot`` the one whose residual has the least weighted dot product with
    the piece, each as a share of its capacity; ties go to the older sequence. A
    new sequence is opened where no open one fits.
    """
    whole, weight = np.array(capacities, np.int64), np.array(weights)
    need = np.column_stack([lengths, np.ones(len(lengths), np.int64), lengths.astype(np.int64) ** 2])
    if len(need) and (need > whole).any():
        raise ValueError("a piece is larger than a sequence")
    out = np.zeros(len(lengths), np.int64)
    left = np.zeros((3, 64), np.int64)  # what is left in each open sequence, as numbered in ``names``
    names = np.zeros(64, np.int64)
    opened = count = 0
    order = np.argsort(-lengths, kind="stable")
    shortest = lengths.min() if len(lengths) else 0
    factor = weight / whole.astype(np.float64) ** 2
    for at, i in enumerate(order):
        piece = need[i]
        if at % 512 == 0:  # sequences that can take no further piece are closed
            usable = (left[0, :count] >= shortest) & (left[1, :count] > 0) & (left[2, :count] >= shortest**2)
            names[: usable.sum()], left[:, : usable.sum()] = names[:count][usable], left[:, :count][:, usable]
            count = int(usable.sum())
        rest = left[:, :count] - piece[:, None]
        fits = np.flatnonzero(rest.min(axis=0) >= 0) if count else ()
        if len(fits):
            if rule == "norm":
                score = factor @ (rest[:, fits].astype(np.float64) ** 2)
            else:
                score = (factor * piece) @ left[:, fits].astype(np.float64)
            best = fits[np.argmin(score)]
        else:
            if count == len(names):
                left, names = np.concatenate([left, np.zeros_like(left)], axis=1), np.concatenate([names, np.zeros_like(names)])
            best = count
            left[:, best], names[best] = whole, opened
            opened, count = opened + 1, count + 1
        left[:, best] -= piece
        out[i] = names[best]
    return out


def cut(docs: DataFrame, path: str, length: int) -> DataFrame:
    """Pieces of every document's ids with the end id: at most ``length`` each, only the first can be shorter."""
    schema = arrow_schema(_CUT)

    def run(batches):
        encoder = byte_level(path)
        end = np.array([END_ID], encoder.kind)
        for part in slices(batches):
            rows = []
            for doc, text in zip(part.column("doc_id").to_pylist(), byte_texts(part.column("text")), strict=True):
                ids = np.concatenate([encoder(text.decode("utf-8", "replace")), end])
                first = len(ids) % length or length
                starts = [0, *range(first, len(ids), length)]
                for piece, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
                    rows.append((doc, piece, a, b - a, ids[a:b].tobytes()))
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _CUT)


def pack_best_fit(
    docs: DataFrame,
    path: str,
    length: int = 2048,
    max_documents: int = 256,
    max_attention: int | None = None,
    rule: str = "norm",
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01),
    group: int = GROUP,
) -> DataFrame:
    """Pieces of documents with their ids and their place in sequences; one row per piece.

    A sequence holds at most ``length`` tokens, ``max_documents`` pieces and
    ``max_attention`` squared tokens of attention within pieces (by default
    ``length`` squared, which any filling keeps). ``weights`` are those of
    tokens, documents and attention in the score. Null and empty texts are the
    end id alone; null ids and repeated rows are documents of their own; very
    long texts are cut into whole sequences and one shorter first piece; an empty
    table has no pieces; other columns are not read. ``ids`` are unsigned
    little-endian integers, 16-bit where the vocabulary allows it.

    Pieces are written first, so that a lost executor neither encodes again nor
    deals a piece to another group. Pieces that fill a sequence have one to
    themselves, numbered below zero, and are not shuffled; the others are dealt
    to groups in turn, whatever their text, so that copies of one document spread
    over all of them.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    attention = length**2 if max_attention is None else max_attention
    capacities = (length, max_documents, attention)
    longest = min(length, math.isqrt(attention))  # a piece alone must fit
    pieces = checkpoint(cut(docs, path, longest)).withColumn("row", F.monotonically_increasing_id())
    short = pieces.filter(F.col("length") < length)  # of each document one, but where pieces are cut shorter
    groups = max(1, -(-short.count() // group))
    schema = arrow_schema(_PACKED)

    def run(key, rows):
        lengths = rows.column("length").to_numpy()
        sequence = best_fit(lengths, capacities, weights, rule)
        order = np.argsort(sequence, kind="stable")
        sorted_lengths = lengths[order]
        ends = np.cumsum(sorted_lengths)
        first = np.flatnonzero(np.diff(sequence[order], prepend=-1))
        base = np.repeat((ends - sorted_lengths)[first], np.diff([*first, len(order)]))
        offset = np.empty(len(order), np.int64)
        offset[order] = ends - sorted_lengths - base
        columns = [*(rows.column(f.name) for f in list(schema)[:5]), pa.array((key[0].as_py() << 32) + sequence), pa.array(offset)]
        return pa.Table.from_arrays(columns, schema=schema)

    packed = short.groupBy(F.pmod("row", F.lit(groups)).alias("dealt")).applyInArrow(run, _PACKED)
    whole = pieces.filter(F.col("length") == length).select(*schema.names[:5], (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(whole)


def packing_report(docs: DataFrame, path: str, length: int = 2048) -> DataFrame:
    """``pack_best_fit`` with the ids of each piece as their crc32 (of unsigned 32-bit integers)."""
    schema = arrow_schema(_REPORT)

    def run(batches):
        kind = byte_level(path).kind
        for batch in batches:
            crc = [crc32_of(np.frombuffer(x, kind)) for x in batch.column("ids").to_pylist()]
            columns = [pa.array(crc, pa.int64()) if f.name == "ids_crc32" else batch.column(f.name) for f in schema]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return pack_best_fit(docs, path, length).mapInArrow(run, _REPORT)
