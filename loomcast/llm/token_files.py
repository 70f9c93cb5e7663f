"""Token ids of documents in files of range-coded blocks.

A file is a table of blocks: ``part`` and ``block`` give their order, ``n_ids``
and ``crc32`` check the ids, ``payload`` is the block's code, and the list
``pieces`` says which stretch of which document each part of the block is. Every
block can be read alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.llm.common import arrow_schema, byte_texts, crc32_joined, crc32_of, slices
from loomcast.llm.range_coder import BLOCK, decode_blocks, encode_blocks
from loomcast.llm.tokens import with_end, word_ids
from loomcast.session import checkpoint

_LANES = 1536
_PIECES = (
    "array<struct<ordinal:long,doc_id:long,doc_start:long,doc_tokens:long,offset:long,length:long>>"
)
_FILE = f"part long, block long, n_ids long, crc32 long, payload binary, pieces {_PIECES}"
_FOUND = "part long, ordinal long, doc_id long, doc_start long, doc_tokens long, offset long, length long, crc32 long"


def in_order(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Whole texts in ascending doc_id order (null first, ties by text), in parts of the order.

    Rows with equal ids are spread by their texts' hashes.
    """
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    return texts.repartitionByRange(parts, *order).sortWithinPartitions(*order, "text")


def encoded(docs: DataFrame, path: str, block: int = BLOCK) -> DataFrame:
    """The blocks of the ids of ``docs`` (doc_id, text), each document closed by the end id.

    Null and empty texts hold the end id alone; null ids come first; rows that
    share an id are documents of their own; an empty table has no blocks.
    """

    def run(batches):
        part = TaskContext.get().partitionId()
        ids_of = word_ids(path)
        made: list[tuple[np.ndarray, list]] = []
        open_ids: list[np.ndarray] = []
        open_pieces: list = []
        room, ordinal, start, number = block, 0, 0, 0
        for rows in slices(batches):
            docs = rows.column("doc_id").to_pylist()
            for doc, ids in zip(docs, map(with_end, ids_of(byte_texts(rows.column("text")))), strict=True):
                offset = 0
                while offset < len(ids):
                    size = min(room, len(ids) - offset)
                    open_ids.append(ids[offset : offset + size])
                    open_pieces.append((ordinal, doc, start, len(ids), offset, size))
                    offset += size
                    room -= size
                    if not room:
                        made.append((np.concatenate(open_ids), open_pieces))
                        open_ids, open_pieces, room = [], [], block
                    if len(made) == _LANES:
                        yield written(part, number, made)
                        number += len(made)
                        made = []
                ordinal += 1
                start += len(ids)
        if open_ids:
            made.append((np.concatenate(open_ids), open_pieces))
        if made:
            yield written(part, number, made)

    arrow = arrow_schema(_FILE)
    names = ("ordinal", "doc_id", "doc_start", "doc_tokens", "offset", "length")

    def written(part, number, made):
        ids = [x for x, _ in made]
        columns = (
            [part] * len(made),
            range(number, number + len(made)),
            [len(x) for x in ids],
            [crc32_of(x) for x in ids],
            encode_blocks(ids),
            [[dict(zip(names, p, strict=True)) for p in pieces] for _, pieces in made],
        )
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return in_order(docs).mapInArrow(run, _FILE)


def decoded(blocks: DataFrame) -> DataFrame:
    """Pieces of documents with the crc32 of their ids; a block that fails its checksum is an error."""

    arrow = arrow_schema(_FOUND)

    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, _LANES):
                rows = batch.slice(first, _LANES).to_pylist()
                found = []
                for row, ids in zip(rows, decode_blocks([r["payload"] for r in rows], [r["n_ids"] for r in rows]), strict=True):
                    if crc32_of(ids) != row["crc32"]:
                        raise ValueError(f"block {row['block']} of part {row['part']} is damaged")
                    at = 0
                    for p in row["pieces"]:
                        found.append(p | {"part": row["part"], "crc32": crc32_of(ids[at : at + p["length"]])})
                        at += p["length"]
                yield pa.RecordBatch.from_pylist(found, schema=arrow)

    return blocks.mapInArrow(run, _FOUND)


def document_ids(blocks: DataFrame) -> DataFrame:
    """One row per document of a token file: doc_id, start, n_tokens, ids_crc32."""
    pieces = decoded(blocks)
    docs = pieces.groupBy("part", "ordinal").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("doc_start").alias("doc_start"),
        F.max("doc_tokens").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("offset", "crc32", "length"))).alias("pieces"),
    )
    # ids of the parts before: one row per part, from the block headers alone
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).groupBy().agg(
        F.sort_array(F.collect_list(F.struct("part", "n"))).alias("totals")
    )
    before = totals.select(
        F.map_from_entries(
            F.transform(
                "totals",
                lambda x: F.struct(
                    x["part"].alias("part"),
                    F.aggregate(
                        F.filter("totals", lambda y: y["part"] < x["part"]), F.lit(0).cast("long"), lambda s, y: s + y["n"]
                    ).alias("n"),
                ),
            )
        )
    ).scalar()

    def run(batches):
        for b in batches:
            crc = [
                p[0]["crc32"] if len(p) == 1 else crc32_joined([(x["crc32"], 4 * x["length"]) for x in p])
                for p in b.column("pieces").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("start"), b.column("n_tokens"), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return (
        docs.withColumn("before", before)
        .select("doc_id", (F.element_at("before", F.col("part")) + F.col("doc_start")).alias("start"), "n_tokens", "pieces")
        .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
    )


def write_and_read(docs: DataFrame, path: str) -> DataFrame:
    """Writes the token file to the shared folder and reports what reading it gives."""
    return document_ids(checkpoint(encoded(docs, path)))
