"""Token counts from counts per pre-token.

No piece of the vocabulary joins two words over a space, so a text's tokens are
those of its pre-tokens: a run of spaces with the word after it. Pieces are
counted once per distinct pre-token and joined to each document's frequencies;
ids are never made. Frequent pre-tokens, of which there can be at most
``frequent``, are joined from a broadcast table; the others meet their counts in
shards by pre-token.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.llm.common import byte_texts, map_slices, slices
from loomcast.session import checkpoint

_BLANK = "▁".encode()
_MOST = 500_000
#: Bytes of text whose rare pre-tokens are sent to the shards together.
_SLICE = 16 << 20


def pre_tokens(text: bytes) -> list[bytes]:
    """Words with all but one of the spaces before them; a trailing run has no word."""
    if not text:
        return []
    parts = text.replace(_BLANK, b" ").split(b" ")
    if b"" not in parts:
        return parts
    out, spaces = [], 0
    for part in parts:
        if part:
            out.append(b" " * spaces + part)
            spaces = 0
        else:
            spaces += 1
    if spaces:
        out.append(b" " * (spaces - 1))
    return out


class PieceCounts(dict):
    """Number of pieces of each pre-token, counted when first asked for."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = map(self.model.id_to_piece, range(self.model.get_piece_size()))
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece of this vocabulary spans words")

    def __missing__(self, token: bytes) -> int:
        if len(self) >= _MOST:
            self.clear()
        # the library puts one space before a text; a lone trailing space is one piece
        self[token] = out = len(self.model.encode(token.decode("utf-8", "replace"))) if token else 1
        return out


_LOADED: dict[str, PieceCounts] = {}


def piece_counts(path: str) -> PieceCounts:
    if path not in _LOADED:
        _LOADED[path] = PieceCounts(path)
    return _LOADED[path]


def frequent_counts(texts: DataFrame, path: str, frequent: int) -> dict[bytes, int]:
    """Pieces of the pre-tokens that make up at least 1 / ``frequent`` of all occurrences.

    One that does so overall does so in some slice, so slices report only those;
    the result has at most ``frequent`` entries whatever the input.
    """

    def work(part):
        found = Counter()
        for t in byte_texts(part.column("text")):
            found.update(pre_tokens(t))
        total = sum(found.values())
        some = [(t, n) for t, n in found.items() if n * frequent >= total]
        return {"token": [None, *(t for t, _ in some)], "n": [total, *(n for _, n in some)]}

    sums = map_slices(texts, work, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))
    sums = checkpoint(sums)
    total = sums.filter("token is null").agg(F.sum("n")).first()[0] or 0
    chosen = sums.filter(F.col("token").isNotNull() & (F.col("n") * frequent >= total)).select("token")

    def count(batches):
        for b in batches:
            tokens = b.column("token").to_pylist()
            n = [piece_counts(path)[t] for t in tokens]
            yield pa.RecordBatch.from_arrays([b.column("token"), pa.array(n, pa.int64())], names=["token", "pieces"])

    rows = chosen.mapInArrow(count, "token binary, pieces long").collect()
    return {bytes(r.token): r.pieces for r in rows}


def token_counts(
    docs: DataFrame, path: str, limit: int = 4096, frequent: int = 100_000, shards: int | None = None
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_tokens, over_limit.

    Null and empty texts have no tokens; null ids and repeated rows are kept as
    rows of their own; other columns are not read. ``shards`` is the number of
    groups of rare pre-tokens, by default that of shuffle partitions.
    """
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    known = spark.sparkContext.broadcast(frequent_counts(texts, path, frequent))
    names = ["slice", "shard", "a", "b", "c", "d"]
    kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 4]

    def row_of(*values):
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names)

    def run(batches):
        # a slice's documents are one row with shard null, its rare pre-tokens one row per shard
        number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        look, press = known.value, zstandard.ZstdCompressor(level=1).compress
        for part in slices(batches, size=_SLICE):
            rare = defaultdict(list)  # pre-token -> document, times, document, times, ...
            own, size = [], []
            for i, t in enumerate(byte_texts(part.column("text"))):
                total = 0
                for token, n in Counter(pre_tokens(t)).items():
                    pieces = look.get(token)
                    if pieces is None:
                        rare[token] += (i, n)
                    else:
                        total += n * pieces
                own.append(total)
                size.append(len(t))
            docs = part.column("doc_id")
            ids = (docs.fill_null(0).to_numpy(zero_copy_only=False), size, own)
            absent = docs.is_null().to_numpy(zero_copy_only=False).astype(np.uint8)
            yield row_of(number, None, *(press(np.array(x, np.int64).tobytes()) for x in ids), press(absent.tobytes()))
            by_shard = defaultdict(list)
            for token in rare:
                by_shard[xxhash.xxh32_intdigest(token) % shards].append(token)
            for shard, tokens in by_shard.items():
                where = [np.array(rare[t], np.int32) for t in tokens]
                counts = np.array([len(w) // 2 for w in where], np.int32)
                joined = b" ".join(t.replace(b" ", b"\xff") for t in tokens)
                yield row_of(number, shard, press(joined), press(np.concatenate(where).tobytes()), press(counts.tobytes()), None)
            number += 1

    def meet(batches):
        """Pieces of each slice's rare pre-tokens, summed per document of the slice."""
        expand, press = zstandard.ZstdDecompressor().decompress, zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            for number, t, r, c in zip(*(b.column(x).to_pylist() for x in ("slice", "a", "b", "c")), strict=True):
                tokens = [x.replace(b"\xff", b" ") for x in expand(t).split(b" ")]
                pieces = np.fromiter(map(piece_counts(path).__getitem__, tokens), np.int64, len(tokens))
                at = np.frombuffer(expand(r), np.int32).reshape(-1, 2)
                sums = np.bincount(at[:, 0], at[:, 1] * np.repeat(pieces, np.frombuffer(expand(c), np.int32)))
                yield row_of(number, 0, press(sums.astype(np.int64).tobytes()), None, None, None)

    def finish(batches):
        """Documents of the slices of one part, with all sums added."""
        expand = zstandard.ZstdDecompressor().decompress
        sums: dict[int, np.ndarray] = {}
        heads = {}
        for b in batches:
            for row in b.to_pylist():
                number = row["slice"]
                if row["shard"] is None:
                    heads[number] = [np.frombuffer(expand(row[x]), np.uint8 if x == "d" else np.int64) for x in "abcd"]
                    continue
                more = np.frombuffer(expand(row["a"]), np.int64)
                have = sums.get(number, np.zeros(0, np.int64))
                if len(have) < len(more):
                    have = np.pad(have, (0, len(more) - len(have)))
                have[: len(more)] += more
                sums[number] = have
        for number, (ids, size, own, absent) in heads.items():
            total = own.copy()
            more = sums.get(number, total[:0])
            total[: len(more)] += more
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, mask=absent.astype(bool)), pa.array(size), pa.array(total), pa.array(total > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    schema = "slice long, shard int, a binary, b binary, c binary, d binary"
    parts = checkpoint(texts.mapInArrow(run, schema))
    sums = parts.filter("shard is not null").repartition(shards, "shard").mapInArrow(meet, schema)
    every = parts.filter("shard is null").union(sums)
    return every.repartition(shards, "slice").mapInArrow(finish, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
