"""Alignment of two tokenizers over a corpus, each distinct text once.

Documents are shuffled by their full text; a distinct text is encoded by both
tokenizers and aligned by bytes once, and its pair counts weigh as often as the
text occurs. Two tokens are linked where their byte ranges overlap; byte offsets
where tokens of both end cut the text into groups. The counts of all pairs go
back to the texts and the texts' measures to the documents.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.llm.byte_level import byte_level
from loomcast.llm.common import arrow_schema, byte_texts, slices
from loomcast.session import checkpoint

#: Pairs whose counts are sent to every task, at most: those with at least this share of all links.
FREQUENT = 500_000
#: Texts whose measures are sent to every task, at most: those with at least this share of all documents.
HOT = 1000
#: Bytes of text that are aligned at once; each takes about 100 bytes of memory.
_SLICE = 1 << 20
_BLANK = "▁"
_PAIR = 1 << 32
_MEASURES = ("n_a", "n_b", "n_groups", "n_links")
_ALIGNED = f"key binary, n long, {', '.join(f'{m} long' for m in _MEASURES)}, groups_sha256 string, pairs array<long>, times array<long>"
_FOUND = "key binary, n_best long, count_sum long, pairs array<long>, times array<long>"


class Pieces:
    """Encoder of a ``sentencepiece`` file and the bytes of its pieces."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = m.get_piece_size()
        piece = [m.id_to_piece(i) for i in range(self.size)]
        byte = [bytes([int(p[3:5], 16)]) if m.is_byte(i) else p.replace(_BLANK, " ").encode() for i, p in enumerate(piece)]
        self.bytes_of = dict(enumerate(byte))

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


_LOADED: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """The encoder of this worker, loaded once; it keeps no texts."""
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


class Aligner:
    """Aligned tokens of texts under a byte-level tokenizer (A) and one of pieces (B)."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = byte_level(path_a, plain=True), pieces(path_b)
        size = max(self.a.size, self.b.size)
        self._width_a, self._width_b = (self._widths(e, size) for e in (self.a, self.b))
        # an id as text with what follows it in a digest: a token of its side, the other side, a group
        self._after = [f"{i}{sign}" for sign in ",|;" for i in range(size)]
        self._size = size

    @staticmethod
    def _widths(encoder, size: int) -> np.ndarray:
        out = np.zeros(size, np.int64)
        out[list(encoder.bytes_of)] = list(map(len, encoder.bytes_of.values()))
        return out

    def ids(self, texts: list[bytes]) -> tuple[list, list]:
        """Ids of both for each text; none where a tokenizer's bytes are not those of a space and the text."""
        known = [t.decode("utf-8", "replace") for t in texts]
        a = [self.a(" " + t).tolist() if t else [] for t in known]
        b = self.b(known)
        for i, text in enumerate(texts):
            want = b" " + text
            if not text or any(b"".join([e.bytes_of.get(x, b"") for x in ids]) != want for e, ids in ((self.a, a[i]), (self.b, b[i]))):
                a[i] = b[i] = []
        return a, b

    def __call__(self, texts: list[bytes]) -> list[tuple]:
        """(n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) of each text; pairs are distinct and sorted."""
        ids_a, ids_b = self.ids(texts)
        a, b = (np.concatenate([np.array(ids, np.int64) for ids in side] or [np.zeros(0, np.int64)]) for side in (ids_a, ids_b))
        end_a, end_b = np.cumsum(self._width_a[a]), np.cumsum(self._width_b[b])
        mark = np.zeros((end_a[-1] if len(a) else 0) + 1, np.uint8)  # 1: a token of A ends here, 2: of B
        mark[end_a] = 1
        mark[end_b] |= 2
        # each stretch between two ends lies in one token of each side, and is their one common stretch
        ends = np.flatnonzero(mark)
        kind = mark[ends].astype(np.int64)
        of_a, of_b = np.cumsum(kind & 1), np.cumsum(kind >> 1)
        pair = a[of_a - (kind & 1)] * _PAIR + b[of_b - (kind >> 1)] if len(ends) else ends
        common = kind == 3
        groups = np.concatenate([[0], np.cumsum(common)])
        # order of the digest: the group's tokens of A, then those of B
        last_a, last_b = mark[end_a] == 3, mark[end_b] == 3
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        code = np.zeros(len(a) + len(b), np.int64)
        code[np.arange(len(a)) + np.concatenate([[0], of_b[common]])[group_a]] = a + self._size * last_a
        code[np.arange(len(b)) + (of_a[common][group_b] if len(b) else 0)] = b + 2 * self._size * last_b
        out, at_a, at_b, at = [], 0, 0, 0
        for own_a, own_b in zip(ids_a, ids_b, strict=True):
            first, first_code = at, at_a + at_b
            at_a, at_b = at_a + len(own_a), at_b + len(own_b)
            at = int(np.searchsorted(ends, end_a[at_a - 1], side="right")) if own_a else first
            distinct, times = np.unique(pair[first:at], return_counts=True)
            text = "".join(map(self._after.__getitem__, code[first_code : at_a + at_b].tolist()))[:-1]
            digest = hashlib.sha256(text.encode()).hexdigest() if own_a else ""
            out.append((len(own_a), len(own_b), int(groups[at] - groups[first]), at - first, digest, distinct, times))
        return out


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


def _key():
    return F.unhex(F.sha2(F.col("text").cast("binary"), 256))


def aligned_texts(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per distinct text that is not null or empty: its key (sha256), number of documents, measures and pairs."""
    schema = arrow_schema(_ALIGNED)

    def run(batches):
        align = _aligner(path_a, path_b)
        for part in slices(batches, size=_SLICE):
            columns = [part.column("key"), part.column("n"), *zip(*align(byte_texts(part.column("text"))), strict=True)]
            arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    texts = docs.select(F.col("text").cast("string").alias("text")).filter("text != ''")
    distinct = texts.groupBy("text").agg(F.count(F.lit(1)).alias("n"))
    return distinct.select(_key().alias("key"), "n", "text").mapInArrow(run, _ALIGNED)


def _pairs_and_times(batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs of a batch with their times, and how many each text has."""
    pairs, times = batch.column("pairs"), batch.column("times")
    size = pairs.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return pairs.flatten().to_numpy(zero_copy_only=False), times.flatten().to_numpy(zero_copy_only=False), size


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, total, best): links of each pair over all documents; whether no pair of its B id has more."""
    schema = arrow_schema("pair long, total long")

    def run(batches):
        for batch in batches:
            pair, times, size = _pairs_and_times(batch)
            weight = times * np.repeat(batch.column("n").to_numpy(zero_copy_only=False), size)
            order = np.argsort(pair, kind="stable")
            found, first = np.unique(pair[order], return_index=True)
            total = np.add.reduceat(weight[order], first) if len(found) else found
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total, pa.int64())], schema=schema)

    parts = aligned.select("n", "pairs", "times").mapInArrow(run, "pair long, total long")
    totals = checkpoint(parts.groupBy("pair").agg(F.sum("total").alias("total")))
    of_b = F.col("pair") % _PAIR
    most = totals.groupBy(of_b.alias("b")).agg(F.max("total").alias("most"))
    return totals.join(most, of_b == F.col("b")).select("pair", "total", (F.col("total") == F.col("most")).alias("best"))


def _with_counts(aligned: DataFrame, counts: DataFrame, frequent: int) -> DataFrame:
    """(key, n_best, count_sum) of each text, in one or more parts that add up.

    A frequent pair's count is looked up in a table of at most ``frequent``
    entries that every task has; the others, none of which holds a larger share
    of all links, are joined.
    """
    spark = aligned.sparkSession
    links = counts.agg(F.sum("total")).first()[0] or 0
    known = counts.filter(F.col("total") >= F.lit(links) / frequent).orderBy("pair").toArrow()
    names = ("pair", "total", "best")
    share = spark.sparkContext.broadcast([known.column(c).to_numpy() for c in names])
    schema = arrow_schema(_FOUND)

    def run(batches):
        pair_of, total, best = share.value
        for batch in batches:
            pair, times, size = _pairs_and_times(batch)
            text = np.repeat(np.arange(len(size)), size)
            at = np.minimum(np.searchsorted(pair_of, pair), max(len(pair_of) - 1, 0))
            hit = pair_of[at] == pair if len(pair_of) else np.zeros(len(pair), bool)
            sums = []
            for value in (best, total):
                sums.append(np.zeros(len(size), np.int64))
                np.add.at(sums[-1], text[hit], times[hit] * value[at[hit]].astype(np.int64))
            left = np.concatenate([[0], np.cumsum(np.bincount(text[~hit], minlength=len(size)))])
            rest = [pa.ListArray.from_arrays(pa.array(left, pa.int32()), pa.array(x[~hit], pa.int64())) for x in (pair, times)]
            columns = [batch.column("key"), *(pa.array(s) for s in sums), *rest]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    found = checkpoint(aligned.select("key", "pairs", "times").mapInArrow(run, _FOUND))
    rare = found.select("key", F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    rare = rare.select("key", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times")).join(counts, "pair")
    value = [F.col("times") * F.col("best").cast("long"), F.col("times") * F.col("total")]
    return found.select("key", "n_best", "count_sum").union(rare.select("key", *value))


def aligned_documents(docs: DataFrame, path_a: str, path_b: str, frequent: int = FREQUENT, hot: int = HOT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id and the measures of its text.

    ``n_a`` and ``n_b`` tokens, ``n_groups``, ``n_links``, ``n_best`` links whose
    count in the corpus is the highest of their B id, ``count_sum`` of the
    counts of all links, ``groups_sha256``. Texts that are null or empty, or that
    a tokenizer does not give back byte by byte, have no tokens: zeros and an
    empty digest. Null ids and repeated rows are kept as rows of their own; a
    very long text is one unit of work; an empty table gives no rows; other
    columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    aligned = checkpoint(aligned_texts(rows, path_a, path_b))
    counts = checkpoint(pair_counts(aligned))
    parts = _with_counts(aligned, counts, frequent)
    sums = parts.groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    columns = [*_MEASURES, "n_best", "count_sum", "groups_sha256"]
    measures = checkpoint(aligned.select("key", "n", *_MEASURES, "groups_sha256").join(sums, "key"))
    # copies of a text that holds a large share of the documents would all meet in one task
    total = aligned.agg(F.sum("n")).first()[0] or 0
    is_hot = F.col("n") * hot >= F.lit(total)
    keyed = rows.filter("text != ''").select("doc_id", _key().alias("key"))
    few = measures.filter(is_hot).select("key", *columns)  # at most ``hot`` rows
    of_hot = keyed.join(F.broadcast(few), "key")
    others = keyed.join(F.broadcast(few.select("key")), "key", "left_anti").join(measures.filter(~is_hot).select("key", *columns), "key")
    zeros = [F.lit("" if c == "groups_sha256" else 0).cast("string" if c == "groups_sha256" else "long").alias(c) for c in columns]
    textless = rows.filter("text is null or text = ''").select("doc_id", *zeros)
    return of_hot.select("doc_id", *columns).union(others.select("doc_id", *columns)).union(textless)
