"""Benchmark decontamination by greedy string tiling.

A benchmark item and a document that share a run of ``least`` words are
candidates. Their longest common runs are marked one after the other, each word
once, found by running Karp-Rabin hashes of falling length. The share of the
item's words under tiles shows a leak even when its passages were reordered.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.llm.common import arrow_schema, byte_texts, hashed_words, slices, windows

LEAST, COVERAGE = 5, 0.5
#: Words of benchmark items that are sent to every task at once; more are done in blocks.
MOST_WORDS = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_FOUND = "doc_id long, item_id long, coverage double, covered_words long, item_words long, n_tiles long, longest_tile long"


def _prefix(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of word * base ** place over all prefixes, and the powers of the base."""
    power = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(len(words), _BASE)]))
    return np.concatenate([[np.uint64(0)], np.cumsum(words * power[:-1], dtype=np.uint64)]), power


class Tiler:
    """Greedy tiles of one item in one document."""

    def __init__(self, item: np.ndarray, doc: np.ndarray, least: int = LEAST):
        self.words = (item, doc)
        self.least = least
        self.marked = (np.zeros(len(item), bool), np.zeros(len(doc), bool))
        self.hashes = tuple(_prefix(w) for w in self.words)
        self.tiles: list[tuple[int, int, int]] = []

    def _free(self, side: int, size: int) -> np.ndarray:
        """Starts of the runs of ``size`` words none of which is marked."""
        sums = np.concatenate([[0], np.cumsum(self.marked[side])])
        return np.flatnonzero(sums[size:] == sums[:-size]) if size < len(sums) else np.zeros(0, np.int64)

    def _running(self, side: int, starts: np.ndarray, size: int) -> np.ndarray:
        """Hashes of the runs, each brought to the power of the longer text's end."""
        sums, _ = self.hashes[side]
        power = max((h[1] for h in self.hashes), key=len)
        return (sums[starts + size] - sums[starts]) * power[len(power) - 1 - starts]

    def _matches(self, size: int):
        """(length, item start, document start) of all common free runs of ``size`` words, made as long as they go."""
        a, b = self._free(0, size), self._free(1, size)
        if not len(a) or not len(b):
            return []
        ha, hb = self._running(0, a, size), self._running(1, b, size)
        order = np.argsort(ha, kind="stable")
        low = np.searchsorted(ha[order], hb, "left")
        high = np.searchsorted(ha[order], hb, "right")
        item, doc = self.words
        out = []
        for j in np.flatnonzero(high > low):
            for k in range(low[j], high[j]):
                x, y = int(a[order[k]]), int(b[j])
                # a run that goes on to the left was found there
                if x and y and item[x - 1] == doc[y - 1] and not self.marked[0][x - 1] and not self.marked[1][y - 1]:
                    continue
                n = 0
                while (
                    x + n < len(item) and y + n < len(doc) and item[x + n] == doc[y + n]
                    and not self.marked[0][x + n] and not self.marked[1][y + n]
                ):
                    n += 1
                if n >= size:
                    out.append((n, x, y))
        return out

    def run(self) -> list[tuple[int, int, int]]:
        size = max(self.least, len(self.words[0]))
        while True:
            while found := self._matches(size):
                # the longest first; of equal length the one that comes first
                for n, x, y in sorted(found, key=lambda m: (-m[0], m[1], m[2])):
                    if not self.marked[0][x : x + n].any() and not self.marked[1][y : y + n].any():
                        self.marked[0][x : x + n] = True
                        self.marked[1][y : y + n] = True
                        self.tiles.append((n, x, y))
            if size == self.least:
                return self.tiles
            size = max(self.least, size // 2)


def _index(items: list[tuple[int, bytes]], least: int):
    """Words of the items, and their seeds sorted with the item of each."""
    words = [hashed_words(t) for _, t in items]
    seeds = [np.unique(windows(w, least)) if len(w) >= least else w[:0] for w in words]
    every = np.concatenate(seeds) if seeds else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(items)), [len(s) for s in seeds])
    order = np.argsort(every, kind="stable")
    return [i for i, _ in items], words, every[order], owner[order]


def _leaks(words: np.ndarray, index, least: int, coverage: float):
    """(item id, item words, tiles) of the items that a document's words cover."""
    ids, items, seeds, owner = index
    if len(words) < least or not len(seeds):
        return
    grams = windows(words, least)
    at = np.minimum(np.searchsorted(seeds, grams), len(seeds) - 1)
    hits = np.unique(grams[seeds[at] == grams])
    if not len(hits):
        return
    first, after = np.searchsorted(seeds, hits, "left"), np.searchsorted(seeds, hits, "right")
    for item in np.unique(np.concatenate([owner[a:b] for a, b in zip(first, after, strict=True)])).tolist():
        tiles = Tiler(items[item], words, least).run()
        if sum(t[0] for t in tiles) >= coverage * len(items[item]):
            yield ids[item], len(items[item]), tiles


def _blocks(benchmark: DataFrame, least: int):
    """The benchmark's index in broadcast blocks of about ``MOST_WORDS`` words, or one item."""
    items = benchmark.select(F.col("item_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n_words = items.agg(F.sum(F.length("text") / 2 + 1)).first()[0] or 0
    blocks = int(n_words // MOST_WORDS) + 1
    for block in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        index = _index([(r.item_id, r.text.encode()) for r in own.toLocalIterator()], least)
        yield benchmark.sparkSession.sparkContext.broadcast(index)


def leaked_items(docs: DataFrame, benchmark: DataFrame, least: int = LEAST, coverage: float = COVERAGE) -> DataFrame:
    """One row per (document, item) of which at least ``coverage`` of the item's words lie under tiles.

    Words are lower-cased; items of fewer than ``least`` words cannot be told
    from common phrases and match nothing. Null texts count as empty; null ids
    stay null; repeated rows each report. The benchmark is searched in blocks of
    bounded size, so it may grow.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = arrow_schema(_FOUND)

    def search(index):
        def run(batches):
            for part in slices(batches):
                rows = []
                for doc, text in zip(part.column("doc_id").to_pylist(), byte_texts(part.column("text")), strict=True):
                    for item, total, tiles in _leaks(hashed_words(text), index.value, least, coverage):
                        covered = sum(t[0] for t in tiles)
                        rows.append((doc, item, covered / total, covered, total, len(tiles), max(t[0] for t in tiles)))
                columns = list(zip(*rows, strict=True)) or [()] * len(schema)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        return texts.mapInArrow(run, _FOUND)

    found = [search(index) for index in _blocks(benchmark, least)]
    return reduce(DataFrame.union, found)


def without_leaks(docs: DataFrame, benchmark: DataFrame, least: int = LEAST, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs``, all columns, that ``leaked_items`` would not report."""

    def clean(index):
        def run(batches):
            for part in slices(batches):
                keep = [
                    next(_leaks(hashed_words(t), index.value, least, coverage), None) is None
                    for t in byte_texts(part.column("text"))
                ]
                yield part.filter(pa.array(keep, pa.bool_()))

        return run

    for index in _blocks(benchmark, least):
        docs = docs.mapInArrow(clean(index), docs.schema)
    return docs
