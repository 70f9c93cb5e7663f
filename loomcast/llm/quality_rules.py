"""Quality rules with compression bands.

A document's text is compressed with zstandard, whole and in chunks of a fixed
size. Repetitive text has a small ratio of compressed to plain bytes, noise a
large one; the accepted band depends on the length, as short texts compress
less.
"""

from __future__ import annotations

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.llm.common import byte_texts, map_slices

#: (bytes from, least ratio, largest ratio): the band that holds from this length on.
BANDS = ((0, 0.0, 2.0), (100, 0.42, 1.2), (300, 0.40, 0.90), (1000, 0.36, 0.80), (3000, 0.33, 0.75), (10000, 0.28, 0.72))
SYMBOLS = b"#*$%&|<>"
_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
_CONTINUED = bytes(range(0x80, 0xC0))


def text_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """(words, code points in words, symbols, repeated lines, words in repeated 5-word windows)."""
    words = text.split()
    chars = len(text.translate(None, _SPACE + _CONTINUED))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.split()]
    repeated = 0
    if len(words) >= 5:
        number: dict[bytes, int] = {}
        ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
        count = len(words) - 4
        key = ids[:count]
        for i in range(1, 5):  # exact: a window's number is made from that of its start and one word
            key = np.unique(key * len(number) + ids[i : count + i], return_inverse=True)[1]
        twice = np.bincount(key)[key] > 1
        steps = np.zeros(len(words) + 1, np.int64)
        np.add.at(steps, np.flatnonzero(twice), 1)
        np.add.at(steps, np.flatnonzero(twice) + 5, -1)
        repeated = int((np.cumsum(steps)[:-1] > 0).sum())
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated


def band(size: int, bands=BANDS) -> tuple[float, float]:
    """Least and largest ratio for a text of ``size`` bytes."""
    return next(((low, high) for first, low, high in reversed(bands) if size >= first), (0.0, 2.0))


def compression_rules(
    docs: DataFrame, bands=BANDS, chunk: int = 4096, bad_chunks: float = 0.5, level: int = 3
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text) with counts, ratios and verdict.

    ``ratio`` is that of the whole text (null without text). Chunks are the full
    pieces of ``chunk`` bytes; the document goes when its ratio, or at least the
    share ``bad_chunks`` of its chunks, lies outside the band of their length.
    Null text counts as empty: no words, no ratio, and the base rule rejects it.
    Null ids, repeated rows and other columns change nothing.
    """

    def work(part):
        texts = byte_texts(part.column("text"))
        press = zstandard.ZstdCompressor(level=level)
        counts = [text_counts(t) for t in texts]
        size = [len(t) for t in texts]
        ratio = [len(press.compress(t)) / len(t) if t else None for t in texts]
        low, high = band(chunk, bands)
        share, ok = [], []
        for t, r in zip(texts, ratio, strict=True):
            pieces = [len(press.compress(t[i : i + chunk])) / chunk for i in range(0, len(t) - chunk + 1, chunk)]
            bad = sum(not low <= x <= high for x in pieces) / len(pieces) if pieces else 0.0
            least, most = band(len(t), bands)
            share.append(bad)
            ok.append(r is not None and least <= r <= most and bad < bad_chunks)
        n_words, chars, symbols, lines, repeated = zip(*counts, strict=True)
        return {
            "doc_id": part.column("doc_id"),
            "n_words": n_words,
            "word_chars": chars,
            "n_symbols": symbols,
            "n_dup_lines": lines,
            "n_repeat_words": repeated,
            "n_bytes": size,
            "ratio": ratio,
            "bad_chunk_share": share,
            "in_band": ok,
        }

    schema = (
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "n_bytes long, ratio double, bad_chunk_share double, in_band boolean"
    )
    made = map_slices(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), work, schema)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return made.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & F.col("in_band"))
