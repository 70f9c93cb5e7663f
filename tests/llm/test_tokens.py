"""Token files, counts and packing against the tokenizer libraries themselves."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from loomcast.llm.common import crc32_joined
from loomcast.llm.packing import curve_keys, hilbert_key, pack
from loomcast.llm.range_coder import decode_blocks, encode_blocks
from loomcast.llm.token_counts import token_counts
from loomcast.llm.token_files import document_ids, encoded, write_and_read

from .conftest import rows_of


def ids_of(path, text):
    made = Tokenizer.from_file(path("word_bpe_49k.json")).encode(text or "", add_special_tokens=False).ids
    return np.array([*made, 1], "<u4")


@given(st.lists(st.lists(st.integers(0, 65535) | st.integers(0, 3), min_size=1, max_size=300), min_size=1, max_size=5))
@settings(max_examples=40, deadline=None)
def test_range_coder_round_trip(blocks):
    blocks = [np.array(b, np.uint16) for b in blocks]
    back = decode_blocks(encode_blocks(blocks), [len(b) for b in blocks])
    assert all((a == b).all() for a, b in zip(blocks, back, strict=True))


def test_repetition_is_coded_shorter():
    block = np.tile(np.arange(40, dtype=np.uint16), 50)
    assert len(encode_blocks([block])[0]) < len(block) * 2 / 10


def test_crc32_of_joined_parts():
    data = bytes(range(256)) * 5
    cuts = [0, 3, 400, 400, len(data)]
    parts = [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    assert crc32_joined([(zlib.crc32(p), len(p)) for p in parts]) == zlib.crc32(data)


@pytest.mark.parametrize("block", [7, 4096])
def test_token_file_gives_the_ids_back(corpus, path, block):
    got = sorted(map(tuple, document_ids(encoded(corpus, path("word_bpe_49k.json"), block)).collect()), key=lambda r: r[1])
    want = Counter((d, len(x), zlib.crc32(x.tobytes())) for d, x in ((d, ids_of(path, t)) for d, t in rows_of(corpus)))
    assert Counter((d, n, crc) for d, _, n, crc in got) == want
    assert [r[1] for r in got] == list(np.cumsum([0, *(r[2] for r in got)])[:-1])
    ids = [(r[0] is not None, r[0] or 0) for r in got]
    assert ids == sorted(ids)


def test_damaged_block_is_noticed(corpus, path):
    from pyspark.sql import functions as F

    blocks = encoded(corpus, path("word_bpe_49k.json")).withColumn("crc32", F.col("crc32") + 1)
    with pytest.raises(Exception, match="damaged"):
        document_ids(blocks).collect()


def test_token_file_of_an_empty_table(empty, path):
    assert write_and_read(empty, path("word_bpe_49k.json")).collect() == []


@pytest.mark.parametrize("frequent", [3, 100_000])
def test_token_counts_equal_the_library(corpus, path, frequent):
    model = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    want = Counter((d, len((t or "").encode()), len(model.encode(t or "")), len(model.encode(t or "")) > 50) for d, t in rows_of(corpus))
    got = token_counts(corpus, path("piece_bpe_32k.model"), limit=50, frequent=frequent, shards=3)
    assert Counter(map(tuple, got.collect())) == want


def test_spaces_and_blank_marks(make, path):
    texts = [" ", "  a", "a  b ", "a   ", "▁a▁▁b", "a\t b\n c", "\x00 x", "<s> </s>", "   "]
    model = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    got = token_counts(make("doc_id long, text string", list(enumerate(texts))), path("piece_bpe_32k.model"), shards=2).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {i: len(model.encode(t)) for i, t in enumerate(texts)}


def test_token_counts_of_an_empty_table(empty, path):
    assert token_counts(empty, path("piece_bpe_32k.model")).collect() == []


def test_hilbert_neighbours_touch():
    side = np.arange(16)
    points = np.array([(a, b, c) for a in side for b in side for c in side])
    key = hilbert_key(points, 4)
    assert sorted(key) == list(range(16**3))
    walk = points[np.argsort(key)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("length", [16, 2048])
def test_packing_holds_each_id_once(corpus, path, length):
    rows = pack(corpus, path("word_bpe_49k.json"), length, parts=3).collect()
    pieces, sequences = Counter(), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, np.uint16)
        assert len(ids) == r.length and zlib.crc32(ids.astype("<u4").tobytes()) == r.ids_crc32
        pieces[r.doc_id, r.doc_tokens] += r.length
        sequences[r.sequence_id].append((r.offset, r.length))
    want = Counter()
    for d, t in rows_of(corpus):
        n = len(ids_of(path, t))
        want[d, n] += n
    assert pieces == want
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == list(np.cumsum([0, *(n for _, n in parts)])[:-1])
        size = sum(n for _, n in parts)
        assert size <= length and size & (size - 1) == 0


def test_packing_of_an_empty_table(empty, path):
    assert pack(empty, path("word_bpe_49k.json")).collect() == []


def test_equal_documents_have_equal_keys():
    from loomcast.llm.packing import _projection

    ids = [np.array([5, 6, 7], np.uint16), np.array([9], np.uint16), np.array([7, 6, 5], np.uint16)]
    keys = curve_keys(ids, _projection())
    assert keys[0] == keys[2] and keys[0] != keys[1]
