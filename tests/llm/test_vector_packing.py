"""Best-fit packing and byte-level ids against the library and a plain search over all sequences."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from loomcast.llm.byte_level import ByteLevel
from loomcast.llm.vector_packing import best_fit, pack_best_fit, packing_report

from .conftest import rows_of

FILE = "byte_bpe_50k.json"


def plain_fit(lengths, capacities, weights, rule):
    """The same choice, one open sequence after the other."""
    left, out = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        need = (lengths[i], 1, lengths[i] ** 2)
        scores = []
        for k, room in enumerate(left):
            if all(r >= n for r, n in zip(room, need, strict=True)):
                if rule == "norm":
                    parts = [w * ((r - n) / c) ** 2 for w, r, n, c in zip(weights, room, need, capacities, strict=True)]
                else:
                    parts = [w * r * n / c**2 for w, r, n, c in zip(weights, room, need, capacities, strict=True)]
                scores.append((sum(parts), k))
        if scores:
            least = min(scores)[0]
            k = next(k for score, k in scores if score <= least * (1 + 1e-12))
        else:
            k = len(left)
            left.append(capacities)
        left[k] = tuple(r - n for r, n in zip(left[k], need, strict=True))
        out[i] = k
    return [out[i] for i in range(len(lengths))]


@given(
    st.lists(st.integers(1, 50), max_size=120),
    st.sampled_from([(50, 6, 2500), (64, 3, 2500), (100, 8, 2600)]),
    st.sampled_from(["norm", "dot"]),
)
@settings(max_examples=80, deadline=None)
def test_every_constraint_holds_and_few_sequences_are_used(lengths, capacities, rule):
    weights = (1.0, 0.25, 0.5)
    got = best_fit(np.array(lengths, np.int64), capacities, weights, rule)
    by = defaultdict(list)
    for n, k in zip(lengths, got.tolist(), strict=True):
        by[k].append(n)
    for own in by.values():
        assert sum(own) <= capacities[0] and len(own) <= capacities[1] and sum(n * n for n in own) <= capacities[2]
    assert sorted(by) == list(range(len(by)))
    if lengths:  # a score that ties in one way of adding may differ in the last digit in the other
        assert abs(len(by) - (max(plain_fit(lengths, capacities, weights, rule)) + 1)) <= 1


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_choice_equals_the_plain_search(rule):
    lengths = np.random.default_rng(3).integers(1, 2000, 700)
    capacities, weights = (2048, 16, 2048**2), (1.0, 0.015625, 0.25)
    assert best_fit(lengths, capacities, weights, rule).tolist() == plain_fit(lengths.tolist(), capacities, weights, rule)


def test_close_to_the_least_number_of_sequences():
    lengths = np.random.default_rng(4).integers(1, 1500, 3000)
    used = best_fit(lengths, (2048, 256, 2048**2), (1.0, 0.01, 0.01), "norm").max() + 1
    assert used <= -(-lengths.sum() // 2048) * 1.002


def ids_of(path, text):
    return np.array([*Tokenizer.from_file(path(FILE)).encode(text or "", add_special_tokens=False).ids, 0], "<u4")


@pytest.mark.parametrize("length,documents,attention,group", [(16, 2, 200, 7), (2048, 256, None, 25_000), (40, 100, 900, 50)])
def test_pieces_hold_each_id_once_under_all_capacities(make, path, corpus, length, documents, attention, group):
    rows = pack_best_fit(corpus, path(FILE), length, documents, attention, group=group).collect()
    longest = min(length, int((attention or length**2) ** 0.5))
    pieces, sequences = Counter(), defaultdict(list)
    for r in rows:
        pieces[r.doc_id, r.piece, r.start, r.length, r.ids] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    want = Counter()
    for d, t in rows_of(corpus):
        ids = ids_of(path, t).astype("<u2")
        starts = [0, *range(len(ids) % longest or longest, len(ids), longest)]
        for piece, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            want[d, piece, a, b - a, ids[a:b].tobytes()] += 1
    assert pieces == want
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == list(np.cumsum([0, *(n for _, n in parts)])[:-1])
        assert sum(n for _, n in parts) <= length and len(parts) <= documents
        assert sum(n * n for _, n in parts) <= (attention or length**2)


def test_report_has_the_crc_of_wide_ids(make, path):
    rows = [(1, "some text"), (2, None), (2, None), (None, ""), (4, "word " * 5000)]
    got = packing_report(make("doc_id long, text string, ids string, row long", [(*r, "i", 1) for r in rows]), path(FILE)).collect()
    for d, t in rows:
        ids, at = ids_of(path, t), 0
        for r in sorted((r for r in got if r.doc_id == d), key=lambda r: r.start)[: 1 if d in (2, None) else None]:
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    assert len([r for r in got if r.doc_id == 2]) == 2 and len([r for r in got if r.doc_id == 4]) == 3


def test_packing_of_an_empty_table_and_wrong_rule(empty, path):
    assert pack_best_fit(empty, path(FILE)).collect() == []
    with pytest.raises(ValueError, match="rule"):
        pack_best_fit(empty, path(FILE), rule="first")


@given(st.text(max_size=60) | st.sampled_from(["<|endoftext|>", "a<|endoftext|> b", "  \n\n x", "don't we'll", "\n" * 70_000]))
@settings(max_examples=150, deadline=None)
def test_ids_equal_the_library(text):
    import public_tokenizers

    file = public_tokenizers.path(FILE)
    text = text.encode("utf-8", "replace").decode()
    for plain in (False, True):
        library = Tokenizer.from_file(file) if plain not in _KNOWN else _KNOWN[plain][0]
        library.encode_special_tokens = plain
        _KNOWN.setdefault(plain, (library, ByteLevel(file, plain)))
        assert _KNOWN[plain][1](text).tolist() == library.encode(text, add_special_tokens=False).ids


_KNOWN: dict = {}


def test_other_kinds_of_files_go_to_the_library(path):
    made = ByteLevel(path("word_bpe_49k.json"))
    assert made._fast is None
    assert made("Some words.").tolist() == Tokenizer.from_file(path("word_bpe_49k.json")).encode("Some words.", add_special_tokens=False).ids


def test_every_entry_is_found_whole(path):
    made, library = ByteLevel(path(FILE)), Tokenizer.from_file(path(FILE))
    texts = []
    for b in made.bytes_of.values():
        try:
            texts.append(b.decode())
        except UnicodeDecodeError:
            continue
    assert [made(t).tolist() for t in texts] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
