"""Alignment of two tokenizers against a direct computation per document."""

import hashlib
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from loomcast.llm.alignment import aligned_documents
from loomcast.llm.byte_level import byte_of_sign

from .conftest import rows_of


def brute_force(path, rows):
    """The measures of each row, from byte offsets of the libraries' own tokens and all pairs of ranges."""
    a_of = Tokenizer.from_file(path("byte_bpe_50k.json"))
    a_of.encode_special_tokens = True
    b_of = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    sign = byte_of_sign()

    def piece(i):
        p = b_of.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b_of.is_byte(i) else p.replace("▁", " ").encode()

    def ranges(ids, data):
        out, at = [], 0
        for i, d in zip(ids, data, strict=True):
            out.append((i, at, at + len(d)))
            at += len(d)
        return out

    found = []
    for doc, text in rows:
        a_ids = a_of.encode(" " + (text or ""), add_special_tokens=False).ids
        b_ids = b_of.encode(text or "")
        a_bytes = [bytes(sign[c] for c in a_of.id_to_token(i)) for i in a_ids]
        b_bytes = [piece(i) for i in b_ids]
        want = (" " + (text or "")).encode()
        if not text or b"".join(a_bytes) != want or b"".join(b_bytes) != want:
            found.append((doc, [], [], "", []))
            continue
        a, b = ranges(a_ids, a_bytes), ranges(b_ids, b_bytes)
        both = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, last = [], 0
        for end in both:
            sides = [",".join(str(i) for i, _, e in side if last < e <= end) for side in (a, b)]
            groups.append("|".join(sides))
            last = end
        links = []
        for i, s, e in a:
            links += [(i, j) for j, t, u in b if t < e and s < u]
        found.append((doc, a, b, ";".join(groups), links))
    counts = Counter(p for *_, links in found for p in links)
    most = Counter()
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    return Counter(
        (
            doc,
            len(a),
            len(b),
            len(text.split(";")) if text else 0,
            len(links),
            sum(counts[p] == most[p[1]] for p in links),
            sum(counts[p] for p in links),
            hashlib.sha256(text.encode()).hexdigest() if a else "",
        )
        for doc, a, b, text, links in found
    )


def measured(docs, path, **how):
    got = aligned_documents(docs, path("byte_bpe_50k.json"), path("piece_bpe_32k.model"), **how)
    return Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got.collect())


ODD = ["▁a b", "<s> x </s>", "<|endoftext|>", "a  b   c ", " lead", "\t\n x", "日本語 текст", "é́ 🙂🙂 ok", "\x00 x", "x" * 300, "aaa\n\n\nbbb", "İ ﬁ ½ ＡＢ"]


@pytest.mark.parametrize("how", [{}, {"frequent": 3, "hot": 2}, {"frequent": 200, "hot": 1}])
def test_measures_equal_brute_force(make, path, corpus, how):
    rows = [(d, t) for d, t in rows_of(corpus) if len(t or "") < 3000]
    rows += list(enumerate(ODD, 1000)) + [(2000 + i, "the same words again") for i in range(40)]
    docs = make("doc_id long, text string, key string, n long, pairs string", [(*r, "k", 5, "p") for r in rows])
    assert measured(docs, path, **how) == brute_force(path, rows)


def test_a_very_long_text(make, path):
    rows = [(1, "some words and others " * 20_000), (2, "some"), (3, "\n" * 400_000)]
    got = measured(make("doc_id long, text string", rows), path)
    assert {r[0]: r[1] > 0 for r in got} == {1: True, 2: True, 3: True}


def test_an_empty_table(empty, path):
    assert not measured(empty, path)
