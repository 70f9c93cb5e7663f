import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, row string, key string"


@pytest.fixture(scope="session")
def corpus(make):
    """Documents with nulls, empty and long texts, ties, repeated rows, copies, and columns of clashing names."""
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice(["an", "the", "or", "ti", "on", "es", "ü", "re"]) for _ in range(rnd.randint(1, 4)))
    prose = lambda n: " ".join(word() for _ in range(n))
    base = [prose(rnd.randint(30, 120)) for _ in range(30)]
    texts = [None, "", " \n\t ", "a", "one two three", "Σας é́ <|endoftext|> x's. y.,", prose(9000)]
    texts += base
    for t in base[:12]:
        w = t.split(" ")
        w[rnd.randrange(len(w))] = "changed"
        texts += [" ".join(w), t.upper(), t]
    texts += [base[0] + "\n" + base[1] + "\n" + base[2], "x " + base[20] + "\n" + base[1], "password = 'abcdef1' AKIA" + "A1" * 10]
    rows = [(i, t, ["en", "de", None][i % 3], "s", len(t or ""), "n", "r", "k") for i, t in enumerate(texts)]
    rows += [(3, "same id", "en", "s", 7, "n", "r", "k"), rows[9], (None, base[4], "en", "s", 3, "n", "r", "k"), (None, None, None, None, None, None, None, None)]
    return make(DOCS, rows)


@pytest.fixture(scope="session")
def empty(make):
    return make(DOCS, [])


@pytest.fixture(scope="session")
def path():
    import public_tokenizers

    return public_tokenizers.path


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]
