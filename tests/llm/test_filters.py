"""Secret scans, URL filter, quality rules, decontamination and the classifier."""

import inspect
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loomcast.llm.common import hashed_words
from loomcast.llm import kneser_ney
from loomcast.llm.kneser_ney import _counted, chances, grams, model, quality_scores
from loomcast.llm.quality_rules import compression_rules, text_counts
from loomcast.llm.secrets import Scanner, redact, secret_report
from loomcast.llm.tiling import Tiler, leaked_items, without_leaks
from loomcast.llm.url_filter import rules_table, url_verdicts

ASSIGN = re.compile(r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]+")


def plain_spans(text):
    text = text.encode().decode("latin-1")  # one character per byte
    out = [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    out += [(1, m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return sorted(out + [(2, m.start(), m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= 24])


def test_scanner_equals_regular_expressions():
    rnd = random.Random(3)
    bits = ["password", "Secret", "token", "api_key", "APIKEY", "=", ":", '"', " ", "abcdef", "AKIA", "AKIA" + "Q1" * 9, "0123456789abcdef" * 2, "é", "\n", ".", "x"]
    texts = ["".join(rnd.choices(bits, k=rnd.randint(0, 25))) for _ in range(4000)]
    for text, got in zip(texts, Scanner().spans([t.encode() for t in texts]), strict=True):
        assert sorted(s for s in got if s[0] < 3) == plain_spans(text), text


def test_added_kinds_and_code_points(make):
    text = "éé ghp_" + "z1" * 18 + " -----BEGIN RSA PRIVATE KEY----- Token: abcdefg"
    row = secret_report(make("doc_id long, text string", [(1, text)])).first()
    kinds = [s.split(":")[0] for s in row.spans.split(",")]
    assert kinds == ["github", "private_key", "assign"]
    kind, start, end = row.spans.split(",")[2].split(":")
    assert text[int(start) : int(end)] == "Token: abcdefg" and row.n_assign == 1


def test_secrets_of_odd_rows(corpus, empty):
    rows = secret_report(corpus).collect()
    assert len(rows) == corpus.count() and sum(r.n_assign for r in rows) == 1
    assert secret_report(empty).collect() == []
    clean = redact(corpus)
    assert clean.columns == corpus.columns
    assert Counter(r.doc_id for r in clean.collect()) == Counter(r.doc_id for r in corpus.collect())
    assert "[REDACTED] [REDACTED]" in [r.text.replace("'", "").strip() for r in clean.collect() if r.text and "RED" in r.text][0]


def test_url_rules(make, spark):
    urls = {
        None: ("", "", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "http://Example.COM/en/x?y#z": ("example.com", "/en/x", "example.com/en/", "block"),
        "https://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        "http://a.b.net/fr/q": ("a.b.net", "/fr/q", "net/fr/", "block"),
        "http://net/es/": ("net", "/es/", "net/es/", "block"),
        "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "http://x.com": ("x.com", "", None, "allow"),
        "a://b://c.com/d": ("b:", "//c.com/d", None, "allow"),
        "http://x.com?/": ("x.com", "", None, "allow"),
    }
    pages = make("page_id long, url string, rule string, host string", [(i, u, "r", "h") for i, u in enumerate(urls)])
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_verdicts(pages, rules_table(spark)).collect()}
    assert got == dict(enumerate(urls.values()))
    none = make("host string, path string, verdict string", [])
    assert {r.verdict for r in url_verdicts(pages, none).collect()} == {"allow"}
    assert url_verdicts(pages.limit(0), rules_table(spark)).collect() == []
    many = spark.range(3000).selectExpr("concat('h', id, '.org') host", "'/p' path", "'block' verdict")
    few = make("page_id long, url string", [(1, "http://x.h77.org/pq"), (2, "http://h77.org/q"), (2, "http://h77.org/q")])
    assert sorted(r.verdict for r in url_verdicts(few, many).collect()) == ["allow", "allow", "block"]


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    inside = {i + k for i, w in enumerate(windows) if w in twice for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


def test_quality_counts():
    rnd = random.Random(1)
    for _ in range(300):
        text = "".join(rnd.choices(["a", "b ", "é\xa0", " ", "\n", "#", "\u2028"], k=rnd.randint(0, 120)))
        assert text_counts(text.encode()) == plain_counts(text)


def test_compression_bands(make, corpus, empty):
    rnd = random.Random(2)
    prose = " ".join("".join(rnd.choices("etaoinshrdlu", k=rnd.randint(2, 7))) for _ in range(900))
    noise = " ".join("".join(chr(rnd.randint(33, 0x2FF)) for _ in range(9)) for _ in range(900))
    rows = compression_rules(make("doc_id long, text string", [(1, prose), (2, "all the same words and no end to it " * 99), (3, noise)]))
    assert {r.doc_id: (r.base_failed, r.in_band) for r in rows.collect()} == {1: (False, True), 2: (True, False), 3: (False, False)}
    odd = compression_rules(corpus).collect()
    assert len(odd) == corpus.count() and not [r for r in odd if r.n_bytes == 0 and r.kept]
    assert compression_rules(empty).collect() == []


def test_tiles_of_reordered_passages():
    item = hashed_words(b"a b c d e f g h i j k l")
    doc = hashed_words(b"x g h i j k l y a b c d e f z")
    assert sorted(Tiler(item, doc, 5).run()) == [(6, 0, 8), (6, 6, 1)]
    assert Tiler(item, hashed_words(b"a b c d x e f g h x"), 5).run() == []
    once = Tiler(hashed_words(b"a b c d e"), hashed_words(b"a b c d e a b c d e"), 5).run()
    assert once == [(5, 0, 0)]


def test_decontamination(make, corpus, empty):
    item = "one two three four five six seven eight nine ten"
    bench = make("item_id long, text string, doc_id long", [(1, item, 0), (2, None, 0), (3, "short one", 0)])
    docs = make(
        "doc_id long, text string, item_id long",
        [(1, "Six seven eight NINE ten. and one two three four five", 5), (2, "one two three four x five six", 5), (3, None, 5), (None, item, 5), (4, item, 5), (4, item, 5)],
    )
    found = Counter((r.doc_id, r.item_id) for r in leaked_items(docs, bench).collect())
    assert found == {(1, 1): 1, (None, 1): 1, (4, 1): 2}
    left = without_leaks(docs, bench)
    assert left.columns == docs.columns and {2, 3} <= {r.doc_id for r in left.collect()}
    assert leaked_items(empty, bench).collect() == [] and without_leaks(corpus, bench.limit(0)).count() == corpus.count()


def test_chances_sum_to_one(spark, make):
    """Over all next characters the interpolated chances of any history add up to at most 1."""
    train = make("lang string, text string", [("en", "the cat and the hat on the mat " * 3 + "abc abd abe bca"), ("en", "to be or not to be")])
    tables = model(_counted(train))
    history = [int(g) >> 16 for g in grams(b"the cab")[3:6]]
    alphabet = sorted({c for t in (r.text for r in train.collect()) for c in t})
    asked = [("en", (h << 16 & ((1 << 63) - 1)) | ord(c)) for h in history for c in alphabet]
    got = chances(make("lang string, gram long", asked), tables).collect()
    for h in history:
        total = sum(math.exp(r.logp) for r in got if r.gram >> 16 == h & ((1 << 47) - 1))
        assert 0.3 < total <= 1.0001


def test_classifier_rejects_what_trusted_text_is_not(make, corpus):
    rnd = random.Random(4)
    prose = lambda: " ".join(rnd.choice(["the", "and", "others", "in", "reason", "then", "sent"]) for _ in range(80))
    docs = [(i, prose(), "en", "p") for i in range(300)] + [(900, "#!! QZX!! " * 40, "en", "p"), (901, None, "en", "p"), (902, "quelque chose", None, "p"), (None, prose(), "en", "p")]
    docs = make("doc_id long, text string, lang string, kept string", docs)
    labels = make("doc_id long, quality int, toxic int", [(i, 1, 0) for i in range(250)] + [(900, 0, 0), (None, 1, 0)])
    got = {r.doc_id: r for r in quality_scores(docs, labels).collect()}
    assert not got[900].kept and not got[901].kept and got[902].kept and got[None].kept
    assert sum(r.kept for i, r in got.items() if i is not None and i < 300) >= 290
    assert len(got) == docs.count()
    assert quality_scores(docs, labels.limit(0)).filter("kept").count() == docs.filter("text is not null").count()
    assert quality_scores(corpus.limit(0), labels).count() == 0


def test_classifier_limits_of_rare_classes_and_languages(make):
    """Junk of a class without held-out text is judged, clean text of a class with one or two is not rejected."""
    rnd = random.Random(6)
    words = {"en": ["the", "and", "others", "in", "reason", "then", "sent"], "es": ["los", "y", "otros", "en", "razón", "que", "niño"]}
    prose = lambda lang, n: " ".join(rnd.choice(words[lang]) for _ in range(n))
    docs = [(i, prose("en", 60), "en") for i in range(400)]  # 128 to 511 bytes
    docs += [(1000 + i, prose("es", 60), "es") for i in range(250)] + [(2000 + i, prose("es", 150), "es") for i in range(8)]
    junk = [(3000, "#!! QZX!! " * 5, "en"), (3001, "#!! QZX!! " * 300, "en"), (3002, "#!! QZX!! " * 300, "es"), (3003, "#!! QZX!! " * 5, "es")]
    frame = make("doc_id long, text string, lang string", docs + junk)
    labels = make("doc_id long, quality int, toxic int", [(d, 1, 0) for d, *_ in docs])
    got = {r.doc_id: r for r in quality_scores(frame, labels).collect()}
    assert not any(got[d].kept for d, *_ in junk) and all(got[d].limit for d in got)
    assert sum(not got[2000 + i].kept for i in range(8)) == 0
    # as many of each language are drawn: the rare one is not crowded out
    few = kneser_ney._sample(frame, labels, 40).groupBy("lang").count().collect()
    assert {r.lang for r in few if 15 <= r["count"] <= 80} == {"en", "es"}


def test_classifier_learns_from_all_trusted_text(make):
    """Neither the model nor the limits are of a part of the trusted documents, however many there are."""
    ids = range(20_600)
    docs = make("doc_id long, text string, lang string", [(i, f"a{i % 7}", "en") for i in ids])
    labels = make("doc_id long, quality int, toxic int", [(i, 1, 0) for i in ids])
    taken = kneser_ney._sample(docs, labels)
    assert taken.count() == len(ids)
    assert 0.19 < taken.filter("held").count() / len(ids) < 0.21
    assert inspect.signature(quality_scores).parameters["trusted"].default is None


def test_quantiles_of_held_out_text_are_exact(make):
    rnd = random.Random(8)
    rows = [(rnd.choice(["", "en", "es"]), rnd.randrange(4), rnd.choice([2.5, 1 + rnd.random() / 1e4, rnd.uniform(1, 90), None])) for _ in range(3000)]
    rows += [("fr", 1, 7.0), ("pt", 2, None)]
    held = make("of_lang string, of_class int, perplexity double", rows)
    kinds = {"own": ["of_lang", "of_class"], "language": ["of_lang"], "length": ["of_class"], "all": []}
    for q in (0.0, 0.3, 0.995, 1.0):
        want = {}
        for kind, by in kinds.items():
            for r in held.groupBy(*by).agg(F.percentile("perplexity", F.lit(q)).alias("p"), F.count("perplexity").alias("n")).collect():
                if r.n:
                    want[kind, *(r[c] if c in by else d for c, d in (("of_lang", ""), ("of_class", -1)))] = r.n, r.p
        got = {(r.kind, r.of_lang, r.of_class): (r.n, r.found) for r in kneser_ney._quantiles(held, q).collect()}
        assert got == want
    assert kneser_ney._quantiles(held.limit(0), 0.995).collect() == []


def test_lookup_of_chances_takes_little_memory():
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    rnd = random.Random(2)
    texts = ["".join(rnd.choices("abcdefgh ", k=2000)) for _ in range(2000)]
    known = np.unique(np.concatenate([grams(t.encode()) for t in texts[:50]]))
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * len(texts), "text": texts})
    tracemalloc.start()
    means = [m for _, part in kneser_ney._means([batch], {"en": (known, np.zeros(len(known), np.float32))}) for m in part]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert means == [0.0] * len(texts) and peak < 48 << 20


def test_classifier_by_shuffle_equals_broadcast(make, monkeypatch):
    docs = make("doc_id long, text string, lang string", [(i, f"some words number {i} and more of them", "en") for i in range(40)])
    labels = make("doc_id long, quality int, toxic int", [(i, 1, 0) for i in range(30)])
    small = {r.doc_id: r.perplexity for r in quality_scores(docs, labels).collect()}
    monkeypatch.setattr(kneser_ney, "MOST_CHANCES", 0)
    assert {r.doc_id: r.perplexity for r in quality_scores(docs, labels).collect()} == pytest.approx(small, rel=1e-5)
