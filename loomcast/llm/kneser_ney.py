"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model.

The model is over characters, four at a time, one per language, trained on
trusted documents. Its counts, discounts and back-off weights are grouped sums
and joins. Every distinct 4-gram of the corpus is joined to the model's counts
once, sharded by its shorter forms; a document's perplexity follows from the
chances of its 4-grams. Documents above a quantile of held-out trusted text of
their language and length are rejected; where there is little such text, the
quantile is of more of it (``_limits``).

A 4-gram is a long of four 16-bit codes, the first character in the top bits;
its first three are the history of the last one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from loomcast.llm.common import arrow_schema, byte_texts, slices
from loomcast.session import checkpoint

ORDER = 4
#: Held-out texts that a limit needs; with fewer, one of more text is used.
LEAST_HELD = 30
#: Entries of the table of chances that is sent to every task; beyond it, documents join it by shuffle.
MOST_CHANCES = 4_000_000
QUANTILE, MARGIN = 0.995, 1.1
#: Most 64-bit words of the filter of trusted ids (8 MB); beyond 16 bits an id it passes more, and the join drops the rest.
_MOST_WORDS = 1 << 20
#: Bins per unit of log perplexity in which held-out texts are counted for the quantiles.
_BINS = 1024
#: Bytes from which on a document belongs to the next class of lengths.
LENGTHS = (128, 512, 2048)
_START = 1
#: Bytes of text whose 4-grams are counted, or looked up, at once; each takes about 50 bytes of memory.
_SLICE, _LOOKUP = 1 << 20, 1 << 19
_SPACES = np.zeros(1 << 16, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True


def codes(text: bytes) -> np.ndarray:
    """Characters as 16-bit codes: white-space runs as one space, digits as 0, rare planes as one code."""
    c = np.minimum(np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), np.uint32), 0xFFFF)
    c = np.where(_SPACES[c], 32, c)
    c = c[~((c == 32) & (np.concatenate([[0], c[:-1]]) == 32))]
    return np.where((c >= 48) & (c < 58), 48, np.maximum(c, 2)).astype(np.int64)


def grams(text: bytes) -> np.ndarray:
    """One 4-gram per character, the first ones padded with start codes."""
    c = np.concatenate([np.full(ORDER - 1, _START), codes(text)])
    n = len(c) - ORDER + 1
    return (c[:n] << 48) | (c[1 : n + 1] << 32) | (c[2 : n + 2] << 16) | c[3 : n + 3]


def _counted(docs: DataFrame) -> DataFrame:
    """(lang, gram, n): distinct 4-grams per language with their counts."""
    schema = arrow_schema("lang string, gram long, n long")

    def run(batches):
        for part in slices(batches, size=_SLICE):
            by_lang: dict = {}
            for lang, text in zip(part.column("lang").to_pylist(), byte_texts(part.column("text")), strict=True):
                by_lang.setdefault(lang or "", []).append(grams(text))
            for lang, found in by_lang.items():
                gram, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram), pa.array(n)], schema=schema)

    return docs.select("lang", "text").mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _suffix(gram, order: int):
    """The last ``order`` characters of a gram."""
    return gram.bitwiseAND((1 << 16 * order) - 1) if order < ORDER else gram


def _history(gram):
    return F.call_function("shiftrightunsigned", gram, F.lit(16))


def model(counts: DataFrame) -> list[DataFrame]:
    """Per order 1..4 a table (lang, gram, p, back) of the grams seen in training.

    ``p`` is the interpolated chance of the last character after the others, and
    for histories ``back`` the weight of the next shorter history.
    """
    levels = [counts.withColumnRenamed("n", "c")]
    for order in range(ORDER - 1, 0, -1):  # lower orders count distinct characters before
        shorter = levels[0].groupBy("lang", _suffix(F.col("gram"), order).alias("gram")).agg(F.count(F.lit(1)).alias("c"))
        levels.insert(0, checkpoint(shorter))
    tables: list[DataFrame] = []
    for order, level in enumerate(levels, 1):
        times = [F.count(F.when(F.col("c") == k, 1)).alias(f"t{k}") for k in (1, 2, 3, 4)]
        t = level.groupBy("lang").agg(*times)  # one row per language
        t1, t2, t3, t4 = (F.col(f"t{k}").cast("double") for k in (1, 2, 3, 4))
        # a discount of zero would leave unseen characters no chance at all
        y = t1 / F.greatest(t1 + 2 * t2, F.lit(1.0))
        cut = [F.when(b > 0, F.least(F.greatest(k - (k + 1) * y * a / b, F.lit(1e-3)), F.lit(float(k)))).otherwise(0.5 * k) for k, a, b in ((1, t2, t1), (2, t3, t2), (3, t4, t3))]
        t = t.select("lang", *[c.alias(f"d{k}") for k, c in enumerate(cut, 1)])
        c = F.col("c")
        discount = F.when(c == 1, F.col("d1")).when(c == 2, F.col("d2")).otherwise(F.col("d3"))
        rows = level.join(t, "lang").withColumn("d", discount).withColumn("history", _history(F.col("gram")))
        sums = rows.groupBy("lang", "history").agg(F.sum("c").alias("total"), (F.sum("d") / F.sum("c")).alias("back"))
        rows = rows.join(sums, ["lang", "history"])
        if order == 1:
            # under all orders every character has the same small chance
            rows = rows.withColumn("lower", F.lit(1.0 / (1 << 16)))
        else:
            lower = tables[-1].select("lang", F.col("gram").alias("short"), F.col("p").alias("lower"))
            rows = rows.withColumn("short", _suffix(F.col("gram"), order - 1)).join(lower, ["lang", "short"])
        p = (c - F.col("d")) / F.col("total") + F.col("back") * F.col("lower")
        tables.append(checkpoint(rows.select("lang", "gram", p.alias("p"), "history", "back")))
    return tables


def chances(corpus: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """(lang, gram, logp) of the corpus's distinct 4-grams (lang, gram), by joins order after order."""
    rows = corpus.withColumn("p", F.lit(1.0 / (1 << 16)))
    for order, level in enumerate(tables, 1):
        backs = level.select("lang", "history", "back").distinct()
        known = level.select("lang", F.col("gram").alias("short"), F.col("p").alias("seen"))
        rows = (
            rows.withColumn("short", _suffix(F.col("gram"), order))
            .withColumn("history", _history(F.col("short")))
            .join(known, ["lang", "short"], "left")
            .join(backs, ["lang", "history"], "left")
            .select("lang", "gram", F.coalesce("seen", F.coalesce("back", F.lit(1.0)) * F.col("p")).alias("p"))
        )
    return rows.select("lang", "gram", F.log("p").cast("float").alias("logp"))


def scored(docs: DataFrame, table: DataFrame) -> DataFrame:
    """``docs`` with ``mean_logp``: mean log chance of the characters (null without text or language model)."""
    if table.count() <= MOST_CHANCES:
        return _scored_by_broadcast(docs, table)
    keyed = docs.withColumn("row", F.monotonically_increasing_id())
    schema = arrow_schema("row long, lang string, gram long, n long")

    def run(batches):
        for part in slices(batches, size=_SLICE):
            for row, lang, text in zip(part.column("row").to_pylist(), part.column("lang").to_pylist(), byte_texts(part.column("text")), strict=True):
                gram, n = np.unique(grams(text), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([row] * len(gram), pa.int64()), pa.array([lang or ""] * len(gram), pa.string()), pa.array(gram), pa.array(n)], schema=schema)

    each = keyed.select("row", "lang", "text").mapInArrow(run, "row long, lang string, gram long, n long")
    sums = each.join(table, ["lang", "gram"]).groupBy("row").agg((F.sum(F.col("n") * F.col("logp")) / F.sum("n")).alias("mean_logp"))
    return keyed.join(sums, "row", "left").drop("row")


def _scored_by_broadcast(docs: DataFrame, table: DataFrame) -> DataFrame:
    made = table.orderBy("lang", "gram").toArrow()
    by_lang = {}
    for lang in pc.unique(made.column("lang")).to_pylist():
        own = made.filter(pc.equal(made.column("lang"), lang))
        by_lang[lang] = own.column("gram").to_numpy(), own.column("logp").to_numpy()
    share = docs.sparkSession.sparkContext.broadcast(by_lang)
    columns = [f.name for f in docs.schema]

    def run(batches):
        for part, mean in _means(batches, share.value):
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), pa.array(mean, pa.float64())], names=[*columns, "mean_logp"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("mean_logp", DoubleType())]))


def _means(batches, by_lang: dict):
    """Slices of the batches (lang, text and others) and the mean log chance of each text, by (grams, chances) per language."""
    for part in slices(batches, size=_LOOKUP):
        langs = part.column("lang").to_pylist()
        found = [grams(t) for t in byte_texts(part.column("text"))]
        mean: list = [None] * len(found)
        for lang, (known, logp) in by_lang.items():
            own = [i for i, x in enumerate(langs) if (x or "") == lang and len(found[i])]
            if own:
                every, where = np.unique(np.concatenate([found[i] for i in own]), return_inverse=True)
                value = logp[np.minimum(np.searchsorted(known, every), len(known) - 1)].astype(np.float64)[where]
                size = np.array([len(found[i]) for i in own])
                sums = np.add.reduceat(value, np.cumsum(size) - size) / size
                for i, m in zip(own, sums.tolist(), strict=True):
                    mean[i] = m
        yield part, mean


def _sample(docs: DataFrame, labels: DataFrame, trusted: int | None = None) -> DataFrame:
    """(doc_id, lang, text, held) of the trusted documents, a fifth held out; some of each language train.

    All of them, or about ``trusted`` of each language where a number is given.
    """
    of_lang = F.coalesce("lang", F.lit("")).alias("of_lang")
    ids = labels.filter("quality = 1 and toxic = 0 and doc_id is not null").select("doc_id").distinct()
    known = checkpoint(docs.select("doc_id", of_lang).join(ids, "doc_id").distinct())
    if trusted is not None:
        place = F.call_function("shiftrightunsigned", F.xxhash64("doc_id"), F.lit(11)) / F.lit(float(1 << 53))
        sizes = known.groupBy("of_lang").agg(F.count(F.lit(1)).alias("size"))  # one row per language
        known = known.join(sizes, "of_lang").filter(place * F.col("size") < trusted).drop("size")
    chosen = known.withColumn("held", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(5)) == 0)
    none_trains = chosen.groupBy("of_lang").agg(F.every("held").alias("none_trains"))
    chosen = checkpoint(chosen.join(none_trains, "of_lang").withColumn("held", F.expr("held and not none_trains")).drop("none_trains"))
    texts = _with_ids(docs.select("doc_id", "lang", "text", of_lang), chosen)
    return texts.join(chosen, ["doc_id", "of_lang"]).drop("of_lang")


def _with_ids(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose doc_id is in ``wanted``, and few others: what a join with it then has to shuffle."""
    size = min(_MOST_WORDS, 1 << max(6, (wanted.count() // 4).bit_length()))
    bit = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(64 * size))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(63).cast("int"))
    none = texts.sparkSession.range(size).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    words = none.union(wanted.select(F.shiftright(bit, 6), mask)).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    words = checkpoint(words.agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words")).select("words.bits"))
    word = F.element_at(words.scalar(), (F.shiftright(bit, 6) + 1).cast("int"))
    return texts.filter(word.bitwiseAND(mask) != 0)


def _quantiles(held: DataFrame, quantile: float) -> DataFrame:
    """(kind, of_lang, of_class, n, found): exact interpolated quantile of the perplexities of each group.

    Kinds are ``own`` (a language and class), ``language``, ``length`` and
    ``all``; what a kind does not tell apart is '' or -1. Equal values are
    counted first, then bins of them; only the values in the bins that hold the
    wanted ranks are put in order.
    """
    lang, size = F.col("of_lang"), F.col("of_class")
    kinds = [("own", lang, size), ("language", lang, F.lit(-1)), ("length", F.lit(""), size), ("all", F.lit(""), F.lit(-1))]
    groups = F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), a.alias("of_lang"), b.alias("of_class")) for k, a, b in kinds]))
    group = ["kind", "of_lang", "of_class"]
    known = held.filter("perplexity is not null").groupBy("of_lang", "of_class", "perplexity").agg(F.count(F.lit(1)).alias("c"))
    values = known.select(groups, "perplexity", "c").withColumn("bin", F.floor(F.log("perplexity") * _BINS))
    values = checkpoint(values.groupBy(*group, "bin", "perplexity").agg(F.sum("c").alias("c")))
    before = lambda w: F.coalesce(F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bins = values.groupBy(*group, "bin").agg(F.sum("c").alias("c"))
    bins = bins.withColumn("n", F.sum("c").over(Window.partitionBy(*group))).withColumn("before", before(Window.partitionBy(*group).orderBy("bin")))
    bins = bins.withColumn("place", (F.col("n") - 1) * F.lit(quantile))
    low, high = F.floor("place"), F.ceil("place")
    wanted = bins.filter((F.col("before") <= high) & (F.col("before") + F.col("c") > low)).drop("c")
    near = values.join(wanted, [*group, "bin"])
    near = near.withColumn("before", F.col("before") + before(Window.partitionBy(*group, "bin").orderBy("perplexity")))
    at = lambda rank: F.max(F.when((F.col("before") <= rank) & (F.col("before") + F.col("c") > rank), F.col("perplexity")))
    ends = near.groupBy(*group, "n", "place").agg(at(low).alias("x"), at(high).alias("y"))
    between = (high - F.col("place")) * F.col("x") + (F.col("place") - low) * F.col("y")
    return ends.select(*group, "n", F.when(F.col("x") == F.col("y"), F.col("x")).otherwise(between).alias("found"))


def _limits(held: DataFrame, langs: DataFrame, quantile: float, margin: float) -> DataFrame:
    """(of_lang, of_class, limit) for every class of ``langs``, the languages with a model.

    The limit is that of the language and class if ``LEAST_HELD`` texts were held
    out, else that of the language, or if it has too few as well, of all. Short
    texts vary more: a limit from other lengths is at least that of the class
    over all languages.
    """
    found = checkpoint(_quantiles(held, quantile))  # a row per language and class, and their sums
    of = lambda kind, least=0: found.filter((F.col("kind") == kind) & (F.col("n") >= least))
    limit = F.col("found") * margin
    own = of("own", LEAST_HELD).select("of_lang", "of_class", limit.alias("own"))
    of_language = of("language", LEAST_HELD).select("of_lang", limit.alias("of_language"))
    of_length = of("length").select("of_class", limit.alias("of_length"))
    classes = langs.select("of_lang", F.explode(F.array(*[F.lit(k) for k in range(len(LENGTHS) + 1)])).alias("of_class"))
    joined = classes.join(own, ["of_lang", "of_class"], "left").join(of_language, "of_lang", "left").join(of_length, "of_class", "left")
    joined = joined.join(F.broadcast(of("all").select(limit.alias("of_all"))), F.lit(True), "left")
    other = F.greatest(F.coalesce("of_language", "of_all"), "of_length")
    return joined.select("of_lang", "of_class", F.coalesce("own", other).alias("limit"))


def quality_scores(
    docs: DataFrame, labels: DataFrame, trusted: int | None = None, quantile: float = QUANTILE, margin: float = MARGIN
) -> DataFrame:
    """``docs`` (doc_id, text, lang and others) with perplexity, length_class, limit and kept.

    Trusted are all labelled rows with quality 1 and toxic 0, or if ``trusted``
    is given, about so many of each language by the hash of their id. ``limit`` is the ``quantile`` of
    held-out trusted perplexities, times ``margin``. A document is kept if its
    perplexity is not above; without text it is rejected; without a limit (no
    trusted text of its language, hence no model) it is kept. Columns of these
    names are replaced; null ids and languages, repeated rows and an empty table
    of labels are fine.
    """
    docs = docs.drop("perplexity", "length_class", "limit", "kept", "mean_logp")
    sample = checkpoint(_sample(docs, labels, trusted))
    tables = model(checkpoint(_counted(sample.filter("not held"))))
    corpus = _counted(docs.select("lang", "text")).select("lang", "gram")
    table = checkpoint(chances(corpus, tables))
    size = F.coalesce(F.octet_length(F.col("text")), F.lit(0))
    length_class = sum((size >= n).cast("int") for n in LENGTHS)
    perplexity = F.exp(-F.col("mean_logp"))
    held = scored(sample.filter("held").select("lang", "text"), table)
    held = held.select(F.coalesce("lang", F.lit("")).alias("of_lang"), length_class.alias("of_class"), perplexity.alias("perplexity"))
    limits = _limits(checkpoint(held), sample.filter("not held").select(F.coalesce("lang", F.lit("")).alias("of_lang")).distinct(), quantile, margin)
    every = scored(docs, table).withColumn("perplexity", perplexity).withColumn("length_class", length_class)
    judged = every.drop("mean_logp").join(
        checkpoint(limits),  # a row per language and class
        (F.coalesce("lang", F.lit("")) == F.col("of_lang")) & (F.col("length_class") == F.col("of_class")),
        "left",
    )
    kept = F.col("perplexity").isNotNull() & (F.col("limit").isNull() | (F.col("perplexity") <= F.col("limit")))
    return judged.drop("of_lang", "of_class").withColumn("kept", kept)
