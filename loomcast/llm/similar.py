"""Groups of similar sets, from candidate buckets.

A bucket is a key that several sets share. In a bucket of ``LARGE`` sets at most
all pairs of different components are looked at: those of a bucket of few are
joined and the keys that two sets share counted, those of a larger one are
compared by their signatures in one task: first each set with the closest one,
then those that this did not join. A signature has a bit for each of as
many classes of grams as the set has grams: whether the set has an odd number of
that class. Two sets differ in at least as many grams as their signatures differ
in bits, so what passes is similar, or nearly, and is compared exactly.

In a bucket of more sets every
set is compared exactly with one centre. Two members that are similar without
both being similar to the centre differ from it in some of the same grams: if
their differences D and E have none in common, the sets differ in |D| + |E|
grams, and a similar pair has so few of them that both are near the centre. So
the bucket is replaced by buckets of equal differences (by prefixes of them),
which are treated alike. No pair that could connect two components is left out.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomcast.llm.common import arrow_schema, distinct, mixed, release
from loomcast.llm.components import components
from loomcast.session import checkpoint

#: Most 64-bit words of a filter (16 MB). One that is too small for its values passes more, and joins drop the rest.
_MOST_WORDS = 1 << 21
#: Most values of a part, about, of the range of values that are counted part by part.
_IN_PART = 1 << 21
#: Sets of a bucket whose pairs are looked at; in general, half of this is the most pairs per set that may be.
LARGE = 2048
#: The same of a bucket whose pairs are joined.
FEW = 32
#: Pairs per set from which on each set is first compared with the closest one alone.
MANY = 4


@contextmanager
def small_batches(spark, rows: int = 64):
    """Rows go to Python in batches of so many while this holds: sets can be large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def wanted_filter(nodes: DataFrame, column: str = "node", many: int | None = None) -> np.ndarray:
    """Bits of the values (hashes; ``many`` if that is known), 64 or more for each up to ``_MOST_WORDS``; other values may pass too."""
    size = min(_MOST_WORDS, 1 << max(10, (nodes.count() if many is None else many).bit_length()))
    bit = F.col(column).bitwiseAND(size * 64 - 1)
    words = nodes.groupBy(F.shiftright(bit, 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(63).cast("int"))).alias("bits")
    )
    found = words.toArrow()
    out = np.zeros(size, np.uint64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def passes(values: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Which of the values (int64) may be wanted."""
    bit = values & (len(words) * 64 - 1)
    return (words[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) == 1


def counted_in_parts(df: DataFrame, values_of: Callable, kind: type, total: int, work: Callable, schema: str) -> DataFrame:
    """A table of the rows that ``work`` makes of sorted distinct values and of how often each is there, part by part of their range.

    ``values_of`` makes values (hashes, unsigned, of ``kind``) of a batch of
    ``df``; there are about ``total`` of them. A task sends a value that it has
    often once with its count, and all values of a part in one row.
    """
    arrow = arrow_schema(schema)
    shuffled = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = min(16, max(4 * shuffled, total // _IN_PART).bit_length())
    together = max(1 << 17, 1 << bits + 7)
    shift = kind(8 * np.dtype(kind).itemsize - bits)

    def sent(held):
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        ends = np.searchsorted(values >> shift, np.arange(1 << bits, dtype=kind), side="right")
        full = np.flatnonzero(np.diff(ends, prepend=0))
        blob = lambda x: pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer((np.concatenate([[0], ends]) * x.itemsize).astype(np.int32)), pa.py_buffer(x)])
        columns = [pa.array(full.astype(np.int32)), *(blob(x).take(pa.array(full)) for x in (values, counts.astype(np.uint32)))]
        return pa.RecordBatch.from_arrays(columns, names=["part", "values", "counts"])

    def dealt(batches):
        held, many = [], 0
        for batch in batches:
            held.append(values_of(batch))
            many += len(held[-1])
            if many >= together:
                yield sent(held)
                held, many = [], 0
        if many:
            yield sent(held)
        release()

    def made(held):
        values, counts = (np.frombuffer(b"".join(x), t) for x, t in zip(zip(*held, strict=True), (kind, np.uint32), strict=True))
        order = np.argsort(values)
        values = values[order]
        first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
        columns = work(values[first], np.add.reduceat(counts[order].astype(np.int64), first))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    def gathered(batches):
        now, held = None, []
        for batch in batches:
            for part, *both in zip(*(batch.column(c).to_pylist() for c in ("part", "values", "counts")), strict=True):
                if part != now and held:
                    yield made(held)
                    held = []
                now = part
                held.append(both)
        if held:
            yield made(held)
        release()

    parts = df.mapInArrow(dealt, "part int, values binary, counts binary").repartition("part")
    with small_batches(df.sparkSession, 512):  # of texts, or of rows that hold many values
        return checkpoint(parts.sortWithinPartitions("part").mapInArrow(gathered, schema))


def last_bits(column: str, bits: int):
    """The last bits of a 64-bit value, signed."""
    return F.shiftright(F.shiftleft(column, 64 - bits), 64 - bits)


def _few_rows(batches, rows: int = 1024):
    """Batches of so many rows: each can hold many keys."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All keys of a batch and the row of each."""
    lists = batch.column("keys")
    return lists.flatten().to_numpy(), np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())


def shared_postings(keyed: DataFrame) -> DataFrame:
    """(key, node, n, rest) of the keys that two different nodes of ``keyed`` (node, n, rest, quiet, keys) have, and few others.

    A key and its node are counted as one number, of as many bits of the key as
    tell most keys apart; the other bits, 24 or more, are of the node. Copies of a set
    (equal nodes) share no key here. Each batch sends two rows a key at most, so
    a hot key is a few rows. ``quiet`` has a bit for each key whose set was
    compared with another one of its text that has the key, and is not similar:
    such keys are counted apart, inverted. What a filter of the shared keys
    passes is all that is made a row a key.
    """
    total = keyed.agg(F.sum(F.size("keys"))).first()[0] or 0
    of_node = 64 - min(40, max(32, total.bit_length() + 6))

    def counted(batch):
        found = []
        for some in _few_rows([batch]):
            keys, row = _flat(some)
            place = np.arange(len(row)) - np.searchsorted(row, row)
            hushed = some.column("quiet").to_numpy()[row] >> place & 1 == 1
            key = np.where(hushed, ~keys, keys).view(np.uint64) << np.uint64(of_node)
            node = some.column("node").to_numpy()[row] ^ keys  # nodes that look alike under one key differ under the next
            node = mixed(node.view(np.uint64)) & np.uint64((1 << of_node) - 1)
            both = distinct(key | node)
            edge = np.diff(both >> np.uint64(of_node)) != 0
            found.append(both[np.concatenate([[True], edge]) | np.concatenate([edge, [True]])] if len(both) else both)
        return np.concatenate(found)

    def shared(both, _):
        short = both >> np.uint64(of_node)
        return [distinct(short[1:][short[1:] == short[:-1]]).view(np.int64)]

    ends = counted_in_parts(keyed.select("node", "quiet", "keys"), counted, np.uint64, total, shared, "short long")
    words = keyed.sparkSession.sparkContext.broadcast(wanted_filter(ends, "short"))
    schema = "key long, node long, n long, rest long"
    arrow = arrow_schema(schema)

    def run(batches):
        for batch in _few_rows(batches):
            keys, row = _flat(batch)
            at = np.flatnonzero(passes(keys, words.value) | passes(~keys, words.value))
            row = pa.array(row[at])
            columns = [pa.array(keys[at]), *(batch.column(c).take(row) for c in ("node", "n", "rest"))]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)
        release()

    return keyed.select("node", "n", F.col("rest").cast("long"), "keys").mapInArrow(run, schema)


def signatures(grams: np.ndarray, n: np.ndarray) -> pa.Array:
    """Signature of each set; the grams of sets of ``n`` grams stand one after the other."""
    bits = np.left_shift(1, np.ceil(np.log2(np.maximum(n, 64))).astype(np.int64))
    first = np.cumsum(bits) - bits
    place = np.repeat(first, n) + (grams & np.repeat(bits - 1, n).astype(np.uint64)).astype(np.int64)
    odd = np.bincount(place, minlength=int(bits.sum())) & 1
    ends = np.concatenate([[0], np.cumsum(bits) // 8]).astype(np.int32)
    data = np.packbits(odd.astype(np.uint8), bitorder="little")
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _stacked(some: list[bytes]) -> np.ndarray:
    """Signatures of one length as rows of words."""
    return np.frombuffer(b"".join(some), np.uint64).reshape(len(some), -1)


def _folded(rows: np.ndarray, words: int) -> np.ndarray:
    """Signatures as those of fewer classes."""
    while rows.shape[1] > words:
        half = rows.shape[1] // 2
        rows = rows[:, :half] ^ rows[:, half:]
    return rows


def _bits(rows: np.ndarray) -> np.ndarray:
    return np.bitwise_count(rows).sum(axis=1, dtype=np.int64)


def differing(x: list[bytes], y: list[bytes]) -> np.ndarray:
    """Bits in which the signatures of pairs of sets differ: no more than the grams in which the sets do."""
    out = np.zeros(len(x), np.int64)
    kind = np.array([len(a) << 32 | len(b) for a, b in zip(x, y, strict=True)], np.int64)
    for k in np.unique(kind):
        at = np.flatnonzero(kind == k)
        p, q = (_stacked([some[i] for i in at]) for some in (x, y))
        words = min(p.shape[1], q.shape[1])
        out[at] = _bits(_folded(p, words) ^ _folded(q, words))
    return out


def _can_be_similar(far, n, m, percent: int):
    """Whether sets of n and m grams that differ in ``far`` grams, or more, can be similar."""
    return far * (100 + percent) <= (100 - percent) * (n + m)


def _signed(signed: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, n, signature) of the given nodes, and of few others; ``signed`` can have a node many times."""
    words = signed.sparkSession.sparkContext.broadcast(wanted_filter(nodes))

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(passes(batch.column("node").to_numpy(), words.value)))
        release()

    return signed.select("node", "n", "signature").mapInArrow(run, "node long, n long, signature binary").dropDuplicates(["node"])


def _near(pairs: DataFrame, signed: DataFrame, percent: int) -> DataFrame:
    """(a, b, far) of the pairs (a, b) that can be similar by their signatures; ``far`` is the number of bits that differ."""

    def run(batches):
        for batch in batches:
            far = differing(batch.column("x").to_pylist(), batch.column("y").to_pylist())
            keep = _can_be_similar(far, batch.column("p").to_numpy(), batch.column("q").to_numpy(), percent)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(far)], names=["a", "b", "far"]).filter(pa.array(keep))
        release()

    x = signed.select(F.col("node").alias("a"), F.col("n").alias("p"), F.col("signature").alias("x"))
    y = signed.select(F.col("node").alias("b"), F.col("n").alias("q"), F.col("signature").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "p", "q", "x", "y").mapInArrow(run, "a long, b long, far long")


def _near_in_buckets(middle: DataFrame, signed: DataFrame, percent: int, closest: bool) -> DataFrame:
    """``_near`` of the pairs of different components and of sides that meet, in buckets of ``LARGE`` sets at most.

    All of them, or with ``closest`` those of each set and the closest other one of its bucket.
    """

    def run(bucket: pa.Table) -> pa.Table:
        bucket = bucket.sort_by("n")
        node, label, side, n = (bucket.column(c).to_numpy() for c in ("node", "label", "side", "n"))
        signature = bucket.column("signature").to_pylist()
        size = np.array([len(x) // 8 for x in signature])  # in order, as a larger set has no shorter signature
        ends = np.searchsorted(n, n * 100 // percent, side="right")
        blocks = [(w, *np.searchsorted(size, [w, w + 1]).tolist()) for w in np.unique(size).tolist()]
        found = [(np.zeros(0, np.int64),) * 3]
        least, nearest = np.full(len(n), np.iinfo(np.int64).max), np.zeros(len(n), np.int64)
        for words, low, high in blocks:
            own = _stacked(signature[low:high])
            for other, first, after in blocks:
                if other < words or ends[high - 1] <= first:
                    continue
                longer = _folded(_stacked(signature[first:after]), words)
                for i in range(low, high):
                    start, end = max(i + 1, first), min(int(ends[i]), after)
                    if start < end:
                        far = _bits(longer[start - first : end - first] ^ own[i - low])
                        keep = _can_be_similar(far, n[i], n[start:end], percent) & (label[start:end] != label[i])
                        at = np.flatnonzero(keep & (side[start:end] + side[i] == 0))
                        if not closest:
                            found.append((np.full(len(at), node[i]), node[start + at], far[at]))
                        elif len(at):
                            j, far = start + at, far[at]
                            nearer = far < least[j]
                            least[j[nearer]], nearest[j[nearer]] = far[nearer], i
                            if far.min() < least[i]:
                                least[i], nearest[i] = far.min(), j[far.argmin()]
        if closest:
            at = np.flatnonzero(least < np.iinfo(np.int64).max)
            found.append((node[at], node[nearest[at]], least[at]))
        a, b, far = (np.concatenate(x) for x in zip(*found, strict=True))
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b), "far": far})

    rows = middle.select("key", "node", "label", "side").join(signed, "node")
    return rows.groupBy("key").applyInArrow(run, "a long, b long, far long")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have a Jaccard similarity of ``percent`` / 100 or more, exactly."""

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                same = len(x) - len(_without(x, y))
                keep.append(100 * same >= percent * (len(x) + len(y) - same))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
        release()

    x = sets.select(F.col("node").alias("a"), F.col("grams").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.col("grams").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def linked_sets(
    postings: DataFrame,
    signed: DataFrame,
    sets_of: Callable[[DataFrame], DataFrame],
    percent: int,
    rounds: int = 8,
) -> DataFrame:
    """(node, label) of the sets that are linked to another, but for the least of each component.

    ``postings``: (key, node, n, rest), a set's keys and size; similar sets share
    a key. Where the keys are the first grams in a common order, ``rest`` is the
    number of the others, else n. ``signed`` has (node, n, signature) of all
    nodes, ``sets_of`` returns (node, grams) for at least the given ones. Buckets
    that are still large after ``rounds`` are compared pair by pair.
    """
    # keys are those of differences from a centre, at first from the empty set
    zero = F.lit(0).cast("long")
    now = postings.groupBy("key", "node").agg(F.first("n").alias("n"), F.first("rest").alias("rest"))
    now = now.select("key", "node", "n", zero.alias("base"), F.col("n").alias("d"), "rest", zero.alias("side"))
    labels = sets = signs = None

    def with_sets(nodes):
        """``sets`` with those of further nodes."""
        nodes = nodes.distinct()
        nodes = checkpoint(nodes if sets is None else nodes.join(sets.select("node"), "node", "left_anti"))
        if nodes.isEmpty() and sets is not None:
            return sets
        new = checkpoint(sets_of(nodes).dropDuplicates(["node"]).select("node", "grams"))
        return new if sets is None else sets.union(new)

    def exactly(pairs):
        """``labels`` with the links among the pairs."""
        with small_batches(pairs.sparkSession):
            return _joined(labels, checkpoint(verified(pairs, sets, percent)))

    for turn in range(rounds + 1):
        largest = LARGE if turn < rounds else float("inf")
        now = checkpoint(_in_buckets(now, labels, turn, largest))
        is_large = F.col("cost") > largest / 2
        is_middle = ~is_large & (F.col("cost") > FEW / 2) & (F.col("members") <= LARGE)
        every, middle, large = now.agg(*[F.count(F.when(c, 1)) for c in (F.lit(True), is_middle, is_large)]).first()
        if not every:
            break
        if signs is None:
            signs = checkpoint(_signed(signed, checkpoint(now.select("node").distinct())))
        pairs = _near(_all_pairs(now.filter(~is_large & ~is_middle), percent), signs, percent)
        if middle:
            pairs = pairs.union(_near_in_buckets(now.filter(is_middle), signs, percent, closest=True)).distinct()
        with small_batches(now.sparkSession, 1024):
            pairs = checkpoint(pairs)
        if not pairs.isEmpty():
            sets = with_sets(pairs.select(F.col("a").alias("node")).union(pairs.select("b")))
            if pairs.count() > MANY * sets.count():
                ends = pairs.union(pairs.select("b", "a", "far"))
                closest = ends.groupBy("a").agg(F.min_by("b", F.struct("far", "b")).alias("b"))
                labels = exactly(closest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
                pairs = _apart(pairs, labels)
            labels = exactly(pairs.select("a", "b"))
            if middle:  # of sets that all have a closest one, so their grams are known
                left = _near_in_buckets(_named(now.filter(is_middle), labels), signs, percent, closest=False)
                labels = exactly(left.select("a", "b").distinct())
        if not large:
            break
        spokes = checkpoint(now.filter(is_large).filter("node != centre").select("node", "n", "centre").distinct())
        sets = with_sets(spokes.select("node").union(spokes.select("centre")))
        with small_batches(now.sparkSession):
            compared = checkpoint(_against_centres(spokes, sets, percent))
        links = compared.filter("linked").select(F.col("node").alias("a"), F.col("centre").alias("b"))
        labels = _joined(labels, links)
        now = compared.select("node", "n", "d", F.explode("posted").alias("p"))
        now = now.select(F.explode("p.keys").alias("key"), "node", "n", "p.base", "d", "p.rest", "p.side")
    return postings.limit(0).select("node", F.col("node").alias("label")) if labels is None else labels


def _in_buckets(now: DataFrame, labels: DataFrame | None, turn: int, largest: float) -> DataFrame:
    """Postings of the buckets of more than one component, with the ``members`` and the ``cost`` (pairs per set) of theirs.

    Those of buckets with more pairs than a bucket of ``largest`` sets have a ``centre``.
    """
    of_key = Window.partitionBy("key")
    count = lambda side: F.count(F.when(F.col("side") == side, 1)).over(of_key)
    members = F.count(F.lit(1)).over(of_key)
    cost = (count(0) * count(0) / 2 + count(1) * count(-1)) / members
    rank = F.xxhash64("node", F.lit(turn))
    rows = _named(now, labels).select("*", members.alias("members"), cost.alias("cost"), F.min_by("node", rank).over(of_key).alias("centre"), F.min("label").over(of_key).alias("low"), F.max("label").over(of_key).alias("high"))
    return rows.filter("low < high").drop("low", "high").withColumn("centre", F.when(F.col("cost") > largest / 2, F.col("centre")))


def _named(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``rows`` with the present ``label`` of each node."""
    if labels is None:
        return rows.withColumn("label", F.col("node"))
    return rows.drop("label").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _joined(labels: DataFrame | None, links: DataFrame) -> DataFrame | None:
    """Labels with further links; the same ones where there are none."""
    if links.isEmpty():
        return labels
    return components(links if labels is None else links.union(labels))


def _apart(pairs: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The pairs whose sets are in different components."""
    if labels is None:
        return pairs
    of = lambda end: labels.select(F.col("node").alias(end), F.col("label").alias(f"of_{end}"))
    both = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    return both.filter(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select(*pairs.columns)


def _all_pairs(few: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that share a bucket of few sets and can be similar.

    Two sets whose differences from the base share o grams differ in d + e - 2o
    grams. Of the keys they share, those in these buckets are counted; beyond
    them they share at most as many grams as the one whose keys end first has
    left. Pairs that share a key of another bucket meet there as well.
    """
    own = ["node", "n", "base", "d", "rest", "side", "label"]
    here = few.select("key", *own)
    there = here.select("key", *[F.col(c).alias(f"other_{c}") for c in own])
    pairs = here.join(there, "key").filter("node < other_node and label != other_label and side + other_side = 0")
    pairs = pairs.filter((F.col("n") * 100 >= F.col("other_n") * percent) & (F.col("other_n") * 100 >= F.col("n") * percent))
    # equal keys have equal bases; what the count of keys must reach is known before the count
    least = (F.col("d") + F.col("other_d")) * (100 + percent) - (F.col("n") + F.col("other_n")) * (100 - percent)
    need = F.ceil(least / (2 * (100 + percent))) - F.greatest("rest", "other_rest")
    pairs = pairs.select(F.col("node").alias("a"), F.col("other_node").alias("b"), "base", need.cast("long").alias("need"))
    counted = pairs.groupBy("a", "b", "base", "need").agg(F.count(F.lit(1)).alias("c"))
    return counted.filter("c >= need").select("a", "b").distinct()


def _against_centres(spokes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, n, centre) with ``linked``, the number ``d`` of differences and what is ``posted`` of them.

    Similar sets x and y differ in at most k (|x| + |y|) grams, k = (100 - percent)
    / (100 + percent), and in at most h = |x| (100 - percent) / percent. Two members
    with d and e differences from the centre c of which they share o differ in
    d + e - 2o. Members linked to the centre need no link among each other. Where
    y is not linked, e > k (|y| + |c|), so x shares o > (d + k (|c| - |x|)) / 2 of
    its differences with any such y that it is similar to: more than half, or
    somewhat less where the centre is smaller than x. One that is not linked
    shares all but h of its differences with a linked one. In a common order,
    what is left of d beyond o, plus one, then holds a shared difference.
    Sides 1 and -1 meet each other, side 0 meets itself.
    """
    posted = "array<struct<keys:array<long>,base:long,rest:long,side:long>>"
    schema = arrow_schema(f"node long, n long, centre long, linked boolean, d long, posted {posted}")

    def run(batches):
        for batch in batches:
            linked, count, posted = [], [], []
            for centre, x, y in zip(*(batch.column(c).to_pylist() for c in ("centre", "x", "y")), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                added, missing = _without(x, y), _without(y, x)
                same, d = len(x) - len(added), len(added) + len(missing)
                near = 100 * same >= percent * (same + d)
                own = np.concatenate([mixed(added), mixed(~missing)])  # what was added is rarer
                least = (d * (100 + percent) + (len(y) - len(x)) * (100 - percent)) // (2 * (100 + percent)) + 1
                first = max(0, d - least + 1)
                sides = [(1, first)] if near else [(0, first), (-1, min(d, len(x) * (100 - percent) // percent + 1))]
                posted.append([_posting(own[:size], centre, d - size, side) for side, size in sides])
                linked.append(near)
                count.append(d)
            columns = [*(batch.column(c) for c in ("node", "n", "centre")), linked, count, posted]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
        release()

    x = sets.select("node", F.col("grams").alias("x"))
    y = sets.select(F.col("node").alias("centre"), F.col("grams").alias("y"))
    joined = spokes.join(x, "node").join(y, "centre").select("node", "n", "centre", "x", "y")
    return joined.mapInArrow(run, f"node long, n long, centre long, linked boolean, d long, posted {posted}")


def _posting(own: np.ndarray, centre: int, rest: int, side: int) -> dict:
    """Keys that only members compared with the same centre, and of a side that it meets, can share."""
    base = mixed(np.array([centre], np.int64).view(np.uint64) + np.uint64(abs(side)))
    return {"keys": mixed(own ^ base).view(np.int64), "base": int(base.view(np.int64)[0]), "rest": rest, "side": side}


def _without(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Values of sorted ``x`` that are not in sorted ``y``."""
    if not len(y):
        return x
    return x[y[np.minimum(np.searchsorted(y, x), len(y) - 1)] != x]
