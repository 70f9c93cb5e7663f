"""Secret scans by one deterministic automaton for all rules.

Each rule is a regular expression over bytes. All rules are compiled to one
automaton by subset construction and minimised into a transition array; a text
is read once, byte by byte, for all of them. Bytes that lead every state to the
start state part the text into stretches that are read side by side. Where a
rule accepts, its reversed automaton finds the leftmost start.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loomcast.llm.common import byte_texts, slices

_WORD = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
_UPPER = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
_HEX = frozenset(b"0123456789abcdef")
_VALUE = _WORD | frozenset(b"+/_.=-")


# A rule's expression is built from these: a set of bytes, or a tuple.
def text(word: str, fold: bool = False):
    """The word itself, in either case if ``fold``."""
    return ("seq", *(frozenset(f"{c.lower()}{c.upper()}".encode() if fold else c.encode()) for c in word))


def seq(*parts):
    return ("seq", *parts)


def either(*parts):
    return ("or", *parts)


def many(part, least: int = 0):
    """``least`` times or more."""
    return ("seq", *[part] * least, ("star", part))


def maybe(part):
    return ("or", part, ("seq",))


@dataclass(frozen=True)
class Rule:
    """A kind of secret: each match ends where its last byte class ends.

    A match shorter than ``least`` bytes is dropped, and so is one whose
    assigned value is shorter than ``value`` bytes. Lengths are tested after
    the match: counted repeats would multiply the automaton's states.
    """

    kind: str
    expression: tuple
    least: int = 0
    value: int = 0


_QUOTE = frozenset(b"\"'")
_KEYS = [text(w, True) for w in ("password", "passwd", "secret", "token")]
_API_KEY = seq(text("api", True), maybe(text("_")), text("key", True))

#: The kinds of the contract.
BASE = (
    Rule(
        "assign",
        seq(
            either(*_KEYS, _API_KEY), maybe(_QUOTE), many(frozenset(b" ")), frozenset(b":="),
            many(frozenset(b" ")), maybe(_QUOTE), many(_VALUE, 1),
        ),
        value=6,
    ),
    Rule("access", seq(text("AKIA"), many(_UPPER, 1)), 20),
    Rule("hex", many(_HEX, 24)),
)

#: Kinds that the method adds.
MORE = (
    Rule("github", seq(text("gh"), frozenset(b"pousr"), text("_"), many(_WORD, 1)), 40),
    Rule("slack", seq(text("xox"), frozenset(b"abprs"), text("-"), many(_WORD | frozenset(b"-"), 1)), 21),
    Rule("google", seq(text("AIza"), many(_WORD | frozenset(b"_-"), 1)), 39),
    Rule(
        "private_key",
        seq(text("-----BEGIN "), many(_UPPER | frozenset(b" ")), text("PRIVATE KEY-----")),
    ),
)


def _nfa(expression):
    """(steps, empty steps, start, end) of an expression; steps: state -> [(bytes, state)]."""
    steps: list[list] = []
    empty: list[list] = []

    def state():
        steps.append([])
        empty.append([])
        return len(steps) - 1

    def build(x, first):
        if isinstance(x, frozenset):
            last = state()
            steps[first].append((x, last))
            return last
        kind, *parts = x
        if kind == "seq":
            for p in parts:
                first = build(p, first)
            return first
        if kind == "or":
            last = state()
            for p in parts:
                begin = state()
                empty[first].append(begin)
                empty[build(p, begin)].append(last)
            return last
        hub = state()
        empty[first].append(hub)
        empty[build(parts[0], hub)].append(hub)
        return hub

    start = state()
    return steps, empty, start, build(expression, start)


def _reversed(x):
    if isinstance(x, frozenset):
        return x
    kind, *parts = x
    parts = [_reversed(p) for p in parts]
    return (kind, *(parts[::-1] if kind == "seq" else parts))


@dataclass(frozen=True)
class Automaton:
    """Transition array ``step[state * classes + class_of[byte]]``; bits of ``accepts`` are rules."""

    step: np.ndarray
    accepts: np.ndarray
    class_of: np.ndarray
    classes: int

    def resets(self) -> np.ndarray:
        """For each byte whether it leads every state to the start state, 0."""
        table = self.step.reshape(-1, self.classes)
        return (table == 0).all(axis=0)[self.class_of]


def compile_rules(expressions: list, anywhere: bool) -> Automaton:
    """Minimal automaton for several expressions; ``anywhere``: a match may begin at any byte."""
    steps, empty, starts, ends = [], [], [], []
    for e in expressions:
        s, n, first, last = _nfa(e)
        shift = len(steps)
        steps += [[(b, t + shift) for b, t in x] for x in s]
        empty += [[t + shift for t in x] for x in n]
        starts.append(first + shift)
        ends.append(last + shift)

    @lru_cache(None)
    def closed(state: int) -> frozenset:
        seen, todo = {state}, [state]
        while todo:
            for t in empty[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)

    # bytes that no step tells apart form one class
    sets = list({b for x in steps for b, _ in x})
    signs = [tuple(byte in s for s in sets) for byte in range(256)]
    number = {sign: i for i, sign in enumerate(dict.fromkeys(signs))}
    class_of = np.array([number[s] for s in signs])
    sample = [signs.index(s) for s in number]

    begin = frozenset().union(*(closed(s) for s in starts))
    found, order, table = {begin: 0}, [begin], []
    for states in order:  # grows while it is read: subset construction
        row = []
        for byte in sample:
            to = set(begin) if anywhere else set()
            for s in states:
                for allowed, t in steps[s]:
                    if byte in allowed:
                        to |= closed(t)
            to = frozenset(to)
            if to not in found:
                found[to] = len(order)
                order.append(to)
            row.append(found[to])
        table.append(row)
    table = np.array(table)
    accepts = np.array([sum(1 << i for i, e in enumerate(ends) if e in s) for s in order])
    # minimise: split groups of states until none is told apart by where its bytes lead
    group = np.unique(accepts, return_inverse=True)[1]
    while True:
        sign = np.column_stack([group, group[table]])
        finer = np.unique(sign, axis=0, return_inverse=True)[1].reshape(-1)
        if finer.max() == group.max():
            break
        group = finer
    first_of = np.unique(group, return_index=True)[1]
    rank = np.empty(len(first_of), np.int64)
    rank[np.argsort(first_of)] = np.arange(len(first_of))  # the start state keeps number 0
    group, first_of = rank[group], np.sort(first_of)
    return Automaton(
        group[table[first_of]].astype(np.int32).reshape(-1), accepts[first_of].astype(np.int64), class_of, len(sample)
    )


class Scanner:
    """Finds the spans of all rules in many texts at once."""

    def __init__(self, rules=BASE + MORE):
        self.rules = rules
        self.all = compile_rules([r.expression for r in rules], anywhere=True)
        self.back = [compile_rules([_reversed(r.expression)], anywhere=False) for r in rules]
        self.dead = [self._dead(a) for a in self.back]
        self.reset = self.all.resets()
        if not self.reset[10]:
            raise ValueError("no rule may run over a line end")

    @staticmethod
    def _dead(a: Automaton) -> int:
        table = a.step.reshape(-1, a.classes)
        stuck = (table == np.arange(len(table))[:, None]).all(axis=1) & (a.accepts == 0)
        return int(np.flatnonzero(stuck)[0]) if stuck.any() else -1

    def spans(self, texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
        """For each text its (rule, first byte, byte after the last), leftmost and non-overlapping per rule."""
        out: list[list] = [[] for _ in texts]
        if not texts:
            return out
        joined = b"\n".join(texts) + b"\n"
        data = np.frombuffer(joined, np.uint8)
        where, bits = self._accepted(data)
        begins = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])[:-1]])
        for i, rule in enumerate(self.rules):
            at = where[(bits >> i) & 1 == 1]
            ends = at[np.append(at[1:] != at[:-1] + 1, True)] + 1 if len(at) else at
            previous = 0
            for end in ends.tolist():
                doc = int(np.searchsorted(begins, end - 1, side="right")) - 1
                low = max(previous, int(begins[doc]))
                start = self._start(joined, i, low, end)
                if start is None:
                    continue
                previous = end
                if end - start < rule.least or rule.value and end - self._value_start(joined, start, end) < rule.value:
                    continue
                out[doc].append((i, start - int(begins[doc]), end - int(begins[doc])))
        return out

    @staticmethod
    def _value_start(data: bytes, start: int, end: int) -> int:
        """First byte of an assigned value: after the first sign, spaces and a quote."""
        at = start
        while at < end and data[at] not in b":=":
            at += 1
        at += 1
        while at < end and data[at] == 32:
            at += 1
        return at + (at < end and data[at] in _QUOTE)

    def _accepted(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions whose byte brings the automaton to an accepting state, and the rules' bits there."""
        stops = np.flatnonzero(self.reset[data])
        first = np.concatenate([[0], stops[:-1] + 1])
        length = stops - first
        order = np.argsort(-length, kind="stable")
        first, length = first[order], length[order]
        active = np.searchsorted(-length, -np.arange(1, length[0] + 1), side="right") if len(length) else []
        a = self.all
        kinds = a.class_of.astype(np.int32)[data]
        state = np.zeros(len(first), np.int32)
        hits = a.accepts > 0
        at, bits = [], []
        for t, n in enumerate(active):
            state[:n] = s = a.step[state[:n] * a.classes + kinds[first[:n] + t]]
            hit = np.flatnonzero(hits[s])
            if len(hit):
                at.append(first[hit] + t)
                bits.append(a.accepts[s[hit]])
        if not at:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, bits = np.concatenate(at), np.concatenate(bits)
        order = np.argsort(at, kind="stable")
        return at[order], bits[order]

    def _start(self, data: bytes, rule: int, low: int, end: int) -> int | None:
        """Leftmost start, not before ``low``, of a match of the rule that ends at ``end``."""
        a, state, found = self.back[rule], 0, None
        step, kinds, classes, accepts, dead = a.step, a.class_of, a.classes, a.accepts, self.dead[rule]
        at = end
        while at > low:
            at -= 1
            state = int(step[state * classes + kinds[data[at]]])
            if state == dead:
                break
            if accepts[state]:
                found = at
        return found


_SCANNERS: dict[tuple, Scanner] = {}


def scanner(rules=BASE + MORE) -> Scanner:
    """The scanner of this worker, compiled once."""
    key = tuple(r.kind for r in rules), hash(rules)
    if key not in _SCANNERS:
        _SCANNERS[key] = Scanner(rules)
    return _SCANNERS[key]


def secret_spans(docs: DataFrame, rules=BASE + MORE) -> DataFrame:
    """Adds ``secret_spans``: array of (kind, start, end), by start and rule, in code points, end exclusive.

    All columns of ``docs`` stay; a clashing ``secret_spans`` is replaced. A
    null or empty text has no spans. Repeated rows are each scanned.
    """
    kept = docs.drop("secret_spans")

    def run(batches):
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for part in slices(batches):
            texts = byte_texts(part.column("text"))
            found = []
            for t, spans in zip(texts, scanner(rules).spans(texts), strict=True):
                rows = [
                    (len(t[:b].decode()), i, len(t[:e].decode())) for i, b, e in spans
                ]  # few texts hold a secret
                found.append([{"kind": rules[i].kind, "start": b, "end": e} for b, i, e in sorted(rows)])
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(found, kind)], names=[*part.schema.names, "secret_spans"]
            )

    added = StructType.fromDDL("secret_spans array<struct<kind:string,start:long,end:long>>")
    return kept.mapInArrow(run, StructType([*kept.schema.fields, *added.fields]))


def redact(docs: DataFrame, rules=BASE + MORE, mark: str = "[REDACTED]") -> DataFrame:
    """``docs`` with each secret replaced by ``mark``; spans that overlap are replaced as one.

    A null text stays null. ``n_chars``, if there is one, is counted again where
    the text changed.
    """
    found = secret_spans(docs, rules)

    def run(batches):
        for part in batches:
            texts, spans = part.column("text").to_pylist(), part.column("secret_spans").to_pylist()
            for i, (t, own) in enumerate(zip(texts, spans, strict=True)):
                if own:
                    cut, after = [], 0
                    for s in own:
                        if s["start"] >= after:
                            cut += [t[after : s["start"]], mark]
                        after = max(after, s["end"])
                    texts[i] = "".join([*cut, t[after:]])
            fields = {n: part.column(n) for n in part.schema.names if n != "secret_spans"}
            if "n_chars" in fields:
                count = [len(t) if own else n for t, own, n in zip(texts, spans, fields["n_chars"].to_pylist(), strict=True)]
                fields["n_chars"] = pa.array(count, part.schema.field("n_chars").type)
            fields["text"] = pa.array(texts, part.schema.field("text").type)
            yield pa.RecordBatch.from_pydict(fields)

    return found.mapInArrow(run, docs.drop("secret_spans").schema)


def secret_report(docs: DataFrame, rules=BASE + MORE) -> DataFrame:
    """One row per document: counts and digests of the base kinds, and all spans as text."""
    base = [r.kind for r in BASE]
    spans = F.col("secret_spans")
    part = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    own = F.filter(spans, lambda s: s["kind"].isin(base))
    of_kind = lambda k: F.filter(spans, lambda s: s["kind"] == k)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in base]
    return secret_spans(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), rules).select(
        "doc_id",
        *counts,
        F.sha2(F.array_join(F.transform(own, part), ","), 256).alias("base_sha256"),
        F.array_join(F.transform(spans, part), ",").alias("spans"),
    )
