"""Adaptive context-mixing range coder over blocks of 16-bit ids.

An id is named by its rank, the order of first appearance in its block. Orders 2
and 1 (the two ids before, the id before) name a candidate for the next rank.
How far it is trusted is a logistic mix of one adaptive estimate per order, the
order-0 one by the candidate's rank. A missed candidate is coded by order 0:
adaptive counts of the ranks' powers of two, where frequent ids have low ranks;
a first appearance carries the id itself. Every block starts from the same
state, so many blocks are coded side by side as lanes of arrays. All arithmetic
is on integers, hence the same on every machine.
"""

from __future__ import annotations

import numpy as np

BLOCK = 4096  # ranks and trust share 16 bits: at most 8192
_SLOTS1, _SLOTS2 = 12, 13  # bits of the candidate tables
_ADD, _LIMIT = 32, 4096
_KINDS = 15  # first appearance, rank 0, ranks from 1, 2, 4, ... 4096
#: What a symbol adds to the cumulative counts; the last row is for lanes that code none.
_STEPS = np.array([[_ADD if j > s else 0 for j in range(_KINDS + 1)] for s in range(_KINDS)] + [[0] * (_KINDS + 1)], np.int64)
_RATE = 5
_TOP = np.uint64(1 << 48)
_LOW = np.uint64((1 << 48) - 1)
_WORD = np.uint64(16)
_FEW = np.uint64(1 << 32)

# p in 1/4096 to 256 * ln(p / (1 - p)), and back
_P = (np.arange(4096) + 0.5) / 4096
_STRETCH = np.clip(np.round(np.log(_P / (1 - _P)) * 256), -2047, 2047).astype(np.int64)
_SQUASH = np.clip(np.round(4096 / (1 + np.exp(-np.arange(-2047, 2048) / 256))), 1, 4095).astype(np.int64)
#: Symbol, bits that follow and first rank of a rank.
_KIND_OF = np.array([1, *(int(r).bit_length() + 1 for r in range(1, 8192))])
_BITS = np.array([16, 0, *range(_KINDS - 2)], np.uint64)
_FIRST = np.array([0, 0, *(1 << b for b in range(_KINDS - 2))])


class _Encoder:
    """Lanes of a range coder with 48-bit ranges that writes 16-bit words."""

    def __init__(self, lanes: int, words: int):
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, _LOW, np.uint64)
        self.words = np.zeros((lanes, words), np.uint32)
        self.at = np.zeros(lanes, np.int64)

    def narrow(self, n, add, span):
        """Takes [low + add, low + add + span) in the first ``n`` lanes."""
        low = self.low[:n]
        low += add
        self.range[:n] = span
        over = np.flatnonzero(low >= _TOP)
        if len(over):
            self.words[over, self.at[over] - 1] += 1
            low[over] &= _LOW
        short = np.flatnonzero(span < _FEW)
        while len(short):
            self.words[short, self.at[short]] = low[short] >> np.uint64(32)
            self.at[short] += 1
            low[short] = (low[short] << _WORD) & _LOW
            self.range[short] <<= _WORD
            short = short[self.range[short] < _FEW]

    def finish(self) -> list[bytes]:
        every = np.arange(len(self.at))
        for shift in (32, 16, 0):
            self.words[every, self.at] = (self.low >> np.uint64(shift)) & np.uint64(0xFFFF)
            self.at += 1
        while (carry := self.words >> 16).any():
            self.words &= 0xFFFF
            self.words[:, :-1] += carry[:, 1:]
        return [w[:n].astype("<u2").tobytes() for w, n in zip(self.words, self.at, strict=True)]


class _Decoder:
    def __init__(self, payloads: list[bytes]):
        self.words = np.zeros((len(payloads), max(map(len, payloads)) // 2 + 4), np.uint64)
        for i, p in enumerate(payloads):
            self.words[i, : len(p) // 2] = np.frombuffer(p, "<u2")
        self.gap = (self.words[:, 0] << np.uint64(32)) | (self.words[:, 1] << _WORD) | self.words[:, 2]
        self.range = np.full(len(payloads), _LOW, np.uint64)
        self.at = np.full(len(payloads), 3)

    def narrow(self, n, add, span):
        gap = self.gap[:n]
        gap -= add
        self.range[:n] = span
        short = np.flatnonzero(span < _FEW)
        while len(short):
            # a damaged block may ask for more than there is; its checksum will tell
            word = self.words[short, np.minimum(self.at[short], self.words.shape[1] - 1)]
            self.at[short] += 1
            gap[short] = ((gap[short] << _WORD) & _LOW) | word
            self.range[short] = (self.range[short] << _WORD) | np.uint64(self.range[short].min() == 0)
            short = short[self.range[short] < _FEW]


class _Model:
    """State of all lanes; a coder codes what the model predicts."""

    def __init__(self, lanes: int):
        self.counts = np.tile(np.arange(_KINDS + 1), (lanes, 1))
        self.known = np.zeros(lanes, np.int64)  # distinct ids so far
        self.guess = [np.zeros(lanes << b, np.uint16) for b in (_SLOTS1, _SLOTS2)]  # rank * 8 + trust
        self.hits = [np.full(lanes * k, 2048, np.int64) for k in (16, 16, 16)]
        self.weights = np.full((3, lanes), 1 << 15, np.int64)
        self.last = np.full((2, lanes), 8191, np.uint32)
        self.every = np.arange(lanes)

    def predict(self, n: int):
        """Slots and entries of both orders, the candidate rank and whether there is one."""
        one, two = self.last[0, :n], self.last[1, :n]
        first = (one * np.uint32(0x9E3779B1)) >> np.uint32(32 - _SLOTS1)
        second = ((one * np.uint32(0x85EBCA6B) + two) * np.uint32(0xC2B2AE35)) >> np.uint32(32 - _SLOTS2)
        slots = ((self.every[:n] << _SLOTS1) + first, (self.every[:n] << _SLOTS2) + second)
        entries = [g.take(s).astype(np.int64) for g, s in zip(self.guess, slots, strict=True)]
        one, two = entries
        best = np.where(two & 7, two, one)
        return slots, entries, best >> 3, (best & 7) > 0

    def chance(self, n: int, entries, candidate):
        """Chance of the candidate in 1/4096, and what ``learn_flag`` needs."""
        one, two = entries
        agree = ((one >> 3) == candidate) & ((one & 7) > 0)
        context = (two & 7) + 8 * agree, (one & 7) + 8 * agree, _KIND_OF.take(candidate)
        at = [(self.every[:n] << 4) + c for c in context]
        was = [h.take(a) for h, a in zip(self.hits, at, strict=True)]
        signal = [_STRETCH.take(w) for w in was]
        mix = signal[0] * self.weights[0, :n]
        mix += signal[1] * self.weights[1, :n]
        mix += signal[2] * self.weights[2, :n]
        mix >>= 16
        mix += 2047
        p = _SQUASH.take(mix, mode="clip")
        return p, (at, was, signal, p)

    def learn_flag(self, n: int, same, asked, learnt):
        """Moves weights and estimates towards what came, in the lanes that had a candidate."""
        at, was, signal, p = learnt
        error = (same * 4096 - p) * 6 * asked
        goal = same * 4094 + 1
        for i in range(3):
            w = self.weights[i, :n]
            w += (signal[i] * error + 0x8000) >> 16
            np.minimum(w, 1 << 19, out=w)
            np.maximum(w, -(1 << 19), out=w)
            # the shift keeps estimates within 1/4096 and 4064/4096
            self.hits[i][at[i]] = was[i] + ((goal - was[i]) >> _RATE) * asked

    def learn_kind(self, n: int, symbol):
        row = self.counts[:n]
        row += _STEPS.take(symbol, axis=0)
        full = np.flatnonzero(row[:, _KINDS] >= _LIMIT)
        if len(full):
            row[full, 1:] = np.cumsum((np.diff(row[full], axis=1) + 1) >> 1, axis=1)

    def learn_rank(self, n: int, slots, entries, rank):
        for g, s, e in zip(self.guess, slots, entries, strict=True):
            trust = e & 7
            less = trust >> 1
            new = np.where((e >> 3 == rank) & (trust > 0), e + (trust < 7), np.where(less > 0, e - trust + less, rank * 8 + 1))
            g[s] = new.astype(np.uint16)
        self.last[1, :n] = self.last[0, :n]
        self.last[0, :n] = rank


def _active(lengths: np.ndarray):
    """Number of lanes, sorted by falling length, that have a t-th id."""
    return np.searchsorted(-lengths, -np.arange(int(lengths[0])), side="left") if len(lengths) else []


def _ranks(block: np.ndarray) -> np.ndarray:
    _, first, where = np.unique(block, return_index=True, return_inverse=True)
    rank = np.empty(len(first), np.int64)
    rank[np.argsort(first)] = np.arange(len(first))
    return rank[where]


def _flag_interval(coder, n, p, asked, same):
    step = coder.range[:n] >> np.uint64(12)
    likely = step * p.astype(np.uint64)
    add = np.where(asked & ~same, likely, np.uint64(0))
    span = np.where(asked, np.where(same, likely, coder.range[:n] - likely), coder.range[:n])
    return add, span


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """The code of each block of at most 8192 uint16 ids; blocks do not depend on each other."""
    if not blocks:
        return []
    order = np.argsort([-len(b) for b in blocks], kind="stable")
    lengths = np.array([len(blocks[i]) for i in order])
    ids = np.zeros((int(lengths[0]) + 1, len(blocks)), np.uint64)
    ranks = np.zeros((int(lengths[0]) + 1, len(blocks)), np.int64)
    for lane, i in enumerate(order):
        ids[: len(blocks[i]), lane] = blocks[i]
        ranks[: len(blocks[i]), lane] = _ranks(blocks[i])
    coder, model = _Encoder(len(blocks), 3 * len(ids) + 4), _Model(len(blocks))
    for t, n in enumerate(_active(lengths)):
        rank = ranks[t, :n]
        slots, entries, candidate, asked = model.predict(n)
        same = candidate == rank
        p, learnt = model.chance(n, entries, candidate)
        coder.narrow(n, *_flag_interval(coder, n, p, asked, same))
        model.learn_flag(n, same, asked, learnt)
        rest = ~(asked & same)
        new = rank == model.known[:n]
        symbol = np.where(new, 0, _KIND_OF.take(rank))
        bits = _BITS.take(symbol)
        follow = np.where(new, ids[t, :n], (rank - _FIRST.take(symbol)).astype(np.uint64))
        row = model.counts[:n].reshape(-1)
        at = model.every[:n] * (_KINDS + 1) + symbol
        first, size = row.take(at), row.take(at + 1)
        step = coder.range[:n] // model.counts[:n, _KINDS].astype(np.uint64)
        fine = (step * (size - first).astype(np.uint64)) >> bits
        add = np.where(rest, step * first.astype(np.uint64) + fine * follow, np.uint64(0))
        coder.narrow(n, add, np.where(rest, fine, coder.range[:n]))
        model.learn_kind(n, np.where(rest, symbol, _KINDS))
        model.known[:n] += new
        model.learn_rank(n, slots, entries, rank)
    out: list[bytes] = [b""] * len(blocks)
    for i, payload in zip(order, coder.finish(), strict=True):
        out[i] = payload
    return out


def decode_blocks(payloads: list[bytes], lengths: list[int]) -> list[np.ndarray]:
    """The ids of each block, from its code and number of ids."""
    if not payloads:
        return []
    order = np.argsort([-n for n in lengths], kind="stable")
    size = np.array([lengths[i] for i in order])
    coder, model = _Decoder([payloads[i] for i in order]), _Model(len(size))
    ids = np.zeros((int(size[0]) + 1, len(size)), np.uint16)
    names = np.zeros((len(size), len(ids)), np.uint16)  # id of each rank
    for t, n in enumerate(_active(size)):
        slots, entries, candidate, asked = model.predict(n)
        p, learnt = model.chance(n, entries, candidate)
        same = coder.gap[:n] < (coder.range[:n] >> np.uint64(12)) * p.astype(np.uint64)
        coder.narrow(n, *_flag_interval(coder, n, p, asked, same))
        model.learn_flag(n, same, asked, learnt)
        rest = ~(asked & same)
        row = model.counts[:n]
        step = coder.range[:n] // row[:, _KINDS].astype(np.uint64)
        place = coder.gap[:n] // step
        symbol = (row[:, 1:_KINDS] <= place.astype(np.int64)[:, None]).sum(axis=1)
        bits = _BITS.take(symbol)
        flat, at = row.reshape(-1), model.every[:n] * (_KINDS + 1) + symbol
        first, after = flat.take(at), flat.take(at + 1)
        fine = (step * (after - first).astype(np.uint64)) >> bits
        begin = step * first.astype(np.uint64)
        follow = np.minimum((coder.gap[:n] - begin) // np.maximum(fine, np.uint64(1)), (np.uint64(1) << bits) - np.uint64(1))
        add = np.where(rest, begin + fine * follow, np.uint64(0))
        coder.narrow(n, add, np.where(rest, fine, coder.range[:n]))
        known = model.known[:n]
        new = rest & (symbol == 0)
        rank = np.where(rest, np.where(new, known, _FIRST.take(symbol) + follow.astype(np.int64)), candidate)
        rank = np.minimum(rank, len(ids) - 1)
        fresh = np.flatnonzero(new)
        names[fresh, rank[fresh]] = follow[fresh]
        ids[t, :n] = names[model.every[:n], rank]
        model.learn_kind(n, np.where(rest, symbol, _KINDS))
        known += new
        model.learn_rank(n, slots, entries, rank)
    out: list[np.ndarray] = [np.zeros(0, np.uint16)] * len(size)
    for lane, i in enumerate(order):
        out[i] = ids[: lengths[i], lane]
    return out
