"""Elias-Fano sequences in numpy: searched in batches, on memory-mapped arrays."""

from __future__ import annotations

import numpy as np

#: Words of 64 bits in a block of the select directories.
BLOCK = 4

_U = np.uint64
_LOW = _U(0x0101010101010101)
_HIGH = _U(0x8080808080808080)
_ALL = 0xFFFFFFFFFFFFFFFF


def _select_table() -> np.ndarray:
    """By byte and rank: the place of that set bit in the byte."""
    out = np.zeros((256, 8), np.uint8)
    for byte in range(256):
        for rank, place in enumerate(p for p in range(8) if byte >> p & 1):
            out[byte, rank] = place
    return out


_SELECT = _select_table()


def _select_in_word(words: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Place of the set bit of each rank (from 0) in each word: byte counts by parallel sums, then a table."""
    sums = words - ((words >> _U(1)) & _U(0x5555555555555555))
    sums = (sums & _U(0x3333333333333333)) + ((sums >> _U(2)) & _U(0x3333333333333333))
    sums = ((sums + (sums >> _U(4))) & _U(0x0F0F0F0F0F0F0F0F)) * _LOW
    at_most = (((ranks * _LOW) | _HIGH) - sums) & _HIGH
    place = np.bitwise_count(at_most).astype(_U) << _U(3)
    rest = ranks - (((sums << _U(8)) >> place) & _U(0xFF))
    return place + _SELECT[((words >> place) & _U(0xFF)).astype(np.intp), rest.astype(np.intp)]


def encode(values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
    """Arrays of a sorted uint64 sequence below ``universe``: its head (count, low bits, last
    high part), low parts packed bit by bit, high parts in unary, and the ones and zeros before each block of those."""
    n = len(values)
    bits = max(0, (universe // n).bit_length() - 1) if n else 0
    highs = (values >> _U(bits)).astype(np.int64)
    top = int(highs[-1]) if n else 0
    unary = np.zeros(-(-(n + top + 2) // (64 * BLOCK)) * 64 * BLOCK, bool)
    unary[highs + np.arange(n)] = True
    ones = np.cumsum(unary.reshape(-1, 64 * BLOCK).sum(axis=1))
    ones = np.append(0, ones[:-1]).astype(np.uint32 if len(unary) < 1 << 32 else _U)
    zeros = (np.arange(len(ones)) * 64 * BLOCK - ones.astype(np.int64)).astype(ones.dtype)
    low = np.zeros(-(-(-(-n * bits // 8) + 16) // 8), _U)
    if n and bits:  # a word's values are its sum, as no bit is in two of them; its last one may go on in the next word
        part = values & _U((1 << bits) - 1)
        word, off = np.divmod(np.arange(n) * bits, 64)
        off = off.astype(_U)
        begins = np.flatnonzero(np.diff(word, prepend=-1))
        low[word[begins]] = np.add.reduceat(part << off, begins)
        over = np.flatnonzero(off > _U(64 - bits))
        low[word[over] + 1] |= part[over] >> (_U(64) - off[over])
    return {"head": np.array([n, bits, top], np.int64), "low": low, "high": np.packbits(unary, bitorder="little").view(_U),
            "ones": ones, "zeros": zeros}


class EliasFano:
    def __init__(self, arrays: dict[str, np.ndarray]) -> None:
        self.n, self.bits, self.top = map(int, arrays["head"])
        self.low, self.high, self.ones, self.zeros = (arrays[k] for k in ("low", "high", "ones", "zeros"))

    def _select(self, rank: np.ndarray, flip: int, before: np.ndarray) -> np.ndarray:
        """Position of the one (or zero, for flip) of each rank: its block by the directory, then at most BLOCK words."""
        flip = _U(flip)
        block = np.searchsorted(before, rank.astype(before.dtype), "right") - 1
        left = rank.astype(_U) - before[block].astype(_U)
        word = block * BLOCK
        bits = self.high[word] ^ flip
        count = np.bitwise_count(bits).astype(_U)
        open_ = np.flatnonzero(left >= count)
        while len(open_):
            left[open_] -= count[open_]
            word[open_] += 1
            bits[open_] = self.high[word[open_]] ^ flip
            count[open_] = np.bitwise_count(bits[open_])
            open_ = open_[left[open_] >= count[open_]]
        return (word << 6) + _select_in_word(bits, left).astype(np.int64)

    def _after(self, position: np.ndarray, rank: np.ndarray, flip: int, before: np.ndarray) -> np.ndarray:
        """Position of the one (or zero) of each rank, given that of the rank before: most lie in the
        same word or the next; the others are selected."""
        start = position + 1
        word = start >> 6
        bits = (self.high[word] ^ _U(flip)) & (_U(_ALL) << (start & 63).astype(_U))
        open_ = np.flatnonzero(bits == 0)
        word[open_] += 1
        bits[open_] = self.high[np.minimum(word[open_], len(self.high) - 1)] ^ _U(flip)
        out = (word << 6) + np.bitwise_count((bits & (~bits + _U(1))) - _U(1))
        if len(far := open_[bits[open_] == 0]):
            out[far] = self._select(rank[far], flip, before)
        return out

    def _low(self, at: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(at), _U)
        bit = at * self.bits
        word, off = bit >> 6, (bit & 63).astype(_U)
        found = self.low[word] >> off
        found |= (self.low[word + 1] << _U(1)) << (_U(63) - off)
        return found & ((_U(1) << _U(self.bits)) - _U(1))

    def access(self, at: np.ndarray) -> np.ndarray:
        """The values at these places."""
        highs = (self._select(at, 0, self.ones) - at).astype(_U)
        return (highs << _U(self.bits)) | self._low(at)

    def access_two(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values at these places and at the next ones."""
        one = self._select(at, 0, self.ones)
        two = self._after(one, at + 1, 0, self.ones)
        bits = _U(self.bits)
        return ((one - at).astype(_U) << bits) | self._low(at), ((two - at - 1).astype(_U) << bits) | self._low(at + 1)

    def find(self, values: np.ndarray, first: np.ndarray | None = None, stop: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Place of each value's successor, within first to stop if given, and whether it equals the value.

        The values' high parts choose a bucket between two zeros; the low
        parts of the bucket's few members are searched by halves.
        """
        place = np.zeros(len(values), np.int64)
        equal = np.zeros(len(values), bool)
        inside = np.flatnonzero((values >> _U(self.bits)) <= _U(self.top)) if self.n else np.zeros(0, np.int64)
        place[:] = self.n
        if not len(inside):
            return place, equal
        x = values[inside]
        high = (x >> _U(self.bits)).astype(np.int64)
        low = x & ((_U(1) << _U(self.bits)) - _U(1))
        zero = np.full(len(x), -1, np.int64)  # the zero before the bucket
        later = np.flatnonzero(high > 0)
        zero[later] = self._select(high[later] - 1, _ALL, self.zeros)
        begin = zero - high + 1
        end = self._after(zero, high, _ALL, self.zeros) - high
        if first is not None:
            begin = np.maximum(begin, first[inside])
        if stop is not None:
            end = np.minimum(end, stop[inside])
        end = np.maximum(begin, end)
        upto = end.copy()
        open_ = np.flatnonzero(begin < end)
        while len(open_):
            middle = (begin[open_] + end[open_]) >> 1
            less = self._low(middle) < low[open_]
            begin[open_[less]] = middle[less] + 1
            end[open_[~less]] = middle[~less]
            open_ = open_[begin[open_] < end[open_]]
        place[inside] = begin
        hit = np.flatnonzero(begin < upto)
        equal[inside[hit]] = self._low(begin[hit]) == low[hit]
        return place, equal
