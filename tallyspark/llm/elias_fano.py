"""Elias-Fano coded monotone sequences and the n-gram trie made of them.

A sequence keeps the low bits of its numbers packed and the high bits in unary: two bits
and the low ones per number. All operations take arrays. Everything lies in one array of
64-bit words, so that a whole trie can be one memory-mapped file.
"""

import mmap
import tempfile

import numpy as np

ONE = np.uint64(1)
# Every byte 1, and the top bit of every byte.
BYTES, TOPS = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
# Place of the set bit with r set bits below it, by byte and r.
IN_BYTE = np.array([([i for i in range(8) if b >> i & 1] + [0] * 8)[:8] for b in range(256)], dtype=np.uint64).ravel()


def _pack(values, bits):
    """Numbers of ``bits`` bits each, one behind the other, in 64-bit words (and a spare one)."""
    words = np.zeros((len(values) * bits >> 6) + 2, dtype=np.uint64)
    if bits and len(values):
        at = np.arange(len(values), dtype=np.uint64) * np.uint64(bits)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        # Numbers that begin in the same word fall into a fixed number of rounds.
        np.bitwise_or.at(words, word, values << shift)
        over = np.flatnonzero(shift + np.uint64(bits) > np.uint64(64))
        np.bitwise_or.at(words, word[over] + 1, values[over] >> (np.uint64(64) - shift[over]))
    return words


def _unpack(words, index, bits):
    if not bits:
        return np.zeros(len(index), dtype=np.uint64)
    if bits == 16:
        return words.view("<u2")[index].astype(np.uint64)
    at = index.astype(np.uint64) * np.uint64(bits)
    word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
    low = words[word] >> shift
    high = np.where(shift > 0, words[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
    return (low | high) & ((ONE << np.uint64(bits)) - ONE)


def _select(word, rank):
    """Place of the set bit with ``rank`` set bits below it, in each 64-bit word."""
    rank = rank.astype(np.uint64)
    # Set bits up to the end of each byte; bytes with no more than the rank come before the one looked for.
    upto = np.bitwise_count(word.view(np.uint8)).view(np.uint64) * BYTES
    byte = np.bitwise_count(((rank * BYTES | TOPS) - upto) & TOPS).astype(np.uint64) << np.uint64(3)
    rank -= ((upto << np.uint64(8)) >> byte) & np.uint64(255)
    return byte + IN_BYTE[((((word >> byte) & np.uint64(255)) << np.uint64(3)) | rank).astype(np.int64)]


class Sequence:
    """A monotone sequence of numbers below 2^63."""

    def __init__(self, words, count, bits, unary):
        self.words, self.count, self.bits = words, count, bits
        self.low, self.high = words[: len(words) - 2 * unary], words[len(words) - 2 * unary : len(words) - unary]
        # Set bits before each word of the unary part.
        self.ones = words[len(words) - unary :].view(np.int64)

    @staticmethod
    def build(values):
        """(words, count, bits, unary words) of a non-decreasing array."""
        values = np.asarray(values, dtype=np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        low = _pack(values & ((ONE << np.uint64(bits)) - ONE), bits)
        at = (values >> np.uint64(bits)) + np.arange(n, dtype=np.uint64)
        unary = ((n + (top >> bits) + 1) >> 6) + 1
        flags = np.zeros(unary * 64, dtype=np.uint8)
        flags[at.astype(np.int64)] = 1
        high = np.packbits(flags, bitorder="little").view(np.uint64)
        ones = np.r_[0, np.cumsum(np.bitwise_count(high), dtype=np.int64)[:-1]].view(np.uint64)
        return np.concatenate([low, high, ones]), n, bits, unary

    def get(self, index):
        """The numbers at the given places."""
        index = np.asarray(index, dtype=np.int64)
        word = np.searchsorted(self.ones, index, "right") - 1
        place = (word.astype(np.uint64) << np.uint64(6)) + _select(self.high[word], index - self.ones[word])
        return ((place - index.astype(np.uint64)) << np.uint64(self.bits)) | _unpack(self.low, index, self.bits)

    def _before(self, high):
        """How many numbers have high bits below ``high``."""
        zeros = np.arange(len(self.high), dtype=np.int64) * 64 - self.ones
        wanted = high.astype(np.int64) - 1
        asked = np.maximum(wanted, 0)
        word = np.searchsorted(zeros, asked, "right") - 1
        place = (word << 6) + _select(~self.high[word], asked - zeros[word]).astype(np.int64)
        return np.where(wanted < 0, 0, place - asked)

    def _search(self, wanted):
        """For wanted numbers that are at most the last: place of the first not below each, end of those with its high bits, its low bits."""
        high = wanted >> np.uint64(self.bits)
        low = wanted & ((ONE << np.uint64(self.bits)) - ONE)
        at, end = self._before(high), self._before(high + ONE)
        # By halves, as many numbers may share their high bits.
        open_ = np.flatnonzero(at < end)
        first, last, asked = at[open_], end[open_], low[open_]
        while len(open_):
            middle = (first + last) >> 1
            below = _unpack(self.low, middle, self.bits) < asked
            first, last = np.where(below, middle + 1, first), np.where(below, last, middle)
            going = first < last
            at[open_] = first
            open_, first, last, asked = open_[going], first[going], last[going], asked[going]
        return at, end, low

    def _inside(self, wanted):
        last = self.get(np.array([self.count - 1]))[0] if self.count else np.uint64(0)
        return wanted <= last if self.count else np.zeros(len(wanted), dtype=bool)

    def successor(self, wanted):
        """Place of the first number that is not below each wanted one; ``count`` if there is none."""
        wanted = np.asarray(wanted, dtype=np.uint64)
        inside = self._inside(wanted)
        result = np.full(len(wanted), self.count, dtype=np.int64)
        result[inside] = self._search(wanted[inside])[0]
        return result

    def find(self, wanted):
        """Place of the first number equal to each wanted one; -1 if there is none."""
        wanted = np.asarray(wanted, dtype=np.uint64)
        inside = np.flatnonzero(self._inside(wanted))
        at, end, low = self._search(wanted[inside])
        # A successor with the same high bits is equal if the low ones are.
        near = np.flatnonzero(at < end)
        near = near[_unpack(self.low, at[near], self.bits) == low[near]]
        result = np.full(len(wanted), -1, dtype=np.int64)
        result[inside[near]] = at[near]
        return result


class Trie:
    """Levels of an n-gram trie, each with the words of its nodes and quantised values.

    A node's word is stored relative to its context: behind the words of all contexts before it, so that
    a level is one monotone sequence, and a number found in it is a child of the context it was asked for.
    """

    BASE = np.uint64(1 << 32)

    def __init__(self, levels):
        """``levels``: per level the words (below 2^32; any for the first), the parent of each node, and value arrays."""
        parts, layout, at = [], [], 0

        def put(words):
            nonlocal at
            parts.append(words)
            at += len(words)
            return at - len(words), at

        for depth, (words, parent, values) in enumerate(levels):
            relative = words if not depth else parent.astype(np.uint64) * self.BASE + words
            coded = Sequence.build(relative)
            entry = {"words": (put(coded[0]), coded[1:]), "values": []}
            for value in values:
                low, high = (float(value.min()), float(value.max())) if len(value) else (0.0, 0.0)
                step = (high - low) / 65535 or 1.0
                entry["values"].append((put(_pack(np.rint((value - low) / step).astype(np.uint64), 16)), low, step))
            layout.append(entry)
        # The file has no name: it is gone when the task ends, however it ends.
        self.file = tempfile.TemporaryFile()
        for words in parts:
            self.file.write(words.tobytes())
        self.file.flush()
        self.map = mmap.mmap(self.file.fileno(), 0, access=mmap.ACCESS_READ)
        memory = np.frombuffer(self.map, dtype=np.uint64)
        self.levels = [
            {
                "words": Sequence(memory[slice(*e["words"][0])], *e["words"][1]),
                "values": [(memory[slice(*place)], low, step) for place, low, step in e["values"]],
            }
            for e in layout
        ]
        self.size = len(memory) * 8

    def find(self, depth, words, parent=None):
        """The node of each word, among the children of ``parent`` below the first level; -1 where there is none."""
        level = self.levels[depth]["words"]
        if not depth:
            return level.find(words)
        known = np.flatnonzero(parent >= 0)
        node = np.full(len(words), -1, dtype=np.int64)
        node[known] = level.find(parent[known].astype(np.uint64) * self.BASE + words[known])
        return node

    def value(self, depth, which, nodes):
        words, low, step = self.levels[depth]["values"][which]
        return _unpack(words, nodes, 16).astype(np.float64) * step + low
