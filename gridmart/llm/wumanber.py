"""Wu-Manber search for many byte strings at once, over whole blocks of text.

Strings are dealt into classes by length. A class of shortest length m looks at windows of m bytes.
A table over hashed blocks (the last bytes of a window) tells how far the window may move because no
string has that block so near its end. Where it may not move, the block and the window's first bytes
select the strings to compare. The text is cut into lanes whose windows move together, one numpy
step for all of them.
"""

from __future__ import annotations

import numpy as np

#: Longest block and prefix in bytes; bounds of the classes of lengths.
BLOCK = 8
BOUNDS = (8, 16, 32)
#: Window starts per lane.
LANE = 1024
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_ONE = np.uint64(0xFF51AFD7ED558CCD)


def _words_at(text: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as a number; the text must be 8 bytes longer than what is asked."""
    return np.ndarray((max(len(text) - 7, 0),), "<u8", buffer=text, strides=(1,))


def _mask(size: int) -> np.uint64:
    return np.uint64((1 << 8 * size) - 1)


class Length:
    """The strings of one class: its shift table and its buckets."""

    def __init__(self, strings: list[bytes], numbers: np.ndarray):
        self.m = m = min(map(len, strings))
        self.block = min(BLOCK, m)
        self.strings = strings
        heads = np.frombuffer(b"".join(s[:m] for s in strings) + bytes(8), np.uint8)
        at = np.arange(len(strings)) * m
        words = _words_at(heads)
        ends = np.arange(self.block, m + 1)
        blocks = words[at[:, None] + ends[None, :] - self.block] & _mask(self.block)
        size = 1 << max(12, min(22, int(blocks.size * 8 - 1).bit_length()))
        self.bits = np.uint64(64 - (size.bit_length() - 1))
        farthest = min(m - self.block + 1, 65_535)
        self.shifts = np.full(size, farthest, np.uint16)
        steps = np.broadcast_to(np.minimum(m - ends, farthest).astype(np.uint16), blocks.shape)
        np.minimum.at(self.shifts, self._slot(blocks.ravel()), steps.ravel())
        keys = self._key(blocks[:, -1], words[at] & _mask(self.block))
        order = np.argsort(keys, kind="stable")
        self.keys, self.starts = np.unique(keys[order], return_index=True)
        self.starts = np.append(self.starts, len(order))
        self.order, self.numbers = order, numbers

    def _slot(self, blocks: np.ndarray) -> np.ndarray:
        return ((blocks * _MULTIPLIER) >> self.bits).astype(np.int64)

    @staticmethod
    def _key(suffix: np.ndarray, prefix: np.ndarray) -> np.ndarray:
        return (suffix * _MULTIPLIER ^ suffix >> np.uint64(29)) + prefix * _ONE

    def candidates(self, text: np.ndarray, size: int) -> np.ndarray:
        """Places whose window ends in a block that some string ends its window with."""
        words, m, block = _words_at(text), self.m, self.block
        last = size - m
        if last < 0:
            return np.empty(0, np.int64)
        at = np.arange(0, last + 1, LANE)
        stop = np.minimum(at + LANE, last + 1)
        found = []
        while len(at):
            shift = self.shifts[self._slot(words[at + (m - block)] & _mask(block))]
            hit = shift == 0
            if hit.any():
                found.append(at[hit])
            at = at + np.maximum(shift, 1)
            inside = at < stop
            if not inside.all():
                at, stop = at[inside], stop[inside]
        return np.concatenate(found) if found else np.empty(0, np.int64)

    def matches(self, text: np.ndarray, raw: memoryview, size: int, is_start) -> tuple[list[int], list[int], list[int]]:
        """Places, ends and numbers of the strings that occur where is_start allows it."""
        at = self.candidates(text, size)
        at = at[is_start(at)]
        words = _words_at(text)
        keys = self._key(words[at + (self.m - self.block)] & _mask(self.block), words[at] & _mask(self.block))
        slot = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        same = self.keys[slot] == keys
        places, stops, which = [], [], []
        for place, bucket in zip(at[same].tolist(), slot[same].tolist()):
            for i in self.order[self.starts[bucket]:self.starts[bucket + 1]].tolist():
                string = self.strings[i]
                if raw[place:place + len(string)] == string:
                    places.append(place)
                    stops.append(place + len(string))
                    which.append(int(self.numbers[i]))
        return places, stops, which


class Searcher:
    """All strings, by classes of length. The numbers of the strings are their places in the list."""

    def __init__(self, strings: list[bytes]):
        classes: dict[int, list[int]] = {}
        for i, string in enumerate(strings):
            classes.setdefault(sum(len(string) >= bound for bound in BOUNDS), []).append(i)
        self.lengths = [Length([strings[i] for i in members], np.array(members)) for members in classes.values()]

    def search(self, text: bytes | bytearray, is_start) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and numbers of all occurrences in a text that ends with 8 spare bytes."""
        codes, raw, size = np.frombuffer(text, np.uint8), memoryview(text), len(text) - 8
        found = [length.matches(codes, raw, size, is_start) for length in self.lengths]
        return tuple(np.array([x for part in found for x in part[i]], np.int64) for i in range(3))
