"""A cuckoo filter over text digests, with the stored keys that its hits are verified against."""

from __future__ import annotations

#: Slots in a bucket, and moves before an insertion counts as an overflow.
SLOTS = 4
MOST_MOVES = 200


class CuckooIndex:
    """A set of live keys with a value each: a filter of 16-bit fingerprints, and bucketed content.

    Keys are (digest bytes, length, check) tuples. A fingerprint has two possible buckets; a slot of
    the filter and the slot of the content beside it always move together. A fingerprint that matches
    is only a hit when the key stored in its slot is the same. When an insertion has moved MOST_MOVES
    fingerprints in vain, the filter is built anew with twice the buckets from the stored keys.
    """

    def __init__(self, buckets: int = 64):
        self.live = 0
        self.resizes = 0
        self.false_hits = 0
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.marks = [0] * (buckets * SLOTS)
        self.content: list[tuple | None] = [None] * (buckets * SLOTS)

    def _places(self, key: tuple) -> tuple[int, int, int]:
        digest = key[0]
        mark = int.from_bytes(digest[:2], "little") or 1
        first = int.from_bytes(digest[2:10], "little") & self.mask
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x5BD1E995)) & self.mask

    def _slot(self, key: tuple) -> int:
        """The key's slot, or -1."""
        mark, first, second = self._places(key)
        for bucket in (first, second) if first != second else (first,):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.marks[slot] == mark:
                    if self.content[slot][0] == key:
                        return slot
                    self.false_hits += 1
        return -1

    def get(self, key: tuple):
        slot = self._slot(key)
        return None if slot < 0 else self.content[slot][1]

    def delete(self, key: tuple) -> bool:
        slot = self._slot(key)
        if slot < 0:
            return False
        self.marks[slot], self.content[slot] = 0, None
        self.live -= 1
        return True

    def insert(self, key: tuple, value) -> None:
        """Add a key that isn't live."""
        self.live += 1
        homeless = self._place(key, value)
        if homeless:
            self._rebuild([*self.entries(), homeless])

    def _rebuild(self, stored: list) -> None:
        """Double the buckets until all stored entries have a place."""
        while True:
            self.resizes += 1
            self._clear((self.mask + 1) * 2)
            if not any(self._place(*entry) for entry in stored):
                return

    def _place(self, key: tuple, value) -> tuple | None:
        """Put the entry into a free slot, moving others; the entry left without one, if any."""
        mark, first, second = self._places(key)
        for bucket in (first, second):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not self.marks[slot]:
                    self.marks[slot], self.content[slot] = mark, (key, value)
                    return None
        entry, bucket = (key, value), second
        for move in range(MOST_MOVES):
            slot = bucket * SLOTS + move % SLOTS
            self.marks[slot], mark = mark, self.marks[slot]
            self.content[slot], entry = entry, self.content[slot]
            bucket = self._other(bucket, mark)
            for free in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not self.marks[free]:
                    self.marks[free], self.content[free] = mark, entry
                    return None
        return entry

    def entries(self):
        return (entry for entry in self.content if entry)
