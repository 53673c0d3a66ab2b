"""Memories of Python workers, bounded in bytes.  Workers are reused by later stages,
so what one remembers is kept small and emptied at the end of a partition."""

from __future__ import annotations

ENTRY = 150            # bytes of a slot and of the headers of key and value


class BoundedMemory:
    """What was used of late, in two generations of at most half of ``limit`` bytes:
    when the young one is full, it becomes the old one and the old one goes."""

    def __init__(self, limit: int):
        self.half = limit // 2
        self.empty()

    def empty(self) -> None:
        self.young, self.old, self.used = {}, {}, 0

    def keep(self, key, value, size: int = 0) -> None:
        size += ENTRY
        if self.used + size > self.half:
            self.young, self.old, self.used = {}, self.young, 0
        self.young[key] = value
        self.used += size
