"""A minimal perfect hash over a fixed set of byte strings, by hash and displace."""

from __future__ import annotations

from xxhash import xxh3_64_intdigest


class PerfectHash:
    """Maps each of n distinct keys to a slot of its own in 0..n-1; other keys map to any slot.

    Keys fall in about n/2 buckets. From the fullest bucket on, each gets the first seed that sends
    all its keys to free slots; a bucket of one key names its slot directly.
    """

    def __init__(self, keys: list[bytes]) -> None:
        self.size = len(keys)
        self.seeds = [0] * max(1, self.size // 2)
        members: list[list[bytes]] = [[] for _ in self.seeds]
        for key in keys:
            members[xxh3_64_intdigest(key) % len(members)].append(key)
        taken = [False] * self.size
        free = 0
        for bucket in sorted(range(len(members)), key=lambda bucket: -len(members[bucket])):
            group = members[bucket]
            if len(group) == 1:
                while taken[free]:
                    free += 1
                taken[free] = True
                self.seeds[bucket] = -free - 1
            elif group:
                self.seeds[bucket] = self._seed(group, taken)

    def _seed(self, group: list[bytes], taken: list[bool]) -> int:
        seed = 1
        while True:
            slots = {xxh3_64_intdigest(key, seed) % self.size for key in group}
            if len(slots) == len(group) and not any(taken[slot] for slot in slots):
                for slot in slots:
                    taken[slot] = True
                return seed
            seed += 1

    def slot(self, key: bytes) -> int:
        seed = self.seeds[xxh3_64_intdigest(key) % len(self.seeds)]
        return -seed - 1 if seed < 0 else xxh3_64_intdigest(key, seed) % self.size
