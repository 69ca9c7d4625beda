"""Byte-pair merging of many byte strings at once, driven by one queue of merge ranks.

All strings of a call lie in one linked list of tokens. A bucket per merge rank holds the list
positions whose pair merges at that rank, a three-level bitmap marks the buckets that are not empty,
and find-first-set on the bitmap yields the least rank. Positions whose pair has changed since they
were queued are stale and skipped. The positions of a bucket belong to different strings or to
places of one string that cannot affect each other, so they merge as one array operation; a string
of any length takes as many steps as it has distinct ranks, not as it has bytes.
"""

from __future__ import annotations

import base64
from collections.abc import Mapping, Sequence

import numpy as np

NO_RANK = np.int32(2**31 - 1)


class RankBitmap:
    """The set of ranks in use: three levels of 64-bit words, least member by find-first-set."""

    def __init__(self, size: int):
        self.levels = []
        while True:
            size = (size + 63) // 64
            self.levels.append([0] * size)
            if size == 1:
                break

    def add(self, rank: int) -> None:
        for level in self.levels:
            word, bit = rank >> 6, 1 << (rank & 63)
            if level[word] & bit:
                return
            level[word] |= bit
            rank = word

    def discard(self, rank: int) -> None:
        for level in self.levels:
            word = rank >> 6
            level[word] &= ~(1 << (rank & 63))
            if level[word]:
                return
            rank = word

    def least(self) -> int:
        """The least member, or -1."""
        rank = 0
        for level in reversed(self.levels):
            bits = level[rank]
            if not bits:
                return -1
            rank = rank << 6 | ((bits & -bits).bit_length() - 1)
        return rank


class BytePairs:
    """Byte-pair encoder: a token per byte to begin with, then merges in order of rank.

    ``rules`` map a pair of ids to (rank, id of the merged token). ``first`` holds the id of every
    byte value, ``last`` that of a string's final byte where it differs.
    """

    def __init__(
        self,
        rules: Mapping[tuple[int, int], tuple[int, int]],
        first: Sequence[int],
        last: Sequence[int] | None = None,
    ):
        self.first = np.array(first, np.int32)
        self.last = None if last is None else np.array(last, np.int32)
        keys = np.array([left << 32 | right for left, right in rules], np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.array([rank for rank, _ in rules.values()], np.int32)[order]
        self.ranks = int(self.pair_ranks.max()) + 1
        self.merged = np.zeros(self.ranks, np.int32)
        made: dict[int, int] = {}
        for rank, token in rules.values():
            self.merged[rank] = token
            made[token] = max(rank, made.get(token, rank))
        # A token that a rule of lesser rank uses: the pair it forms can merge before other pairs
        # of the token's own rank, so one string merges one pair of it at a time.
        self.unsafe = np.zeros(self.ranks, bool)
        for pair, (rank, _) in rules.items():
            for part in pair:
                if made.get(part, -1) > rank:
                    self.unsafe[made[part]] = True

    @classmethod
    def from_ranks(cls, ranks: Mapping[bytes, int]) -> BytePairs:
        """From ranks of byte strings, where a token's id is its rank and any cut of it may merge."""
        rules = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    rules[left, right] = rank, rank
        return cls(rules, [ranks[bytes([value])] for value in range(256)])

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank at which neighbouring tokens merge."""
        keys = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.pair_keys, keys)
        at[at == len(self.pair_keys)] = 0
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NO_RANK)

    def encode(self, strings: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all strings one after the other, and the number of ids of each."""
        lengths = np.array([len(s) for s in strings], np.int64)
        data = np.frombuffer(b"".join(strings), np.uint8)
        n = len(data)
        if not n:
            return np.zeros(0, np.int32), np.zeros(len(strings), np.int64)
        owner = np.repeat(np.arange(len(strings), dtype=np.int32), lengths)
        token = self.first[data]
        if self.last is not None:
            ends = np.cumsum(lengths)[lengths > 0] - 1
            token[ends] = self.last[data[ends]]
        after = np.arange(1, n + 1, dtype=np.int32)
        before = np.arange(-1, n - 1, dtype=np.int32)
        edges = np.flatnonzero(owner[1:] != owner[:-1])
        after[edges], after[n - 1] = n, n
        before[edges + 1] = -1
        rank = np.full(n, NO_RANK, np.int32)
        inner = after < n
        places = np.flatnonzero(inner)
        rank[places] = self._rank(token[places], token[places + 1])
        chosen = np.zeros(n, bool)

        buckets: list[list[np.ndarray] | None] = [None] * self.ranks
        bitmap = RankBitmap(self.ranks)

        def push(positions: np.ndarray) -> None:
            """Queue sorted positions under their current ranks."""
            ranks = rank[positions]
            if len(positions) > 1:
                order = np.argsort(ranks, kind="stable")
                positions, ranks = positions[order], ranks[order]
                bounds = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
                heads = ranks[np.concatenate([[0], bounds])].tolist()
                parts = np.split(positions, bounds) if len(bounds) else [positions]
            else:
                heads, parts = ranks.tolist(), [positions]
            for head, part in zip(heads, parts):
                if buckets[head] is None:
                    buckets[head] = [part]
                    bitmap.add(head)
                else:
                    buckets[head].append(part)

        push(places[rank[places] != NO_RANK])
        while (least := bitmap.least()) >= 0:
            parts = buckets[least]
            buckets[least] = None
            bitmap.discard(least)
            left = parts[0] if len(parts) == 1 else np.sort(np.concatenate(parts))
            left = left[rank[left] == least]
            if not len(left):
                continue
            right = after[left]
            if len(left) > 1:
                overlaps = right[:-1] == left[1:]
                if overlaps.any():
                    # In a run such as aaaa every other pair merges, from the left.
                    number = np.arange(len(left))
                    heads = np.concatenate([[True], ~overlaps])
                    kept = (number - np.maximum.accumulate(np.where(heads, number, 0))) % 2 == 0
                    left, right = left[kept], right[kept]
                if self.unsafe[least]:
                    owners = owner[left]
                    kept = np.concatenate([[True], owners[1:] != owners[:-1]])
                    if not kept.all():
                        buckets[least] = [left[~kept]]
                        bitmap.add(least)
                        left, right = left[kept], right[kept]
            follow = after[right]
            token[left] = self.merged[least]
            token[right] = -1
            rank[right] = NO_RANK
            after[left] = follow
            has_next = follow < n
            before[follow[has_next]] = left[has_next]
            ahead = before[left]
            if len(left) > 1:
                chosen[left] = True
                ahead = ahead[ahead >= 0]
                ahead = ahead[~chosen[ahead]]
                chosen[left] = False
            else:
                ahead = ahead[ahead >= 0]
            rank[left] = NO_RANK
            changed = np.concatenate([ahead, left[has_next]])
            if not len(changed):
                continue
            rank[changed] = self._rank(token[changed], token[after[changed]])
            changed = changed[rank[changed] != NO_RANK]
            if len(changed):
                changed.sort()
                push(changed)
        alive = token >= 0
        return token[alive], np.bincount(owner[alive], minlength=len(strings))


class TokenBytes:
    """The byte string of every id, for decoding many ids at once."""

    def __init__(self, ranks: Mapping[bytes, int]):
        table = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            table[rank] = token
        self.starts = np.concatenate([[0], np.cumsum([len(token) for token in table])])
        self.data = np.frombuffer(b"".join(table), np.uint8)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids, one after the other, and the number of bytes of each."""
        ids = np.asarray(ids, np.int64)
        starts = self.starts[ids]
        lengths = self.starts[ids + 1] - starts
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        shift = np.repeat(starts - (ends - lengths), lengths)
        return self.data[np.arange(total) + shift], lengths


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks by byte string from the content of a rank file (base64 token, rank)."""
    lines = (line.split() for line in data.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in lines}
