"""Minimal perfect hashing of 64-bit keys, with stored fingerprints.

The keys are placed level by level: at each level every remaining key hashes to a
bit; keys alone on their bit take it, the rest go on to the next level.  A key's
number is the count of set bits before its own, so n keys get the numbers 0..n-1,
and a lookup costs a fixed expected number of bit tests.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

#: Odd multipliers of the 64-bit finaliser.
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
GOLDEN = 0x9E3779B97F4A7C15
MAX_LEVELS = 64


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of each key; seeds give independent functions."""
    x = keys.astype(np.uint64) + np.uint64((GOLDEN * (2 * seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


@dataclass
class PerfectHash:
    """Levels of bits, each with the count of set bits before its words."""

    levels: list[tuple[int, np.ndarray, np.ndarray]] = field(default_factory=list)
    size: int = 0

    @classmethod
    def build(cls, keys: np.ndarray, load: float = 0.6) -> PerfectHash:
        """``keys`` must be distinct; ``load`` is keys per bit at each level."""
        out, left = cls(), np.asarray(keys, dtype=np.uint64)
        for level in range(MAX_LEVELS):
            if not len(left):
                return out
            bits = max(64, int(len(left) / load) // 64 * 64 + 64)
            at = mix(left, level) % np.uint64(bits)
            counts = np.bincount(at.astype(np.int64), minlength=bits)
            alone = counts[at.astype(np.int64)] == 1
            flags = counts == 1
            words = np.packbits(flags, bitorder="little").view(np.uint64)
            before = out.size + np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))[:-1]
            out.levels.append((bits, words, before))
            out.size += int(flags.sum())
            left = left[~alone]
        raise ValueError("keys repeat")

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Each key's number; any number or -1 for a key that was not built in."""
        keys = np.asarray(keys, dtype=np.uint64)
        out = np.full(len(keys), -1, dtype=np.int64)
        left = np.arange(len(keys))
        for level, (bits, words, before) in enumerate(self.levels):
            if not len(left):
                break
            at = mix(keys[left], level) % np.uint64(bits)
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            here = (words[word] >> bit) & np.uint64(1) == 1
            below = words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            found = before[word] + np.bitwise_count(below).astype(np.int64)
            out[left[here]] = found[here]
            left = left[~here]
        return out

    def dump(self) -> bytes:
        head = [np.array([len(self.levels), self.size], dtype="<u8").tobytes()]
        for bits, words, before in self.levels:
            head.append(np.array([bits], dtype="<u8").tobytes() + words.astype("<u8").tobytes() + before.astype("<u8").tobytes())
        return b"".join(head)

    @classmethod
    def load(cls, data: bytes) -> tuple[PerfectHash, int]:
        """The function and the number of bytes it took."""
        n, size = (int(x) for x in np.frombuffer(data, "<u8", 2))
        out, at = cls(size=size), 16
        for _ in range(n):
            bits = int(np.frombuffer(data, "<u8", 1, at)[0])
            words = np.frombuffer(data, "<u8", bits // 64, at + 8)
            before = np.frombuffer(data, "<u8", bits // 64, at + 8 + bits // 8).astype(np.int64)
            out.levels.append((bits, words, before))
            at += 8 + bits // 4
        return out, at
