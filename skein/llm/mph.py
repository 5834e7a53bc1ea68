"""Minimal perfect hash over 64-bit keys by cascaded bit levels (Limasset et al., "Fast and
scalable minimal perfect hashing for massive key sets", 2017).

Each level hashes the keys still without a place into twice as many bits as keys; a bit hit
by exactly one key is that key's place, the others go on to the next level. A key's slot is
the number of set bits before its own, so n keys fill slots 0 .. n-1. A stranger may land
on any slot: callers compare a stored fingerprint.
"""

from __future__ import annotations

import numpy as np

GAMMA = 2
MAX_LEVELS = 64


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A bijection of 64-bit numbers for every seed, so distinct keys stay distinct."""
    with np.errstate(over="ignore"):
        z = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 1000) >> np.uint64(32)).astype(np.uint32)


def build(keys: np.ndarray) -> list[bytes]:
    """Levels of packed bits for distinct keys."""
    rest, levels = np.asarray(keys).astype(np.uint64), []
    while len(rest):
        if len(levels) == MAX_LEVELS:
            raise ValueError("keys are not distinct")
        size = np.uint64(-(-GAMMA * len(rest) // 8) * 8)
        at = (mix(rest, len(levels)) % size).astype(np.int64)
        hits = np.bincount(at, minlength=int(size))
        levels.append(np.packbits(hits == 1).tobytes())
        rest = rest[hits[at] != 1]
    return levels


def slots(levels: list[bytes], keys: np.ndarray) -> np.ndarray:
    """Slot of each key; -1 for a key that no level places."""
    keys = np.asarray(keys).astype(np.uint64)
    out, left, before = np.full(len(keys), -1, dtype=np.int64), np.arange(len(keys)), 0
    for seed, packed in enumerate(levels):
        bits = np.unpackbits(np.frombuffer(packed, dtype=np.uint8))
        at = (mix(keys[left], seed) % np.uint64(len(bits))).astype(np.int64)
        rank = np.cumsum(bits) - 1 + before
        here = bits[at] == 1
        out[left[here]] = rank[at[here]]
        left, before = left[~here], before + int(bits.sum())
    return out
