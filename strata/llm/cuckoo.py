"""A cuckoo filter over 128-bit digests: 16-bit fingerprints, four slots a
bucket, insertion, deletion and vectorised look-up. Small helper that runs
inside Spark tasks, one filter for each shard of the key space."""

from __future__ import annotations

import numpy as np

SLOTS = 4
MAX_KICKS = 400
LOAD = 0.85


def halves(digests) -> tuple[np.ndarray, np.ndarray]:
    """The two 64-bit halves of 16-byte digests."""
    raw = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
    return raw[:, 0], raw[:, 1]


def _marks(low: np.ndarray, high: np.ndarray, n_buckets: int):
    """Fingerprint (never 0), first and second bucket of each key."""
    fp = ((low >> np.uint64(40)) & np.uint64(0xFFFF)).astype(np.uint16)
    fp[fp == 0] = 1
    first = (high & np.uint64(n_buckets - 1)).astype(np.int64)
    return fp, first, first ^ _hop(fp, n_buckets)


def _hop(fp, n_buckets: int):
    """Distance to the other bucket; depends on the fingerprint alone, so that
    a stored fingerprint can move without its key."""
    mixed = (np.asarray(fp, np.uint64) * np.uint64(0x5BD1E995)) >> np.uint64(8)
    return (mixed & np.uint64(n_buckets - 1)).astype(np.int64)


class CuckooFilter:
    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def for_keys(cls, n_keys: int) -> CuckooFilter:
        n_buckets = 1 << max(2, int(np.ceil(np.log2(max(n_keys, 1) / (SLOTS * LOAD)))))
        return cls(np.zeros((n_buckets, SLOTS), np.uint16))

    @classmethod
    def from_bytes(cls, blob: bytes) -> CuckooFilter:
        return cls(np.frombuffer(blob, np.uint16).reshape(-1, SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    def insert(self, digests) -> bool:
        """Add the keys; False when one finds no place (the caller builds a
        larger filter from the exact table)."""
        if not len(digests):
            return True
        table, n_buckets = self.table, len(self.table)
        fps, first, second = _marks(*halves(digests), n_buckets)
        for fp, a, b in zip(fps.tolist(), first.tolist(), second.tolist(), strict=True):
            for kick in range(MAX_KICKS):
                for at in (a, b):
                    free = np.flatnonzero(table[at] == 0)
                    if len(free):
                        table[at, free[0]] = fp
                        break
                else:
                    slot = (kick + fp) % SLOTS
                    fp, table[b, slot] = int(table[b, slot]), fp
                    a, b = b, b ^ int(_hop(fp, n_buckets))
                    continue
                break
            else:
                return False
        return True

    def delete(self, digests) -> None:
        """Take out keys that were inserted before."""
        if not len(digests):
            return
        for fp, a, b in zip(*(x.tolist() for x in _marks(*halves(digests), len(self.table))), strict=True):
            for at in (a, b):
                held = np.flatnonzero(self.table[at] == fp)
                if len(held):
                    self.table[at, held[0]] = 0
                    break

    def may_hold(self, digests) -> np.ndarray:
        if not len(digests):
            return np.zeros(0, bool)
        fp, first, second = _marks(*halves(digests), len(self.table))
        return (self.table[first] == fp[:, None]).any(1) | (self.table[second] == fp[:, None]).any(1)


def built(digests) -> CuckooFilter:
    size = len(digests)
    while True:
        out = CuckooFilter.for_keys(size)
        if out.insert(digests):
            return out
        size = 2 * max(size, 4)
