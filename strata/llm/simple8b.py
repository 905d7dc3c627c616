"""Simple-8b blocks of token ids. Small numpy helper that runs in Spark tasks.

A block holds whole documents, one after the other:

* header: magic ``S8B1``, then four unsigned 32-bit numbers: documents, ids,
  words, escapes;
* doc_id (signed 64-bit), null marks (8-bit) and id counts (unsigned 32-bit) of
  the documents;
* escapes: positions (unsigned 32-bit) and values (unsigned 64-bit) of the ids
  of ``1 << ESCAPE_BITS`` and more, which stand as 0 in the words;
* offsets (unsigned 32-bit): ids before every ``STRIDE``-th word, so that a part
  of a block can be read alone;
* words (unsigned 64-bit): a 4-bit selector and 60 bits with as many ids as the
  selector says, the first in the lowest bits.

All numbers are little-endian.
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC, STRIDE, ESCAPE_BITS = b"S8B1", 128, 20
# Fixed values of the format: ids per word and bits per id of each selector.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
_HEAD = struct.Struct("<4s4I")


def encode_words(ids: np.ndarray) -> np.ndarray:
    """Words for ids under ``1 << 60``: each takes the selector that packs the
    most of the ids that follow."""
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64)
    ids = ids.astype(np.uint64)
    width = np.frexp(ids.astype(np.float64))[1].astype(np.int8)  # bit lengths; a rounded-up one is still enough
    selector = np.full(n, 15, np.int8)
    wide, span = width, 1  # the widest of the ``span`` ids from each place on
    for s in range(len(COUNTS) - 2, -1, -1):
        count = int(COUNTS[s])
        if n < count:
            break
        while span < count:
            step = min(span, count - span)
            wide = np.maximum(wide[:-step], wide[step:])
            span += step
        fits = wide <= BITS[s]
        if not fits.any():
            break  # larger counts of narrower ids fit nowhere either
        selector[:len(fits)] -= fits  # who fits a larger count fits all smaller ones, with more bits each
    step = COUNTS.astype(np.uint8)[selector].tobytes()
    starts, i = [], 0
    while i < n:
        starts.append(i)
        i += step[i]
    first = np.array(starts)
    chosen = selector[first]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s in np.unique(chosen):
        rows = np.flatnonzero(chosen == s)
        if BITS[s]:
            for j in range(COUNTS[s]):
                words[rows] |= ids[first[rows] + j] << np.uint64(j * BITS[s])
    return words


def decode_words(words: np.ndarray) -> np.ndarray:
    """All ids of ``words``: one gather and scatter per selector in use."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[selector]
    first = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    for s in np.unique(selector):
        if BITS[s]:
            rows = np.flatnonzero(selector == s)
            mask = np.uint64((1 << int(BITS[s])) - 1)
            for j in range(COUNTS[s]):
                out[first[rows] + j] = (words[rows] >> np.uint64(j * BITS[s])) & mask
    return out


def encode_block(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    """One block of whole documents."""
    flat = np.concatenate(ids).astype(np.uint64) if ids else np.zeros(0, np.uint64)
    far = np.flatnonzero(flat >= np.uint64(1 << ESCAPE_BITS))
    values = flat[far]
    flat[far] = 0
    words = encode_words(flat)
    counts = COUNTS[(words >> np.uint64(60)).astype(np.int64)]
    offsets = (np.cumsum(counts) - counts)[::STRIDE]
    return b"".join([
        _HEAD.pack(MAGIC, len(ids), len(flat), len(words), len(far)),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], np.uint8).tobytes(),
        np.array([len(x) for x in ids], "<u4").tobytes(),
        far.astype("<u4").tobytes(), values.astype("<u8").tobytes(), offsets.astype("<u4").tobytes(),
        words.astype("<u8").tobytes()])


class Block:
    """Reader of one block."""

    def __init__(self, payload: bytes):
        magic, n_docs, self.n_ids, n_words, n_far = _HEAD.unpack_from(payload)
        if magic != MAGIC:
            raise ValueError("not a Simple-8b block")
        at = _HEAD.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, kind, n, at)
            at += out.nbytes
            return out

        ids, nulls = take("<i8", n_docs), take("u1", n_docs)
        self.doc_ids = [None if null else int(d) for d, null in zip(ids, nulls, strict=True)]
        self.counts = take("<u4", n_docs)
        self.far, self.values = take("<u4", n_far), take("<u8", n_far)
        self.offsets = take("<u4", -(-n_words // STRIDE))
        self.words = take("<u8", n_words)

    def read(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids start .. stop of the block, decoding only the strides they lie in."""
        stop = self.n_ids if stop is None else min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, np.uint64)
        lo = int(np.searchsorted(self.offsets, start, side="right")) - 1
        hi = int(np.searchsorted(self.offsets, stop, side="left"))
        out = decode_words(self.words[lo * STRIDE:hi * STRIDE])
        base = int(self.offsets[lo])
        a, b = np.searchsorted(self.far, [base, base + len(out)])
        out[self.far[a:b].astype(np.int64) - base] = self.values[a:b]
        return out[start - base:stop - base]
