"""Hashed byte trigrams of texts as dense rows, for models over small spaces."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import text_blocks

_KEPT = np.arange(256, dtype=np.uint32)
for _b in range(0x80):
    if not chr(_b).isalpha():
        _KEPT[_b] = 0x20
_KEPT[0x41:0x5B] += 32


def trigram_counts(column: pa.Array, dims: int, rows: int = 256, max_bytes: int = 1 << 20
                   ) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, last row + 1, counts) with counts of shape (rows, dims), for
    at most ``rows`` rows and about ``max_bytes`` of text at a time.

    Letters are lowered, every other ASCII character counts as a space, and a
    space is added before and behind each text; ``dims`` is a power of two.
    """
    shift = np.uint32(32 - int(dims).bit_length() + 1)
    for at in range(0, len(column), rows):
        for a, b, data, offsets in text_blocks(column.slice(at, rows), max_bytes):
            n = b - a
            lengths = np.diff(offsets)
            padded = np.full(len(data) + 2 * n, 0x20, np.uint32)
            row = np.repeat(np.arange(n), lengths)
            padded[np.arange(len(data)) + 2 * row + 1] = _KEPT[data]
            codes = (padded[:-2] << np.uint32(16)) | (padded[1:-1] << np.uint32(8)) | padded[2:] \
                if len(padded) > 2 else padded[:0]
            # A text of m bytes has m trigrams in its padded form.
            owner = np.repeat(np.arange(n), lengths + 2)[:len(codes)]
            starts = offsets[:-1] + 2 * np.arange(n)
            inside = np.arange(len(codes)) < (starts + lengths)[owner]
            # Runs of spaces say nothing.
            inside &= codes != 0x202020
            bins = (codes[inside] * np.uint32(0x9E3779B1)) >> shift
            flat = owner[inside] * dims + bins.astype(np.int64)
            yield at + a, at + b, np.bincount(flat, minlength=n * dims).reshape(n, dims)
