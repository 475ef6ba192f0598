"""Block convolution: where short blocks of numbers recur, by exact integer
number-theoretic transforms.

The sum of squared differences between a block and each position of a window is
``sum(t^2) + sum(b^2) - 2 * sum(t * b)``; the last term is a correlation, taken
modulo primes.  The sum lies between 0 and ``width * top^2``, so it is zero if it
is zero modulo primes whose product is larger than that.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Primes of the form k * 2^m + 1 below 2^31, each with a primitive root.
PRIMES = ((2013265921, 31), (1811939329, 13), (469762049, 3))
#: Numbers transformed at a time.
CHUNK = 1 << 15


@lru_cache(maxsize=256)
def _twiddles(prime: int, root: int, half: int, inverse: bool) -> np.ndarray:
    w = pow(root, (prime - 1) // (2 * half), prime)
    if inverse:
        w = pow(w, -1, prime)
    out = np.ones(half, np.uint64)
    done = 1
    while done < half:
        out[done:2 * done] = out[:done] * np.uint64(pow(w, done, prime)) % np.uint64(prime)
        done *= 2
    return out[:, None]


def _mod(x: np.ndarray, p: np.uint64) -> None:
    q = x // p
    q *= p
    x -= q


def forward(a: np.ndarray, prime: int, root: int) -> None:
    """Transform the columns of ``a`` (a power of two rows, values below the
    prime) in place; the result is in bit-reversed order."""
    p, half = np.uint64(prime), len(a) // 2
    while half:
        pairs = a.reshape(-1, 2, half, a.shape[1])
        u, w = pairs[:, 0], pairs[:, 1]
        d = u + p
        d -= w
        u += w
        np.minimum(u, u - p, out=u)
        d *= _twiddles(prime, root, half, False)
        _mod(d, p)
        w[...] = d
        half //= 2


def inverse(a: np.ndarray, prime: int, root: int) -> None:
    """Undo ``forward`` in place, but for the factor ``len(a)``."""
    p, half = np.uint64(prime), 1
    while half < len(a):
        pairs = a.reshape(-1, 2, half, a.shape[1])
        u, w = pairs[:, 0], pairs[:, 1]
        d = w * _twiddles(prime, root, half, True)
        _mod(d, p)
        w[...] = u
        w += p
        w -= d
        np.minimum(w, w - p, out=w)
        u += d
        np.minimum(u, u - p, out=u)
        half *= 2


def primes_needed(top: np.ndarray, width: int) -> np.ndarray:
    """How many of ``PRIMES`` tell sums up to ``width * top^2`` from zero."""
    largest = np.asarray(top, np.float64) ** 2 * width * (1 + 1e-9)
    bounds = np.cumprod([float(p) for p, _ in PRIMES])
    return np.searchsorted(bounds, largest, "right") + 1


def recurrences(values: np.ndarray, starts: np.ndarray, room: np.ndarray, top: np.ndarray,
                width: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """All (start, distance) with ``values[start + i] == values[start + distance + i]``
    for every i below ``width``, for distances from ``low`` below ``high``.

    ``values`` are not negative; ``room`` is the largest distance allowed at each
    start, and ``top`` bounds the values that start can meet.
    """
    size = 1
    while size < high - low - 1 + width:
        size *= 2
    padded = np.concatenate([values, np.zeros(high + size, np.int64)]).astype(np.uint64)
    squares = np.zeros(len(padded) + 1, np.uint64)
    np.cumsum(padded * padded, out=squares[1:])
    sums = squares[width:] - squares[:-width]
    needed = primes_needed(top, width)
    if len(needed) and needed.max() > len(PRIMES):
        raise ValueError("more different values than the primes can tell apart")
    at_start, at_distance = [], []
    spread, shift = np.arange(size), np.arange(high - low)
    for count in np.unique(needed):
        chosen = np.flatnonzero(needed == count)
        step = max(1, CHUNK // size)
        for i in range(0, len(chosen), step):
            some = chosen[i:i + step]
            b = starts[some]
            window = padded[(b + low)[None, :] + spread[:, None]]
            block = np.zeros_like(window)
            block[0] = padded[b]
            if width > 1:
                block[:size - width:-1] = padded[b[None, :] + np.arange(1, width)[:, None]]
            both = sums[(b + low)[None, :] + shift[:, None]] + sums[b]
            zero = shift[:, None] + low <= room[some]
            for prime, root in PRIMES[:count]:
                p = np.uint64(prime)
                x, y = window % p, block % p
                forward(x, prime, root)
                forward(y, prime, root)
                x *= y
                _mod(x, p)
                inverse(x, prime, root)
                twice = x[:high - low] * np.uint64(2)
                _mod(twice, p)
                square = both % p
                square *= np.uint64(size)
                _mod(square, p)
                zero &= twice == square
            d, s = np.nonzero(zero)
            at_start.append(b[s])
            at_distance.append(d + low)
    empty = np.empty(0, np.int64)
    return (np.concatenate([empty, *at_start]).astype(np.int64),
            np.concatenate([empty, *at_distance]).astype(np.int64))
