"""Characteristic polynomial of an integer symmetric matrix, its largest roots
and their null spaces, all exact or to many digits.

The polynomial is found modulo many primes (Hessenberg form, then the recurrence
over its leading minors) and put together by Chinese remaindering.  All its
roots are real, so Descartes' rule is exact: the sign changes of ``p(x + a)``
count the roots above ``a``, each as often as it occurs.  Bisection on that count
isolates a root, bisection on the sign of ``p`` refines it.  Vectors come from
inverse iteration in decimal arithmetic.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal, localcontext
from math import comb

import numpy as np

#: Roots are found to this many bits, vectors with this many digits.
ROOT_BITS = 160
DIGITS = 80


def _is_prime(n: int) -> bool:
    if n % 2 == 0:
        return n == 2
    d, r = n - 1, 0
    while d % 2 == 0:
        d, r = d // 2, r + 1
    for a in (2, 3, 5, 7):  # enough below 3,215,031,751
        x = pow(a, d, n)
        if a % n == 0 or x in (1, n - 1):
            continue
        for _ in range(r - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_above(product: int) -> Iterator[int]:
    """Falling primes below 2^31 whose product is larger than ``product``."""
    n, found = (1 << 31) - 1, 1
    while found <= product:
        if _is_prime(n):
            found *= n
            yield n
        n -= 2


def coefficient_bound(trace: int, size: int) -> int:
    """No coefficient of the characteristic polynomial of a positive
    semidefinite matrix of this trace is larger (Maclaurin's inequality)."""
    return max((comb(size, k) * trace ** k) // k ** k + 1 for k in range(1, size + 1))


def charpoly_mod(matrix: np.ndarray, prime: int) -> list[int]:
    """Coefficients of det(x - matrix) modulo ``prime`` (below 2^31), from x^0 up;
    ``matrix`` holds residues as 64-bit integers."""
    h, size = matrix.copy(), len(matrix)
    for c in range(size - 2):
        below = np.flatnonzero(h[c + 1:, c])
        if not len(below):
            continue
        r = c + 1 + int(below[0])
        if r != c + 1:
            h[[r, c + 1]] = h[[c + 1, r]]
            h[:, [r, c + 1]] = h[:, [c + 1, r]]
        factors = h[c + 2:, c] * pow(int(h[c + 1, c]), -1, prime) % prime
        h[c + 2:] = (h[c + 2:] - factors[:, None] * h[c + 1] % prime) % prime
        h[:, c + 1] = (h[:, c + 1] + (h[:, c + 2:] * factors % prime).sum(axis=1)) % prime
    polys = np.zeros((size + 1, size + 1), np.int64)
    polys[0, 0] = 1
    for k in range(1, size + 1):
        # Products of the subdiagonal towards row k, times the column above it.
        weights, product = np.zeros(k, np.int64), 1
        for i in range(k - 1, -1, -1):
            weights[i] = int(h[i, k - 1]) * product % prime
            product = product * int(h[i, i - 1]) % prime if i else 0
        polys[k, 1:] = polys[k - 1, :-1]
        polys[k] = (polys[k] - (weights[:, None] * polys[:k] % prime).sum(axis=0)) % prime
    return polys[size].tolist()


def remainders_joined(found: dict[int, list[int]]) -> list[int]:
    """The integers of smallest absolute value with these residues by prime."""
    product = 1
    for p in found:
        product *= p
    parts = [(product // p * pow(product // p, -1, p), residues) for p, residues in found.items()]
    out = []
    for i in range(len(next(iter(found.values())))):
        x = sum(part * residues[i] for part, residues in parts) % product
        out.append(x - product if 2 * x > product else x)
    return out


def roots_above(poly: list[int], c: int, s: int) -> int:
    """How many roots are larger than c / 2^s, with multiplicity."""
    size = len(poly) - 1
    a = [x << (s * (size - i)) for i, x in enumerate(poly)]
    for i in range(size):
        for j in range(size - 1, i - 1, -1):
            a[j] += c * a[j + 1]
    signs = [x > 0 for x in a if x]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def _sign(poly: list[int], c: int, s: int) -> int:
    value, size = 0, len(poly) - 1
    for i in range(size, -1, -1):
        value = value * c + (poly[i] << (s * (size - i)))
    return (value > 0) - (value < 0)


def largest_root(poly: list[int], k: int, bits: int = ROOT_BITS) -> tuple[int, int, int, int]:
    """(c, s, first, last): the k-th largest root (from 0), positive, is c / 2^s to
    ``bits`` bits; roots first to last - 1 cannot be told from it."""
    low, high, s = 0, -poly[-2], 0  # the trace bounds all roots
    below, above = len(poly) - 1, 0  # roots above low and above high
    side = None
    while high - low > 1 or (high << 1) >> bits < 1:
        if (high - low) << bits <= high:
            break
        if high - low <= 1:
            low, high, s = 2 * low, 2 * high, s + 1
        middle = (low + high) // 2
        if below - above > 1:
            n = roots_above(poly, middle, s)
            if n > k:
                low, below = middle, n
            else:
                high, above = middle, n
        else:
            if side is None:
                # One root lies above low and not above high; p changes sign there.
                side = 1 if above % 2 == 0 else -1
            if _sign(poly, middle, s) * side >= 0:
                high = middle
            else:
                low = middle
    return high, s, above, below


def null_vectors(matrix: list[list[int]], c: int, s: int, count: int, digits: int = DIGITS
                 ) -> np.ndarray:
    """(count, size): orthonormal vectors that ``matrix - c / 2^s`` all but sends
    to zero, by inverse iteration."""
    with localcontext() as context:
        context.prec = digits
        size = len(matrix)
        shift = Decimal(c) / (Decimal(2) ** s)
        a = np.array([[Decimal(x) for x in row] for row in matrix], dtype=object).reshape(size, size)
        tiny = (abs(a).max() + 1) * Decimal(10) ** (5 - digits)
        for i in range(size):
            a[i, i] -= shift
        order = np.arange(size)
        for i in range(size):
            best = i + max(range(size - i), key=lambda r: abs(a[i + r, i]))
            a[[i, best]], order[[i, best]] = a[[best, i]], order[[best, i]]
            if abs(a[i, i]) < tiny:
                a[i, i] = tiny
            if i + 1 < size:
                a[i + 1:, i] = a[i + 1:, i] / a[i, i]
                a[i + 1:, i + 1:] -= a[i + 1:, i][:, None] * a[i, i + 1:][None, :]
        vectors = [np.array([Decimal((7 * i * i + 13 * i * (j + 1) + 5 * j) % 101 - 50) + Decimal(j + 1) / 3
                             for i in range(size)], dtype=object) for j in range(count)]
        for _ in range(3):
            solved = []
            for v in vectors:
                x = v[order]
                for i in range(1, size):
                    x[i] -= (a[i, :i] * x[:i]).sum()
                for i in range(size - 1, -1, -1):
                    if i + 1 < size:
                        x[i] -= (a[i, i + 1:] * x[i + 1:]).sum()
                    x[i] /= a[i, i]
                x = x / abs(x).max()
                for u in solved:
                    x = x - u * (u * x).sum()
                solved.append(x / (x * x).sum().sqrt())
            vectors = solved
        out = np.array([[float(t) for t in v] for v in vectors]).reshape(count, size)
    lead = np.abs(out).argmax(axis=1)
    return out * np.where(out[np.arange(count), lead] < 0, -1.0, 1.0)[:, None]
