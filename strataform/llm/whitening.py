"""Whitening of embedding vectors from the exact characteristic polynomial of
their integer scatter matrix.

Each component c of a vector becomes the integer ``floor(SCALE * c)`` (an offset
added to all of them would change nothing below).  Over the distinct vectors,
``n * sum(x x') - S S'`` is n^2 times the covariance, in exact integers: tasks add
up products of 20-bit limbs, Spark adds the partial sums as decimals.  From there
on only matrices of the dimension are handled:

1. the characteristic polynomial modulo each of many primes, the primes dealt
   over tasks, joined by Chinese remaindering (``charpoly``);
2. one task a component isolates its root to 160 bits and finds its vector by
   inverse iteration; roots that cannot be told apart share one null space;
3. a pass over the distinct vectors measures the covariance of the result, and a
   pass over all rows projects them.

Only sums of the dimension's square, and one vector a component, reach the driver.

Defined results: vectors that are null, empty, or hold null or non-finite entries
are dropped; components of eigenvalue zero are left out, so equal vectors, one
vector, or an empty table give no row; repeated rows each give theirs; components
of one eigenvalue are any orthonormal basis of its space; ids may be null and of
any type; other columns are ignored; vectors of different lengths, and values
whose scaled floor leaves 62 bits, are an error.  There is no text; long vectors
cost their length cubed a prime and a component.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction
from math import gcd, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .charpoly import (charpoly_mod, coefficient_bound, largest_root, null_vectors, primes_above,
                       remainders_joined)
from .common import scratch_table

SCALE = 64
COMPONENTS = 16
LIMB = 20
PRIMES_PER_TASK = 8


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(id, x): the rows that take part, with their scaled floors."""
    entries = F.col(f"`{vec_col}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), entries.alias("c")).where(
        (F.size("c") > 0) & F.forall("c", lambda e: F.coalesce(
            F.abs(e) < float("inf"), F.lit(False))))
    return rows.select("id", F.transform("c", lambda e: F.when(
        F.abs(e * scale) < float(1 << 62), F.floor(e * scale)).otherwise(F.raise_error(F.lit(
            "a scaled value leaves 62 bits")).cast("bigint"))).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = pc.list_flatten(column).to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0), np.int64)


def _limbs(x: np.ndarray) -> list[np.ndarray]:
    """Signed parts of ``LIMB`` bits, lowest first, as doubles."""
    out = []
    while not out or x.any():
        low = ((x + (1 << (LIMB - 1))) & ((1 << LIMB) - 1)) - (1 << (LIMB - 1))
        out.append(low.astype(np.float64))
        x = (x - low) >> LIMB
    return out


def _partial_products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Upper triangles of the products of the vectors, each with a 1 behind it, by
    the weight of the limbs."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        x = _matrix(batch.column(0))
        for i in range(0, len(x), 4096):
            some = x[i:i + 4096]
            parts = _limbs(np.hstack([some, np.ones((len(some), 1), np.int64)]))
            for a, left in enumerate(parts):
                for b, right in enumerate(parts):
                    # Below 2^12 products of less than 2^39: exact in doubles.
                    product = (left.T @ right).astype(np.int64)
                    sums[a + b] = sums.get(a + b, 0) + product
            if max(int(np.abs(s).max()) for s in sums.values()) >= 1 << 61:
                yield from _rows(sums)
                sums = {}
    yield from _rows(sums)


def _rows(sums: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for weight, s in sums.items():
        i, j = np.triu_indices(len(s))
        yield pa.RecordBatch.from_arrays(
            [pa.array(i), pa.array(j), pa.array(np.full(len(i), weight)), pa.array(s[i, j])],
            names=["i", "j", "weight", "value"])


def scatter(distinct: DataFrame) -> tuple[int, list[int], list[list[int]]]:
    """(n, sums, n * sum(x x') - S S') of the vectors, exactly."""
    added = (distinct.select("x").mapInArrow(
        _partial_products, "i bigint, j bigint, weight bigint, value bigint")
        .groupBy("i", "j", "weight").agg(F.sum(F.col("value").cast("decimal(28,0)")).alias("v")))
    whole: dict[tuple[int, int], int] = {}
    for i, j, weight, v in added.collect():
        whole[i, j] = whole.get((i, j), 0) + (int(v) << (LIMB * weight))
    size = max((j for _, j in whole), default=0)
    n = whole.get((size, size), 0)
    sums = [whole[i, size] for i in range(size)]
    return n, sums, [[n * whole[min(i, j), max(i, j)] - sums[i] * sums[j] for j in range(size)]
                     for i in range(size)]


def characteristic_polynomial(spark, matrix: list[list[int]]) -> list[int]:
    """Coefficients from x^0 up, of a positive semidefinite integer matrix."""
    size = len(matrix)
    bound = coefficient_bound(sum(matrix[i][i] for i in range(size)), size)
    primes = list(primes_above(2 * bound))

    def residues(p: int) -> np.ndarray:
        return np.array([[x % p for x in row] for row in matrix], np.int64)

    def run(batches):
        for batch in batches:
            yield batch.assign(coefficients=[charpoly_mod(residues(int(p)), int(p))
                                             for p in batch["prime"]])

    tasks = -(-len(primes) // PRIMES_PER_TASK)
    rows = spark.createDataFrame([(p,) for p in primes], "prime bigint").repartition(
        tasks, "prime").mapInPandas(run, "prime bigint, coefficients array<bigint>").collect()
    return remainders_joined({r.prime: list(r.coefficients) for r in rows})


def principal_components(spark, matrix: list[list[int]], components: int
                         ) -> list[tuple[Fraction, np.ndarray]]:
    """(eigenvalue to many digits, unit vector) of the largest positive eigenvalues."""
    size = len(matrix)
    factor = gcd(*(x for row in matrix for x in row)) if size else 0
    if not factor:
        return []
    small = [[x // factor for x in row] for row in matrix]
    poly = characteristic_polynomial(spark, small)
    positive = size - next(i for i, c in enumerate(poly) if c)
    wanted = min(components, positive)

    def run(batches):
        import pandas as pd

        for batch in batches:
            for k in batch["id"]:
                c, s, first, last = largest_root(poly, int(k))
                v = null_vectors(small, c, s, last - first)[int(k) - first]
                yield pd.DataFrame({"k": [int(k)], "c": [str(c)], "s": [s], "v": [v.tolist()]})

    rows = spark.range(wanted, numPartitions=wanted).mapInPandas(
        run, "k bigint, c string, s bigint, v array<double>").collect()
    return [(Fraction(int(r.c), 1 << r.s) * factor, np.array(r.v))
            for r in sorted(rows, key=lambda r: r.k)]


def _projected(x: np.ndarray, n: int, sums: list[int], directions: np.ndarray) -> np.ndarray:
    """The vectors less the mean, on each direction."""
    top = int(np.abs(x).max(initial=0))
    if n * top + max(map(abs, sums)) < 1 << 52:
        centred = (n * x - np.array(sums, np.int64)) / n
    else:
        centred = np.array([[float(Fraction(n * int(c) - s, n)) for c, s in zip(row, sums, strict=True)]
                            for row in x])
    return centred @ directions


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Sum over dimensions of (n * x - S)^2, exactly."""
    total = sum(s * s for s in sums)
    top = int(np.abs(x).max(initial=0))
    if top * top * x.shape[1] < 1 << 62 and top * sum(map(abs, sums)) < 1 << 62:
        squares = (x * x).sum(axis=1).tolist()
        crossed = (x @ np.array(sums, np.int64)).tolist()
    else:
        squares = [sum(c * c for c in row) for row in x.tolist()]
        crossed = [sum(c * s for c, s in zip(row, sums, strict=True)) for row in x.tolist()]
    return [n * n * a - 2 * n * b + total for a, b in zip(squares, crossed, strict=True)]


def _identity_error(distinct: DataFrame, n: int, sums: list[int], directions: np.ndarray) -> float:
    """Largest absolute entry of the whitened vectors' covariance less the identity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = _projected(_matrix(batch.column(0)), n, sums, directions)
            w = np.hstack([w, np.ones((len(w), 1))])
            i, j = np.triu_indices(w.shape[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(i), pa.array(j), pa.array((w.T @ w)[i, j])], names=["i", "j", "value"])

    size = directions.shape[1]
    whole = np.zeros((size + 1, size + 1))
    for i, j, v in distinct.select("x").mapInArrow(run, "i bigint, j bigint, value double").groupBy(
            "i", "j").agg(F.sum("value")).collect():
        whole[i, j] = whole[j, i] = v
    mean = whole[:-1, -1] / n
    return float(np.abs(whole[:-1, :-1] / n - np.outer(mean, mean) - np.eye(size)).max())


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
           components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """One row per vector that takes part: ``id_col``, n (distinct vectors),
    deviation (decimal: exact sum of (n * x - S)^2; null beyond 38 digits),
    whitened and explained (one double a component) and identity_error."""
    spark = vectors.sparkSession
    rows = integer_vectors(vectors, id_col, vec_col, scale)
    distinct = scratch_table(rows.select("x").distinct(), "distinct-vectors")
    shortest, longest = distinct.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if shortest != longest:
        raise ValueError(f"vectors of different lengths: {shortest} to {longest}")
    schema = T.StructType([
        T.StructField(id_col, vectors.schema[id_col].dataType), T.StructField("n", T.LongType()),
        T.StructField("deviation", T.DecimalType(38, 0)),
        T.StructField("whitened", T.ArrayType(T.DoubleType())),
        T.StructField("explained", T.ArrayType(T.DoubleType())),
        T.StructField("identity_error", T.DoubleType())])
    if longest is None:
        return spark.createDataFrame([], schema)
    n, sums, matrix = scatter(distinct)
    found = principal_components(spark, matrix, components)
    if not found:
        return spark.createDataFrame([], schema)
    trace = sum(matrix[i][i] for i in range(len(matrix)))
    # An eigenvalue of the scatter is n^2 times one of the covariance.
    directions = np.stack([v / sqrt(e / (n * n)) for e, v in found], axis=1)
    explained = [float(e / trace) for e, _ in found]
    error = _identity_error(distinct, n, sums, directions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x = _matrix(batch.column(1))
            w = _projected(x, n, sums, directions)
            bounds = pa.array(np.arange(len(x) + 1) * w.shape[1], pa.int32())
            far = [Decimal(d) if d < 10 ** 38 else None for d in _deviations(x, n, sums)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(x), n)), pa.array(far, pa.decimal128(38, 0)),
                 pa.ListArray.from_arrays(bounds, pa.array(w.ravel())),
                 pa.ListArray.from_arrays(bounds, pa.array(np.tile(explained, len(x)))),
                 pa.array(np.full(len(x), error))], names=schema.names)

    return rows.mapInArrow(run, schema)


def by_component(whitened: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """One row per vector and component of ``whiten``, numbered from 1; deviation
    is null where it leaves 64 bits."""
    pairs = F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "pair")
    return whitened.select(
        F.col(f"`{id_col}`"), "n", F.col("deviation").alias("_deviation"), "identity_error", pairs
    ).select(F.col(f"`{id_col}`"), (F.col("place") + 1).cast("int").alias("component"), "n",
             F.col("_deviation").try_cast("bigint").alias("deviation"),
             F.col("pair.whitened").alias("whitened"), F.col("pair.explained").alias("explained"),
             "identity_error")
