"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

The rows are kept once as tiles of integers in a written table. Each step is one pass over it: every tile multiplies its
centred rows X with a direction and then their transpose with the product, so u = Xc and g = X'u come from the same read. Vectors on
the side of the dimensions stay on the driver; those on the side of the rows never do: each is held as the combination
``a`` of dimensions it comes from (u = Xa), which makes its inner products with X c the same as a'g. All are
orthogonalised fully on both sides. The small upper bidiagonal matrix has the singular values of X.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from panelkit.sources.tables import checkpointed, release

#: Entries become floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: Components at most.
MOST = 8
#: Bytes of a tile's numbers, so that an Arrow batch of many tiles stays small.
TILE_BYTES = 1 << 15
#: Steps that are made at least, unless there are fewer dimensions: up to then the bidiagonalisation is complete.
LEAST_STEPS = 128
#: Beyond those, residual of the wanted components against the largest singular value at which it ends.
RESIDUAL = 1e-14
#: Share of the largest singular value below which a direction has no variance.
NOTHING = 1e-12
#: Entries stay in this range, so that they are exact as doubles and as 64-bit integers.
RANGE = float(1 << 52)

# Sums leave a task as two halves of 32 bits each, which add up exactly.
_HALF = 32


@dataclass(frozen=True)
class Rows:
    """The prepared rows: tiles (``ids``, ``x``, ``kind``), their number, and the exact sum of each dimension."""

    tiles: DataFrame
    n: int
    sums: list[int]

    @property
    def base(self) -> np.ndarray:
        """The whole part of each mean."""
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> list[int]:
        """What the whole part leaves of each sum."""
        return [s % self.n for s in self.sums]


@dataclass(frozen=True)
class Whitening:
    """Unit eigenvectors in columns by falling eigenvalue, and the variance of all dimensions together."""

    vectors: np.ndarray
    eigenvalues: np.ndarray
    trace: float


def _dimensions(vectors: DataFrame) -> int:
    """The length that most vectors have, of equally many the larger."""
    sizes = vectors.groupBy(F.size("v").alias("size")).count()
    best = sizes.agg(F.max(F.struct("count", "size")).alias("best")).first().best
    return best.size if best else 0


def prepared(df: DataFrame, id_column: str, vector_column: str) -> Rows | None:
    """The usable rows as a written table of tiles, with count and sums; None if there is none."""
    entry = F.col(vector_column).cast("array<double>")
    usable = df.select(F.col(id_column).alias("id"), entry.alias("v")).filter(
        F.coalesce(F.size("v") > 0, F.lit(False))
        & F.coalesce(F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))
    )
    width = _dimensions(usable)
    if not width:
        return None
    id_type = df.schema[id_column].dataType
    arrow_id = to_arrow_type(id_type)

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("v").flatten().to_numpy().reshape(len(batch), width)
            x = np.clip(np.floor(SCALE * x), -RANGE, RANGE).astype(np.int64) + SHIFT
            held = x - SHIFT
            low, high = int(held.min(initial=0)), int(held.max(initial=0))
            kind = next(k for k in ("<i2", "<i4", "<i8") if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
            step = max(1, TILE_BYTES // (width * np.dtype(kind).itemsize))
            parts = range(0, len(batch), step)
            ids = batch.column("id").cast(arrow_id)
            sums = [x[a : a + step] for a in parts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.ListArray.from_arrays(pa.array([*parts, len(batch)], pa.int32()), ids),
                    pa.array([held[a : a + step].astype(kind).tobytes() for a in parts], pa.binary()),
                    pa.array([kind] * len(parts), pa.string()),
                    pa.array([(s >> _HALF).sum(0) for s in sums], pa.list_(pa.int64())),
                    pa.array([(s & ((1 << _HALF) - 1)).sum(0) for s in sums], pa.list_(pa.int64())),
                ],
                names=["ids", "x", "kind", "high", "low"],
            )

    schema = StructType([StructField("ids", ArrayType(id_type)), StructField("x", BinaryType())])
    schema = schema.add("kind", "string").add("high", ArrayType(LongType())).add("low", ArrayType(LongType()))
    made = checkpointed(usable.filter(F.size("v") == width).mapInArrow(tiles, schema))
    each = made.select("ids", F.posexplode(F.arrays_zip("high", "low")).alias("at", "s"))
    whole = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    found = each.groupBy("at").agg(whole("s.high").alias("high"), whole("s.low").alias("low"), F.sum(F.size("ids")).alias("n"))
    rows = sorted(found.collect())
    return Rows(made.drop("high", "low"), rows[0].n, [(int(r.high) << _HALF) + int(r.low) for r in rows])


def _centred(x: bytes, kind: str, base: np.ndarray, fraction: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A tile's rows less the whole part of the means, as integers, and less the means, as doubles."""
    whole = np.frombuffer(x, kind).reshape(-1, len(base)).astype(np.int64) + (SHIFT - base)
    return whole, whole - fraction


def _reduced(rows: Rows, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all tiles of ``part``, a vector of doubles for the centred rows of a tile.

    Tasks add up their tiles; their sums are added by as many tasks as their square root says, so the driver gets
    few vectors at any number of tasks.
    """
    base, fraction = rows.base, np.array(rows.rest) / rows.n

    def added(batches: Iterator[pa.RecordBatch], vectors: Callable[[pa.RecordBatch], Iterator[np.ndarray]]):
        total = None
        for batch in batches:
            for v in vectors(batch):
                total = v if total is None else total + v
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    def tiles(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for x, kind in zip(batch.column("x"), batch.column("kind")):
            yield part(_centred(x.as_py(), kind.as_py(), base, fraction)[1])

    def sums(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        return (np.frombuffer(s.as_py()) for s in batch.column("sums"))

    own = rows.tiles.select("x", "kind").mapInArrow(lambda batches: added(batches, tiles), "sums binary")
    fan = max(1, isqrt(rows.tiles.rdd.getNumPartitions()))
    found = own.repartition(fan).mapInArrow(lambda batches: added(batches, sums), "sums binary").collect()
    return sum(np.frombuffer(r.sums) for r in found)


def _against(v: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """A vector made orthogonal to the columns of a basis, twice for rounding."""
    for _ in range(2):
        v = v - basis @ (basis.T @ v)
    return v


def _products(c: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """For a tile: the square of its part of Xc, its part of X'Xc, and the square of all of its entries."""

    def part(x: np.ndarray) -> np.ndarray:
        u = x @ c
        return np.concatenate([x.T @ u, [u @ u, np.vdot(x, x)]])

    return part


def bidiagonalised(rows: Rows, most: int = MOST, seed: int = 13) -> Whitening:
    """The leading eigenvectors of the rows' covariance.

    In step k the product of X and the k-th vector v is made orthogonal to all earlier u; its length and what was taken off
    are the k-th column of the bidiagonal matrix. X'u, made orthogonal to all v, gives the next v. Where nothing is
    left (fewer directions than dimensions, or equal singular values), a new direction orthogonal to all v goes on.
    """
    width = len(rows.sums)
    draw = np.random.default_rng(seed)
    v = draw.standard_normal(width)
    v /= np.linalg.norm(v)
    basis, sources = np.empty((width, 0)), np.empty((width, 0))  # v by columns, and the a of u = X a
    images = np.empty((width, 0))  # X'u by columns
    small, trace, largest = np.empty((0, 0)), 0.0, 0.0
    guess = np.empty(0)  # what is known before of v's product with X along the earlier u
    for step in range(width):
        expected = np.zeros(step)
        expected[: len(guess)] = guess
        c = v - sources @ expected
        found = _reduced(rows, _products(c))
        g, square, trace = found[:width], found[width], found[width + 1]
        along = sources.T @ g  # inner products of Xc with every earlier u
        c, g = c - sources @ along, g - images @ along
        length = np.sqrt(max(square - along @ along, 0.0))
        column = np.append(expected + along, length)
        largest = max(largest, float(np.linalg.norm(column)))
        basis = np.column_stack([basis, v])
        nothing = length <= NOTHING * np.sqrt(trace)
        u_source, image = (np.zeros(width), np.zeros(width)) if nothing else (c / length, g / length)
        sources, images = np.column_stack([sources, u_source]), np.column_stack([images, image])
        small = np.block([[small, column[:-1, None]], [np.zeros((1, step)), np.array([[0.0 if nothing else length]])]])
        left = _against(image - column[-1] * v, basis)
        beta = float(np.linalg.norm(left))
        if step + 1 >= max(LEAST_STEPS, most):
            p, values, _ = np.linalg.svd(small)
            if beta * np.abs(p[-1, :most]).max() <= RESIDUAL * values[0]:
                break
        if beta > NOTHING * max(largest, 1e-300):
            v, guess = left / beta, np.append(np.zeros(step), beta)
        else:
            v, guess = _against(draw.standard_normal(width), basis), np.empty(0)
            size = np.linalg.norm(v)
            v = v / size if size else v
        v = _against(v, basis)
        v /= np.linalg.norm(v) or 1.0
    _, values, right = np.linalg.svd(small)
    kept = values[:most] > NOTHING * np.sqrt(trace)
    vectors = (basis @ right.T)[:, :most][:, kept]
    vectors /= np.linalg.norm(vectors, axis=0)
    return Whitening(vectors, values[:most][kept] ** 2 / rows.n, trace / rows.n)


def _identity_error(rows: Rows, found: Whitening) -> float:
    """How far the covariance of the whitened rows is from the identity, at most."""
    k = len(found.eigenvalues)
    w = found.vectors / np.sqrt(found.eigenvalues)

    def part(x: np.ndarray) -> np.ndarray:
        y = x @ w
        return np.concatenate([(y.T @ y).ravel(), y.sum(0)])

    sums = _reduced(rows, part) / rows.n
    covariance, mean = sums[: k * k].reshape(k, k), sums[k * k :]
    return float(np.abs(covariance - np.outer(mean, mean) - np.eye(k)).max())


def _deviations(whole: np.ndarray, n: int, rest: list[int]) -> list[int | None]:
    """Per row the sum over the dimensions of (n x - S)^2, exactly; None if it is no 64-bit integer."""
    largest = (int(np.abs(whole).max(initial=0)) + 1) * n
    if largest * largest * len(rest) < 1 << 63:
        y = whole * n - np.array(rest, np.int64)
        return (y * y).sum(1).tolist()
    near = ((whole.astype(np.float64) * n - np.array(rest, np.float64)) ** 2).sum(1)
    exact = [
        sum((int(c) * n - r) ** 2 for c, r in zip(row, rest)) if about < 1.001 * (1 << 63) else 1 << 63
        for row, about in zip(whole, near)
    ]
    return [e if e < 1 << 63 else None for e in exact]


def whitened(df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", most: int = MOST) -> DataFrame:
    """A row per usable vector and component: id, ``component`` from 1 by falling eigenvalue, ``n`` (usable rows),
    ``deviation`` (sum over the dimensions of (n x - S)^2, exact), ``whitened``, ``explained`` (share of the variance) and
    ``identity_error`` (largest entry of the whitened rows' covariance less the identity).

    Not usable, and dropped: NULL and empty vectors, those with NULL, NaN or infinite entries, and those of another
    length than most (of two equally frequent lengths the longer counts). An entry c is taken as the
    whole number floor(1024 c) + 100000, with 1024 c held within 2^52 either way. Directions without variance (at most
    1e-12 of the largest spread) are no components, so there may be fewer than ``most``, and none if all vectors are
    equal, which gives no rows. A deviation beyond 64 bits is NULL. NULL and repeated ids and repeated rows stay rows of their own. An
    empty table gives no rows. Other columns are not looked at.

    Up to ``LEAST_STEPS`` dimensions the bidiagonalisation is complete; with more it may end when the wanted
    components are found to ``RESIDUAL``. Each step reads the tiles once.
    """
    spark, id_type = df.sparkSession, df.schema[id_column].dataType
    schema = StructType([StructField("id", id_type)])
    for name, kind in (
        ("component", "integer"), ("n", "long"), ("deviation", "long"), ("whitened", "double"), ("explained", "double"),
        ("identity_error", "double"),
    ):
        schema = schema.add(name, kind)
    rows = prepared(df, id_column, vector_column)
    found = bidiagonalised(rows, most) if rows else None
    if found is None or not len(found.eigenvalues):
        return spark.createDataFrame([], schema).withColumnRenamed("id", id_column)
    error, k, n = _identity_error(rows, found), len(found.eigenvalues), rows.n
    base, rest, fraction = rows.base, rows.rest, np.array(rows.rest) / n
    w, explained = found.vectors / np.sqrt(found.eigenvalues), found.eigenvalues / found.trace

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x, kind in zip(batch.column("ids"), batch.column("x"), batch.column("kind")):
                whole, x = _centred(x.as_py(), kind.as_py(), base, fraction)
                each = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.values.take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(each), n)), pa.array(_deviations(whole, n, rest), pa.int64()).take(pa.array(each)),
                        pa.array((x @ w).ravel()), pa.array(np.tile(explained, len(x))), pa.array(np.full(len(each), error)),
                    ],
                    names=schema.names,
                )

    result = checkpointed(rows.tiles.mapInArrow(project, schema)).withColumnRenamed("id", id_column)
    release(rows.tiles)
    return result
