"""Whitening of embeddings: exact cross-products from bit slices, then the leading eigenvectors.

Entries become integers, ``floor(1024 * c) + 100000``.  Every batch of rows is shifted by its smallest entry of each
dimension and cut into bit planes; a plane holds one bit of one dimension for 64 rows in each word.  The product of two
dimensions over all rows is then  sum over planes a, b of 2^(a+b) * popcount(plane a AND plane b),  which is exact, and
so is taking the shift out again.  Tasks return one integer for each pair of dimensions; Spark adds them up.  Centring
is done on those integers (n * sum of products - product of sums) before the only rounding, the division by n squared.

What reaches the driver is one integer per pair of dimensions, whatever the number of rows.  Whitening itself is a
narrow pass.  The check at the end, how far the covariance of the whitened vectors is from the identity, reads their
staged table twice: means first, then centred products.

Nulls and odd rows: vectors that are null or hold null, NaN or infinite entries are left out; vectors of different
lengths have no common covariance, so each length is a fit list of its own (empty vectors have no component); repeated
rows count as often as they occur; null ids are kept; components without variance (all vectors equal, or fewer rows
than components) are not returned; an empty table gives no rows; further columns are ignored.  `deviation` is null
where the exact number does not fit a long.  Entries beyond 2^52 / 1024 do not fit the integers and raise an error.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brassledger.session import staged

SCALE, OFFSET = 1024, 100_000
TILE_BYTES = 4 << 20
FLAT = 1e-12  # components with less than this share of the largest eigenvalue are rounding


def integers(vectors: np.ndarray) -> np.ndarray:
    scaled = np.floor(vectors.astype(np.float64) * SCALE)
    if len(scaled) and np.abs(scaled).max() >= 2.0**52:
        raise OverflowError("an entry is too large for the integer grid")
    return scaled.astype(np.int64) + OFFSET


def bit_planes(u: np.ndarray) -> np.ndarray:
    """(bits, dimensions, words) of non-negative integers (rows, dimensions)."""
    bits = max(int(u.max()).bit_length(), 1)
    rows = -(-len(u) // 64) * 64
    planes = np.zeros((bits, u.shape[1], rows // 64), np.uint64)
    for b in range(bits):
        packed = np.zeros((u.shape[1], rows // 8), np.uint8)
        packed[:, : -(-len(u) // 8)] = np.packbits(((u >> b) & 1).astype(np.uint8).T, axis=1)
        planes[b] = packed.view(np.uint64)
    return planes


def _meet(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """For every two dimensions, in how many rows both have the bit; tiled so that the words of a tile stay in cache."""
    d, words = one.shape
    counts = np.empty((d, d), np.int64)
    step = max(1, TILE_BYTES // (8 * d * max(words, 1)))
    for at in range(0, d, step):
        both = one[at : at + step, None, :] & other[None, :, :]
        counts[at : at + step] = np.bitwise_count(both).sum(2, dtype=np.int64)
    return counts


def scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums (d) and sums of products (d, d) of integer rows, as Python integers."""
    low = x.min(0)
    planes = bit_planes((x - low).astype(np.uint64))
    bits, d, _ = planes.shape
    narrow = 2 * bits + len(x).bit_length() < 62
    products = np.zeros((d, d), np.int64 if narrow else object)
    sums = np.zeros(d, object)
    for a in range(bits):
        sums += np.bitwise_count(planes[a]).sum(1, dtype=np.int64).astype(object) * (1 << a)
        for b in range(a, bits):
            met = _meet(planes[a], planes[b])
            met = met if a == b else met + met.T
            products += (met if narrow else met.astype(object)) * (1 << (a + b))
    shift, n = low.astype(object), len(x)
    products = products.astype(object) + np.outer(shift, sums) + np.outer(sums, shift) + n * np.outer(shift, shift)
    return sums + n * shift, products


@dataclass(frozen=True)
class Whitener:
    """For vectors of one length: rows, integer sums, mean, components over the root of their eigenvalue, shares."""

    n: int
    sums: list[int]
    mean: np.ndarray
    axes: np.ndarray
    explained: np.ndarray


def solve(n: int, sums: np.ndarray, products: np.ndarray, components: int) -> Whitener:
    """Eigenvectors of the covariance, by falling eigenvalue."""
    centred = n * products - np.outer(sums, sums)
    covariance = (centred / (n * n)).astype(np.float64)  # Python integers: correctly rounded
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = int((values[:components] > FLAT * max(values[0], 0.0)).sum()) if np.trace(covariance) > 0 else 0
    mean = (sums / n).astype(np.float64)
    axes = vectors[:, :kept] / np.sqrt(values[:kept])
    return Whitener(n, [int(s) for s in sums], mean, axes, values[:kept] / np.trace(covariance) if kept else values[:0])


def usable(embedding):
    """Not null, and all entries finite."""
    finite = F.forall(embedding, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(finite & (F.size(embedding) > 0), F.lit(False))


def _by_width(column: pa.Array):
    """(row numbers, matrix) for every length of list in the column."""
    sizes = np.diff(column.offsets.to_numpy())
    for width in np.unique(sizes):
        at = np.flatnonzero(sizes == width)
        part = column if len(at) == len(column) else column.take(pa.array(at))
        yield at, part.flatten().to_numpy(zero_copy_only=False).reshape(len(at), width)


def moments(vectors: DataFrame) -> DataFrame:
    """(width, i, j, value): i = j = -1 the number of rows, i = -1 the sum of j, else the sum of products, i <= j."""

    def run(batches):
        found: dict[int, list] = {}
        for batch in batches:
            for _, matrix in _by_width(batch.column(0)):
                sums, products = scatter(integers(matrix))
                held = found.setdefault(matrix.shape[1], [0, 0, 0])
                held[0] += len(matrix)
                held[1] = held[1] + sums
                held[2] = held[2] + products
        for width, (n, sums, products) in found.items():
            i, j = np.triu_indices(width)
            values = [n, *sums, *products[i, j]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(values), width, np.int32)),
                    pa.array(np.concatenate([[-1], np.full(width, -1), i]).astype(np.int32)),
                    pa.array(np.concatenate([[-1], np.arange(width), j]).astype(np.int32)),
                    pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0)),
                ],
                names=["width", "i", "j", "value"],
            )

    parts = vectors.select("embedding").mapInArrow(run, "width int, i int, j int, value decimal(38,0)")
    return parts.groupBy("width", "i", "j").agg(F.sum("value").cast("decimal(38,0)").alias("value"))


def fit(vectors: DataFrame, components: int) -> dict[int, Whitener]:
    """One whitener per length of vector, from all rows."""
    rows = moments(vectors).collect()  # as many as pairs of dimensions
    found = {}
    for width in {r["width"] for r in rows}:
        n, sums, products = 0, np.zeros(width, object), np.zeros((width, width), object)
        for r in rows:
            if r["width"] == width:
                i, j, value = r["i"], r["j"], int(r["value"])
                if j < 0:
                    n = value
                elif i < 0:
                    sums[j] = value
                else:
                    products[i, j] = products[j, i] = value
        found[width] = solve(n, sums, products, components)
    return found


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n * x - S)^2, exactly."""
    far = max(abs(n * int(v) - s) for bound in (x.min(0), x.max(0)) for v, s in zip(bound, sums, strict=True))
    whole = n * int(np.abs(x).max()) + max(map(abs, sums)) < 1 << 62 and far * far * x.shape[1] < 1 << 62
    held = np.int64 if whole else object
    off = n * x.astype(held) - np.array(sums, held)
    return [int(v) if v < 1 << 63 else None for v in (off * off).sum(1)]


def whiten(embeddings: DataFrame, components: int = 8) -> DataFrame:
    """Per usable row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    vectors = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    vectors = vectors.filter(usable(F.col("embedding")))
    models = fit(vectors, components)

    def project(batches):
        for batch in batches:
            ids = batch.column(0)
            for at, matrix in _by_width(batch.column(1)):
                m = models[matrix.shape[1]]
                x = integers(matrix)
                w = (x - m.mean) @ m.axes
                starts = np.arange(0, w.size + 1, w.shape[1] or 1, dtype=np.int32) if w.shape[1] else np.zeros(len(w) + 1, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(at)),
                        pa.array(np.full(len(at), matrix.shape[1], np.int32)),
                        pa.array(deviations(x, m.n, m.sums), pa.int64()),
                        pa.ListArray.from_arrays(starts, w.ravel()),
                    ],
                    names=["vec_id", "width", "deviation", "whitened"],
                )

    schema = "vec_id long, width int, deviation long, whitened array<double>"
    found = staged(vectors.mapInArrow(project, schema), "whitened")
    errors = _identity_errors(found, models)
    facts = [
        (w, k, m.n, float(m.explained[k - 1]), errors.get(w)) for w, m in sorted(models.items()) for k in range(1, len(m.explained) + 1)
    ]
    kind = "array<struct<width:int,component:int,n:long,explained:double,identity_error:double>>"
    named = F.array(*[F.struct(*[F.lit(v) for v in fact]) for fact in facts]).cast(kind) if facts else F.array().cast(kind)
    rows = found.withColumn("fact", F.explode(F.filter(named, lambda f: f["width"] == F.col("width"))))
    return rows.select(
        "vec_id",
        F.col("fact.component").alias("component"),
        F.col("fact.n").alias("n"),
        "deviation",
        F.element_at("whitened", F.col("fact.component")).alias("whitened"),
        F.col("fact.explained").alias("explained"),
        F.col("fact.identity_error").alias("identity_error"),
    )


def _identity_errors(found: DataFrame, models: dict[int, Whitener]) -> dict[int, float]:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, for each length."""
    errors = {}
    for width, m in models.items():
        ks = range(len(m.explained))
        if not ks:
            continue
        rows = found.filter(F.col("width") == width)
        means = rows.agg(*[F.avg(F.col("whitened")[k]).alias(f"m{k}") for k in ks]).first()
        off = [F.col("whitened")[k] - F.lit(means[f"m{k}"]) for k in ks]
        pairs = [(a, b) for a in ks for b in ks if a <= b]
        cov = rows.agg(*[F.avg(off[a] * off[b]).alias(f"c{a}_{b}") for a, b in pairs]).first()
        errors[width] = max(abs(cov[f"c{a}_{b}"] - (a == b)) for a, b in pairs)
    return errors
