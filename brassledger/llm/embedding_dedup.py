"""Near-duplicate vectors: spherical k-means cells, blocked cosine products, one representative per group.

Vectors link if their labels are equal and not null, their lengths are equal, and their cosine, in double precision, is
at least `threshold`.  Each (label, length) is a space of its own with its own cells, about `CELL_ROWS` vectors each.

No link is lost at the border of cells: with centres c (home) and d, a vector x within angle t of some vector that is
nearer to d than to c satisfies  x.(c - d) <= sin(t) |c - d|,  because x is then at most t away from the plane between
them.  So x is a guest of exactly the cells for which that holds (of two cells that would both see a pair, the lower
one is enough).  How many that are depends on the data: clustered vectors visit few cells; vectors without any structure
visit most, and then the work is that of comparing all, which an exact answer cannot avoid there.

A cell with very many vectors is split into blocks, each two of which meet in a task of bounded size.  A task returns
the number of links of each vector and a forest of the links it found, never the pairs.

Centres are fitted on a bounded sample (`SAMPLE_PER_CELL` vectors per cell, at most `MAX_CELLS` cells per space); they
only decide where vectors meet, not whether they link.

Nulls and odd rows: vectors that are null, empty, zero or hold null, NaN or infinite elements, and those without a
label, link with nothing and are kept; repeated rows are vectors of their own; rows with a null id count as links but
never name a component; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brassledger.llm.graph import connected, forest, spread_hot_groups, tile_edges
from brassledger.session import staged

CELL_ROWS = 4096
MAX_CELLS = 256
MAX_CENTRES = 16_384  # of all spaces together; spaces beyond them have one cell and are split into blocks instead
SAMPLE_PER_CELL = 64
BLOCK_ROWS = 4096
TILE = 512
ROUNDS = 8


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, in double precision; first by their largest element, so that none overflows."""
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def spherical_kmeans(vectors: np.ndarray, k: int) -> np.ndarray:
    """k centres of length one; seeded by the vectors farthest from those before, emptied cells keep their centre."""
    centres = [vectors[0]]
    nearest = vectors @ centres[0]
    for _ in range(k - 1):
        centres.append(vectors[nearest.argmin()])
        nearest = np.maximum(nearest, vectors @ centres[-1])
    c = np.array(centres)
    for _ in range(ROUNDS):
        cell = (vectors @ c.T).argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, cell, vectors)
        size = np.sqrt((sums * sums).sum(1))
        c[size > 0] = sums[size > 0] / size[size > 0, None]
    return c


def visits(vectors: np.ndarray, centres: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vector, cell, whether it is its home)."""
    near = vectors @ centres.T
    own = near.argmax(1)
    gap = np.sqrt(np.maximum(2 - 2 * (centres @ centres.T), 0))[own]
    reach = math.sqrt(max(0.0, 1 - threshold * threshold))
    guest = near[np.arange(len(vectors)), own][:, None] - near <= reach * gap + 1e-9
    guest &= np.arange(len(centres)) <= own[:, None]
    row, cell = np.nonzero(guest)
    return row, cell, cell == own[row]


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    """A column of equally long lists as a matrix."""
    lists = table.column(name).combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0)
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)


def _compare(v: np.ndarray, is_home: np.ndarray, own: np.ndarray, bi: int, bj: int, threshold: float):
    """Links per vector of one task, and the smallest position it is joined to."""
    n = len(v)
    counts = np.zeros(n, np.int64)
    homes, guests = np.flatnonzero(is_home), np.flatnonzero(~is_home)
    if bi == bj:
        sides = [(homes, homes), (homes, guests)]
    else:
        left, right = own == bi, own == bj
        sides = [(np.flatnonzero(left & is_home), np.flatnonzero(right)), (np.flatnonzero(right & is_home), np.flatnonzero(left & ~is_home))]
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for rows, columns in sides:
        if not len(columns):
            continue
        other = v[columns].T
        for at in range(0, len(rows), TILE):
            some = rows[at : at + TILE]
            mask = v[some] @ other >= threshold
            if rows is columns:
                mask[np.arange(len(some)), np.arange(at, at + len(some))] = False  # itself
                counts[some] += mask.sum(1)
            else:
                counts[some] += mask.sum(1)
                counts[columns] += mask.sum(0)
            x, y = tile_edges(mask, some, columns)
            a.append(x)
            b.append(y)
    return counts, forest(n, np.concatenate(a), np.concatenate(b))


def _centres(valid: DataFrame, sizes: list) -> dict[tuple[int, int], np.ndarray]:
    """Centres of every space with more than a cell of vectors, fitted on a sample of bounded size."""
    cells, left = {}, MAX_CENTRES
    for r in sorted(sizes, key=lambda r: (-r["n"], r["label"], r["width"])):
        k = min(math.ceil(r["n"] / CELL_ROWS), MAX_CELLS, left)
        if k > 1:
            cells[r["label"], r["width"]] = (k, r["n"])
            left -= k
    if not cells:
        return {}
    found = {}
    for (label, width), (k, n) in cells.items():
        space = valid.filter((F.col("label") == label) & (F.col("width") == width))
        share = min(1.0, 2 * k * SAMPLE_PER_CELL / n)
        some = space.filter(F.pmod(F.xxhash64("row"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
        sample = _numbers(some.select("vector").limit(k * SAMPLE_PER_CELL).toArrow(), "vector")
        if len(sample) > k:
            found[label, width] = spherical_kmeans(unit(sample), k)
    return found


def groups(vectors: DataFrame, threshold: float = 0.93) -> DataFrame:
    """Per row of (vec_id, embedding, label): vec_id, n_links, component_id, kept."""
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    rows = staged(rows, "vectors")  # from here on the row numbers are fixed
    usable = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable &= F.exists("vector", lambda x: x != 0)
    valid = rows.filter(F.col("label").isNotNull() & usable).withColumn("width", F.size("vector"))
    # A space is one (label, length): its sizes are needed for the number of cells.  Only large ones come back.
    spaces = valid.groupBy("label", "width").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > CELL_ROWS)
    centres = _centres(valid, spaces.orderBy(F.desc("n"), "label", "width").limit(MAX_CENTRES // 2).collect())

    def spread(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            label, width = (table.column(c).to_numpy() for c in ("label", "width"))
            order = np.lexsort((width, label))
            cuts = np.flatnonzero((np.diff(label[order]) != 0) | (np.diff(width[order]) != 0)) + 1
            for some in np.split(order, cuts):
                if not len(some):
                    continue
                part = table.take(pa.array(some))
                v = unit(_numbers(part, "vector"))
                c = centres.get((int(label[some[0]]), int(width[some[0]])))
                row, cell, is_home = (np.arange(len(v)), np.zeros(len(v), np.int64), np.ones(len(v), bool)) if c is None else visits(v, c, threshold)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("label").take(pa.array(row)).combine_chunks(),
                        part.column("width").take(pa.array(row)).combine_chunks(),
                        pa.array(cell.astype(np.int32)),
                        part.column("row").take(pa.array(row)).combine_chunks(),
                        pa.array(is_home),
                        pa.ListArray.from_arrays(np.arange(0, (len(row) + 1) * v.shape[1], v.shape[1], dtype=np.int32)[: len(row) + 1], v[row].ravel()),
                    ],
                    names=["label", "width", "cell", "row", "home", "vector"],
                )

    def compare(key, table):
        v = _numbers(table, "vector")
        row, is_home, own = (table.column(c).to_numpy() for c in ("row", "home", "own"))
        counts, root = _compare(v, is_home.astype(bool), own, key[3].as_py(), key[4].as_py(), threshold)
        hit = counts > 0
        return pa.table({"row": row[hit], "links": counts[hit], "root": row[root[hit]]})

    met = valid.mapInArrow(spread, "label long, width int, cell int, row long, home boolean, vector array<double>")
    tasks = spread_hot_groups(met, ["label", "width", "cell"], "row", BLOCK_ROWS)
    parts = tasks.groupBy("label", "width", "cell", "bi", "bj").applyInArrow(compare, "row long, links long, root long")
    parts = staged(parts, "partial-links")

    linked = parts.groupBy("row").agg(F.sum("links").alias("n_links"))
    roots = connected(parts.select(F.col("row").alias("a"), F.col("root").alias("b")))
    named = rows.select("row", "vec_id").join(linked, "row", "left").join(roots.withColumnRenamed("node", "row"), "row", "left")
    named = staged(named.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("root", "row").alias("root")), "rooted")
    least = named.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    return named.join(least, "root").select(
        "vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")
    )
