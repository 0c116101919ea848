"""Links between rows: compared in blocks, reduced to forests, joined into components."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brassledger.session import discard, shared_folder


# ---------------------------------------------------------------- inside a task
def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node it reaches over the undirected edges a-b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while not np.array_equal(label, jumped := label[label]):
            label = jumped
        if np.array_equal(label, before):
            break
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label


def tile_edges(mask: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join what the mask joins: each link of a sparse tile, a forest of a dense one.

    A dense tile holds as many links as the product of its sides; its forest
    has at most their sum, so a group of copies never becomes all its pairs.
    """
    if np.count_nonzero(mask) <= 4 * (len(rows) + len(columns)):
        r, c = np.nonzero(mask)
        return rows[r], columns[c]
    far = np.int64(len(rows))
    left, right = np.arange(len(rows)), np.full(len(columns), far)
    while True:
        right_new = np.minimum(right, np.where(mask, left[:, None], far).min(0))
        left_new = np.minimum(left, np.where(mask, right_new[None, :], far).min(1))
        if np.array_equal(left, left_new) and np.array_equal(right, right_new):
            break
        left, right = left_new, right_new
    met = right < far
    return np.concatenate([rows, columns[met]]), np.concatenate([rows[left], rows[right[met]]])


# ---------------------------------------------------------------- over the cluster
def spread_hot_groups(rows: DataFrame, keys: list[str], row: str, block_rows: int) -> DataFrame:
    """Adds `bi`, `bj`: every two rows of a group meet in a task of at most about 2 x block_rows rows.

    Groups up to block_rows stay whole, at (0, 0).  A larger one is cut into
    blocks by a hash of `row`; a row of block b goes to each pair (b, k).  `own`
    is the row's block, so that a task can compare block against block.
    Sizes are counted with map-side combination; only large groups are joined.
    """
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > block_rows)
    sizes = sizes.select(*[F.col(k).alias(f"_{k}") for k in keys], F.ceil(F.col("_n") / block_rows).alias("_blocks"))
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    met = rows.join(sizes, on, "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1).cast("long")))
    own = F.pmod(F.xxhash64(F.lit("block"), F.col(row)), F.col("_blocks"))
    met = met.withColumn("own", own).withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
    return met.select(
        *[F.col(c) for c in rows.columns],
        "own",
        F.least("own", "_other").alias("bi"),
        F.greatest("own", "_other").alias("bj"),
    )


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a long, b long); root is one node of its component.

    Rounds of contraction: every node moves to the neighbour of lowest hash
    (or stays), then edges are renamed and self-loops and repeats dropped.  The
    hash order is random against the ids, so also long chains shrink by a
    constant factor each round; a star takes two.  Each round's edges and moves
    are tables in the shared folder; neighbourhoods are minima, never lists.
    """
    spark = edges.sparkSession
    root = shared_folder(spark, "components")

    def put(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))
    tidy = lambda df: (
        df.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )
    now, moves, level = put(tidy(edges), "edges0"), [], 0
    while not now.isEmpty():
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = both.groupBy("a").agg(F.min(rank("b")).alias("m"))
        best = best.select(F.col("a").alias("node"), F.least(rank("a"), F.col("m"))["v"].alias("to"))
        move = put(best, f"moves{level}")
        moves.append(move)
        left = move.select(F.col("node").alias("a"), F.col("to").alias("x"))
        right = move.select(F.col("node").alias("b"), F.col("to").alias("y"))
        renamed = now.join(left, "a").join(right, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
        level += 1
        now = put(tidy(renamed), f"edges{level}")
        discard(spark, f"{root}/edges{level - 1}")
    if not moves:
        return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = moves[0].select("node", F.col("to").alias("root"))
    for move in moves[1:]:
        step = move.select(F.col("node").alias("root"), "to")
        found = found.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return found
