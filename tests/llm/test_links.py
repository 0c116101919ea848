"""Linking operators against brute force: components, embedding near-duplicates, SimHash."""

import math
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from brassledger.llm import embedding_dedup, graph, simhash
from brassledger.session import ship_package


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def roots_by_hand(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def classes(root):
    found = defaultdict(set)
    for node, r in root.items():
        found[r].add(node)
    return {frozenset(c) for c in found.values()}


# ---------------------------------------------------------------- graph
@pytest.mark.parametrize("seed", range(5))
def test_forest_equals_union_find(seed):
    rng = np.random.default_rng(seed)
    n, m = 60, int(rng.integers(0, 90))
    a, b = rng.integers(0, n, m), rng.integers(0, n, m)
    assert graph.forest(n, a, b).tolist() == list(roots_by_hand(range(n), zip(a.tolist(), b.tolist())).values())


@pytest.mark.parametrize("share", [0.0, 0.02, 0.3, 0.95])
def test_tile_edges_connect_what_the_mask_connects(share):
    mask = np.random.default_rng(3).random((40, 50)) < share
    rows, columns = np.arange(40), np.arange(30, 80)  # the sides overlap
    x, y = graph.tile_edges(mask, rows, columns)
    r, c = np.nonzero(mask)
    assert graph.forest(80, x, y).tolist() == graph.forest(80, rows[r], columns[c]).tolist()
    assert len(x) <= 4 * 90


def test_connected_over_chains_stars_and_cliques(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 540)]
    clique = [(a, b) for a in range(900, 908) for b in range(900, 908)]
    edges = [*chain, *star, *clique, (7, 7)]
    found = graph.connected(spark.createDataFrame(edges, "a long, b long")).collect()
    nodes = {n for e in edges[:-1] for n in e}
    assert {r.node for r in found} == nodes
    assert classes({r.node: r.root for r in found}) == classes(roots_by_hand(nodes, edges[:-1]))
    assert graph.connected(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("limit", [2, 7, 100])
def test_rows_of_a_split_group_meet_once(spark, limit):
    rows = spark.createDataFrame([(k, r) for k, n in ((1, 20), (None, 5), (2, 1)) for r in range(n)], "k long, r long")
    tasks = defaultdict(list)
    for t in graph.spread_hot_groups(rows, ["k"], "r", limit).collect():
        tasks[t.k, t.bi, t.bj].append((t.own, t.r))
    met = defaultdict(int)
    for (k, bi, bj), members in tasks.items():
        for x in members:
            for y in members:
                if x[1] < y[1] and {x[0], y[0]} == {bi, bj}:
                    met[k, x[1], y[1]] += 1
    assert set(met.values()) == {1} and len(met) == 190 + 10


# ---------------------------------------------------------------- vectors
def vectors(seed=5):
    rng = np.random.default_rng(seed)
    rows, n = [], 0
    for label in (1, 2, None):
        for _ in range(12):
            base = rng.normal(size=8)
            for _ in range(int(rng.integers(1, 6))):
                rows.append((n, (base + rng.normal(scale=0.25, size=8)).tolist(), label, 0))
                n += 1
    odd = [None, [], [0.0] * 8, [float("nan")] + [1.0] * 7, [float("inf")] * 8, [None] + [1.0] * 7, [1e300] * 8, [1e-300] * 8, [1.0] * 3]
    rows += [(n + i, v, 1, 0) for i, v in enumerate(odd)]
    rows += [(rows[0][0], rows[0][1], 1, 0), (None, rows[0][1], 1, 0)]
    return rows


def links_by_hand(rows, threshold):
    def direction(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v) / max(map(abs, v))
        return v / np.linalg.norm(v)

    unit = [direction(v) for _, v, _, _ in rows]
    edges = []
    for i, a in enumerate(unit):
        for j in range(i):
            b = unit[j]
            if a is not None and b is not None and len(a) == len(b) and rows[i][2] == rows[j][2] and rows[i][2] is not None:
                if a @ b >= threshold:
                    edges.append((i, j))
    return edges


@pytest.mark.parametrize("cell_rows, block_rows", [(4096, 4096), (8, 4096), (8, 5)])
def test_vectors_equal_brute_force(spark, monkeypatch, cell_rows, block_rows):
    monkeypatch.setattr(embedding_dedup, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(embedding_dedup, "BLOCK_ROWS", block_rows)
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, n_links int").repartition(4)
    found = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.groups(df, 0.93).collect()), key=str)
    edges = links_by_hand(rows, 0.93)
    root = roots_by_hand(range(len(rows)), edges)
    expected = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in root if root[j] == root[i] and rows[j][0] is not None]
        least = min(ids, default=None)
        expected.append((r[0], sum(i in e for e in edges), least, r[0] is not None and r[0] == least))
    assert found == sorted(expected, key=str)


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.groups(df).count() == 0


def test_cells_lose_no_link():
    """Every pair within reach has a home among the cells that both visit."""
    rng = np.random.default_rng(11)
    base = embedding_dedup.unit(rng.normal(size=(300, 6)))
    v = embedding_dedup.unit(np.concatenate([base, base + rng.normal(scale=0.1, size=base.shape)]))
    centres = embedding_dedup.spherical_kmeans(v, 9)
    row, cell, is_home = embedding_dedup.visits(v, centres, 0.93)
    seen, homes = set(zip(row.tolist(), cell.tolist())), dict(zip(row[is_home].tolist(), cell[is_home].tolist()))
    near = np.argwhere(v @ v.T >= 0.93)
    assert len(near) > 900
    for a, b in near.tolist():
        assert ((a, homes[b]) in seen) or ((b, homes[a]) in seen)


# ---------------------------------------------------------------- SimHash
def print_by_hand(text, words=4):
    tokens = (text or "").encode().lower().split()
    shingles = [b" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))] if tokens else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_of_odd_texts():
    for text in (None, "", " \n", "one", "A b C", "a b c d", "É é\tx y\x0bz", "w " * 30_000 + "end", "a b c d e"):
        assert simhash.fingerprint(text) == print_by_hand(text)


def test_hamming_code_covers_within_one_bit():
    words = np.arange(128)
    assert len(set(simhash.NEAREST.tolist())) == 16
    assert np.bitwise_count(simhash.NEAREST ^ words).max() == 1


@pytest.mark.parametrize("parts", [2, 3, 5])
def test_linked_fingerprints_meet_at_a_home(parts):
    rng = np.random.default_rng(parts)
    a = rng.integers(0, 1 << 63, 150, dtype=np.int64).astype(np.uint64)
    b = a.copy()
    for i in range(len(b)):
        for bit in rng.choice(64, rng.integers(0, 5), replace=False):
            b[i] ^= np.uint64(1 << int(bit))
    row, key, is_home = simhash.anchors(np.concatenate([a, b]), parts, 4)
    at, homes = defaultdict(set), defaultdict(set)
    for r, k, h in zip(row.tolist(), key.tolist(), is_home.tolist()):
        at[r].add(k)
        if h:
            homes[r].add(k)
    for i in range(150):
        assert at[i] & homes[i + 150] or at[i + 150] & homes[i]


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(400)]
    found = []
    for _ in range(25):
        base = rng.choice(words, 120).tolist()
        for _ in range(int(rng.integers(1, 5))):
            copy = list(base)
            for at in rng.choice(120, rng.integers(0, 4), replace=False):
                copy[at] = "edit"
            found.append(" ".join(copy))
    return [*found, None, "", "  ", found[0], found[0], "short", "SHORT"]


@pytest.mark.parametrize("block_rows", [8192, 4])
def test_components_equal_brute_force(spark, texts, monkeypatch, block_rows):
    monkeypatch.setattr(simhash, "BLOCK_ROWS", block_rows)
    df = spark.createDataFrame([(i + 10, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, fp string").repartition(3)
    prints = [print_by_hand(t) for t in texts]
    edges = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    root = roots_by_hand(range(len(prints)), edges)
    found = {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in simhash.components(df).collect()}
    assert found == {i + 10: (prints[i], root[i] + 10) for i in root}
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r + 10 for r in root.values()})


def test_repeated_and_missing_ids(spark):
    rows = [(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (None, "other words entirely here"), (9, "a b c d e")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(((r.doc_id, r.component_id) for r in simhash.components(df).collect()), key=str)
    assert found == sorted([(1, 1), (1, 1), (None, 1), (None, None), (9, 1)], key=str)
    assert sorted((r.doc_id for r in simhash.keep_first(df).collect()), key=str) == [1, None, None]
    none = df.limit(0)
    assert simhash.components(none).count() == 0 and simhash.keep_first(none).count() == 0


def test_rows_are_kept_by_component_and_not_by_id(spark):
    a, b, c = "a b c d e", "other words entirely here now", "third text of some more words"
    rows = [(1, a), (5, a), (5, b), (5, c), (5, c), (7, b), (None, c), (None, "x y z"), (None, "x y z")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_row", F.lit("own")).repartition(3)
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(1, a), (5, b), (5, c), (None, c), (None, "x y z")], key=str
    )
