"""Near-duplicate documents by SimHash, found around anchor points of a covering code.

A fingerprint has 64 bits, one vote of every shingle's XXH64 per bit.  Two fingerprints link if they differ in at most
`distance` bits.  To find all links without comparing all pairs:

1. Bits are cut into `parts`.  Two linked fingerprints differ in at most ``distance // parts`` bits of some part.
2. The anchors of a part are the words of a covering code: the product of perfect Hamming (7, 4) codes over runs of
   seven bits (covering radius 1 each); bits left over are taken as they are.  A fingerprint's home is its nearest
   anchor.  It is copied to every anchor that can be the home of a fingerprint within the part's threshold; such an
   anchor lies within covering radius plus threshold, and of those only the ones that some flip of that many bits
   really leads to are taken.  So linked fingerprints meet at the home of one of them, and no link is lost.
3. Fingerprints are compared per anchor, every pair's distance in whole.

Equal fingerprints are one row before any of this, so copies cost nothing.  An anchor with very many fingerprints is
split into blocks, each two of which meet in a task of bounded size.  A task returns a forest of the links it found.

More parts mean fewer copies and larger groups; `parts` follows the number of fingerprints, and every choice is exact.

Nulls and odd rows: a null text is an empty one, of fingerprint zero, and links like any other; rows with null ids get
a fingerprint and join components without naming them (null where no id is known); repeated rows are kept, one result
row per row; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brassledger.llm.graph import connected, forest, spread_hot_groups, tile_edges
from brassledger.session import staged

SEED = 42
BLOCK_ROWS = 8192  # fingerprints of one side of a comparing task
TILE = 512


# ---------------------------------------------------------------- fingerprints
def fingerprint(text: str | None, words: int = 4) -> int:
    """Unsigned 64-bit SimHash of the word shingles of a text, repeats included."""
    import xxhash

    tokens = (text or "").encode().lower().split()  # of bytes: A-Z and the ASCII blanks only
    if not tokens:
        return 0
    if len(tokens) <= words:
        return xxhash.xxh64_intdigest(b" ".join(tokens), SEED)
    flat = b" ".join(tokens)
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1
    ends = np.cumsum(sizes)
    starts = (ends - sizes)[: len(tokens) - words + 1].tolist()
    ends = (ends - 1)[words - 1 :].tolist()
    h, seed = xxhash.xxh64_intdigest, SEED
    votes = np.zeros(64, np.int64)
    for a in range(0, len(starts), 1 << 16):
        some = zip(starts[a : a + (1 << 16)], ends[a : a + (1 << 16)])
        hashes = np.array([h(flat[i:j], seed) for i, j in some], "<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << b for b in np.flatnonzero(2 * votes > len(starts)).tolist())


def fingerprints(docs: DataFrame, words: int = 4, row: str | None = None) -> DataFrame:
    """(doc_id long, fp long) per row, and its number if a column `row` is named; fp holds the bits as a signed number."""
    numbers = [row] if row else []

    def run(frames):
        for frame in frames:
            bits = np.array([fingerprint(t, words) for t in frame["text"]], np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": frame["doc_id"], "fp": bits, **{c: frame[c] for c in numbers}})

    # Ids pass pandas as text: there, whole numbers beside nulls would become floats.
    chosen = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), "text", *numbers)
    found = chosen.mapInPandas(run, ", ".join(["doc_id string, fp long", *[f"{c} long" for c in numbers]]))
    return found.select(F.col("doc_id").cast("long").alias("doc_id"), "fp", *numbers)


# ---------------------------------------------------------------- anchors
def _nearest_codewords() -> np.ndarray:
    """For each 7-bit word the codeword of the Hamming code within one bit: flip the bit its syndrome names."""
    word = np.arange(128)
    bits = (word[:, None] >> np.arange(7)) & 1
    syndrome = np.bitwise_xor.reduce(bits * np.arange(1, 8), axis=1)
    return np.where(syndrome > 0, word ^ (1 << np.maximum(syndrome - 1, 0)), word)


NEAREST = _nearest_codewords()


def layout(parts: int) -> list[tuple[int, int]]:
    """(first bit, bits) of each part."""
    ends = [64 * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(ends, ends[1:])]


def home(part: np.ndarray, bits: int) -> np.ndarray:
    """The nearest anchor of each part (unsigned numbers of `bits` bits)."""
    anchor = np.zeros_like(part)
    for at in range(0, bits, 7):
        run = (part >> np.uint64(at)) & np.uint64((1 << min(7, bits - at)) - 1)
        anchor |= (NEAREST[run].astype(np.uint64) if bits - at >= 7 else run) << np.uint64(at)
    return anchor


def anchors(fp: np.ndarray, parts: int, distance: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the fingerprint, anchor, whether it is its home).

    Of two anchors that would both see a pair, the lower is enough: a
    fingerprint goes only to anchors up to its own home.
    """
    rows, keys, homes = [], [], []
    index = np.arange(len(fp))
    for k, (first, bits) in enumerate(layout(parts)):
        part = (fp >> np.uint64(first)) & np.uint64((1 << bits) - 1)
        own = home(part, bits)
        found = [own]
        for flips in range(1, distance // parts + 1):
            for some in combinations(range(bits), flips):
                found.append(home(part ^ np.uint64(sum(1 << b for b in some)), bits))
        near = np.sort(np.stack(found, 1), axis=1)
        fresh = np.ones(near.shape, bool)
        fresh[:, 1:] = near[:, 1:] != near[:, :-1]
        r, c = np.nonzero(fresh & (near <= own[:, None]))
        rows.append(index[r])
        keys.append((near[r, c] | np.uint64(k << 56)).astype(np.int64))
        homes.append(near[r, c] == own[r])
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(homes)


def parts_for(n: int, distance: int) -> int:
    """Parts by the number of fingerprints: few anchors and few copies for few rows, many of both for many rows."""
    return 3 if n <= 20_000_000 or distance < 2 else 2


# ---------------------------------------------------------------- links
def _compare(fp: np.ndarray, is_home: np.ndarray, own: np.ndarray, bi: int, bj: int, distance: int):
    """Edges that join what is linked among the fingerprints of one anchor (or of two of its blocks)."""
    if bi == bj:
        sides = [(np.flatnonzero(is_home), np.arange(len(fp)))]
    else:
        left, right = own == bi, own == bj
        sides = [
            (np.flatnonzero(left & is_home), np.flatnonzero(right)),
            (np.flatnonzero(right & is_home), np.flatnonzero(left & ~is_home)),
        ]
    for rows, columns in sides:
        for at in range(0, len(rows), TILE):
            some = rows[at : at + TILE]
            mask = np.bitwise_count(fp[some][:, None] ^ fp[columns][None, :]) <= distance
            yield tile_edges(mask, some, columns)


def links(nodes: DataFrame, n: int, distance: int, parts: int) -> DataFrame:
    """(a, b) joining what is linked among n distinct fingerprints `fp`: not every link, but all that connect."""
    bags = n // 2_000 + 64  # anchors are dealt into bags, so that a task compares many small ones

    def spread(frames):
        for frame in frames:
            fp = frame["fp"].to_numpy(np.int64).view(np.uint64)
            step = 20_000 if distance // parts < 2 else 1_000
            for at in range(0, len(fp), step):
                row, key, is_home = anchors(fp[at : at + step], parts, distance)
                yield pd.DataFrame({"anchor": key, "fp": fp[at : at + step][row].view(np.int64), "home": is_home})

    def compare(key, frame):
        frame = frame.sort_values("anchor")
        fp, own = frame["fp"].to_numpy(np.int64).view(np.uint64), frame["own"].to_numpy(np.int64)
        is_home, anchor = frame["home"].to_numpy(bool), frame["anchor"].to_numpy()
        cuts = [0, *(np.flatnonzero(anchor[1:] != anchor[:-1]) + 1).tolist(), len(fp)]
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, j in zip(cuts, cuts[1:]):
            if j - i > 1:
                for x, y in _compare(fp[i:j], is_home[i:j], own[i:j], key[1], key[2], distance):
                    a.append(x + i)
                    b.append(y + i)
        number, place = np.unique(fp, return_inverse=True)  # one fingerprint can stand at several anchors
        root = forest(len(number), place[np.concatenate(a)], place[np.concatenate(b)])
        node = np.flatnonzero(root != np.arange(len(number)))
        return pd.DataFrame({"a": number[node].view(np.int64), "b": number[root[node]].view(np.int64)})

    rows = nodes.select("fp").mapInPandas(spread, "anchor long, fp long, home boolean")
    tasks = spread_hot_groups(rows, ["anchor"], "fp", BLOCK_ROWS)
    tasks = tasks.withColumn("bag", F.pmod(F.xxhash64("anchor"), F.lit(bags)))
    return tasks.groupBy("bag", "bi", "bj").applyInPandas(compare, "a long, b long")


def _rooted(nodes: DataFrame, distance: int) -> DataFrame:
    """Distinct fingerprints `fp` with the `root` of their component."""
    n = nodes.count()
    roots = connected(links(nodes, n, distance, parts_for(n, distance)))
    roots = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    return staged(roots.withColumn("root", F.coalesce("root", "fp")), "fingerprint-roots")


def components(docs: DataFrame, distance: int = 4, words: int = 4) -> DataFrame:
    """Per document row: doc_id, fp, component_id (the smallest id reachable over links, itself included)."""
    prints = staged(fingerprints(docs, words), "fingerprints")
    nodes = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = _rooted(nodes, distance)
    least = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    named = roots.join(least, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, distance: int = 4, words: int = 4) -> DataFrame:
    """Of each component the row of the smallest id, in its own columns; decided by row, never by id.

    Rows are numbered as they are staged: of rows that share an id only those
    of one component compete, and the first of them stays.  Rows without an id
    compete among themselves, so of each component one of them stays, too.
    """
    row = "_row"
    while row in docs.columns:
        row += "_"
    docs = staged(docs.withColumn(row, F.monotonically_increasing_id()), "numbered-documents")
    prints = staged(fingerprints(docs, words, row), "fingerprints")
    first = F.min(F.struct("doc_id", row)).alias("first")
    own = staged(prints.groupBy("fp", F.isnull("doc_id").alias("unnamed")).agg(first), "first-rows")
    nodes = staged(own.select("fp").distinct(), "distinct-fingerprints")
    firsts = own.join(_rooted(nodes, distance), "fp").groupBy("root", "unnamed").agg(F.min("first").alias("first"))
    gone = prints.select(row).join(firsts.select(F.col("first")[row].alias(row)), row, "left_anti")
    return docs.join(staged(gone, "gone-rows"), row, "left_anti").drop(row)
