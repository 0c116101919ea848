"""Best-fit packing of documents into sequences, planned over the histogram of their lengths.

1. Tokenise: a document becomes one piece, or, if longer than a sequence, pieces of which only the first may be
   shorter than a sequence.  Pieces carry lengths and a checksum, not ids.
2. Plan: best-fit decreasing over the histogram.  Sequences with equal contents are planned together, so the plan's
   size depends on the capacity and not on the number of documents.  It is the only thing the driver sees.
3. Place: every piece gets a rank among the pieces of its length, the plan is spread into one slot per rank, and
   both are joined on (length, rank).  A length that a third of all documents share is ranked in lanes.

Nulls and odd rows: a null or empty text is a document of just its end id; rows with repeated or null ids are
documents of their own (their pieces differ in place only); an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brassledger.llm.tokens import batches, encoder
from brassledger.session import staged

PIECES = "doc_id string, piece int, start long, length long, ids_crc32 long"
LANE_ROWS = 50_000  # pieces of one length that one window group ranks
CHUNK = 4096  # slots that one row of the spread plan stands for


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece of a document of n ids."""
    head = n % capacity
    ends = [head] if head else []
    ends += range(head + capacity, n + 1, capacity)
    return [(a, b - a) for a, b in zip([0, *ends], ends)]


def tokenise(docs: DataFrame, path: str, end_id: int, capacity: int) -> DataFrame:
    """One row per piece, with the unsigned crc32 of its ids as little-endian 32-bit integers."""

    def run(frames):
        model = encoder(path)
        end = np.array([end_id], "<u4")
        for frame in frames:
            texts = frame["text"].fillna("").tolist()
            for a, b in batches(texts):
                rows = []
                for doc_id, ids in zip(frame["doc_id"].iloc[a:b], model.encode(texts[a:b])):
                    ids = np.concatenate([np.frombuffer(ids, model.dtype).astype("<u4"), end])
                    for k, (start, n) in enumerate(cut(len(ids), capacity)):
                        rows.append((doc_id, k, start, n, zlib.crc32(ids[start : start + n].tobytes())))
                yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    # Ids pass pandas as text: there, whole numbers beside nulls would become floats.
    chosen = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), "text")
    return chosen.mapInPandas(run, PIECES).withColumn("doc_id", F.col("doc_id").cast("long"))


def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[int, tuple | None]]:
    """(sequences, contents) of best-fit decreasing; contents is a chain (length, offset, contents before).

    Lengths are taken in falling order; each goes to the open sequences with the
    least room that still holds it, all of an equal kind at a time.  New
    sequences are opened only when none has room, so the work follows the number
    of kinds.
    """
    groups: list[list[list]] = [[] for _ in range(capacity + 1)]  # by room: [sequences, chain]
    rooms: list[int] = []  # rooms that have groups, rising

    def add(room: int, n: int, chain) -> None:
        if not groups[room]:
            insort(rooms, room)
        groups[room].append([n, chain])

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                each = capacity // length
                for items, n in ((each, left // each), (left % each, 1)):
                    if items and n:
                        chain = None
                        for i in range(items):
                            chain = (length, i * length, chain)
                        add(capacity - items * length, n, chain)
                break
            room = rooms[at]
            group = groups[room][-1]
            n = min(left, group[0])
            chain = (length, capacity - room, group[1])
            group[0] -= n
            if not group[0]:
                groups[room].pop()
                if not groups[room]:
                    rooms.pop(at)
            add(room - length, n, chain)
            left -= n
    return [(n, chain) for room in groups for n, chain in room]


def plan(histogram: dict[int, int], capacity: int) -> pd.DataFrame:
    """Runs of slots: pieces of `length` with `n` ranks from `rank` on go to as many sequences from `sequence_id` on."""
    rows, rank, first = [], dict.fromkeys(histogram, 0), 0
    for n, chain in best_fit(histogram, capacity):
        while chain:
            length, offset, chain = chain
            rows.append((length, rank[length], n, first, offset))
            rank[length] += n
        first += n
    return pd.DataFrame(rows, columns=["length", "rank", "n", "sequence_id", "offset"], dtype="int64")


def pack(docs: DataFrame, path: str, end_id: int = 0, capacity: int = 2048) -> DataFrame:
    """Pieces with `sequence_id` and `offset`; offsets of a sequence have no gaps."""
    spark = docs.sparkSession
    pieces = staged(tokenise(docs, path, end_id, capacity).withColumn("row", F.monotonically_increasing_id()), "pieces")
    total = pieces.count()
    lanes = total // LANE_ROWS + 1
    # A row's place among equals does not matter; its number, fixed by staging, only splits long runs of one length.
    pieces = pieces.withColumn("lane", F.pmod(F.xxhash64("row"), F.lit(lanes)))
    in_lane = pieces.groupBy("length", "lane").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in in_lane.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    # At most `capacity` rows came back, whatever the number of documents.

    runs = plan(histogram, capacity)
    slots = spark.createDataFrame(runs, "length long, rank long, n long, sequence_id long, offset long")
    slots = slots.withColumn("step", F.explode(F.expr(f"sequence(0L, n - 1, {CHUNK}L)")))
    slots = slots.repartition(total // 250_000 + 8, "length", "rank", "step")
    slots = slots.withColumn("step", F.explode(F.expr(f"sequence(step, least(step + {CHUNK}, n) - 1)")))
    slots = slots.select(
        "length", (F.col("rank") + F.col("step")).alias("rank"), (F.col("sequence_id") + F.col("step")).alias("sequence_id"), "offset"
    )

    before = Window.partitionBy("length").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    base = in_lane.select("length", "lane", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "lane").orderBy("doc_id", "piece", "row")
    ranked = pieces.withColumn("rank", F.row_number().over(within) - 1).join(base, ["length", "lane"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("base"))
    return ranked.join(slots, ["length", "rank"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
