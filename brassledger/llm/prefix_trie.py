"""Conversations that share first turns, as a trie, with totals of subtrees by time-forward processing.

The d-th node of a conversation is its sequence of first d turns.  A node's key is its depth and the XOR of 120-bit
digests of (position, role, text) over these turns, so keys of all prefixes come from a running XOR: it is taken within
blocks of a range partitioning and carried over from block to block, no conversation is gathered in a row or a task.

Totals flow from the leaves to the root.  Nodes are sorted in reverse level order, deepest first (by Spark's sort, which
spills); each adds up the messages addressed to it and sends its own total to its parent through a priority queue that
spills sorted runs (`Messages`).  As a parent comes later in that order, its message is always there in time.

Conversations are dealt to shards in the order of their first turns, so a shard holds neighbouring branches, and almost
all nodes have all their members in one shard; their totals are complete there.  Nodes with members in several shards
(the shard roots and what is above them) wait: FAN neighbouring shards form a shard of the next level, and a node is
handled at the first level where one shard holds it.  Messages between levels are tables, added up for each receiver
before they are sent on.  The last level has one shard, with what is above the coarsest shard roots only.

What one task must see in order is a shard, as a stream, and, for `ends_sha256`, the ids that end in one node, also as
a stream: a digest over a sorted list has no other order.

Nulls and odd rows: null turns come first; null roles and texts are empty; turns with the same number are ordered by
role, then by a digest of the text (equal ones are interchangeable); repeated rows are turns of their own; rows without
a conversation id belong to no conversation and are left out; an empty table gives no rows, also no root; further
columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brassledger.session import staged

SHARE_OF, SHARED_TURNS = 5, 9  # conversation c takes up to crc32(c) % 9 turns of conversation c - c % 5
BLOCK_ROWS = 500_000
SHARD_CONVERSATIONS = 200_000
FAN = 64  # shards of one level that form a shard of the next
QUEUE_ROWS = 200_000  # messages held in memory by a task before a run goes to its disk
HOT_CHILDREN = 10_000  # parents beyond it are looked up apart, so that their children do not meet
ORDER_TURNS = 8  # turns that decide which conversations are neighbours
KEY = ["depth", "x", "y"]


# ---------------------------------------------------------------- rebuilt conversations
def _shared(conv: Column) -> Column:
    return F.crc32(conv.cast("string")) % SHARED_TURNS


def _tasks(rows: DataFrame, each: int) -> int:
    """Parts of about `each` rows, but not fewer than a shuffle has."""
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows.count() / each))


def _number(rows: DataFrame) -> DataFrame:
    """Turns of a conversation numbered from 1, in blocks: (conv, position, block, digest, bytes).

    One range partitioning on (conv, turn, ...) puts the parts of a long conversation into neighbouring blocks; numbers
    start in a block where the blocks before it end.
    """
    thin = rows.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    digest = F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(" "), F.col("role"), F.col("text")), 256)
    thin = thin.select("conv", "turn", "role", digest.alias("digest"), F.octet_length("text").cast("long").alias("bytes"))
    spread = thin.withColumn("salt", F.monotonically_increasing_id())  # only tells equal rows apart
    blocks = _tasks(thin, BLOCK_ROWS)
    ranged = spread.repartitionByRange(blocks, "conv", F.asc_nulls_first("turn"), "role", "digest", "salt")
    ranged = ranged.withColumn("block", F.spark_partition_id())
    rows = staged(ranged, "turns")
    here = Window.partitionBy("conv", "block").orderBy(F.asc_nulls_first("turn"), "role", "digest", "salt")
    sizes = rows.groupBy("conv", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("conv", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    numbered = rows.withColumn("rank", F.row_number().over(here)).join(sizes, ["conv", "block"])
    return numbered.select("conv", (F.col("start") + F.col("rank")).alias("position"), "block", "digest", "bytes")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, position, block, digest, bytes) of all rebuilt turns, and (conv, turns) of all rebuilt conversations."""
    turns = staged(_number(conversations), "numbered")
    sizes = turns.groupBy("conv").agg(F.max("position").alias("own"))
    convs = sizes.withColumn("shared", _shared(F.col("conv"))).withColumn("base", F.col("conv") - F.col("conv") % SHARE_OF)
    bases = sizes.select(F.col("conv").alias("base"), F.col("own").alias("base_turns"))
    convs = convs.join(bases, "base", "left").withColumn("taken", F.least("shared", F.coalesce("base_turns", F.lit(0))))
    convs = convs.withColumn("turns", F.col("taken") + F.greatest(F.col("own") - F.col("shared"), F.lit(0)))
    convs = staged(convs.select("conv", "base", "shared", "taken", "turns"), "conversations")
    own = turns.join(convs, "conv").filter("position > shared")
    own = own.select("conv", (F.col("position") - F.col("shared") + F.col("taken")).alias("position"), "block", "digest", "bytes")
    first = turns.filter(F.col("position") < SHARED_TURNS).withColumnRenamed("conv", "base")
    lent = first.join(convs, "base").filter("position <= shared")
    lent = lent.select("conv", "position", F.lit(-1).alias("block"), "digest", "bytes")
    return own.unionAll(lent), convs.select("conv", "turns")


def _words(digest: Column, *starts: int) -> list[Column]:
    """Longs from the hex digits of a digest."""
    return [F.conv(F.substring(digest, s, 15), 16, 10).cast("long") for s in starts]


def prefixes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Per conversation and depth, 0 included: conv, the key (depth, x, y), the parent's px, py, bytes, and `turns`."""
    placed = F.sha2(F.concat(F.col("position").cast("string"), F.lit(" "), F.col("digest")), 256)
    u, v = _words(placed, 1, 17)
    rows = turns.select("conv", "position", "block", u.alias("u"), v.alias("v"), "bytes")
    rows = staged(rows, "digests")
    sums = rows.groupBy("conv", "block").agg(F.bit_xor("u").alias("bu"), F.bit_xor("v").alias("bv"))
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(
        "conv", "block", *[F.coalesce(F.bit_xor(b).over(before), F.lit(0)).alias(c) for b, c in (("bu", "cu"), ("bv", "cv"))]
    )
    here = Window.partitionBy("conv", "block").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    running = rows.withColumn("x", F.bit_xor("u").over(here)).withColumn("y", F.bit_xor("v").over(here))
    running = running.join(carried, ["conv", "block"]).join(convs, "conv")
    x, y = F.col("x").bitwiseXOR(F.col("cu")), F.col("y").bitwiseXOR(F.col("cv"))
    nodes = running.select(
        "conv", F.col("position").cast("long").alias("depth"), x.alias("x"), y.alias("y"),
        x.bitwiseXOR(F.col("u")).alias("px"), y.bitwiseXOR(F.col("v")).alias("py"), "bytes", "turns",
    )
    zero = F.lit(0).cast("long")
    none = F.lit(None).cast("long")
    roots = convs.select("conv", zero.alias("depth"), zero.alias("x"), zero.alias("y"), none.alias("px"), none.alias("py"), zero.alias("bytes"), "turns")
    return nodes.unionAll(roots)


# ---------------------------------------------------------------- inside a task
class Messages:
    """A priority queue of (place, leaves, saved) that keeps at most `room` of them in memory.

    What is more goes as a sorted run into a file of the task's own, as Spark's sort spills; runs are merged on reading.
    """

    def __init__(self, room: int = QUEUE_ROWS):
        self._room, self._heap = room, []
        self._runs: list = []  # [next message, file]

    def push(self, place: tuple, leaves: int, saved: int) -> None:
        heapq.heappush(self._heap, (place, leaves, saved))
        if len(self._heap) > self._room:
            self._spill()

    def _spill(self) -> None:
        file = tempfile.TemporaryFile()  # gone with the task  # noqa: SIM115
        for message in sorted(self._heap):
            pickle.dump(message, file, pickle.HIGHEST_PROTOCOL)
        self._heap = []
        file.seek(0)
        heapq.heappush(self._runs, (pickle.load(file), len(self._runs), file))
        if len(self._runs) > FAN:
            self._merge()

    def _merge(self) -> None:
        """All runs into one, so that a task keeps few files open."""
        file = tempfile.TemporaryFile()  # noqa: SIM115
        while self._runs:
            pickle.dump(self._next_of_runs(), file, pickle.HIGHEST_PROTOCOL)
        file.seek(0)
        self._runs = [(pickle.load(file), 0, file)]

    def _next_of_runs(self) -> tuple:
        message, number, file = heapq.heappop(self._runs)
        try:
            heapq.heappush(self._runs, (pickle.load(file), number, file))
        except EOFError:
            file.close()
        return message

    def take(self, place: tuple) -> tuple[int, int]:
        """The sum of all messages to a place; none may be left for an earlier one."""
        leaves = saved = 0
        while self._heap or self._runs:
            from_run = bool(self._runs) and (not self._heap or self._runs[0][0] < self._heap[0])
            first = self._runs[0][0] if from_run else self._heap[0]
            if first[0] > place:
                break
            if first[0] < place:
                raise RuntimeError("a message missed its receiver")
            _, a, b = self._next_of_runs() if from_run else heapq.heappop(self._heap)
            leaves, saved = leaves + a, saved + b
        return leaves, saved

    def empty(self) -> bool:
        return not (self._heap or self._runs)


def time_forward(nodes: Iterator[tuple], room: int = QUEUE_ROWS) -> Iterator[tuple]:
    """Totals of nodes that come in reverse level order.

    A node is (shard, depth, x, y, px, py, local parent, leaves, saved), where leaves and saved are its own
    and what messages of lower levels brought.  Out come (depth, x, y, leaves, saved, px, py, whether its parent is of
    a higher level).
    """
    queue, shard = Messages(room), None
    for of, depth, x, y, px, py, local, leaves, saved in nodes:
        if of != shard:
            if not queue.empty():
                raise RuntimeError("a message missed its receiver")
            shard = of
        a, b = queue.take((-depth, x, y))
        leaves, saved = leaves + a, saved + b
        if local:
            queue.push((1 - depth, px, py), leaves, saved)
        yield depth, x, y, leaves, saved, px, py, not local and depth > 0
    if not queue.empty():
        raise RuntimeError("a message missed its receiver")


def _totals(batches):
    def rows():
        for batch in batches:
            yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)

    names = ["depth", "x", "y", "n_leaves", "saved_tokens", "px", "py", "outward"]
    kinds = [pa.int64()] * 7 + [pa.bool_()]
    done: list = []
    for row in time_forward(rows()):
        done.append(row)
        if len(done) == 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names=names)
            done = []
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names=names)


def _digests(batches):
    """Rows sorted by (depth, x, y, conv): one digest per node, streamed."""
    names, kinds = [*KEY, "ends_sha256"], [pa.int64()] * 3 + [pa.string()]
    key = digest = None
    done: list = []
    for batch in batches:
        for *at, conv in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if at != key:
                if key:
                    done.append((*key, digest.hexdigest()))
                key, digest = at, hashlib.sha256(b"%d" % conv)
            else:
                digest.update(b",%d" % conv)
        if len(done) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names=names)
            done = []
    if key:
        done.append((*key, digest.hexdigest()))
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names=names)


# ---------------------------------------------------------------- over the cluster
def _shards(members: DataFrame, count: int) -> DataFrame:
    """(conv, shard): conversations in the order of their first turns, cut into `count` neighbourhoods."""
    at = [F.max(F.when(F.col("depth") == d, F.col("x"))).alias(f"t{d}") for d in range(1, ORDER_TURNS + 1)]
    firsts = members.filter(F.col("depth") <= ORDER_TURNS).groupBy("conv").agg(*at)
    order = [F.col(f"t{d}") for d in range(1, ORDER_TURNS + 1)]
    return firsts.repartitionByRange(count, *order, "conv").select("conv", F.spark_partition_id().alias("shard"))


def _level(low: Column, high: Column, levels: int) -> Column:
    """The first level at which one shard holds both ends of a range of shards."""
    found = F.lit(levels)
    for level in reversed(range(levels)):
        found = F.when(F.floor(low / FAN**level) == F.floor(high / FAN**level), F.lit(level)).otherwise(found)
    return found


def trie(conversations: DataFrame, shard_conversations: int = SHARD_CONVERSATIONS) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns, convs = rebuilt(conversations)
    members = staged(prefixes(turns, convs), "members")
    count = _tasks(convs, shard_conversations)
    levels = 1 + math.ceil(math.log(count, FAN))
    dealt = staged(_shards(members, count), "shards")

    nodes = members.join(dealt, "conv").groupBy(*KEY).agg(
        F.min("conv").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.min("px").alias("px"),
        F.min("py").alias("py"),
        F.min("bytes").alias("bytes"),
        F.min("shard").alias("low"),
        F.max("shard").alias("high"),
    )
    nodes = staged(nodes.withColumn("level", _level(F.col("low"), F.col("high"), levels)), "nodes")

    # Of a parent its children need the level and the smallest member; it needs their number.
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y"))
    parents = staged(nodes.join(children.agg(F.count(F.lit(1)).alias("n_children")), KEY), "parents")
    nodes = staged(_with_parent(nodes, parents), "tree")

    messages = None
    for level in range(levels):
        here = nodes.filter(F.col("level") == level)
        own = here.select(*KEY, "px", "py", "low", (F.coalesce("parent_level", F.lit(-1)) == level).alias("local"),
                          F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves"),
                          ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
        if messages is not None:
            own = own.join(messages, KEY, "left")
            own = own.withColumn("leaves", F.col("leaves") + F.coalesce("more_leaves", F.lit(0)))
            own = own.withColumn("saved", F.col("saved") + F.coalesce("more_saved", F.lit(0)))
        shard = F.floor(F.col("low") / FAN**level).cast("long").alias("shard")
        stream = own.select(shard, *KEY, "px", "py", "local", "leaves", "saved")
        stream = stream.repartition("shard").sortWithinPartitions("shard", F.desc("depth"), "x", "y")
        schema = "depth long, x long, y long, n_leaves long, saved_tokens long, px long, py long, outward boolean"
        done = staged(stream.mapInArrow(_totals, schema), f"totals-{level}")
        found = done if level == 0 else found.unionAll(done)
        sent = found.filter("outward").groupBy((F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y"))
        messages = sent.agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved"))

    ending = members.filter("depth = turns").select(*KEY, "conv")
    ends = ending.repartition(*KEY).sortWithinPartitions(*KEY, "conv").mapInArrow(_digests, "depth long, x long, y long, ends_sha256 string")
    result = nodes.join(found.select(*KEY, "n_leaves", "saved_tokens"), KEY).join(ends, KEY, "left")
    return result.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def _with_parent(nodes: DataFrame, parents: DataFrame) -> DataFrame:
    """Nodes with n_children, parent_level and parent_conv_id.

    Children of one parent would meet at its key.  Parents with many children are few (at most one in HOT_CHILDREN
    nodes), so they are looked up first, and only the other children are sent to their parents.
    """
    above = parents.select(
        (F.col("depth") + 1).alias("depth"), F.col("x").alias("px"), F.col("y").alias("py"),
        F.col("level").alias("parent_level"), F.col("conv_id").alias("parent_conv_id"), "n_children",
    )
    up = ["depth", "px", "py"]
    counted = nodes.join(parents.select(*KEY, "n_children"), KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    hot = above.filter(F.col("n_children") > HOT_CHILDREN).drop("n_children")
    first = staged(counted.join(hot, up, "left"), "below-hot")
    rest = first.filter("parent_level IS NULL").drop("parent_level", "parent_conv_id")
    rest = rest.join(above.filter(F.col("n_children") <= HOT_CHILDREN).drop("n_children"), up, "left")
    return first.filter("parent_level IS NOT NULL").unionByName(rest)
