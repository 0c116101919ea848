"""Language-model scores by prediction by partial matching over bytes, beside a unigram base score.

Tokens are the words of the text with A-Z in lower case, then one end.  The model reads a document as the bytes of its
words, each followed by a space, then one end byte, and predicts every byte from up to `ORDER` bytes before it, across
word borders; before a document stand end bytes.

* Training: tasks cut the documents into blocks (`BLOCK_CHARS` of text) and write each block's distinct byte strings of
  length ORDER + 1 with their counts in its training documents.  One shuffle sums them; counts of shorter contexts
  follow from these.  All counts of all orders are used, whatever the size of the corpus.
* Prediction: method C.  A context with total n and u distinct next bytes gives a seen byte c / (n + u) and escapes
  with u / (n + u) to the context without its oldest byte, where the bytes seen before are excluded from both parts;
  below order 0 the bytes never seen share what is left equally.  Scores are pretrained: nothing is learned from the
  document being scored.
* The trie never stands in one place.  The probability of a byte depends on its string alone, so it is found once per
  distinct string: strings whose contexts end in the same two bytes (256^3 at most) meet in one task, with every context
  of order 2 and more they need; orders 0 and 1 are one table of 256 x 256 counts that every task gets.  The
  probabilities go back to the blocks that hold the string: a string meets as many rows as there are such blocks, never
  its occurrences.

The base score needs the training count of every word of every document.  Tasks number the distinct words of a block of
documents and write the block as numbers; counts are summed per word, first in the tasks that read them, and join the words of the blocks
again.  A word that every block holds (the end, say) has one sum and as many rows as there are blocks; no task has to
take them all, as a sum combines on the map side and a join can split them.  One shuffle by block brings them to their
documents; texts are read once.

Nulls and odd rows: a null text is an empty one, a single end; rows with a null id belong to training; rows with
repeated ids are documents of their own; an empty table gives no rows; without training documents the model is uniform
over bytes and no word is known; further columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brassledger.session import shared_folder, staged

ORDER = 4
BLOCK_CHARS = 16 << 20
SLICE = 1 << 21  # bytes whose strings are sorted or looked up at a time
BATCH_ROWS = 1 << 15
BAG_GRAMS = 100_000  # distinct strings in one task of the model, on average
END = b"\n"  # no word holds it

WORD, BLOCK, GRAM = 0, 1, 2
SCHEMA = pa.schema(
    [
        ("block", pa.int64()), ("local", pa.int32()), ("word", pa.binary()), ("gram", pa.int64()), ("n", pa.int64()),
        ("ids", pa.binary()), ("spelled", pa.binary()), ("doc_ids", pa.list_(pa.string())), ("held_out", pa.list_(pa.bool_())),
        ("sizes", pa.list_(pa.int32())), ("kind", pa.int32()),
    ]
)
DDL = "block long, local int, word binary, gram long, n long, ids binary, spelled binary, doc_ids array<string>, held_out array<boolean>, sizes array<int>, kind int"


def words_of(text: str | None) -> list[bytes]:
    """Words of the text; bytes are lowered and split at ASCII letters and blanks only."""
    return (text or "").encode("utf-8", "replace").lower().split()


def spell(words: list[bytes], order: int) -> bytes:
    """A document as the model reads it: after `order` end bytes its words, a space after each, and an end."""
    return b"".join([END * order, b" ".join(words), b" " if words else b"", END])


def _stream(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Documents' bytes one after the other, and where each begins."""
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    return np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum(sizes)])


# ---------------------------------------------------------------- counting
def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, rising, and the sum of each one's counts."""
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _slices(data: np.ndarray, order: int):
    """Strings of length order + 1 by the place of their last byte, which is the low one; the oldest is the highest."""
    for at in range(order, len(data), SLICE):
        end = min(at + SLICE, len(data))
        keys = np.zeros(end - at, np.int64)
        for back in range(order, -1, -1):
            keys = (keys << 8) | data[at - back : end - back]
        yield slice(at, end), keys


def _before(bounds: np.ndarray, order: int) -> np.ndarray:
    """Places of the end bytes that stand before each document; they are not predicted."""
    return (bounds[:-1, None] + np.arange(order)).ravel()


def count(documents: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct strings of spelled documents, rising, and their counts."""
    if not documents:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    data, bounds = _stream(documents)
    counted = np.ones(len(data), bool)
    counted[_before(bounds, order)] = False
    parts = []
    for at, keys in _slices(data, order):
        keys = np.sort(keys[counted[at]])
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        parts.append((keys[first], np.diff(np.append(first, len(keys)))))
    return _summed(*(np.concatenate(x) for x in zip(*parts)))


# ---------------------------------------------------------------- the model
def _longer(c, n, u, log, shorter_c, shorter_n, shorter_u, covered):
    """log10 probabilities in contexts one byte longer.

    c: a byte's count; n, u: total and distinct bytes of its context; log, shorter_c, shorter_n, shorter_u: the same in
    the shorter context; covered: counts there of the bytes seen in the longer one.  An escape takes the probability of
    the shorter context with these bytes excluded: only the share it gave to seen bytes, or to its own escape, changes,
    because whatever it excludes further down contains them.
    """
    log10 = lambda x: np.log10(np.maximum(x, 1))
    left_u = shorter_u - u
    left = log10(shorter_n - covered + left_u)
    seen = log10(shorter_n + shorter_u) - left
    unseen = np.where(left_u > 0, log10(left_u) - left, 0.0) - log10(shorter_u) + log10(shorter_n + shorter_u)
    escaped = log + log10(u) - log10(n + u) + np.where(shorter_c > 0, seen, unseen)
    return np.where(c > 0, log10(c) - log10(n + u), np.where(n > 0, escaped, log))


class LowOrders:
    """Orders 0 and 1: counts of pairs of bytes, and the log10 probability of the second after the first."""

    def __init__(self, pairs: np.ndarray, counts: np.ndarray):
        """pairs: first byte * 256 + second."""
        self.c = np.zeros(1 << 16)
        self.c[pairs] = counts
        c = self.c.reshape(256, 256)
        single = c.sum(0)
        n, u = single.sum(), np.count_nonzero(single)
        if u:
            never = math.log10(u / (n + u)) - math.log10(max(256 - u, 1))
            log = np.where(single > 0, np.log10(np.maximum(single, 1)) - math.log10(n + u), never)
        else:
            log = np.full(256, -math.log10(256))
        seen = c > 0
        own_n, own_u = c.sum(1, keepdims=True), seen.sum(1, keepdims=True)
        self.log = _longer(c, own_n, own_u, log, single, n, u, (seen * single).sum(1, keepdims=True)).ravel()
        self.n, self.u = np.repeat(own_n.ravel(), 256), np.repeat(own_u.ravel(), 256)


def predict(keys: np.ndarray, counts: np.ndarray, order: int, low: LowOrders) -> np.ndarray:
    """log10 probability of the last byte of each string after the others.

    keys: distinct, rising, and with all strings whose contexts end in the same two bytes; counts may be 0.
    """
    tables = [(keys, counts)]
    for k in range(order - 1, 1, -1):
        tables.append(_summed(tables[-1][0] & ((1 << 8 * (k + 1)) - 1), tables[-1][1]))
    if order == 1:
        return low.log[keys]
    held, shorter = low, np.arange(1 << 16)
    for k, (key, c) in enumerate(reversed(tables), 2):
        at = np.searchsorted(shorter, key & ((1 << 8 * k) - 1))
        node = np.unique(key >> 8, return_inverse=True)[1]
        n, u = np.bincount(node, c)[node], np.bincount(node, c > 0)[node]
        covered = np.bincount(node, np.where(c > 0, held.c[at], 0))[node]
        log = _longer(c, n, u, held.log[at], held.c[at], held.n[at], held.u[at], covered)
        held, shorter = SimpleNamespace(c=c, n=n, u=u, log=log), key
    return held.log


def log10_of(documents: list[bytes], order: int, keys: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """Sum of its bytes' log10 probabilities for each spelled document; keys: all their strings."""
    data, bounds = _stream(documents)
    index = pd.Index(keys)
    found = np.zeros(len(data), np.float32)
    for at, some in _slices(data, order):
        found[at] = logs[index.get_indexer(some)]
    found[_before(bounds, order)] = 0
    return np.add.reduceat(found, bounds[:-1], dtype=np.float64)


# ---------------------------------------------------------------- passes
class _Block:
    """Some documents in numbers; words are kept once."""

    def __init__(self, order: int):
        self.order = order
        self.number: defaultdict = defaultdict()
        self.number.default_factory = self.number.__len__
        self.number[END]  # has number 0
        self.ids, self.held, self.numbers, self.size = [], [], [], 0
        self.spelled: dict[bool, list[bytes]] = {False: [], True: []}  # by held out or not, until counted
        self.loose, self.grams = 0, []

    def add(self, doc_id: str | None, text: str | None, held_out: bool) -> None:
        words = words_of(text)
        self.ids.append(doc_id)
        self.held.append(held_out)
        self.numbers.append(np.fromiter(map(self.number.__getitem__, words), np.uint32, len(words)))
        self.spelled[held_out].append(spell(words, self.order))
        self.size += len(text or "")
        self.loose += len(self.spelled[held_out][-1])
        if self.loose >= SLICE:
            self.count()

    def count(self) -> None:
        for held_out, documents in self.spelled.items():
            keys, counts = count(documents, self.order)
            self.grams.append((keys, 0 * counts if held_out else counts))
            documents.clear()
        self.loose = 0

    def take_grams(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct strings of all its documents, and their counts in training documents."""
        self.count()
        return _summed(*(np.concatenate(x) for x in zip(*self.grams)))


def _read_blocks(docs: DataFrame, order: int) -> DataFrame:
    """Rows of three kinds: a block's distinct words, its distinct byte strings, the block in numbers."""

    def rows(kind: int, size: int, **columns):
        """Batches of at most BATCH_ROWS rows; columns not named are null."""
        arrays = []
        for field in SCHEMA:
            if field.name == "kind":
                arrays.append(pa.array(np.full(size, kind, np.int32)))
            elif field.name in columns:
                value = columns[field.name]
                arrays.append(value if isinstance(value, pa.Array) else pa.array(value, field.type))
            else:
                arrays.append(pa.nulls(size, field.type))
        batch = pa.RecordBatch.from_arrays(arrays, schema=SCHEMA)
        return (batch.slice(at, BATCH_ROWS) for at in range(0, size, BATCH_ROWS))

    def run(batches):
        import zstandard

        serial = 0
        first = TaskContext.get().partitionId() << 32

        def close(block):
            nonlocal serial
            n, at = len(block.number), first + serial
            serial += 1
            keys, counts = block.take_grams()
            yield from rows(GRAM, len(keys), block=np.full(len(keys), at), gram=keys, n=counts)
            trained = [x for x, out in zip(block.numbers, block.held) if not out]
            counts = np.bincount(np.concatenate(trained), minlength=n) if trained else np.zeros(n, int)
            counts[0] = len(trained)
            words = list(block.number)
            local = np.arange(n, dtype=np.int32)
            yield from rows(WORD, n, block=np.full(n, at), local=local, word=words, n=counts.astype(np.int64))
            pack = zstandard.ZstdCompressor(level=1).compress
            packed, spelled = pack(np.concatenate(block.numbers).tobytes()), pack(END.join(words[1:]))
            sizes = [[len(x) for x in block.numbers]]
            yield from rows(
                BLOCK, 1, block=[at], ids=[packed], spelled=[spelled], doc_ids=[block.ids], held_out=[block.held], sizes=sizes
            )

        block = _Block(order)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                for doc_id, text, out in zip(*(some.column(c).to_pylist() for c in ("doc_id", "text", "held_out"))):
                    block.add(doc_id, text, out)
                    if block.size >= BLOCK_CHARS:
                        yield from close(block)
                        block = _Block(order)
        if block.ids:
            yield from close(block)

    return docs.mapInArrow(run, DDL)


def score(docs: DataFrame, held_out: Column, order: int = ORDER) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "lm")
    chosen = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    _read_blocks(chosen, order).write.option("compression", "zstd").parquet(f"{folder}/blocks")
    read = lambda kind: spark.read.schema(DDL).parquet(f"{folder}/blocks").filter(F.col("kind") == kind)

    grams = read(GRAM).select("block", "gram", "n")
    totals = staged(grams.groupBy("gram").agg(F.sum("n").alias("n")), "grams", folder)
    pair = F.col("gram").bitwiseAND(F.lit(0xFFFF)).alias("pair")
    pairs = totals.groupBy(pair).agg(F.sum("n").alias("n")).toPandas()  # at most 256 x 256 rows
    low = LowOrders(pairs["pair"].to_numpy(), pairs["n"].to_numpy())

    def judge(table: pa.Table) -> pa.Table:
        keys, counts = (table.column(c).to_numpy() for c in ("gram", "n"))
        keys, counts = _summed(keys, counts)
        return pa.table({"gram": keys, "log": predict(keys, counts, order, low)})

    context_end = F.shiftright("gram", 8).bitwiseAND(F.lit(0xFFFF))
    bag = F.pmod(F.xxhash64(context_end), F.lit(totals.count() // BAG_GRAMS + 1))
    logs = staged(totals.withColumn("bag", bag).groupBy("bag").applyInArrow(judge, "gram long, log double"), "logs", folder)

    words = read(WORD).select("block", "local", "word", "n")
    sums = words.groupBy("word").agg(F.sum("n").cast("double").alias("value"), F.min("block").alias("home"))
    # One narrow row per word or string of a block: words have keys below 0 (-1 - local), and the block that is to count
    # the word as new has its sum as -1 - sum; strings have keys from 0.
    summed = F.when(F.col("block") == F.col("home"), -1 - F.col("value")).otherwise(F.col("value"))
    words = words.join(sums, "word").select("block", (-1 - F.col("local").cast("long")).alias("key"), summed.alias("value"))
    known_grams = grams.join(logs, "gram").select("block", F.col("gram").alias("key"), F.col("log").alias("value"))

    def finish(known: pa.Table, block: pa.Table) -> pa.Table:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        key, value = (known.column(c).to_numpy() for c in ("key", "value"))
        gram = key >= 0
        by = np.flatnonzero(~gram)
        by = by[np.argsort(-1 - key[by])]
        first = value[by] < 0
        total = np.where(first, -1 - value[by], value[by])
        row = block.to_pylist()[0]
        numbers = np.frombuffer(unpack(row["ids"]), np.uint32)
        spelled = [END, *unpack(row["spelled"]).split(END)]
        sizes = np.array(row["sizes"], np.int64)
        ends = np.cumsum(sizes)
        log, met = np.log10(total + 1.0), (total > 0).astype(np.int64)
        running = np.concatenate([[0.0], np.cumsum(log[numbers])]), np.concatenate([[0], np.cumsum(met[numbers])])
        documents = [spell([spelled[i] for i in numbers[a:b].tolist()], order) for a, b in zip(ends - sizes, ends)]
        new = np.zeros(len(sizes), np.int64)
        new[0] = np.count_nonzero((total > 0) & first)
        return pa.table(
            {
                "doc_id": pa.array(row["doc_ids"], pa.string()),
                "held_out": pa.array(row["held_out"], pa.bool_()),
                "n_tokens": sizes + 1,
                "n_known": running[1][ends] - running[1][ends - sizes] + met[0],
                "base": running[0][ends] - running[0][ends - sizes] + log[0],
                "score": log10_of(documents, order, key[gram], value[gram]),
                "new_words": new,
            }
        )

    blocks = read(BLOCK).select("block", "ids", "spelled", "doc_ids", "held_out", "sizes")
    result = "doc_id string, held_out boolean, n_tokens long, n_known long, base double, score double, new_words long"
    scored = words.unionAll(known_grams).groupBy("block").cogroup(blocks.groupBy("block")).applyInArrow(finish, result)
    scored = staged(scored, "scored", folder)
    sums = scored.agg(F.sum(F.when(~F.col("held_out"), F.col("n_tokens"))).alias("n"), F.sum("new_words").alias("v")).first()
    n, v = sums["n"] or 0, sums["v"] or 0
    return scored.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * F.lit(math.log10(n + v + 1))).alias("base_score"),
        "score",
    )
