"""A byte-level convolutional classifier of text quality, trained and applied in numpy.

Bytes of the UTF-8 text get learned vectors; learned filters slide over all positions; the text is covered by chunks of
`CHUNK` positions, each reaching `WIDTH - 1` bytes into the next, so no window of bytes is lost at a border.  Every
filter is max-pooled per chunk, the chunks of a document are averaged, and a small hidden layer makes one probability
of them.  Averages over chunks do not depend on the length of a text; the whole of it counts.

Training takes a bounded sample of rows and the whole text of each: per class the `TRAIN_DOCS` labelled documents with
the lowest hash of their id, without texts of more than `TRAIN_TEXT` bytes, up to `TRAIN_BYTES` bytes.  That is all that
reaches the driver.  Where rows share an id, the smallest of their texts stands for it.  Classes weigh the same, so a
score is the probability under equal shares of good and bad.  The same data gives the same weights.

Scoring is a pandas UDF over texts: narrow, in blocks of bounded size.

Nulls and odd rows: a null text is an empty one, and an empty one is scored like any other (a chunk of zero bytes);
without labels of both classes there is nothing to learn, and every score is 1; rows with repeated or null ids are
scored each; an empty table gives no rows; further columns are ignored or, in a filter, kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK, WIDTH = 256, 5
DIM, FILTERS, HIDDEN = 8, 24, 16
TRAIN_DOCS = 1500  # a class
TRAIN_TEXT, TRAIN_BYTES = 1 << 18, 1 << 24  # of one text, of all texts of a class
EPOCHS, BATCH, RATE = 14, 64, 0.01
BLOCK = 64 * CHUNK  # positions convolved at a time
THRESHOLD = 0.3


@dataclass
class Network:
    bytes: np.ndarray  # 256 x DIM
    filters: np.ndarray  # WIDTH * DIM x FILTERS
    bias: np.ndarray
    hidden: np.ndarray  # FILTERS x HIDDEN
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def fresh(cls, rng: np.random.Generator) -> Network:
        def normal(*shape, scale):
            return rng.normal(0, scale, shape).astype(np.float32)

        zero = lambda n: np.zeros(n, np.float32)
        return cls(
            normal(256, DIM, scale=0.5), normal(WIDTH * DIM, FILTERS, scale=(2 / WIDTH / DIM) ** 0.5), zero(FILTERS),
            normal(FILTERS, HIDDEN, scale=FILTERS**-0.5), zero(HIDDEN), normal(HIDDEN, scale=HIDDEN**-0.5), zero(1),
        )

    def parameters(self) -> list[np.ndarray]:
        return [self.bytes, self.filters, self.bias, self.hidden, self.hidden_bias, self.out, self.out_bias]

    def windows(self, data: np.ndarray) -> np.ndarray:
        """Every window of WIDTH bytes as one row of their vectors."""
        vectors = self.bytes[data]
        n = len(data) - WIDTH + 1
        return np.lib.stride_tricks.as_strided(vectors, (n, WIDTH * DIM), (vectors.strides[0], vectors.strides[1]))

    def head(self, pooled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        deep = np.tanh(pooled @ self.hidden + self.hidden_bias)
        return 1 / (1 + np.exp(-(deep @ self.out + self.out_bias[0]))), deep

    def seen(self, data: np.ndarray, blind: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Blocks of (first chunk, chunk x position x filter) over bytes laid out in whole chunks; `blind` positions do not count."""
        chunks = len(data) // CHUNK
        data = np.concatenate([data, np.zeros(WIDTH - 1, np.uint8)])
        edges = np.searchsorted(blind, np.arange(0, chunks * CHUNK + BLOCK, BLOCK))
        for k, at in enumerate(range(0, chunks * CHUNK, BLOCK)):
            end = min(at + BLOCK, chunks * CHUNK)
            seen = np.ascontiguousarray(self.windows(data[at : end + WIDTH - 1])) @ self.filters
            seen[blind[edges[k] : edges[k + 1]] - at] = -np.inf
            yield at // CHUNK, seen.reshape(-1, CHUNK, FILTERS)

    def pool(self, data: np.ndarray, blind: np.ndarray) -> np.ndarray:
        """Max per filter and chunk."""
        out = np.empty((len(data) // CHUNK, FILTERS), np.float32)
        for first, seen in self.seen(data, blind):
            out[first : first + len(seen)] = seen.max(1)
        return np.maximum(out + self.bias, 0)

    def peaks(self, data: np.ndarray, blind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in `data` each filter has its max in each chunk, and that max without bias."""
        at = np.empty((len(data) // CHUNK, FILTERS), np.int64)
        peak = np.empty(at.shape, self.filters.dtype)
        for first, seen in self.seen(data, blind):
            top = seen.argmax(1)
            block = slice(first, first + len(seen))
            at[block] = top + (first + np.arange(len(seen)))[:, None] * CHUNK
            peak[block] = np.take_along_axis(seen, top[:, None, :], 1)[:, 0]
        return at, peak

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Probability of good quality for each whole text."""
        found = np.empty(len(texts))
        for first, last in _ranges(texts):
            data, counts, blind = lay_out([(t or "").encode("utf-8", "replace") for t in texts[first:last]])
            starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
            pooled = np.add.reduceat(self.pool(data, blind), starts, axis=0) / counts[:, None]
            found[first:last] = self.head(pooled)[0]
        return found


def _ranges(texts: list, size: int = 1 << 22):
    start, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text or "") + CHUNK
        if held >= size:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def chunks_of(n: int) -> int:
    """Chunks of a text of n bytes; at least WIDTH - 1 zero bytes follow it."""
    return (n + WIDTH - 1 + CHUNK - 1) // CHUNK


def lay_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts one after the other, each filling whole chunks with zeros; chunks per text; windows that reach the next."""
    counts = np.array([chunks_of(len(t)) for t in texts])
    data = np.frombuffer(b"".join(t.ljust(c * CHUNK, b"\0") for t, c in zip(texts, counts.tolist())), np.uint8)
    ends = np.cumsum(counts) * CHUNK
    return data, counts, (ends[:, None] - np.arange(WIDTH - 1, 0, -1)).ravel()


# ---------------------------------------------------------------- training
def train(texts: list[bytes], labels: np.ndarray, seed: int = 7) -> Network:
    """Adam on the cross-entropy of whole texts; classes weigh the same."""
    rng = np.random.default_rng(seed)
    net = Network.fresh(rng)
    weight = np.where(labels == 1, 0.5 / max((labels == 1).mean(), 1e-9), 0.5 / max((labels == 0).mean(), 1e-9))
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            step += 1
            rate = RATE * (1 - 0.8 * epoch / EPOCHS) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            found = gradients(net, [texts[i] for i in some], labels[some], weight[some])
            for p, g, (m, v) in zip(net.parameters(), found, moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= (rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
    return net


def gradients(net: Network, texts: list[bytes], labels: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    """Of the mean loss over whole texts, whatever their number of chunks."""
    data, counts, blind = lay_out(texts)
    at, peak = net.peaks(data, blind)
    peak = peak + net.bias
    pooled = np.add.reduceat(np.maximum(peak, 0), np.concatenate([[0], np.cumsum(counts)[:-1]]), axis=0) / counts[:, None]
    probability, deep = net.head(pooled)

    d_out = ((probability - labels) * weight / len(texts)).astype(net.out.dtype)
    d_deep = np.outer(d_out, net.out) * (1 - deep * deep)
    d_pooled = d_deep @ net.hidden.T
    d_peak = np.repeat(d_pooled / counts[:, None], counts, axis=0) * (peak > 0)
    d_filters, d_bytes = np.zeros_like(net.filters), np.zeros_like(net.bytes)
    data = np.concatenate([data, np.zeros(WIDTH - 1, np.uint8)])
    for first in range(0, len(at), BLOCK // CHUNK):  # only peaks pass gradients on
        some = d_peak[first : first + BLOCK // CHUNK]
        near = data[at[first : first + len(some), :, None] + np.arange(WIDTH)]  # chunk x filter x byte of the window
        d_filters += np.einsum("cfw,cf->wf", net.bytes[near].reshape(len(some), FILTERS, -1), some)
        d_best = (some[:, :, None] * net.filters.T[None]).reshape(-1, DIM)
        d_bytes += np.stack([np.bincount(near.ravel(), d_best[:, k], 256) for k in range(DIM)], 1).astype(d_bytes.dtype)
    return [d_bytes, d_filters, d_peak.sum(0), pooled.T @ d_deep, d_deep.sum(0), deep.T @ d_out, np.array([d_out.sum()])]


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, quality, text) of the bounded sample.  Ids are chosen among labels alone, so few rows meet the documents."""
    known = labels.filter("quality in (0, 1) and doc_id is not null").select(
        F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("quality")
    )
    hashed = (F.xxhash64("id"), "id")
    known = known.distinct()
    some = [known.filter(F.col("quality") == q).orderBy(*hashed).limit(TRAIN_DOCS) for q in (0, 1)]
    chosen = some[0].unionAll(some[1])  # at most 2 x TRAIN_DOCS rows
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    met = texts.filter(F.octet_length("text") <= TRAIN_TEXT).join(F.broadcast(chosen), "id")
    one = met.groupBy("id", "quality").agg(F.min("text").alias("text"))
    so_far = F.sum(F.octet_length("text")).over(Window.partitionBy("quality").orderBy(*hashed))
    return one.withColumn("_so_far", so_far).filter(F.col("_so_far") <= TRAIN_BYTES).drop("_so_far")


def fit(docs: DataFrame, labels: DataFrame) -> Network | None:
    rows = training_rows(docs, labels).toPandas().sort_values(["id", "quality"])  # at most TRAIN_BYTES a class
    if rows["quality"].nunique() < 2:
        return None
    return train([t.encode("utf-8", "replace") for t in rows["text"]], rows["quality"].to_numpy())


def quality(net: Network | None, text: Column) -> Column:
    """The score of a text as an expression, from 0 to 1."""
    if net is None:
        return F.lit(1.0)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(net.score(texts.tolist()))

    return score(text)
