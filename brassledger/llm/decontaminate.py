"""Documents that hold benchmark items, also edited ones: CGK embedding, bit sampling, exact edit distance.

Texts are words: lower case, ASCII punctuation and blanks between them.  A document is contaminated by an item of n
words if some window of it is within ``floor(edits * n)`` word edits (insert, delete, replace) of the whole item.

For each length of items (rare words are looked up for classes of lengths):

1. Rare words.  If k edits are allowed, r of the k + r rarest words of an item must stand in a window within reach.
   So only places are looked at where r rare words of the class stand close enough, and where n - k of the words in
   reach are words of the class at all.  This loses nothing.
2. Pieces.  An item is cut into k // 2 + 1 pieces of five to ten words (one piece where k < 2).  Of k edits at least
   one piece has at most one, so every item within reach has a piece that is nearly whole.
3. CGK embedding.  A random walk reads the words of a window of a piece's size: each step writes the word it stands on
   and moves on or stays by a random bit of (step, word).  The same walk over an edited text falls back into step soon
   after an edit, so a small edit distance becomes a small Hamming distance between what is written.
4. Bit sampling.  A key of `SAMPLED` random steps is equal for window and piece with a probability that falls with
   their Hamming distance; independent walks and keys, as many as `repeats_for` measures to be needed for the size,
   bring the recall to its target.  Exact copies have equal keys always.  A bucket names the item and the place of the
   piece in it, so a window found there says where the whole item would begin.
5. Verification.  The whole item is compared by the exact edit distance with all windows that begin about there, so
   nothing false is reported, and nothing is reported that no bucket named.

All this is one narrow pass over the documents; nothing is shuffled, so passages that many documents share do no harm.
The items go to the tasks in shards of bounded size.  Driver and tasks hold one shard at a time: with more than one,
the result of each pass is written before the next shard is read.

Words are lower case; ASCII punctuation and blanks stand between them, and each character of scripts without blanks is
a word.  An item of fewer than five words allows no edit, so its exact copies are found; `min_words` leaves out items
too short to prove anything.

Nulls and odd rows: null and empty texts hold nothing, and items without words are not searched; rows with repeated or
null ids are judged each; equal items are all reported; an empty table or benchmark gives no rows; further columns are
ignored.
"""

from __future__ import annotations

import re
import string
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brassledger.session import staged

EDITS = 0.2  # edits allowed per word of an item
MIN_WORDS = 1
SAMPLED = 2
RECALL = 0.999
TRIALS, TRIED_WALKS, MOST_WALKS = 300, 128, 64
CELLS = 1 << 18  # of edit distances held at a time
SHARD_WORDS = 1_000_000  # of the benchmark, in one pass over the documents
_BLANKED = bytes(32 if chr(b) in string.punctuation or b < 32 else b for b in range(256))
_SEED = 20_240_607


#: Scripts that write no blanks between words (Thai to Myanmar, Khmer, kana, Han).
_UNSPACED = re.compile("([\u0e00-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff])")


def words_of(text: str | None) -> list[bytes]:
    text = (text or "").lower()
    if not text.isascii() and _UNSPACED.search(text):
        text = _UNSPACED.sub(r" \1 ", text)
    return text.encode("utf-8", "replace").translate(_BLANKED).split()


@lru_cache(maxsize=None)
def repeats_for(recall: float, size: int, sampled: int = SAMPLED) -> int:
    """Walks needed so that a piece with one edit is met, from match rates measured for each kind of edit.

    Pieces differ in how often walks fall back into step after their edit, so the chance to miss is averaged over
    pieces and not taken from an average rate.
    """
    rng = np.random.default_rng(size)
    needed = 1
    for kind in range(3):  # replace, insert, delete
        pieces, texts = rng.integers(1, 1 << 40, (TRIALS, size)), []
        for piece in pieces.tolist():
            at, word = int(rng.integers(0, size)), int(rng.integers(1, 1 << 40))
            fresh = piece[:at] + [[word], [word, piece[at]], []][kind] + piece[at + 1 :]
            around = rng.integers(1, 1 << 40, size + 3).tolist()
            texts.append([around[0], *fresh, *around[1:]][: 2 * size + 2])
        walks = Walks(rng, list(pieces), list(range(TRIALS)), TRIED_WALKS, sampled)
        flat, width = np.array(texts).ravel(), 2 * size + 2
        own = walks.keys(pieces.ravel(), np.arange(TRIALS) * size, (np.arange(TRIALS) + 1) * size)
        met = np.zeros(own.shape, bool)
        for shift in (0, 1, 2):  # every place is looked at, also the one before or after
            first = np.arange(TRIALS) * width + shift
            met |= own == walks.keys(flat, first, first + size)
        miss = 1 - met.mean(0)
        while needed < MOST_WALKS and (miss**needed).mean() > 1 - recall:
            needed += 1
    return needed


def within(item: np.ndarray, window: np.ndarray, most: int) -> int | None:
    """Least number of edits from the item to a prefix of the window, if at most `most`."""
    steps = np.arange(len(window) + 1)
    row = steps.copy()
    for i, word in enumerate(item, 1):
        fresh = np.empty_like(row)
        fresh[0] = i
        fresh[1:] = np.minimum(row[1:] + 1, row[:-1] + (window != word))
        row = np.minimum.accumulate(fresh - steps) + steps
        if row.min() > most:
            return None
    least = int(row.min())
    return least if least <= most else None


class LengthClass:
    """Items of about one length: which words are theirs, which of them rare, and their pieces."""

    def __init__(self, low: int, words: int):
        self.low, self.reach = low, low  # reach: words of the longest window within the edits
        self.needed = max(1, low // 4)
        self.words, self.rare = np.zeros(words, bool), np.zeros(words, bool)
        self.lengths: list[Pieces] = []

    def starts(self, words: np.ndarray) -> np.ndarray:
        """Places where a window can begin: with a word of an item, and with enough rare ones in reach."""
        at = np.flatnonzero(self.rare[words])
        if len(at) < self.needed:
            return at[:0]
        first, last = at[: len(at) - self.needed + 1], at[self.needed - 1 :]
        low = np.maximum(last - self.reach + 1, 0)
        fits = low <= first
        low, size = low[fits], (first - low)[fits] + 1
        places = np.repeat(low - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        places = np.unique(places)
        return places[self.words[words[places]]]


class Walks:
    """Walks of 2n steps for pieces of n words, which read about n words, and the pieces' keys under them."""

    def __init__(self, rng, pieces: list[np.ndarray], labels: list[int], repeats: int, sampled: int = SAMPLED):
        self.n = len(pieces[0])
        steps = 2 * self.n
        self.coins = rng.integers(1, 1 << 62, (steps, repeats, 1), dtype=np.int64).astype(np.uint64) | np.uint64(1)
        self.sampled = np.zeros((steps, repeats), bool)
        for r in range(repeats):
            self.sampled[rng.choice(steps, sampled, replace=False), r] = True
        starts = np.arange(len(pieces)) * self.n
        keys = self.keys(np.concatenate(pieces), starts, starts + self.n)
        self.buckets = []  # per walk: rising keys, and the pieces of each
        for row in keys:
            order = np.argsort(row, kind="stable")
            self.buckets.append((row[order], np.array(labels)[order]))

    def keys(self, words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Per walk and window a hash of the words written at the sampled steps (0 past the end)."""
        at = np.repeat(starts[None], self.coins.shape[1], axis=0)
        key = np.zeros(at.shape, np.uint64)
        for step in range(int(np.flatnonzero(self.sampled.any(1))[-1]) + 1):
            word = np.where(at < ends, words[np.minimum(at, len(words) - 1)], 0).astype(np.uint64)
            wanted = self.sampled[step]
            if wanted.any():
                mixed = (key[wanted] ^ word[wanted]) * np.uint64(0x9E3779B97F4A7C15)
                key[wanted] = mixed ^ (mixed >> np.uint64(29))
            at += ((word + np.uint64(1)) * self.coins[step] >> np.uint64(61)).astype(np.int64) & 1
        return key

    def candidates(self, words: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """(start, label) of windows and pieces whose keys are equal under some walk, in batches of windows."""
        for a in range(0, len(starts), 8192):
            part = starts[a : a + 8192]
            keys = self.keys(words, part, np.minimum(part + self.n, ends[a : a + 8192]))
            met = []
            for row, (known, labels) in zip(keys, self.buckets):
                low, high = np.searchsorted(known, row, "left"), np.searchsorted(known, row, "right")
                hit = np.flatnonzero(high > low)
                size = (high - low)[hit]
                met.append(np.stack([np.repeat(part[hit], size), labels[_runs(low[hit], size)]], 1))
            both = np.unique(np.concatenate(met), axis=0)
            yield both[:, 0], both[:, 1]


def _runs(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each run, one run after the other."""
    return np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())


class Pieces:
    """The items of n words, cut into pieces that are looked up by walks; `windows` verifies what the buckets name."""

    def __init__(self, rng, items: list[np.ndarray], members: list[int], most: int, recall: float, words: int):
        self.n, self.most, self.reach = len(items[0]), most, len(items[0]) + most
        self.items, self.members, self.words = np.array(items), np.array(members), words
        self.known = np.unique(np.arange(len(items))[:, None] * words + self.items)
        self.count = most // 2 + 1
        self.cuts = np.linspace(0, self.n, self.count + 1).astype(np.int64)
        self.walks, self.piece_words = [], []
        for size in sorted(set(np.diff(self.cuts).tolist())):
            places = np.flatnonzero(np.diff(self.cuts) == size)
            labels = [i * self.count + j for i in range(len(items)) for j in places.tolist()]
            pieces = [self.items[k // self.count, self.cuts[k % self.count] :][:size] for k in labels]
            repeats = repeats_for(recall, size) if most else 1  # exact copies meet under any walk
            self.walks.append(Walks(rng, pieces, labels, repeats))
            self.piece_words.append(np.unique(np.array(labels)[:, None] * words + np.array(pieces)))

    def windows(self, words: np.ndarray, starts: np.ndarray, bounds: np.ndarray, known: np.ndarray):
        """(item, edits, start) of the best window of each region that a bucket names; `starts`: where windows may begin."""
        text = np.searchsorted(bounds, starts, "right") - 1
        size = np.minimum(starts + self.reach, bounds[text + 1])
        size[:-1] = np.minimum(size[:-1], starts[1:])
        places = _runs(starts, size - starts)
        ends = bounds[np.repeat(text, size - starts) + 1]
        for walks, own in zip(self.walks, self.piece_words):
            slack = min(self.most, 1)
            near = known[np.minimum(places + walks.n, ends)] - known[places] >= walks.n - slack
            for place, label in walks.candidates(words, places[near], ends[near]):
                if slack:  # nearly all words of the piece must be there
                    window = words[np.minimum(place[:, None] + np.arange(walks.n + 1), len(words) - 1)]
                    key = label[:, None] * self.words + window
                    there = own[np.minimum(np.searchsorted(own, key), len(own) - 1)] == key
                    kept = there.sum(1) >= walks.n - 1
                    place, label = place[kept], label[kept]
                yield from self._verified(words, place, label, starts, bounds)

    def _verified(self, words, place, label, starts, bounds):
        regions = self._regions(label // self.count, place - self.cuts[label % self.count], place, starts, bounds)
        order = np.argsort(regions[2] - regions[1], kind="stable")
        width, i = (regions[2] - regions[1])[order] + self.reach + 1, 0
        while i < len(order):
            j = i + 1
            while j < len(order) and (j - i + 1) * width[j] <= CELLS:
                j += 1
            yield from self._compare(words, *(x[order[i:j]] for x in regions))
            i = j

    def _regions(self, item, begin, place, starts, bounds):
        """(item, first start, last start, end of the text): starts within `most` words of where pieces put the item."""
        text = np.searchsorted(bounds, place, "right") - 1
        low, end = np.maximum(begin - self.most, bounds[text]), bounds[text + 1]
        high = np.minimum(begin + self.most, end - 1)
        some = np.searchsorted(starts, high, "right") > np.searchsorted(starts, low, "left")  # else no window begins there
        order = np.lexsort((low[some], item[some]))
        item, low, high, end = (x[some][order] for x in (item, low, high, end))
        if not len(item):
            return item, low, high, end
        fresh = np.ones(len(item), bool)
        fresh[1:] = (item[1:] != item[:-1]) | (low[1:] > high[:-1] + 1) | (end[1:] != end[:-1])
        first = np.flatnonzero(fresh)
        low, high = low[first], high[np.append(first[1:], len(item)) - 1]
        # Long regions are cut, so that a repetitive text is compared in pieces of bounded size.
        step = 4 * self.n
        pieces = (high - low) // step + 1
        lows = np.repeat(low, pieces) + step * _runs(np.zeros_like(pieces), pieces)
        return np.repeat(item[first], pieces), lows, np.minimum(lows + step - 1, np.repeat(high, pieces)), np.repeat(end[first], pieces)

    def _compare(self, words, item, low, high, end):
        last = (high - low)[:, None]  # of the starts, from the beginning of a region
        columns = np.arange(int(last.max()) + self.reach)
        place = low[:, None] + columns
        text = np.where(place < end[:, None], words[np.minimum(place, len(words) - 1)], 0)
        key = item[:, None] * self.words + text
        known = self.known[np.minimum(np.searchsorted(self.known, key), len(self.known) - 1)] == key
        begins = known & (columns <= last)
        seen = np.zeros((len(item), len(columns) + self.reach + 1), np.int32)
        seen[:, 1 : len(columns) + 1] = np.cumsum(known, axis=1)
        seen[:, len(columns) + 1 :] = seen[:, len(columns), None]
        begins &= seen[:, self.reach : -1] - seen[:, : len(columns)] >= self.n - self.most
        some = np.flatnonzero(begins.any(1))
        text, begins, item, low = text[some, ::-1], begins[some], item[some], low[some]
        # From the back: the last row holds, per start, the least edits of the item to a window that begins there.
        steps = np.arange(len(columns) + 1, dtype=np.int32)
        row = np.zeros((len(some), len(steps)), np.int32)
        for i in range(1, self.n + 1):
            fresh = np.empty_like(row)
            fresh[:, 0] = i
            np.minimum(row[:, 1:] + 1, row[:, :-1] + (text != self.items[item, -i][:, None]), out=fresh[:, 1:])
            fresh -= steps
            row = np.minimum.accumulate(fresh, axis=1) + steps
            if i % 8 == 0 or i == self.n:
                open_ = row.min(1) <= self.most
                if not open_.all():
                    row, text, begins, item, low = row[open_], text[open_], begins[open_], item[open_], low[open_]
                if not len(item):
                    return
        edits = np.where(begins, row[:, :0:-1], self.most + 1)
        best = edits.argmin(1)
        least = edits[np.arange(len(item)), best]
        hit = least <= self.most
        yield from zip(self.members[item[hit]].tolist(), least[hit].tolist(), (low + best)[hit].tolist())


class Index:
    """The items of one shard, by length class and bucket; `search` finds them in batches of documents."""

    def __init__(self, items: list[tuple[int, str]], edits: float = EDITS, recall: float = RECALL, min_words: int = MIN_WORDS):
        rng = np.random.default_rng(_SEED)
        self.edits = edits
        split = [(item_id, words_of(text)) for item_id, text in items]
        split = sorted((x for x in split if len(x[1]) >= max(min_words, 1)), key=lambda x: len(x[1]))
        self.vocabulary: dict[bytes, int] = {}
        number = self.vocabulary.setdefault
        self.items = [(i, np.array([number(w, len(self.vocabulary) + 1) for w in ws], np.int64)) for i, ws in split]
        seen = Counter(w for _, ws in split for w in ws)
        rank = {w: i for i, w in enumerate(sorted(seen, key=lambda w: (seen[w], -len(w), w)))}
        rarity = np.empty(len(self.vocabulary) + 1, np.int64)
        for word, n in self.vocabulary.items():
            rarity[n] = rank[word]

        by_length: dict[int, list[int]] = defaultdict(list)
        for k, (_, w) in enumerate(self.items):
            by_length[len(w)].append(k)
        self.classes: list[LengthClass] = []
        for n, members in sorted(by_length.items()):
            if not self.classes or n > 1.2 * self.classes[-1].low + 1:
                self.classes.append(LengthClass(n, len(self.vocabulary) + 1))
            c = self.classes[-1]
            c.reach = n + int(edits * n)
            for k in members:
                w = self.items[k][1]
                c.words[w] = True
                c.rare[w[np.argsort(rarity[w], kind="stable")[: int(edits * n) + c.needed]]] = True
            own = [self.items[k][1] for k in members]
            c.lengths.append(Pieces(rng, own, members, int(edits * n), recall, len(self.vocabulary) + 1))

    def search(self, texts: list[str | None]) -> list[tuple[int, int, int, int]]:
        """(text, item, edits, first word) of the best window found for each text and item."""
        if not self.items:
            return []
        number, ids, bounds = self.vocabulary.get, [], [0]
        for text in texts:
            ids.extend([number(w, 0) for w in words_of(text)])
            bounds.append(len(ids))
        words, bounds = np.array([*ids, 0], np.int64), np.array(bounds)
        found: dict[tuple[int, int], tuple[int, int]] = {}
        for c in self.classes:
            starts = c.starts(words)
            if not len(starts):
                continue
            ends = bounds[np.searchsorted(bounds, starts, "right")]
            known = np.concatenate([[0], np.cumsum(c.words[words])])
            for same in c.lengths:
                most = same.most
                full = known[np.minimum(starts + same.reach, ends)] - known[starts] >= same.n - most
                if not full.any():
                    continue
                for item, edits, start in same.windows(words, starts[full], bounds, known):
                    key = int(np.searchsorted(bounds, start, "right") - 1), item
                    if (edits, start) < found.get(key, (most + 1, 0)):
                        found[key] = (edits, start)
        return [(t, k, edits, int(start - bounds[t])) for (t, k), (edits, start) in sorted(found.items())]


def _batches(texts: list, size: int = 1 << 23):
    start, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text or "")
        if held >= size:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _shards(benchmark: DataFrame) -> tuple[DataFrame, int]:
    """The items with their shard, and how many shards there are; a shard has about SHARD_WORDS words."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.filter("text is not null")
    total = items.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    shards = total // SHARD_WORDS + 1
    return items.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards))), shards


def _index(items: DataFrame, shard: int, options: dict) -> Index:
    """The index of one shard, the only part of the benchmark that the driver and a pass over the documents hold."""
    rows = items.filter(F.col("shard") == shard).select("item_id", "text").orderBy("item_id", "text").collect()
    return Index([(r["item_id"], r["text"]) for r in rows], **options)


def find_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Per document row and item found in it: doc_id, item_id, edits, item_words, first_word (from 0)."""
    chosen = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), "text")
    items, shards = _shards(benchmark)
    leaks = None
    for shard in range(shards):
        found = _pass(chosen, _index(items, shard, options))
        if shards > 1:
            found = staged(found, "leaks")
        leaks = found if leaks is None else leaks.unionAll(found)
    return leaks.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("item_id").cast("long").alias("item_id"), "edits", "item_words", "first_word"
    )


def _pass(chosen: DataFrame, index: Index) -> DataFrame:
    def run(frames):
        for frame in frames:
            ids, texts = frame["doc_id"].tolist(), frame["text"].tolist()
            for a, b in _batches(texts):
                rows = []
                for t, k, edits, start in index.search(texts[a:b]):
                    item, words = index.items[k]
                    rows.append((ids[a + t], None if item is None else str(item), edits, len(words), start))
                yield pd.DataFrame(rows, columns=["doc_id", "item_id", "edits", "item_words", "first_word"])

    return chosen.mapInPandas(run, "doc_id string, item_id string, edits int, item_words int, first_word int")


def _holds_none(index: Index, text: Column) -> Column:
    @F.pandas_udf("boolean")
    def judge(texts: pd.Series) -> pd.Series:
        values, out = texts.tolist(), np.ones(len(texts), bool)
        for a, b in _batches(values):
            out[[a + hit[0] for hit in index.search(values[a:b])]] = False
        return pd.Series(out)

    return judge(text)


def keep_clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents whose text holds no item, with all their columns; further shards look at what earlier ones kept."""
    items, shards = _shards(benchmark)
    for shard in range(shards):
        docs = docs.filter(_holds_none(_index(items, shard, options), F.col("text")))
        if shards > 1:
            docs = staged(docs, "without-leaks")
    return docs
