"""Token ids from the `tokenizers` library, with a bounded memory of words."""

from __future__ import annotations

import json
import os
from array import array
from functools import lru_cache

import numpy as np

SINGLE = (",", ".")  # marks that end a word as a pre-token of their own


class Encoder:
    """Ids of whole texts as little-endian bytes (`dtype`), equal to ``tokenizer.encode(text)``.

    Byte-level BPE never merges across its pre-tokens, and a blank before a
    word always begins one.  So texts whose blanks are single spaces and line
    ends are cut there and each distinct piece is encoded by the library once;
    other texts, and other kinds of tokenizers, are encoded whole.  Pieces met
    again move from a first memory, which the many rare ones pass through, to a
    second; each is emptied at `words` pieces.  Texts that hold the string of an
    added token are encoded whole, as the library takes such strings out first.
    """

    def __init__(self, path: str, words: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = [t["content"] for t in spec.get("added_tokens") or []]
        before = spec.get("pre_tokenizer") or {}
        self.cuts = (
            before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and not spec.get("normalizer")
        )
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.words = words
        self.known: dict[str, bytes] = {}  # a piece after a space, or "\n" and a piece; met again
        self.fresh: dict[str, bytes] = {}  # the same, met once
        self.first: dict[str, bytes] = {}  # a piece at the start of a text
        self.marks = {m: self._ids([m])[0] for m in SINGLE}

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.code, e.ids).tobytes() for e in found]

    def _learn(self, missing: set[str]) -> None:
        marked = {w for w in missing if w[-1] in SINGLE and w[:-1].lstrip("\n").isalpha()}
        stems = {w[:-1] for w in marked}
        plain = [w for w in (missing - marked) | stems if w not in self.known and w not in self.fresh]
        self.fresh.update(zip(plain, self._ids([w if w[0] == "\n" else f" {w}" for w in plain])))
        for w in marked:
            self.fresh[w] = (self.known.get(w[:-1]) or self.fresh[w[:-1]]) + self.marks[w[-1]]

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(texts)
        cut, whole, missing, starts = [], [], set(), set()
        for memory in (self.known, self.fresh, self.first):
            if len(memory) > self.words:
                memory.clear()
        get, fresh = self.known.get, self.fresh
        for i, text in enumerate(texts):
            flat = text.replace("\n", " ")
            if not self.cuts or not flat or " ".join(flat.split()) != flat or any(t in text for t in self.added):
                whole.append(i)
                continue
            pieces = text.replace("\n", " \n").split(" ")
            ids = list(map(get, pieces))
            ids[0] = b""
            gaps = [k for k, x in enumerate(ids) if x is None] if None in ids else []
            for k in gaps:
                if (found := fresh.get(pieces[k])) is None:
                    missing.add(pieces[k])
                else:
                    self.known[pieces[k]] = found
            starts.add(pieces[0])
            cut.append((i, pieces, ids, gaps))
        if missing:
            self._learn(missing)
        if starts := [w for w in starts if w not in self.first]:
            self.first.update(zip(starts, self._ids(starts)))
        for i, pieces, ids, gaps in cut:
            for k in gaps:
                ids[k] = get(pieces[k]) or fresh[pieces[k]]
            ids[0] = self.first[pieces[0]]
            out[i] = b"".join(ids)
        for i, ids in zip(whole, self._ids([texts[i] for i in whole])):
            out[i] = ids
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each Python worker and vocabulary file."""
    return Encoder(path)


def batches(texts: list[str], size: int = 1 << 21):
    """Ranges of texts of about `size` characters, so that pieces in memory stay bounded."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= size:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
