"""How many tokens a unigram tokenizer makes of a text, without making them.

Aho-Corasick names every vocabulary piece that ends at a character; dynamic programming keeps, per character, the best
score of the text so far and the number of pieces of that best path.  Ties go to the piece that starts first, as in the
tokenizer: of equally good paths to a character the one with the longest last piece stays.  A character that is no
piece by itself may also be unknown, at the lowest score less ten, and costs as many byte pieces as its UTF-8 has
bytes if the vocabulary has those, else one piece for a run of unknown characters.

Before a word mark that follows another character no piece can span, if the vocabulary holds none with a mark inside;
the same goes for line ends.  There the text is cut, and each distinct word is solved once per task (the memory is
emptied at `WORDS` words).  Cutting leaves every sum as it is because scores are whole numbers; for other vocabularies
texts are solved whole.

The vocabulary is a sentencepiece file: its pieces with their scores, read as a unigram model.

Nulls and odd rows: a null or empty text has no tokens and score 0; rows with repeated or null ids are counted each; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"  # stands for a space, and begins a text
WORDS = 500_000
PENALTY = 10.0  # of an unknown character below the lowest score
SHIFT = 62  # pieces are kept above, minus the score below, in one whole number


class Vocabulary:
    """Pieces with scores; `solve` gives (score, pieces) of the best path through a normalised text."""

    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick

        scores = dict(pieces)
        self.automaton = ahocorasick.Automaton()
        for piece, score in scores.items():
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p in scores if len(p) == 1}
        self.unknown = min(scores.values()) - PENALTY
        self.bytes = all(f"<0x{b:02X}>" in scores for b in range(256))
        whole = all(s == int(s) and s <= 0 for s in scores.values())
        inside = any(MARK in p.lstrip(MARK) for p in scores)
        self.cuts = whole and not inside and self.bytes
        self.cuts_lines = self.cuts and not any("\n" in p for p in scores if len(p) > 1)

    def solve(self, text: str) -> tuple[float, int]:
        ends: list[list] = [[] for _ in range(len(text) + 1)]
        for last, match in self.automaton.iter(text):
            ends[last + 1].append(match)
        best, pieces, open_ = [0.0], [0], [False]  # open_: the path ends in an unknown character
        for end, found in enumerate(ends[1:], 1):
            top, start = None, -1
            for length, score in found:
                score += best[end - length]
                if top is None or score > top or score == top and end - length < start:
                    top, start = score, end - length
            unknown = False
            char = text[end - 1]
            if char not in self.single:
                score = best[end - 1] + self.unknown
                if top is None or score > top:
                    top, start, unknown = score, end - 1, True
            if not unknown:
                n = pieces[start] + 1
            elif self.bytes:
                n = pieces[start] + len(char.encode("utf-8", "surrogatepass"))
            else:
                n = pieces[start] + (not open_[start])
            best.append(top)
            pieces.append(n)
            open_.append(unknown)
        return best[-1], pieces[-1]


class _Solved(dict):
    """Solved words; a missing one is solved on the way."""

    def __init__(self, vocabulary: Vocabulary, before: str):
        self.vocabulary, self.before = vocabulary, before

    def __missing__(self, word: str) -> int:
        score, pieces = self.vocabulary.solve(self.before + word)
        self[word] = value = (pieces << SHIFT) + int(-score)
        return value


class Counter:
    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.after_space, self.bare = _Solved(vocabulary, MARK), _Solved(vocabulary, "")
        score, pieces = vocabulary.solve("\n")
        self.line_end = (pieces << SHIFT) + int(-score) if vocabulary.cuts else 0

    def count(self, text: str | None) -> tuple[int, float]:
        """(pieces, score) of a whole text."""
        if not text:
            return 0, 0.0
        if not self.vocabulary.cuts or MARK in text:
            score, pieces = self.vocabulary.solve(MARK + text.replace(" ", MARK))
            return pieces, score
        lines = text.split("\n") if self.vocabulary.cuts_lines else [text]
        total = self.line_end * (len(lines) - 1)
        for k, line in enumerate(lines):
            words = line.split(" ")
            if "" in words:
                if k and line:
                    total += self.bare[words[0]] if words[0] else 0
                    words = words[1:]
                elif k:
                    continue
                total += self._run_on(words)
                continue
            if k:
                total += self.bare[words[0]]
                words = words[1:]
            total += sum(map(self.after_space.__getitem__, words))
        for known in (self.after_space, self.bare):
            if len(known) > WORDS:
                known.clear()
        return total >> SHIFT, -float(total & ((1 << SHIFT) - 1))

    def _run_on(self, words: list[str]) -> int:
        """Words each after a space, where several spaces follow each other: such a run stays with its word."""
        total, run = 0, ""
        for word in words:
            if word:
                total += self.after_space[run + word]
                run = ""
            else:
                run += MARK
        if run:
            total += self.after_space[run[1:]]
        return total


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One counter for each Python worker and vocabulary file."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    return Counter(Vocabulary([(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]))


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """Per row: doc_id, n_tokens, score."""

    def run(frames):
        model = counter(path)
        for frame in frames:
            found = [model.count(text) for text in frame["text"]]
            counts = pd.DataFrame(found, columns=["n_tokens", "score"]).astype({"n_tokens": "int64", "score": "float64"})
            yield counts.assign(doc_id=frame["doc_id"].to_numpy())

    chosen = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), "text")
    counted = chosen.mapInPandas(run, "doc_id string, n_tokens long, score double")
    return counted.select(F.col("doc_id").cast("long").alias("doc_id"), "n_tokens", "score")
