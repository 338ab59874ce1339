"""Token counts of unigram tokenizers by count-only Viterbi.

An Aho-Corasick automaton enumerates all vocabulary pieces that end at each character of a word; dynamic programming
carries the best score and the number of pieces of the path to there, nothing else. Ties are decided as the tokenizers
library decides them: of paths to the same place with equal score, the one whose last piece starts first stays.
A character that is no piece costs the least score less 10 and counts as its UTF-8 bytes (byte fallback), or
together with its unknown neighbours as one piece.

Text is treated as by a "▁" metaspace pre-tokenizer that prepends always and splits: spaces become ▁, and words begin with it.
Words come from two bounded dictionaries once they are counted, an old one and a new one that takes its place when full.

Defined results: null and empty texts have 0 tokens. Repeated rows and null doc_ids are rows like any other; an
empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE, PENALTY, KEPT = "▁", 10.0, 600_000


class UnigramCounter:
    """Counts pieces by a list of (piece, score)."""

    def __init__(self, vocab: list[tuple[str, float]], byte_fallback: bool = True):
        self.trie = ahocorasick.Automaton()
        for piece, score in vocab:
            if piece:
                self.trie.add_word(piece, (len(piece), score))
        self.trie.make_automaton()
        self.single = {p for p, _ in vocab if len(p) == 1}
        self.unknown = min(s for _, s in vocab) - PENALTY
        self.bytes = byte_fallback
        self.known: dict[str, int] = {}
        self.old: dict[str, int] = {}
        #: No piece holds a line feed: then a path can't cross one, and texts may be cut there.
        self.lines = byte_fallback and not any("\n" in p for p, _ in vocab)

    def viterbi(self, word: str) -> int:
        """The number of pieces on the best path."""
        n = len(word)
        if self.single.issuperset(word):  # no unknown characters
            score, count = [0.0, *[-math.inf] * n], [0] * (n + 1)
            for last, (size, s) in self.trie.iter(word):
                start = last + 1 - size
                s += score[start]
                if s > score[last + 1]:
                    score[last + 1] = s
                    count[last + 1] = count[start] + 1
            return count[n]
        score, count, lone = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        done = 0  # places up to here are settled
        best: float | None = None

        def unknown(end: int, best: float | None) -> None:
            c = word[end - 1]
            if c not in self.single:
                s = score[end - 1] + self.unknown
                if best is None or s > best:
                    score[end] = s
                    if self.bytes:
                        count[end] = count[end - 1] + len(c.encode("utf-8", "surrogatepass"))
                    else:
                        count[end] = count[end - 1] + (not lone[end - 1])
                        lone[end] = True

        # matches come by their ends, of equal ends the longest first
        for last, (size, s) in self.trie.iter(word):
            end = last + 1
            while done + 1 < end:
                done += 1
                unknown(done, best)
                best = None
            s += score[end - size]
            if best is None or s > best:
                best = score[end] = s
                count[end] = count[end - size] + 1
        while done < n:
            done += 1
            unknown(done, best)
            best = None
        return count[n]

    def count(self, text: str) -> int:
        if not text:
            return 0
        text = text.replace(" ", SPACE)
        words = [SPACE + w for w in text[text.startswith(SPACE) :].split(SPACE)]
        feeds = 0
        if self.lines and "\n" in text:
            feeds = text.count("\n")
            words = "\n".join(words).split("\n")
        known = self.known
        new = [w for w in set(words) if w not in known]
        if new:
            if len(known) + len(new) > KEPT:  # words that are met again move from the old dictionary to the new one
                self.old, self.known = known, {}
                known, new = self.known, list(set(words))
            old = self.old
            for w in new:
                n = old.get(w)
                known[w] = self.viterbi(w) if n is None else n
        return sum(map(known.__getitem__, words)) + feeds


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece file, taken as a unigram vocabulary."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())]


@lru_cache(2)
def counter(path: str) -> UnigramCounter:
    return UnigramCounter(vocabulary(path))


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c.count(t.as_py() or "") for t in b.column(1)], pa.int64())], names=["doc_id", "n_tokens"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, n_tokens long")
