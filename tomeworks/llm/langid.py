"""Language identification by word-first backoff.

A text is split into lower-case words (ASCII that isn't a letter separates). A known word scores by its log frequency
in each language; an unseen one by the mean log frequency of its longest known character n-grams: five characters
with the word's ends marked, else four, and so on to single ones. The scores of all words of the whole text are summed.

The model is fitted on a sample of about `sample` labelled documents of each language, whole texts, picked by a hash of doc_id;
the counts come from a distributed aggregation, and at most about `vocabulary` words and n-grams of each order and
language are kept, the most frequent ones, so that its size depends on the parameters and languages alone.

Defined results: null or without a letter: `und`, score 0. Letters, but none of the words or n-grams known: the
first language by name, with even score. Repeated rows are predicted alike; null doc_ids are predicted but not
learnt from; rows with null lang aren't learnt from. With nothing to learn from, everything is `und`.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import doc_slices, stash, text_buffers
from .kernels import run_hashes, word_hashes, words

SAMPLE, VOCABULARY, ORDERS = 2500, 30_000, 5
LETTERS = np.full(256, 0x20, np.uint8)
LETTERS[[c for c in range(256) if c > 127 or chr(c).isalpha()]] = [c for c in range(256) if c > 127 or chr(c).isalpha()]
MARK = "\x02"


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept apart for measuring: the checksum of its id leaves remainder 1 by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def grams(found: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the n-grams of marked words, their words, and where they start in the joined text."""
    text = "".join(f"{MARK}{w.decode('utf-8', 'replace')}{MARK}" for w in found)
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    ends = np.flatnonzero(cp == ord(MARK))[1::2]
    h = run_hashes(cp, order) + np.uint64(order)
    word = np.searchsorted(ends, np.arange(len(h)))
    inside = np.arange(len(h)) + order - 1 <= ends[np.minimum(word, len(ends) - 1)] if len(ends) else np.zeros(0, bool)
    at = np.flatnonzero(inside)
    return h[at], word[at], at


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        langs = b.column(1).to_pylist()
        counts: Counter = Counter()
        data, offs = text_buffers(pc.utf8_lower(b.column(0).cast(pa.string())))
        for i, lang in enumerate(langs):
            own = Counter(LETTERS[data[offs[i] : offs[i + 1]]].tobytes().split())
            for w, n in own.items():
                counts[lang, w] += n
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in counts], pa.string()), pa.array([k[1].decode("utf-8", "replace") for k in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], names=["lang", "word", "n"])


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        langs, found, n = b.column(0).to_pylist(), [w.encode() for w in b.column(1).to_pylist()], b.column(2).to_numpy()
        names = sorted(set(langs))
        code = np.array([names.index(x) for x in langs], np.int64)
        for order in range(1, ORDERS + 1):
            h, word, _ = grams(found, order)
            for k, name in enumerate(names):
                own = code[word] == k
                u, inv = np.unique(h[own], return_inverse=True)
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(u), pa.string()), pa.array([order] * len(u), pa.int32()), pa.array(u.view(np.int64)), pa.array(np.bincount(inv, n[word[own]]).astype(np.int64))], names=["lang", "ord", "item", "n"])


def top(counts: DataFrame, keys: list[str], most: int) -> DataFrame:
    """Rows of at most about the `most` highest n for each key, by thresholds from the counts of counts."""
    steps = counts.groupBy(*keys, F.least("n", F.lit(1000)).alias("n")).count().collect()
    by: dict[tuple, list] = {}
    for r in steps:
        by.setdefault(tuple(r[k] for k in keys), []).append((r["n"], r["count"]))
    least = []
    for key, rows in by.items():
        total, bar = 0, 1000
        for n, c in sorted(rows, reverse=True):
            if total and total + c > most:
                break
            total, bar = total + c, n
        least.append((*key, bar))
    bars = counts.sparkSession.createDataFrame(least, ", ".join(f"{k} {counts.schema[k].dataType.simpleString()}" for k in keys) + ", bar long") if least else None
    return counts.where("false") if bars is None else counts.join(F.broadcast(bars), keys).where("n >= bar").drop("bar")


class WordFirstModel:
    """Log frequencies of words and n-grams by language, with hashed keys."""

    def __init__(self, langs: list[str], words_: pa.Table, grams_: pa.Table):
        self.langs = langs
        self.word_keys, self.word_scores = self._tables(words_, 0)
        self.gram_tables = {o: self._tables(grams_, o) for o in range(1, ORDERS + 1)}

    def _tables(self, t: pa.Table, order: int) -> tuple[np.ndarray, np.ndarray]:
        t = t.filter(pc.equal(t["ord"], order))
        item, n = t["item"].to_numpy().view(np.uint64), t["n"].to_numpy().astype(np.float64)
        lang = np.array([self.langs.index(x) for x in t["lang"].to_pylist()], np.int64)
        keys, inv = np.unique(item, return_inverse=True)
        m = np.zeros((len(keys), len(self.langs)))
        np.add.at(m, (inv, lang), n)
        total = m.sum(axis=0) + 0.5 * max(1, len(keys))
        return keys, np.log((m + 0.5) / total).astype(np.float32)

    @staticmethod
    def _find(keys: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Rows of the keys, -1 where unknown."""
        if not len(keys):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        return np.where(keys[at] == h, at, -1)

    def unseen(self, found: list[bytes]) -> np.ndarray:
        """Scores of words by their longest known n-grams."""
        out, left = np.zeros((len(found), len(self.langs)), np.float32), np.arange(len(found))
        for order in range(ORDERS, 0, -1):
            if not len(left):
                break
            h, word, _ = grams([found[i] for i in left], order)
            keys, scores = self.gram_tables[order]
            at = self._find(keys, h)
            ok = at >= 0
            word, at = word[ok], at[ok]
            n = np.bincount(word, minlength=len(left))
            known = n > 0
            for k in range(len(self.langs)):
                out[left[known], k] = (np.bincount(word, scores[at, k], minlength=len(left)) / np.maximum(n, 1))[known]
            left = left[~known]
        return out

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        n, total = len(column), np.zeros((len(column), len(self.langs)))
        data, offs = text_buffers(pc.utf8_lower(column.cast(pa.string())))
        letters = np.zeros(n, bool)
        for i, j in doc_slices(offs):
            d, o = LETTERS[data[offs[i] : offs[j]]], offs[i : j + 1] - offs[i]
            starts, ends, first = words(d, o)
            if not len(starts):
                continue
            letters[i:j] = first[1:] > first[:-1]
            h, at, inv = np.unique(word_hashes(d, starts, ends), return_index=True, return_inverse=True)
            row = self._find(self.word_keys, h)
            scores = np.zeros((len(h), len(self.langs)), np.float32)
            known = row >= 0
            if known.any():
                scores[known] = self.word_scores[row[known]]
            new = at[~known]
            if len(new):
                raw = d.tobytes()
                scores[~known] = self.unseen([raw[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist(), strict=True)])
            sums = np.concatenate((np.zeros((1, len(self.langs))), np.cumsum(scores[inv], axis=0, dtype=np.float64)))
            total[i:j] = sums[first[1:]] - sums[first[:-1]]
            ascii_ = np.concatenate(([0], np.cumsum((d > 0x20) & (d < 128), dtype=np.int64)))
            for r in np.flatnonzero(letters[i:j] & (ascii_[o[1:]] == ascii_[o[:-1]])):  # words without an ASCII letter may hold no letter at all
                if not any(map(str.isalpha, d[o[r] : o[r + 1]].tobytes().decode("utf-8", "replace"))):
                    letters[i + r] = False
        p = np.exp(total - total.max(axis=1, keepdims=True)) if n else total
        p /= p.sum(axis=1, keepdims=True) if n else 1
        best = p.argmax(axis=1) if n else np.zeros(0, int)
        score = np.where(letters, p[np.arange(n), best], 0.0)
        return [self.langs[b] if ok else "und" for b, ok in zip(best.tolist(), letters.tolist(), strict=True)], score


def fit(train: DataFrame, sample: int = SAMPLE, vocabulary: int = VOCABULARY) -> WordFirstModel | None:
    """A model of (doc_id, text, lang) rows; see the module's text for its bounds."""
    spark = train.sparkSession
    train = train.where("doc_id is not null and lang is not null and text is not null")
    sizes = {r["lang"]: r["count"] for r in train.groupBy("lang").count().collect()}
    if not sizes:
        return None
    share = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, sample / n)))])
    picked = train.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.element_at(share, F.col("lang")) * float(1 << 30))
    counts = stash(picked.select("text", "lang").mapInArrow(_word_counts, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")))
    top_words = top(counts.where("n > 1"), ["lang"], vocabulary).toArrow()
    gram = stash(counts.mapInArrow(_gram_counts, "lang string, ord int, item long, n long").groupBy("lang", "ord", "item").agg(F.sum("n").alias("n")))
    top_grams = top(gram, ["lang", "ord"], vocabulary).select("lang", "ord", "item", "n").toArrow()
    raw = [w.encode() for w in top_words["word"].to_pylist()]
    data = np.frombuffer(b" ".join(raw), np.uint8)
    starts, ends, _ = words(data, np.array([0, len(data)]))
    top_words = pa.table([top_words["lang"], pa.array(np.zeros(len(raw), np.int32)), pa.array(word_hashes(data, starts, ends).view(np.int64)), top_words["n"]], names=["lang", "ord", "item", "n"])
    return WordFirstModel(sorted(sizes), top_words, top_grams)


def predict(docs: DataFrame, model: WordFirstModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if model is None:
        return rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, score = sent.value.predict(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def known(docs: DataFrame, model: WordFirstModel | None, text_col: str = "text") -> DataFrame:
    """The rows whose text isn't `und`, each judged on its own, whatever its id."""
    if model is None:
        return docs.where("false")
    sent, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, _ = sent.value.predict(b.column(at).cast(pa.string()))
            yield b.filter(pa.array([x != "und" for x in lang], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learnt from the documents that aren't held out."""
    train = docs.select("doc_id", "text", "lang").where(~held_out(F.col("doc_id")))
    return predict(docs, fit(train)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
