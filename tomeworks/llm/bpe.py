"""Byte-level BPE in batched numpy merge rounds.

The symbols of many distinct words lie in one flat array. In a round, every adjacent pair is looked up by binary
search over the sorted pair keys, each word takes its pair of lowest rank, and all places of that pair in the word are merged
at once. Pieces seen before come from a bounded dictionary.

Defined results: null is the empty text, which has no ids; texts of any length are cut only where the pattern
itself must cut. Repeated rows and null doc_ids are rows like any other; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: How byte-level vocabularies split a text (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A space where the pattern always cuts: between two characters that aren't white space.
SAFE = regex.compile(r"(?<=\S) (?=\S)")
#: Characters of a text that are handled at once, and pieces kept in the dictionary.
SPAN, KEPT = 1 << 20, 300_000


def byte_letters() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte: itself, or the next from U+0100."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    out, at = [""] * 256, 256
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b], at = chr(at), at + 1
    return out


class BytePairCodec:
    """A byte-level BPE tokenizer from the file of a public vocabulary."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        letters = byte_letters()
        back = {c: b for b, c in enumerate(letters)}
        self.size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.first = np.array([vocab[c] for c in letters], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        key = np.array([vocab[a] * self.size + vocab[b] for a, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        #: A token made by two different merges could win against a pair of its own round: then one merge a round.
        self.single = len(np.unique(made)) < len(made)
        order = np.argsort(key)
        self.keys, self.ranks, self.made = key[order], order.astype(np.int64), made[order]
        self.bytes: list[bytes] = [b""] * self.size
        for t, i in vocab.items():
            self.bytes[i] = bytes(back[c] for c in t)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for t, i in self.added.items():
            self.bytes[i] = t.encode()
        self.split = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.pieces = regex.compile(PATTERN)
        self.known: dict[str, str] = {}
        self.old: dict[str, str] = {}

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and where each word begins (n + 1)."""
        n = len(words)
        word = np.repeat(np.arange(n), [len(w) for w in words])
        sym = self.first[np.frombuffer(b"".join(words), np.uint8)]
        done_word, done_sym, none = [], [], np.int64(1 << 62)
        while len(sym):
            key = sym[:-1] * self.size + sym[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = (self.keys[at] == key) & (word[:-1] == word[1:])
            rank = np.append(np.where(hit, self.ranks[at], none), none)
            head = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            low = np.minimum.reduceat(rank, head)
            size = np.diff(np.append(head, len(sym)))
            live = low < none
            if not live.all():
                out = np.repeat(~live, size)
                done_word.append(word[out])
                done_sym.append(sym[out])
                if not live.any():
                    break
                stay = ~out
                sym, word, rank = sym[stay], word[stay], rank[stay]
                at = at[stay[:-1]] if stay[-1] else np.append(at, 0)[stay]
                size, low = size[live], low[live]
            pos = np.flatnonzero(rank == np.repeat(low, size))
            if self.single:
                pos = pos[np.concatenate(([True], word[pos[1:]] != word[pos[:-1]]))]
            else:  # of places that overlap, every other one from the left
                run = np.concatenate(([True], pos[1:] != pos[:-1] + 1))
                nth = np.arange(len(pos)) - np.maximum.accumulate(np.where(run, np.arange(len(pos)), 0))
                pos = pos[nth % 2 == 0]
            sym = sym.copy()
            sym[pos] = self.made[at[pos]]
            keep = np.ones(len(sym), bool)
            keep[pos + 1] = False
            sym, word = sym[keep], word[keep]
        if not done_word:
            return np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
        word, sym = np.concatenate(done_word), np.concatenate(done_sym)
        order = np.argsort(word, kind="stable")
        return sym[order], np.searchsorted(word[order], np.arange(n + 1))

    def learn(self, pieces: set[str]) -> None:
        """Put pieces into the dictionary: their ids as decimal numbers joined by commas.

        A full dictionary becomes the old one, from which pieces that are met again move to the new one."""
        new = [p for p in pieces if p not in self.known]
        if not new:
            return
        if len(self.known) + len(new) > KEPT:
            self.old, self.known = self.known, {}
            new = list(pieces)
        if self.old:
            again = {p: self.old[p] for p in new if p in self.old}
            self.known.update(again)
            new = [p for p in new if p not in again]
        for i in range(0, len(new), 50_000):
            part = new[i : i + 50_000]
            ids, at = self.merge([p.encode() for p in part])
            text = list(map(str, ids.tolist()))
            at = at.tolist()
            self.known.update((p, ",".join(text[a:b])) for p, a, b in zip(part, at, at[1:], strict=False))

    def spans(self, text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > SPAN:
            m = SAFE.search(text, at + SPAN)
            if m is None:
                break
            yield text[at : m.start()]
            at = m.start()
        yield text[at:] if at else text

    def parts(self, text: str) -> Iterator[str | list[str]]:
        """The pieces of each span of the text, and the ids of added tokens between them."""
        for part in self.split.split(text) if self.split else (text,):
            if part in self.added:
                yield str(self.added[part])
            elif part:
                for span in self.spans(part):
                    yield self.pieces.findall(span)

    def ids_text(self, text: str) -> Iterator[str]:
        """Ids of the text as decimal numbers joined by commas, by parts."""
        for part in self.parts(text):
            if not isinstance(part, str):
                self.learn(set(part))
                part = ",".join(map(self.known.__getitem__, part))
            yield part

    def ids_texts(self, texts: Iterator[str]) -> Iterator[Iterator[str]]:
        """ids_text of each text; the new pieces of many short texts are merged together."""

        def flush() -> Iterator[Iterator[str]]:
            docs = [list(self.parts(t)) for t in held]
            self.learn(set().union(*(p for d in docs for p in d if not isinstance(p, str))))
            for d in docs:
                yield (p if isinstance(p, str) else ",".join(map(self.known.__getitem__, p)) for p in d)

        held, size = [], 0
        for t in texts:
            if held and size + len(t) > SPAN:
                yield from flush()
                held, size = [], 0
            if len(t) > SPAN:
                yield self.ids_text(t)
            else:
                held.append(t)
                size += len(t)
        if held:
            yield from flush()

    @staticmethod
    def numbers(parts: Iterator[str]) -> np.ndarray:
        got = [np.fromstring(x, np.int64, sep=",") for x in parts]
        return np.concatenate(got) if got else np.zeros(0, np.int64)

    def encode(self, text: str | None) -> np.ndarray:
        return self.numbers(self.ids_text(text or ""))

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids.tolist()))

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


@lru_cache(2)
def codec(path: str) -> BytePairCodec:
    return BytePairCodec(path)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (the whole token sequence): the operator's general form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c.numbers(parts).astype(np.int32) for parts in c.ids_texts(t.as_py() or "" for t in b.column(1))], pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, text of (doc_id, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c.decode(np.array(x.as_py() or [], np.int64)) for x in b.column(1)], pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: digests of the ids and of what they decode to, in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            counts, ids_sha, text_sha = [], [], []
            for parts in c.ids_texts(t.as_py() or "" for t in b.column(1)):
                a, d, n = hashlib.sha256(), [], 0
                for part in parts:
                    a.update(("," if n else "").encode() + part.encode())
                    ids = np.fromstring(part, np.int64, sep=",")
                    n += len(ids)
                    d.append(c.decode_bytes(ids))
                counts.append(n)
                ids_sha.append(a.hexdigest())
                text_sha.append(hashlib.sha256(b"".join(d).decode("utf-8", "replace").encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
