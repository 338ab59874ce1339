"""Secret scan with a random forest that removes false positives.

Candidates are found in flat byte arrays: words that hold a digit, an assignment or many capitals and are long enough, cut to key and
value and freed from the punctuation around them; the parts of words of any length, between quotes, commas, brackets, &, ;, ?, =, :, @ and
non-ASCII characters (and between slashes in urls), are candidates too, and what holds another one is preferred to it. A forest trained from labelled findings judges each by its length,
its character transitions (classes, and log probability of letter pairs against dictionary words), how much of it dictionary words cover,
the path it comes from, and the words beside it (three before and two after, of which the nearest 200 characters count on each
side, whatever the text). The dictionary is learned from all documents: the words that occur most, with their
numbers, in a distributed count of which a bounded number is kept.

The labelled findings are made by a fixed rule (`labelled_findings`): keys, tokens and passwords in the formats in
which they leak, against identifiers, digests, card and phone numbers, addresses, dates, file names and words. Their
number is a parameter. Another DataFrame or list of findings can be given instead.

Defined results: null or empty text: no findings; null path: as an empty one; null doc_ids keep their findings;
repeated rows give theirs as often; of candidates that overlap the first, then the longer one is reported, so ties
can't be; texts and words of any length are read whole; empty tables give no rows. Other columns play no part.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import doc_slices, stash, text_buffers
from .kernels import words
from .langid import top
from .random_forest import RandomForest

FINDINGS, THRESHOLD, LEAST = 6000, 0.5, 8
#: Words of the dictionary, and letters of a word in it, at most.
DICTIONARY, LONGEST = 20_000, 14
WORDS = (
    "the of and to in for is on that by this with you it not or be are from at as your all have new more an was we will home can us about if page my has search free but our one other do no "
    "information time they site he up may what which their news out use any there see only so his when contact here business who web also now help get view online first am been would how were "
    "services some these click its like service than find price date back top people had list name just over state year day into email two health world re next used go work last most products "
    "music buy data make them should product system post her city add policy number such please available copyright support message after best software then good video well where info rights public "
    "books high school through each links she review years order very privacy book items company read group need many user said does set under general research university january mail full map reviews program life"
).split()
NEAR = {
    "secret": re.compile(r"(?i)(passw|passwd|pwd|secret|token|credential|bearer|auth)"),
    "key": re.compile(r"(?i)(api.?key|access.?key|private.?key|\bkey\b|_key|aws|signing)"),
    "plain": re.compile(r"(?i)(commit|sha|md5|checksum|digest|hash|uuid|guid|etag|revision|build|version|isbn|order|invoice|phone|card|iban|id\b|ip\b)"),
    "sample": re.compile(r"(?i)(example|sample|dummy|test|changeme|your|placeholder|xxx|fake)"),
}
EDGE = "\"'`,;.()[]{}<>#$%&*!?|"
ASSIGN = re.compile(r"^[\"'`({\[<]*([A-Za-z][\w.\-]{1,40})[\"'`]?\s*(?:=>|:=|=|:)\s*(.+)$")
NAMED = re.compile(r"(?i)passw|passwd|pwd|secret|token|credential|api.?key|access.?key|auth")
#: How issued keys begin (fixed values).
ISSUED = ("AKIA", "ASIA", "ghp_", "sk-", "xox", "eyJ")
CAPITAL = np.zeros(256, np.uint8)
CAPITAL[65:91] = 1
INTEREST = np.zeros(256, np.uint8)
INTEREST[[*range(48, 58)]] = 1
INTEREST[[ord("="), ord(":")]] = 1


#: What parts a word, and a part with the padding of base64; in urls slashes part too.
SEPARATORS = "\"'`,;&=:@?|(){}<>\\\\\\[\\]\x80-\U0010ffff"
PART = re.compile(f"[^{SEPARATORS}]+(?:(?<=[^{SEPARATORS}]{{16}})={{1,2}}(?=[\"'`,;&)}}\\]]|$))?")
URL_PART = re.compile(f"[^{SEPARATORS}/#]+")
#: Several pairs or quoted values: not one value.
PAIRS = re.compile(r"[\"'`][\]},:;]|[,;&?]\W{0,2}[\w.\-]{1,40}[\"'`]?[=:]")
USER = re.compile(r"://[^/?#:@\"'`<>,\s]*:([^/?#\"'`<>,\s]+)@")
KEY = re.compile(r"[A-Za-z][\w.\-]{1,40}")


def _worth(value: str, name: str, near: str) -> bool:
    """Whether the forest is to see it."""
    return len(value) >= LEAST and value.isascii() and (any(c.isdigit() for c in value) or bool(name) and bool(NAMED.search(near)) or value.startswith(ISSUED))


def candidates(word: str, before: str, after: str) -> Iterator[tuple[str, int, str, str, str]]:
    """(value, its place in the word, key name, text before, text after) of what may be secrets in a word: its value as a
    whole, the password of a url, and the parts. They may hold one another."""
    m = ASSIGN.match(word)
    name, raw, at = ("", word, 0) if m is None else (m[1], m[2], m.start(2))
    value = raw.strip(EDGE)
    at += raw.find(value) if value else 0
    seen = set()
    url = "://" in word
    if not url and _worth(value, name, name or " ".join(before.split()[-2:])) and not PAIRS.search(value):
        seen.add((at, len(value)))
        yield value, at, name, before, after
    for m in USER.finditer(word) if url else ():
        if _worth(m[1], "password", "password"):
            seen.add((m.start(1), len(m[1])))
            yield m[1], m.start(1), "password", before, after
    parts = [(m[0], m.start()) for m in (URL_PART if url else PART).finditer(word)]
    for k, (part, at) in enumerate(parts):
        value = part.strip(EDGE)
        if len(value) < LEAST:
            continue
        name = ""
        if k:
            last, begin = parts[k - 1]
            gap = word[begin + len(last) : at]
            last = last.rstrip("=")
            if "://" not in gap and ("=" in gap or ":" in gap or len(last) < len(parts[k - 1][0])) and not any(c in gap for c in ",;&") and KEY.fullmatch(last):
                name = last
        near = " ".join([*before.split()[-3:], *(x for x, _ in parts[max(0, k - 3) : k])][-3:])[-200:]
        at += part.find(value)
        if (at, len(value)) not in seen and _worth(value, name, name):
            yield value, at, name, near, " ".join([*(x for x, _ in parts[k + 1 : k + 3]), after][:2])[:200]


class Lexicon:
    """Words of four letters or more, and log probabilities of letter pairs in them, by how often they occur."""

    def __init__(self, counts: dict[str, int]):
        self.words = {w for w in counts if len(w) > 3}
        self.longest = max(map(len, self.words), default=0)
        seen: dict[str, float] = {a + b: 1.0 for a in LOWER for b in LOWER}
        for w, n in counts.items():
            for a, b in zip(w, w[1:], strict=False):
                seen[a + b] += math.log1p(n)
        total = sum(seen.values())
        self.pairs = {k: math.log(v / total) for k, v in seen.items()}

    def covered(self, low: str) -> int:
        """Letters under words, the longest first from the left."""
        out = at = 0
        while at < len(low):
            for n in range(min(self.longest, len(low) - at), 3, -1):
                if low[at : at + n] in self.words:
                    out += n
                    at += n
                    break
            else:
                at += 1
        return out


LOWER = "abcdefghijklmnopqrstuvwxyz"
_SPLIT = np.full(256, 0x20, np.uint8)
_SPLIT[[*range(65, 91), *range(97, 123)]] = [*range(97, 123)] * 2


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data, offs = text_buffers(b.column(0))
        counts: Counter = Counter()
        for i, j in doc_slices(offs):
            for r in range(i, j):
                counts.update(_SPLIT[data[offs[r] : offs[r + 1]]].tobytes().split())
        kept = {w.decode(): n for w, n in counts.items() if 4 <= len(w) <= LONGEST}
        yield pa.RecordBatch.from_arrays([pa.array(list(kept), pa.string()), pa.array(list(kept.values()), pa.int64())], names=["word", "n"])


def learn(docs: DataFrame, text_col: str = "text", most: int = DICTIONARY) -> Lexicon:
    """The words of all texts that occur most, about `most` at most and in five places at least, besides the basic ones."""
    counts = docs.select(F.col(text_col).cast("string").alias("text")).where("text is not null").mapInArrow(_word_counts, "word string, n long")
    counts = stash(counts.groupBy("word").agg(F.sum("n").alias("n")).where("n >= 5").withColumn("all", F.lit(0)))
    got = top(counts, ["all"], most).toArrow()
    return Lexicon(dict.fromkeys(WORDS, 1) | dict(zip(got["word"].to_pylist(), got["n"].to_pylist(), strict=True)))


def features(value: str, name: str, before: str, after: str, path: str, lexicon: Lexicon) -> list[float]:
    n, low = len(value), value.lower()
    kinds = [0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3 for c in value]
    changes = sum(a != b for a, b in zip(kinds, kinds[1:], strict=False))
    share = [kinds.count(k) / n for k in range(4)]
    counts = {c: low.count(c) for c in set(low)}
    entropy = -sum(k / n * math.log2(k / n) for k in counts.values())
    pairs = [lexicon.pairs[low[i : i + 2]] for i in range(n - 1) if low[i : i + 2] in lexicon.pairs]
    covered = lexicon.covered(low) / n
    near = f"{name} {before}"
    return [
        n, changes / n, *share, entropy, sum(pairs) / len(pairs) if pairs else 0.0, len(pairs) / n, covered,
        float(all(c in "0123456789abcdef" for c in low)), float(low.count("-")), float(low.count(".")), float(value.startswith(ISSUED)), float(bool(name)),
        *(float(bool(p.search(near))) for p in NEAR.values()), float(bool(NEAR["plain"].search(after))), float(bool(NEAR["sample"].search(low))),
        float(bool(re.search(r"(?i)test|example|doc|sample", path))), float(bool(re.search(r"(?i)\.env|config|secret|settings|\.ya?ml", path))),
    ]


def labelled_findings(n: int = FINDINGS, seed: int = 11) -> list[tuple[str, str, str, str, str, int]]:
    """(value, key name, text before, text after, path, label) of n made-up findings, half of them secrets."""
    r = random.Random(seed)
    some = lambda s, k: "".join(r.choice(s) for _ in range(k))
    hexa, upper, alnum = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    paths = ["", "src0", "src17", "app/config.yml", "tests/test_a.py", "docs/readme.md", "deploy/.env", "blog/post.html", "src/main.py"]
    talk = lambda: " ".join(r.choice(WORDS) for _ in range(3))
    letters = lambda k: some("abcdefghijklmnopqrstuvwxyz", k)
    out = []
    for i in range(n):
        value = name = ""
        before, after, path = (talk() if r.random() < 0.6 else " ".join(letters(r.randint(2, 10)) for _ in range(3))), talk(), r.choice(paths)
        if i % 2:
            kind = r.randrange(8)
            if kind == 0:
                value = r.choice(["AKIA", "AKIA", "ASIA"]) + some(upper, 16)
            elif kind == 1:
                name, value = r.choice(["password", "passwd", "pwd", "PASSWORD"]), some(hexa, r.choice([12, 16, 18, 20]))
            elif kind == 2:
                value, before = some(hexa, r.choice([32, 40, 64])), before + " " + r.choice(["auth token", '"token":', *(k + mark for k in ("token", "secret", "api_key", "access_key", "credential") for mark in (" =", ":", " :"))])
            elif kind == 3:
                name, value = r.choice(["api_key", "apikey", "API_KEY", "secret", "access_token", "token"]), some(alnum, r.choice([20, 24, 32, 40]))
            elif kind == 4:
                value = r.choice(["ghp_", "sk-", "xoxb-"]) + some(alnum, r.choice([24, 36]))
            elif kind == 5:
                name, value = "password", r.choice(WORDS).title() + some("0123456789", 4) + r.choice("!@_-") + some(alnum, 4)
            elif kind == 6:
                value, before = some(alnum + "+/", 40), before + r.choice([" secret key =", " aws_secret_access_key ="])
            else:
                value = "eyJ" + some(alnum, 30) + "." + some(alnum, 40)
        else:
            kind = r.randrange(12)
            if kind == 0:
                value = some("0123456789", r.choice([8, 10, 12, 13, 16]))
            elif kind == 1:
                value = ".".join(str(r.randrange(256)) for _ in range(4))
            elif kind == 2:
                value, before = some(hexa, r.choice([7 + 1, 32, 40, 64])), before + r.choice([" commit", " sha256", " checksum", " md5", " revision", " etag:", " build"])
            elif kind == 3:
                value = str(uuid.UUID(int=r.getrandbits(128)))
            elif kind == 4:
                name, value = r.choice(["password", "token", "api_key"]), r.choice(["changeme123", "your_token_here", "example1234", "xxxxxxxxxxxx", "placeholder1", "<password1>", "dummy-token-0"])
            elif kind == 5:
                value = f"{r.randint(1990, 2030)}-{r.randint(1, 12):02d}-{r.randint(1, 28):02d}" + r.choice(["", "T10:00:00Z"])
            elif kind == 6:
                value = "+" + some("0123456789", 2) + "-" + some("0123456789", 3) + "-" + some("0123456789", 7)
            elif kind == 7:
                value = "/".join(r.choice(WORDS) for _ in range(3)) + some("0123456789", 2) + r.choice([".html", ".png", ".py", ""])
            elif kind == 8:
                value = r.choice(WORDS) + letters(r.randint(4, 9)) + some("0123456789", r.choice([1, 2, 4]))
            elif kind == 9:
                name, value = r.choice(["id", "order", "version", "page", "width", "ref", "lang"]), r.choice([some("0123456789", 8), r.choice(WORDS) + some("0123456789", 6), f"{r.randint(0, 9)}.{r.randint(0, 99)}.{r.randint(0, 9999)}"])
            elif kind == 10:
                value = letters(r.randint(3, 8)) + some("0123456789", 2) + "@" + r.choice(WORDS) + letters(3) + ".com"
            else:
                value = "-".join([letters(r.randint(3, 9)) for _ in range(3)] + [some("0123456789", 2)])
        out.append((value, name, before, after, path, i % 2))
    return out


def train(findings: list[tuple[str, str, str, str, str, int]] | None = None, lexicon: Lexicon | None = None) -> RandomForest:
    """A forest of labelled findings, which carries the dictionary that its features are made with."""
    findings = labelled_findings() if findings is None else findings
    lexicon = lexicon or Lexicon(dict.fromkeys(WORDS, 1))
    x = np.array([features(v, k, b, a, p, lexicon) for v, k, b, a, p, _ in findings])
    forest = RandomForest().fit(x, np.array([f[-1] for f in findings], float))
    forest.lexicon = lexicon
    return forest


def scan_rows(column: pa.Array, paths: list[str | None], forest: RandomForest, threshold: float) -> Iterator[tuple[int, int, int, str, float]]:
    """(row, first and last byte + 1 in the UTF-8 text, value, score) of the findings that the forest keeps."""
    data, offs = text_buffers(column)
    for i, j in doc_slices(offs):
        d, o = data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        starts, ends, first = words(d, o)
        if not len(starts):
            continue
        marks = np.concatenate(([0], np.cumsum(INTEREST[d], dtype=np.int64)))
        caps = np.concatenate(([0], np.cumsum(CAPITAL[d], dtype=np.int64)))
        hits = np.flatnonzero(((marks[ends] > marks[starts]) | (caps[ends] - caps[starts] >= 12)) & (ends - starts >= LEAST))
        if not len(hits):
            continue
        doc = np.searchsorted(first, hits, "right") - 1
        raw, found, x = d.tobytes(), [], []
        for h, r in zip(hits.tolist(), doc.tolist(), strict=True):
            # 816 bytes hold 200 characters
            head = lambda a, b: raw[starts[a] : min(ends[b], starts[a] + 816)].decode("utf-8", "replace")[:200] if a <= b else ""  # noqa: B023, E731
            tail = lambda a, b: raw[max(starts[a], ends[b] - 816) : ends[b]].decode("utf-8", "replace")[-200:] if a <= b else ""  # noqa: B023, E731
            word = raw[starts[h] : ends[h]].decode("utf-8", "replace")
            byte = None if word.isascii() else np.flatnonzero((d[starts[h] : ends[h]] & 0xC0) != 0x80)
            for value, at, name, before, after in candidates(word, tail(max(first[r], h - 3), h - 1), head(h + 1, min(h + 2, first[r + 1] - 1))):
                begin = int(starts[h]) + int(at if byte is None else byte[at])
                found.append((i + r, begin - int(o[r]), begin - int(o[r]) + len(value), value))
                x.append(features(value, name, before, after, paths[i + r] or "", forest.lexicon))
        if found:
            kept = [(*f, s) for f, s in zip(found, forest.predict(np.array(x)).tolist(), strict=True) if s >= threshold]
            row = end = -1
            for f in sorted(kept, key=lambda f: (f[0], f[1], -f[2])):
                if f[0] != row or f[1] >= end:
                    row, end = f[0], f[2]
                    yield f


FOUND = "doc_id long, start long, end long, length long, score double, secret_sha256 string"


def find_secrets(docs: DataFrame, forest: RandomForest | None = None, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """doc_id, start and end (bytes of the UTF-8 text), length, score, secret_sha256 of each secret."""
    sent = docs.sparkSession.sparkContext.broadcast(forest or train(lexicon=learn(docs, text_col)))
    path = F.col(path_col).cast("string") if path_col else F.lit("")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, out = b.column(0).to_pylist(), []
            for row, s, e, value, score in scan_rows(b.column(1), b.column(2).to_pylist(), sent.value, threshold):
                out.append((ids[row], s, e, e - s, score, hashlib.sha256(value.encode()).hexdigest()))
            cols = list(zip(*out, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(),) * 4 + (pa.float64(), pa.string()), strict=True)], names=["doc_id", "start", "end", "length", "score", "secret_sha256"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), path.alias("path")).mapInArrow(run, FOUND)


def redact(docs: DataFrame, forest: RandomForest | None = None, threshold: float = THRESHOLD, text_col: str = "text", path_col: str | None = "source", mark: str = "[secret]") -> DataFrame:
    """The same rows and columns, with each secret of the text replaced by `mark`."""
    sent = docs.sparkSession.sparkContext.broadcast(forest or train(lexicon=learn(docs, text_col)))
    names = docs.columns
    at = names.index(text_col)
    where = names.index(path_col) if path_col else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            paths = b.column(where).cast(pa.string()).to_pylist() if where is not None else [""] * len(b)
            by: dict[int, list] = {}
            for row, s, e, *_ in scan_rows(b.column(at), paths, sent.value, threshold):
                by.setdefault(row, []).append((s, e))
            if by:
                text = b.column(at).to_pylist()
                for row, spans in by.items():
                    raw, out, last = text[row].encode(), [], 0
                    for s, e in sorted(spans):
                        out += [raw[last:s], mark.encode()]
                        last = e
                    text[row] = b"".join([*out, raw[last:]]).decode("utf-8", "replace")
                b = b.set_column(at, names[at], pa.array(text, b.column(at).type))
            yield b

    return docs.mapInArrow(run, docs.schema)
