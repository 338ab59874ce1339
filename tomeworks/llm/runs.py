"""Periodic runs of words by the Lyndon stack.

A run is a stretch of words with a smallest period that no neighbouring word extends. Each run of at least two periods has a
root that is the longest Lyndon word at its place under an order of the words or under the reverse order. A stack
scanned from right to left gives, for each place, the end of the longest Lyndon word that starts there: the next place with a smaller suffix. Suffixes
are compared word by word, and where many words are equal by rolling hashes: the length of the longest common extension is found by binary
search. Places whose word repeats are extended to both sides in the same way, and what is found is verified on the words themselves.
There is no suffix array, and each text is handled by itself in one pass over the table without a shuffle.

Words are numbered within their text by a dictionary of the words, so equal numbers are equal words; hashes serve only to compare stretches of numbers.

Defined results: null and empty texts have no words, no runs, four nulls, and the digest of nothing; a text of any length is
handled whole, in memory of some 40 bytes a word; of equally repeated runs the first, then the one of least period is reported;
repeated rows and null ids are rows like any other; an empty table gives no rows; only ids and texts are read, so further columns play no part.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rolling hashes are polynomials over this prime with this base.
PRIME, BASE = (1 << 61) - 1, 0x1B873593CC9E2D51 % ((1 << 61) - 1)
#: Equal words that are compared one by one before hashes are asked.
DIRECT = 8
#: Bytes of text that are split into words at once.
CHUNK = 1 << 20
#: Words from which on ends are held in four bytes each instead of a list, which is faster.
WIDE = 1 << 20
SPACES = b" \t\n\v\f\r"


def number_words(text: bytes) -> tuple[array, list[bytes]]:
    """The words [^\\x20\\x09-\\x0D]+ of a text as numbers, and the word of each number."""
    ids, seen, at = array("i"), {}, 0
    while at < len(text):
        end = min(len(text), at + CHUNK)
        while end < len(text) and text[end] not in SPACES:  # a word is cut nowhere
            end += 1
        ids.extend([seen.setdefault(w, len(seen)) for w in text[at:end].split()])
        at = end
    return ids, list(seen)


class Extensions:
    """Longest common extensions of two places of a sequence; hashes are made when they are first needed."""

    def __init__(self, w: array):
        self.w, self.n, self.sums = w, len(w), None

    def _hashes(self) -> None:
        self.sums = array("q", accumulate(self.w, lambda h, x: (h * BASE + x + 1) % PRIME, initial=0))
        self.powers = array("q", accumulate(range(self.n), lambda p, _: p * BASE % PRIME, initial=1))

    def same(self, i: int, j: int, k: int) -> bool:
        """Whether the k words from i and those from j have one hash."""
        s, p = self.sums, self.powers[k]
        return (s[i + k] - s[i] * p - s[j + k] + s[j] * p) % PRIME == 0

    def right(self, i: int, j: int) -> int:
        """How many words from i on equal those from j on (i < j)."""
        w, n, k = self.w, self.n, 0
        most = n - j
        while k < most and w[i + k] == w[j + k]:
            k += 1
            if k == DIRECT:
                break
        else:
            return k
        if self.sums is None:
            self._hashes()
        step = k
        while k + step <= most and self.same(i + k, j + k, step):
            k += step
            step *= 2
        while step > 1:  # the next `step` words are not all equal, or not all there
            step //= 2
            if k + step <= most and self.same(i + k, j + k, step):
                k += step
        return k

    def left(self, i: int, j: int) -> int:
        """How many words that end at i equal those that end at j (i < j)."""
        w, k = self.w, 0
        most = i + 1
        while k < most and w[i - k] == w[j - k]:
            k += 1
            if k == DIRECT:
                break
        else:
            return k
        if self.sums is None:
            self._hashes()
        step = k
        while k + step <= most and self.same(i - k - step + 1, j - k - step + 1, step):
            k += step
            step *= 2
        while step > 1:
            step //= 2
            if k + step <= most and self.same(i - k - step + 1, j - k - step + 1, step):
                k += step
        return k


def lyndon_ends(w: array, right: Callable[[int, int], int], down: bool) -> np.ndarray:
    """For each place, the end of the longest Lyndon word that starts there: the next place whose suffix is smaller, words
    ordered by their numbers, or down from the highest. A suffix is larger than its own prefixes in both orders."""
    n = len(w)
    v = [-x - 1 for x in w] if down else list(w)
    v.append(-(1 << 31))  # the end is smaller than all words
    ends, near = array("i", bytes(4 * n)), 0
    if n < WIDE:
        ends = ends.tolist()
    for i in range(n - 1, -1, -1):
        x, j = v[i], i + 1
        y = v[j]
        near = near + 1 if x == y else 0  # how far the suffix equals the next one
        while y >= x:
            if x == y:
                k = near if j == i + 1 else right(i, j)
                if v[i + k] > v[j + k]:
                    break
            j = ends[j]
            y = v[j]
        ends[i] = j
    return np.array(ends, np.int32)


def find_runs(w: array, least: int = 6, times: int = 4) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of at least `least` words and `times` periods (two or more), by start and period."""
    n = len(w)
    if n < max(least, times):
        return []
    lce, found, flat = Extensions(w), set(), np.frombuffer(w, np.int32)
    for down in (False, True):
        ends = lyndon_ends(w, lce.right, down)
        # the first root of a run is followed by times - 2 whole periods at least
        place = np.arange(n)
        period = ends - place
        for k in range(1, times - 1):
            ok = place + (k + 1) * period <= n
            place, period = place[ok], period[ok]
            ok = (flat[place] == flat[place + k * period]) & (flat[place + period - 1] == flat[place + (k + 1) * period - 1])
            place, period = place[ok], period[ok]
        reached: dict[int, int] = {}
        for i, p in zip(place.tolist(), period.tolist(), strict=True):
            if reached.get(p, 0) >= i + 2 * p:
                continue  # two runs of one period share less than a period
            right, left = lce.right(i, i + p), lce.left(i - 1, i + p - 1) if i else 0
            start, end = i - left, i + p + right
            if end - start >= 2 * p:
                reached[p] = end
            if end - start >= max(least, times * p):
                if w[start : end - p] != w[start + p : end] or (start and w[start - 1] == w[start + p - 1]) or (end < n and w[end] == w[end - p]):
                    raise ArithmeticError("two stretches of words share a hash")
                found.add((start, end - start, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def most_repeated(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length / period, the first of equal ones."""
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def kept_places(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Words that stay: all but those of a run behind its first period."""
    change = np.zeros(n + 1, np.int32)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.flatnonzero(np.cumsum(change[:n]) == 0)


def digest(words: list[bytes], ids: array, places: np.ndarray) -> str:
    """SHA-256 of the words at these places, joined by one space."""
    out, flat = hashlib.sha256(), np.frombuffer(ids, np.int32) if len(ids) else np.zeros(0, np.int32)
    for a in range(0, len(places), 1 << 16):
        out.update((b" " if a else b"") + b" ".join(map(words.__getitem__, flat[places[a : a + (1 << 16)]].tolist())))
    return out.hexdigest()


def repeat_tail(ids: array, doc_id: int | None) -> array:
    """Words of every tenth id, by its CRC-32, made periodic from a place on, which id and length say."""
    h, n = zlib.crc32(str(doc_id).encode()), len(ids)
    if doc_id is None or h % 10 or not n:
        return ids
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = ids[a : a + p]
    return ids[:a] + (unit * (-(-(n - a) // len(unit))))[: n - a]


FIELDS = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
SCHEMA = pa.schema([(f.split()[0], pa.int64() if f.endswith("long") else pa.string()) for f in FIELDS.split(", ")])


def periodic_runs(docs: DataFrame, planted: bool = False, least: int = 6, times: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_runs; start, length, period and exponent_milli of the most repeated run; digests of all runs and of the text
    without what they repeat. With `planted`, every tenth document first gets a periodic tail (see repeat_tail)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()), strict=True):
                ids, words = number_words(text.as_py() or b"")
                if planted:
                    ids = repeat_tail(ids, doc_id)
                runs = find_runs(ids, least, times)
                best = most_repeated(runs)
                told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
                lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
                out.append((doc_id, len(runs), *told, hashlib.sha256(lines.encode()).hexdigest(), digest(words, ids, kept_places(len(ids), runs))))
            columns = list(zip(*out, strict=True)) or [()] * len(SCHEMA)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, SCHEMA.types, strict=True)], schema=SCHEMA)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, FIELDS)


def run_table(docs: DataFrame, least: int = 6, times: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start, length, period: one row for each run."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()), strict=True):
                runs = find_runs(number_words(text.as_py() or b"")[0], least, times)
                columns = list(zip(*runs, strict=True)) or [()] * 3
                yield pa.RecordBatch.from_arrays([pa.array([doc_id] * len(runs), pa.int64()), *(pa.array(c, pa.int64()) for c in columns)], schema=schema)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, start long, length long, period long")


def collapse(docs: DataFrame, least: int = 6, times: int = 4, text_col: str = "text") -> DataFrame:
    """The same rows with runs cut down to one period and words joined by one space; null stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index(text_col)
            out = []
            for text in b.column(at).cast(pa.binary()):
                ids, words = number_words(text.as_py() or b"")
                keep = kept_places(len(ids), find_runs(ids, least, times))
                out.append(b" ".join(words[ids[i]] for i in keep.tolist()) if text.is_valid else None)
            yield b.set_column(at, b.schema.field(at), pa.array(out, pa.binary()).cast(b.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)


#: The same rows in DuckDB's SQL, from equal triples of words of one text at each distance: for small tables.
SQL = r"""
WITH b AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
    xor(4294967295, list_reduce([4294967295] || flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ord(c), -1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])),
        lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) ELSE xor(x >> 1, 3988292384 * (x & 1)) END)) AS h FROM documents),
g AS (SELECT doc_id, ws, len(ws) AS n, h % 10 = 0 AND len(ws) > 0 AS made, h // 10 AS g FROM b),
a AS (SELECT *, CASE WHEN made THEN g % n END AS a FROM g),
p AS (SELECT *, CASE WHEN made THEN 1 + (n - a) // (3 + g % 8) END AS p FROM a),
w AS (SELECT doc_id, n, unnest(range(n)) AS i, unnest(CASE WHEN made THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN ws[i + 1] ELSE ws[a + (i - a) % p + 1] END) ELSE ws END) AS word FROM p),
t AS (SELECT doc_id, n, i, word || ' ' || lead(word) OVER d || ' ' || lead(word, 2) OVER d AS t FROM w WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
e AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM t x JOIN t y ON x.doc_id = y.doc_id AND x.t = y.t AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
s AS (SELECT doc_id, q, min(i) AS s, count(*) + 2 + q AS len FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM e) GROUP BY doc_id, q, k),
r AS (SELECT doc_id, s, len, min(q) AS q FROM s WHERE len >= greatest(6, 4 * q) GROUP BY doc_id, s, len),
o AS (SELECT doc_id, count(*) AS n_runs, sha256(string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q)) AS sha FROM r GROUP BY 1),
m AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY len::DOUBLE / q DESC, s, q) = 1),
x AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + len)) AS i FROM r),
k AS (SELECT doc_id, sha256(string_agg(word, ' ' ORDER BY i)) AS sha FROM w ANTI JOIN x USING (doc_id, i) GROUP BY 1)
SELECT p.doc_id, coalesce(o.n_runs, 0)::BIGINT AS n_runs, m.s::BIGINT AS start, m.len::BIGINT AS length, m.q::BIGINT AS period, ((1000 * m.len) // m.q)::BIGINT AS exponent_milli,
    coalesce(o.sha, sha256('')) AS runs_sha256, coalesce(k.sha, sha256('')) AS collapsed_sha256
FROM p LEFT JOIN o USING (doc_id) LEFT JOIN m USING (doc_id) LEFT JOIN k USING (doc_id)
"""
