"""Rank-queue BPE, lexical search and periodic runs against plain versions, with nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import base64
import collections
import hashlib
import math
import random
import re
import uuid
import zlib
from array import array

import numpy as np
import pytest
from pyspark.sql import functions as F

P = pytest.importorskip("public_tokenizers")
from tomeworks.llm import bpe, lexical_search, rank_bpe, runs  # noqa: E402

#: Columns of the operators' own names beside id and text.
CLASH = ("n_tokens", "ids", "item", "item_id", "score", "rank", "terms", "start", "length", "period", "n_runs", "shard", "h")


def clash(*but):
    return {c: F.lit("x") for c in CLASH if c not in but}


def sha(b):
    return hashlib.sha256(b).hexdigest()


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import tiktoken

    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def nasty():
    rng = random.Random(4)
    few = "abcdeéßЖ中😀 \n\t'sλ12-_<|>"
    out = ["", " ", "a" * 5000, "ab" * 3000, "\0\x01\x7f" * 50, "don't we'll", "<|endoftext|>", " x　y", "".join(rng.choice("abcdefgh") for _ in range(200_000)), "語" * 40_000]
    out += ["".join(rng.choice(few) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    out += ["".join(chr(rng.choice([rng.randint(32, 126), rng.randint(160, 0x2FFF), rng.randint(0x10000, 0x1FFFF)])) for _ in range(40)) for _ in range(200)]
    return out


def test_op11(spark, tiktoken_encoding):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    rows = [*enumerate(nasty()), (None, "null id"), (None, None), (7, None), (3, "one id, two texts"), (3, "one id, two texts")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(clash())
    want = []
    for i, t in rows:
        ids = tiktoken_encoding.encode_ordinary(t or "")
        want.append((i, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())))
    assert sorted(map(tuple, rank_bpe.round_trip(docs, path).collect()), key=str) == sorted(want, key=str)
    encoded = rank_bpe.encode_documents(docs, path)
    assert sorted(sha(",".join(map(str, r["ids"])).encode()) for r in encoded.collect()) == sorted(w[2] for w in want)
    back = rank_bpe.decode_documents(encoded, path).collect()
    assert sorted(bytes(r["content"]) for r in back) == sorted((t or "").encode() for _, t in rows)
    assert rank_bpe.round_trip(docs.where("false"), path).count() == 0


def test_op11_spans(tiktoken_encoding, monkeypatch):
    monkeypatch.setattr(bpe, "SPAN", 50)
    monkeypatch.setattr(bpe, "KEPT", 20)
    t = "\n".join(nasty()[10:])
    assert rank_bpe.RankCodec(P.path("byte_bpe_multi_50k.tiktoken")).encode(t).tolist() == tiktoken_encoding.encode_ordinary(t)


def test_op11_any_ranks(tmp_path):
    """Ranks in any order, so that a merge can bring up a lower rank than its own: always the least, and of equal ones the first."""
    rng = random.Random(9)
    for turn in range(40):
        tokens = [bytes((b,)) for b in range(256)]
        while len(tokens) < 300:
            t = b"".join(rng.choice((b"a", b"b", b"c")) for _ in range(rng.randint(2, 5)))
            if t not in tokens:
                tokens.append(t)
        head = tokens[256:]
        rng.shuffle(head)
        ranks = {t: r for r, t in enumerate([*head, *tokens[:256]])}
        file = tmp_path / f"{turn}.tiktoken"
        file.write_text("".join(f"{base64.b64encode(t).decode()} {r}\n" for t, r in ranks.items()))
        own = rank_bpe.RankCodec(str(file))
        words = [b"".join(rng.choice((b"a", b"b", b"c")) for _ in range(rng.randint(1, 30))) for _ in range(20)]
        ids, at = own.merge(words)
        for n, w in enumerate(words):
            parts = [w] if w in ranks else [bytes((x,)) for x in w]
            while True:
                some = [(ranks[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]
                if not some or w in ranks:
                    break
                k = min(some)[1]
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
            assert ids[at[n] : at[n + 1]].tolist() == [ranks[p] for p in parts]


def test_rank_queue():
    rng = np.random.default_rng(0)
    ranks = rng.integers(-1, 5000, 3000)
    q = rank_bpe.RankQueue(ranks)
    for r, at in ((70_000, 5), (4, 9), (4, 2), (262_143, 1)):
        q.push(r, at)
    want = collections.defaultdict(list)
    for at, r in [*enumerate(ranks.tolist()), (5, 70_000), (9, 4), (2, 4), (1, 262_143)]:
        if r >= 0:
            want[r].append(at)
    got = []
    while (x := q.pop()) is not None:
        got.append(x)
    assert got == [(r, sorted(want[r])) for r in sorted(want)]


def terms(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def plain_ranking(docs, items, k):
    held = [(i, collections.Counter(terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n, total = len(held), sum(x[2] for x in held)
    df = collections.Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, size in held:
            m = 50 + 50 * size * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def corpus():
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(60)] + ["É", "ß9", "x_y", "Straße", "日本"]
    weights = [1 / (1 + k) for k in range(len(vocabulary))]
    docs = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.choice((0, 1, 5, 30, 200))))) for i in rng.sample(range(-500, 1000), 300)]
    docs += [(5000, None), (5001, ""), (5002, "?!"), (None, docs[3][1] + " w3"), (None, docs[3][1] + " w3"), (5003, "W3 " * 30_000), (9, "w5 w6 w7"), (9, "w5 w6 w7"), (8, "w5 w6 w7"), (5004, "w3")]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.randint(1, 40)))) for k in range(25)]
    items += [(30, None), (31, ""), (32, "nowhere"), (33, "W3 w3"), (33, "W3 w3"), (34, "w5"), (34, "w6 w7"), (None, "w8 straße")]  # two texts of one id, and a null one
    return docs, items


@pytest.mark.parametrize("block,span,segment,words", [(128, 256, 2_000_000, 2_000_000), (4, 8, 300, 2_000_000), (3, 500, 2000, 60)])
def test_op12(spark, monkeypatch, block, span, segment, words):
    for name, value in (("BLOCK", block), ("SPAN", span), ("SEGMENT_TERMS", segment)):
        monkeypatch.setattr(lexical_search, name, value)
    rows, queries = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(clash()).repartition(3)
    items = spark.createDataFrame(queries, "item_id long, text string").withColumns(clash("item_id"))
    want_of = list(dict.fromkeys(queries))
    index = lexical_search.build_index(docs, f"{lexical_search.shared_dir(spark)}/test-{uuid.uuid4().hex}")
    for k in (3, 50):
        got = lexical_search.search(index, items, k, block_words=words).collect()
        assert sorted(map(tuple, got), key=str) == plain_ranking(rows, want_of, k)
    lexical_search.discard(index)
    assert lexical_search.rank_documents(docs.where("false"), items).count() == 0
    assert lexical_search.rank_documents(docs, items.where("false")).count() == 0


def test_op12_skips():
    """Ranges below the threshold are skipped without decompression."""
    rng = np.random.default_rng(1)
    lengths = np.full(20_000, 10)
    lengths[:60] = 11
    hashes = np.concatenate([np.concatenate((rng.integers(10, 4000, n - (n > 10)), np.full(int(n > 10), 5))) for n in lengths]).astype(np.uint64)
    import pyarrow as pa

    row = lexical_search.build_segment([pa.array(np.arange(20_000))], lengths, hashes, (20_000, int(lengths.sum())))
    seg = lexical_search.open_segment(row[2:])
    want = np.array([5, 17, 18, 19], np.uint64)
    best = lexical_search.Best(50)
    lexical_search.search_segment(seg, np.searchsorted(seg.terms, want), np.array([9000, 10, 10, 10]), best)
    assert (np.sort(best.doc) < 60).all() and len(best.doc) == 50
    blocks = sum(int(seg.block[t + 1] - seg.block[t]) for t in np.searchsorted(seg.terms, want))
    assert len(seg.opened) < blocks


def test_posting_blocks():
    rng = np.random.default_rng(2)
    doc = np.cumsum(rng.integers(1, 5, 1000))
    doc[300:] += 300
    doc[700:] += 100_000
    tf = rng.choice([1, 1, 2, 300, 70_000], 1000)
    head = np.array([0, 1, 128, 256, 299, 500, 699, 800])
    data, shape = lexical_search.encode_blocks(doc, tf, head)
    zeros = np.zeros(0)
    seg = lexical_search.Segment(zeros, np.ones(8, np.int64), zeros, zeros, np.full(doc[-1] + 1, 60), doc[head], doc[head], zeros, shape, data)
    seg.size = np.diff(np.append(head, 1000))
    seg.at = np.concatenate(([0], np.cumsum(seg.size * (lexical_search.WIDTHS[shape >> 2] + lexical_search.WIDTHS[shape & 3]))))
    for b in range(8):
        d, impact = seg.open(b)
        own = slice(head[b], head[b] + seg.size[b])
        assert d.tolist() == doc[own].tolist()
        assert impact.tolist() == lexical_search.impacts(tf[own], np.full(seg.size[b], 60)).tolist()


def plain_runs(w, least=6, times=4):
    best = {}
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j - i + p >= max(least, times * p):
                best.setdefault((i, j - i + p), p)
            i = max(j, i + 1)
    return sorted(((s, n, p) for (s, n), p in best.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("direct", [8, 1])
def test_runs(monkeypatch, direct):
    monkeypatch.setattr(runs, "DIRECT", direct)
    monkeypatch.setattr(runs, "WIDE", 40)
    rng = random.Random(3)
    for _ in range(3000):
        w = [rng.randrange(rng.choice((1, 2, 3, 5))) for _ in range(rng.randint(0, 60))]
        if w and rng.random() < 0.6:
            a, p = rng.randrange(len(w)), rng.randint(1, 9)
            w = w[:a] + (w[a : a + p] * 60)[: len(w) - a]
        for least, times in ((6, 4), (2, 2), (3, 3)):
            assert runs.find_runs(array("i", w), least, times) == plain_runs(w, least, times)
    assert runs.find_runs(array("i", [0] * 300_000)) == [(0, 300_000, 1)]
    w = array("i", [*range(200)] * 5 + [3] * 300 + [*range(50)] * 20)
    assert runs.find_runs(w) == plain_runs(w)


def test_number_words(monkeypatch):
    t = "ä b\tb\x0b\x0cc  x\n\n ä".encode()
    for chunk in (1 << 20, 1, 3):
        monkeypatch.setattr(runs, "CHUNK", chunk)
        ids, words = runs.number_words(t)
        assert [words[i] for i in ids] == t.split()
    assert runs.number_words(b" \n") == (array("i"), [])


def plain_op13(doc_id, text):
    w = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len((text or "").encode().split())
    if doc_id is not None and h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = plain_runs(w)
    gone = {i for s, size, p in found for i in range(s + p, s + size)}
    top = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2])) if found else None
    told = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    return doc_id, len(found), *told, sha("".join(f"{s},{size},{p}\n" for s, size, p in found).encode()), sha(b" ".join(x for i, x in enumerate(w) if i not in gone))


def test_op13(spark):
    rng = random.Random(5)
    line = "buy now and save " * 9
    texts = [None, "", " \n", "one", "x " * 5, "x " * 6, "x " * 2000, "a b " * 4, "é ß " * 3 + "é", line, "intro " + line + "x x x x x x x " + line, "word" * 50_000, "a a a a a a b b b b b b"]
    texts += [" ".join(rng.choice("abcdef") for _ in range(rng.randint(0, 300))) for _ in range(60)]
    rows = [*enumerate(texts), (None, line), (None, None), (3, line), (3, line)]
    rows += [(i, " ".join(f"w{rng.randrange(50)}" for _ in range(rng.randint(1, 200)))) for i in range(100, 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(clash())
    got = sorted(map(tuple, runs.periodic_runs(docs, planted=True).collect()), key=str)
    assert got == sorted((plain_op13(*r) for r in rows), key=str)
    assert sum(r[1] > 0 for r in got) > 20
    assert runs.periodic_runs(docs.where("false"), planted=True).count() == 0
    each = collections.Counter(map(tuple, runs.run_table(docs).collect()))
    assert each == collections.Counter((i, *r) for i, t in rows for r in plain_runs((t or "").encode().split()))
    kept = {(r["doc_id"], r["text"]) for r in runs.collapse(docs).where("doc_id in (9, 1) or text is null").collect()}
    assert kept == {(9, "buy now and save"), (1, ""), (0, None), (None, None)}
    assert runs.collapse(docs).columns == docs.columns
