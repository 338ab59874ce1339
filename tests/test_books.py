"""The plans from pages to records, and from records back to files; layouts of vectors."""

import json
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tomeworks import cli
from tomeworks.operators import keywords, projection
from tomeworks.plans import books, normalise
from tomeworks.providers import base
from tomeworks.sources import run_log

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors can't import this file


class Broken:
    name = "broken"

    def __call__(self, request):
        raise ValueError("down")


class Fenced:
    name = "fenced"

    def __call__(self, request):
        return '```json\n{"title": "T", "author": "Ann", "unknown": 1}\n```'


class Prose:
    name = "prose"

    def __call__(self, request):
        return "I can't tell."


class Shelf:
    name = "shelf"

    def __call__(self, request):
        return json.dumps({"source": "shelf", "query": "q", "result_count": 1, "items": [{"title": "other", "publisher": "Press", "isbn_identifiers": ["1"]}]})


class Label:
    name = "label"

    def __call__(self, request):
        words = json.loads(request)
        return '"Dark Magic"\nbecause' if len(words) > 1 else None


class Shout:
    name = "shout"

    def __call__(self, image):
        return image.upper() or None


for c in (Broken, Fenced, Prose, Shelf, Label, Shout):
    base.register(c.name, c)


@pytest.fixture
def docs(spark):
    pages = spark.createDataFrame(
        [(1, 1, [("native", "Dune\nsandworms everywhere")]), (1, 2, [("native", " ")]), (1, 3, [("native", "a desertplanet"), ("scan", "x")]), (2, 1, [("native", None)]), (3, 1, [])],
        "doc int, page_number int, results array<struct<method:string,text:string>>",
    )
    d = books.documents(pages)
    return d.withColumns({"pdf_hash": F.concat(F.lit("h"), "doc"), "path": F.concat(F.lit("/b/"), "doc", F.lit(".pdf")), "info": F.create_map(F.lit("producer"), F.lit("scan"))})


def results(df):
    return {r["doc"]: (json.loads(r["result"]) if r["result"] else None, r["error"]) for r in df.collect()}


def test_full_run(docs):
    got = results(books.run(docs, base.PipelineConfig(extractor="outline", search_methods=("shelf", "broken"))))
    record, error = got[1]
    assert error is None and record["title"] == "Dune" and record["publisher"] == "Press" and record["isbn_identifiers"] == ["1"]
    assert record["keywords"] == ["desertplanet", "everywhere", "sandworms"]
    assert got[2] == got[3] == (None, "no text on any page")


def test_search(docs):
    found = lambda n: books.search(books.extract(docs, c := base.PipelineConfig(extractor="outline", search_methods=("naive", "broken", "shelf"), max_results=n)), c)
    for n in (0, 3):
        got = {r["doc"]: r["candidates"] for r in found(n).collect()}
        assert [c["method"] for c in got[1]] == ["naive", "shelf"] and got[2] == got[3] == []
        payload = json.loads(got[1][0]["payload"])
        assert payload["query"] == "Dune" and payload["result_count"] == len(payload["items"]) == min(n, 1)


def test_modes_and_replies(docs):
    got = results(books.run(docs, base.PipelineConfig(extractor="fenced"), "bookinfo"))
    assert got[1][0]["author"] == ["Ann"] and got[1][0]["title"] == "T"
    assert results(books.run(docs, base.PipelineConfig(extractor="prose")))[1] == (None, "the reply is not a record")
    assert "down" in results(books.run(docs, base.PipelineConfig(extractor="broken"), attempts=1))[1][1]
    with pytest.raises(ValueError):
        books.run(docs, base.PipelineConfig(), "other")
    with pytest.raises(ValueError):
        books.run(docs, base.PipelineConfig(extractor="none"))


def test_blocks_and_ocr(spark, docs):
    config = base.PipelineConfig(limits=base.ContextLimits(first_pages=1, last_pages=1))
    b = books.blocks(docs.where("doc = 1"), "Read.", config).select("blocks", books.block_text(F.col("blocks")).alias("t")).first()
    assert [x.split("\n")[0] for x in b["blocks"]["ocr"]] == ["PAGE: 1 OCR USING METHOD: native", "PAGE: 3 OCR USING METHOD: native", "PAGE: 3 OCR USING METHOD: scan"]
    assert b["t"].startswith("Read.\n\n/b/1.pdf\n\nProducer: scan\n\nPAGE: 1")
    pages = spark.createDataFrame([(1, 1, "ab"), (1, 2, ""), (1, 3, None)], "doc int, page_number int, image string")
    got = {r["page_number"]: [tuple(x) for x in r["results"]] for r in books.ocr_results(pages, ["shout", "broken", "echo"], attempts=1).collect()}
    assert got == {1: [("shout", "AB"), ("echo", "ab")], 2: [], 3: []}


def test_batch_keeps_a_log(spark, docs, tmp_path):
    log, config = str(tmp_path / "log"), base.PipelineConfig(extractor="outline")
    status = lambda c, **k: sorted((r["pdf_hash"], r["status"]) for r in books.run_batch(docs, c, log, **k).collect())
    assert status(config) == [("h1", "processed"), ("h2", "failed"), ("h3", "failed")]
    assert status(config)[0] == ("h1", "cached")
    assert status(config, prompt="Read it.")[0] == ("h1", "processed")
    assert run_log.parsed(run_log.read_runs(spark, log)).select("title").distinct().first()["title"] == "Dune"


def test_normalise_and_write(spark, tmp_path):
    runs = [("a.pdf", "h1", {"title": "A", "author": ["X", "Y"], "publisher": "Paizo Inc", "keywords": ["Dungeon", "dungeons", ""], "isbn_identifiers": ["978-0-306-40615-7"]}, 1), ("b.pdf", "h2", {"title": "B", "publisher": "Paizo", "keywords": []}, 2), ("c.pdf", "h3", {"title": None}, 3)]
    rows = run_log.parsed(spark.createDataFrame([(n, h, "{}", json.dumps(r), t) for n, h, r, t in runs], "pdf_name string, pdf_hash string, pipeline_config string, result string, t int").withColumn("run_timestamp", F.timestamp_seconds("t")).drop("t"))
    words = normalise.distinct_keywords(rows)
    assert sorted(r["keyword"] for r in words.collect()) == ["dungeon", "dungeons"]
    assert {r["keyword"]: r["label"] for r in normalise.canonical_keywords(words, distance=0.5).collect()} == {"dungeon": "dungeon", "dungeons": "dungeon"}
    assert {r["label"] for r in normalise.canonical_keywords(words, clusters=1, labeller="label").collect()} == {"dark magic"}
    mapping = normalise.canonical_keywords(words, clusters=2, labeller="label")
    assert {r["keyword"]: r["label"] for r in mapping.collect()} == {"dungeon": "dungeon", "dungeons": "dungeons"}
    out = normalise.normalised(rows, normalise.canonical_keywords(words, distance=0.5))
    normalise.save(out, str(tmp_path / "normal"))
    got = {r["pdf_hash"]: r for r in normalise.load(spark, str(tmp_path / "normal")).collect()}
    assert got["h1"]["canonical_keywords"] == ["dungeon"] and got["h1"]["canonical_publisher"] == got["h2"]["canonical_publisher"] == "Paizo"
    assert got["h3"]["canonical_keywords"] == [] and got["h1"]["entity"]["authors"] == ["X"] and got["h1"]["entity"]["isbn_13"] == "9780306406157"

    root = tmp_path / "books"
    (root / "sub").mkdir(parents=True)
    found = spark.createDataFrame([(f"file:{root}/sub/a.pdf", "h1", "zz.pdf"), (f"file:{root}/b.pdf", "other", "b.pdf"), (f"file:{root}/d.pdf", "h9", "d.pdf")], "path string, file_hash string, file_name string")
    meta = out.select(F.col("pdf_hash").alias("file_hash"), F.col("pdf_name").alias("file_name"), "entity", F.col("run_timestamp").alias("order"))
    for want in ("done", "exists"):
        status = {r["path"].split("/")[-1]: r["status"] for r in normalise.write_sidecars(found, meta, str(root), str(root)).collect()}
        assert status == {"a.pdf": want, "b.pdf": want, "d.pdf": "no metadata"}
    payload = json.loads((root / "__normalized__/sub/a.pdf.json").read_text())
    assert payload["publisher"] == "Paizo" and payload["categories"] == ["dungeon"] and "description" not in payload
    assert "<dc:title>" in (root / "__normalized__/b.pdf.xmp").read_text()
    (tmp_path / "file").write_text("")
    bad = normalise.write_sidecars(found, meta, str(root), str(tmp_path / "file"))
    normalise.failures(bad, str(tmp_path / "failed"))
    assert spark.read.text(str(tmp_path / "failed")).count() == 2


def test_cells(spark):
    v = spark.createDataFrame([(f"k{i}", [float(i % 3), float(i % 3 == 0)]) for i in range(60)], "keyword string, embedding array<float>")
    assert normalise.cells(v, 60, 100).select("cell").distinct().count() == 1
    got = normalise.cells(v, 60, 15)
    assert got.count() == 60 and got.groupBy("cell").count().agg(F.max("count")).first()[0] < 30


def test_ward():
    x = np.array([[0, 0], [0, 1], [5, 5], [5, 6], [20, 0]], float)
    assert keywords.average_linkage(x, clusters=3, linkage="ward").tolist() == [0, 0, 1, 1, 2]
    assert keywords.average_linkage(x, distance=1.5, linkage="ward").tolist() == [0, 0, 1, 1, 2]
    assert keywords.average_linkage(x, distance=0.5, linkage="ward").tolist() == [0, 1, 2, 3, 4]


def groups():
    r = np.random.default_rng(0)
    return np.vstack([r.normal(c, 0.3, (40, 6)) for c in (np.eye(6) * 4)[:3]] + [r.uniform(-9, 9, (6, 6))])


def test_density_clusters():
    got = projection.hdbscan(groups(), 15, 5)
    assert [set(got[i : i + 40]) for i in (0, 40, 80)] == [{0}, {1}, {2}] and set(got[120:]) == {-1}
    assert set(projection.hdbscan(groups()[:10], 15)) == {-1} and len(projection.hdbscan(np.zeros((0, 2)), 5)) == 0
    assert set(projection.hdbscan(np.zeros((40, 2)), 5)) <= {-1, 0, 1, 2, 3, 4, 5, 6, 7}


@pytest.mark.parametrize("layout", [lambda x: projection.tsne(x, 15), lambda x: projection.umap(x, 10, metric="euclidean")])
def test_layouts(layout):
    y = layout(groups()[:120])
    assert np.array_equal(y, layout(groups()[:120])) and np.isfinite(y).all()
    near = projection.distances(y) + np.diag(np.full(120, np.inf))
    same = (near.argmin(1) // 40) == np.arange(120) // 40
    assert same.mean() > 0.95
    for n in (0, 1, 2, 5):
        assert layout(np.ones((n, 3))).shape == (n, 2)


def test_cluster_map(spark):
    df = spark.createDataFrame([("b", i, [float(v) for v in row]) for i, row in enumerate(groups()[:120])] + [("c", 900, [1.0] * 6), ("c", 901, None)], "block string, item int, v array<double>")
    got = projection.cluster_map(df, "block", "item", "v", 10, 15, "pca", "euclidean").toPandas().set_index("item")
    assert len(got) == 121 and got.loc[900, "cluster_id"] == -1 and got.loc[range(120), "cluster_id"].nunique() >= 2
    with pytest.raises(ValueError):
        projection.cluster_map(df, "block", "item", "v", layout="other")


def test_commands(spark, tmp_path, capsys):
    pages = spark.createDataFrame([("h1", "/b/a.pdf", 1, [("native", "Dune\nsandworms")])], "pdf_hash string, path string, page_number int, results array<struct<method:string,text:string>>")
    pages.write.parquet(str(tmp_path / "pages"))
    log, out = str(tmp_path / "log"), str(tmp_path / "normal")
    for want in ("processed 1", "cached 1"):
        assert cli.main(["run", str(tmp_path / "pages"), "--log", log, "--extractor", "outline", "--search", "naive"]) == 0
        assert want in capsys.readouterr().out
    assert cli.main(["show", log]) == 0 and '"title": "Dune"' in capsys.readouterr().out
    assert cli.main(["normalise", log, out, "--distance", "0.5"]) == 0
    (tmp_path / "b").mkdir()
    (tmp_path / "b/a.pdf").write_bytes(b"%PDF-")
    assert cli.main(["write", out, str(tmp_path / "b"), str(tmp_path / "t"), "--failures", str(tmp_path / "bad")]) == 0
    assert "done 1" in capsys.readouterr().out and json.loads((tmp_path / "t/a.pdf.json").read_text())["title"] == "Dune"
