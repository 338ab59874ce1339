"""Reading and writing PDFs, images, archives and configuration."""

import json
import tarfile
import zipfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tomeworks import cli
from tomeworks.functions import images, metadata, xmp
from tomeworks.operators import keywords
from tomeworks.providers import config
from tomeworks.sources import archives, pdf


def make_pdf(texts, pixels=None, title="A (first) title"):
    """A file with one page for each text; pixels: an array for the pages' image."""
    out, at = bytearray(b"%PDF-1.4\n"), []

    def add(body):
        at.append(len(out))
        out.extend(b"%d 0 obj\n" % len(at) + body + b"\nendobj\n")

    kids = b" ".join(b"%d 0 R" % (5 + 2 * i) for i in range(len(texts)))
    add(b"<</Type/Catalog/Pages 2 0 R>>")
    add(b"<</Type/Pages/Count %d/Kids[%s]/Resources<</XObject<</Im0 4 0 R>>>>>>" % (len(texts), kids))
    add(b"<</Title (" + title.encode().replace(b"(", b"\\(").replace(b")", b"\\)") + b")/Keywords (a, b,, a)/Author <FEFF00C900760061>>>")
    a = np.full((2, 2, 1), 255, np.uint8) if pixels is None else pixels
    raw = zlib.compress(a.tobytes())
    add(b"<</Type/XObject/Subtype/Image/Width %d/Height %d/BitsPerComponent 8/ColorSpace/%s/Filter/FlateDecode/Length %d>>stream\n" % (a.shape[1], a.shape[0], b"DeviceGray" if a.shape[2] == 1 else b"DeviceRGB", len(raw)) + raw + b"\nendstream")
    for i, t in enumerate(texts):
        add(b"<</Type/Page/Parent 2 0 R/Contents %d 0 R>>" % (6 + 2 * i))
        body = zlib.compress(b"BT /F1 12 Tf 10 10 Td (" + t.encode("latin-1") + b") Tj 0 -14 Td [(two) -300 (words)] TJ ET")
        add(b"<</Filter/FlateDecode/Length %d>>\nstream\r\n" % len(body) + body + b"\nendstream")
    start = len(out)
    out += b"xref\n0 %d\n" % (len(at) + 1) + b"0000000000 65535 f \n" + b"".join(b"%010d 00000 n \n" % p for p in at)
    return bytes(out + b"trailer\n<</Size %d/Root 1 0 R/Info 3 0 R>>\nstartxref\n%d\n%%%%EOF\n" % (len(at) + 1, start))


def test_read_and_write():
    p = pdf.Pdf(make_pdf(["one", "zwei \u00fc"]))
    assert p.info() == {"Title": "A (first) title", "Keywords": "a, b,, a", "Author": "\u00c9va"}
    assert [p.page_text(x) for x in p.pages()] == ["one\ntwo words", "zwei \u00fc\ntwo words"]
    assert p.page_image(p.pages()[0])[:3] == (2, 2, 1)
    assert p.xmp() is None
    again = pdf.Pdf(pdf.with_metadata(make_pdf(["one"]), {"Title": "N\u00e4chster", "Keywords": None}, "<x/>"))
    assert again.info() == {"Title": "N\u00e4chster", "Author": "\u00c9va"}
    assert again.xmp() == "<x/>" and len(again.pages()) == 1
    third = pdf.Pdf(pdf.with_metadata(again.content, {"Title": "3"}, "<y/>"))
    assert third.info()["Title"] == "3" and third.xmp() == "<y/>"
    assert again.content.startswith(make_pdf(["one"]))
    for bad in (b"", b"x", b"%PDF-1.4\n<<", b"%PDF-1.4\n1 0 obj <</Type/Catalog/Pages 1 0 R/Kids[1 0 R]>>"):
        with pytest.raises(ValueError):
            pdf.with_metadata(bad, {}, None)


def test_object_streams_and_predictors():
    inner = b"7 0 8 27 <</Type/Pages/Kids[8 0 R]>>  <</Type/Page>>"
    first = inner.index(b"<<")
    body = zlib.compress(inner.replace(b"7 0 8 27", b"7 0 8 %2d" % (inner.index(b"<</Type/Page>>") - first)))
    raw = b"%%PDF-1.5\n1 0 obj<</Type/Catalog/Pages 7 0 R>>endobj\n2 0 obj<</Type/ObjStm/N 2/First %d/Filter/FlateDecode/Length %d>>stream\n" % (first, len(body)) + body + b"\nendstream endobj\ntrailer<</Root 1 0 R>>"
    assert len(pdf.Pdf(raw).pages()) == 1
    rows = np.arange(12, dtype=np.uint8).reshape(3, 4)
    coded = b"\x00" + rows[0].tobytes() + b"\x02" + (rows[1] - rows[0]).tobytes() + b"\x01" + np.diff(rows[2], prepend=np.uint8(0)).tobytes()
    assert pdf._unpredict(coded, {"Predictor": 15, "Columns": 4}) == rows.tobytes()


def test_frames(spark):
    a = np.zeros((2, 4, 3), np.uint8)
    rows = [("/a.pdf", bytearray(make_pdf(["x"], a))), ("/b.pdf", bytearray(b"no"))]
    files = spark.createDataFrame(rows, "path string, content binary")
    docs = {r["path"]: r for r in pdf.documents(files).collect()}
    assert docs["/a.pdf"]["page_count"] == 1 and docs["/b.pdf"]["error"] and docs["/b.pdf"]["page_count"] is None
    page = pdf.pages(files)
    got = page.select("text", images.nonwhite(F.col("image")).alias("n"), images.png(F.col("image")).alias("png"), images.scaled(F.col("image"), 2)["pixels"].alias("small")).first()
    assert (got["text"], got["n"], len(got["small"])) == ("x\ntwo words", 8, 6)
    assert bytes(got["png"])[:8] == b"\x89PNG\r\n\x1a\n"
    none = page.select(F.lit(None).cast(images.IMAGE).alias("image")).select(images.nonwhite(F.col("image")), images.preprocessed(F.col("image"))).first()
    assert tuple(none) == (None, None)
    record = F.struct(F.lit("T").alias("title"), F.lit(None).cast("string").alias("publisher"), F.array(F.lit("A"), F.lit("B")).alias("authors"), F.array().cast("array<string>").alias("categories"))
    made = pdf.embed(files.select("path", "content", metadata.to_info(record).alias("info"), xmp.write_xmp({"title": F.lit("T")}, F.lit("2026-01-01").cast("timestamp")).alias("packet")))
    got = {r["path"]: r for r in made.collect()}
    assert got["/b.pdf"]["error"]
    new = pdf.Pdf(bytes(got["/a.pdf"]["content"]))
    assert new.info()["Author"] == "A, B" and "<dc:title>" in new.xmp()


def test_images():
    ramp = np.arange(16, dtype=np.uint8).reshape(4, 4, 1)
    assert images.grey(ramp).min() == 0 and images.grey(ramp).max() == 255
    assert images.resized(ramp, 2, 2).ravel().tolist() == [2, 4, 10, 12]
    assert images.dark_pixels(np.array([[[250, 250, 250], [249, 255, 255]]], np.uint8)) == 1


def test_commands(spark, tmp_path, capsys):
    root = tmp_path / "in"
    root.mkdir()
    dark = np.zeros((2, 2, 1), np.uint8)
    for name, data in (("a.pdf", make_pdf(["x"], dark, "one")), ("b.pdf", make_pdf(["other"], dark, "two")), ("c.pdf", make_pdf(["x"], None, "three")), ("d.pdf", b"broken"), ("e.pdf", b"broken too")):
        (root / name).write_bytes(data)
    cli.main(["inspect", str(root)])
    lines = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert sorted(x["record"]["title"] for x in lines) == ["d", "e", "one", "three", "two"]
    cli.main(["dedupe", str(root), "--by-content", "--rm"])
    assert sorted(p.name for p in root.iterdir()) == ["a.pdf", "c.pdf", "d.pdf", "e.pdf"]
    cli.main(["pages", str(root), str(tmp_path / "pages")])
    table = spark.read.parquet(str(tmp_path / "pages"))
    assert sorted(r["results"][0]["text"] for r in table.collect()) == ["x\ntwo words"] * 2
    capsys.readouterr()
    cli.main(["run", str(tmp_path / "pages"), "--log", str(tmp_path / "log"), "--mode", "bookinfo"])
    assert "processed 2" in capsys.readouterr().out
    cli.main(["normalise", str(tmp_path / "log"), str(tmp_path / "table"), "--distance", "0.3"])
    for want in ("done", "exists"):
        cli.main(["write", str(tmp_path / "table"), str(root), str(tmp_path / "out"), "--embed"])
        assert f"{want} 2" in capsys.readouterr().out
    assert pdf.Pdf((tmp_path / "out/a.pdf").read_bytes()).info()["Title"] == "x"
    cli.main(["search", "naive", "--title", "T"])
    assert json.loads(capsys.readouterr().out)["items"][0]["title"] == "T"


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x/y.txt", "1")
        z.writestr("../out.txt", "2")
    (tmp_path / "f").write_text("3")
    with tarfile.open(tmp_path / "b.tar.gz", "w:gz") as t:
        t.add(tmp_path / "f", "f")
    (tmp_path / "c.zip").write_text("no")
    rows = [(str(p), bytearray(p.read_bytes())) for p in tmp_path.iterdir()]
    got = archives.expand(archives.members(spark.createDataFrame(rows, "path string, content binary"))).collect()
    assert sorted(r["status"].split(":")[0] for r in got) == ["done", "done", "failed", "failed"]
    assert (tmp_path / "a/x/y.txt").read_text() == "1" and (tmp_path / "b/f").read_text() == "3"
    assert not (tmp_path.parent / "out.txt").exists() and not (tmp_path / "out.txt").exists()


def test_config(tmp_path, monkeypatch):
    (tmp_path / "s.json").write_text('{"GOOGLE_BOOKS_API_KEY": "k", "OLLAMA_HOST": "h"}')
    secrets = config.read_secrets(str(tmp_path / "s.json"))
    assert config.default_search_methods(secrets) == ("googlebooks",) and config.default_search_methods({}) == ()
    assert config.client_config("ollama", secrets) == {"host": "h"}
    for call in (lambda: config.client_config("none", {}), lambda: config.read_secrets(str(tmp_path / "no")), lambda: config.writer_binary("no")):
        with pytest.raises((ValueError, FileNotFoundError)):
            call()
    monkeypatch.setenv("METADATA_WRITER", str(tmp_path / "s.json"))
    assert config.writer_binary("no") == str(tmp_path / "s.json")
    assert config.HardcoverClient("k", 5, 3).offset == 10 and config.GoogleBooksClient("k").max_results == 5
    assert config.default_ocr_methods("m") == ("native", "tesseract", "ollama:m")
    kind = StructType.fromDDL("title string not null, keywords array<string>, confidence double")
    assert config.json_schema(kind) == {"type": "object", "properties": {"title": {"type": "string"}, "keywords": {"type": "array", "items": {"type": "string"}}, "confidence": {"type": "number"}}, "required": ["title"]}
    assert config.scrub({"a\ud800": ["b\udfff", 1]}) == {"a": ["b", 1]}
    told = config.messages({"prompt": "p", "path": "x", "metadata": " ", "ocr": ["o"]}, ["i"])
    assert [m["content"] for m in told] == ["p", "x\n\no"] and told[1]["images"] == ["i"]


def test_sweep(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(v) for v in np.eye(3)[i % 3] + rng.normal(0, 0.05, 3)]) for i in range(18)]
    df = spark.createDataFrame(rows, "item int, vector array<double>")
    scores = dict(keywords.silhouette_by_k(df, "item", "vector", [2, 3, 5]))
    assert max(scores, key=scores.get) == 3
