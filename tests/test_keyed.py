"""Look-ups by key, answers kept between runs, and the latest row of a stream."""

import datetime as dt
import re

from tomeworks.operators import lookup
from tomeworks.plans import books
from tomeworks.providers import base as P
from tomeworks.sources import keyed
from tomeworks.streaming import listen


def test_lookup_reads_its_buckets(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k string, v string, n long"
    one = spark.range(2000).selectExpr("concat('k', id) AS k", "concat('v', id) AS v", "id AS n")
    assert keyed.lookup(one.limit(1), path, "k", "n", schema).count() == 0
    keyed.append(one, path, "k")
    keyed.append(one.where("n % 2 = 0").selectExpr("k", "'new' AS v", "n + 1 AS n"), path, "k")
    keyed.append(one.where("n = 4").selectExpr("k", "'old' AS v", "n - 1 AS n"), path, "k")
    want = spark.createDataFrame([("k4",), ("k5",), ("none",), (None,)], "k string")
    got = keyed.lookup(want, path, "k", "n", schema)
    assert sorted(map(tuple, got.collect())) == [("k4", "new", 5), ("k5", "v5", 5)]
    plan = got._jdf.queryExecution().toString()
    read = re.search(r"PartitionFilters: \[([^\]]*)\]", plan)[1]
    assert "bucket" in read and len(re.findall(r"\d+(?=[,)])", read.split(" IN ")[-1])) <= 4


def counting(log):
    """A provider that answers with the request in capitals, and writes down that it was asked."""

    def make():
        def call(request):
            with open(log, "a") as f:
                f.write(request[:4] + "\n")
            if "bad" in request:
                raise ValueError("no")
            if request.startswith("{"):
                return '{"title": "T"}'
            return None if "none" in request else request.upper()

        return call

    return make


def test_through_cache(spark, tmp_path):
    log = tmp_path / "asked"
    P.register("counting", counting(str(log)))
    respond = lambda some: P.ask(some, "key", "request", "counting", 1)
    df = spark.createDataFrame([("1", "a"), ("2", "b"), ("2", "b"), ("3", "bad"), ("4", "none")], "key string, request string")
    for turn in (1, 2):
        got = {r["key"]: (r["response"], r["error"]) for r in lookup.through_cache(df, str(tmp_path / "cache"), respond, "key").collect()}
        assert got == {"1": ("A", None), "2": ("B", None), "3": (None, "ValueError: no"), "4": (None, None)}
        asked = sorted(log.read_text().split())
        assert asked == sorted(["a", "b"] + ["bad", "none"] * turn)  # what was answered isn't asked again
    more = spark.createDataFrame([("1", "a"), ("5", "c")], "key string, request string")
    assert {r["response"] for r in lookup.through_cache(more, str(tmp_path / "cache"), respond, "key").collect()} == {"A", "C"}
    assert log.read_text().split().count("a") == 1


def test_books_ask_once(spark, tmp_path):
    log = tmp_path / "asked"
    P.register("counting_extractor", counting(str(log)))
    pages = [(1, [("native", "some text")])]
    docs = spark.createDataFrame([("d1", "h1", "/a.pdf", {}, pages, True), ("d2", "h2", "/b.pdf", {}, pages, True)], "doc string, pdf_hash string, path string, info map<string,string>, pages array<struct<page_number:int,results:array<struct<method:string,text:string>>>>, has_text boolean")
    config = P.PipelineConfig(extractor="counting_extractor", cache=str(tmp_path / "cache"))
    assert "cache" not in config.to_json()
    for _ in range(2):
        got = books.run(docs, config, "bookinfo").collect()
        assert {r["doc"] for r in got if '"title":"T"' in r["result"]} == {"d1", "d2"}
    assert len(log.read_text().splitlines()) == 2


def test_latest_of_a_stream(spark, tmp_path):
    at = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(hours=n)
    schema, source = "h string, at timestamp, v string", str(tmp_path / "in")
    turns = [
        [("a", at(1), "a1"), ("a", at(3), "a3"), ("b", at(2), "b2"), (None, at(1), "x"), ("c", None, "y")],
        [("a", at(2), "late"), ("a", at(3), "a3"), ("b", at(4), "b4"), ("d", at(0), "d0")],
    ]
    want = [{"a": "a3", "b": "b2"}, {"a": "a3", "b": "b4", "d": "d0"}]
    keys = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "h string")
    for rows, then in zip(turns, want, strict=True):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        for _ in range(2):  # a run with nothing new changes nothing
            listen.keep_latest(spark.readStream.schema(schema).parquet(source), str(tmp_path / "t"), str(tmp_path / "state"), "h", "at")
        got = keyed.lookup(keys, str(tmp_path / "t"), "h", "at", schema)
        assert {r["h"]: r["v"] for r in got.collect()} == then
    handed = spark.read.parquet(str(tmp_path / "t")).count()
    assert handed == 4  # a3, b2, b4, d0: neither the late nor the repeated row
