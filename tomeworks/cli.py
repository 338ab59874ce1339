"""Commands over folders of documents: python -m tomeworks.cli COMMAND ..."""

from __future__ import annotations

import argparse
import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import images, metadata, xmp
from .functions.text import file_name, moved_below, path_allowed, plain_path
from .operators import dedupe, pages
from .plans import books, normalise
from .providers.base import ContextLimits, PipelineConfig, ask
from .sources import archives, files, pdf, run_log
from .sources.staging import staged


def _count(text: str) -> int:
    n = int(text)
    if n < 0:
        raise argparse.ArgumentTypeError("must not be negative")
    return n


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tomeworks", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    d = sub.add_parser("dedupe", help="move or delete files whose content was seen before, in order of their paths")
    d.add_argument("folder")
    d.add_argument("--by-content", action="store_true", help="files are the same if their number of pages and what their first and last page show are")
    act = d.add_mutually_exclusive_group(required=True)
    act.add_argument("--dest")
    act.add_argument("--rm", action="store_true")
    d.add_argument("--dry-run", action="store_true")
    c = sub.add_parser("copy", help="copy files to a folder")
    c.add_argument("sources", nargs="+")
    c.add_argument("--dest", required=True)
    c.add_argument("--prefix", help="a folder on the path must begin with this")
    c.add_argument("--deduplicate", action="store_true")
    c.add_argument("--overwrite", action="store_true", help="replace files of the same name instead of leaving them")
    c.add_argument("--max-files", type=_count)
    c.add_argument("--dry-run", action="store_true")
    f = sub.add_parser("flatten", help="move files to the parent of their folder as <folder>_<file>")
    f.add_argument("roots", nargs="+")
    f.add_argument("--dry-run", action="store_true")
    r = sub.add_parser("run", help="make records of documents from a table of their pages (pdf_hash, path, page_number, results) and log them")
    r.add_argument("pages")
    r.add_argument("--log", required=True)
    r.add_argument("--mode", choices=("full", "bookinfo"), default="full")
    r.add_argument("--prompt", default="default", help="the name of a prompt, or its text")
    r.add_argument("--extractor", default="outline")
    r.add_argument("--selector", default="first")
    r.add_argument("--search", nargs="*", default=[], help="search methods in order")
    r.add_argument("--search-max-results", type=_count, default=3)
    r.add_argument("--cache", help="a folder that keeps the answers of providers for later runs")
    r.add_argument("--num-front-ocr-pages", type=_count, default=5)
    r.add_argument("--num-back-ocr-pages", type=_count, default=3)
    r.add_argument("--max-pdfs", type=_count)
    for side in ("first", "last"):
        r.add_argument(f"--context-{side}-ocr-pages", type=_count)
    s = sub.add_parser("show", help="print the results of a log as JSON lines")
    s.add_argument("log")
    n = sub.add_parser("normalise", help="make keywords and publishers of a log canonical and save the table")
    n.add_argument("log")
    n.add_argument("out")
    how = n.add_mutually_exclusive_group()
    how.add_argument("--clusters", type=_count)
    how.add_argument("--distance", type=float)
    n.add_argument("--linkage", choices=("average", "complete", "single", "ward"), default="average")
    n.add_argument("--labeller", help="the provider that names clusters; without one, the shortest keyword does")
    n.add_argument("--publisher-threshold", type=float, default=75.0)
    w = sub.add_parser("write", help="write payloads and XMP beside the files of a folder")
    w.add_argument("table", help="what normalise saved")
    w.add_argument("folder")
    w.add_argument("target")
    w.add_argument("--failures", help="a folder for the log of what failed")
    w.add_argument("--embed", action="store_true", help="write info and XMP into copies of the files instead")
    g = sub.add_parser("pages", help="make the table of pages that run reads from the PDFs of a folder")
    g.add_argument("sources", nargs="+")
    g.add_argument("out")
    u = sub.add_parser("unarchive", help="expand the archives of a folder beside them")
    u.add_argument("folder")
    q = sub.add_parser("search", help="print what a search method answers for a title and an author")
    q.add_argument("method")
    q.add_argument("--title", default="")
    q.add_argument("--author", default="")
    q.add_argument("--max-results", type=_count, default=5)
    for name, text in (("inspect", "print the metadata of PDFs as JSON lines"), ("check", "list files that aren't sound PDFs"), ("members", "list what archives hold"), ("count", "count PDFs")):
        s = sub.add_parser(name, help=text)
        s.add_argument("folder")
    return p


def content_keys(found: DataFrame) -> DataFrame:
    """path, content_hash: the identity of what files show; null, so never a duplicate, where the first or last page can't be read."""
    shown = pdf.pages(found)
    digest = F.coalesce(images.digest(F.col("image")), F.sha2(F.col("text"), 256))
    keys = dedupe.content_signature(shown.select("path", "page_number", digest.alias("digest")), "path", "page_number", "digest")
    return found.select("path").join(keys, "path", "left").select("path", F.sha2(F.to_json("signature"), 256).alias("content_hash"))


def there(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """path of the files of a folder, none if it isn't there."""
    if not os.path.isdir(folder):
        return spark.createDataFrame([], "path string")
    return files.discover(spark, folder, pattern).select(plain_path(F.col("path")).alias("path"))


def duplicates_plan(found: DataFrame, root: str, dest: str, by_content: bool = False) -> DataFrame:
    """path, dest of the files whose content was seen before; their places below root stay, names that are taken in dest get a number."""
    keys = content_keys(found) if by_content else files.with_hash(found)
    gone = dedupe.first_seen(keys, F.col("content_hash"), "path").where("status = 'duplicate'")
    target = moved_below(F.col("path"), os.path.abspath(root), os.path.abspath(dest))
    return dedupe.free_names(gone.select("path", target.alias("target")), "target", "path", there(found.sparkSession, dest)).select("path", "dest")


def copies_plan(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """path, dest, status of the files to copy: their places below their roots stay, the roots follow each other. Status is `exists` where
    something lies already, else `planned`; with --overwrite the last of equal names is taken, else the first."""
    plan = None
    for n, root in enumerate(files.expand_paths(a.sources)):
        found = files.discover(spark, root)
        own = found.select("path", F.struct(F.lit(n).alias("root"), "path").alias("order"), moved_below(F.col("path"), os.path.abspath(root), os.path.abspath(a.dest)).alias("dest"), *([F.sha2("content", 256).alias("content_hash")] if a.deduplicate else []))
        plan = own if plan is None else plan.unionByName(own)
    if plan is None:
        raise SystemExit("no sources")
    if a.prefix:
        plan = plan.where(path_allowed(F.col("path"), a.prefix))
    if a.deduplicate:
        old = files.with_hash(files.discover(spark, a.dest)) if os.path.isdir(a.dest) else plan.where("false")
        plan = dedupe.copy_plan(plan, old, "content_hash", "order").drop("content_hash")
    plan = staged(plan)
    chosen = dedupe.one_per_dest(plan, "order", last=a.overwrite)
    if not a.overwrite:
        chosen = chosen.join(there(spark, a.dest).withColumnRenamed("path", "dest"), "dest", "left_anti")
    if a.max_files is not None:
        chosen = chosen.orderBy("order").limit(a.max_files)
    chosen = staged(chosen.select("path", "dest", F.lit("planned").alias("status")))
    rest = plan.join(chosen, ["path", "dest"], "left_anti").select("path", "dest", F.lit("exists").alias("status"))
    return chosen if a.overwrite or a.max_files is not None else chosen.unionByName(rest)


def flatten_moves(spark: SparkSession, roots: list[str]) -> DataFrame:
    """path, dest, status of the files below the roots: names that are taken stay, and of files that would get one name the first moves."""
    found = staged(files.discover(spark, roots, "*").select("path"))
    plan = dedupe.flatten_plan(found, "path")
    for r in (os.path.abspath(r).rstrip("/") for r in roots):
        plan = plan.where(F.regexp_replace(plain_path(F.col("path")), r"/[^/]*$", "") != F.lit(r))
    plan = staged(plan)
    chosen = dedupe.one_per_dest(plan.join(found.select(F.col("path").alias("dest")), "dest", "left_anti").select("path", "dest"), "path")
    chosen = staged(chosen.withColumn("status", F.lit("planned")))
    return chosen.unionByName(plan.join(chosen, "path", "left_anti").select("path", "dest", F.lit("exists").alias("status")))


def run_pages(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """pdf_hash, status, error of the documents in the table a.pages: its first and last pages that aren't blank are read."""
    config = PipelineConfig(a.num_front_ocr_pages, a.num_back_ocr_pages, a.extractor, a.selector, tuple(a.search), a.search_max_results, ContextLimits(first_pages=a.context_first_ocr_pages, last_pages=a.context_last_ocr_pages), cache=a.cache)
    table = spark.read.parquet(a.pages)
    if a.max_pdfs is not None:
        table = table.join(table.select("pdf_hash").distinct().orderBy("pdf_hash").limit(a.max_pdfs), "pdf_hash", "left_semi")
    blank = ~F.exists("results", lambda r: F.trim(F.coalesce(r["text"], F.lit(""))) != "")
    shown = pages.sample_pages(table, "pdf_hash", "page_number", blank, config.first_pages, config.last_pages)
    whole = table.groupBy("pdf_hash").agg(F.min("path").alias("path"))
    docs = whole.join(books.documents(shown, "pdf_hash"), "pdf_hash", "left")
    none = F.array().cast("array<struct<page_number:int,results:array<struct<method:string,text:string>>>>")
    docs = docs.withColumns({"doc": F.col("pdf_hash"), "pages": F.coalesce("pages", none), "has_text": F.coalesce("has_text", F.lit(False)), "info": F.create_map().cast("map<string,string>")})
    return books.run_batch(docs, config, a.log, a.mode, prompt=a.prompt)


def normalise_log(spark: SparkSession, a: argparse.Namespace) -> None:
    clusters = 1000 if a.clusters is None and a.distance is None else a.clusters
    rows = staged(run_log.parsed(run_log.read_runs(spark, a.log)))
    mapping = normalise.canonical_keywords(normalise.distinct_keywords(rows), clusters, a.distance, a.linkage, labeller=a.labeller)
    normalise.save(normalise.normalised(rows, staged(mapping), a.publisher_threshold), a.out)


def write_back(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    found = files.with_hash(files.discover(spark, a.folder)).select("path", F.col("content_hash").alias("file_hash"), file_name(F.col("path")).alias("file_name"))
    meta = normalise.load(spark, a.table).select(F.col("pdf_hash").alias("file_hash"), F.col("pdf_name").alias("file_name"), "entity", F.col("run_timestamp").alias("order"))
    if a.embed:
        return staged(normalise.write_pdfs(files.discover(spark, a.folder), found, meta, a.folder, a.target))
    done = staged(normalise.write_sidecars(found, meta, a.folder, a.target))  # staged, since writing is not to be done twice
    if a.failures:
        normalise.failures(done, a.failures)
    return done


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName("tomeworks").getOrCreate()
    if a.command == "normalise":
        normalise_log(spark, a)
        return 0
    if a.command == "show":
        for r in run_log.latest(run_log.read_runs(spark, a.log).select("pdf_hash", "result", "run_timestamp"), "pdf_hash", "run_timestamp").orderBy("pdf_hash").toLocalIterator():
            print(r["result"])
        return 0
    if a.command in ("run", "write"):
        status = (run_pages if a.command == "run" else write_back)(spark, a)
        for r in status.groupBy(F.regexp_extract("status", "^[^:]*", 0).alias("status")).count().orderBy("status").collect():
            print(r["status"], r["count"])
        return 0
    if a.command == "inspect":
        record = F.struct("path", "page_count", "error", metadata.from_info(F.coalesce("info", F.create_map().cast("map<string,string>")), F.col("path")).alias("record"), xmp.record(F.col("xmp")).alias("xmp"))
        for r in pdf.documents(files.discover(spark, a.folder)).select(F.to_json(record).alias("line")).orderBy("line").toLocalIterator():
            print(r["line"])
        return 0
    if a.command == "pages":
        found = files.discover(spark, files.expand_paths(a.sources))
        shown = pdf.pages(found).join(files.with_hash(found).select("path", F.col("content_hash").alias("pdf_hash")), "path")
        native = F.when(F.trim("text") != "", F.array(F.struct(F.lit("native").alias("method"), "text"))).otherwise(F.array().cast("array<struct<method:string,text:string>>"))
        shown.select("pdf_hash", "path", "page_number", native.alias("results"), "image").write.mode("overwrite").parquet(a.out)
        return 0
    if a.command == "unarchive":
        for r in archives.expand(archives.members(files.discover(spark, a.folder, "*"))).orderBy("archive", "member").toLocalIterator():
            print(r["status"], r["archive"], r["member"] or "")
        return 0
    if a.command == "search":
        request = spark.createDataFrame([("0", json.dumps({"info": {"title": a.title or None, "author": a.author or None}, "max_results": a.max_results}))], "key string, request string")
        print(ask(request, "key", "request", a.method).first()["response"])
        return 0
    if a.command == "count":
        print(files.count_files(spark, a.folder))
        return 0
    if a.command == "dedupe":
        found = files.discover(spark, a.folder)
        plan = duplicates_plan(found, a.folder, a.dest or a.folder, a.by_content)
        if a.rm:
            gone = staged(files.remove_files(staged(plan), dry_run=a.dry_run))
            print(f"removed {gone.where(~F.col('status').startswith('failed')).count()}")
            return 0
    elif a.command == "copy":
        plan = copies_plan(spark, a)
    elif a.command == "flatten":
        plan = flatten_moves(spark, a.roots)
    elif a.command == "check":
        for r in files.discover(spark, a.folder, case_insensitive=True).where(~files.looks_valid(F.col("content"))).select("path").orderBy("path").toLocalIterator():
            print(r["path"])
        return 0
    else:
        for r in archives.members(files.discover(spark, a.folder, "*")).select("archive", "member", "error").orderBy("archive", "member").toLocalIterator():
            print(r["archive"], r["member"] or r["error"])
        return 0
    if "status" not in plan.columns:
        plan = plan.withColumn("status", F.lit("planned"))
    plan = staged(plan)
    done = files.move_files(plan.where("status = 'planned'"), copy=a.command == "copy", dry_run=a.dry_run, overwrite=a.command == "copy" and a.overwrite)
    for r in done.unionByName(plan.where("status <> 'planned'")).orderBy("path").toLocalIterator():
        print(r["status"], r["path"], "->", r["dest"])
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
