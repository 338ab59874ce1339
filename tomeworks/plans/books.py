"""From pages to book records: OCR, extraction, catalogue search, selection and the run log, as stages over DataFrames.

Every stage is one row for each document. What a provider answers is cached by content, so that a document is asked about
once for a config; a provider's failure is that document's `error` and leaves the others alone."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import metadata_lines, split_authors, strip_code_fences
from ..operators import pages as P
from ..operators.lookup import through_cache
from ..providers import offline  # noqa: F401  (registers the offline providers)
from ..providers.base import PipelineConfig, ask, factory, retrying
from ..sources import run_log
from ..sources.staging import staged

INFO = "author string, title string, subtitle string, publisher string, keywords array<string>, description string"
REPLY = f"struct<{INFO.replace(' string', ':string').replace(' array', ':array')},author_confidence:double,title_confidence:double>"
DETAIL = INFO.replace("author string", "author array<string>") + ", subject string, isbn_identifiers array<string>"
#: Prompts by name; a config may bring its own text instead.
PROMPTS = {
    "default": "Read the pages and the file's metadata. Give author, title, subtitle, publisher, keywords and a description of the book as one flat JSON object, with a confidence from 0 to 1 for author and title.",
    "ttrpg": "Read the pages and the file's metadata. The book belongs to a tabletop roleplaying game: name the game system and the kind of book among the keywords. Answer with one flat JSON object of author, title, subtitle, publisher, keywords and description, with a confidence from 0 to 1 for author and title.",
    "flat": "Answer with one JSON object only, without nesting, comments or code fences. Its fields are author, title, subtitle, publisher, keywords, description, author_confidence and title_confidence.",
    "ocr": "Write out the text on this page as it stands, line by line, and nothing else. An empty page has an empty answer.",
    "keyword_system": "You name groups of keywords. Answer with one short label on one line.",
    "keyword_user": "Give the label that fits all of these keywords best:",
    "selection": "Merge what was read from the pages with the catalogue candidates into one record. Prefer what the pages support, and leave out what no source supports.",
}


def ocr_results(pages: DataFrame, methods: list[str], doc: str = "doc", number: str = "page_number", image: str = "image", attempts: int = 3) -> DataFrame:
    """pages with results, an array of (method, text) in the order of the methods: those that gave text. A method that
    fails on a page is left out there."""
    makers = [(m, factory(m)) for m in methods]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        calls = [(m, retrying(make(), attempts)) for m, make in makers]
        for pdf in batches:
            rows = []
            for x in pdf[image]:
                got = []
                for m, call in calls:
                    try:
                        text = call(x) if x is not None else None
                    except Exception:
                        text = None
                    if text and text.strip():
                        got.append({"method": m, "text": text})
                rows.append(got)
            yield pd.DataFrame({doc: pdf[doc], number: pdf[number], "results": pd.Series(rows, dtype=object)})

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return pages.select(doc, number, image).mapInPandas(run, f"{doc} {kinds[doc]}, {number} {kinds[number]}, results array<struct<method:string,text:string>>")


def documents(pages: DataFrame, doc: str = "doc", number: str = "page_number", results: str = "results") -> DataFrame:
    """doc, pages (ordered array of page_number, results), combined_text, has_text."""
    text = P.combined_text(pages, doc, number, results)
    listed = pages.groupBy(doc).agg(F.array_sort(F.collect_list(F.struct(F.col(number).cast("int").alias("page_number"), F.col(results).alias("results")))).alias("pages"))
    return listed.join(text, doc)


def ocr_blocks(pages: Column) -> Column:
    """A block of text for every result of the pages given."""
    each = F.transform(pages, lambda p: F.transform(p["results"], lambda r: F.concat(F.lit("PAGE: "), p["page_number"].cast("string"), F.lit(" OCR USING METHOD: "), r["method"], F.lit("\n"), r["text"])))
    return F.flatten(each)


def blocks(docs: DataFrame, prompt: str, config: PipelineConfig) -> DataFrame:
    """docs with `blocks`: prompt, path, metadata lines and the page texts within the config's limits. docs has doc, path,
    info (map) and pages."""
    limits = config.limits
    shown = P.context_pages(F.col("pages"), limits.first_pages, limits.last_pages)
    parts = F.struct(F.lit(prompt).alias("prompt"), F.col("path").alias("path"), metadata_lines(F.col("info")).alias("metadata"), ocr_blocks(shown).alias("ocr"))
    return docs.withColumn("blocks", parts)


def block_text(blocks: Column) -> Column:
    """The blocks as one text, for providers that read plain text."""
    return F.array_join(F.filter(F.concat(F.array(blocks["prompt"], blocks["path"], blocks["metadata"]), blocks["ocr"]), lambda x: F.trim(x) != ""), "\n\n")


def _asked(df: DataFrame, request: Column, name: str, attempts: int, columns: list[str], cache: str | None = None) -> DataFrame:
    """df's columns with response and failure: equal requests are asked once, and not at all if the cache holds an answer."""
    df = staged(df.select(*columns, F.to_json(request).alias("_request")).withColumn("_key", F.sha2(F.concat(F.lit(name + "\n"), "_request"), 256)))
    requests, respond = df.select("_key", "_request").dropDuplicates(["_key"]), lambda some: ask(some, "_key", "_request", name, attempts)
    answers = staged(respond(requests) if cache is None else through_cache(requests, cache, respond, "_key"))
    return df.join(answers.withColumnRenamed("error", "failure"), "_key").drop("_key", "_request")


def extract(docs: DataFrame, config: PipelineConfig, attempts: int = 3, prompt: str = "default") -> DataFrame:
    """docs with info_reply (the record read from the blocks, confidences 0 where none is given) and error. Documents
    without text, and replies that aren't a JSON object, have a null record and an error."""
    told = _asked(blocks(docs.where("has_text"), PROMPTS.get(prompt, prompt), config), F.col("blocks"), config.extractor, attempts, ["doc", "blocks"], config.cache)
    r = F.from_json(strip_code_fences(F.col("response")), REPLY)
    sound = F.schema_of_variant(F.try_parse_json(strip_code_fences(F.col("response")))).startswith("OBJECT")
    reply = F.when(sound, F.struct(*[r[c].alias(c) for c in ("author", "title", "subtitle", "publisher", "keywords", "description")], *[F.coalesce(r[c], F.lit(0.0)).alias(c) for c in ("author_confidence", "title_confidence")]))
    told = told.select("doc", "blocks", reply.alias("info_reply"), F.coalesce("failure", F.when(~F.coalesce(sound, F.lit(False)), F.lit("the reply is not a record"))).alias("error"))
    out = docs.drop("blocks").join(told, "doc", "left")
    return out.withColumn("error", F.when(~F.col("has_text"), F.lit("no text on any page")).otherwise(F.col("error")))


def search(infos: DataFrame, config: PipelineConfig, attempts: int = 3) -> DataFrame:
    """infos with candidates, an array of (method, payload) in the order of the methods; one that fails or finds nothing
    is left out. A method is asked for JSON of `info` and `max_results`; a payload is JSON of source, query, result_count
    and items."""
    found = None
    for i, name in enumerate(config.search_methods):
        got = _asked(infos.where("info_reply is not null"), F.struct(F.col("info_reply").alias("info"), F.lit(config.max_results).alias("max_results")), name, attempts, ["doc"], config.cache)
        got = got.where(F.trim("response") != "").select("doc", F.struct(F.lit(i).alias("i"), F.lit(name).alias("method"), F.col("response").alias("payload")).alias("c"))
        found = got if found is None else found.unionByName(got)
    kind = "array<struct<method:string,payload:string>>"
    if found is None:
        return infos.withColumn("candidates", F.array().cast(kind))
    listed = found.groupBy("doc").agg(F.transform(F.array_sort(F.collect_list("c")), lambda c: F.struct(c["method"].alias("method"), c["payload"].alias("payload"))).alias("candidates"))
    return infos.join(listed, "doc", "left").withColumn("candidates", F.coalesce("candidates", F.array().cast(kind)))


def select_best(found: DataFrame, config: PipelineConfig, attempts: int = 3) -> DataFrame:
    """found with `result`, the final record as JSON, from the blocks, the first record and the candidates that are JSON."""
    sound = F.filter(F.transform("candidates", lambda c: c["payload"]), lambda c: F.try_parse_json(c).isNotNull())
    request = F.struct(F.struct(F.lit(PROMPTS["selection"]).alias("prompt"), F.col("blocks.path").alias("path"), F.col("blocks.metadata").alias("metadata"), F.col("blocks.ocr").alias("ocr")).alias("blocks"), F.col("info_reply").alias("info"), sound.alias("candidates"))
    told = _asked(found.where("info_reply is not null"), request, config.selector, attempts, ["doc"], config.cache)
    record = strip_code_fences(F.col("response"))
    sound = F.coalesce(F.schema_of_variant(F.try_parse_json(record)).startswith("OBJECT"), F.lit(False))
    told = told.select("doc", F.when(sound, record).alias("result"), F.coalesce("failure", F.when(~sound, F.lit("the selection is not a record"))).alias("_error"))
    return found.join(told, "doc", "left").withColumn("error", F.coalesce("error", "_error")).drop("_error")


def info_only(infos: DataFrame) -> DataFrame:
    """infos with `result`: the record as read, in the form that the selection gives (author as a list)."""
    r = F.col("info_reply")
    names = split_authors(r["author"])
    author = F.when(F.size(names) > 0, names)
    rest = [r[c].alias(c) for c in ("title", "subtitle", "publisher", "keywords", "description")]
    detail = F.struct(author.alias("author"), *rest, F.lit(None).cast("string").alias("subject"), F.lit(None).cast("array<string>").alias("isbn_identifiers"))
    return infos.withColumn("result", F.when(r.isNotNull(), F.to_json(detail)))


def run(docs: DataFrame, config: PipelineConfig, mode: str = "full", attempts: int = 3, prompt: str = "default") -> DataFrame:
    """doc, pdf_hash, path, result, error. Mode "full" extracts, searches and selects, "bookinfo" stops after extraction."""
    if mode not in ("full", "bookinfo"):
        raise ValueError(f"no such mode: {mode}")
    infos = staged(extract(docs, config, attempts, prompt))
    out = info_only(infos) if mode == "bookinfo" else select_best(staged(search(infos, config, attempts)), config, attempts)
    return out.select("doc", "pdf_hash", "path", "result", "error")


def run_batch(docs: DataFrame, config: PipelineConfig, log: str, mode: str = "full", attempts: int = 3, prompt: str = "default") -> DataFrame:
    """pdf_hash, status, error of each distinct content: `cached` if the log holds a run of it with this config and mode,
    else `processed` or `failed`. Processed ones are appended to the log; where it can't be written they are `not logged`."""
    spark = docs.sparkSession
    signature = json.dumps({"mode": mode, "prompt": PROMPTS.get(prompt, prompt), "config": json.loads(config.to_json())}, sort_keys=True)
    known = run_log.read_runs(spark, log).where(F.col("pipeline_config") == signature).select("pdf_hash").distinct()
    docs = docs.dropDuplicates(["pdf_hash"])
    old = staged(docs.select("pdf_hash").join(known, "pdf_hash", "left_semi"))
    done = staged(run(docs.join(old, "pdf_hash", "left_anti"), config, mode, attempts, prompt))
    good = done.where("result is not null")
    rows = good.select(F.element_at(F.split("path", "/"), -1).alias("pdf_name"), "pdf_hash", F.lit(signature).alias("pipeline_config"), "result", F.current_timestamp().alias("run_timestamp"))
    logged = run_log.append_runs(rows, log)
    fresh = done.select("pdf_hash", F.when(F.col("result").isNotNull(), "processed" if logged else "not logged").otherwise("failed").alias("status"), "error")
    return fresh.unionByName(old.select("pdf_hash", F.lit("cached").alias("status"), F.lit(None).cast("string").alias("error")))
