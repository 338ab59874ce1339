"""Queries about files: page images, content identity, file records, catalogue answers, keyword clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import images as I
from ..functions import metadata as M
from ..operators import catalogues, dedupe, keywords
from .catalog import j, query, t

# Parts stand in for pages: their pixels are dark up to a place, white from there on.
_W, _H = "(p_size % 9 + 1)", "(p_partkey % 7 + 1)"
_K = f"(p_partkey % ({_W} * {_H} + 1))"
_HEX = f"concat(repeat('61', cast({_K} as int)), repeat('FF', cast({_W} * {_H} - {_K} as int)))"


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    image = F.struct(F.expr(f"cast({_W} as int)").alias("width"), F.expr(f"cast({_H} as int)").alias("height"), F.lit(1).alias("channels"), F.expr(f"unhex({_HEX})").alias("pixels"))
    return t(spark, sf_dir, "part").select("p_partkey", "p_size", image.alias("image"))


_S_DIGEST = f"sha256(encode({_W} || 'x' || {_H} || 'x1') || unhex({_HEX}))"


@query(f"SELECT p_partkey, {_S_DIGEST} AS digest, 'data:image/png;base64,' || to_base64(unhex({_HEX})) AS url FROM part")
def page_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).select("p_partkey", I.digest(F.col("image")).alias("digest"), I.data_url(F.col("image.pixels")).alias("url"))


@query(f"SELECT p_partkey, {_K}::BIGINT AS shown, {_K} / ({_W} * {_H}) <= 0.005 AS blank FROM part")
def blank_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.pages import is_blank

    got = _pages(spark, sf_dir).select("p_partkey", I.nonwhite(F.col("image")).alias("shown"), (F.col("image.width") * F.col("image.height")).alias("total"))
    return got.select("p_partkey", "shown", is_blank(F.col("shown"), F.col("total")).alias("blank"))


_S_LONG = "greatest(p_size * 97, p_partkey % 7 * 311 + 1)"


@query(f"""SELECT p_partkey, CASE WHEN {_S_LONG} > 1600 THEN greatest(floor(p_size * 97 * 1600 / {_S_LONG}), 1) ELSE p_size * 97 END::INT AS width,
  CASE WHEN {_S_LONG} > 1600 THEN greatest(floor((p_partkey % 7 * 311 + 1) * 1600 / {_S_LONG}), 1) ELSE p_partkey % 7 * 311 + 1 END::INT AS height FROM part""")
def image_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = I.long_edge((F.col("p_size") * 97).cast("int"), (F.col("p_partkey") % 7 * 311 + 1).cast("int"))
    return t(spark, sf_dir, "part").select("p_partkey", s["width"].alias("width"), s["height"].alias("height"))


@query(f"SELECT p_partkey, least({_W}, 4)::INT AS width, {_K} = 0 OR {_K} = {_W} * {_H} AS plain FROM part WHERE {_W} >= {_H}")
def prepared_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scaled to four pixels; a page of one shade has nothing to stretch."""
    p = _pages(spark, sf_dir).where(f"{_W} >= {_H}")
    grey = I.preprocessed(F.col("image"))
    return p.select("p_partkey", I.scaled(F.col("image"), 4)["width"].alias("width"), F.hex(grey["pixels"]).rlike("^((61)*|(FF)*)$").alias("plain"))


@query(f"""
WITH d AS (SELECT p_partkey // 3 AS doc, p_partkey % 3 AS page, {_S_DIGEST} AS digest FROM part),
s AS (SELECT doc, count(*) AS page_count, arg_min(digest, page) AS first, arg_max(digest, page) AS last FROM d GROUP BY doc),
f AS (SELECT *, min(doc) OVER (PARTITION BY page_count, first, last) AS first_seen FROM s)
SELECT doc, first_seen, CASE WHEN doc = first_seen THEN 'unique' ELSE 'duplicate' END AS status FROM f""")
def dedupe_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _pages(spark, sf_dir).select(F.expr("p_partkey div 3").alias("doc"), (F.col("p_partkey") % 3).alias("page"), I.digest(F.col("image")).alias("digest"))
    return dedupe.first_seen(dedupe.content_signature(pages, "doc", "page", "digest"), F.col("signature"), "doc").select("doc", "first_seen", "status")


_TAGS = "p_type || ', ' || p_brand || ' ,, ' || p_type"


@query("SELECT p_partkey, p_type || '|' || p_brand AS keywords, CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE 'file_' || p_partkey END AS title, date '2001-02-03' AS day FROM part")
def file_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    info = F.map_filter(F.create_map(F.lit("Keywords"), F.expr(_TAGS), F.lit("Title"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")), F.lit("CreationDate"), F.lit("D:20010203040506Z")), lambda k, v: v.isNotNull())
    r = M.from_info(info, F.concat(F.lit("/in/file_"), F.col("p_partkey").cast("string"), F.lit(".pdf")))
    return t(spark, sf_dir, "part").select("p_partkey", j(r["categories"]).alias("keywords"), r["title"].alias("title"), r["published_date"].alias("day"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN '/out/' || p_name || '.x' ELSE '/out/dir' || p_size || '/in.pdf' END AS dest FROM part")
def destinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("/out/"), "p_name", F.lit(".x"))).otherwise(F.concat(F.lit("/out/dir"), F.col("p_size").cast("string"), F.lit("/")))
    return t(spark, sf_dir, "part").select("p_partkey", M.destination(asked, F.lit("in.pdf")).alias("dest"))


@query("SELECT p_partkey, true AS same, p_partkey % 2 = 0 AS other, p_type || '|' || p_brand AS authors FROM part")
def record_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records read back from JSON: sets without order or repeats, unknown fields ignored."""
    record = lambda names, title: F.to_json(F.struct(names.alias("authors"), title.alias("title"), F.lit(1).alias("unknown")))
    a = M.writer_input(record(F.array("p_type", "p_brand", "p_type"), F.col("p_name")))
    b = M.writer_input(record(F.array("p_brand", "p_type"), F.col("p_name")))
    c = M.writer_input(record(F.array("p_brand", "p_type"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_name"))))
    same = lambda x, y: M.same_record(x, y, ("title", "authors", "categories", "isbn13"))
    return t(spark, sf_dir, "part").select("p_partkey", same(a, b).alias("same"), same(a, c).alias("other"), j(a["authors"]).alias("authors"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 4 > 0 THEN p_partkey % 4 END::INT AS result_count, CASE WHEN p_partkey % 4 > 0 THEN p_name END AS title,
  CASE WHEN p_partkey % 4 > 0 THEN 0 END::INT AS ids, CASE WHEN p_partkey % 4 > 0 THEN p_name END AS query FROM part""")
def volume_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    info = F.struct(F.col("p_name").alias("title"), F.array("p_brand").alias("authors"), F.col("p_size").alias("pageCount"))
    answer = F.to_json(F.struct(F.array_repeat(F.struct(info.alias("volumeInfo"), F.lit("x").alias("kind")), (F.col("p_partkey") % 4).cast("int")).alias("items")))
    payload = catalogues.search_payload("googlebooks", F.col("p_name"), catalogues.simple_volumes(answer))
    p = F.from_json(payload, "query string, result_count int, items array<struct<title:string,industryIdentifiers:array<string>>>")
    return t(spark, sf_dir, "part").select("p_partkey", p["result_count"].alias("result_count"), p["items"][0]["title"].alias("title"), F.when(p.isNotNull(), F.size(p["items"][0]["industryIdentifiers"])).alias("ids"), p["query"].alias("query"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE 1 END::INT AS n, CASE WHEN p_partkey % 5 > 0 THEN p_brand END AS author,
  CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_partkey % 3 = 1 END AS by_author, CASE WHEN p_partkey % 3 > 0 THEN p_name END AS asked FROM part""")
def book_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers with errors are empty; a request needs a title, keywords or a description, and names the author if known."""
    p, n = t(spark, sf_dir, "part"), F.col("p_partkey")
    book = F.struct(F.col("p_name").alias("title"), F.array(F.struct(F.struct(F.col("p_brand").alias("name")).alias("author"))).alias("contributions"))
    answer = F.to_json(F.struct(F.struct(F.array(book).alias("books")).alias("data"), F.when(n % 5 == 0, F.array(F.lit("bad"))).alias("errors")))
    got, null = catalogues.simple_books(answer), F.lit(None).cast("string")
    ask = catalogues.books_request(F.when(n % 3 > 0, F.col("p_name")), F.when(n % 3 == 1, F.col("p_brand")), F.lit(None).cast("array<string>"), null)
    return p.select("p_partkey", F.size(got).alias("n"), F.try_element_at(F.try_element_at(got, F.lit(1))["authors"], F.lit(1)).alias("author"), F.when(ask.isNotNull(), ask["variables"]["known"]["contributions"].isNotNull()).alias("by_author"), ask["variables"]["known"]["title"]["_eq"].alias("asked"))


@query("""
WITH c AS (SELECT DISTINCT p_type AS tag, substr(p_type, 1, 3) AS canonical, p_size % 4 AS cluster FROM part)
SELECT canonical, string_agg(DISTINCT tag, '|' ORDER BY tag) AS tags, (SELECT count(DISTINCT cluster) FROM c) AS n_clusters FROM c GROUP BY canonical""")
def tag_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = t(spark, sf_dir, "part").select(F.col("p_type").alias("tag"), F.substring("p_type", 1, 3).alias("canonical"), (F.col("p_size") % 4).alias("cluster"))
    n = keywords.count_clusters(p, "cluster")
    return keywords.tag_sets(p, "canonical", "tag").select("canonical", j(F.col("tags")).alias("tags")).crossJoin(F.broadcast(n))  # one row


@query("SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_name || '|Bo' WHEN 1 THEN c_name END AS authors FROM customer")
def detailed_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .books import info_only

    null = F.lit(None).cast("string")
    said = F.when(F.col("c_custkey") % 3 == 0, F.concat("c_name", F.lit(" and Bo"))).when(F.col("c_custkey") % 3 == 1, F.col("c_name")).otherwise(" , ")
    reply = F.struct(said.alias("author"), F.col("c_name").alias("title"), null.alias("subtitle"), null.alias("publisher"), F.lit(None).cast("array<string>").alias("keywords"), null.alias("description"))
    done = info_only(t(spark, sf_dir, "customer").select("c_custkey", reply.alias("info_reply")))
    return done.select("c_custkey", j(F.from_json(F.get_json_object("result", "$.author"), "array<string>")).alias("authors"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'title' ELSE '' END AS missing FROM customer")
def required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = F.to_json(F.struct(F.when(F.col("c_custkey") % 2 == 1, F.col("c_name")).alias("title"), F.array("c_name").alias("keywords")))
    return t(spark, sf_dir, "customer").select("c_custkey", j(M.missing_fields(record, ("title", "keywords"))).alias("missing"))


