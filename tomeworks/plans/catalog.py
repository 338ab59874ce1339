"""The queries of the library by name, each with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import xmp
from ..operators import agglomerate, dedupe, keywords, lookup, pages, projection, publishers
from ..providers.base import ContextLimits, PipelineConfig
from ..sources import keyed, run_log
from ..sources.staging import local_dir, staged
from ..streaming import listen
from . import books, normalise

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The rules of functions/text.py in DuckDB's SQL.
def s_keyword(x: str) -> str:
    x = f"lower({x})"
    for pattern, token in ((X.URL, "<url>"), (X.EMAIL, "<email>"), (X.PHONE, "<phone>"), (r"\p{P}", ""), (r"\s+", " ")):
        x = f"regexp_replace({x}, '{pattern}', '{token}', 'g')"
    return f"trim({x})"


def s_publisher(x: str) -> str:
    k = s_keyword(x)
    y = rf"regexp_replace(trim(regexp_replace({k}, '{X.LICENSE}', '')), '^a\s+(.+)', '\1')"
    return f"coalesce(nullif(trim(string_split_regex({y}, '{X.SUFFIX}')[1]), ''), {k})"


def s_names(x: str, pattern: str) -> str:
    return f"list_filter(list_transform(string_split_regex({x}, '{pattern}'), lambda n: trim(n)), lambda n: n <> '')"


def s_join(x: str) -> str:
    return f"array_to_string({x}, '|')"


def j(x: Column) -> Column:
    """An array as text, so that engines compare alike."""
    return F.array_join(x, "|")


S_WORDS = r"list_distinct(string_split_regex(text, '\s+'))"


@query(rf"""
SELECT keyword, count(*) AS n_docs FROM (
  SELECT DISTINCT h, {s_keyword("w")} AS keyword FROM (SELECT h, unnest({S_WORDS}) AS w FROM (SELECT DISTINCT sha256(text) AS h, text FROM documents)))
WHERE keyword <> '' GROUP BY keyword""")
def keyword_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keywords.keyword_counts(t(spark, sf_dir, "documents").where("text is not null"), F.split("text", r"\s+"), F.sha2("text", 256))


_RAW = r"p_name || ' (No. ' || p_partkey || ') see https://shop.example.com/p?id=' || p_partkey || ' or mail part_' || p_size || '@example.com, tel +49 30 1234' || p_partkey || '  & sci-fi/' || p_type"


@query(f"SELECT p_partkey, {s_keyword('raw')} AS keyword FROM (SELECT p_partkey, {_RAW} AS raw FROM part)")
def normalize_keyword(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "part").select("p_partkey", F.expr(_RAW).alias("raw")).select("p_partkey", X.normalize_keyword(F.col("raw")).alias("keyword"))


_MISREAD = "CASE p_partkey % 7 WHEN 0 THEN replace(p_name, 'e', 'Ã©') WHEN 1 THEN replace(p_name, 'a', 'ÃƒÂ¡') WHEN 2 THEN p_name || ' itâ€™s â€œnewâ€\x9d' WHEN 3 THEN p_name || ' CAFÉ™ naïve' WHEN 4 THEN replace(p_name, 'o', 'Ã¶') || ' 日' WHEN 5 THEN replace(p_name, 'i', 'Ð¸') ELSE p_name END"


def s_repaired(x: str) -> str:
    latin = f"translate({x}, '{X.CP1252}', '{X.CP1252_BYTES}')"
    back = f"decode(unhex(array_to_string(list_transform(string_split({latin}, ''), lambda c: printf('%02X', unicode(c))), '')))"
    return f"CASE WHEN regexp_matches({x}, '{X.MISREAD}') AND regexp_full_match({latin}, '[\\x{{0}}-\\x{{FF}}]*') THEN coalesce(TRY({back}), {x}) ELSE {x} END"


@query(f"SELECT p_partkey, repaired, {s_repaired('repaired')} AS twice FROM (SELECT p_partkey, {s_repaired('raw')} AS repaired FROM (SELECT p_partkey, {_MISREAD} AS raw FROM part))")
def repaired_unicode(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = t(spark, sf_dir, "part").select("p_partkey", F.expr(_MISREAD).alias("raw"))
    return raw.select("p_partkey", X.repair_unicode(F.col("raw")).alias("repaired"), X.repair_unicode(F.col("raw"), rounds=2).alias("twice"))


_PUB = "CASE p_partkey % 7 WHEN 0 THEN 'A ' || p_name || ' Publishing' WHEN 1 THEN p_name || ', Inc.' WHEN 2 THEN p_name || ' LLC Games' WHEN 3 THEN p_name || ' distributed by ' || p_brand WHEN 4 THEN 'Press' WHEN 5 THEN upper(p_name) || ' GmbH & Co. KG' ELSE p_name END"


@query(f"SELECT p_partkey, {s_publisher('raw')} AS publisher FROM (SELECT p_partkey, {_PUB} AS raw FROM part)")
def normalize_publisher(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "part").select("p_partkey", F.expr(_PUB).alias("raw")).select("p_partkey", X.normalize_publisher(F.col("raw")).alias("publisher"))


_AUTHORS = "c_name || ', ' || c_mktsegment || ' AND Sandy & ' || c_name || ' , '"


@query(rf"SELECT c_custkey, {s_join(s_names(_AUTHORS, r'(?i),\s*|\band\b'))} AS authors FROM customer")
def split_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "customer").select("c_custkey", j(X.split_authors(F.expr(_AUTHORS))).alias("authors"))


@query(f"SELECT c_custkey, {s_names('a', '[,&]')}[1] AS first_author, len(list_distinct({s_names('a', '[,&]')})) AS n_authors FROM (SELECT c_custkey, {_AUTHORS} AS a FROM customer)")
def parse_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = X.parse_authors(F.expr(_AUTHORS))
    return t(spark, sf_dir, "customer").select("c_custkey", names[0].alias("first_author"), F.size(names).cast("long").alias("n_authors"))


@query("""
SELECT doc_id, sha256(text) AS dup_key, first_seen, CASE WHEN doc_id = first_seen THEN 'unique' ELSE 'duplicate' END AS status
FROM (SELECT *, min(doc_id) OVER (PARTITION BY text) AS first_seen FROM documents)""")
def dedupe_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.first_seen(t(spark, sf_dir, "documents").select("doc_id", "text"), F.sha2("text", 256), "doc_id").select("doc_id", "dup_key", "first_seen", "status")


@query("""
WITH s AS (SELECT conv_id, count(*) AS page_count, sha256(arg_min(text, turn)) AS first, sha256(arg_max(text, turn)) AS last FROM conversations GROUP BY conv_id),
f AS (SELECT *, min(conv_id) OVER (PARTITION BY page_count, first, last) AS first_seen FROM s)
SELECT conv_id, page_count, first_seen, CASE WHEN conv_id = first_seen THEN 'unique' ELSE 'duplicate' END AS status FROM f""")
def dedupe_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = t(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("page_count"), F.sha2(F.min_by("text", "turn"), 256).alias("first"), F.sha2(F.max_by("text", "turn"), 256).alias("last"))
    return dedupe.first_seen(s, F.struct("page_count", "first", "last"), "conv_id").select("conv_id", "page_count", "first_seen", "status")


@query("""
SELECT conv_id, turn, length(text) AS n FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS a, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS z
  FROM conversations WHERE length(regexp_replace(text, '\\s', '', 'g')) / greatest(length(text), 1) > 0.005 AND length(text) > 0) WHERE a <= 2 OR z <= 1""".replace("\\\\", "\\"))
def sample_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    blank = pages.is_blank(F.length(F.regexp_replace("text", r"\s", "")), F.length("text"))
    return pages.sample_pages(t(spark, sf_dir, "conversations"), "conv_id", "turn", blank, 2, 1).select("conv_id", "turn", F.length("text").cast("long").alias("n"))


@query("""
SELECT conv_id, array_to_string(list_distinct_ordered, '|') AS turns FROM (
  SELECT conv_id, list(turn ORDER BY turn) AS list_distinct_ordered FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS a, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS z FROM (SELECT DISTINCT conv_id, turn FROM conversations))
  WHERE a <= 3 OR z <= 2 GROUP BY conv_id)""")
def context_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = t(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_set("turn")).alias("p"))
    return own.select("conv_id", j(pages.context_pages(F.col("p"), 3, 2).cast("array<string>")).alias("turns"))


@query("""
SELECT conv_id, string_agg(CASE WHEN trim(coalesce(text, '')) <> '' THEN '=== Page ' || (turn + 1) || ' - ' || role || ' ===' || chr(10) || text || chr(10) ELSE '' END, chr(10) ORDER BY turn) AS combined_text, bool_or(trim(coalesce(text, '')) <> '') AS has_text
FROM conversations GROUP BY conv_id""")
def combined_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = t(spark, sf_dir, "conversations").select("conv_id", (F.col("turn") + 1).alias("n"), F.array(F.struct(F.col("role").alias("method"), "text")).alias("results"))
    return pages.combined_text(p, "conv_id", "n", "results")


_ISBNS = "array('978-' || lpad(cast(p_partkey as string), 9, '3') || '-7', lpad(cast(p_size as string), 9, '0') || '-X', '0-' || lpad(cast(p_partkey as string), 9, '4'))"
_S_ISBNS = _ISBNS.replace("array(", "[", 1)[:-1].replace("as string", "as varchar") + "]"


def _s_isbn(n: int) -> str:
    return f"list_filter(list_transform({_S_ISBNS}, lambda x: regexp_replace(x, '[^0-9]', '', 'g')), lambda x: length(x) = {n})[1]"


_S_X = f"nullif(regexp_replace({_S_ISBNS}[2], '[^0-9Xx]', '', 'g'), '')"


@query(f"SELECT p_partkey, {_s_isbn(13)} AS isbn13, {_s_isbn(10)} AS isbn10, CASE WHEN length({_S_X}) = 10 THEN {_S_X} END AS x10, CASE WHEN length({_S_X}) <> 10 THEN {_S_X} END AS x13 FROM part")
def isbn_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = F.expr(_ISBNS)
    with_x = X.isbn_with_x(ids[1])
    return t(spark, sf_dir, "part").select("p_partkey", X.isbn_digits(ids, 13).alias("isbn13"), X.isbn_digits(ids, 10).alias("isbn10"), with_x["isbn10"].alias("x10"), with_x["isbn13"].alias("x13"))


_LIST = "CASE event_id % 5 WHEN 0 THEN '[\"' || event_type || '\", \"' || user_id || '\", \"\"]' WHEN 1 THEN event_type WHEN 2 THEN '' WHEN 3 THEN NULL ELSE props END"


@query(f"""
SELECT event_id, array_to_string(CASE WHEN event_id % 5 = 0 THEN [event_type, user_id::VARCHAR] WHEN event_id % 5 IN (2, 3) THEN []::VARCHAR[] ELSE [raw] END, '|') AS items
FROM (SELECT *, {_LIST} AS raw FROM events)""")
def load_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "events").select("event_id", j(X.json_list(F.expr(_LIST))).alias("items"))


_RESULT = "CASE c_custkey % 3 WHEN 0 THEN '{\"author\": [\"' || c_name || '\", \"B\"]}' WHEN 1 THEN '{\"author\": \"' || c_name || ', B\"}' ELSE '{\"author\": null}' END"


@query("SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_name || '|B' WHEN 1 THEN c_name || ', B' END AS authors FROM customer")
def union_author(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "customer").select("c_custkey", j(X.author_list(F.expr(_RESULT))).alias("authors"))


_ENTITY = f"""
SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_brand END AS author, p_name AS title,
  CASE WHEN length({_s_isbn(13)}) = 13 THEN {_s_isbn(13)} END AS isbn13,
  array_to_string(list_sort(list_distinct([lower(p_type), lower(trim(p_mfr))])), '|') AS tags FROM (SELECT *, p_brand || ' ' AS p_mfr FROM part)"""


def _entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = t(spark, sf_dir, "part")
    author = F.when(F.col("p_partkey") % 4 == 0, F.array().cast("array<string>")).otherwise(F.array("p_brand", "p_type"))
    null = F.lit(None).cast("string")
    e = lookup.book_entity(author, F.col("p_name"), null, F.col("p_name"), null, F.array("p_type", F.concat("p_brand", F.lit(" ")), F.lit(" ")), F.lit(None).cast("array<string>"), null, F.expr(_ISBNS))
    return part.select("p_partkey", e.alias("e"))


@query(_ENTITY)
def book_metadata_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("e")
    return _entities(spark, sf_dir).select("p_partkey", F.try_element_at(e["authors"], F.lit(1)).alias("author"), e["title"].alias("title"), e["isbn_13"].alias("isbn13"), j(e["tags"]).alias("tags"))


@query(_ENTITY.replace("AS tags", "AS categories").replace(" AS title", " AS title, length(p_name) > 0 AS has_publisher"))
def writer_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.from_json(F.to_json(lookup.writer_payload(F.col("e"))), "authors array<string>, title string, publisher string, categories array<string>, isbn13 string")
    return _entities(spark, sf_dir).select("p_partkey", p.alias("p")).select("p_partkey", F.col("p.authors")[0].alias("author"), "p.title", F.col("p.publisher").isNotNull().alias("has_publisher"), "p.isbn13", j(F.col("p.categories")).alias("categories"))


@query("""
WITH m AS (SELECT l.doc_id, sha256(d.text) AS file_hash, 'doc_' || (l.doc_id + 1) || '.pdf' AS file_name, l.quality FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
h AS (SELECT file_hash, arg_max(quality, doc_id) AS q FROM m GROUP BY 1), n AS (SELECT file_name, arg_max(quality, doc_id) AS q FROM m GROUP BY 1),
f AS (SELECT doc_id, sha256(text) AS file_hash, 'doc_' || doc_id || '.pdf' AS file_name FROM documents)
SELECT f.doc_id, coalesce(h.q, n.q)::VARCHAR AS entity, CASE WHEN h.q IS NOT NULL THEN 'hash' WHEN n.q IS NOT NULL THEN 'name' END AS matched_by
FROM f LEFT JOIN h ON f.file_hash = h.file_hash LEFT JOIN n ON f.file_name = n.file_name""")
def metadata_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = t(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("file_hash"))
    name = lambda n: F.concat(F.lit("doc_"), n.cast("string"), F.lit(".pdf"))
    meta = t(spark, sf_dir, "labels").join(docs, "doc_id").select("doc_id", "file_hash", name(F.col("doc_id") + 1).alias("file_name"), F.col("quality").alias("entity"))
    return lookup.metadata_lookup(docs.withColumn("file_name", name(F.col("doc_id"))), meta, "doc_id").select("doc_id", F.col("entity").cast("string").alias("entity"), "matched_by")


@query("""
WITH q AS (SELECT o_orderkey AS query_id, o_orderpriority AS title, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE 'nobody' END AS author FROM orders WHERE o_orderkey % 50 = 0),
c AS (SELECT o_orderkey AS item, o_orderpriority AS title, o_orderstatus AS author, o_totalprice AS users FROM orders),
b AS (SELECT q.query_id, c.item, c.users, 'title+author' AS matched_by FROM q JOIN c ON q.title = c.title AND q.author = c.author),
a AS (SELECT * FROM b UNION ALL SELECT q.query_id, c.item, c.users, 'title' FROM q JOIN c ON q.title = c.title WHERE q.query_id NOT IN (SELECT query_id FROM b)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY users DESC, item) AS rank FROM a)
SELECT query_id, item, matched_by, rank FROM r WHERE rank <= 3""")
def catalog_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders")
    q = o.where("o_orderkey % 50 = 0").select(F.col("o_orderkey").alias("query_id"), F.col("o_orderpriority").alias("title"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).otherwise("nobody").alias("author"))
    c = o.select(F.col("o_orderkey").alias("item"), F.col("o_orderpriority").alias("title"), F.col("o_orderstatus").alias("author"), F.col("o_totalprice").alias("users"))
    return lookup.catalogue_search(q, c, "users", 3).select("query_id", "item", "matched_by", F.col("rank").cast("long").alias("rank"))


@query()
def catalog_search_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """catalog_search with every order as a query against every order; its pairs are too many for SQL that joins them."""
    o = t(spark, sf_dir, "orders")
    q = o.select(F.col("o_orderkey").alias("query_id"), F.col("o_orderpriority").alias("title"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).otherwise("nobody").alias("author"))
    c = o.select(F.col("o_orderkey").alias("item"), F.col("o_orderpriority").alias("title"), F.col("o_orderstatus").alias("author"), F.col("o_totalprice").alias("users"))
    return lookup.catalogue_search(q, c, "users", 3).select("query_id", "item", "matched_by", F.col("rank").cast("long").alias("rank"))


_S_NAMES = f"SELECT norm, min(pos) AS pos FROM (SELECT {s_publisher('name')} AS norm, pos FROM (SELECT p_name AS name, min(p_partkey) AS pos FROM part WHERE trim(p_name) <> '' GROUP BY 1)) GROUP BY 1"
#: The dynamic program of the longest common subsequence, one character of the first name at a time.
_S_RATIO = f"""
WITH RECURSIVE n AS ({_S_NAMES}),
p AS (SELECT a.norm AS a, b.norm AS b, a.pos AS pa, b.pos AS pb FROM n a JOIN n b ON a.norm < b.norm),
d AS (SELECT a, b, 0 AS i, list_transform(range(length(b) + 1), lambda x: 0) AS r FROM p
  UNION ALL SELECT a, b, i + 1, list_reduce(list_transform(range(1, length(b) + 1), lambda k: [r[k] + CASE WHEN substr(a, i + 1, 1) = substr(b, k, 1) THEN 1 ELSE -1000 END, r[k + 1]]),
      lambda acc, x: list_append(acc, greatest(acc[len(acc)], greatest(x[1], x[2]))), [0]) FROM d WHERE i < length(a)),
l AS (SELECT a, b, r[len(r)] AS lcs FROM d WHERE i = length(a)),
m AS (SELECT a, b, round(200.0::DOUBLE * lcs / (length(a) + length(b)), 4) AS ratio, 200.0::DOUBLE * lcs / (length(a) + length(b)) >= 75 OR starts_with(b, a) OR starts_with(a, b) AS ok FROM l)
"""


def _publisher_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publishers.publisher_names(t(spark, sf_dir, "part"), "p_name", "p_partkey")


@query(_S_RATIO + "SELECT a, b, ratio FROM m WHERE ok")
def fuzzy_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publishers.fuzzy_pairs(_publisher_rows(spark, sf_dir))


#: Names in order of appearance: each joins the first seed that it matches, or becomes one.
_S_GREEDY = """
, o AS (SELECT n.norm, row_number() OVER (ORDER BY pos, n.norm) AS k, coalesce(near, []::VARCHAR[]) AS near
  FROM n LEFT JOIN (SELECT x AS norm, list(y) AS near FROM (SELECT a AS x, b AS y FROM m WHERE ok UNION ALL SELECT b, a FROM m WHERE ok) GROUP BY x) USING (norm)),
g AS (SELECT 0::BIGINT AS k, []::VARCHAR[] AS seeds, NULL::VARCHAR AS norm, NULL::VARCHAR AS seed
  UNION ALL SELECT k, CASE WHEN found IS NULL THEN list_append(seeds, norm) ELSE seeds END, norm, coalesce(found, norm)
  FROM (SELECT o.k, g.seeds, o.norm, list_filter(g.seeds, lambda s: list_contains(o.near, s))[1] AS found FROM g JOIN o ON o.k = g.k + 1)),
"""
_S_ALL = f"w AS (SELECT name, seed FROM (SELECT DISTINCT p_name AS name, {s_publisher('p_name')} AS norm FROM part WHERE trim(p_name) <> '') JOIN g USING (norm))"


@query(_S_RATIO + _S_GREEDY + _S_ALL + """
SELECT name, canonical FROM w JOIN (SELECT seed, arg_min(name, (length(name), name)) AS canonical FROM w GROUP BY seed) USING (seed)""")
def canonical_publisher(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = staged(_publisher_rows(spark, sf_dir))
    return publishers.canonical_names(publishers.greedy_groups(names, publishers.fuzzy_pairs(names)))


@query(rf"""
WITH w AS (SELECT DISTINCT doc_id, unnest({S_WORDS}) AS raw FROM documents), k AS (SELECT doc_id, raw, {s_keyword("raw")} AS keyword FROM w),
c AS (SELECT keyword, substr(keyword, 1, 3) AS cluster FROM (SELECT DISTINCT keyword FROM k) WHERE length(keyword) >= 3),
l AS (SELECT cluster, {s_keyword("arg_min(keyword, (length(keyword), keyword))")} AS label FROM c GROUP BY cluster),
m AS (SELECT k.doc_id, coalesce(l.label, k.keyword) AS word FROM k LEFT JOIN c ON k.keyword = c.keyword LEFT JOIN l ON l.cluster = c.cluster)
SELECT doc_id, count(DISTINCT word) AS n, md5(string_agg(DISTINCT word, '|' ORDER BY word)) AS canonical FROM m WHERE word <> '' GROUP BY doc_id""")
def keyword_canonicalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t(spark, sf_dir, "documents").select("doc_id", F.array_distinct(F.split("text", r"\s+")).alias("words"))
    words = keywords.distinct_words(rows, "words").select("keyword").distinct().where("length(keyword) >= 3")
    clusters = words.select("keyword", F.substring("keyword", 1, 3).alias("cluster_id"))
    mapping = clusters.join(keywords.label_clusters(clusters), "cluster_id").select("keyword", "label")
    out = keywords.apply_canonical(rows, "doc_id", "words", mapping)
    return out.select("doc_id", F.size("canonical").cast("long").alias("n"), F.md5(j(F.col("canonical"))).alias("canonical"))


@query("""
SELECT a.vec_id, b.vec_id AS query_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS cosine
FROM embeddings a JOIN embeddings b ON b.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND a.label = b.label""")
def cosine_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = t(spark, sf_dir, "embeddings")
    q = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"), "label")
    return e.join(q, "label").where("vec_id <> query_id").select("vec_id", "query_id", F.round(X.cosine(F.col("embedding"), F.col("q")), 6).alias("cosine"))


@query()
def cluster_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise.clusters_of_labels(t(spark, sf_dir, "embeddings"), "label", "vec_id", "embedding", 8)


@query("""
WITH RECURSIVE c AS (SELECT c_custkey AS item, CASE WHEN c_custkey > 1 THEN c_custkey // 2 END AS parent, row_number() OVER (ORDER BY c_custkey DESC) - 1 AS rank, count(*) OVER () AS n FROM customer),
f AS (SELECT item, k, n - k AS most, item AS cluster FROM c, (SELECT unnest([5, 50, 500, 100000]) AS k)
  UNION ALL SELECT f.item, f.k, f.most, c.parent FROM f JOIN c ON c.item = f.cluster AND c.parent IS NOT NULL AND c.rank < f.most)
SELECT item, k, min(cluster) AS cluster FROM f GROUP BY item, k""")
def dendrogram_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cuts of one tree for several numbers of clusters: customers, each absorbed by the one of half its number, the highest first."""
    c = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("item"))
    tree = c.where("item > 1").select("item", F.expr("item div 2").alias("parent"), (1 / F.col("item")).alias("height"), F.lit(0).alias("step"))
    return agglomerate.cuts(c, tree, [5, 50, 500, 100000]).select("item", "k", "cluster")


@query(r"""
WITH n AS (SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN p_name || '_' || (p_partkey % 5) || '.pdf' ELSE p_name || '.pdf' END AS target FROM part),
h AS (SELECT DISTINCT p_name || CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE '_' || s_suppkey % 13 END || '.pdf' AS path FROM part JOIN supplier ON p_partkey = s_suppkey),
w AS (SELECT DISTINCT target FROM n), a AS (SELECT path FROM h UNION SELECT target FROM w),
x AS (SELECT path AS target, 0 AS k FROM h UNION SELECT regexp_extract(path, '^(.*)_([1-9][0-9]{0,8})(\.[^./]*)?$', 1) || regexp_extract(path, '^(.*)_([1-9][0-9]{0,8})(\.[^./]*)?$', 3), try_cast(regexp_extract(path, '^(.*)_([1-9][0-9]{0,8})(\.[^./]*)?$', 2) AS INT) FROM a),
r AS (SELECT p_partkey, target, row_number() OVER (PARTITION BY target ORDER BY p_partkey) AS r FROM n),
s AS (SELECT target, max(r) AS m FROM r GROUP BY 1), c AS (SELECT target, unnest(range(m + (SELECT count(*) FROM x WHERE x.target = s.target))) AS k FROM s),
o AS (SELECT target, k, row_number() OVER (PARTITION BY target ORDER BY k) AS r FROM c WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.target = c.target AND x.k = c.k))
SELECT p_partkey, CASE WHEN k = 0 THEN target ELSE regexp_replace(target, '\.pdf$', '') || '_' || k || '.pdf' END AS dest FROM r JOIN o USING (target, r)""")
def move_plan_taken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free names beside those that lie in the destination."""
    p, u = t(spark, sf_dir, "part"), t(spark, sf_dir, "supplier")
    name = F.when(F.col("p_partkey") % 7 == 0, F.concat("p_name", F.lit("_"), (F.col("p_partkey") % 5).cast("string"))).otherwise(F.col("p_name"))
    taken = p.join(u, F.col("p_partkey") == F.col("s_suppkey")).select(F.concat("p_name", F.when(F.col("s_suppkey") % 4 == 0, "").otherwise(F.concat(F.lit("_"), (F.col("s_suppkey") % 13).cast("string"))), F.lit(".pdf")).alias("path"))
    return dedupe.free_names(p.select("p_partkey", F.concat(name, F.lit(".pdf")).alias("target")), "target", "p_partkey", taken).select("p_partkey", "dest")


@query("""
WITH u AS (SELECT vec_id, label, list_transform(embedding::DOUBLE[], lambda v: v / sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda w: w * w)))) AS u FROM embeddings),
d AS (SELECT a.vec_id, a.label, b.label AS other, sum(1 - list_dot_product(a.u, b.u)) AS s, count(*) AS n FROM u a JOIN u b ON true GROUP BY ALL),
e AS (SELECT vec_id, label, max(CASE WHEN other = label AND n > 1 THEN s / (n - 1) END) AS a, min(CASE WHEN other <> label THEN s / n END) AS b FROM d GROUP BY ALL)
SELECT label, round(avg(CASE WHEN a IS NULL OR b IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM e GROUP BY label""")
def silhouette(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keywords.silhouette(t(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label").withColumn("silhouette", F.round("silhouette", 6))


def _packet(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = t(spark, sf_dir, "part")
    m = {
        "title": F.concat("p_name", F.lit(" <&> "), "p_type"), "description": F.col("p_type"), "publisher": F.col("p_brand"), "language": F.lit("en"), "authors": F.array("p_brand", "p_name"), "categories": F.array("p_type"),
        "google_id": F.concat(F.lit("g"), F.col("p_partkey").cast("string")), "asin": F.lit(" "), "isbn13": F.expr("'978' || lpad(cast(p_partkey as string), 10, '0')"), "series_name": F.when(F.col("p_partkey") % 2 == 0, F.col("p_brand")),
        "series_number": F.col("p_size") / 4, "published_date": F.expr("date_add(date'2001-01-01', p_size)"),
    }
    return part.select("p_partkey", "p_size", xmp.write_xmp(m, F.lit("2026-01-01 00:00:00").cast("timestamp")).alias("packet"))


@query("""
SELECT p_partkey, p_name || ' <&> ' || p_type AS title, p_brand AS publisher, p_brand || '|' || p_name AS authors, p_type AS categories, 'g' || p_partkey AS google_id, NULL::VARCHAR AS asin, '978' || lpad(p_partkey::VARCHAR, 10, '0') AS isbn,
  CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS series_name, CASE WHEN p_partkey % 2 = 0 THEN round(p_size / 4, 2) END AS series_number, (date '2001-01-01' + p_size)::DATE AS create_date, 'tomeworks' AS creator_tool FROM part""")
def xmp_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _packet(spark, sf_dir).select("p_partkey", xmp.record(F.col("packet")).alias("r")).select("p_partkey", "r.*")
    return r.select("p_partkey", "title", "publisher", j(F.col("authors")).alias("authors"), j(F.col("categories")).alias("categories"), "google_id", "asin", "isbn", "series_name", F.round(F.col("series_number").cast("double"), 2).alias("series_number"), "create_date", "creator_tool")


@query("SELECT p_partkey, false AS same, p_partkey % 3 = 0 AS changed, true AS unknown FROM part")
def xmp_differs(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = F.col("packet")
    later = F.replace(a, F.lit("2026-01-01T"), F.lit("2027-02-02T"))
    other = F.when(F.col("p_partkey") % 3 == 0, F.replace(later, F.lit("<rdf:li>"), F.lit("<rdf:li>new "))).otherwise(later)
    return _packet(spark, sf_dir).select("p_partkey", xmp.differs(a, later).alias("same"), xmp.differs(a, other).alias("changed"), xmp.differs(a, F.lit(None).cast("string")).alias("unknown"))


@query(r"""
SELECT page_id, list_bool_or(list_transform(string_split(url, '/'), lambda p: starts_with(p, 'blog.'))) AND NOT list_contains(string_split(url, '/'), 'es')
  AND NOT regexp_matches(url, '\[[A-Za-z]{2}\]') AND NOT contains(url, 'utm_source') AS allowed FROM pages""")
def path_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "pages").select("page_id", X.path_allowed(F.col("url"), "blog.", "es", ("utm_source",)).alias("allowed"))


_NAME = "p_name || CASE p_partkey % 6 WHEN 0 THEN '.tar.gz' WHEN 1 THEN '.tbz2' WHEN 2 THEN '.ZIP' WHEN 3 THEN '.7z' WHEN 4 THEN '.txt' ELSE '.tar.bz2' END"


@query("SELECT p_partkey, CASE WHEN p_partkey % 6 <> 4 THEN p_name END AS dest FROM part")
def archive_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "part").select("p_partkey", X.archive_stem(F.expr(_NAME)).alias("dest"))


@query("""
SELECT p_partkey, CASE WHEN n = 0 THEN p_name || '.pdf' ELSE p_name || '_' || n || '.pdf' END AS dest FROM (SELECT p_partkey, p_name, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) - 1 AS n FROM part)""")
def move_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = t(spark, sf_dir, "part").select("p_partkey", F.concat("p_name", F.lit(".pdf")).alias("target"))
    return dedupe.free_names(p, "target", "p_partkey").select("p_partkey", "dest")


@query(r"SELECT page_id, regexp_replace(url, '^(.*/)?([^/]+)/([^/]+)$', '\1\2_\3') AS dest FROM pages WHERE regexp_replace(url, '^(.*/)?([^/]+)/([^/]+)$', '\1\2_\3') <> url")
def flatten_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.flatten_plan(t(spark, sf_dir, "pages"), "url").select("page_id", "dest")


@query("""
SELECT doc_id FROM (SELECT min(doc_id) AS doc_id FROM documents WHERE sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE doc_id % 10 = 0) GROUP BY text)""")
def copy_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = t(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    return dedupe.copy_plan(d, d.where("doc_id % 10 = 0"), "h", "doc_id").select("doc_id")


@query(r"SELECT page_id, coalesce(nullif(trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)), ''), regexp_replace(string_split(url, '/')[-1], '(.)\.[^.]*$', '\1')) AS title FROM pages")
def html_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = X.blank_to_null(F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1))
    return t(spark, sf_dir, "pages").select("page_id", F.coalesce(title, X.stem(X.file_name(F.col("url")))).alias("title"))


@query("SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS status FROM events GROUP BY user_id")
def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = t(spark, sf_dir, "events").select("user_id", "event_id", F.col("event_type").alias("status"), F.struct("ts", "event_id").alias("at"))
    return run_log.latest(e, "user_id", "at").select("user_id", "event_id", "status")


@query("SELECT event_id, user_id, event_type AS title, user_id || '|x' AS keywords FROM events")
def run_log_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = t(spark, sf_dir, "events")
    result = F.to_json(F.struct(F.col("event_type").alias("title"), F.array(F.lit("x"), F.col("user_id").cast("string"), F.lit("x")).alias("keywords"), F.col("event_type").alias("author")))
    runs = e.select(F.col("event_id").cast("string").alias("pdf_name"), F.col("user_id").cast("string").alias("pdf_hash"), F.lit("{}").alias("pipeline_config"), result.alias("result"), F.col("ts").cast("timestamp").alias("run_timestamp"))
    path = f"{run_dir(spark)}/runs"
    if not run_log.append_runs(runs.withColumn("run_timestamp", F.date_trunc("year", "run_timestamp")), path):
        raise RuntimeError("the run log was not written")
    return run_log.parsed(run_log.read_runs(spark, path)).select(F.col("pdf_name").cast("long").alias("event_id"), F.col("pdf_hash").cast("long").alias("user_id"), "title", j(F.col("keywords")).alias("keywords"))


def run_dir(spark: SparkSession) -> str:
    import uuid

    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or local_dir(spark)
    return f"{root}/job-{uuid.uuid4().hex}"


@query("SELECT event_type AS status, count(*) AS n, count(DISTINCT user_id) AS documents, arg_max(event_id, (ts, event_id)) AS last_event FROM events GROUP BY event_type")
def batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "events").groupBy(F.col("event_type").alias("status")).agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("documents"), F.max_by("event_id", F.struct("ts", "event_id")).alias("last_event"))


@query("""SELECT DISTINCT sha256('{"model":"m","payload":"' || source || '/' || lang || '"}') AS cache_key FROM documents WHERE lang <> 'en'""")
def cache_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = lookup.cache_key(F.lit("m").alias("model"), F.concat_ws("/", "source", "lang").alias("payload"))
    r = t(spark, sf_dir, "documents").select("lang", key.alias("cache_key"))
    return lookup.cache_misses(r.select("cache_key"), r.where("lang = 'en'").select("cache_key").distinct())


_S_ENGLISH = "CASE WHEN c_custkey % 4 = 0 THEN ' ' ELSE c_name || ' ' END"


@query(f"""
SELECT c_custkey, concat_ws('+', CASE WHEN trim({_S_ENGLISH}) <> '' THEN 'intitle:' || trim({_S_ENGLISH}) END, CASE WHEN c_custkey % 3 > 0 THEN 'inauthor:' || c_mktsegment END) AS q,
  CASE WHEN c_custkey % 4 > 0 THEN trim({_S_ENGLISH}) WHEN c_custkey % 8 = 0 THEN c_mktsegment || ' b' ELSE substr(repeat(c_name, 20), 1, 200) END AS text FROM customer""")
def search_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.expr(_S_ENGLISH)
    author = F.when(F.col("c_custkey") % 3 > 0, F.col("c_mktsegment"))
    words = F.when(F.col("c_custkey") % 8 == 0, F.array(F.col("c_mktsegment"), F.lit(" "), F.lit("b"))).otherwise(F.array().cast("array<string>"))
    return t(spark, sf_dir, "customer").select("c_custkey", X.clauses(intitle=title, inauthor=author).alias("q"), X.query_text(title, words, F.repeat("c_name", 20)).alias("text"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'api_key=<redacted>|host=' || event_type ELSE 'host=' || event_type END AS options FROM events")
def redact_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.create_map(F.lit("api_key"), F.when(F.col("event_id") % 3 == 0, F.lit("x")), F.lit("host"), F.col("event_type"), F.lit("project"), F.lit(None).cast("string"))
    kept = F.transform(F.map_entries(X.redact(m)), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return t(spark, sf_dir, "events").select("event_id", j(kept).alias("options"))


@query("SELECT event_id, props AS body, CASE WHEN event_id % 4 > 0 THEN event_type END AS label FROM events")
def model_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    fenced = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("```json\n"), "props", F.lit("\n```"))).otherwise(F.col("props"))
    reply = F.when(F.col("event_id") % 4 > 0, F.concat(F.lit(' "'), "event_type", F.lit('"\nbecause it is'))).otherwise('""\nnothing')
    return t(spark, sf_dir, "events").select("event_id", X.strip_code_fences(fenced).alias("body"), X.first_line(reply).alias("label"))


@query("SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS chunk FROM orders")
def chunk_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.chunk_ids(t(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 1000)


@query("SELECT event_id, 'CANDIDATE 1:' || chr(10) || props || chr(10) || chr(10) || 'CANDIDATE 2:' || chr(10) || '{}' AS candidates FROM events")
def candidates_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "events").select("event_id", lookup.candidates_text(F.array(F.col("props"), F.lit("{not json"), F.lit("{}"))).alias("candidates"))


@query("SELECT n_nationkey, 'Region: ' || n_regionkey || chr(10) || 'Title: ' || n_name AS lines FROM nation")
def metadata_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.create_map(F.lit("title"), F.col("n_name"), F.lit("region"), F.col("n_regionkey").cast("string"), F.lit("subject"), F.lit(""))
    return t(spark, sf_dir, "nation").select("n_nationkey", X.metadata_lines(m).alias("lines"))


@query("SELECT c_custkey, 'O''Brien 2Nd-Edition ' || upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS title FROM customer")
def title_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "customer").select("c_custkey", X.title_case(F.concat(F.lit("o'brien 2nd-EDITION "), "c_mktsegment")).alias("title"))


@query("""
SELECT w.* FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2) w,
  (SELECT max(ts) - INTERVAL 1 HOUR AS mark FROM events) m WHERE w.window_start + INTERVAL 1 HOUR <= m.mark""")
def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = listen.table_stream(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    out = run_dir(spark)
    listen.run_available(listen.window_counts(stream), f"{out}/windows", f"{out}/state")
    got = spark.read.schema("window_start timestamp, event_type string, n long, total double").parquet(f"{out}/windows")
    return got.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("SELECT event_id, user_id FROM events")
def listen_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = listen.table_stream(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    twice = stream.withColumn("_n", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_n")
    out = run_dir(spark)
    listen.run_available(listen.distinct_events(twice, delay="3650 days").select("event_id", "user_id"), f"{out}/events", f"{out}/state")
    return spark.read.schema("event_id long, user_id long").parquet(f"{out}/events")


# The books: conversations stand in for documents, turns for pages, roles for OCR methods.
CONFIG = PipelineConfig(extractor="outline", search_methods=("naive",), limits=ContextLimits(first_pages=3, last_pages=1))


def _books(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = t(spark, sf_dir, "conversations")
    rows = c.groupBy(F.col("conv_id").alias("doc"), (F.col("turn") + 1).alias("page_number")).agg(F.array_sort(F.collect_list(F.struct(F.col("role").alias("method"), "text"))).alias("results"))
    docs = books.documents(rows)
    return docs.withColumns({"pdf_hash": F.sha2("combined_text", 256), "path": F.concat(F.lit("/books/"), F.col("doc").cast("string"), F.lit(".pdf")), "info": F.create_map(F.lit("producer"), F.lit("scan"))})


_S_RECORDS = r"""
WITH p AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS a, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS z FROM conversations),
k AS (SELECT * FROM p WHERE a <= 3 OR z <= 1),
b AS (SELECT conv_id, bool_or(trim(coalesce(text, '')) <> '') AS has_text FROM conversations GROUP BY conv_id),
l AS (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM k WHERE text IS NOT NULL),
h AS (SELECT conv_id, arg_min(trim(line), (turn, i)) AS title FROM l WHERE trim(line) <> '' GROUP BY conv_id),
w AS (SELECT DISTINCT conv_id, unnest(regexp_extract_all(lower(text), '[a-z]{9,}')) AS word FROM k WHERE text IS NOT NULL),
r AS (SELECT conv_id, string_agg(word, '|' ORDER BY word) AS keywords FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY word) AS n FROM w) WHERE n <= 10 GROUP BY conv_id)
SELECT b.conv_id AS doc, CASE WHEN has_text THEN title END AS title, CASE WHEN has_text THEN coalesce(keywords, '') END AS keywords,
CASE WHEN NOT has_text THEN 'no text on any page' END AS error FROM b LEFT JOIN h USING (conv_id) LEFT JOIN r USING (conv_id)"""


def _records(done: DataFrame) -> DataFrame:
    words = F.from_json(F.get_json_object("result", "$.keywords"), "array<string>")
    return done.select("doc", F.get_json_object("result", "$.title").alias("title"), j(words).alias("keywords"), "error")


@query("SELECT user_id, ts, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def listen_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest event of each user, kept up by a stream."""
    out, events = run_dir(spark), listen.table_stream(spark, sf_dir, "events")
    listen.keep_latest(events.select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_id"), f"{out}/latest", f"{out}/state", "user_id", "ts")
    got = keyed.lookup(t(spark, sf_dir, "events").select("user_id"), f"{out}/latest", "user_id", "ts", "user_id long, ts timestamp, event_id long")
    return got.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(_S_RECORDS)
def books_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(books.run(_books(spark, sf_dir), CONFIG))


@query(_S_RECORDS)
def books_info_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(books.run(_books(spark, sf_dir), CONFIG, "bookinfo"))


@query("""
WITH d AS (SELECT conv_id, bool_or(trim(coalesce(text, '')) <> '') AS has_text, string_agg(coalesce(text, ''), '|' ORDER BY turn) AS content FROM conversations GROUP BY conv_id)
SELECT content, min(CASE WHEN has_text THEN 'processed' ELSE 'failed' END) AS first, min(CASE WHEN has_text THEN 'cached' ELSE 'failed' END) AS again FROM d GROUP BY content""")
def books_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, docs = f"{run_dir(spark)}/log", _books(spark, sf_dir)
    docs = staged(docs.withColumn("pdf_hash", F.array_join(F.transform("pages", lambda p: F.coalesce(p["results"][0]["text"], F.lit(""))), "|")))
    first = staged(books.run_batch(docs, CONFIG, log).select("pdf_hash", F.col("status").alias("first")))
    again = books.run_batch(docs, CONFIG, log).select("pdf_hash", F.col("status").alias("again"))
    return first.join(again, "pdf_hash").select(F.col("pdf_hash").alias("content"), "first", "again")


@query()
def normalise_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = t(spark, sf_dir, "part")
    words = F.concat(F.split("p_name", r"\s+"), F.split("p_type", r"\s+"))
    result = F.to_json(F.struct(F.col("p_name").alias("title"), F.col("p_brand").alias("publisher"), words.alias("keywords"), F.array("p_brand", "p_name").alias("author")))
    at = F.timestamp_seconds(F.col("p_partkey"))
    parts = p.select(F.col("p_partkey").cast("string").alias("pdf_name"), F.md5(F.col("p_partkey").cast("string")).alias("pdf_hash"), F.lit("{}").alias("pipeline_config"), result.alias("result"), at.alias("run_timestamp"))
    rows = staged(run_log.parsed(parts))
    mapping = staged(normalise.canonical_keywords(normalise.distinct_keywords(rows), distance=0.4))
    out = normalise.normalised(rows, mapping)
    return out.select("pdf_hash", "canonical_publisher", j(F.col("canonical_keywords")).alias("canonical_keywords"), F.to_json(lookup.writer_payload(F.col("entity"))).alias("payload"))


@query()
def cluster_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layout and density clusters of each label's vectors; those without a label are laid out together."""
    e = t(spark, sf_dir, "embeddings").where("embedding is not null")
    e = e.withColumn("label", F.coalesce(F.col("label").cast("string"), F.lit("none")))
    return projection.cluster_map(_cells(e, 1, 2048), "block", "vec_id", "embedding", min_cluster_size=10)


def _cells(e: DataFrame, clusters: int, most: int = 4096) -> DataFrame:
    """A label's vectors as one block, or beyond `most` of them as k-means cells; share: the block's part of the label's
    `clusters`, by size, at least one."""
    sizes = staged(e.groupBy("label").agg(F.count("*").alias("n")))
    small = e.join(sizes.where(F.col("n") <= most), "label").withColumn("cell", F.lit("0"))
    for label, n in sorted(sizes.where(F.col("n") > most).collect()):
        one = staged(e.where(F.col("label") == F.lit(label)))
        small = small.unionByName(normalise.cells(one, n, most, item="vec_id").withColumn("n", F.lit(n).cast("long")).select(*small.columns))
    got = small.withColumn("block", F.concat_ws("-", F.col("label").cast("string"), "cell"))
    members = got.groupBy("block").agg(F.count("*").alias("members"))
    return got.join(members, "block").withColumn("share", F.greatest(F.lit(1), F.round(F.lit(clusters) * F.col("members") / F.col("n"))).cast("int"))


from . import media  # noqa: E402, F401  (adds its queries)
