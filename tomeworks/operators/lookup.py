"""Lookups: metadata of files, catalogues, caches, and the entities written back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import isbn_digits, keyword_set, title_case
from ..sources import keyed
from ..sources.staging import staged


def metadata_lookup(files: DataFrame, meta: DataFrame, order: str, by_hash: str = "file_hash", by_name: str = "file_name", value: str = "entity") -> DataFrame:
    """files with `value` and matched_by: the last metadata row of the same hash, else of the same name, else null."""
    last = lambda key: meta.where(f"{key} is not null").groupBy(key).agg(F.max_by(value, order).alias(f"_{key}"))
    out = files.join(last(by_hash), by_hash, "left").join(last(by_name), by_name, "left")
    h, n = F.col(f"_{by_hash}"), F.col(f"_{by_name}")
    out = out.withColumns({value: F.coalesce(h, n), "matched_by": F.when(h.isNotNull(), "hash").when(n.isNotNull(), "name")})
    return out.drop(f"_{by_hash}", f"_{by_name}")


def catalogue_search(queries: DataFrame, catalogue: DataFrame, rank: str, limit: int = 5, page: int = 1) -> DataFrame:
    """Catalogue rows for (query_id, title, author): by both, or where that finds none, by title alone; by falling rank.

    What a query can get are the first rows of its title and author, or of its title, so the catalogue is cut to those
    before it meets the queries: rows grow with the queries, not with the pairs."""
    keys = [k for k in catalogue.columns if k not in ("title", "author", rank)]
    skip = max((page - 1) * limit, 0)
    ranked = lambda df, *by: df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(rank), *keys))).where(F.col("rank") <= skip + limit)
    c = catalogue.withColumnsRenamed({"title": "c_title", "author": "c_author"}).where("c_title is not null")
    named = ranked(c.where("c_author is not null"), "c_title", "c_author").drop("rank")
    both = queries.join(named, (F.col("title") == F.col("c_title")) & (F.col("author") == F.col("c_author"))).withColumn("matched_by", F.lit("title+author"))
    rest = queries.join(both.select("query_id").distinct(), "query_id", "left_anti")
    alone = rest.join(ranked(c, "c_title").drop("rank"), F.col("title") == F.col("c_title")).withColumn("matched_by", F.lit("title"))
    return ranked(both.unionByName(alone), "query_id").where(F.col("rank") > skip)


def cache_key(*parts: Column) -> Column:
    return F.sha2(F.to_json(F.struct(*parts)), 256)


def cache_misses(requests: DataFrame, cache: DataFrame, key: str = "cache_key") -> DataFrame:
    """One request for each key that the cache doesn't hold."""
    return requests.dropDuplicates([key]).join(cache.select(key), key, "left_anti")


def through_cache(requests: DataFrame, path: str, respond: Callable[[DataFrame], DataFrame], key: str = "cache_key") -> DataFrame:
    """key, response, error of the requests, one for each key: from the cache at `path`, which is read in the buckets of the
    keys only; what it lacks goes through `respond` (requests to key, response, error) once. Answers without an error are added to it."""
    requests = staged(requests.dropDuplicates([key]))
    held = staged(keyed.lookup(requests, path, key, "answered_at", f"{key} string, response string, answered_at timestamp").select(key, "response", F.lit(None).cast("string").alias("error")))
    fresh = staged(respond(cache_misses(requests, held, key)).select(key, "response", "error"))
    good = fresh.where("error is null and response is not null").select(key, "response", F.current_timestamp().alias("answered_at"))
    keyed.append(good, path, key)
    return held.unionByName(fresh)


def book_entity(author: Column, title: Column, subtitle: Column, publisher: Column, canonical: Column, keywords: Column, categories: Column, description: Column, ids: Column) -> Column:
    """What is written back: the first author only, publisher in title case (the canonical one first), tags as a sorted set."""
    return F.struct(
        F.filter(F.slice(author, 1, 1), lambda a: a.isNotNull()).alias("authors"), title.alias("title"), subtitle.alias("subtitle"),
        title_case(F.coalesce(canonical, publisher)).alias("publisher"), F.coalesce(categories, F.array().cast("array<string>")).alias("categories"), keyword_set(keywords).alias("tags"),
        description.alias("description"), isbn_digits(ids, 13).alias("isbn_13"), isbn_digits(ids, 10).alias("isbn_10"),
    )


def entity_json(entity: Column) -> Column:
    """All fields, null ones included."""
    return F.to_json(entity, {"ignoreNullFields": "false"})


def writer_payload(e: Column) -> Column:
    """Fields with content only; categories fall back to the tags."""
    full = lambda a: F.when(F.size(a) > 0, a)
    text = lambda x: F.nullif(x, F.lit(""))
    return F.struct(
        full(e["authors"]).alias("authors"), text(e["title"]).alias("title"), text(e["subtitle"]).alias("subtitle"), text(e["publisher"]).alias("publisher"),
        F.coalesce(full(e["categories"]), full(e["tags"])).alias("categories"), text(e["description"]).alias("description"), text(e["isbn_13"]).alias("isbn13"), text(e["isbn_10"]).alias("isbn10"),
    )


def candidates_text(candidates: Column) -> Column:
    """Numbered blocks of JSON candidates; those that aren't JSON are left out."""
    sound = F.filter(candidates, lambda c: F.try_parse_json(c).isNotNull())
    blocks = F.transform(sound, lambda c, i: F.concat(F.lit("CANDIDATE "), (i + 1).cast("string"), F.lit(":\n"), c))
    return F.when(F.size(sound) > 0, F.array_join(blocks, "\n\n")).otherwise("No candidates provided")
