"""Catalogue requests and what is made of the answers, as Column expressions over JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, clauses, query_text

#: The fields that the two public catalogues answer with.
VOLUMES = "items array<struct<volumeInfo:struct<title:string,subtitle:string,authors:array<string>,publisher:string,publishedDate:string,description:string,categories:array<string>,industryIdentifiers:array<struct<type:string,identifier:string>>,pageCount:int,language:string,previewLink:string>>>"
BOOKS = "data struct<books:array<struct<title:string,description:string,pages:int,release_date:string,contributions:array<struct<author:struct<name:string>>>,cached_tags:string>>>, errors array<string>"
#: What simple_books hands on of a book, beside its authors' names.
ASKED = ("title", "description", "pages", "release_date", "cached_tags")
#: One operation for every search: its condition is a variable, of the type that the catalogue's schema has for it.
SEARCH = f"query ($known: books_bool_exp!, $most: Int, $skip: Int) {{ books(where: $known, order_by: {{users_count: desc}}, limit: $most, offset: $skip) {{ {' '.join(ASKED)} contributions {{ author {{ name }} }} }} }}"


def volumes_request(title: Column, author: Column, most: int = 5) -> Column:
    """q and maxResults of a volume search; null where there is nothing to ask for."""
    q = clauses(intitle=F.coalesce(title, F.lit("")), inauthor=F.coalesce(author, F.lit("")))
    return F.when(q != "", F.struct(q.alias("q"), F.lit(most).alias("maxResults")))


def simple_volumes(answer: Column) -> Column:
    """The volumes of an answer, flat; identifiers as type and identifier, an empty list where there are none."""
    got = F.from_json(answer, VOLUMES)["items"]
    plain = ("title", "subtitle", "authors", "publisher", "publishedDate", "description", "categories", "pageCount", "language", "previewLink")
    none = F.array().cast("array<struct<type:string,identifier:string>>")
    return F.transform(got, lambda v: F.struct(*[v["volumeInfo"][c].alias(c) for c in plain], F.coalesce(v["volumeInfo"]["industryIdentifiers"], none).alias("industryIdentifiers")))


def books_request(title: Column, author: Column, keywords: Column, description: Column, limit: int = 5, page: int = 1) -> Column:
    """query and variables of a book search: what is known of it, which is the title, or else the keywords or the description's
    beginning, and the author if there is one, is the condition; null where there is nothing to ask for. Written as JSON, which leaves
    out nulls, a condition on the author is there only if one is known."""
    asked, who = query_text(title, F.coalesce(keywords, F.array().cast("array<string>")), description), blank_to_null(author)
    equal = lambda x: F.struct(x.alias("_eq"))
    by = F.when(who.isNotNull(), F.struct(F.struct(equal(who).alias("name")).alias("author")))
    variables = F.struct(F.struct(equal(asked).alias("title"), by.alias("contributions")).alias("known"), F.lit(limit).alias("most"), F.lit(max((page - 1) * limit, 0)).alias("skip"))
    return F.when(asked.isNotNull(), F.struct(F.lit(SEARCH).alias("query"), variables.alias("variables")))


def simple_books(answer: Column) -> Column:
    """The books of an answer, flat, with the names of their authors; an answer with errors, or none, is an empty list."""
    got = F.from_json(answer, BOOKS)
    flat = F.transform(
        got["data"]["books"],
        lambda b: F.struct(b["title"].alias("title"), b["description"].alias("description"), b["pages"].alias("pages"), b["release_date"].alias("release_date"), b["cached_tags"].alias("cached_tags"), F.filter(F.transform(b["contributions"], lambda c: c["author"]["name"]), lambda n: n.isNotNull()).alias("authors")),
    )
    sound = flat.isNotNull() & (F.coalesce(F.size(got["errors"]), F.lit(0)) <= 0)
    return F.when(sound, flat).otherwise(F.filter(F.coalesce(flat, F.from_json(F.lit("[]"), "array<struct<title:string,description:string,pages:int,release_date:string,cached_tags:string,authors:array<string>>>")), lambda b: F.lit(False)))


def search_payload(source: str, query: Column, items: Column) -> Column:
    """What a search hands on: source, query, result_count and items as JSON; null where it found nothing."""
    return F.when(F.size(items) > 0, F.to_json(F.struct(F.lit(source).alias("source"), query.alias("query"), F.size(items).alias("result_count"), items.alias("items"))))
