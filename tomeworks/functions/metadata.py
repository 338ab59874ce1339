"""Metadata records as structs: what files say, what is written into them, and when two records are the same."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank_to_null, drop_blank, parse_authors

#: The fields of a record to be written, and those that are sets.
WRITER = "title string, subtitle string, publisher string, publishedDate date, description string, authors array<string>, categories array<string>, language string, seriesName string, seriesNumber float, seriesTotal int, isbn10 string, isbn13 string, asin string, goodreadsId string, comicvineId string, hardcoverId string, googleId string"
SETS = ("authors", "categories")


def info_keywords(x: Column) -> Column:
    """The distinct keywords between the commas of an info dictionary's text; an empty list for null."""
    return F.array_distinct(F.coalesce(drop_blank(F.split(x, ",")), F.array().cast("array<string>")))


def info_date(x: Column) -> Column:
    """The day of a PDF date (D:YYYYMMDD...), null where it has none."""
    digits = F.regexp_extract(F.coalesce(x, F.lit("")), r"^(?:D:)?(\d{4})(\d{2})?(\d{2})?", 0)
    digits = F.regexp_replace(digits, "^D:", "")
    day = F.concat(F.substring(digits, 1, 4), F.lit("-"), F.coalesce(F.nullif(F.substring(digits, 5, 2), F.lit("")), F.lit("01")), F.lit("-"), F.coalesce(F.nullif(F.substring(digits, 7, 2), F.lit("")), F.lit("01")))
    return F.when(digits != "", F.try_to_date(day, "yyyy-MM-dd"))


def from_info(info: Column, name: Column) -> Column:
    """A record from an info dictionary (map) and the file's name, which gives the title where there is none."""
    get = lambda k: blank_to_null(F.try_element_at(info, F.lit(k)))
    stem = F.regexp_replace(F.element_at(F.split(name, "/"), -1), r"(.)\.[^.]*$", "$1")
    return F.struct(
        F.coalesce(get("Title"), stem).alias("title"), F.coalesce(parse_authors(get("Author")), F.array().cast("array<string>")).alias("authors"), get("Subject").alias("description"),
        get("EBX_PUBLISHER").alias("publisher"), get("Language").alias("language"), info_keywords(get("Keywords")).alias("categories"), info_date(get("CreationDate")).alias("published_date"),
    )


def to_info(e: Column) -> Column:
    """The info dictionary's entries of a payload (map); fields without content change nothing."""
    texts = {"Title": e["title"], "Producer": e["publisher"], "Author": F.when(F.size(e["authors"]) > 0, F.array_join(e["authors"], ", ")), "Keywords": F.when(F.size(e["categories"]) > 0, F.array_join(e["categories"], ", "))}
    return F.map_filter(F.create_map(*[x for k, v in texts.items() for x in (F.lit(k), v)]), lambda k, v: v.isNotNull())


def same_record(a: Column, b: Column, fields: tuple[str, ...], sets: tuple[str, ...] = SETS) -> Column:
    """Whether two structs are equal field by field: null equals null, and sets have no order and no repeats."""
    plain = lambda r, f: F.array_sort(F.array_distinct(r[f])) if f in sets else r[f]
    out = F.lit(True)
    for f in fields:
        out = out & plain(a, f).eqNullSafe(plain(b, f))
    return out


def writer_input(text: Column) -> Column:
    """A record to be written, from JSON; unknown fields are ignored, and sets keep the order of their first values."""
    r = F.from_json(text, WRITER)
    names = [f.split()[0] for f in WRITER.split(", ")]
    return F.when(r.isNotNull(), F.struct(*[(F.array_distinct(r[n]) if n in SETS else r[n]).alias(n) for n in names]))


def destination(candidate: Column, name: Column, is_folder: Column | None = None) -> Column:
    """Where a file goes: the candidate itself if it looks like a file (a dot in its last part), else the file's name in it."""
    last = F.element_at(F.split(F.regexp_replace(candidate, "/+$", ""), "/"), -1)
    inside = F.concat(F.regexp_replace(candidate, "/+$", ""), F.lit("/"), name)
    looks = F.contains(last, F.lit("."))
    return F.when(looks if is_folder is None else looks & ~is_folder, candidate).otherwise(inside)


def missing_fields(record: Column, required: tuple[str, ...]) -> Column:
    """The required fields that a JSON record lacks or has as null; all of them where it is no record."""
    v = F.try_parse_json(record)
    return F.filter(F.array(*[F.when(F.try_variant_get(v, f"$.{f}", "string").isNull() & F.try_variant_get(v, f"$.{f}", "array<string>").isNull(), F.lit(f)) for f in required]), lambda x: x.isNotNull())
