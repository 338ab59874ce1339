"""String rules of the metadata domain as Column expressions: no Python runs on the executors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What URLs, e-mail addresses and phone numbers become in a keyword.
URL, EMAIL, PHONE = r"(https?://|www\.)\S+", r"[\w.+-]+@[\w-]+(\.[\w-]+)+", r"\+?\d[\d ()-]{7,}\d"
#: Phrases after which a publisher's name ends, and company suffixes.
LICENSE = r"(under license|produced under license|published under|distributed by|in association with).*$"
SUFFIX = r"\b(incorporated|inc|llc|ltd|limited|ltda|ab|srl|sas|company|co|gmbh|sa|bv|oy|kg|kk|publishing|press|productions|production|entertainment)\.?\b"
#: What Windows-1252 has at the bytes 80 to 9F, but for the five that it leaves free, and those bytes.
CP1252 = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
CP1252_BYTES = "".join(c.encode("cp1252").decode("latin-1") for c in CP1252)
#: The first two bytes of a Latin, Greek or Cyrillic letter or of a longer sequence, read one by one.
MISREAD = rf"[\x{{C2}}-\x{{C5}}\x{{CE}}-\x{{D1}}\x{{E2}}-\x{{F0}}][\x{{80}}-\x{{BF}}{CP1252}]"
ARCHIVE = r"(?i)\.(tar\.gz|tgz|tar\.bz2|tbz2|tbz|tar|zip|7z)$"


def blank_to_null(x: Column) -> Column:
    return F.nullif(F.trim(x), F.lit(""))


def repair_unicode(x: Column, rounds: int = 1) -> Column:
    """UTF-8 that was read as Windows-1252 (or Latin-1) as what it was; `rounds` times over.

    Only where the whole text, taken back to bytes, is UTF-8 again; other text stays, also where parts of it look misread. Two-byte
    letters beyond Latin, Greek and Cyrillic aren't repaired by themselves, so that a capital before a sign (CAFÉ™) stays."""
    for _ in range(rounds):
        latin = F.translate(x, CP1252, CP1252_BYTES)
        back = F.try_validate_utf8(F.encode(latin, "ISO-8859-1").cast("string"))
        x = F.when(x.rlike(MISREAD) & latin.rlike(r"^[\x{0}-\x{FF}]*$"), F.coalesce(back, x)).otherwise(x)
    return x


def normalize_keyword(x: Column) -> Column:
    """Misread UTF-8 repaired; lower case on one line; URLs, addresses and phone numbers as tokens; no punctuation; single spaces."""
    plain = x = F.lower(repair_unicode(x))
    for pattern, token in ((URL, "<url>"), (EMAIL, "<email>"), (PHONE, "<phone>"), (r"\p{P}", ""), (r"\s+", " ")):
        x = F.regexp_replace(x, pattern, token)
    return F.when(plain.rlike(r"^\p{L}+$"), plain).otherwise(F.trim(x))  # most words are letters only


def normalize_publisher(x: Column) -> Column:
    """The keyword form up to a licence phrase and the first company suffix; the keyword form where nothing is left."""
    clean = normalize_keyword(x)
    y = F.trim(F.regexp_replace(clean, LICENSE, ""))
    y = F.regexp_replace(y, r"^a\s+(.+)", "$1")
    y = F.trim(F.split(y, SUFFIX, 2)[0])
    return F.coalesce(F.nullif(y, F.lit("")), clean)


def _names(x: Column, pattern: str) -> Column:
    return F.filter(F.transform(F.split(x, pattern), lambda n: F.trim(n)), lambda n: n != "")


def split_authors(x: Column) -> Column:
    """Names between commas or the word "and"."""
    return _names(x, r"(?i),\s*|\band\b")


def parse_authors(x: Column) -> Column:
    """Distinct names between commas or ampersands, in order."""
    return F.array_distinct(_names(x, "[,&]"))


def drop_blank(words: Column) -> Column:
    return F.filter(F.transform(words, lambda w: F.trim(w)), lambda w: w != "")


def keyword_set(words: Column) -> Column:
    """Sorted distinct keywords in lower case, without blanks; null is empty."""
    return F.array_sort(F.array_distinct(F.transform(drop_blank(F.coalesce(words, F.array().cast("array<string>"))), lambda w: F.lower(w))))


def isbn_digits(ids: Column, length: int) -> Column:
    """The first identifier that has so many digits; an X isn't one."""
    return F.try_element_at(F.filter(F.transform(ids, lambda x: F.regexp_replace(x, "[^0-9]", "")), lambda x: F.length(x) == length), F.lit(1))


def isbn_with_x(x: Column) -> Column:
    """isbn10 and isbn13 of one identifier that may end in X; any other length counts as isbn13."""
    y = F.nullif(F.regexp_replace(x, "[^0-9Xx]", ""), F.lit(""))
    return F.struct(F.when(F.length(y) == 10, y).alias("isbn10"), F.when(F.length(y) != 10, y).alias("isbn13"))


def title_case(x: Column) -> Column:
    """Every run of letters begins with a capital, also after digits and apostrophes."""
    runs = F.regexp_extract_all(x, F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    return F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, 1 << 30)))), "")


def strip_code_fences(x: Column) -> Column:
    x = F.trim(x)
    inner = F.regexp_replace(F.regexp_replace(x, r"^```[^\n]*\n?", ""), r"\n?```\s*$", "")
    return F.when(x.startswith("```"), F.trim(inner)).otherwise(x)


def first_line(x: Column) -> Column:
    """The first line without quotes; null if nothing is left."""
    return F.nullif(F.trim(F.regexp_replace(F.trim(F.split(x, "\n")[0]), r'^"+|"+$', "")), F.lit(""))


def clauses(**fields: Column) -> Column:
    """key:value clauses of a catalogue query joined by +, blanks left out; empty if none is left."""
    return F.concat_ws("+", *[F.when(F.trim(v) != "", F.concat(F.lit(k + ":"), F.trim(v))) for k, v in fields.items()])


def query_text(title: Column, keywords: Column, description: Column) -> Column:
    """The title, else the keywords, else the first 200 characters of the description, else null."""
    return F.coalesce(blank_to_null(title), F.nullif(F.array_join(drop_blank(keywords), " "), F.lit("")), F.nullif(F.substring(F.trim(description), 1, 200), F.lit("")))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def plain_path(path: Column) -> Column:
    """The path without the scheme of the local file system."""
    return F.regexp_replace(path, "^file:/*", "/")


def moved_below(path: Column, root: str, target: str) -> Column:
    """Where a path below root lies below target: only the beginning is replaced. A path outside root goes to target itself."""
    root, target, own = root.rstrip("/"), target.rstrip("/"), plain_path(path)
    inside = own.startswith(F.lit(root + "/"))
    return F.when(inside, F.concat(F.lit(target), own.substr(F.lit(len(root) + 1), F.length(own)))).otherwise(F.concat(F.lit(target + "/"), file_name(path)))


def stem(name: Column) -> Column:
    return F.regexp_replace(name, r"(.)\.[^.]*$", "$1")


def archive_stem(name: Column) -> Column:
    """The folder an archive is expanded to; null if it isn't one."""
    return F.when(name.rlike(ARCHIVE), F.regexp_replace(name, ARCHIVE, ""))


def json_list(x: Column) -> Column:
    """A JSON list's values that aren't empty, as strings; any other text is a list of itself, null and "" an empty one."""
    parsed = F.try_variant_get(F.try_parse_json(x), "$", "array<string>")
    return F.coalesce(F.filter(parsed, lambda v: v.isNotNull() & (v != "")), F.when(x != "", F.array(x)), F.array().cast("array<string>"))


def author_list(record: Column) -> Column:
    """The author of a JSON record, which is a name or a list of names."""
    v = F.try_parse_json(record)
    many = F.try_variant_get(v, "$.author", "array<string>")
    one = F.try_variant_get(v, "$.author", "string")
    return F.coalesce(many, F.when(one.isNotNull(), F.array(one)))


def redact(options: Column) -> Column:
    """A map without null values, and with <redacted> for what looks like a key, secret or token."""
    return F.transform_values(F.map_filter(options, lambda k, v: v.isNotNull()), lambda k, v: F.when(k.rlike("(?i)key|secret|token"), F.lit("<redacted>")).otherwise(v))


def metadata_lines(pairs: Column) -> Column:
    """Key: value lines of a map, keys in title case, blank values left out."""
    kept = F.array_sort(F.map_entries(F.map_filter(pairs, lambda k, v: v.isNotNull() & (v != ""))))
    return F.array_join(F.transform(kept, lambda e: F.concat(F.initcap(e["key"]), F.lit(": "), e["value"])), "\n")


def common_subsequence(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence, as a fold over the rows of the dynamic program."""
    chars = lambda s: F.filter(F.split(s, ""), lambda c: c != "")
    bs = chars(b)
    zero = F.transform(bs, lambda c: F.lit(0))

    def row(old: Column, c: Column) -> Column:
        start = F.struct(F.lit(0).alias("left"), F.lit(0).alias("diag"), F.array().cast("array<int>").alias("row"))

        def cell(s: Column, p: Column) -> Column:
            up = p["up"]
            v = F.when(p["c"] == c, s["diag"] + 1).otherwise(F.greatest(s["left"], up))
            return F.struct(v.alias("left"), up.alias("diag"), F.array_append(s["row"], v).alias("row"))

        pairs = F.zip_with(bs, old, lambda c2, up: F.struct(c2.alias("c"), up.alias("up")))
        return F.aggregate(pairs, start, cell, lambda s: s["row"])

    last = F.aggregate(chars(a), zero, row)
    return F.when(F.size(last) > 0, F.element_at(last, -1)).otherwise(F.lit(0))


def indel_ratio(a: Column, b: Column) -> Column:
    """Similarity 0 to 100: twice the common subsequence by the summed lengths; two empty names are equal."""
    total = F.length(a) + F.length(b)
    return F.when(total == 0, F.lit(100.0)).otherwise(F.lit(200).cast("double") * common_subsequence(a, b) / F.greatest(total, F.lit(1)))


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def path_allowed(path: Column, prefix: str, folder: str = "LANG", updates: tuple[str, ...] = ()) -> Column:
    """A component begins with the prefix, none is the language folder, no [xx] tag and no listed update in the path."""
    parts = F.split(path, "/")
    return F.exists(parts, lambda p: p.startswith(prefix)) & ~F.array_contains(parts, folder) & ~path.rlike(r"\[[A-Za-z]{2}\]") & ~any_of([path.contains(u) for u in updates])
