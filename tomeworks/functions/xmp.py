"""Writing and reading XMP packets as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank_to_null, drop_blank, isbn_with_x

#: Namespaces, and the schemes of identifiers with the columns that fill them.
SPACES = {
    "rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#",
    "dc": "http://purl.org/dc/elements/1.1/",
    "xmp": "http://ns.adobe.com/xap/1.0/",
    "xmpidq": "http://ns.adobe.com/xmp/Identifier/qual/1.0/",
    "calibre": "http://calibre-ebook.com/xmp-namespace",
    "calibreSI": "http://calibre-ebook.com/xmp-namespace-series-index",
}
SCHEMES = (("google", "google_id"), ("goodreads", "goodreads_id"), ("comicvine", "comicvine_id"), ("hardcover", "hardcover_id"), ("amazon", "asin"), ("isbn", "isbn"))
#: What is read of a packet.
FIELDS = ("title", "description", "publisher", "language", "authors", "categories", *(c for _, c in SCHEMES), "isbn10", "isbn13", "series_name", "series_number", "creator_tool", "create_date")


def escape(x: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def _tag(name: str, inner: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"<{name}>"), inner, F.lit(f"</{name}>")), F.lit(""))


def _items(values: Column) -> Column:
    return F.array_join(F.transform(values, lambda v: F.concat(F.lit("<rdf:li>"), escape(v), F.lit("</rdf:li>"))), "")


def _list(name: str, kind: str, values: Column) -> Column:
    return F.when(F.size(values) > 0, F.concat(F.lit(f"<{name}><rdf:{kind}>"), _items(values), F.lit(f"</rdf:{kind}></{name}>"))).otherwise("")


def _alt(name: str, value: Column) -> Column:
    return F.when(blank_to_null(value).isNotNull(), F.concat(F.lit(f'<{name}><rdf:Alt><rdf:li xml:lang="x-default">'), escape(value), F.lit(f"</rdf:li></rdf:Alt></{name}>"))).otherwise("")


def write_xmp(m: dict[str, Column], now: Column, creator_tool: str = "tomeworks") -> Column:
    """A packet with Dublin Core, identifiers, dates and, where there is a series, the series block."""
    null = F.lit(None).cast("string")
    get = lambda k: m.get(k, null)
    isbn = F.coalesce(blank_to_null(get("isbn13")), blank_to_null(get("isbn10")))
    ids = [F.when(blank_to_null(v).isNotNull(), F.concat(F.lit(f"<rdf:li rdf:parseType=\"Resource\"><xmpidq:Scheme>{s}</xmpidq:Scheme><rdf:value>"), escape(v), F.lit("</rdf:value></rdf:li>"))) for s, v in ((s, isbn if c == "isbn" else get(c)) for s, c in SCHEMES)]
    bag = F.concat_ws("", *ids)
    stamp = F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    created = F.coalesce(F.date_format(m["published_date"], "yyyy-MM-dd'T'00:00:00'Z'"), stamp) if "published_date" in m else stamp
    names = " ".join(f'xmlns:{k}="{v}"' for k, v in SPACES.items())
    series = F.when(
        get("series_name").isNotNull(),
        F.concat(F.lit('<rdf:Description rdf:about=""><calibre:series rdf:parseType="Resource"><rdf:value>'), escape(get("series_name")), F.lit("</rdf:value><calibreSI:series_index>"), F.format_string("%.2f", F.coalesce(m["series_number"].cast("double") if "series_number" in m else F.lit(0.0), F.lit(0.0))), F.lit("</calibreSI:series_index></calibre:series></rdf:Description>")),
    ).otherwise("")
    return F.concat(
        F.lit(f'<x:xmpmeta xmlns:x="adobe:ns:meta/"><rdf:RDF {names}><rdf:Description rdf:about="">'),
        _alt("dc:title", get("title")), _alt("dc:description", get("description")),
        _list("dc:publisher", "Bag", F.filter(F.array(get("publisher")), lambda p: p.isNotNull())), _list("dc:language", "Bag", F.filter(F.array(get("language")), lambda p: p.isNotNull())),
        _list("dc:creator", "Seq", m["authors"]) if "authors" in m else F.lit(""), _list("dc:subject", "Bag", m["categories"]) if "categories" in m else F.lit(""),
        F.when(bag != "", F.concat(F.lit("<xmp:Identifier><rdf:Bag>"), bag, F.lit("</rdf:Bag></xmp:Identifier>"))).otherwise(""),
        _tag("xmp:MetadataDate", stamp), _tag("xmp:CreateDate", created), _tag("xmp:CreatorTool", F.lit(creator_tool)), _tag("xmp:ModifyDate", stamp),
        F.lit("</rdf:Description>"), series, F.lit("</rdf:RDF></x:xmpmeta>"),
    )


_ITEMS = "struct<`rdf:li`:array<string>>"
_BOX = f"struct<`rdf:Alt`:{_ITEMS},`rdf:Bag`:{_ITEMS},`rdf:Seq`:{_ITEMS}>"
_PAIR = "`xmpidq:Scheme`:string,`rdf:value`:string"
_INDEX = ("calibreSI:series_index", "calibre:series_index", "series_index", "calibreSI:seriesIndex", "calibre:seriesIndex")
_BLOCKS = "array<struct<{}>>".format(
    ",".join(
        [f"`dc:{n}`:{_BOX}" for n in ("title", "description", "publisher", "language", "creator", "subject")]
        + [f"`xmp:Identifier`:struct<`rdf:Bag`:struct<`rdf:li`:array<struct<{_PAIR},`rdf:Description`:struct<{_PAIR}>>>>>"]
        + ["`calibre:series`:struct<`rdf:value`:string,{}>".format(",".join(f"`{n}`:string" for n in _INDEX)), "`xmp:CreatorTool`:string", "`xmp:CreateDate`:string"]
    )
)
#: What is read of a packet; its root is x:xmpmeta or rdf:RDF itself.
PACKET = f"struct<`rdf:RDF`:struct<`rdf:Description`:{_BLOCKS}>,`rdf:Description`:{_BLOCKS}>"


def _record(r: Column) -> Column:
    blocks = F.coalesce(r["rdf:RDF"]["rdf:Description"], r["rdf:Description"])
    first = lambda values: F.try_element_at(F.filter(F.coalesce(values, F.array().cast("array<string>")), lambda v: blank_to_null(v).isNotNull()), F.lit(1))

    def listed(name: str) -> Column:
        none = F.array().cast("array<string>")
        each = F.transform(blocks, lambda d: F.concat(*[F.coalesce(d[f"dc:{name}"][f"rdf:{kind}"]["rdf:li"], none) for kind in ("Alt", "Bag", "Seq")]))
        return F.coalesce(drop_blank(F.flatten(each)), none)

    within = F.flatten(F.transform(blocks, lambda d: F.coalesce(d["xmp:Identifier"]["rdf:Bag"]["rdf:li"], F.array())))
    pairs = F.transform(within, lambda p: F.struct(F.lower(F.trim(F.coalesce(p["xmpidq:Scheme"], p["rdf:Description"]["xmpidq:Scheme"]))).alias("scheme"), blank_to_null(F.coalesce(p["rdf:value"], p["rdf:Description"]["rdf:value"])).alias("value")))
    named = lambda scheme: F.try_element_at(F.filter(pairs, lambda p: (p["scheme"] == scheme) & p["value"].isNotNull()), F.lit(-1))["value"]
    isbn = isbn_with_x(named("isbn"))
    index = first(F.transform(blocks, lambda d: F.coalesce(*[blank_to_null(d["calibre:series"][n]) for n in _INDEX])))
    out = {n: F.try_element_at(listed(n), F.lit(1)) for n in ("title", "description", "publisher", "language")}
    out |= {"authors": F.array_distinct(listed("creator")), "categories": F.array_distinct(listed("subject"))}
    out |= {column: named(scheme) for scheme, column in SCHEMES}
    out |= {"isbn10": isbn["isbn10"], "isbn13": isbn["isbn13"]}
    out["series_name"] = first(F.transform(blocks, lambda d: d["calibre:series"]["rdf:value"]))
    out["series_number"] = index.try_cast("float")
    out["creator_tool"] = first(F.transform(blocks, lambda d: d["xmp:CreatorTool"]))
    out["create_date"] = F.try_to_date(F.substring(first(F.transform(blocks, lambda d: d["xmp:CreateDate"])), 1, 10), "yyyy-MM-dd")
    return F.struct(*[v.alias(k) for k, v in out.items()])


def record(x: Column) -> Column:
    """A packet as one struct, of one parse. Absent values are null, absent lists empty, as all are in a null, empty or broken
    packet; of two identifiers of one scheme the last counts."""
    # a lambda binds what was parsed, so that no optimizer rule can copy the parse into each field
    return F.element_at(F.transform(F.array(F.from_xml(x, PACKET)), _record), 1)


def read_xmp(x: Column) -> dict[str, Column]:
    """record's fields as columns by name."""
    r = record(x)
    return {k: r[k] for k in FIELDS}


def differs(a: Column, b: Column) -> Column:
    """Whether the text of two packets differs, dates aside; null differs from anything."""
    plain = lambda x: F.trim(F.xpath_string(F.regexp_replace(x, r"<xmp:(MetadataDate|CreateDate|ModifyDate)>[^<]*</xmp:(MetadataDate|CreateDate|ModifyDate)>", ""), F.lit("/*")))
    return F.coalesce(plain(a) != plain(b), F.lit(True))
