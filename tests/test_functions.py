"""Golden cases of the string, XMP and page rules."""

import pytest
from pyspark.sql import functions as F

from tomeworks.functions import text as X
from tomeworks.functions import xmp
from tomeworks.operators import lookup, pages


def value(spark, column, **row):
    return spark.createDataFrame([tuple(row.values()) or (1,)], ", ".join(f"{k} string" for k in row) or "one int").select(column).first()[0]


CASES = [
    (X.normalize_keyword, "Sci-Fi", "scifi"),
    (X.normalize_keyword, "", ""),
    (X.normalize_keyword, None, None),
    (X.normalize_keyword, "CAFÃ‰ Noir", "café noir"),
    (X.repair_unicode, "Les MisÃ©rables", "Les Misérables"),
    (X.repair_unicode, "donâ€™t â€” ðŸ˜€", "don’t — 😀"),
    (X.repair_unicode, "ÐœÐ¾ÑÐºÐ²Ð°".replace("ÑÐ", "Ñ\x81Ð"), "Москва"),
    (X.repair_unicode, "CAFÉ™ naïve", "CAFÉ™ naïve"),
    (X.repair_unicode, "Ã© 日本", "Ã© 日本"),
    (X.repair_unicode, "Ã", "Ã"),
    (X.repair_unicode, "", ""),
    (X.repair_unicode, None, None),
    (lambda x: X.repair_unicode(x, rounds=2), "ÃƒÂ©tÃƒÂ©", "été"),
    (X.normalize_keyword, " A\nB   C ", "a b c"),
    (X.normalize_keyword, "see http://a.b/c?d now", "see <url> now"),
    (X.normalize_publisher, "A Foo Bar Publishing", "foo bar"),
    (X.normalize_publisher, "Acme LLC Games", "acme"),
    (X.normalize_publisher, "Press", "press"),
    (X.normalize_publisher, "Foo distributed by Bar", "foo"),
    (X.split_authors, "Ann Lee, Bob Ray and Cy Day", ["Ann Lee", "Bob Ray", "Cy Day"]),
    (X.split_authors, "Sandy", ["Sandy"]),
    (X.split_authors, " , ", []),
    (X.parse_authors, "A & B, A", ["A", "B"]),
    (X.title_case, "o'reilly 2nd-ed", "O'Reilly 2Nd-Ed"),
    (X.strip_code_fences, '```json\n{"a":1}\n```', '{"a":1}'),
    (X.strip_code_fences, '{"a":1}', '{"a":1}'),
    (X.first_line, '"Dark Fantasy"\nbecause', "Dark Fantasy"),
    (X.first_line, "", None),
    (X.archive_stem, "a.tar.gz", "a"),
    (X.archive_stem, "b.tbz2", "b"),
    (X.archive_stem, "c.txt", None),
    (X.stem, "a.b.pdf", "a.b"),
    (X.json_list, '["a", "", null, 1]', ["a", "1"]),
    (X.json_list, "plain", ["plain"]),
    (X.json_list, None, []),
    (X.author_list, '{"author": ["A", "B"]}', ["A", "B"]),
    (X.author_list, '{"author": "A, B"}', ["A, B"]),
    (X.author_list, "{}", None),
]


@pytest.mark.parametrize(("rule", "given", "want"), CASES)
def test_rules(spark, rule, given, want):
    assert value(spark, rule(F.col("x")), x=given) == want


def test_keyword_form_is_stable(spark):
    for s in ("Ünïcode & co.", "mail a.b@c.de, +49 30 123456", "x__y"):
        once = value(spark, X.normalize_keyword(F.col("x")), x=s)
        assert value(spark, X.normalize_keyword(F.col("x")), x=once) == once


def test_isbn(spark):
    ids = F.array(F.lit("978-0-306-40615-7"), F.lit("0-306-40615-2"), F.lit("0-8044-2957-X"))
    assert value(spark, X.isbn_digits(ids, 13)) == "9780306406157"
    assert value(spark, X.isbn_digits(ids, 10)) == "0306406152"
    assert value(spark, X.isbn_with_x(F.lit("0-8044-2957-X")))["isbn10"] == "080442957X"
    assert value(spark, X.isbn_with_x(F.lit("12345")))["isbn13"] == "12345"


@pytest.mark.parametrize(("a", "b", "ratio"), [("kitten", "sitting", 61.5385), ("wizards of the coast", "wizards of coast", 88.8889), ("", "", 100.0), ("abc", "", 0.0), ("same", "same", 100.0)])
def test_indel_ratio(spark, a, b, ratio):
    assert round(value(spark, X.indel_ratio(F.col("a"), F.col("b")), a=a, b=b), 4) == ratio


def test_queries_and_redaction(spark):
    assert value(spark, X.clauses(intitle=F.lit(" Dune "), inauthor=F.lit(None).cast("string"))) == "intitle:Dune"
    assert value(spark, X.clauses(intitle=F.lit(" "))) == ""
    none = F.array().cast("array<string>")
    assert value(spark, X.query_text(F.lit(" "), F.array(F.lit("a"), F.lit("b")), F.lit("d"))) == "a b"
    assert len(value(spark, X.query_text(F.lit(None).cast("string"), none, F.repeat(F.lit("x"), 300)))) == 200
    m = F.create_map(F.lit("api_key"), F.lit("x"), F.lit("host"), F.lit("h"), F.lit("project"), F.lit(None).cast("string"))
    assert value(spark, X.redact(m)) == {"api_key": "<redacted>", "host": "h"}


@pytest.mark.parametrize(("first", "last", "want"), [(2, 2, [1, 2, 4, 5]), (None, 1, [5]), (None, None, [1, 2, 3, 4, 5]), (4, 3, [1, 2, 3, 4, 5]), (0, 0, []), (9, 9, [1, 2, 3, 4, 5])])
def test_context_pages(spark, first, last, want):
    assert value(spark, pages.context_pages(F.array(*[F.lit(i) for i in range(1, 6)]), first, last)) == want


def test_sample_pages(spark):
    rows = spark.createDataFrame([(1, i, i in (0, 9)) for i in range(10)], "doc int, n int, blank boolean")
    got = pages.sample_pages(rows, "doc", "n", F.col("blank"), 2, 1)
    assert sorted(r["n"] for r in got.collect()) == [1, 2, 8]


def test_entity_and_payload(spark):
    null = F.lit(None).cast("string")
    e = lookup.book_entity(F.array(F.lit("A"), F.lit("B")), F.lit("T"), null, F.lit("acme games"), null, F.array(F.lit("X"), F.lit(" x ")), F.lit(None).cast("array<string>"), F.lit(""), F.array(F.lit("978-0-306-40615-7")))
    got = value(spark, F.struct(e.alias("e"), lookup.writer_payload(e).alias("p"), lookup.entity_json(e).alias("j")))
    assert got["e"]["authors"] == ["A"]
    assert got["e"]["publisher"] == "Acme Games"
    assert got["p"]["categories"] == ["x"]
    assert got["p"]["description"] is None
    assert '"isbn_10":null' in got["j"]


def test_xmp_round_trip(spark):
    m = {"title": F.lit('a < b & "c"'), "authors": F.array(F.lit("A"), F.lit("B & C")), "isbn10": F.lit("0306406152"), "isbn13": F.lit(" "), "series_name": F.lit("S"), "series_number": F.lit(2.5)}
    packet = xmp.write_xmp(m, F.lit("2026-01-01 00:00:00").cast("timestamp"))
    r = xmp.read_xmp(packet)
    got = value(spark, F.struct(*[r[k].alias(k) for k in ("title", "authors", "isbn", "series_name", "series_number", "publisher", "categories")]))
    assert tuple(got) == ('a < b & "c"', ["A", "B & C"], "0306406152", "S", 2.5, None, [])


def test_xmp_of_other_writers(spark):
    names = " ".join(f'xmlns:{k}="{v}"' for k, v in xmp.SPACES.items())
    one = "<rdf:Description><dc:title><rdf:Alt><rdf:li> </rdf:li><rdf:li xml:lang='de'> A &amp; B </rdf:li></rdf:Alt></dc:title><dc:subject><rdf:Bag><rdf:li>x</rdf:li><rdf:li/><rdf:li>y</rdf:li><rdf:li>x</rdf:li></rdf:Bag></dc:subject><xmp:CreateDate>unknown</xmp:CreateDate></rdf:Description>"
    item = lambda scheme, v: f"<rdf:li rdf:parseType='Resource'><xmpidq:Scheme>{scheme}</xmpidq:Scheme>{v}</rdf:li>"
    two = "<rdf:Description><xmp:Identifier><rdf:Bag>" + item("ISBN", "<rdf:value>0-306-40615-x</rdf:value>") + item("google", "<rdf:value>g1</rdf:value>") + item("Google", "<rdf:value>g2</rdf:value>") + item("google", "") + "<rdf:li><rdf:Description><xmpidq:Scheme>amazon</xmpidq:Scheme><rdf:value>B0</rdf:value></rdf:Description></rdf:li></rdf:Bag></xmp:Identifier><calibre:series rdf:parseType='Resource'><rdf:value>S</rdf:value><calibre:series_index>two</calibre:series_index></calibre:series></rdf:Description>"
    whole = f'<?xpacket begin="" id="W5M0MpCehiHzreSzNTczkc9d"?><x:xmpmeta xmlns:x="adobe:ns:meta/"><rdf:RDF {names}>{one}{two}</rdf:RDF></x:xmpmeta><?xpacket end="w"?>'
    bare = f"<rdf:RDF {names}>{one}</rdf:RDF>"
    plain = f"<rdf:RDF {names}><rdf:Description><dc:title>no list</dc:title><xmp:CreatorTool>tool</xmp:CreatorTool></rdf:Description></rdf:RDF>"
    texts = [whole, bare, plain, "<a/>", "", "no xml", whole[: len(whole) // 2], None]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, x string").select("i", xmp.record(F.col("x")).alias("r")).orderBy("i").collect()
    got = [x["r"].asDict() for x in rows]
    assert (got[0]["title"], got[0]["categories"], got[0]["authors"], got[0]["create_date"]) == ("A & B", ["x", "y"], [], None)
    assert (got[0]["isbn"], got[0]["isbn10"], got[0]["isbn13"], got[0]["google_id"], got[0]["asin"]) == ("0-306-40615-x", "030640615x", None, "g2", "B0")
    assert (got[0]["series_name"], got[0]["series_number"]) == ("S", None)
    assert (got[1]["title"], got[1]["isbn"], got[2]["title"], got[2]["creator_tool"]) == ("A & B", None, None, "tool")
    nothing = {k: [] if k in ("authors", "categories") else None for k in xmp.FIELDS}
    assert got[3:] == [nothing] * 5


def test_candidates(spark):
    assert value(spark, lookup.candidates_text(F.array().cast("array<string>"))) == "No candidates provided"
    assert value(spark, lookup.candidates_text(F.array(F.lit("{bad"), F.lit('{"a":1}')))) == 'CANDIDATE 1:\n{"a":1}'
