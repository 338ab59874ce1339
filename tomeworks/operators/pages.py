"""Pages of documents: sampling, context, and the text that they make up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sample_pages(pages: DataFrame, doc: str, number: str, blank: Column, first: int = 5, last: int = 3) -> DataFrame:
    """The first and last pages of each document that aren't blank, in order, none twice."""
    shown = pages.where(~F.coalesce(blank, F.lit(True)))
    a = F.row_number().over(Window.partitionBy(doc).orderBy(number))
    z = F.row_number().over(Window.partitionBy(doc).orderBy(F.desc(number)))
    return shown.withColumns({"_a": a, "_z": z}).where((F.col("_a") <= first) | (F.col("_z") <= last)).drop("_a", "_z")


def context_pages(pages: Column, first: int | None, last: int | None) -> Column:
    """First and last items of an ordered array, none twice; all of them if neither number is given."""
    if first is None and last is None:
        return pages
    n = F.size(pages)
    head = F.slice(pages, 1, F.least(F.lit(first or 0), n))
    if not last:
        return head
    tail = F.slice(pages, F.greatest(n - F.least(F.lit(last), n) + 1, F.lit(1)), F.lit(last))
    return F.array_distinct(F.concat(head, tail))


def is_blank(nonwhite: Column, total: Column, threshold: float = 0.005) -> Column:
    """Whether a page shows next to nothing; one without pixels is blank."""
    return F.when(total == 0, True).otherwise(F.try_divide(nonwhite, total) <= threshold)


def page_text(number: Column, results: Column) -> Column:
    """The results of one page that aren't blank, each under its heading."""
    shown = F.filter(results, lambda r: F.trim(F.coalesce(r["text"], F.lit(""))) != "")
    return F.array_join(F.transform(shown, lambda r: F.concat(F.lit("=== Page "), number.cast("string"), F.lit(" - "), r["method"], F.lit(" ===\n"), r["text"], F.lit("\n"))), "\n")


def combined_text(pages: DataFrame, doc: str, number: str, results: str) -> DataFrame:
    """doc, combined_text, has_text: the page texts in order."""
    t = pages.select(doc, F.struct(F.col(number).alias("n"), page_text(F.col(number), F.col(results)).alias("t")).alias("p"))
    out = t.groupBy(doc).agg(F.array_sort(F.collect_list("p")).alias("ps"))
    text = F.array_join(F.transform("ps", lambda p: p["t"]), "\n")
    return out.select(doc, text.alias("combined_text"), F.exists("ps", lambda p: F.trim(p["t"]) != "").alias("has_text"))
