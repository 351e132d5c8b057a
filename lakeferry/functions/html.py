"""Cells of HTML tables, as array expressions over a page column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Named character references that occur in cell texts.
ENTITIES = (
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&apos;", "'"),
    ("&minus;", "\u2212"),
    ("&ndash;", "\u2013"),
    ("&mdash;", "\u2014"),
    ("&euro;", "\u20ac"),
    ("&percnt;", "%"),
    ("&comma;", ","),
    ("&period;", "."),
)


def element_pattern(tag: str) -> str:
    """Pattern whose first group is the inside of an element (elements of one kind do not nest)."""
    return rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>"


def inner_parts(html: Column, tag: str) -> Column:
    return F.regexp_extract_all(html, F.lit(element_pattern(tag)), F.lit(1))


def plain_text(html: Column) -> Column:
    """Text of a fragment: tags removed, character references resolved, ends stripped."""
    bare = F.regexp_replace(html, r"(?s)<[^>]*>", "")
    resolved = bare
    for name, char in ENTITIES:
        resolved = F.replace(resolved, F.lit(name), F.lit(char))
    for digits, base in ((r"&#(\d{1,7});", 10), (r"&#[xX]([0-9a-fA-F]{1,6});", 16)):
        resolved = _numbered(resolved, digits, base)
    # last, so that what it gives is not resolved again
    resolved = F.replace(resolved, F.lit("&amp;"), F.lit("&"))
    text = F.when(bare.contains("&"), resolved).otherwise(bare)
    return F.regexp_replace(text, r"^[\s\u00a0]+|[\s\u00a0]+$", "")


def _numbered(text: Column, digits: str, base: int) -> Column:
    """Numeric references of one base resolved, each distinct one by one replacement."""
    mark = F.lit("&#" if base == 10 else "&#x")
    return F.aggregate(
        F.array_distinct(F.regexp_extract_all(text, F.lit(digits), F.lit(1))),
        F.replace(text, F.lit("&#X"), F.lit("&#x")),
        lambda found, x: F.replace(found, F.concat(mark, x, F.lit(";")), _char(x, base)),
    )


def _char(digits: Column, base: int) -> Column:
    """Character of a code in digits."""
    code = F.lpad(F.conv(digits, base, 16), 8, "0")
    return F.decode(F.unhex(code), "UTF-32")


def first_table(html: Column, css_class: str | None = None) -> Column:
    """Inside of the first table, or of the first one with exactly this class; null if there is none."""
    quote = """["']?"""
    attrs = r"(?:\s[^>]*)?" if css_class is None else rf"(?=\s)[^>]*\sclass\s*=\s*{quote}{css_class}{quote}(?=[\s>])[^>]*"
    return F.nullif(F.regexp_extract(html, rf"(?is)<table{attrs}>(.*?)</table\s*>", 1), F.lit(""))


def row_cells(row: Column, cell: str = "td", header: str | None = "th") -> Column:
    """Texts of one row: those of its links, then those of its cells (or header cells), blanks dropped."""
    cells = inner_parts(row, cell)
    if header is not None:
        cells = F.when(F.size(cells) > 0, cells).otherwise(inner_parts(row, header))
    texts = F.transform(F.concat(inner_parts(row, "a"), cells), plain_text)
    return F.filter(texts, lambda x: x != "")


def table_cells(table: Column, row: str = "tr", cell: str = "td", header: str | None = "th") -> Column:
    """Array of rows, each an array of cell texts."""
    return F.transform(inner_parts(table, row), lambda x: row_cells(x, cell, header))
