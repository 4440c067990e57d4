"""Link extraction from HTML pages."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Unescaped and unanchored on purpose: any character, then "zip", anywhere in the link.
ARCHIVE_LINK = ".zip"

_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>]*+)"""
_ATTRIBUTES = rf"(?:[^>=]*+=\s*+{_VALUE})*+[^>=]*+"
# One pass over a page. Comments, scripts and other tags are matched as a whole, so that a
# link inside them is passed over; left open, they run to the end of the page, so that each
# character is passed a bounded number of times, however many tags are left open.
# Group 2 holds the attributes of a closed <a> tag and is empty for anything else.
_MARKUP = (
    r"(?is)<(?:!--.*?(?:-->|\z)"
    r"|(script|style)\b.*?(?:</\1\s*+>|\z)"
    rf"|a(?=[\s/])(?:({_ATTRIBUTES})>|{_ATTRIBUTES}\z)"
    rf"|[a-z]{_ATTRIBUTES}(?:>|\z))"
)
# One attribute: name, then an optional value. Whole pairs, so a value is never a name.
_ATTRIBUTE = rf"""(?s)([^\s=>/"']++(?:\s*+=\s*+{_VALUE})?+)"""
_HREF = r"(?is)^href\s*="
_HREF_VALUE = r"""(?is)^href\s*+=\s*+(["']?)(.*)\1$"""
# A character reference at the start of a piece of text: a number, or a name. A name without
# its semicolon counts only where "=" does not follow.
_REFERENCE = r"^&(#[0-9]++;?|#[xX][0-9a-fA-F]++;?|[A-Za-z][A-Za-z0-9]*+(?:;|(?!=)))"
# Numbers 128 to 159 stand for what Windows-1252 has there.
_WINDOWS = [bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(128, 160)]
_REPLACEMENT = "\ufffd"


def page_links(html: Column | str) -> Column:
    """Array of the ``href`` values of all ``<a>`` tags, in page order."""
    tags = F.regexp_extract_all(html, F.lit(_MARKUP), F.lit(2))
    hrefs = F.transform(
        F.filter(tags, lambda tag: tag != ""),
        lambda tag: F.filter(
            F.regexp_extract_all(tag, F.lit(_ATTRIBUTE), F.lit(1)), lambda a: a.rlike(_HREF)
        ),
    )
    # The first one counts if a tag has several.
    return F.transform(F.filter(hrefs, lambda h: F.size(h) > 0), lambda h: _value(F.get(h, 0)))


def extract_links(
    pages: DataFrame, pattern: str = ARCHIVE_LINK, *, html: str = "html", link: str = "link"
) -> DataFrame:
    """One row per link that contains a match of ``pattern``; other page columns are kept.

    A narrow job: no shuffle and no Python worker, each page is handled where it is read.
    """
    links = pages.withColumn(link, F.explode(page_links(html))).drop(html)
    return links.filter(F.col(link).rlike(pattern))


def _value(attribute: Column) -> Column:
    value = F.regexp_extract(attribute, _HREF_VALUE, 2)
    return F.when(value.contains("&"), _unescaped(value)).otherwise(value)


def _unescaped(text: Column) -> Column:
    """Decode character references, each once: what one gives is never part of another."""
    # One constant, which the optimizer folds; names come with their semicolon where needed.
    names = F.from_json(F.lit(json.dumps(html5)), "map<string,string>")

    def decoded(piece: Column) -> Column:
        reference = F.regexp_extract(piece, _REFERENCE, 1)
        char = F.when(reference.startswith("#"), _numbered(reference)).otherwise(
            F.try_element_at(names, reference)
        )
        rest = F.substr(piece, F.char_length(reference) + 2)
        return F.when(reference == "", piece).otherwise(F.coalesce(F.concat(char, rest), piece))

    pieces = F.split(text, "(?=&)", -1)
    return F.array_join(F.transform(pieces, decoded), "")


def _numbered(reference: Column) -> Column:
    digits = F.rtrim(F.substr(reference, F.lit(2)), F.lit(";"))
    code = F.when(digits.rlike("^[xX]"), F.conv(F.substr(digits, F.lit(2)), 16, 10)).otherwise(digits)
    # Longer numbers are beyond the last character anyway.
    n = F.when(F.char_length(F.ltrim(code, F.lit("0"))) > 7, -1).otherwise(
        F.coalesce(code.try_cast("int"), F.lit(-1))
    )
    plain = F.when(n.between(1, 0xD7FF) | n.between(0xE000, 0x10FFFF), n)
    char = F.decode(F.unhex(F.lpad(F.hex(plain), 8, "0")), "UTF-32")
    windows = F.get(F.array(*map(F.lit, _WINDOWS)), n - 128)
    return F.when(n.between(128, 159), windows).otherwise(F.coalesce(char, F.lit(_REPLACEMENT)))
