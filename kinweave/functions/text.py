"""Text normalisation and tokens, as Catalyst expressions.

Accents are removed by one translate: its table is built once from the Unicode database, so no Python
runs for a row.
"""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

PIN_PATTERN = r"\b\d{4,7}\b"
STREET_PATTERN = r"\b\d{1,4}[a-z]?\b"
#: The words that count as missing where a table is read.
NA_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


@functools.cache
def accent_table(last: int = 0x1FFFF) -> tuple[str, str]:
    """Characters that decompose to one of a-z or 0-9, what they become, and after them all marks, which go."""
    source, target, marks = [], [], []
    for point in range(128, last + 1):
        if 0xD800 <= point < 0xE000:
            continue
        c = chr(point)
        if unicodedata.category(c) == "Mn":
            marks.append(c)
            continue
        base = [x for x in unicodedata.normalize("NFD", c.lower()) if unicodedata.category(x) != "Mn"]
        if len(base) == 1 and base[0].isascii() and base[0].isalnum():
            source.append(c)
            target.append(base[0])
    return "".join(source + marks), "".join(target)


def strip_accents(text: Column) -> Column:
    """Lower case without accents."""
    source, target = accent_table()
    return F.translate(F.lower(F.translate(text, source, target)), "̇", "")


def normalise(text: Column) -> Column:
    """Lower case, no accents, runs of anything but a-z and 0-9 as one space, trimmed; null is empty."""
    return F.trim(F.regexp_replace(strip_accents(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", " "))


def pin_code(address: Column, pattern: str = PIN_PATTERN) -> Column:
    """The first postal code, or empty."""
    return F.regexp_extract(address, f"(?i){pattern}", 0)


def street_number(address: Column, pattern: str = STREET_PATTERN) -> Column:
    """The first street number, or empty; a leading four-digit postal code is one, too."""
    return F.regexp_extract(address, f"(?i){pattern}", 0)


def all_numbers(text: Column, pattern: str = PIN_PATTERN) -> Column:
    """The distinct matches of a number pattern."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"({pattern})"), 1))


def token_list(text: Column) -> Column:
    """Tokens between spaces; none for an empty text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), " "), lambda t: t != "")


def replace_tokens(text: Column, table: dict[str, str]) -> Column:
    """Whole tokens replaced in one pass, not recursively. The table is a literal: mining bounds it to its top-k."""
    if not table:
        return text
    known = F.create_map(*[F.lit(x) for pair in sorted(table.items()) for x in pair])
    return F.array_join(F.transform(token_list(text), lambda t: F.coalesce(F.element_at(known, t), t)), " ")


def search_text(name: Column, address: Column) -> Column:
    return F.trim(F.concat_ws(" ", name, address))


def id_list(text: Column) -> Column:
    """A comma list's trimmed ids without blanks; nan and none, in any case, are an empty list."""
    text = F.trim(F.coalesce(text, F.lit("")))
    ids = F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.when(F.lower(text).isin("", "nan", "none"), F.array().cast("array<string>")).otherwise(ids)


def badly_formatted(text: Column) -> Column:
    """A list cell with brackets or quotes, or with padded ids; empty and nan cells pass, and so do empty entries."""
    cell = F.coalesce(text, F.lit(""))
    padded = F.exists(F.split(cell, ","), lambda x: (x != F.trim(x)))
    return ~cell.isin("", "nan") & (cell.rlike(r"[\[\]'\"]") | padded)


def word_grams(text: Column, low: int = 2, high: int = 4) -> Column:
    """Character n-grams of space-padded words; a word stops at the first n that covers it whole."""

    def of_word(w: Column) -> Column:
        padded, size = F.concat(F.lit(" "), w, F.lit(" ")), F.length(w) + 2
        sizes = F.sequence(F.lit(low), F.least(F.lit(high), size))
        return F.flatten(F.transform(sizes, lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: F.substring(padded, i, n))))

    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda t: t != "")
    return F.flatten(F.transform(words, of_word))


def na_to_null(column: Column) -> Column:
    return F.when(~column.isin(*NA_WORDS), column)
