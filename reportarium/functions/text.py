"""Text columns; all built-in expressions over the whole text."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


# Fixed value: characters that count as white space at the ends of a text.
WHITE_SPACE = (
    "\t\n\x0b\f\r \x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Cut white space of every kind at both ends (a plain ``trim`` cuts blanks only)."""
    return F.trim(text, F.lit(WHITE_SPACE))


def unix_lines(text: Column) -> Column:
    """Line ends as a single newline."""
    return F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def lines_of(text: Column) -> Column:
    """Array of lines without their newline; a final newline opens no line."""
    closing = F.when(text.endswith("\n"), 1).otherwise(0)
    cut = F.substring(text, F.lit(1), F.char_length(text) - closing)
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(cut, "\n"))


def head_lines(text: Column, lines: int) -> Column:
    """The first lines of a text, each closed by a newline."""
    head = F.substring_index(text, "\n", lines)
    cut = F.char_length(head) < F.char_length(text)
    closed = F.when(cut | ~text.endswith("\n"), F.concat(head, F.lit("\n"))).otherwise(text)
    return F.when(text == "", F.lit("")).otherwise(closed)


def first_digits(text: Column) -> Column:
    """First run of digits, null where there is none."""
    found = F.regexp_extract(text, r"(\d+)", 1)
    return F.when(found != "", found)


def path_segment(path: Column, back: int = 1) -> Column:
    """Segment of a path counted from its end."""
    return F.try_element_at(F.split(path, "/"), F.lit(-back))


def without_scheme(path: Column, scheme_length: int = 5) -> Column:
    """Path without its five-character scheme."""
    return F.substring(path, F.lit(scheme_length + 1), F.char_length(path))


def report_label(name: Column, number: Column) -> Column:
    return F.coalesce(name, F.concat(F.lit("Report "), number.cast("string")))


def word_count(text: Column) -> Column:
    """Words between white space."""
    return F.regexp_count(text, F.lit(r"\S+"))


def keyword_matches(text: Column, keywords: Iterable[str]) -> Column:
    """Keywords found in a text as whole words, in lower case, once per occurrence.

    The words of the text (letters a-z and digits) are looked up alone and in runs as long as
    the keywords have, so phrases count that overlap or lie within one another. Shorter ones come
    first, those of one length in the order of the text.
    """
    by_size: dict[int, set[str]] = {}
    for keyword in keywords:
        words = re.findall("[a-z0-9]+", keyword.lower())
        by_size.setdefault(len(words), set()).add(" ".join(words))

    def runs(words: Column, size: int) -> Column:
        if size == 1:
            return words
        # Runs that the end cuts short have fewer words than any keyword sought.
        return F.transform(words, lambda _, at: F.array_join(F.slice(words, at + 1, F.lit(size)), " "))

    def known(words: Column, size: int) -> Column:
        return F.filter(runs(words, size), lambda run: run.isin(*sorted(by_size[size])))

    def found(words: Column) -> Column:
        return F.concat(*(known(words, size) for size in sorted(by_size)))

    words = F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))
    return F.transform(F.array(words), found)[0]
