"""Find licences in whole texts by their sentences, in the order that a licence's rule names.

A text is cut into pieces at line ends and after closing punctuation, and each piece is reduced
to lower-case words, which also drops comment marks. A piece is a sentence; but where the words
of several pieces in a row are a known sentence, they are that one. Such pieces may be parted by
a line end, a semicolon or a colon (hard-wrapped texts), not by a full stop or a line without
words. Known licence sentences have an identifier of one letter, so the identifiers of a text
are one string, with a dot for each other sentence; a rule is an ordered
pattern of identifiers that allows a few other sentences between them. Longer rules come
first; matches don't overlap. All of it is built-in functions on one row.

Null or empty text, or one without words: no sentences, no licences. Empty table: no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Identifiers of known sentences, as they read once reduced to words.
SENTENCES = {
    "A": "licensed under the apache license version 2 0",
    "B": "licensed under the apache license version 2 0 the license",
    "D": "you may not use this file except in compliance with the license",
    "E": "you may obtain a copy of the license at",
    "F": "unless required by applicable law or agreed to in writing software distributed under "
    "the license is distributed on an as is basis without warranties or conditions of any kind "
    "either express or implied",
    "G": "see the license for the specific language governing permissions and limitations under "
    "the license",
    "H": "released under the mit license",
    "I": "this project is licensed under the mit license",
    "J": "permission is hereby granted free of charge to any person obtaining a copy of this "
    "software and associated documentation files the software to deal in the software without "
    "restriction including without limitation the rights to use copy modify merge publish "
    "distribute sublicense and or sell copies of the software and to permit persons to whom the "
    "software is furnished to do so subject to the following conditions",
    "K": "the above copyright notice and this permission notice shall be included in all copies "
    "or substantial portions of the software",
    "L": "the software is provided as is without warranty of any kind express or implied "
    "including but not limited to the warranties of merchantability fitness for a particular "
    "purpose and noninfringement",
    "M": "redistribution and use in source and binary forms with or without modification are "
    "permitted provided that the following conditions are met",
    "N": "redistributions of source code must retain the above copyright notice this list of "
    "conditions and the following disclaimer",
    "O": "redistributions in binary form must reproduce the above copyright notice this list of "
    "conditions and the following disclaimer in the documentation and or other materials "
    "provided with the distribution",
    "P": "neither the name of the copyright holder nor the names of its contributors may be "
    "used to endorse or promote products derived from this software without specific prior "
    "written permission",
    "Q": "this work is licensed under the gnu general public license version 3",
    "R": "this program is free software you can redistribute it and or modify it under the "
    "terms of the gnu general public license as published by the free software foundation "
    "either version 3 of the license or at your option any later version",
    "S": "this program is distributed in the hope that it will be useful but without any "
    "warranty without even the implied warranty of merchantability or fitness for a particular "
    "purpose",
    "T": "see the gnu general public license for more details",
    "U": "licensed under cc by nc 4 0",
    "V": "licensed under cc by 4 0",
    "W": "licensed under cc by sa 4 0",
    "X": "this work is licensed under a creative commons attribution 4 0 international license",
    "Y": "this is free and unencumbered software released into the public domain",
    "Z": "all rights reserved",
}
#: A licence and its sentences in order, longer rules before their parts.
RULES = (
    ("Apache-2.0 header", "BDEFG"),
    ("MIT text", "JKL"),
    ("BSD-3-Clause", "MNOP"),
    ("BSD-2-Clause", "MNO"),
    ("GPL-3.0-or-later header", "RST"),
    ("GPL-3.0-or-later header", "RS"),
    ("Apache-2.0", "A"),
    ("Apache-2.0", "B"),
    ("MIT", "H"),
    ("MIT", "I"),
    ("GPL-3.0", "Q"),
    ("CC-BY-NC-4.0", "U"),
    ("CC-BY-4.0", "V"),
    ("CC-BY-SA-4.0", "W"),
    ("CC-BY-4.0", "X"),
    ("Unlicense", "Y"),
    ("proprietary", "Z"),
)
#: Other sentences allowed between two of a rule: an address, a list mark, a clause.
BETWEEN = r"\.{0,2}"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SENTENCE_END = r"[.!?;:]+[ \t\r\n]+|[\r\n]+"
#: Marks for the end of a piece: known sentences go on over the first, not over the second.
SOFT, HARD = "\x01", "\x02"


def rule_pattern(sentences: str) -> str:
    return BETWEEN.join(sentences)


def any_rule() -> str:
    return "|".join(rule_pattern(sentences) for _, sentences in RULES)


def pieces(text: Column) -> Column:
    """The lower-case words of the text, with marks where the pieces of ``SENTENCE_END`` end."""
    low = F.translate(text, UPPER + SOFT + HARD, LOWER + "--")
    low = F.replace(low, F.lit("\r\n"), F.lit("\n"))
    ends = F.regexp_replace(low, r"[.!?](?=[ \t\r\n])", HARD)
    ends = F.regexp_replace(ends, r"[;:](?=[ \t\r\n])", SOFT)
    words = F.regexp_replace(ends, f"[^a-z0-9\r\n{SOFT}{HARD}]+", " ")
    gap = f" \r\n{SOFT}{HARD}"
    # Each gap is tried at its start only, so long ones cost no more than their length.
    stop = f"[ \r\n{SOFT}]*+{HARD}"
    blank = f"[ {SOFT}]*+[\r\n][ {SOFT}]*+[\r\n]"
    hard = F.regexp_replace(words, f"(?<![{gap}])(?:{stop}|{blank})[{gap}]*", HARD)
    soft = f"(?<![{gap}]) ?[\r\n{SOFT}][ \r\n{SOFT}]*"
    return F.trim(F.regexp_replace(hard, soft, SOFT))


def sentences(text: Column) -> Column:
    """The sentences as lower-case words, without empty ones."""
    longest = sorted(SENTENCES.values(), key=len, reverse=True)
    known = "|".join(s.replace(" ", f"[ {SOFT}]") for s in longest)
    other = f"[^{SOFT}{HARD}]"
    one = f"(?<!{other})(?:{known})(?!{other})|{other}+"
    found = F.regexp_extract_all(pieces(text), F.lit(one), F.lit(0))
    return F.transform(found, lambda s: F.translate(s, SOFT, " "))


def identifiers(listed: Column) -> Column:
    """One letter per sentence, a dot for those that are not known."""
    pairs = [F.lit(x) for letter, sentence in SENTENCES.items() for x in (sentence, letter)]
    known = F.create_map(*pairs)
    return F.array_join(
        F.transform(listed, lambda s: F.coalesce(F.element_at(known, s), F.lit("."))), ""
    )


def licence_of(match: Column) -> Column:
    """The first rule that a matched run of identifiers follows."""
    name = F.lit(None).cast("string")
    for licence, own in reversed(RULES):
        name = F.when(match.rlike(f"^(?:{rule_pattern(own)})$"), licence).otherwise(name)
    return name


def find_licences(documents: DataFrame) -> DataFrame:
    """doc_id, identifiers of all sentences, the matched runs, and their licences in order."""
    codes = F.coalesce(identifiers(sentences(F.col("text"))), F.lit(""))
    found = documents.select("doc_id", codes.alias("identifiers"))
    found = found.withColumn(
        "matches", F.regexp_extract_all("identifiers", F.lit(f"({any_rule()})"), F.lit(1))
    )
    return found.withColumn("licences", F.transform("matches", licence_of))
