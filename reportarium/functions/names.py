"""Column-name rules; these touch names on the driver, never rows."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame

# Fixed value: characters a table format rejects in column names.
REJECTED = r"[ ,;{}()\n\t=*\-]+"


def clean_name(name: str, fill: str = "_") -> str:
    return re.sub(REJECTED, fill, name).strip(fill)


def clean_names(df: DataFrame, fill: str = "_") -> DataFrame:
    """Rename all columns by the rule; two columns falling together is an error."""
    names = [clean_name(c, fill) for c in df.columns]
    clash = [n for n, k in Counter(n.lower() for n in names).items() if k > 1]
    if clash:
        raise ValueError(f"column names fall together after cleaning: {sorted(clash)}")
    return df.toDF(*names)


def drop_unnamed(df: DataFrame) -> DataFrame:
    """Drop spreadsheet left-overs: empty headers and ``Unnamed…``.

    The CSV reader names an empty header ``_c<position>``.
    """
    stray = [
        c
        for i, c in enumerate(df.columns)
        if c == "" or c.startswith("Unnamed") or c == f"_c{i}"
    ]
    return df.drop(*stray)
