"""Samples out of report output texts; each text is handled within its own row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportarium.functions.text import head_lines, lines_of

# Lines of a text sample, rows per table block, fields that make a line
# a table row, length from which a line is a title.
SAMPLE_LINES = 15
BLOCK_ROWS = 5
TABLE_FIELDS = 4
TITLE_CHARS = 5


def sample_text(text: Column, lines: int = SAMPLE_LINES) -> Column:
    """First lines of a text, tabs as semicolons, every line closed by a newline."""
    return F.replace(head_lines(text, lines), F.lit("\t"), F.lit(";"))


#: What a separated piece does: it opens a quoted cell, or would close one that is open.
_OPENS, _CLOSES, _PLAIN = "o", "c", "n"
#: Cells over these signs: a quoted one lasts until a piece closes it, or to the end.
_CELL_RUN = f"{_OPENS}{_PLAIN}*[{_OPENS}{_CLOSES}]?|[{_CLOSES}{_PLAIN}]"


def _has_closing(piece: Column) -> Column:
    """Whether a quote is left when doubled ones are taken out."""
    return F.contains(F.replace(piece, F.lit('""'), F.lit("")), F.lit('"'))


def _sign(piece: Column) -> Column:
    """A quote opens a cell only at its beginning, and closes one that is open unless doubled."""
    own = F.substring(piece, 2, 1 << 30)
    rest = F.substring(piece, 3, 1 << 30)
    opens = F.startswith(own, F.lit('"')) & ~_has_closing(rest)
    return F.when(opens, _OPENS).when(_has_closing(own), _CLOSES).otherwise(_PLAIN)


def unquoted(cell: Column) -> Column:
    """A cell without the quotes around it; what follows the closing quote stays as it is."""
    parts = F.split(F.substring(cell, 2, 1 << 30), '""')
    holding = F.array_position(F.transform(parts, lambda p: F.contains(p, F.lit('"'))), True)
    last = F.get(parts, (holding - 1).cast("int"))
    inside = F.substring_index(last, '"', 1)
    behind = F.substring(last, F.char_length(inside) + 2, F.lit(1 << 30))
    closed = F.concat(
        F.array_join(F.array_append(F.slice(parts, 1, (holding - 1).cast("int")), inside), '"'),
        F.array_join(
            F.array_prepend(F.slice(parts, (holding + 1).cast("int"), F.size(parts)), behind), '""'
        ),
    )
    return (
        F.when(~F.startswith(cell, F.lit('"')), cell)
        .when(holding == 0, F.array_join(parts, '"'))
        .otherwise(closed)
    )


def with_records(df: DataFrame, text: str, name: str) -> DataFrame:
    """The other columns and the records of a tab-separated text: arrays of raw cells.

    Cells are parted by tabs and records by line ends outside quotes. Everything is linear in the
    text: it is split once at each tab and line end, every piece gets a sign for what its quotes
    do, and one look over the string of signs tells which pieces make up a cell.
    """
    kept = [c for c in df.columns if c != text]
    pieces = F.regexp_extract_all(F.concat(F.lit("\n"), F.col(text)), F.lit("[\t\n][^\t\n]*"), F.lit(0))
    # Without any quote every piece is a cell, and the steps below are null.
    quoted = F.contains(F.col(text), F.lit('"'))
    signs = F.when(quoted, F.array_join(F.transform("__pieces", _sign), ""))
    runs = F.transform(F.regexp_extract_all("__signs", F.lit(_CELL_RUN), F.lit(0)), F.char_length)
    begins = F.flatten(
        F.transform("__runs", lambda n: F.concat(F.array(F.lit(True)), F.array_repeat(F.lit(False), n - 1)))
    )
    starts = F.filter(
        F.transform("__begins", lambda first, at: F.when(first, at + 1)), lambda at: at.isNotNull()
    )
    cells = F.transform(
        F.arrays_zip(F.col("__starts").alias("at"), F.col("__runs").alias("n")),
        lambda run: F.array_join(F.slice("__pieces", run["at"], run["n"]), ""),
    )
    cells = F.coalesce(cells, "__pieces")
    lines = F.filter(
        F.transform("__cells", lambda c, at: F.when(F.startswith(c, F.lit("\n")), at + 1)),
        lambda at: at.isNotNull(),
    )
    records = F.transform(
        "__lines",
        lambda at, place: F.transform(
            F.slice("__cells", at, F.coalesce(F.get("__lines", place + 1), F.size("__cells") + 1) - at),
            lambda c: F.substring(c, 2, 1 << 30),
        ),
    )
    steps = {"__pieces": pieces, "__signs": signs, "__runs": runs, "__begins": begins}
    steps |= {"__starts": starts, "__cells": cells, "__lines": lines}
    for step, made in steps.items():
        df = df.withColumn(step, made)
    return df.select(*kept, records.alias(name))


def with_column_sample(df: DataFrame, text: str, samples: int = SAMPLE_LINES) -> DataFrame:
    """Add ``columns``: header and first values of a tab-separated text; or ``sample_text``.

    Cells may be quoted, and then hold tabs, line ends and doubled quotes; a quote within a cell
    stands for itself. Blank lines are not rows. Missing cells are null, surplus cells are dropped,
    of two equal headers the later column counts. A text with one column has no ``columns`` but
    the plain sample; one without data rows has an empty ``columns``.
    """
    kept = df.columns
    recorded = with_records(df.withColumn("__text", F.col(text)), "__text", "__records")
    below = F.filter("__records", lambda r, place: (place > 0) & ~((F.size(r) == 1) & (r[0] == "")))
    rows = F.transform(F.slice(below, 1, samples), lambda r: F.transform(r, unquoted))
    header = F.transform(F.get("__records", F.lit(0)), unquoted)
    places = F.array_sort(
        F.transform(header, lambda name, place: F.struct(name.alias("name"), place.alias("place")))
    )
    # Sorted by name and place, the last of equal names is followed by another name.
    lasting = F.filter(
        "__places",
        lambda p, i: ~F.coalesce(F.get("__places", i + 1)["name"] == p["name"], F.lit(False)),
    )
    ordered = F.array_sort(
        F.transform(lasting, lambda p: F.struct(p["place"].alias("place"), p["name"].alias("name")))
    )
    columns = F.transform(
        ordered,
        lambda p: F.struct(
            p["name"].alias("name"),
            F.transform("__rows", lambda row: F.get(row, p["place"])).alias("values"),
        ),
    )
    single = F.size(ordered) == 1
    none = F.array().cast("array<struct<name: string, values: array<string>>>")
    return recorded.select(*kept, rows.alias("__rows"), places.alias("__places")).select(
        *kept,
        F.when(F.size("__rows") == 0, none).when(~single, columns).alias("columns"),
        F.when((F.size("__rows") > 0) & single, sample_text(F.col(text), samples)).alias(
            "sample_text"
        ),
    )


#: What a line is: a table row, blank, long enough for a title, or something else.
_ROW, _BLANK, _LONG, _SHORT = "r", "b", "t", "s"
_OTHER = f"[{_BLANK}{_LONG}{_SHORT}]"


def _with_steps(df: DataFrame, steps: dict[str, Column]) -> DataFrame:
    for name, column in steps.items():
        df = df.withColumn(name, column)
    return df


def _places(begins) -> Column:
    """Places of the lines for which ``begins`` holds."""
    return F.filter(F.sequence(F.lit(0), F.size("__signs") - 1), begins)


def _sign_at(place: Column) -> Column:
    return F.coalesce(F.get("__signs", place), F.lit(_BLANK))


def _first_title(start: Column, signs: Column) -> Column:
    """The first line long enough for a title, of lines from ``start`` on with these signs."""
    at = F.array_position(signs, _LONG).cast("int")
    return F.when(at > 0, F.get("__lines", start + at - 1))


def _runs(df: DataFrame, rows: int) -> DataFrame:
    """``__blocks`` of the table rows that follow one another: title, or null, and first rows."""
    first = _places(lambda i: (_sign_at(i) == _ROW) & (_sign_at(i - 1) != _ROW))
    last = _places(lambda i: (_sign_at(i) == _ROW) & (_sign_at(i + 1) != _ROW))

    def block(start: Column, number: Column) -> Column:
        after = F.when(number > 0, F.get("__last", number - 1) + 1).otherwise(0)
        gap = F.slice("__signs", after + 1, start - after)
        # Behind a block, lines up to the next blank one are no titles.
        blank = F.array_position(gap, _BLANK).cast("int")
        skipped = F.when(number == 0, 0).when(blank == 0, F.size(gap)).otherwise(blank)
        title = _first_title(after + skipped, F.slice(gap, skipped + 1, F.size(gap)))
        kept = F.least(F.lit(rows), F.get("__last", number) - start + 1)
        return F.struct(title.alias("title"), F.slice("__lines", start + 1, kept).alias("rows"))

    steps = {"__first": first, "__last": last, "__blocks": F.transform("__first", block)}
    return _with_steps(df, steps)


def _older_runs(df: DataFrame, rows: int) -> DataFrame:
    """``__blocks`` as the older scan finds them: lines before one, the block, what it skips."""
    # Possessive: no two ways to match, so the signs are looked through once.
    pattern = (
        f"({_OTHER}*+)({_ROW}{{1,{rows}}}+)[{_ROW}{_BLANK}{_LONG}{_SHORT}]"
        f"[{_ROW}{_LONG}{_SHORT}]*+(?:{_BLANK}|$)|{_OTHER}*+{_ROW}{{0,{rows}}}+$"
    )

    def lengths(group: int) -> Column:
        return F.transform(
            F.regexp_extract_all(F.array_join("__signs", ""), F.lit(pattern), F.lit(group)),
            F.char_length,
        )

    # The number of its part for each line, to find where parts begin.
    owner = F.flatten(F.transform("__whole", lambda n, part: F.array_repeat(part, n)))
    begins = _places(
        lambda i: (i == 0) | (F.get("__owner", i) != F.get("__owner", i - 1))
    )
    parts = F.arrays_zip(
        F.col("__begins").alias("start"), F.col("__gaps").alias("gap"), F.col("__taken").alias("taken")
    )

    def block(part: Column) -> Column:
        return F.struct(
            _first_title(part["start"], F.slice("__signs", part["start"] + 1, part["gap"])).alias("title"),
            F.slice("__lines", part["start"] + part["gap"] + 1, part["taken"]).alias("rows"),
        )

    found = F.filter("__parts", lambda part: part["taken"] > 0)
    steps = {"__whole": lengths(0), "__gaps": lengths(1), "__taken": lengths(2), "__owner": owner}
    steps |= {"__begins": begins, "__parts": parts, "__blocks": F.transform(found, block)}
    return _with_steps(df, steps)


def _by_title(blocks: Column) -> Column:
    """Title and place of blocks, in order of both."""
    return F.array_sort(
        F.transform(blocks, lambda b, at: F.struct(b["title"].alias("title"), at.alias("at")))
    )


def _last_of_titles(df: DataFrame) -> DataFrame:
    """``__blocks`` named as the older scan does, of which the last of a title replaces others.

    A block without a title is numbered after the titles known before it.
    """
    # Sorted by title and place, the first of a title follows another one.
    new = F.filter(
        "__sorted",
        lambda b, i: b["title"].isNull() | ~F.coalesce(F.get("__sorted", i - 1)["title"] == b["title"], F.lit(False)),
    )
    counted = F.transform(
        F.array_sort(F.transform(new, lambda b: F.struct(b["at"].alias("at"), b["title"].alias("title")))),
        lambda b, known: F.struct(b["at"].alias("at"), b["title"].alias("title"), (known + 1).alias("number")),
    )
    numbered = F.transform(
        F.filter(counted, lambda b: b["title"].isNull()),
        lambda b: F.struct(
            b["at"].alias("at"), F.concat(F.lit("Report "), b["number"].cast("string")).alias("title")
        ),
    )
    own = F.filter(
        F.transform("__blocks", lambda b, at: F.struct(at.alias("at"), b["title"].alias("title"))),
        lambda b: b["title"].isNotNull(),
    )
    named = F.array_sort(F.concat(own, numbered))
    named_blocks = F.zip_with(
        "__named",
        "__blocks",
        lambda b, found: F.struct(b["title"].alias("title"), found["rows"].alias("rows")),
    )
    last = F.filter(
        "__sorted",
        lambda b, i: ~F.coalesce(F.get("__sorted", i + 1)["title"] == b["title"], F.lit(False)),
    )
    kept = F.transform(
        F.array_sort(F.transform(last, lambda b: b["at"])), lambda at: F.get("__blocks", at)
    )
    steps = {"__sorted": _by_title(F.col("__blocks")), "__named": named, "__blocks": named_blocks}
    df = _with_steps(df, steps)
    return _with_steps(df, {"__sorted": _by_title(F.col("__blocks")), "__blocks": kept})


def explode_blocks(df: DataFrame, text: str, rows: int = BLOCK_ROWS, compat: bool = False) -> DataFrame:
    """One row per titled table block of a text: ``block_no`` from 1, ``title``, ``rows``.

    A table row has at least four tab-separated fields. A block is a run of such rows,
    of which the first ``rows`` are kept with ``|`` for tabs. Its title is the first
    longer line since the block before; lines that follow a block up to the next blank
    line belong to that block and are no titles. Without a title it is ``Report n``.

    ``compat`` reproduces the older scan: a block also ends at the row after the last
    kept one, everything up to the next blank line after the closing line is skipped
    (also when the closing line is itself blank), a block open at the end of the text
    is lost, and of blocks with one title the last replaces the others. Its ``Report n``
    are numbered as if no line of the text read like that.

    Blocks are found from one sign per line, by places; texts are cut out at the end. The work
    is linear in the lines of a text, but for sorting its titles in ``compat``.
    """
    kept = [c for c in df.columns if c != text]
    line_sign = lambda line: (
        # Cut before the tab that opens the fourth field, a table row has lost something.
        F.when(F.substring_index(line, "\t", TABLE_FIELDS - 1) != line, _ROW)
        .when(line == "", _BLANK)
        .when(F.char_length(line) >= TITLE_CHARS, _LONG)
        .otherwise(_SHORT)
    )
    lined = df.select(*kept, lines_of(F.col(text)).alias("__lines")).filter(F.size("__lines") > 0)
    signed = lined.withColumn("__signs", F.transform("__lines", line_sign))
    found = _last_of_titles(_older_runs(signed, rows)) if compat else _runs(signed, rows)
    # The outer form, as for the plain one Spark adds a filter that finds the blocks twice.
    exploded = found.select(*kept, F.posexplode_outer("__blocks").alias("__no", "__block"))
    numbered = exploded.filter("__no is not null").withColumn("block_no", F.col("__no") + 1)
    return numbered.select(
        *kept,
        "block_no",
        F.coalesce("__block.title", F.concat(F.lit("Report "), F.col("block_no").cast("string"))).alias(
            "title"
        ),
        F.transform("__block.rows", lambda row: F.replace(row, F.lit("\t"), F.lit("|"))).alias("rows"),
    )
