"""Samples and blocks against plain statements of their rules."""

import csv
import io
import random
import sys
import time

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from reportarium.operators.samples import (
    explode_blocks,
    sample_text,
    unquoted,
    with_column_sample,
    with_records,
)
from reportarium.plans.exports import output_blocks
from reportarium.sources.exports import locate, read_outputs
from reportarium.workload.roles import Tables, outputs


def rule_lines(text):
    parts = text.split("\n")
    return parts[:-1] if parts[-1] == "" else parts


def rule_blocks(text, rows=5):
    """Every run of table rows, titled by the first longer line since the block before."""
    lines = rule_lines(text)
    table = [line.count("\t") >= 3 for line in lines]
    blocks, gap, i = [], [], 0
    while i < len(lines):
        if not table[i]:
            gap.append(lines[i])
            i += 1
            continue
        end = i
        while end < len(lines) and table[end]:
            end += 1
        if blocks:
            gap = gap[gap.index("") + 1 :] if "" in gap else []
        title = next((g for g in gap if len(g) >= 5), f"Report {len(blocks) + 1}")
        blocks.append((title, [x.replace("\t", "|") for x in lines[i : min(end, i + rows)]]))
        gap, i = [], end
    return blocks


def rule_compat(text, rows=5):
    """The older scan: one block, then nothing until a blank line below the closing line."""
    lines, found, i = rule_lines(text), {}, 0
    while i < len(lines):
        title = None
        while i < len(lines) and lines[i].count("\t") < 3:
            if title is None and len(lines[i]) >= 5:
                title = lines[i]
            i += 1
        start = i
        while i < len(lines) and lines[i].count("\t") >= 3 and i - start < rows:
            i += 1
        if i >= len(lines):
            break
        found[title or f"Report {len(found) + 1}"] = [
            x.replace("\t", "|") for x in lines[start:i]
        ]
        i += 1
        while i < len(lines) and lines[i] != "":
            i += 1
        i += 1
    return sorted(found.items())


CASES = [
    "",
    "\n",
    "Title one\n\na\tb\tc\td\n1\t2\t3\t4\n",
    "Title one\na\tb\tc\td\n1\t2\t3\t4\n\nTitle two\nx\ty\tz\tw\n\n",
    "abc\na\tb\tc\td\n\nq\tw\te\tr\n\n",
    "Three\na\tb\tc\n",
    "Long table\n" + "a\tb\tc\td\n" * 7 + "\nAfter it\n" + "e\tf\tg\th\n" * 2 + "\n",
    "Same title\na\tb\tc\td\n\n\nSame title\ne\tf\tg\th\n\n",
    "Title\na\tb\tc\td\nfooter line\nstill footer\n\nNext one\ne\tf\tg\th\nend\n",
    "a\tb\tc\td",
]


def random_texts(count, seed):
    rng = random.Random(seed)
    kinds = ["", "", "a\tb\tc\td", "1\t2\t3\t4\t5", "Title %d", "abc", "x\ty", "Same"]
    for n in range(count):
        lines = [rng.choice(kinds) for _ in range(rng.randrange(0, 25))]
        yield "\n".join(x % n if "%" in x else x for x in lines) + rng.choice(["", "\n"])


@pytest.mark.parametrize("compat", [False, True])
def test_blocks_follow_the_rule(spark, compat):
    texts = CASES + list(random_texts(300, seed=7))
    df = spark.createDataFrame(list(enumerate(texts)), "document_id int, text string")
    got = {n: [] for n in range(len(texts))}
    for row in explode_blocks(df, "text", compat=compat).collect():
        got[row.document_id].append((row.block_no, row.title, row.rows))
    for n, text in enumerate(texts):
        blocks = [(title, rows) for _, title, rows in sorted(got[n])]
        if compat:
            assert sorted(blocks) == rule_compat(text), repr(text)
        else:
            assert blocks == rule_blocks(text), repr(text)


def test_older_scan_on_whole_documents(spark):
    source = outputs(Tables(spark, SMALL), tabs=True).withColumn(
        "text", F.replace("text", F.lit(".\n"), F.lit("\n\n"))
    )
    got = {}
    for row in output_blocks(source, compat=True).collect():
        got.setdefault(row.document_id, []).append((row.title, row.rows))
    for row in source.collect():
        assert sorted(got.get(row.document_id, [])) == rule_compat(row.text)


def test_open_block_and_following_table_differ_by_mode(spark):
    text = "First one\na\tb\tc\td\n\nSecond one\ne\tf\tg\th\n\nThird one\ni\tj\tk\tl"
    df = spark.createDataFrame([(text,)], "text string")
    titles = lambda compat: [r.title for r in explode_blocks(df, "text", compat=compat).collect()]
    assert titles(False) == ["First one", "Second one", "Third one"]
    assert titles(True) == ["First one"]


@pytest.mark.parametrize("compat", [False, True])
def test_blocks_of_a_long_text_take_linear_time(spark, compat):
    """A hundred thousand blocks, and long stretches without any, in one text."""
    def text(number):
        blocks = "".join(f"Title {i % 900}\na\tb\tc\td\nfoot\n\n" if i % 3 else "e\tf\tg\th\n\n\n" for i in range(number))
        return "x\n" * number + blocks + "long line\n" * number + "a\tb\tc\td"

    seconds = {}
    for number in (10_000, 100_000, 100_000):
        whole = text(number)
        df = spark.createDataFrame([(whole,)], "text string")
        start = time.perf_counter()
        got = [(r.title, r.rows) for r in explode_blocks(df, "text", compat=compat).orderBy("block_no").collect()]
        seconds[number] = time.perf_counter() - start
        assert (sorted(got) if compat else got) == (rule_compat if compat else rule_blocks)(whole)
    assert seconds[100_000] < 25 * max(seconds[10_000], 0.5)


@pytest.mark.parametrize("lines", [1, 3, 15])
def test_text_sample_keeps_first_lines(spark, lines):
    texts = ["", "a", "a\n", "a\tb\n\n", "\n" * 20, "\n".join(str(i) for i in range(40)), "a\n" * 15]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r[0] for r in df.select(sample_text(F.col("text"), lines)).collect()]
    want = ["".join(x + "\n" for x in rule_lines(t)[:lines]).replace("\t", ";") for t in texts]
    assert got == want


def test_column_sample_cases(spark):
    cases = {
        "two": "h1\th2\n1\t2\n3\n\n5\t6\t7",
        "one": "one\na\nb",
        "header": "h1\th2\n",
        "empty": "",
        "blank": "\na\tb",
        "double": "x\ty\tx\n1\t2\t3",
        "many": "a\tb\n" + "".join(f"{i}\t{i}\n" for i in range(40)),
    }
    df = spark.createDataFrame(list(cases.items()), "name string, text string")
    got = {r.name: r for r in with_column_sample(df, "text").collect()}
    columns = lambda name: [(c.name, c["values"]) for c in got[name].columns]
    assert columns("two") == [("h1", ["1", "3", "5"]), ("h2", ["2", None, "6"])]
    assert got["one"].columns is None and got["one"].sample_text == "one\na\nb\n"
    assert got["header"].columns == [] and got["header"].sample_text is None
    assert got["empty"].columns == []
    assert got["blank"].sample_text == "\na;b\n"
    assert dict(columns("double")) == {"x": ["3"], "y": ["2"]}
    assert columns("many")[0] == ("a", [str(i) for i in range(15)])


def records(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    plain = F.transform("records", lambda r: F.struct((F.array_join(r, "") == "").alias("bare"), F.transform(r, unquoted).alias("cells")))
    rows = with_records(df, "text", "records").select("n", plain.alias("records")).collect()
    found = {r.n: [x.cells for x in r.records if not (x.bare and len(x.cells) == 1)] for r in rows}
    return [found[n] for n in range(len(texts))]


def rule_records(text):
    csv.field_size_limit(sys.maxsize)
    return [r for r in csv.reader(io.StringIO(text), delimiter="\t") if r]


def test_cells_equal_those_of_a_reader_of_separated_values(spark):
    rng = random.Random(3)
    texts = ['a"b\tc', '"a\tb"\tc', '"a""b"c"d\te', '"open\tto the\nend', '""\t""""\t"""', '"x"\n"y"']
    texts += ["".join(rng.choices('a"\t\n', [3, 4, 2, 1], k=rng.randrange(0, 14))) for _ in range(1500)]
    for text, got in zip(texts, records(spark, texts)):
        assert got == rule_records(text), repr(text)


def test_long_cells_and_many_cells(spark):
    long = "x" * 1_000_000
    texts = [
        f'h1\th2\n"{long}"\tb\n',
        'h1\th2\n"' + '""' * 300_000 + '"\tb\n',
        'h1\th2\n"' + "a\t" * 200_000 + '"\tb\n',
        "h\t" * 100_000 + "\n" + '"a"\t' * 100_000,
        '"' + "\n" * 100_000,
    ]
    for text, got in zip(texts, records(spark, texts)):
        assert got == rule_records(text)
    df = spark.createDataFrame([(texts[0],)], "text string")
    (row,) = with_column_sample(df, "text").collect()
    assert [(c.name, c["values"]) for c in row.columns] == [("h1", [long]), ("h2", ["b"])]


def test_output_files_are_read_whole(spark, folder):
    with open(f"{folder}/Output_17.csv", "w", newline="") as f:
        f.write("Sales;x\r\na\tb\r\n1\t2\r\n")
    with open(f"{folder}/Output_18.csv", "w") as f:
        f.write("h\n")
    found = read_outputs(spark, folder)
    rows = {r.document_id: r.text for r in found.collect()}
    assert rows == {"17": "Sales;x\na\tb\n1\t2\n", "18": "h\n"}
    paths = spark.createDataFrame([("D1", "/exports/Output_17.csv")], "document_id string, export_path string")
    assert [(r.document_id, r.text[:5]) for r in locate(found, paths).collect()] == [("D1", "Sales")]
