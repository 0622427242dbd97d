import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from plain import near_groups, odd_documents, word_ids, word_tokenizer
from reportarium.llm import toxicity
from test_packing import filled
from test_secret_scan import plain_spans

FOLDER = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    """What each stage returns, written and read as the next one's documents."""
    out, docs = [spark.read.parquet(f"{FOLDER}/documents.parquet")], None
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "rows")
        docs = out[-1]
        stage(spark, docs, FOLDER).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_stages_return_documents(results):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "MinHash near-dedup", "secret scans", "packing",
    ]
    for docs in results[:-1]:
        assert docs.columns == COLUMNS


def test_toxic_documents_go_and_clean_ones_stay(spark, results):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").filter(~toxicity.held_out())
    left = {r.doc_id for r in results[1].collect()}
    rows = labels.collect()
    assert all(r.doc_id in left for r in rows if not r.toxic)
    assert sum(r.doc_id not in left for r in rows if r.toxic) >= 0.95 * sum(r.toxic for r in rows)


def test_one_document_of_each_group_stays(results):
    before = [(r.doc_id, r.text) for r in results[1].collect()]
    want = {i for i, component in near_groups(before, 5).items() if i == component}
    after = results[2].collect()
    assert {r.doc_id for r in after} == want and len(after) == len(want) < len(before)


def test_secrets_are_gone_and_other_texts_unchanged(results):
    before = {r.doc_id: r for r in results[2].collect()}
    changed = 0
    for r in results[3].collect():
        assert not plain_spans(r.text)
        if r.text != before[r.doc_id].text:
            changed += 1
            assert "[secret]" in r.text and r.n_chars == len(r.text)
    assert changed >= sum(bool(plain_spans(r.text)) for r in before.values()) > 0
    assert results[3].count() == len(before)


def test_packing_holds_every_id_once(results):
    tokenizer = word_tokenizer()
    rows = results[4].collect()
    by_doc = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        by_doc.setdefault(r.doc_id, []).extend(r.ids)
    assert by_doc == {r.doc_id: word_ids(r.text, 2, tokenizer) for r in results[3].collect()}
    filled((r.length, r.sequence_id, r.offset) for r in rows)


def test_run_equals_its_stages(spark, results):
    got = contract.queries()["pipeline"](spark, FOLDER)
    key = ["doc_id", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got.select(*key).collect())) == sorted(map(tuple, results[4].select(*key).collect()))


def test_odd_documents_pass_all_stages(spark):
    docs = odd_documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.columns == odd_documents(spark).columns
    ids = {r.doc_id for r in docs.collect()}
    assert {0, 1, 2, 10, 13, None} <= ids and 11 not in ids
    empty = odd_documents(spark).filter(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, "/root/testdata/sf0.001")
    assert empty.collect() == []


def test_rows_of_one_id_that_are_not_near_all_stay(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(5, a, 1), (7, a, 2), (7, b, 3), (9, b, 4), (9, b, 5), (9, c + " more", 6), (11, c, 7), (13, "", 8)]
    rows += [(13, "", 9), (13, None, 10), (None, a, 11), (None, a, 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part int")
    stage = dict(corpus_pipeline.STAGES)["MinHash near-dedup"]
    got = stage(spark, docs, FOLDER)
    assert got.schema == docs.schema
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    assert kept == sorted([(5, a), (7, b), (9, c + " more"), (13, ""), (13, None), (None, a), (None, a)], key=str)
    odd = [(r.doc_id, r.text) for r in stage(spark, odd_documents(spark), FOLDER).collect()]
    assert {(3, "one"), (3, "another text of id three")} <= set(odd)
    assert [i for i, _ in odd].count(10) == 1 and 11 not in [i for i, _ in odd]
