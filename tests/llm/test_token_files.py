import pyarrow.dataset as ds
import pyarrow.parquet as pq

from conftest import SMALL
from plain import WORDS, crc, odd_documents, word_ids, word_tokenizer
from reportarium.llm import registry
from reportarium.llm.token_files import (
    checksums,
    read_places,
    read_tokens,
    write_token_files,
)


def test_query_equals_plain_encoding(spark):
    tokenizer = word_tokenizer()
    documents = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()
    want, start = [], 0
    for r in documents:
        ids = word_ids(r.text, 1, tokenizer)
        want.append((r.doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    got = registry.op10_token_files(spark, SMALL)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == want


def test_files_hold_documents_in_order_in_the_wanted_encodings(spark, folder):
    write_token_files(spark.read.parquet(f"{SMALL}/documents.parquet"), f"{folder}/t", WORDS)
    files = sorted(f for f in ds.dataset(f"{folder}/t").files)
    ids = [i for f in files for i in pq.read_table(f, columns=["doc_id"])["doc_id"].to_pylist()]
    assert ids == sorted(ids) and len(ids) == 200
    group = pq.ParquetFile(files[0]).metadata.row_group(0)
    columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    assert any("DICTIONARY" in e for e in columns["ids.list.element"].encodings)
    for name in ("doc_id", "shard_start", "n_tokens"):
        assert "DELTA_BINARY_PACKED" in columns[name].encodings
        assert columns[name].has_offset_index and columns[name].has_column_index


def test_selective_reads(spark, folder):
    write_token_files(spark.read.parquet(f"{SMALL}/documents.parquet"), f"{folder}/t", WORDS)
    some = read_tokens(spark, f"{folder}/t", 50, 59)
    assert sorted(r.doc_id for r in some.collect()) == list(range(50, 60))
    assert "PushedFilters: [IsNotNull(doc_id), GreaterThanOrEqual(doc_id,50)" in plan_of(some)
    assert "ids:array" not in plan_of(read_places(spark, f"{folder}/t"))


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_odd_rows(spark, folder):
    tokenizer = word_tokenizer()
    documents = odd_documents(spark)
    write_token_files(documents, f"{folder}/odd", WORDS)
    got = read_tokens(spark, f"{folder}/odd").collect()
    want = sorted(str((r.doc_id, word_ids(r.text, 1, tokenizer))) for r in documents.collect())
    assert sorted(str((r.doc_id, r.ids)) for r in got) == want
    places = read_places(spark, f"{folder}/odd").orderBy("start").collect()
    assert places[0].doc_id is None
    ends = [r.start + r.n_tokens for r in places]
    assert [r.start for r in places] == [0, *ends[:-1]]
    write_token_files(documents.limit(0), f"{folder}/none", WORDS)
    assert read_places(spark, f"{folder}/none").collect() == []
    assert checksums(read_tokens(spark, f"{folder}/none")).collect() == []
