import hashlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SMALL
from plain import RANKS, odd_documents
from reportarium.llm import registry
from reportarium.llm.byte_bpe import decode, encode, encoder, safe_pieces, tokenize

PATTERN = public_tokenizers.PATTERN
OWN = encoder(RANKS, PATTERN)
TEXTS = st.text(st.sampled_from("ab'sST 1²\n\t　 é日!.-"), max_size=60)


@settings(max_examples=400, deadline=None)
@given(TEXTS, st.integers(1, 9))
def test_cutting_changes_no_id(text, long):
    assert "".join(safe_pieces(text, long)) == text
    assert encode(text, OWN, long) == OWN.encode_ordinary(text)


def test_long_texts(spark):
    for text in ("word " * 40_000, "y" * 150_000, "a1" * 80_000, " \n" * 70_000 + "x"):
        assert encode(text, OWN) == OWN.encode_ordinary(text)
        assert OWN.decode_bytes(encode(text, OWN)) == text.encode()


def test_query_equals_the_library(spark):
    def digest(raw):
        return hashlib.sha256(raw).hexdigest()

    want = []
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        ids = OWN.encode_ordinary(r.text or "")
        raw = np.array(ids, dtype="<u4").tobytes()
        want.append((r.doc_id, len(ids), digest(raw), digest((r.text or "").encode())))
    got = registry.op8_byte_bpe(spark, SMALL)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_odd_rows_round_trip(spark):
    documents = odd_documents(spark)
    tokens = tokenize(documents, RANKS, PATTERN, ("ids", "n_tokens", "decoded"))
    want = sorted(str((r.doc_id, (r.text or "").encode())) for r in documents.collect())
    got = tokens.collect()
    assert sorted(str((r.doc_id, bytes(r.decoded))) for r in got) == want
    assert all(r.n_tokens == len(r.ids) for r in got)
    again = decode(tokens, RANKS, PATTERN).collect()
    assert sorted(str((r.doc_id, bytes(r.decoded))) for r in again) == want
    assert tokenize(documents.limit(0), RANKS, PATTERN).collect() == []
