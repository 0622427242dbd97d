import hashlib
import math
import random
import re
import string
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SMALL
from plain import odd_documents
from reportarium.llm import registry
from reportarium.llm.secret_scan import (
    ALLOWED,
    entropies,
    find_secrets,
    fixed_spans,
    redact,
    redacted,
    spans_of,
)

ALLOW = [re.compile(a) for a in ALLOWED]


def plain_spans(text):
    """The shapes as they are written, matched first and checked for length after."""
    assign = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [("assign", m) for m in re.finditer(assign, text, re.ASCII) if len(m[2]) >= 8]
    found += [("access", m) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [("hex", m) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(kind, m.start(), m.end()) for kind, m in found]


PIECES = st.lists(
    st.sampled_from(
        ["password", "Token", "API_KEY", "apikey", "secret", "ſecret", "toKen", "=", ":", " ", '"', "'"]
        + ["abcdefg", "12345678", "AKIA", "AKIAABCDEFGHIJKL", "0123456789abcdef", "é", "\n", "."]
    ),
    max_size=14,
).map("".join)


@settings(max_examples=500, deadline=None)
@given(PIECES)
def test_fixed_shapes(text):
    assert fixed_spans(text) == plain_spans(text)
    kept = [s for s in spans_of(text, ALLOW) if s[0] != "entropy"]
    assert sorted(kept) == sorted(plain_spans(text))


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("abcd1"), min_size=1, max_size=40), st.integers(1, 12))
def test_sliding_entropy_equals_entropy_of_each_window(text, window):
    want = []
    for i in range(len(text) - window + 1):
        counts = Counter(text[i : i + window]).values()
        want.append(-sum(n / window * math.log2(n / window) for n in counts))
    assert list(entropies(text, window)) == pytest.approx(want, abs=1e-9)


def kinds(text):
    return [k for k, _, _ in spans_of(text, ALLOW)]


def test_random_strings_are_found_and_the_allow_list_holds():
    assert kinds("key q7Tz1Lr0Xw93KfPb82VnYcMd5Hs ok") == ["entropy"]
    assert kinds("4fA09c3B7e12D586aF0b") == ["entropy"]
    assert kinds("550E8400-e29b-41d4-a716-446655440000") == []
    assert kinds("EXAMPLEq7Tz1Lr0Xw93KfPb82VnYcMd5Hs") == []
    assert kinds("Donaudampfschifffahrtsgesellschaftskapitaen") == []
    assert kinds("gggggggggggggggggggggggg1111111111111111111") == []
    assert kinds("token=q7Tz1Lr0Xw93KfPb82VnYcMd5Hs") == ["assign"]


LETTERS = "qTzLrXwKfPbVnYcMdHsGjZeR"


def test_the_allow_list_takes_out_parts_only():
    for text in (
        "services/t0a1b2c3/9f8e7d6c5b4a3f2e1d0c9b8a",
        "api/v2/k3j9x0q2m7v5t1w8z4r6b2n0",
        "example-q7Tz1Lr0Xw93KfPb82VnYcMd5Hs",
        "q7Tz1Lr0Xw93KfPb82VnYcMd5Hs/sample_data",
        "550e8400-e29b-41d4-a716-446655440000/q7Tz1Lr0Xw93KfPb82VnYcMd5Hs",
        "q7Tz1-Lr0Xw93_KfPb82VnYcMd5Hs",
        LETTERS,
        "keys/" + LETTERS,
    ):
        assert kinds(f"see {text} there") == ["entropy"], text
    [(_, start, end)] = spans_of("services/t0a1b2c3/9f8e7d6c5b4a3f2e1d0c9b8a", ALLOW)
    assert (start, end) == (9, 42)  # both random parts, not the name before them


def test_slugs_and_names_are_no_keys():
    for text in (
        "how-to-build-a-python3-web-scraper",
        "2024-quarterly-budget-forecast-review",
        "max_position_embeddings_2048",
        "how-to-build-a-web-app-3f2a9c81d4e7",
        "services/accounts/2024/quarterly_report_v2",
        "NightlyBuildArtifactsUploaderFactory",
        "2024-03-01/12-30-45/00012345678901234567",
        "550e8400-e29b-41d4-a716-446655440000/readme",
    ):
        assert kinds(f"see {text} there") == [], text


@pytest.mark.parametrize(
    "alphabet, least",
    [(string.ascii_letters + string.digits + "+/", 0.97), (string.ascii_letters + string.digits + "-_", 0.95)]
    + [(string.ascii_letters, 0.94), (string.ascii_lowercase + string.digits, 0.88), ("0123456789abcdef", 0.98)],
)
@pytest.mark.parametrize("before", ["", "services/", "key-example-"])
def test_random_keys_of_24_characters_are_found(alphabet, least, before):
    rnd = random.Random(alphabet)
    keys = ["".join(rnd.choices(alphabet, k=24)) for _ in range(1000)]
    assert sum("entropy" in kinds(before + key) for key in keys) >= least * len(keys)


def test_redaction_joins_overlaps():
    text = "a password=" + "0123456789abcdef" * 3 + " b"
    spans = spans_of(text, ALLOW)
    assert [k for k, _, _ in spans] == ["assign", "hex"]
    assert redacted(text, spans, "#") == "a # b"


def test_query_equals_plain_matching(spark):
    folder, want = SMALL.replace("0.001", "0.01"), []
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        spans = plain_spans(r.text or "")
        order = ["assign", "access", "hex"]
        spans.sort(key=lambda s: (s[1], order.index(s[0])))
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        counts = [sum(s[0] == k for s in spans) for k in order]
        want.append((r.doc_id, *counts, hashlib.sha256(listed.encode()).hexdigest()))
    got = registry.op6_secret_scan(spark, folder)
    rows = got.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256").collect()
    assert sorted(map(tuple, rows)) == sorted(want)
    assert sum(r.n_assign + r.n_access for r in rows) > 0


def test_odd_rows(spark):
    documents = odd_documents(spark)
    found = find_secrets(documents)
    assert found.count() == documents.count()
    assert all(r.spans is not None for r in found.collect())
    clean = redact(documents)
    assert clean.schema == documents.schema
    assert sorted(map(str, clean.collect())) == sorted(map(str, documents.collect()))
    secret = spark.createDataFrame([(1, "x token=abcdefgh1 y", 0)], "doc_id long, text string, n_chars long")
    assert [tuple(r) for r in redact(secret).collect()] == [(1, "x [secret] y", 12)]
    assert find_secrets(documents.limit(0)).collect() == redact(documents.limit(0)).collect() == []
