import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from conftest import SMALL
from plain import odd_documents
from reportarium.llm import best_position, registry
from reportarium.llm.best_position import ImpactLists, ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(documents, items, k=10):
    """The rules as stated, scoring every document."""
    counted = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in documents]
    holders = Counter(term for _, own in counted for term in own)
    number = sum(1 for _, own in counted if own)
    words = sum(sum(own.values()) for _, own in counted)
    terms = {}
    for item, text in items:
        if item is not None:
            terms.setdefault(item, set()).update(TERM.findall((text or "").translate(LOWER)))
    rows = []
    for item, wanted in terms.items():
        scored = []
        for doc, own in counted:
            score = 0
            for term in wanted & own.keys():
                w = math.floor(1000 * math.log((2 * number + 2) / (2 * holders[term] + 1)))
                m = 100 - 90 + (90 * sum(own.values()) * number) // words
                score += w * ((10**9 * own[term]) // (1000 * own[term] + 8 * m))
            if score > 0 and doc is not None:
                scored.append((-score, doc))
        rows += [(item, r, doc, -s) for r, (s, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(rows)


def found(spark, documents, items, **more):
    documents = spark.createDataFrame(documents, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(items, "item_id long, text string")
    return sorted(tuple(r) for r in ranked_search(documents, items, **more).collect())


def corpus(seed, number=400):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Été", "日本", "x9"]
    weights = [1 / (i + 1) for i in range(len(words))]
    documents = []
    for i in range(number):
        text = " ".join(rnd.choices(words, weights, k=rnd.choice([0, 1, 3, 10, 10, 60])))
        documents.append((i, rnd.choice([text, text.upper(), text.replace(" ", "--")])))
    documents += [(i + number, t) for i, t in documents[:80]]  # ties
    items = [(i, " ".join(rnd.choices(words, k=rnd.randint(1, 8)))) for i in range(25)]
    return documents, items


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_search_equals_scoring_everything(spark, seed):
    documents, items = corpus(seed)
    assert found(spark, documents, items) == plain(documents, items)
    assert found(spark, documents, items, k=3) == plain(documents, items, 3)


def test_queries_of_many_passes(spark, monkeypatch):
    documents, items = corpus(4)
    monkeypatch.setattr(best_position, "BLOCK", 200)
    assert found(spark, documents, items) == plain(documents, items)


def test_query_equals_scoring_everything(spark):
    documents = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    got = registry.op13_best_position(spark, SMALL)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(tuple(r) for r in got.collect()) == plain(documents, items)


def entries(rng, documents, terms, spread):
    held = rng.random((documents, terms)) < 0.7
    at, term = np.nonzero(held)
    return at, term, rng.integers(1, spread, len(at))


@pytest.mark.parametrize("spread", [3, 50, 10**6])
def test_lists_stop_early_and_lose_no_tie(spread):
    rng = np.random.default_rng(spread)
    ids = rng.permutation(2000)
    at, term, impact = entries(rng, 2000, 6, spread)
    for wanted in ([0], [1, 4], [0, 2, 3], [0, 1, 2, 3, 4, 5], [9]):
        wanted = np.array(wanted)
        lists = ImpactLists(ids, at, term, impact)
        totals = np.zeros(2000, dtype=np.int64)
        use = np.isin(term, wanted)
        np.add.at(totals, at[use], impact[use])
        order = np.lexsort((ids, -totals))
        order = order[totals[order] > 0][:10]
        got = lists.best(wanted, 10)
        assert got[0].tolist() == ids[order].tolist() and got[1].tolist() == totals[order].tolist()
        if spread == 10**6 and 0 < len(order) and len(wanted) < 4:
            assert lists.accesses < 0.7 * 2000 * len(wanted)
        if len(order):
            least = int(totals[order[-1]]) + 1
            before, lists.accesses = lists.accesses, 0
            again = lists.best(wanted, 10, least)
            want = [i for i in order if totals[i] >= least]
            assert [i for i, s in zip(*again) if s >= least] == ids[want].tolist()
            assert lists.accesses <= before


def test_best_positions_stop_before_the_last_ones_read():
    """One document that is high in every list marks beginnings beyond what was read."""
    ids = np.arange(100)
    at = np.repeat(ids, 2)
    term = np.tile([0, 1], 100)
    down = 1000 - ids
    impact = np.stack([down, down], axis=1).ravel()
    lists = ImpactLists(ids, at, term, impact)
    got = lists.best(np.array([0, 1]), 3)
    assert got[0].tolist() == [0, 1, 2] and lists.accesses == 2 * best_position.READ


def test_odd_rows(spark):
    documents = odd_documents(spark)
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    items = [(1, "one TEXT"), (1, "words"), (2, None), (3, ""), (None, "one"), (5, "y" * 50_000), (6, "é 日本語")]
    table = spark.createDataFrame([(*i, 7) for i in items], "item_id long, text string, doc_id long")
    got = sorted(tuple(r) for r in ranked_search(documents, table).collect())
    assert got == plain(rows, items) and {r[0] for r in got} == {1, 5, 6}
    assert ranked_search(documents.limit(0), table).collect() == []
    assert ranked_search(documents, table.limit(0)).collect() == []
