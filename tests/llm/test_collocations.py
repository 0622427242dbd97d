import random
import re
from collections import Counter

import numpy as np
import pytest

from plain import odd_documents
from reportarium.llm import collocations
from reportarium.llm.collocations import Tiles, frequent_phrases

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def plain(rows, least, longest=5, top=2000):
    """The rules as stated, on lists of (text, lang)."""
    counts, n = {}, Counter()
    for text, lang in rows:
        own = counts.setdefault(lang or "und", Counter())
        text = (text or "").translate(str.maketrans(UPPER, LOWER))
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for size in range(1, longest + 1):
                own.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    result = []
    for lang, own in counts.items():
        candidates = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        covered = set()
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    if a >= own[p[i : i + size]]:
                        covered.add(p[i : i + size])
        scored = []
        for p, a in candidates.items():
            if p not in covered:
                cuts = [(1000 * a * n[lang] // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                scored.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            result.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(result)


def found(spark, rows, least, **more):
    df = spark.createDataFrame(rows, "text string, lang string")
    return sorted(tuple(r) for r in collocations.collocations(df, least, **more).collect())


def texts(seed, number=150):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["É", "naïve", "B", "b"]
    weights = [1 / (i + 1) for i in range(len(words))]
    phrases = [" ".join(rnd.choices(words, k=rnd.randint(2, 7))) for _ in range(6)]
    rows = []
    for _ in range(number):
        parts = []
        for _ in range(rnd.randint(0, 12)):
            parts.append(rnd.choice(phrases) if rnd.random() < 0.4 else rnd.choices(words, weights)[0])
            parts.append(rnd.choice([" ", " ", "\t", ". ", ",", "\n", " a a a a a a "]))
        rows.append(("".join(parts), rnd.choice(["en", "en", "de", None, "und"])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_phrases_equal_plain_counting(spark, seed):
    rows = texts(seed)
    want = plain(rows, 5)
    assert len({r[0] for r in want}) == 3 and max(len(r[2].split()) for r in want) == 5
    assert found(spark, rows, 5) == want
    assert found(spark, rows, 5, longest=3, top=4) == plain(rows, 5, 3, 4)


def test_items_beyond_the_head_are_counted_by_hash(spark, monkeypatch):
    monkeypatch.setattr(collocations, "HEAD", 7)
    rows = texts(3)
    assert found(spark, rows, 5) == plain(rows, 5)


def test_dense_tiles_and_coordinates_count_alike(monkeypatch):
    rng = np.random.default_rng(5)
    steps = [(rng.zipf(1.3, 60_000) % 70_000, rng.zipf(1.3, 60_000) % 70_000) for _ in range(3)]
    want = Counter(p for x, y in steps for p in zip(x.tolist(), y.tolist()))
    for dense, held in [(100, 2), (4096, 192), (1 << 30, 1)]:
        monkeypatch.setattr(collocations, "DENSE", dense)
        monkeypatch.setattr(collocations, "TILES", held)
        tiles, got = Tiles(), Counter()
        for batch in [*(b for x, y in steps for b in tiles.add(x, y)), *tiles.rest()]:
            for left, right, f in zip(*(c.to_pylist() for c in batch.columns)):
                got[left, right] += f
        assert got == want


def test_odd_texts(spark):
    documents = odd_documents(spark)
    rows = [(r.text, r.lang) for r in documents.collect()]
    got = sorted(tuple(r) for r in collocations.collocations(documents, 3).collect())
    assert got == plain(rows, 3) and got
    assert collocations.collocations(documents.limit(0), 3).collect() == []


def test_products_beyond_64_bits_stay_exact(spark):
    a, n, parts = 7 * 10**12, 3 * 10**13, [(9 * 10**12, 8 * 10**12 + 1), (9 * 10**12, 8 * 10**12)]
    heads, tails = zip(*parts)
    schema = "lang string, phrase string, a long, n long, heads array<long>, tails array<long>"
    df = spark.createDataFrame([("en", "x y z", a, n, list(heads), list(tails))], schema)
    row = collocations.scored(df).first()
    assert row.score == min(1000 * a * n // (x * y) for x, y in parts)
    assert (row.l, row.r) == min(parts, key=lambda p: (1000 * a * n // (p[0] * p[1])))


def test_words_of_a_language_are_counted_once_each(spark):
    df = spark.createDataFrame([("x y " * 40 + ". z", "en")] * 30, "text string, lang string")
    totals, rounds = frequent_phrases(df, 10, 2)
    assert [tuple(r) for r in totals.collect()] == [("en", 81 * 30)]
    assert {r.phrase: r.f for r in rounds[1].collect()} == {"x y": 1200, "y x": 1170}
