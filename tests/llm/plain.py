"""Plain statements of the operators' rules, to hold their results against."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

#: Texts that break things: empty, blank, long, odd white space, marks, special-token strings.
ODD_TEXTS = [
    None,
    "",
    "   \n\t ",
    "one",
    "a b c",
    "don't I'LL 's 12345 ½² x1y2",
    "a\x1cb\x85c x y ​ z",
    "é ŠÉ Ως ΑΣ é ﬁ",
    "日本語 テスト<|endoftext|> hi <|startoftext|>",
    "x\n\n\ty\x0bz\x0c!!!???...",
    "same text twice with a few more words",
    "same text twice with a few more words",
    "word " * 30_000,
    "y" * 50_000,
]


def odd_documents(spark):
    """The odd texts with clashing extra columns, a repeated id, a null id and a repeated row."""
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)]
    rows += [(3, "another text of id three"), (None, "no id at all"), (10, ODD_TEXTS[10])]
    rows = [(i, t, "en", "s", None if t is None else len(t), 1, "x", 2.0) for i, t in rows]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, lang string, source string, n_chars long, "
        "part int, ids string, score double",
    )


def word_tokenizer() -> Tokenizer:
    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    return tokenizer


def word_ids(text: str | None, end: int, tokenizer: Tokenizer) -> list[int]:
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def shingles(text: str | None, size: int) -> frozenset:
    words = [w.lower() for w in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())]
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def near_groups(rows: list[tuple[int, str | None]], size: int) -> dict[int, int]:
    """The smallest id reachable from each id, by comparing all pairs that share a shingle."""
    sets = [(i, shingles(t, size)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    holders = defaultdict(list)
    for j, (i, own) in enumerate(sets):
        common = defaultdict(int)
        for s in own:
            for k in holders[s]:
                common[k] += 1
            holders[s].append(j)
        for k, n in common.items():
            if 100 * n >= 80 * (len(own) + len(sets[k][1]) - n):
                a, b = find(i), find(sets[k][0])
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i, _ in rows}
