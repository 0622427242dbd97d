"""Token ids of whole texts by the word vocabulary, one look-up per different word.

The vocabulary's tokenizer drops white space and never looks across it, so a text's ids are
those of its words one after the other. Each task finds the different words of a step of
texts, splits them as the vocabulary does, and asks the tokenizers library for the parts it
has not met; a bounded table keeps the others. Words beyond plain Latin letters, digits and
ASCII signs go to the library whole.
Strings of special tokens in a text are ordinary text.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

# Spark runs a task per core; threads of the library's own only add memory.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: The vocabulary's own pre-split pattern for lower-case Latin words.
PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+|\n")
OTHER = re.compile(r"[^!-~À-ÖØ-öø-ÿ\n]").search
#: Parts of words that one worker keeps at most.
KEPT_PARTS = 200_000


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write each byte as a printable letter; others count up from 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Ragged:
    """Rows of ids one after the other, appended in bulk."""

    def __init__(self, kind: type):
        self.ids, self.bounds, self.rows = np.zeros(0, dtype=kind), np.zeros(1, dtype=np.int64), 0
        self.used = 0

    def extend(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        rows, used = self.rows + len(lengths), self.used + len(ids)
        if rows >= len(self.bounds):
            self.bounds = np.concatenate([self.bounds, np.zeros(rows, dtype=np.int64)])
        if used > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(used, dtype=self.ids.dtype)])
        self.bounds[self.rows + 1 : rows + 1] = self.used + np.cumsum(lengths)
        self.ids[self.used : used] = ids
        self.rows, self.used = rows, used

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the rows, and their lengths."""
        starts = self.bounds[rows]
        lengths = self.bounds[rows + 1] - starts
        ends = np.cumsum(lengths)
        places = np.repeat(starts - (ends - lengths), lengths)
        places += np.arange(len(places))
        return self.ids[places], lengths


class WordIds:
    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        self.parts = Tokenizer(self.whole.model)
        self.parts.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.whole.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.kind = np.uint16 if len(self.ends) <= 1 << 16 else np.uint32
        self.letters = _byte_letters()
        self.forget()

    def forget(self) -> None:
        """Row 0 of the known parts is empty: it stands for a word's end."""
        self.slots: dict[str, int] = {"\n": 0}
        self.known = Ragged(self.kind)
        self.known.extend(np.zeros(0, dtype=self.kind), np.zeros(1, dtype=np.int64))

    def _learn(self, parts: list[str]) -> None:
        spelled = [
            p if p.isascii() else p.encode().decode("latin-1").translate(self.letters)
            for p in parts
        ]
        lines = [" ".join(spelled[i : i + 1000]) for i in range(0, len(spelled), 1000)]
        found = self.parts.encode_batch_fast(lines, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, dtype=self.kind) for e in found])
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(parts):  # a vocabulary without a mark at each word's end
            rows = [self.parts.encode(s, add_special_tokens=False).ids for s in spelled]
            ids = np.array([i for row in rows for i in row], dtype=self.kind)
            stops = np.cumsum([len(row) for row in rows])
        self.known.extend(ids, np.diff(stops, prepend=0))
        self.slots.update(zip(parts, range(len(self.slots), len(self.slots) + len(parts))))

    def _words(self, words: pa.Array) -> Ragged:
        """The ids of different words, in their order."""
        text = pc.binary_join(
            pa.ListArray.from_arrays([0, len(words)], words.cast(pa.string())), "\n"
        )[0].as_py()
        whole: dict[int, list[int]] = {}
        if OTHER(text):
            lines = text.split("\n")
            rare = [i for i, word in enumerate(lines) if OTHER(word)]
            found = self.whole.encode_batch_fast([lines[i] for i in rare], add_special_tokens=False)
            for i, e in zip(rare, found, strict=True):
                whole[i], lines[i] = e.ids, ""
            text = "\n".join(lines)
        flat = PARTS.findall(text.lower() + "\n")
        if len(self.slots) > KEPT_PARTS:
            self.forget()
        new = set(flat).difference(self.slots)
        if new:
            self._learn(list(new))
        slots = np.fromiter(map(self.slots.__getitem__, flat), dtype=np.int64, count=len(flat))
        ids, lengths = self.known.take(slots)
        ends = np.cumsum(lengths)[slots == 0]
        result = Ragged(self.kind)
        if not whole:
            result.extend(ids, np.diff(ends, prepend=0))
            return result
        rows = np.split(ids, ends[:-1])
        for i, own in whole.items():
            rows[i] = np.array(own, dtype=self.kind)
        result.extend(np.concatenate(rows), np.array([len(row) for row in rows]))
        return result

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where each text's ids start and end, and the ids of all texts."""
        split = pc.ascii_split_whitespace(texts)
        flat = split.flatten().dictionary_encode()
        if not len(flat):
            return np.zeros(len(texts) + 1, dtype=np.int64), np.zeros(0, dtype=self.kind)
        ids, lengths = self._words(flat.dictionary).take(flat.indices.to_numpy())
        word_ends = np.cumsum(pc.list_value_length(split).to_numpy())
        text_ends = np.concatenate([[0], np.cumsum(lengths)])[word_ends]
        return np.concatenate([[0], text_ends]), ids


_WORKERS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One per Python worker, kept between its tasks."""
    if path not in _WORKERS:
        _WORKERS[path] = WordIds(path)
    return _WORKERS[path]
