"""Byte-level BPE of whole texts with the tiktoken library and a local file of ranks.

Long texts are cut where the pre-split pattern always ends a match: between a character and
white space after it, or after a letter or digit that is followed by another kind of
character. No match crosses such a place and none looks back, so the ids are those of the
whole text. Decoding joins the raw bytes of the ids.

Null text: as empty, no ids. Empty table: no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from reportarium.llm.common import steps

#: Texts beyond this many characters are cut.
LONG = 1 << 16
SAFE = regex.compile(r"(?<=\S)(?=\s)|(?<=\p{L})(?=[^\s\p{L}])|(?<=\p{N})(?=[^\s\p{N}])")

_ENCODERS: dict[tuple[str, str], tiktoken.Encoding] = {}


def encoder(ranks: str, pattern: str) -> tiktoken.Encoding:
    """One per Python worker, from a file with a base64 token and its rank per line."""
    if (ranks, pattern) not in _ENCODERS:
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _ENCODERS[ranks, pattern] = tiktoken.Encoding(
            "local", pat_str=pattern, mergeable_ranks=table, special_tokens={}
        )
    return _ENCODERS[ranks, pattern]


def safe_pieces(text: str, long: int = LONG) -> Iterator[str]:
    """The text in pieces of about ``long`` characters, cut at safe places only."""
    start = 0
    while len(text) - start > long:
        place = SAFE.search(text, start + long)
        if place is None:
            break
        yield text[start : place.start()]
        start = place.start()
    yield text[start:]


def encode(text: str, own: tiktoken.Encoding, long: int = LONG) -> list[int]:
    if len(text) <= long:
        return own.encode_ordinary(text)
    return [i for piece in safe_pieces(text, long) for i in own.encode_ordinary(piece)]


#: What ``tokenize`` can add to a document id.
OUTPUTS = {
    "ids": T.ArrayType(T.IntegerType()),
    "n_tokens": T.LongType(),
    "ids_sha256": T.StringType(),
    "decoded": T.BinaryType(),
    "decoded_sha256": T.StringType(),
}


def tokenize(
    documents: DataFrame, ranks: str, pattern: str, outputs: tuple[str, ...] = ("ids",)
) -> DataFrame:
    """doc_id and the chosen outputs; decoded ones come from the ids, not from the text."""
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType())] + [T.StructField(o, OUTPUTS[o]) for o in outputs]
    )
    arrow = to_arrow_schema(schema)
    decoding = any(o.startswith("decoded") for o in outputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(ranks, pattern)
        for batch in steps(batches):
            rows = {name: [] for name in schema.names}
            rows["doc_id"] = batch.column("doc_id")
            for text in batch.column("text").to_pylist():
                ids = encode(text, own)
                decoded = own.decode_bytes(ids) if decoding else b""
                for name in outputs:
                    if name == "ids":
                        value = ids
                    elif name == "n_tokens":
                        value = len(ids)
                    elif name == "ids_sha256":
                        value = hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
                    elif name == "decoded":
                        value = decoded
                    else:
                        value = hashlib.sha256(decoded).hexdigest()
                    rows[name].append(value)
            yield pa.RecordBatch.from_pydict(rows, schema=arrow)

    return documents.select("doc_id", "text").mapInArrow(run, schema)


def decode(tokens: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id and the raw bytes of a column ``ids``; null ids give no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(ranks, pattern)
        for batch in batches:
            raw = [own.decode_bytes(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(raw, pa.binary())], names=["doc_id", "decoded"]
            )

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")
