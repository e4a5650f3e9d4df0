"""Packing by powers of two: no sequence crosses documents and none needs padding.

A document of n tokens is cut into as many pieces of the full length as fit and then into the
binary digits of the rest, longest first. Every piece has a power of two as its length and is a
sequence of its own, so pieces of one length form a bucket of equally long sequences that a
training step takes as they are. No document meets another, so nothing is shuffled.

Null and empty texts hold the end token alone: one piece of length 1. Repeated rows are packed
each for itself, a null id is carried along, and columns other than the id and the text are not
looked at. Empty tables give empty results. Strings that look like special tokens are ordinary
text.
"""

from __future__ import annotations

import json
import re
import sys
from array import array
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEQUENCE = 2048
END = 1
#: Bytes of ids in one batch that goes back to Spark.
BATCH_BYTES = 4 << 20


def piece_lengths(tokens: int, most: int = SEQUENCE) -> list[int]:
    """Powers of two of at most ``most``, itself one, longest first."""
    full, rest = divmod(tokens, most)
    return [most] * full + [1 << k for k in range(most.bit_length() - 1, -1, -1) if rest >> k & 1]


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit numbers, by a byte-level tokenizer file.

    Texts of ASCII, the Latin blocks and common punctuation are merged by ``tiktoken`` from the
    same file, which gives the same ids several times faster; all others are left to
    ``tokenizers``.
    """

    PLAIN = re.compile(r"[\t\n\r -~\u00A1-\u017F\u2010-\u2027\u20AC]*")
    # Fixed value: the published pattern by which byte-level tokenizers cut text before merging.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str) -> None:
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        special = {token["id"] for token in held.get("added_tokens") or []}
        # Printable characters stand for their own bytes, the next code points for the others.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = (b for b in range(256) if b not in plain)
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
        ranks = {bytes(map(byte_of.__getitem__, t)): i for t, i in held["model"]["vocab"].items() if i not in special}
        self.merge = tiktoken.Encoding("file", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def tokenizer(self):
        """Read when a text first needs it: it takes more memory than the merges."""
        from tokenizers import Tokenizer

        found = Tokenizer.from_file(self.path)
        found.encode_special_tokens = True
        return found

    def encode(self, text: str) -> bytes:
        if self.PLAIN.fullmatch(text):
            ids = self.merge.encode_ordinary(text)
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        numbers = array("I", ids)
        if sys.byteorder == "big":
            numbers.byteswap()
        return numbers.tobytes()


@lru_cache(1)
def _encoder(path: str) -> Encoder:
    """One for each Python worker, kept over its tasks."""
    return Encoder(path)


def pack(
    docs: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    sequence: int = SEQUENCE,
    end: int = END,
) -> DataFrame:
    """A row for each piece: ``doc_id``, ``start``, ``length``, ``ids``, ``doc_tokens``, ``sequence_id``, ``offset``.

    ``ids`` holds little-endian unsigned 32-bit token ids; ``tokenizer`` is the path of a
    tokenizer file that every executor can open.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    closing = np.asarray([end], "<u4").tobytes()
    names = ["doc_id", "start", "length", "ids", "doc_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            size = 0
            for i, value in enumerate(batch.column(1)):
                ids = encoder.encode(value.as_py() or "") + closing
                start, total = 0, len(ids) // 4
                for length in piece_lengths(total, sequence):
                    for kept, x in zip(rows, (i, start, length, ids[4 * start : 4 * (start + length)], total), strict=True):
                        kept.append(x)
                    start += length
                    size += 4 * length
                    if size > BATCH_BYTES:
                        yield made(batch, rows)
                        rows, size = [[], [], [], [], []], 0
            yield made(batch, rows)

    def made(batch: pa.RecordBatch, rows: list[list]) -> pa.RecordBatch:
        at, start, length, ids, total = rows
        wide = [pa.array(x, pa.int64()) for x in (start, length, total)]
        column = batch.column(0).take(pa.array(at, pa.int64()))
        return pa.record_batch([column, wide[0], wide[1], pa.array(ids, pa.binary()), wide[2]], names)

    pieces = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint"
    )
    return pieces.select(
        *names, F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
