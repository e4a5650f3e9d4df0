"""Near-duplicate documents by SimHash and covering locality-sensitive hashing.

A document's fingerprint has a bit set where over half of its shingle hashes have it. Two
fingerprints are linked when at most ``radius`` bits differ. Covering hashing finds every such
pair: each bit position gets a vector of ``radius + 1`` bits, and each non-zero vector v makes a
mask of the positions whose vector has an odd product with v. At most ``radius`` differing
positions span too few dimensions to meet every v, so some mask misses all of them, and the two
fingerprints agree there.

Copies of a fingerprint are folded before anything is paired. A bucket is compared in blocks
inside a task and yields a spanning forest, never all its pairs. A bucket above ``most`` is not
compared: its members are masked again by further families, of which each again covers every
linked pair, until a few bits are free and two to their number bounds the bucket.

Null, empty and wordless texts have fingerprint zero. Repeated rows keep their rows. A null id
is carried along, and its component takes the smallest id that is not null. Columns of the
input other than the id and the text are not looked at. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casepulse.llm.components import components
from casepulse.llm.store import cut
from casepulse.llm.words import sums

RADIUS = 4
SHINGLE = 4
#: Largest bucket that one task compares.
MOST = 4096
LEVELS = 4
#: Rows of two numbers up to which they are sent to all tasks.
SENT = 300_000


def shingle_hashes(text: bytes, size: int) -> list[int]:
    """XXH64 with seed 42 of each run of ``size`` lower-cased words joined by single spaces."""
    words = text.lower().split()
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(b" ".join(words), 42)] if words else []
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate([[0], ends[: len(words) - size] + 1])
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], 42) for a, b in zip(begins.tolist(), ends[size - 1 :].tolist(), strict=True)]


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _majority(hashes: list[list[int]]) -> np.ndarray:
    """A fingerprint for each list of hashes."""
    first = np.cumsum([0, *map(len, hashes)])
    flat = np.fromiter((h for each in hashes for h in each), np.uint64, first[-1])
    bits = np.unpackbits(flat.view(np.uint8), bitorder="little").reshape(-1, 64)
    ones = np.zeros((len(hashes), 64), np.int64)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        ones[full] = np.add.reduceat(bits, first[:-1][full], axis=0, dtype=np.int64)
    over = 2 * ones > np.diff(first)[:, None]
    return np.packbits(over, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id`` and ``fp``, the 64 bits as a signed BIGINT, a row for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, held, size = [], [], 0
            for value in batch.column(1):
                raw = value.as_buffer().to_pybytes() if value.is_valid else b""
                held.append(shingle_hashes(raw, shingle))
                size += len(held[-1])
                if size > 200_000:
                    out.append(_majority(held))
                    held, size = [], 0
            out.append(_majority(held))
            yield pa.record_batch([batch.column(0), _signed(np.concatenate(out))], ["doc_id", "fp"])

    kind = docs.schema[doc_id].dataType.simpleString()
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return chosen.mapInArrow(run, f"doc_id {kind}, fp bigint")


def masks(radius: int = RADIUS, turn: int = 0) -> list[int]:
    """The covering masks of 64 bits as signed numbers; ``turn`` deals the vectors differently."""
    vectors = (1 << (radius + 1)) - 1
    order = np.random.default_rng(turn).permutation(64) if turn else np.arange(64)
    out = []
    for v in range(1, vectors + 1):
        mask = sum(1 << i for i in range(64) if ((int(order[i]) % vectors + 1) & v).bit_count() % 2)
        out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def forest(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that connect what the links of at most ``radius`` bits connect, one fewer than members at most."""
    component = np.arange(len(values))
    links = []
    for i in range(len(values) - 1):
        near = i + 1 + np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= radius)
        apart = near[component[near] != component[i]]
        if len(apart):
            others, first = np.unique(component[apart], return_index=True)
            links += [(i, int(j)) for j in apart[first]]
            component[np.isin(component, others)] = component[i]
    return links


def _linked(buckets: DataFrame, radius: int) -> DataFrame:
    """Links within each row's array of members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            for members in batch.column(0):
                values = np.sort(np.asarray(members.values.to_numpy(zero_copy_only=False), np.int64))
                for i, j in forest(values.view(np.uint64), radius):
                    left.append(int(values[i]))
                    right.append(int(values[j]))
            yield pa.record_batch([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return buckets.mapInArrow(run, "a bigint, b bigint")


def links(prints: DataFrame, radius: int = RADIUS, most: int = MOST) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints ``fp`` that join every pair within ``radius``.

    Buckets of two need no second look: their least and greatest member are the pair.
    """
    found = None
    members = prints.select("fp", F.lit(0).cast("bigint").alias("mask"))
    for level in range(LEVELS):
        keys = F.explode(F.array(*(F.lit(m) for m in masks(radius, level))))
        # A bucket agrees on every position that one of the masks on the way to it keeps.
        masked = members.select("fp", "mask", keys.alias("key"))
        masked = masked.select("fp", F.col("mask").bitwiseOR(F.col("key")).alias("mask"))
        keyed = masked.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("part"), "fp")
        if level:  # two ways to the same mask are one bucket
            keyed = keyed.distinct()
        sizes = cut(
            keyed.groupBy("mask", "part")
            .agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
            .where("n > 1")
        )
        pairs = sizes.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).where("n = 2").select("a", "b")
        last = level == LEVELS - 1
        middle = sizes.where("n > 2" if last else f"n > 2 and n <= {most}").select("mask", "part")
        groups = keyed.join(middle, ["mask", "part"]).groupBy("mask", "part").agg(F.collect_list("fp").alias("fps"))
        both = pairs.unionByName(_linked(groups.select("fps"), radius))
        found = both if found is None else found.unionByName(both)
        large = sizes.where(f"n > {most}").select("mask", "part")
        if last or large.isEmpty():
            break
        members = cut(keyed.join(large, ["mask", "part"]).select("fp", "mask"))
    return found.distinct()


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    radius: int = RADIUS,
    shingle: int = SHINGLE,
    most: int = MOST,
) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id``, the smallest id that links reach, a row for each row."""
    prints = cut(fingerprints(docs, doc_id, text, shingle))
    distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    labels = components(cut(links(distinct, radius, most)))
    # Most prints are linked to none and their own component; of the others a task adds up its minima first.
    linked = cut(labels.select(F.col("node").alias("fp"), "label").join(distinct, "fp"))
    smallest = linked.groupBy("label").agg(F.min("least").alias("component_id"))
    of_linked = linked.join(_sent(smallest), "label").select("fp", "component_id")
    of_print = distinct.join(of_linked, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    return prints.join(_sent(cut(of_print)), "fp").select("doc_id", "fp", "component_id")


def _sent(rows: DataFrame) -> DataFrame:
    """The rows, marked to be sent to all tasks where they are few: then no task gets all rows of one key."""
    return F.broadcast(rows) if rows.count() <= SENT else rows
