"""Importance resampling of documents towards a target by hashed word runs.

Every run of one to three words falls into one of ``buckets`` by the CRC-32 of its bytes. Buckets
are counted over all documents and over the target; the scaled logarithm of the smoothed ratio of
their shares is a bucket's gain, and a document's weight is the sum over its runs. With Gumbel
noise that depends on its id alone the weight becomes a score, and the highest scores are a draw
without replacement in proportion to the weights. Scores are ranked by :mod:`radix`.

CRC-32 is linear over the bits, so the CRC of a run comes from those of its words by table
look-ups on arrays: only each word is hashed on its own. Words are lower-cased in ASCII and parted
at every ASCII character that is neither letter nor digit.

Null, empty and wordless texts have no runs and weight zero. A null id is hashed as an empty one
and loses ties. Repeated rows keep their rows; of equal scores and ids the first in the table
ranks first. Other columns are not looked at. Empty tables give empty results.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casepulse.llm.radix import ranked
from casepulse.llm.store import cut
from casepulse.llm.words import LOWER, PUNCTUATED, slices, sums

RUNS, BUCKETS, SCALE = 3, 10_000, 1000
#: Words of the shortest document that can be drawn, the share drawn in percent, and the seed of the noise.
LEAST_WORDS, PERCENT, SEED = 20, 5, 42

_SPACED = bytes(np.where(PUNCTUATED[LOWER], 32, LOWER).astype(np.uint8))
_NEAR = 64


@lru_cache(None)
def _steps() -> tuple[np.ndarray, np.ndarray]:
    """What each byte of a CRC becomes after n zero bytes, for n up to ``_NEAR`` and for powers of two."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    at = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).ravel()
    near = [at]
    for _ in range(_NEAR):
        near.append(table[near[-1] & 255] ^ (near[-1] >> 8))
    powers = [near[1]]
    for _ in range(40):
        powers.append(_through(powers[-1], powers[-1], np.zeros(len(at), np.int64)))
    return np.stack(near).ravel(), np.stack(powers)


def _through(table: np.ndarray, crc: np.ndarray, base: np.ndarray) -> np.ndarray:
    out = table[base + (crc & 255)]
    for k in range(1, 4):
        out = out ^ table[base + 256 * k + ((crc >> (8 * k)) & 255)]
    return out


def followed(crc: np.ndarray, lengths: np.ndarray, more: np.ndarray) -> np.ndarray:
    """CRC-32 of strings of which the first parts have ``crc`` and the rest, of such ``lengths``, ``more``."""
    near, powers = _steps()
    out = _through(near, crc, np.minimum(lengths, _NEAR) * 1024)
    far = np.flatnonzero(lengths > _NEAR)
    if len(far):
        rest, moved = lengths[far] - _NEAR, out[far]
        for bit in range(int(rest.max()).bit_length()):
            has = np.flatnonzero((rest >> bit) & 1)
            moved[has] = _through(powers[bit], moved[has], np.zeros(len(has), np.int64))
        out[far] = moved
    return out ^ more


def run_hashes(data: np.ndarray, edges: np.ndarray, longest: int = RUNS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """CRC-32 of all runs of up to ``longest`` words, the row of each, and the number of words of each row."""
    rows = [data[a:b].tobytes().translate(_SPACED).split() for a, b in zip(edges[:-1], edges[1:], strict=True)]
    counts = np.fromiter(map(len, rows), np.int64, len(rows))
    words = [word for row in rows for word in row]
    crc = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    spaced = followed(np.full(len(words), zlib.crc32(b" "), np.uint32), lengths - 1, crc)
    row = np.repeat(np.arange(len(rows)), counts)
    hashes, of, last = [crc], [row], crc
    for size in range(2, longest + 1):
        last = followed(last[: len(words) - size + 1], lengths[size - 1 :], spaced[size - 1 :])
        inside = row[: len(words) - size + 1] == row[size - 1 :]
        hashes.append(last[inside])
        of.append(row[size - 1 :][inside])
    return np.concatenate(hashes), np.concatenate(of), counts


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """``bucket`` and ``n``, its number of runs in all texts, for buckets that have any; each task adds up its own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, data, edges in slices(batch.column(0)):
                total += np.bincount(run_hashes(data, edges)[0] % np.uint32(buckets), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "n"])

    return docs.select(text).mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text: str = "text", buckets: int = BUCKETS, scale: int = SCALE) -> np.ndarray:
    """The gain of each bucket; what reaches the driver is a number for each bucket."""
    counted = []
    for frame in (docs, target):
        n = np.zeros(buckets)
        for row in bucket_counts(frame, text, buckets).collect():
            n[row.bucket] = row.n
        counted.append(n)
    s, t = counted
    return np.floor(scale * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weights(docs: DataFrame, gain: np.ndarray, *carried: str, text: str = "text") -> DataFrame:
    """The ``carried`` columns, ``n_words``, ``n_features`` and ``weight`` of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            for at, data, edges in slices(batch.column(0)):
                hashes, row, counts = run_hashes(data, edges)
                order = np.argsort(row, kind="stable")
                first = np.searchsorted(row[order], np.arange(len(edges)))
                weight = sums(gain[hashes % np.uint32(len(gain))][order], first)
                kept = [batch.column(i + 1).slice(at, len(edges) - 1) for i in range(len(carried))]
                yield pa.record_batch(
                    [*kept, pa.array(counts), pa.array(np.diff(first)), pa.array(weight)],
                    [*carried, "n_words", "n_features", "weight"],
                )

    types = "".join(f"{c} {docs.schema[c].dataType.simpleString()}, " for c in carried)
    return docs.select(text, *carried).mapInArrow(run, types + "n_words bigint, n_features bigint, weight bigint")


def noise(doc_id: Column, seed: int = SEED, scale: int = SCALE) -> Column:
    """Scaled Gumbel noise from the SHA-256 of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.floor(F.lit(-float(scale)) * F.log(-F.log((number + F.lit(0.5)) / F.lit(4294967296.0))))


def resample(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank``, null where not drawn, a row for each row.

    Of the documents of at least ``least_words`` words, ``percent`` of a hundred are drawn, rounded down.
    """
    chosen = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    weighed = weights(chosen, gains(chosen, target.select(F.col(text).alias("text"))), "doc_id")
    scored = weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = cut(scored.withColumn("row", F.monotonically_increasing_id()))
    able = scored.where(F.col("n_words") >= least_words)
    drawn = percent * able.count() // 100
    ranks = ranked(able, "row", [("score", False), ("doc_id", True)]).where(F.col("rank") <= drawn)
    return scored.join(ranks, "row", "left").select("doc_id", "n_features", "weight", "score", "rank")
