"""Benchmark decontamination by winnowing.

Of the hashes of all k-grams the least in each window of ``WINDOW - k + 1`` is kept, on both
sides and by the same rule, so any ``WINDOW`` words that a document shares with an item leave a
common fingerprint. Kept hashes that meet are extended: only the windows that contain the
shared k-gram are compared, word by word. Items of fewer than ``WINDOW`` words are one window;
for each such length n the fingerprint is the n-gram itself, a winnowing of window one.

A benchmark of at most ``broadcast_words`` words is sent to the executors. A larger one is
joined: fingerprints to fingerprints first, then the windows around the hits to its windows.

Null and empty texts have no words. Rows of the benchmark without an id mark words as hit, but
are not listed. Repeated documents keep their rows; items of equal id count once. Columns other
than id and text are not looked at. Empty tables give empty results or documents without hits.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casepulse.llm.words import PUNCTUATED, Words, find, grams, hashes, slices, split

WINDOW = 13
GRAM = 8
#: Words of a benchmark that every executor may hold.
BROADCAST_WORDS = 2_000_000
NO_HASH = np.uint64(2**64 - 1)


def winnow(words: Words, values: np.ndarray, k: int, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the kept k-grams: whatever is least in some window, ties included."""
    n = len(values)
    row = words.rows
    hashed = np.full(n, NO_HASH)
    whole = grams(values, k)
    same = row[k - 1 :] == row[: max(0, n - k + 1)]
    hashed[: len(whole)] = np.where(same, whole, NO_HASH)
    span = max(1, window - k + 1)
    least = hashed.copy()
    for j in range(1, min(span, n)):
        least[:-j] = np.minimum(least[:-j], np.where(row[j:] == row[:-j], hashed[j:], NO_HASH))
    kept = np.zeros(n, bool)
    for j in range(min(span, n)):
        kept[j:] |= (hashed[j:] == least[: n - j]) & (row[j:] == row[: n - j])
    kept &= hashed != NO_HASH
    places = np.flatnonzero(kept)
    return places, hashed[places]


class Benchmark:
    """The windows of all items, and the fingerprints that lead to them."""

    def __init__(self, items: Iterable[tuple[object, str | None]], window: int = WINDOW, gram: int = GRAM) -> None:
        self.window, self.gram = window, gram
        self.items: dict[bytes, set[str | None]] = defaultdict(set)
        lengths: dict[int, list[np.ndarray]] = defaultdict(list)
        for item, text in items:
            raw = np.frombuffer((text or "").encode(), np.uint8)
            words = split(raw, np.asarray([0, len(raw)]), PUNCTUATED)
            n = len(words.starts)
            if not n:
                continue
            size = min(n, window)
            for i in range(n - size + 1):
                self.items[key(words, i, size)].add(None if item is None else str(item))
            lengths[size].append(winnow(words, hashes(words), self.k(size), size)[1])
        self.prints = {size: np.unique(np.concatenate(x)) for size, x in sorted(lengths.items())}

    def k(self, size: int) -> int:
        return self.gram if size == self.window else size

    def hits(self, words: Words) -> Iterator[tuple[int, int, bytes]]:
        """First word, number of words and text of each window that may be one of the benchmark's."""
        values = hashes(words)
        for size, prints in self.prints.items():
            k = self.k(size)
            if k > len(values):
                continue
            places, kept = winnow(words, values, k, size)
            for first in around(words, places[find(prints, kept) >= 0], size, k):
                yield first, size, key(words, first, size)


def around(words: Words, places: np.ndarray, size: int, k: int) -> list[int]:
    """First words of the windows of ``size`` words that contain a k-gram at one of the places."""
    if not len(places):
        return []
    firsts = np.unique((places[:, None] - np.arange(size - k + 1)[None, :]).ravel())
    firsts = firsts[(firsts >= 0) & (firsts + size <= len(words.starts))]
    row = words.rows
    return firsts[row[firsts] == row[firsts + size - 1]].tolist()


def key(words: Words, first: int, size: int) -> bytes:
    """The words themselves, joined by a space that no word holds."""
    return b" ".join(words.word(i) for i in range(first, first + size))


SCHEMA = "n_words bigint, n_hit bigint, items array<string>"


def _row_results(words: Words, hits: Iterable[tuple[int, int, Iterable[str | None]]]) -> tuple[list, list, list]:
    """Words, hit words and items of each row; hits: first word, length and items of each window found."""
    hit = np.zeros(len(words.starts), bool)
    items: dict[int, set] = defaultdict(set)
    row = words.rows
    for first, size, ids in hits:
        hit[first : first + size] = True
        items[int(row[first])].update(ids)
    counts = words.counts()
    n_hit = np.bincount(row[hit], minlength=len(counts)) if len(counts) else counts
    listed = [sorted(x for x in items[i] if x is not None) if i in items else [] for i in range(len(counts))]
    return counts.tolist(), n_hit.tolist(), listed


def _by_broadcast(docs: DataFrame, benchmark: Benchmark, kind: str, field: str | None = None) -> DataFrame:
    """Results by ``doc_id``; texts are its field ``field``, if given, so that they go through once."""
    shared = docs.sparkSession.sparkContext.broadcast(benchmark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            for _, data, edges in slices(batch.column(0).field(field) if field else batch.column(1)):
                words = split(data, edges, PUNCTUATED)
                found = ((i, n, held.items[text]) for i, n, text in held.hits(words) if text in held.items)
                for kept, more in zip(out, _row_results(words, found), strict=True):
                    kept.extend(more)
            counts = [pa.array(x, pa.int64()) for x in out[:2]]
            yield pa.record_batch(
                [batch.column(0), *counts, pa.array(out[2], pa.list_(pa.string()))],
                ["doc_id", "n_words", "n_hit", "items"],
            )

    return (docs.select("doc_id") if field else docs).mapInArrow(run, f"doc_id {kind}, {SCHEMA}")


def _prints(frame: DataFrame, sizes: list[int], window: int, gram: int) -> DataFrame:
    """``id``, ``size``, ``place``, ``print`` of the fingerprints of each text for windows of each size."""
    kind = frame.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, edges in slices(batch.column(1)):
                words = split(data, edges, PUNCTUATED)
                values, row = hashes(words), words.rows
                for size in sizes:
                    k = gram if size == window else size
                    if k > len(values):
                        continue
                    places, kept = winnow(words, values, k, size)
                    of = row[places]
                    yield pa.record_batch(
                        [
                            batch.column(0).take(pa.array(at + of)),
                            pa.array(np.full(len(places), size, np.int64)),
                            pa.array(places - words.first[of]),
                            pa.array(kept.view(np.int64)),
                        ],
                        ["id", "size", "place", "print"],
                    )

    return frame.mapInArrow(run, f"id {kind}, size bigint, place bigint, print bigint")


def _windows(frame: DataFrame, window: int, gram: int) -> DataFrame:
    """``id``, ``first``, ``size``, ``words`` of the windows around the ``hits`` of each text, or of an item's all."""
    kind = frame.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                raw = np.frombuffer((batch.column(1)[i].as_py() or "").encode(), np.uint8)
                words = split(raw, np.asarray([0, len(raw)]), PUNCTUATED)
                n = len(words.starts)
                wanted: list[tuple[int, int]] = []
                hits = batch.column(2)[i].as_py()
                if hits is None:
                    size = min(n, window)
                    wanted = [(first, size) for first in range(n - size + 1)] if n else []
                else:
                    by_size = defaultdict(list)
                    for hit in hits:
                        by_size[hit["size"]].append(hit["place"])
                    for size, places in by_size.items():
                        k = gram if size == window else size
                        wanted += [(first, size) for first in around(words, np.asarray(places), size, k)]
                column = batch.column(0).take(pa.array(np.full(len(wanted), i)))
                firsts, sizes = (pa.array([w[j] for w in wanted], pa.int64()) for j in (0, 1))
                texts = pa.array([key(words, *w).decode() for w in wanted], pa.string())
                yield pa.record_batch([column, firsts, sizes, texts], ["id", "first", "size", "words"])

    return frame.mapInArrow(run, f"id {kind}, first bigint, size bigint, words string")


def _by_join(docs: DataFrame, items: DataFrame, sizes: list[int], window: int, gram: int) -> DataFrame:
    """The same through joins, for a benchmark of any size. Equal texts are compared once."""
    texts = docs.select(F.sha2("text", 256).alias("id"), "text").where("id is not null").groupBy("id").agg(F.first("text").alias("text"))
    bench = items.select(F.col("item_id").cast("string").alias("id"), "text")
    of_bench = _prints(bench, sizes, window, gram).select("size", "print").distinct()
    met = _prints(texts, sizes, window, gram).join(of_bench, ["size", "print"], "left_semi")
    hits = met.groupBy("id").agg(F.collect_list(F.struct("size", "place")).alias("hits"))
    near = _windows(texts.join(hits, "id").select("id", "text", "hits"), window, gram)
    no_hits = F.lit(None).cast("array<struct<size:bigint,place:bigint>>").alias("hits")
    all_windows = _windows(bench.select("id", "text", no_hits), window, gram)
    # Items by window: a window that very many items share is one row, so no document meets it twice.
    listed = all_windows.groupBy("size", "words").agg(F.collect_set("id").alias("items"))
    found = (
        near.join(listed, ["size", "words"])
        .groupBy("id")
        .agg(
            F.collect_list(F.struct("first", "size")).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    joined = docs.withColumn("id", F.sha2("text", 256)).join(found, "id", "left").select("doc_id", "text", "spans", "items")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, n_hit = [], []
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                raw = np.frombuffer((text.as_py() or "").encode(), np.uint8)
                n = len(split(raw, np.asarray([0, len(raw)]), PUNCTUATED).starts)
                hit = np.zeros(n, bool)
                for span in spans.as_py() or []:
                    hit[span["first"] : span["first"] + span["size"]] = True
                counts.append(n)
                n_hit.append(int(hit.sum()))
            items = [x or [] for x in batch.column(3).to_pylist()]
            yield pa.record_batch(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string()))],
                ["doc_id", "n_words", "n_hit", "items"],
            )

    return joined.mapInArrow(run, f"doc_id {kind}, {SCHEMA}")


def contamination(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    broadcast_words: int = BROADCAST_WORDS,
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_hit``, ``items`` (ids as sorted strings) and ``contaminated``, a row for each row.

    A document is contaminated if at least a twentieth of its words is hit. ``doc_id`` may be a
    struct and ``text`` a field of it, as ``row.text``.
    """
    field = text.removeprefix(f"{doc_id}.") if text.startswith(f"{doc_id}.") else None
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    items = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"))
    # No word is shorter than a byte, nor two words closer than a byte apart.
    size = items.agg(F.sum((F.octet_length("text") + 1) / 2)).first()[0] or 0
    if size <= broadcast_words:
        held = Benchmark(((row["item_id"], row["text"]) for row in items.collect()), window, gram)
        result = _by_broadcast(docs, held, docs.schema["doc_id"].dataType.simpleString(), field)
    else:
        result = _by_join(docs, items, list(range(1, window + 1)), window, gram)
    return result.withColumn("contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))


def clean(docs: DataFrame, items: DataFrame, **options: object) -> DataFrame:
    """The rows of ``docs``, with all columns, that are not contaminated."""
    whole = docs.select(F.struct(*docs.columns).alias("row"))
    found = contamination(whole, items, **options | {"doc_id": "row", "text": f"row.{options.get('text', 'text')}"})
    return found.where("not contaminated").select("doc_id.*")
