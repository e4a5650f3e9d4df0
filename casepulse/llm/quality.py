"""Quality by distribution: how far a text's characters and common words are from its language's.

For each language the shares of character classes and of common words are taken over all of its
texts. A text is far from its language if the Jensen-Shannon distance of its own shares exceeds
a limit: symbols, tables and shouting shift the classes of characters, lists of names and word
salad the common words. Texts too short for shares to mean anything pass. The limit of common
words is one that a text without any of them exceeds, where its length leaves that no chance.

Common words are exact. A word with a share of ``COMMON`` of a language's words has half of it
in the partitions where it is at least half as frequent, so tasks pass on only such words, and a
second pass counts the few that remain over all texts. Neither result depends on partitioning.

Every language of at least ``LEAST_OF_LANGUAGE`` words has a reference; texts of one with fewer,
whose shares mean little, are judged by the base rule alone and have null distances. Texts without
a language are compared with every reference and judged by the nearest. References are taken and
used in blocks of ``AT_ONCE`` languages, so what driver and tasks hold does not grow with their
number. Null and empty texts have no words and fail the base rule. Repeated rows keep their rows,
a null id is carried along, and other columns are not looked at. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casepulse.llm.store import cut
from casepulse.llm.words import BLANK, HashIndex, grams, hashes, mix, slices, split, sums, tally

# The base rule.
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS, MOST_REPEATED, WINDOW = 50, 50, 3

#: Share of a language's words from which on a word is common.
COMMON = 0.004
#: Words from which on a language has a reference, and languages whose references are held at once.
LEAST_OF_LANGUAGE, AT_ONCE = 2000, 400
#: Limits of the distances of character classes and of common words, and how long a text must be for each.
FAR_CHARS, FAR_WORDS = 0.30, 0.42
LEAST_CHARS, LEAST_JUDGED = 200, 100
#: Part of the distance of a text without common words from which on a text is far, and deviations left to chance.
WITHOUT, CHANCE = 0.9, 4.0

# Classes of characters by their first byte: lower and upper letters, digits, blanks, line feeds,
# sentence marks, symbols, other marks, letters beyond ASCII.
LOWER_LETTER, UPPER_LETTER, DIGIT, SPACE, LINE, MARK, SYMBOL, OTHER, BEYOND, CONTINUED = range(10)


def _class_table() -> np.ndarray:
    table = np.full(256, OTHER, np.int64)
    table[97:123], table[65:91], table[48:58] = LOWER_LETTER, UPPER_LETTER, DIGIT
    table[BLANK], table[10] = SPACE, LINE
    table[list(b".,;:!?'\"()-")] = MARK
    table[list(SYMBOLS)] = SYMBOL
    table[192:], table[128:192] = BEYOND, CONTINUED
    return table


CLASS = _class_table()


@dataclass
class References:
    """For each language of a block the shares of character classes and of its common words, the rest last."""

    languages: list[str]
    classes: np.ndarray
    words: list[HashIndex]
    shares: list[np.ndarray]


def char_shares(data: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """How many characters of each class each row has."""
    row = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    counts = np.bincount(row * 10 + CLASS[data], minlength=10 * (len(edges) - 1)).reshape(-1, 10)
    return counts[:, :CONTINUED]


def jensen_shannon(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The distance of each row of p, made to add up to one, from q: between 0 and 1."""
    p = p / np.maximum(p.sum(axis=-1, keepdims=True), 1)
    middle = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / middle), 0.0).sum(axis=-1)
        right = np.where(q > 0, q * np.log2(q / middle), 0.0).sum(axis=-1)
    return np.sqrt(np.clip((left + right) / 2, 0.0, 1.0))


def word_limits(shares: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """The distance above which the common words of a text of so many words are far from the shares.

    Drawn by these shares, eight times the divergence in nats times the words is about a chi-squared value.
    """
    none = np.zeros((1, len(shares)))
    none[0, -1] = 1
    free = len(shares) - 1
    chance = np.sqrt((free + CHANCE * np.sqrt(2 * free)) / (8 * np.log(2) * np.maximum(n_words, 1)))
    return np.minimum(FAR_WORDS, np.maximum(WITHOUT * jensen_shannon(none, shares)[0], chance))


def _lang_batches(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    langs = np.asarray(batch.column(0).to_pylist(), object)
    for at, data, edges in slices(batch.column(1)):
        yield langs[at : at + len(edges) - 1], data, edges


def _candidates(docs: DataFrame) -> DataFrame:
    """``lang``, ``key``, ``count`` of the words that are frequent in their partition; key NULL holds all its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for langs, data, edges in _lang_batches(batch):
                words = split(data, edges)
                keys, of = hashes(words), langs[words.rows] if len(langs) else langs
                for lang in dict.fromkeys(langs):
                    more = tally(keys[of == lang])
                    before = held.get(lang)
                    both = tally(*map(np.concatenate, zip(before, more, strict=True))) if before else more
                    held[lang] = both
        for lang, (keys, counts) in held.items():
            total = int(counts.sum())
            often = counts >= COMMON / 2 * total
            columns = [
                pa.array([lang] * (int(often.sum()) + 1), pa.string()),
                pa.array([None, *keys[often].view(np.int64).tolist()], pa.int64()),
                pa.array([total, *counts[often].tolist()], pa.int64()),
            ]
            yield pa.record_batch(columns, ["lang", "key", "count"])

    return docs.select("lang", "text").mapInArrow(run, "lang string, key bigint, count bigint")


def _totals(docs: DataFrame, words: dict[str, np.ndarray]) -> DataFrame:
    """``lang``, ``kind``, ``at``, ``count``: characters of each class, each candidate and all words of each language."""
    shared = docs.sparkSession.sparkContext.broadcast({k: HashIndex(v) for k, v in words.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums_: dict[str, list[np.ndarray]] = {k: [np.zeros(CONTINUED, np.int64), np.zeros(len(v.keys) + 1, np.int64)] for k, v in shared.value.items()}
        for batch in batches:
            for langs, data, edges in _lang_batches(batch):
                shares = char_shares(data, edges)
                found = split(data, edges)
                keys, of = hashes(found), langs[found.rows] if len(langs) else langs
                for lang in dict.fromkeys(langs):
                    if lang in sums_:
                        sums_[lang][0] += shares[langs == lang].sum(axis=0)
                        at = shared.value[lang].find(keys[of == lang])
                        sums_[lang][1] += np.bincount(np.where(at < 0, len(sums_[lang][1]) - 1, at), minlength=len(sums_[lang][1]))
        rows = [(lang, kind, i, int(c)) for lang, two in sums_.items() for kind, x in enumerate(two) for i, c in enumerate(x)]
        columns = [pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.int64()))]
        yield pa.record_batch(columns, ["lang", "kind", "at", "count"])

    counted = docs.select("lang", "text").mapInArrow(run, "lang string, kind bigint, at bigint, count bigint")
    return counted.groupBy("lang", "kind", "at").agg(F.sum("count").alias("count"))


def references(docs: DataFrame, text: str = "text", lang: str = "lang", at_once: int = AT_ONCE) -> list[References]:
    """References in blocks of languages by name; of each the driver gets at most ``2 / COMMON`` words, a block at a time."""
    docs = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")
    found = cut(_candidates(docs).groupBy("lang", "key").agg(F.sum("count").alias("count")))
    kept = found.where("key is null").where(F.col("count") >= LEAST_OF_LANGUAGE).select("lang", F.col("count").alias("of_lang"))
    blocks, last = [], None
    while True:
        block = kept if last is None else kept.where(F.col("lang") > last)
        block = block.orderBy("lang").limit(at_once)  # at most at_once rows
        often = found.where("key is not null").join(F.broadcast(block), "lang").where(F.col("count") >= COMMON / 2 * F.col("of_lang"))
        words: dict[str, list[int]] = {row["lang"]: [] for row in block.collect()}
        if not words:
            return blocks
        for row in often.select("lang", "key").collect():
            words[row["lang"]].append(row["key"])
        blocks.append(_referred(docs, {k: np.unique(np.asarray(v, np.int64).view(np.uint64)) for k, v in words.items()}))
        last = max(words)
        if len(words) < at_once:
            return blocks


def _referred(docs: DataFrame, candidates: dict[str, np.ndarray]) -> References:
    counts = {k: [np.zeros(CONTINUED), np.zeros(len(v) + 1)] for k, v in candidates.items()}
    for row in _totals(docs.where(F.col("lang").isin(*candidates)), candidates).collect():
        counts[row["lang"]][row["kind"]][row["at"]] = row["count"]
    languages, classes, indexes, shares = sorted(candidates), [], [], []
    for name in languages:
        chars, times = counts[name]
        classes.append(chars / max(chars.sum(), 1))
        common = np.flatnonzero(times[:-1] >= COMMON * times.sum())
        indexes.append(HashIndex(candidates[name][common]))
        shares.append(np.append(times[common], times.sum() - times[common].sum()) / max(times.sum(), 1))
    return References(languages, np.asarray(classes).reshape(-1, CONTINUED), indexes, shares)


def base_counts(data: np.ndarray, edges: np.ndarray) -> dict[str, np.ndarray]:
    """The figures of the base rule for each row."""
    words = split(data, edges, lower=False)
    first, n = words.first, words.counts()
    inside = ~BLANK[data] & ((data & 0xC0) != 0x80)
    symbol = np.isin(data, list(SYMBOLS))
    total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[edges])
    row = words.rows
    repeated = np.zeros(len(row), bool)
    if len(row) >= WINDOW:
        three = grams(hashes(words), WINDOW)
        valid = row[WINDOW - 1 :] == row[: 1 - WINDOW]
        keys = mix(three ^ mix(row[: 1 - WINDOW].astype(np.uint64)))[valid]
        order = np.argsort(keys, kind="stable")
        same, twice = keys[order][1:] == keys[order][:-1], np.zeros(len(keys), bool)
        twice[1:] = same
        twice[:-1] |= same
        starts = np.flatnonzero(valid)[order[twice]]
        for j in range(WINDOW):
            repeated[starts + j] = True
    lines = np.zeros(len(n), np.int64)
    for i in range(len(n)):
        seen: set[bytes] = set()
        for line in data[edges[i] : edges[i + 1]].tobytes().split(b"\n"):
            if line.strip(b" \t\r\x0b\x0c"):
                if line in seen:
                    lines[i] += 1
                else:
                    seen.add(line)
    return {
        "n_words": n,
        "word_chars": total(inside),
        "n_symbols": total(symbol),
        "n_dup_lines": lines,
        "n_repeat_words": sums(repeated.astype(np.int64), first),
    }


def distances(
    data: np.ndarray, edges: np.ndarray, langs: np.ndarray, refs: References
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distance of each row's characters and of its common words from its language's, and the limit of the latter.

    Rows without a language get those of the nearest of the block, rows of other languages NaN.
    """
    n = len(edges) - 1
    chars, of_words, limits = np.full(n, np.nan), np.full(n, np.nan), np.full(n, FAR_WORDS)
    shares = char_shares(data, edges)
    words = split(data, edges)
    keys, row = hashes(words), words.rows
    place_of = {name: k for k, name in enumerate(refs.languages)}
    own = np.asarray([-1 if x is None else place_of.get(x, -2) for x in langs], int)
    best = np.full(n, np.inf)
    for k in range(len(refs.languages)):
        mine = np.flatnonzero((own == k) | (own == -1))
        if not len(mine):
            continue
        by_char = jensen_shannon(shares[mine], refs.classes[k])
        size = len(refs.shares[k])
        place = np.full(n, -1)
        place[mine] = np.arange(len(mine))
        chosen = place[row] >= 0
        at = refs.words[k].find(keys[chosen])
        cells = place[row[chosen]] * size + np.where(at < 0, size - 1, at)
        by_word = jensen_shannon(np.bincount(cells, minlength=len(mine) * size).reshape(-1, size), refs.shares[k])
        nearer = by_char + by_word < best[mine]
        at_rows = mine[nearer]
        best[at_rows] = (by_char + by_word)[nearer]
        chars[at_rows], of_words[at_rows] = by_char[nearer], by_word[nearer]
        limits[at_rows] = word_limits(refs.shares[k], words.counts()[at_rows])
    return chars, of_words, limits


FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _measured(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, ``lang`` and the base figures of each row; distances are null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, edges in slices(batch.column("text")):
                base, n = base_counts(data, edges), len(edges) - 1
                unknown = [pa.nulls(n, pa.float64())] * 3
                yield pa.record_batch(
                    [*batch.slice(at, n).columns, *(pa.array(base[x].astype(np.int64)) for x in FIGURES), *unknown],
                    [*batch.schema.names, *FIGURES, *_DISTANCES],
                )

    figures = ", ".join([*(f"{x} bigint" for x in FIGURES), *(f"{x} double" for x in _DISTANCES)])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, text string, lang string, {figures}")


_DISTANCES = ("char_distance", "word_distance", "word_limit")


def _compared(measured: DataFrame, refs: References) -> DataFrame:
    """The rows with the distances that one block of references gives, where it has the language or is nearer."""
    shared = measured.sparkSession.sparkContext.broadcast(refs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.asarray(batch.column("lang").to_pylist(), object)
            for at, data, edges in slices(batch.column("text")):
                rows = batch.slice(at, len(edges) - 1)
                found = np.stack(distances(data, edges, langs[at : at + len(edges) - 1], shared.value))
                before = np.stack([rows.column(x).to_numpy(zero_copy_only=False).astype(float) for x in _DISTANCES])
                better = ~np.isnan(found[0]) & ~(found[:2].sum(axis=0) >= before[:2].sum(axis=0))
                kept = np.where(better, found, before)
                columns = [pa.array(x, mask=np.isnan(x)) for x in kept]
                yield pa.record_batch([*rows.columns[: -len(columns)], *columns], rows.schema.names)

    return measured.mapInArrow(run, measured.schema)


def judge(docs: DataFrame, refs: list[References], doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """A row for each row: the base figures, both distances, ``base_failed`` and ``kept``."""
    judged = _measured(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")))
    for block in refs:
        judged = _compared(judged, block)
    failed = F.expr(f"n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED} * n_words")
    far_chars = f"word_chars >= {LEAST_CHARS} and char_distance > {FAR_CHARS}"
    far_words = f"n_words >= {LEAST_JUDGED} and word_distance > word_limit"
    far = F.coalesce(F.expr(far_chars), F.lit(False)) | F.coalesce(F.expr(far_words), F.lit(False))
    judged = judged.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & ~far)
    return judged.drop("text", "lang", "word_limit")
