"""Language-model scores by a hashed maximum-entropy model with a class-factored softmax.

The probability of a word is that of its class times that of the word in its class. Classes are
of two sorts. The most frequent words form classes of a fixed size, within which a second softmax
chooses. All other words, and those never seen, fall into classes by their endings, within which
a word has its smoothed share of the class, an unseen word that of one more word. So the
probabilities of all training words and of an unseen word in each such class add up to one.

Both softmaxes are fed by rows of two hashed weight tables: for the word before, the two words
before together, and the second and third words before by themselves (skips). Training is one
pass over all training texts in rounds: every task follows the gradient through its texts from
the weights of the round before, and the moves of all tasks are averaged by blocks of the
tables in Spark. The tables are of fixed size, so what the driver and the executors hold does
not grow.

Counts of words are kept exactly. Those of at most ``HEAD`` frequent words are sent to the
executors; the others are joined to the words of the texts by key. A word's key is 60 bits of
its hash and four of the class of its ending.

Null and empty texts consist of the end token alone. Texts of null id train. Without any
training text every token is unseen, and scores are finite. Repeated rows keep their rows;
columns other than the id and the text are not looked at. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casepulse.llm.store import cut
from casepulse.llm.words import BASE, HashIndex, Words, hashes, mix, slices, split, sums, tally

#: Words whose counts every executor holds.
HEAD = 1 << 18
#: Words of a class, classes of frequent words, and classes of endings.
SIZE, FREQUENT, ENDINGS = 64, 16, 16
CLASSES = FREQUENT + ENDINGS
#: Rows of each weight table; endings that stand for infrequent words in the history.
ROWS, SHAPES = 1 << 13, 1 << 12
BLOCK = 64
ROUNDS = 2
RATE = 0.15
BATCH = 1 << 14
#: Tokens of a row that are added up side by side with those of all other rows.
SHORT = 16
#: Distinct words a counting task gathers before it passes them on.
GATHERED = 1 << 21
SMOOTH = 0.1
START = SHAPES + FREQUENT * SIZE
END_KEY = np.uint64(0xE0D0_E0D0_E0D0_E0D0)


@dataclass
class Tokens:
    """Keys and endings of the words of some rows, each row closed by the end token."""

    keys: np.ndarray
    shapes: np.ndarray
    first: np.ndarray


def tokens(words: Words) -> Tokens:
    n_rows = len(words.first) - 1
    hashed = hashes(words)
    last = np.zeros(len(hashed), np.uint64)
    for j in (1, 2, 3):
        at = words.ends - j
        byte = np.where(at >= words.starts, words.data[np.maximum(at, 0)].astype(np.uint64), np.uint64(0))
        last = last * np.uint64(256) + byte
    ending = mix(last)
    keys = (hashed & ~np.uint64(ENDINGS - 1)) | (ending & np.uint64(ENDINGS - 1))
    places = words.first[1:]
    keys = np.insert(keys, places, END_KEY)
    shapes = np.insert((ending >> np.uint64(20)).astype(np.int64) % SHAPES, places, 0)
    return Tokens(keys, shapes, words.first + np.arange(n_rows + 1))


def _batches(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, Tokens]]:
    for at, data, edges in slices(batch.column(column)):
        yield at, tokens(split(data, edges))


@dataclass
class Model:
    """Counts of frequent words and the two tables of weights with their biases."""

    index: HashIndex
    counts: np.ndarray
    rank: np.ndarray
    total: int
    distinct: int
    class_bias: np.ndarray
    word_bias: np.ndarray
    masses: np.ndarray
    class_rows: np.ndarray = field(default_factory=lambda: np.zeros((ROWS, CLASSES), np.float32))
    word_rows: np.ndarray = field(default_factory=lambda: np.zeros((ROWS, SIZE), np.float32))

    def features(self, t: Tokens, rank: np.ndarray) -> np.ndarray:
        """A row of the class table for each token and each of four views of what stands before it."""
        name = np.where(rank >= 0, rank + SHAPES, t.shapes).astype(np.uint64)
        at = np.arange(len(name)) - np.repeat(t.first[:-1], np.diff(t.first))
        before = []
        for j in (1, 2, 3):
            moved = np.concatenate([np.full(min(j, len(name)), START, np.uint64), name[: max(0, len(name) - j)]])
            before.append(np.where(at >= j, moved, np.uint64(START)))
        one, two, three = before
        with np.errstate(over="ignore"):
            views = [one + np.uint64(1 << 40), (one * BASE) ^ two, two + np.uint64(1 << 41), three + np.uint64(1 << 42)]
            return (np.stack([mix(v) for v in views], axis=1) >> np.uint64(40)).astype(np.int64) % ROWS

    def word_features(self, features: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """A row of the word table for each token in a frequent class: the word before and the second before."""
        with np.errstate(over="ignore"):
            mixed = mix(features[:, [0, 2]].astype(np.uint64) * np.uint64(FREQUENT) + classes[:, None].astype(np.uint64))
        return (mixed >> np.uint64(40)).astype(np.int64) % ROWS

    def prepare(self, t: Tokens) -> tuple[np.ndarray, ...]:
        at = self.index.find(t.keys)
        rank = np.where(at >= 0, self.rank[at], -1) if len(self.rank) else np.full(len(t.keys), -1)
        classes = np.where(rank >= 0, rank // SIZE, FREQUENT + (t.keys & np.uint64(ENDINGS - 1)).astype(np.int64))
        return at, rank, classes, self.features(t, rank)

    def class_logits(self, features: np.ndarray) -> np.ndarray:
        out = self.class_rows.take(features[:, 0], axis=0)
        for j in range(1, features.shape[1]):
            out += self.class_rows.take(features[:, j], axis=0)
        out += self.class_bias
        return out

    def word_logits(self, rows: np.ndarray, classes: np.ndarray) -> np.ndarray:
        out = self.word_rows.take(rows[:, 0], axis=0)
        out += self.word_rows.take(rows[:, 1], axis=0)
        out += self.word_bias.take(classes, axis=0)
        return out

    def log_probabilities(self, t: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """Natural logarithms for each token, without the count of words not at hand; and those words' places."""
        at, rank, classes, features = self.prepare(t)
        out = np.empty(len(t.keys))
        for a in range(0, len(out), BATCH):
            part = slice(a, a + BATCH)
            logits = self.class_logits(features[part])
            top = logits.max(axis=1)
            size = np.log(np.exp(logits - top[:, None]).sum(axis=1)) + top
            out[part] = logits[np.arange(len(logits)), classes[part]] - size
            own = np.flatnonzero(rank[part] >= 0)
            if len(own):
                rows = self.word_features(features[part][own], classes[part][own])
                logits = self.word_logits(rows, classes[part][own])
                top = logits.max(axis=1)
                size = np.log(np.exp(logits - top[:, None]).sum(axis=1)) + top
                out[a + own] += logits[np.arange(len(own)), rank[part][own] % SIZE] - size
        rest = np.flatnonzero(rank < 0)
        out[rest] -= np.log(self.masses[classes[rest] - FREQUENT])
        held = rest[at[rest] >= 0]
        out[held] += np.log(self.counts[at[held]] + SMOOTH)
        return out, rest[at[rest] < 0]

    def train(self, t: Tokens, squares: tuple[np.ndarray, np.ndarray]) -> None:
        """Follow the gradient through the tokens; ``squares`` sums the squared gradients of each row."""
        _, rank, classes, features = self.prepare(t)
        for a in range(0, len(rank), BATCH):
            part = slice(a, a + BATCH)
            view, chosen = features[part], classes[part]
            _descend(self.class_rows, squares[0], view, _error(self.class_logits(view), chosen))
            own = np.flatnonzero(rank[part] >= 0)
            if len(own):
                rows = self.word_features(view[own], chosen[own])
                error = _error(self.word_logits(rows, chosen[own]), rank[part][own] % SIZE)
                _descend(self.word_rows, squares[1], rows, error)


def _error(logits: np.ndarray, truth: np.ndarray) -> np.ndarray:
    """Softmax less the truth: the gradient of the loss by the logits."""
    logits -= logits.max(axis=1)[:, None]
    np.exp(logits, out=logits)
    logits /= (logits @ np.ones(logits.shape[1], logits.dtype))[:, None]
    logits[np.arange(len(truth)), truth] -= 1.0
    return logits


def _totals(error: np.ndarray, order: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``error`` by groups of ``order``: most are short, so all first rows are taken at once, then all second ones."""
    total = error.take(order[begins], axis=0)
    for k in range(1, SHORT):
        longer = np.flatnonzero(lengths > k)
        if not len(longer):
            return total
        total[longer] += error.take(order[begins[longer] + k], axis=0)
    longer = np.flatnonzero(lengths > SHORT)
    if len(longer):
        left = lengths[longer] - SHORT
        first = np.cumsum(left) - left
        rest = np.arange(left.sum()) + np.repeat(begins[longer] + SHORT - first, left)
        total[longer] += np.add.reduceat(error.take(order[rest], axis=0), first, axis=0)
    return total


def _descend(table: np.ndarray, squares: np.ndarray, rows: np.ndarray, error: np.ndarray) -> None:
    """One step of the rows in use, each by the root of the squares it has met."""
    for j in range(rows.shape[1]):
        short = rows[:, j].astype(np.min_scalar_type(ROWS - 1))  # numbers of 16 bits are sorted by their digits
        order = np.argsort(short, kind="stable")
        sorted_ = short[order]
        begins = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
        used = sorted_[begins].astype(np.int64)
        gradient = _totals(error, order, begins, np.diff(begins, append=len(order)))
        squares[used] += np.einsum("ij,ij->i", gradient, gradient)
        gradient *= (RATE / np.sqrt(squares[used] + 1e-6)).astype(gradient.dtype)[:, None]
        table[used] -= gradient


def _count(docs: DataFrame) -> DataFrame:
    """``key`` and ``count`` of all words of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, size = [], [], 0
        for batch in batches:
            for _, t in _batches(batch, 0):
                k, c = tally(t.keys)
                keys.append(k)
                counts.append(c)
                size += len(k)
                if size > GATHERED:
                    k, c = tally(np.concatenate(keys), np.concatenate(counts))
                    keys, counts, size = [k], [c], len(k)
                    if size > GATHERED // 2:
                        yield from made(k, c)
                        keys, counts, size = [], [], 0
        if keys:
            yield from made(*tally(np.concatenate(keys), np.concatenate(counts)))

    def made(keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(keys), 100_000):
            part = slice(a, a + 100_000)
            columns = [pa.array(keys[part].view(np.int64)), pa.array(counts[part].astype(np.int64))]
            yield pa.record_batch(columns, ["key", "count"])

    counted = docs.select("text").mapInArrow(run, "key bigint, count bigint")
    return counted.groupBy("key").agg(F.sum("count").alias("count"))


def _frequent_from(vocabulary: DataFrame, most: int) -> int:
    """The least count from which on words are at most ``most``: read off a histogram of bounded size."""
    grain = F.floor(F.log2("count") * 16)
    bins = vocabulary.groupBy(grain.alias("bin")).agg(F.count("*").alias("words"), F.min("count").alias("least")).collect()
    least, words = 1 << 62, 0
    for row in sorted(bins, key=lambda r: -r["bin"]):
        words += row["words"]
        if words > most:
            break
        least = row["least"]
    return least


def start(vocabulary: DataFrame, head: int = HEAD) -> tuple[Model, int]:
    """A model that knows counts but no history, and the least count of the words it holds."""
    least = _frequent_from(vocabulary, head)
    # Keys are signed in Spark: the low bits of the ending are the same.
    by_ending = vocabulary.groupBy(F.pmod("key", F.lit(ENDINGS)).alias("ending")).agg(
        F.sum("count").alias("count"), F.count("*").alias("words")
    )
    per_ending = {r["ending"]: (r["count"], r["words"]) for r in by_ending.collect()}
    held = vocabulary.where(F.col("count") >= least).toArrow()
    keys = held["key"].to_numpy().view(np.uint64)
    counts = held["count"].to_numpy()
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    best = np.lexsort((keys, -counts))[: FREQUENT * SIZE]
    rank = np.full(len(keys), -1)
    rank[best] = np.arange(len(best))
    words = np.zeros(FREQUENT * SIZE)
    words[: len(best)] = counts[best]
    masses = np.asarray([SMOOTH + per_ending.get(e, (0, 0))[0] + SMOOTH * per_ending.get(e, (0, 0))[1] for e in range(ENDINGS)])
    np.add.at(masses, (keys[best] & np.uint64(ENDINGS - 1)).astype(int), -(counts[best] + SMOOTH))
    masses = np.maximum(masses, SMOOTH)
    by_class = words.reshape(FREQUENT, SIZE)
    with np.errstate(divide="ignore"):
        word_bias = np.where(by_class > 0, np.log(by_class), -1e9).astype(np.float32)
        sizes = np.concatenate([by_class.sum(axis=1), masses])
        class_bias = np.where(sizes > 0, np.log(sizes / sizes.sum()), -1e9).astype(np.float32)
    total = sum(c for c, _ in per_ending.values())
    distinct = sum(w for _, w in per_ending.values())
    return Model(HashIndex(keys), counts, rank, total, distinct, class_bias, word_bias, masses), least


def _round(docs: DataFrame, model: Model, trainers: int) -> None:
    """One round of gradient steps in every task, averaged into the model."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Model = shared.value
        tables = (held.class_rows, held.word_rows)
        own = Model(**{k: getattr(held, k) for k in held.__dataclass_fields__})
        own.class_rows, own.word_rows = (x.copy() for x in tables)
        squares = tuple(np.zeros(ROWS) for _ in tables)
        seen = 0
        for batch in batches:
            for _, t in _batches(batch, 0):
                own.train(t, squares)
                seen += len(t.keys)
        if not seen:
            return
        for name, before, after in (("class", *_pair(held, own, 0)), ("word", *_pair(held, own, 1))):
            moved = (after - before).astype(np.float16)
            for b in range(0, ROWS, BLOCK):
                part = moved[b : b + BLOCK]
                if part.any():
                    yield pa.record_batch(
                        [pa.array([name]), pa.array([b], pa.int64()), pa.array([seen], pa.int64()), pa.array([part.tobytes()], pa.binary())],
                        ["table", "block", "seen", "moved"],
                    )

    def average(moves: pa.Table) -> pa.Table:
        seen = moves["seen"].to_numpy().astype(float)
        total = sum(np.frombuffer(m.as_py(), np.float16).astype(np.float32) * s for m, s in zip(moves["moved"], seen, strict=True))
        return pa.table({"table": moves["table"][:1], "block": moves["block"][:1], "total": pa.array([np.asarray(total, np.float32).tobytes()], pa.binary()), "seen": [seen.sum()]})

    steps = docs.select("text").coalesce(trainers).mapInArrow(run, "table string, block bigint, seen bigint, moved binary")
    merged = steps.groupBy("table", "block").applyInArrow(average, "table string, block bigint, total binary, seen double")
    for row in merged.collect():  # as many rows as the tables have blocks
        table = model.class_rows if row["table"] == "class" else model.word_rows
        move = np.frombuffer(row["total"], np.float32).reshape(BLOCK, -1) / row["seen"]
        table[row["block"] : row["block"] + BLOCK] += move
    shared.unpersist()


def _pair(held: Model, own: Model, which: int) -> tuple[np.ndarray, np.ndarray]:
    return (held.class_rows, own.class_rows) if which == 0 else (held.word_rows, own.word_rows)


def train(docs: DataFrame, model: Model, rounds: int = ROUNDS) -> None:
    """Each text trains in one round; the rounds begin from the averages of those before."""
    trainers = 2 * docs.sparkSession.sparkContext.defaultParallelism
    turn = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(rounds))
    for r in range(rounds):
        _round(docs.where(turn == r), model, trainers)


def _scored(docs: DataFrame, model: Model, kind: str) -> DataFrame:
    """What each row's frequent words give, and the keys of its others."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["row", "doc_id", "held_out", "n_tokens", "n_held", "base", "natural", "others"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Model = shared.value
        for batch in batches:
            for at, t in _batches(batch, 3):
                n = len(t.first) - 1
                logs, others = held.log_probabilities(t)
                place = held.index.find(t.keys)
                known = place >= 0
                counts = np.where(known, held.counts[place], 0) if len(held.counts) else np.zeros(len(place))
                base = np.where(known, np.log10(counts + SMOOTH), 0.0)
                offsets = np.searchsorted(others, t.first).astype(np.int32)
                keys = pa.ListArray.from_arrays(pa.array(offsets), pa.array(t.keys[others].view(np.int64)))
                columns = [np.diff(t.first), sums(known.astype(np.int64), t.first), sums(base, t.first), sums(logs, t.first)]
                yield pa.record_batch([*batch.slice(at, n).columns[:3], *map(pa.array, columns), keys], names)

    return docs.select("row", "doc_id", "held_out", "text").mapInArrow(
        run,
        f"row bigint, doc_id {kind}, held_out boolean, n_tokens bigint, n_held bigint, base double, natural double, others array<bigint>",
    )


def score(
    docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", head: int = HEAD, rounds: int = ROUNDS
) -> DataFrame:
    """A row for each row: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    ``held_out`` tells the rows that train nothing; ``score`` is the log10 probability of the
    text, ``base_score`` that of smoothed counts of single words.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    docs = docs.select(F.col(doc_id).alias("doc_id"), held_out.alias("held_out"), F.col(text).alias("text"))
    learning = docs.where("not held_out")
    vocabulary = cut(_count(learning))
    model, least = start(vocabulary, head)
    train(learning, model, rounds)
    rows = cut(_scored(docs.withColumn("row", F.monotonically_increasing_id()), model, kind))
    logs = F.log10(F.coalesce("count", F.lit(0)) + SMOOTH)
    others = (
        rows.select("row", F.explode("others").alias("key"))
        .join(vocabulary.where(F.col("count") < least), "key", "left")
        .groupBy("row")
        .agg(F.sum(logs).alias("rest"), F.count("count").alias("n_rest"))
    )
    mass = float(np.log10(model.total + SMOOTH * (model.distinct + 1)))
    rest = F.coalesce("rest", F.lit(0.0))
    return rows.join(others, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_held") + F.coalesce("n_rest", F.lit(0))).alias("n_known"),
        F.lit(int(model.total)).cast("bigint").alias("train_tokens"),
        (F.col("base") + rest - F.col("n_tokens") * F.lit(mass)).alias("base_score"),
        (F.col("natural") / float(np.log(10)) + rest).alias("score"),
    )
