"""Language identification by interpolated Kneser-Ney character models.

Texts become streams of letters: case folded, every run of other characters one space. For
each language n-grams up to ``ORDER`` are counted in a bounded sample of labelled rows, in Spark,
and turned into interpolated Kneser-Ney probabilities. A model is a sorted hash array for each
order: the hashes of all n-grams seen in any language, and beside each its log probability in
every language. An n-gram that is not there falls back to the next order with the weight of
its context. The language of lowest cross-entropy per letter wins; equal ones go to the smaller
name. A part of the sample is kept out of the counts to calibrate the score and the limits of
cross-entropy beyond which a text is rejected as no language that was learned.

Every label is learned, however many there are and however short their texts. Languages come in
blocks, by name, of at most ``CELLS`` n-grams times languages, or of one language: the driver
counts and fits one block at a time, and a text passes from block to block with its best language
so far and the sum its score needs.

Null texts and texts without letters are ``und`` with score 0 and rejected. Rows without a
label train nothing; without any label every text is ``und``. Repeated
rows keep their rows, a null id is carried along, and columns other than id, text and label
are not looked at. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from casepulse.llm.store import cut
from casepulse.llm.words import BASE, HashIndex, find, mix, slices, sums, tally

ORDER = 5
UNKNOWN = "und"
#: Languages up to whose number their counts of rows are sent to all tasks.
SENT = 10_000
#: Labelled rows of each language that a model is fitted on, and their letters: the row that passes that bound is the last.
ROWS_PER_LANGUAGE, LETTERS_PER_LANGUAGE = 1000, 8_000_000
#: N-grams times languages of a block, four bytes each.
CELLS = 16_000_000
#: One row in so many of the sample calibrates.
CALIBRATE = 5
#: Deviations above its language's usual cross-entropy at which a text is rejected.
MARGIN = 12.0
SPACE = 32
CHARS = 1 << 18


def _fold_table() -> np.ndarray:
    """Folded letter of each code point of the basic plane, a space for what is no letter."""
    table = np.full(1 << 16, SPACE, np.uint32)
    for point in range(1 << 16):
        letter = chr(point)
        if letter.isalpha():
            low = letter.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


_FOLD = _fold_table()


def letters(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded letters of rows of UTF-8 bytes, each row with a space before it, and the rows' edges."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), "<u4")
    lead = (data & 0xC0) != 0x80
    starts = np.concatenate([[0], np.cumsum(lead)])[edges]
    folded = np.where(points < len(_FOLD), _FOLD[np.minimum(points, len(_FOLD) - 1)], points)
    out = np.insert(folded, starts[:-1], SPACE)
    starts = starts + np.arange(len(starts))  # with the spaces put in
    repeated = np.zeros(len(out), bool)
    repeated[1:] = (out[1:] == SPACE) & (out[:-1] == SPACE)
    repeated[starts[:-1]] = False
    kept = np.concatenate([[0], np.cumsum(~repeated)])
    return out[~repeated].astype(np.uint64), kept[starts]


def gram_hashes(stream: np.ndarray, n: int) -> np.ndarray:
    """A hash of the n letters that end at each place; the first n - 1 places hold no full one."""
    with np.errstate(over="ignore"):
        out = np.zeros(len(stream), np.uint64)
        for j in range(n - 1, -1, -1):
            shifted = np.concatenate([np.zeros(j, np.uint64), stream[: len(stream) - j]]) if j else stream
            out = out * BASE + shifted
        return mix(out + np.uint64(n))


@dataclass
class Block:
    """Some languages, and for each order their sorted hashes with log10 probabilities and context weights.

    ``mean`` and ``spread`` are those of the cross-entropy per letter that the texts of each
    language have.
    """

    languages: list[str]
    grams: list[HashIndex] = field(default_factory=list)
    logs: list[np.ndarray] = field(default_factory=list)
    contexts: list[HashIndex] = field(default_factory=list)
    weights: list[np.ndarray] = field(default_factory=list)
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None

    def log_probabilities(self, stream: np.ndarray, places: np.ndarray) -> np.ndarray:
        """A row for each place, a column for each language."""
        top = len(self.grams)
        at = self.grams[-1].find(gram_hashes(stream, top)[places])
        out = self.logs[-1][at]  # -1 is overwritten below
        open_ = np.flatnonzero(at < 0)
        back = np.zeros((len(open_), len(self.languages)), np.float32)
        for n in range(top, 0, -1):
            if not len(open_):
                return out
            if n < top:
                at = self.grams[n - 1].find(gram_hashes(stream, n)[places[open_]])
                seen = at >= 0
                out[open_[seen]] = back[seen] + self.logs[n - 1][at[seen]]
                open_, back = open_[~seen], back[~seen]
            if n > 1 and len(open_):
                known = self.contexts[n - 1].find(gram_hashes(stream, n - 1)[places[open_] - 1])
                back[known >= 0] += self.weights[n - 1][known[known >= 0]]
        out[open_] = back + self.unseen
        return out

    @property
    def unseen(self) -> np.float32:
        """The log probability of a letter that no language has: one of all code points."""
        return np.float32(-np.log10(0x110000))

    def entropies(self, data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per letter of each row in each language, and the number of letters; spaces at the ends count."""
        stream, first = letters(data, edges)
        n_letters = sums((stream != SPACE).astype(np.int64), first)
        padded = np.concatenate([np.full(ORDER, SPACE, np.uint64), stream])
        total = np.zeros((len(first) - 1, len(self.languages)))
        if not self.languages:
            return total, n_letters
        at = 0
        while at < len(first) - 1:  # blocks of rows, a long row in blocks of letters
            to = max(at + 1, int(np.searchsorted(first, first[at] + CHARS, side="right")) - 1)
            for a in range(first[at], first[to], CHARS):
                b = min(a + CHARS, first[to])
                block = self.log_probabilities(padded[a : b + ORDER], np.arange(ORDER, b - a + ORDER))
                edge = np.clip(first[at : to + 1], a, b) - a
                total[at:to] -= sums(block.astype(np.float64), edge)
            at = to
        return total / np.maximum(np.diff(first), 1)[:, None], n_letters


@dataclass
class Model:
    """Blocks of languages; ``sharpness`` turns differences of cross-entropy into probabilities."""

    blocks: list[Block] = field(default_factory=list)
    sharpness: float = 1.0

    @property
    def languages(self) -> list[str]:
        return [name for block in self.blocks for name in block.languages]


def _counts(sample: DataFrame) -> DataFrame:
    """``lang``, ``n``, ``gram``, ``context``, ``inner``, ``letters``: each n-gram of the sample with its parts' hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.asarray(batch.column(0).to_pylist(), object)
            for at, data, edges in slices(batch.column(1)):
                stream, first = letters(data, edges)
                lang = np.repeat(langs[at : at + len(edges) - 1], np.diff(first))
                padded = np.concatenate([np.full(ORDER, SPACE, np.uint64), stream])
                at_row = np.arange(len(stream)) - np.repeat(first[:-1], np.diff(first))
                for name in dict.fromkeys(lang):
                    own = np.flatnonzero(lang == name)
                    for n in range(1, ORDER + 1):
                        places = own[at_row[own] >= n - 1] + ORDER
                        grams, index, counts = np.unique(
                            gram_hashes(padded, n)[places], return_index=True, return_counts=True
                        )
                        places = places[index]
                        context = gram_hashes(padded, n - 1)[places - 1] if n > 1 else np.zeros(len(places), np.uint64)
                        inner = gram_hashes(padded, n - 1)[places] if n > 1 else np.zeros(len(places), np.uint64)
                        inner_context = gram_hashes(padded, n - 2)[places - 1] if n > 2 else np.zeros(len(places), np.uint64)
                        columns = [pa.array(x.view(np.int64)) for x in (grams, context, inner, inner_context)]
                        yield pa.record_batch(
                            [
                                pa.array([name] * len(grams), pa.string()),
                                pa.array(np.full(len(grams), n, np.int64)),
                                *columns,
                                pa.array(counts.astype(np.int64)),
                            ],
                            ["lang", "n", "gram", "context", "inner", "inner_context", "count"],
                        )

    schema = "lang string, n bigint, gram bigint, context bigint, inner bigint, inner_context bigint, count bigint"
    return sample.mapInArrow(run, schema).groupBy("lang", "n", "gram", "context", "inner", "inner_context").agg(F.sum("count").alias("count"))


def _discounts(counts: np.ndarray) -> np.ndarray:
    """Three discounts for counts of one, two and more, by counts of counts."""
    n1, n2, n3, n4 = (float(np.sum(counts == k)) for k in (1, 2, 3, 4))
    if not n1 or not n2:
        return np.asarray([0.5, 0.75, 0.9])
    y = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.clip(raw, 0.05, [0.95, 1.9, 2.9])


def _one_language(rows: dict[int, dict[str, np.ndarray]], alphabet: int) -> tuple[list, list]:
    """For each order the n-grams with their probabilities, and the contexts with their weights."""
    probabilities: list[tuple[np.ndarray, np.ndarray]] = []
    weights: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(1, np.uint64), np.ones(1))]
    top = max(rows)
    for n in range(1, top + 1):
        row = rows[n]
        if n == top:
            grams, counts, context, inner = row["gram"], row["count"].astype(float), row["context"], row["inner"]
        else:  # in how many ways each n-gram is continued to the left
            above = rows[n + 1]
            grams, counts = tally(above["inner"])
            at = find(grams, row["gram"])
            order = np.full(len(grams), -1)
            order[at[at >= 0]] = np.flatnonzero(at >= 0)
            extra = np.flatnonzero(at < 0)  # seen at the very beginning of texts only
            keep = order >= 0
            grams, counts, order = grams[keep], counts[keep].astype(float), order[keep]
            grams = np.concatenate([grams, row["gram"][extra]])
            counts = np.concatenate([counts, np.ones(len(extra))])
            order = np.concatenate([order, extra])
            context, inner = row["context"][order], row["inner"][order]
        cut = _discounts(counts)[np.minimum(counts, 3).astype(int) - 1]
        contexts, place = np.unique(context, return_inverse=True)
        total = np.bincount(place, counts)
        weight = np.bincount(place, cut) / total
        if n == 1:
            lower = np.full(len(grams), 1.0 / alphabet)
            weights[0] = (np.zeros(1, np.uint64), weight)
        else:
            below, values = probabilities[-1]
            lower = values[find(below, inner)]
            weights.append((contexts, weight))
        p = (counts - cut) / total[place] + weight[place] * lower
        order = np.argsort(grams)
        probabilities.append((grams[order], p[order]))
    return probabilities, weights


def _taken(values: np.ndarray, at: np.ndarray, other: float) -> np.ndarray:
    """The values at places, or another one at place -1."""
    return np.append(values, other)[at]


def fit(counts: dict[str, dict[int, dict[str, np.ndarray]]], single: np.ndarray) -> Block:
    """A block of counts by language and order, in the order of the languages' names; a language may lack the higher orders.

    ``single`` has the n-grams of one letter of all languages, also of those not in the block, so
    that a letter weighs the same in whatever block.
    """
    languages = sorted(counts)
    model, alphabet = Block(languages), len(single) + 1
    fitted = [_one_language(counts[x], alphabet) for x in languages]
    nothing = (np.zeros(0, np.uint64), np.zeros(0))
    for probabilities, weights in fitted:
        probabilities += [nothing] * (ORDER - len(probabilities))
        weights += [nothing] * (ORDER - len(weights))
    for n in range(1, ORDER + 1):
        having = [counts[x][n] for x in languages if n in counts[x]]
        union, index = np.unique(np.concatenate([x["gram"] for x in having] or [nothing[0]]), return_index=True)
        parts = {k: np.concatenate([x[k] for x in having] or [nothing[0]])[index] for k in ("context", "inner")}
        union = single if n == 1 else union
        contexts = np.unique(np.concatenate([f[1][n - 1][0] for f in fitted]))
        weight = np.zeros((len(contexts), len(languages)))
        logs = np.zeros((len(union), len(languages)))
        for k, (probabilities, weights) in enumerate(fitted):
            at = find(weights[n - 1][0], contexts)
            weight[:, k] = np.log10(_taken(weights[n - 1][1], at, 1.0))
            at = find(probabilities[n - 1][0], union)
            if n == 1:
                back = np.log10(weights[0][1][0] / alphabet) * np.ones(len(union))
            else:
                back = weight[find(contexts, parts["context"]), k] + model.logs[-1][model.grams[-1].find(parts["inner"]), k]
            logs[:, k] = np.where(at >= 0, np.log10(_taken(probabilities[n - 1][1], at, 1.0)), back)
        model.grams.append(HashIndex(union))
        model.logs.append(logs.astype(np.float32))
        model.contexts.append(HashIndex(contexts))
        model.weights.append(weight.astype(np.float32))
    return model


#: Sharpnesses of which the one that fits best is taken.
SHARPNESS = 2.0 ** np.arange(-6, 5)


def _sample(labelled: DataFrame, rows: int, letters_: int) -> DataFrame:
    """Rows of each language by the order of a hash, the longest last, within both bounds; ``calibrating`` for one in ``CALIBRATE``."""
    size = F.char_length("text")
    sizes = labelled.groupBy("lang").agg(F.count("*").alias("rows"))
    few = sizes.count() <= SENT
    chance = F.pmod(F.xxhash64("text", "key"), F.lit(1 << 30)) / (1 << 30)
    keyed = labelled.withColumns({"chance": chance, "size": size, "long": size > letters_ // 10})
    likely = keyed.join(F.broadcast(sizes) if few else sizes, "lang").where(F.col("long") | (F.col("chance") * F.col("rows") < 1.5 * rows + 30))
    # Repeated rows without a key share one chance; any of them may stand for the others.
    in_order = Window.partitionBy("lang").orderBy("long", "chance", "text")
    ranked = likely.withColumn("rank", F.row_number().over(in_order)).where(F.col("rank") <= rows)
    before = F.coalesce(F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    kept = ranked.withColumn("before", before).where(F.col("before") < letters_)
    return kept.select("lang", "text", (F.col("rank") % CALIBRATE == 0).alias("calibrating"))


def _blocks(counted: DataFrame, cells: int) -> Iterator[list[str]]:
    """Languages by name in blocks of at most so many n-grams times languages, or of one."""
    names: list[str] = []
    grams = 0
    for row in counted.groupBy("lang").agg(F.count("*").alias("grams")).orderBy("lang").toLocalIterator():
        if names and (grams + row["grams"]) * (len(names) + 1) > cells:
            yield names
            names, grams = [], 0
        names, grams = [*names, row["lang"]], grams + row["grams"]
    if names:
        yield names


def _block(counted: DataFrame, languages: list[str], single: np.ndarray) -> Block:
    table = counted.where(F.col("lang").isin(*languages)).toArrow()
    counts: dict[str, dict[int, dict[str, np.ndarray]]] = {}
    place = pc.index_in(table["lang"], pa.array(languages)).to_numpy()
    orders = table["n"].to_numpy()
    for k, name in enumerate(languages):
        counts[name] = {}
        for n in range(1, ORDER + 1):
            own = np.flatnonzero((place == k) & (orders == n))
            if len(own):
                columns = {c: table[c].to_numpy()[own].view(np.uint64) for c in ("gram", "context", "inner")}
                columns["count"] = table["count"].to_numpy()[own]
                order = np.argsort(columns["gram"])
                counts[name][n] = {c: v[order] for c, v in columns.items()}
    return fit(counts, single)


def learn(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    rows: int = ROWS_PER_LANGUAGE,
    letters_per_language: int = LETTERS_PER_LANGUAGE,
    cells: int = CELLS,
) -> Model:
    """A model of the labelled rows; ``key`` only makes the choice of the sample one of rows, not of texts."""
    labelled = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.col(key).alias("key"))
    sample = cut(_sample(labelled.where("lang is not null and text is not null"), rows, letters_per_language))
    counted = cut(_counts(sample.where("not calibrating").select("lang", "text")))
    letters_ = counted.where("n = 1").select("gram").distinct().toArrow()["gram"]  # no more than there are letters
    single = np.sort(letters_.to_numpy().view(np.uint64))
    model = Model([_block(counted, names, single) for names in _blocks(counted, cells)])
    if model.blocks:
        _calibrate(model, sample.where("calibrating").select("lang", "text"))
    return model


def _calibrate(model: Model, held: DataFrame) -> None:
    """Limits of cross-entropy by language, and the sharpness under which the scores fit best, from rows not counted."""
    scored = cut(_compared(held.select(F.struct(F.col("lang").alias("truth"), "text").alias("row")), model, SHARPNESS, "text", "truth").where("n_letters > 0 and own is not null").withColumn("row", F.struct("row.truth")))
    quantiles = F.percentile("own", F.array(F.lit(0.5), F.lit(0.99))).alias("q")
    judged = scored.where("n_letters >= 20")
    overall = judged.agg(quantiles).first()["q"] or [2.0, 3.0]
    of = {r["truth"]: r["q"] for r in judged.groupBy(F.col("row.truth").alias("truth")).agg(quantiles).collect()}
    for block in model.blocks:
        middle, high = np.asarray([of.get(name) or overall for name in block.languages]).T
        block.mean, block.spread = middle, np.maximum(0.05, (high - middle) / 2.33)
    losses = []
    for k, sharpness in enumerate(SHARPNESS.tolist()):
        gap = F.least((F.col("own") - F.col("lowest")) * sharpness * F.sqrt("n_letters"), F.lit(300.0))
        chance = F.pow(F.lit(10.0), -gap) / F.col("sums")[k]
        losses.append(F.avg(-F.log(F.greatest(chance, F.lit(1e-12)))).alias(f"loss{k}"))
    loss = list(scored.agg(*losses).first())
    model.sharpness = 1.0 if loss[0] is None else float(SHARPNESS[int(np.argmin(loss))])


_STATE = "best string, lowest double, far boolean, n_letters bigint, own double, sums array<double>"


def _compared(rows: DataFrame, model: Model, sharpness: np.ndarray, text: str = "text", truth: str | None = None) -> DataFrame:
    """``row`` with the best language of its field ``text``, its cross-entropy and whether it is far, after all blocks.

    ``sums`` adds up, for each sharpness, the chances of all languages over that of the best;
    ``own`` is the cross-entropy in the language that field ``truth`` of the row names.
    """
    names = [part.strip().split(" ")[0] for part in _STATE.split(",")]
    kinds = T._parse_datatype_string(_STATE)
    frame = rows.select("row", *(F.lit(None).cast(f.dataType).alias(f.name) for f in kinds.fields))
    schema = T.StructType([*rows.select("row").schema.fields, *kinds.fields])
    for block in model.blocks:
        frame = frame.mapInArrow(_through(rows.sparkSession.sparkContext.broadcast(block), sharpness, text, truth, names), schema)
    return frame


def _through(shared, sharpness: np.ndarray, text: str, truth: str | None, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        languages = np.asarray(block.languages, object)
        for batch in batches:
            texts = batch.column("row")
            for name in text.split("."):
                texts = texts.field(name)
            for at, data, edges in slices(texts):
                part = batch.slice(at, len(edges) - 1)
                entropy, n_letters = block.entropies(data, edges)
                n = len(entropy)
                here = np.argmin(entropy, axis=1)
                low = entropy[np.arange(n), here]
                before = part.column("lowest").to_numpy(zero_copy_only=False).astype(float)
                lowest = np.fmin(before, low)
                scale = sharpness[None, :] * np.sqrt(np.maximum(n_letters, 1))[:, None]
                held = part.column("sums")
                sums_ = np.zeros((n, len(sharpness)))
                if n and held.null_count < n:
                    sums_ = held.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
                    sums_ = sums_ * 10.0 ** -np.minimum((before - lowest)[:, None] * scale, 300.0)
                for k in range(len(languages)):
                    sums_ = sums_ + 10.0 ** -np.minimum((entropy[:, k] - lowest)[:, None] * scale, 300.0)
                better = np.isnan(before) | (low < before)
                far = np.zeros(n, bool)
                if block.mean is not None:
                    room = MARGIN * block.spread[here] * np.maximum(1.0, np.sqrt(100.0 / np.maximum(n_letters, 1)))
                    far = low > block.mean[here] + room
                best = pc.if_else(pa.array(better), pa.array(languages[here], pa.string()), part.column("best"))
                far = pc.if_else(pa.array(better), pa.array(far), part.column("far"))
                own = part.column("own").to_numpy(zero_copy_only=False).astype(float)
                if truth:
                    place = {name: k for k, name in enumerate(block.languages)}
                    mine = np.asarray([place.get(x, -1) for x in part.column("row").field(truth).to_pylist()], int)
                    own = np.where(mine >= 0, entropy[np.arange(n), mine], own)
                state = {
                    "best": best,
                    "lowest": pa.array(lowest),
                    "far": far,
                    "n_letters": pa.array(n_letters),
                    "own": pa.array(own, mask=np.isnan(own)),
                    "sums": pa.array(list(sums_), pa.list_(pa.float64())),
                }
                yield pa.record_batch([part.column("row"), *(state[x] for x in names)], ["row", *names])

    return run


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with ``lang_pred``, ``score``, ``cross_entropy`` and ``rejected`` added, replacing such columns.

    ``text`` names a column, or a field of a struct with its path in dots.
    """
    docs = docs.drop("lang_pred", "score", "cross_entropy", "rejected")
    rows = docs.select(F.struct(*docs.columns).alias("row"))  # the text goes through once, within its row
    found = _compared(rows, model, np.asarray([model.sharpness]), text)
    known = F.coalesce(F.col("n_letters") > 0, F.lit(False))
    return found.select(
        "row.*",
        F.when(known, F.col("best")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(known, 1.0 / F.col("sums")[0]).otherwise(0.0).alias("score"),
        F.when(known, F.col("lowest")).alias("cross_entropy"),
        (~known | F.coalesce("far", F.lit(True))).alias("rejected"),
    )


def held_out(doc_id: str | Column, parts: int) -> Column:
    """True for the rows that train nothing: the remainder of the id's CRC-32 is 0; a null id trains."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == 0, F.lit(False))
