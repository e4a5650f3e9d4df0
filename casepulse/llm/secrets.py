"""Secrets in texts: known shapes, and random strings by how badly a tokenizer packs them.

Text that people write falls into long tokens of a byte-pair vocabulary; random strings do not.
A run of letters, digits and marks is taken as a secret if it yields few characters for each
token, without the words at its ends; otherwise each of its parts between marks is looked at, so
that words before a secret do not hide it. Digests of the usual lengths, universally unique
identifiers and plain numbers are left out; names made of words are dense enough to pass.

Spans are in code points, the end exclusive. Those of known shapes always stay, whatever the
test says of them, and of a run that overlaps them the rest is looked at. Null and empty texts have no
spans. Repeated rows keep their rows, a null id is carried along, and columns other than the id
and the text are not looked at. Empty tables give empty results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The known shapes, in the order in which their spans are listed, and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
# Words of which one stands in every assignment, as they are looked for first.
NAMED = re.compile(r"passw|secret|token|api_?key", re.IGNORECASE | re.ASCII)

#: Runs and parts of them that the tokenizer test looks at, and the characters for each token below which they are random.
LEAST_RUN, RATIO = 16, 2.0
RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
PART = re.compile(r"[A-Za-z0-9]+")
DIGESTS = (32, 40, 48, 56, 64, 96, 128)
UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
HEXADECIMAL = re.compile(r"[0-9a-fA-F]+")
#: Characters that are split into tokens at once.
PIECE = 1024


@lru_cache(1)
def _encoding(path: str):
    """The vocabulary of a ranks file, kept for each Python worker."""
    import base64

    import tiktoken

    from casepulse.llm.packing import Encoder

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=Encoder.PATTERN, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Start, end and kind of each known shape, by start and then in the order of the kinds."""
    found = []
    if NAMED.search(text):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def dense(run: str, encoding, ratio: float = RATIO) -> bool:
    """Whether a run has as many characters for each token as language has; long runs are split piece by piece."""
    tokens = sum(len(encoding.encode_ordinary(run[i : i + PIECE])) for i in range(0, len(run), PIECE))
    return len(run) >= ratio * tokens


def is_random(run: str, encoding, ratio: float = RATIO) -> bool:
    """Whether a run is neither known nor dense enough to be language."""
    if len(run) < LEAST_RUN or not re.search("[A-Za-z]", run) or UUID.fullmatch(run):
        return False
    if HEXADECIMAL.fullmatch(run) and len(run) in DIGESTS:
        return False
    return not dense(run, encoding, ratio)


def random_parts(run: str, encoding, ratio: float = RATIO) -> list[tuple[int, int]]:
    """Start and end of what is random in a run: the whole of it without words at its ends, or parts between marks."""
    parts = [m.span() for m in PART.finditer(run)]
    if not is_random(run, encoding, ratio):
        inner = parts if len(parts) > 1 or parts != [(0, len(run))] else []
        return [(a, b) for a, b in inner if b - a >= LEAST_RUN and is_random(run[a:b], encoding, ratio)]
    wordy = [run[a:b].isalpha() and dense(run[a:b], encoding, ratio) for a, b in parts]
    first, last = 0, len(parts) - 1
    while first < last and wordy[first]:
        first += 1
    while last > first and wordy[last]:
        last -= 1
    # Marks belong to the secret where no word was taken away.
    a = 0 if first == 0 else parts[first][0]
    b = len(run) if last == len(parts) - 1 else parts[last][1]
    return [(a, b)] if is_random(run[a:b], encoding, ratio) else [(0, len(run))]


def spans(text: str, encoding, ratio: float = RATIO) -> list[tuple[int, int, str]]:
    """Base spans and what is random outside of them, in one sweep over both."""
    known = base_spans(text)
    more, k = [], 0
    for m in RUN.finditer(text):
        at, end = m.span()
        while k < len(known) and known[k][1] <= at:
            k += 1
        # Base spans may overlap one another, so the next run begins with the first that reaches it.
        j = k
        while at < end:
            stop = min(end, known[j][0]) if j < len(known) else end
            if stop - at >= LEAST_RUN:
                more += [(at + a, at + b, "random") for a, b in random_parts(text[at:stop], encoding, ratio)]
            if j == len(known) or known[j][0] >= end:
                break
            at = max(at, known[j][1])
            j += 1
    order = (*KINDS, "random")
    return sorted([*known, *more], key=lambda s: (s[0], order.index(s[2])))


SPAN = "array<struct<kind: string, start: bigint, end: bigint>>"


def find_secrets(docs: DataFrame, ranks: str, doc_id: str = "doc_id", text: str = "text", ratio: float = RATIO) -> DataFrame:
    """``doc_id`` and ``spans``, ordered by start and kind, a row for each row.

    ``ranks`` is the path of a file of token ranks that every executor can open.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(ranks)
        for batch in batches:
            rows = [
                [{"kind": k, "start": a, "end": b} for a, b, k in spans(value.as_py() or "", encoding, ratio)]
                for value in batch.column(1)
            ]
            yield pa.record_batch([batch.column(0), pa.array(rows, pa.list_(span))], ["doc_id", "spans"])

    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(run, f"doc_id {kind}, spans {SPAN}")


def listed(spans_: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    one = F.transform(spans_, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")


def base_only(spans_: Column) -> Column:
    return F.filter(spans_, lambda s: s["kind"] != "random")


def number(spans_: Column, kind: str) -> Column:
    return F.size(F.filter(spans_, lambda s: s["kind"] == kind)).cast("bigint")
