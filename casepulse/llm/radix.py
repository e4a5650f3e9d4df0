"""Ranks of all rows by a distributed least-significant-digit radix sort.

Sort keys are mapped to unsigned numbers and laid side by side into one composite key, of which
each pass sorts one digit, the least significant first. A pass is a stable counting sort: rows lie
in blocks of neighbouring places, digits are counted by block, and a prefix sum over (digit,
block) is the first place that the rows of a digit and block move to; inside a block a row moves
on by the number of rows of its digit before it. Rows of one block meet in one task, however many
share a digit, and only the counts of a digit are ever summed in one place. After the last pass
the place of a row is its rank.

Keys are BIGINT columns; a null comes after all numbers. Rows that are equal in all keys keep the
order of the table. Digits in which no two rows can differ are not sorted. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casepulse.llm.store import cut

DIGIT_BITS, BLOCK_BITS = 10, 14


def _unsigned(name: str, ascending: bool, low: int | None, high: int | None, nulls: int) -> tuple[Column, int]:
    """The key as a number from zero, later rows with greater ones, and its width in bits."""
    if low is None:
        return F.lit(0).cast("bigint"), 0
    if high - low + 1 < 1 << 63:
        number = F.col(name) - F.lit(low) if ascending else F.lit(high) - F.col(name)
        return F.coalesce(number, F.lit(high - low + 1)), (high - low + (nulls > 0)).bit_length()
    if nulls:
        raise ValueError(f"{name} holds nulls and spans over 63 bits")
    turned = F.col(name).bitwiseXOR(F.lit(-(1 << 63)))
    return turned if ascending else F.bitwise_not(turned), 64


def _digit(parts: list[tuple[str, int]], number: int) -> Column:
    """Digit ``number`` of the composite of ``parts`` (column, bits), of which the last is the least significant."""
    out, offset = F.lit(0).cast("bigint"), 0
    mask = (1 << DIGIT_BITS) - 1
    for name, bits in reversed(parts):
        shift = number * DIGIT_BITS - offset
        if -DIGIT_BITS < shift < bits:
            # Cut to the digit before it is moved up, so that nothing overflows.
            moved = F.shiftrightunsigned(name, shift) if shift >= 0 else F.shiftleft(F.col(name).bitwiseAND(mask >> -shift), -shift)
            out = out.bitwiseOR(moved.bitwiseAND(mask))
        offset += bits
    return out.cast("int")


def _moved(names: list[str]):
    """The rows of one block at the places that the offsets of the block give them."""

    def run(rows: pa.Table, offsets: pa.Table) -> pa.Table:
        rows = rows.take(pc.sort_indices(rows["place"]))
        digit = rows["digit"].to_numpy()
        first = np.zeros(1 << DIGIT_BITS, np.int64)
        first[offsets["digit"].to_numpy()] = offsets["offset"].to_numpy()
        order = np.argsort(digit, kind="stable")
        run_of = digit[order]
        began = np.searchsorted(run_of, run_of, side="left")
        place = np.empty(len(digit), np.int64)
        place[order] = first[run_of] + np.arange(len(digit)) - began
        return rows.select(names).add_column(0, "place", pa.array(place))

    return run


def _pass(rows: DataFrame, digit: Column) -> DataFrame:
    names = [name for name in rows.columns if name != "place"]
    keyed = rows.withColumns({"digit": digit, "block": F.shiftright("place", BLOCK_BITS)})
    counts = cut(keyed.groupBy("digit", "block").agg(F.count("*").alias("n")))
    totals = dict(counts.groupBy("digit").agg(F.sum("n")).collect())  # one row for each value of a digit
    begin = np.cumsum([0, *(totals.get(d, 0) for d in range((1 << DIGIT_BITS) - 1))])
    begins = F.element_at(F.array(*(F.lit(int(b)) for b in begin)), F.col("digit") + 1)
    before = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("digit", "block", (begins + F.coalesce(F.sum("n").over(before), F.lit(0))).alias("offset"))
    kinds = ", ".join(f"{name} bigint" for name in ["place", *names])
    return cut(keyed.groupBy("block").cogroup(offsets.groupBy("block")).applyInArrow(_moved(names), kinds))


def ranked(rows: DataFrame, row: str, keys: Sequence[tuple[str, bool]]) -> DataFrame:
    """Column ``row`` (BIGINT) and ``rank`` from 1 of all rows in the order of ``keys``: (name, ascending), the first weighs most."""
    least = [F.min(name).alias(f"low{i}") for i, (name, _) in enumerate(keys)]
    most = [F.max(name).alias(f"high{i}") for i, (name, _) in enumerate(keys)]
    nulls = [F.count_if(F.col(name).isNull()).alias(f"nulls{i}") for i, (name, _) in enumerate(keys)]
    span = rows.agg(*least, *most, *nulls).first()
    columns, parts = {}, []
    for i, (name, ascending) in enumerate(keys):
        columns[f"key{i}"], bits = _unsigned(name, ascending, span[f"low{i}"], span[f"high{i}"], span[f"nulls{i}"])
        parts.append((f"key{i}", bits))
    chosen = rows.select(F.col(row).alias("row"), *(c.alias(k) for k, c in columns.items()))
    placed = cut(chosen.withColumn("place", F.monotonically_increasing_id()))
    width = sum(bits for _, bits in parts)
    for number in range(max(1, -(-width // DIGIT_BITS))):  # one pass at least: it numbers the rows
        placed = _pass(placed, _digit(parts, number))
    return placed.select(F.col("row").alias(row), (F.col("place") + 1).alias("rank"))
