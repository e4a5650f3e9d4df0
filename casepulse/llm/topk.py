"""Exact top-k inner products by the threshold algorithm over sorted lists of each dimension.

Rows are dealt over shards of at most about ``SHARD``, each with its rows sorted once by every
dimension. A query reads those lists from the end that its sign favours, one step of places in all
of them at a time, and scores every row it meets for the first time. What it has not met cannot
score more than the sum over dimensions of the query's component times the value read last; when
that falls below the kth score met, the rest of the shard is left unread. The shards go in rounds,
one, then eight times as many as before, and a round starts from the kth score of the rounds
before it, which no row of the answer falls short of.

Vectors that are null or hold null or non-finite components take no part; vectors of different
lengths are not compared. A row is never compared with itself, but with rows equal to it. Ties go
to the smaller id, a null id last. Fewer rows than k give all of them. Components are rounded down
to integers and scores are exact; a score beyond BIGINT fails with OverflowError. Other columns
are not looked at. Empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casepulse.llm.store import cut
from casepulse.llm.vectors import integers, matrix

SHARD, BLOCK = 4096, 4096
STEP, WIDER = 32, 8
NO_BOUND = -(1 << 63)


def exact(values: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same integers in the fastest kind of number in which their products add up exactly."""
    most = max(max(-int(v.min(initial=0)), int(v.max(initial=0))) for v in (values, others))
    total = most * most * max(1, values.shape[1])
    kind = np.float64 if total < 1 << 53 else np.int64 if total < 1 << 63 else object
    return values.astype(kind), others.astype(kind)


class Lists:
    """The rows of a shard, in the order that breaks ties, and their places sorted by every dimension."""

    def __init__(self, values: np.ndarray) -> None:
        self.values = values
        self.order = np.ascontiguousarray(np.argsort(values.astype(np.float64) if values.dtype == object else values, axis=0, kind="stable").T)
        self.sorted = np.stack([values[o, j] for j, o in enumerate(self.order)]) if values.size else values.T

    def top(self, query: np.ndarray, k: int, own: int = -1, bound: int = NO_BOUND) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k best rows but ``own`` that reach ``bound``, best first."""
        n = len(self.values)
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        met = np.zeros(n, bool)
        if own >= 0:
            met[own] = True
        best, scores = np.zeros(0, np.int64), np.zeros(0, self.values.dtype)
        at, step = 0, STEP
        while at < n:
            to = min(n, at + step)
            before = met.copy()
            if len(up) or len(down):
                met[self.order[up, n - to : n - at].ravel()] = True
                met[self.order[down, at:to].ravel()] = True
            else:
                met[:] = True  # every row scores zero
            new = np.flatnonzero(met & ~before)
            best = np.concatenate([best, new])
            scores = np.concatenate([scores, self.values[new] @ query])
            level = np.unique(scores, return_inverse=True)[1] if scores.dtype == object else scores
            chosen = np.lexsort((best, -level))[:k]
            best, scores = best[chosen], scores[chosen]
            unread = query[up] @ self.sorted[up, n - to] + query[down] @ self.sorted[down, to - 1]
            if unread < bound or (len(best) == k and unread < scores[-1]):
                break
            at, step = to, step * 2
        reach = scores >= bound
        return best[reach], scores[reach]


def _answers(k: int):
    def run(key: tuple, rows: pa.Table, queries: pa.Table) -> pa.Table:
        query_of, places, score_of, held = [], [], [], np.zeros(0, np.int64)
        if len(rows) and len(queries):
            dims = key[0].as_py()
            values, asked = exact(matrix(rows["values"], dims), matrix(queries["asked_values"], dims))
            place = rows["place"].to_numpy()
            ids = rows["vec_id"].fill_null(0).to_numpy()
            held = np.lexsort((place, ids, rows["vec_id"].is_null().to_numpy()))
            lists = Lists(values[held])
            where = {p: i for i, p in enumerate(place[held].tolist())}
            for query, own, bound in zip(asked, queries["asked_place"].to_pylist(), queries["bound"].to_pylist(), strict=True):
                found, scores = lists.top(query, k, where.get(own, -1), bound)
                query_of += [own] * len(found)
                places += found.tolist()
                score_of += [int(x) for x in scores]
        chosen = rows.select(["place", "vec_id"]).take(pa.array(held[np.asarray(places, np.int64)]))
        return pa.table([pa.array(query_of, pa.int64()), *chosen.columns, pa.array(score_of, pa.int64())], ["query", "place", "vec_id", "score"])

    return run


def search(
    vectors: DataFrame,
    asked: Column,
    k: int = 10,
    scale: int = 1024,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    shard: int = SHARD,
    block: int = BLOCK,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` for the rows whose id satisfies ``asked``, a condition on ``vec_id``."""
    held = integers(vectors, scale, vec_id, embedding)
    held = cut(held.select(F.col("vec_id").cast("bigint"), "values", F.size("values").alias("dims"), F.monotonically_increasing_id().alias("place")))
    shards = max(1, -(-held.count() // shard))
    rows = held.withColumn("shard", F.pmod(F.xxhash64("place"), F.lit(shards)).cast("int"))
    queries = held.where(asked)
    blocks = max(1, -(-queries.count() // block))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("place"), F.lit(blocks)).cast("int"))
    in_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "place")
    found, begin = None, 0
    while begin < shards:
        end = min(shards, max(1, begin * WIDER))
        if found is None:
            bounded = queries.withColumn("bound", F.lit(NO_BOUND))
        else:
            last = found.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") == k)
            bound = F.coalesce("least", F.lit(NO_BOUND)).alias("bound")
            bounded = queries.join(last, queries.place == last["query"], "left").select(*queries.columns, bound)
        in_shard = F.explode(F.sequence(F.lit(begin), F.lit(end - 1)))
        left = rows.where(F.col("shard").between(begin, end - 1)).select("dims", "shard", in_block, "place", "vec_id", "values")
        renamed = [F.col(name).alias(f"asked_{name}") for name in ("dims", "block", "place", "values")]
        right = bounded.select(*renamed, "bound", in_shard.alias("asked_shard"))
        cells = left.groupBy("dims", "shard", "block").cogroup(right.groupBy("asked_dims", "asked_shard", "asked_block"))
        more = cells.applyInArrow(_answers(k), "query bigint, place bigint, vec_id bigint, score bigint")
        more = more if found is None else more.unionByName(found.drop("rank"))
        found = cut(more.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k))
        begin = end
    asking = queries.select(F.col("place").alias("query"), F.col("vec_id").alias("query_id"))
    return found.join(asking, "query").select("query_id", "rank", "vec_id", "score")
