"""Exact top-k search by inner product with multi-resolution segment statistics.

Vectors are whole numbers, floor(256 * x) of each component. They are cut into ever more
segments (``LEVELS``); a segment's mean and deviation bound the distance of two vectors from below,
``sum(w * ((mean - mean')**2 + (dev - dev')**2))``, and with the norms, which are the same sums,
the inner product from above: ``sum(w * (mean * mean' + dev * dev'))``. The coarsest bounds, of few numbers each, come first, for all pairs of a
block: the rows with the best of them are scored exactly and give each query's threshold, the k-th
best of those scores. A pair whose bound is below it is dropped. Each finer level is computed for the pairs that the levels before
it have left, the exact product for those that all have left: pair by pair where they are few, else as a product
over the rows and queries that still have one. Bounds get a margin for rounding, so nothing is lost. On
vectors without structure the coarse levels drop few pairs and cost as much as half the exact products.

Queries and rows are dealt into blocks of bounded size by a hash, and each pair of blocks is one
group; every group gives at most k rows per query, of which the best k stay.

Defined cases: vectors that are null, or hold a null or non-finite component, take no part; a
repeated row (id and vector) counts once; rows without an id are candidates of no rank and take
no part either; a row is no candidate of queries with its own id; only vectors of the same number
of components are compared; ties go to the smaller id, then to the smaller hash of the vector;
components and scores are kept within 64 bits; empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterline.workspace import materialize

LEVELS = (2, 4, 8, 16)
BLOCK_ROWS = 8192
BLOCK_QUERIES = 1024
# Queries that share one matrix of bounds inside a task.
TOGETHER = 128
PAIRS = 1 << 18
# Below this share of its pairs a block's products are computed pair by pair.
FEW = 0.05
EXACT = float(1 << 53)
LIMITS = (-float(1 << 63), float(1 << 63))
_OUT = "query_id long, query_hash long, vec_id long, hash long, score long"
_ARROW = pa.schema([(name.split()[0], pa.int64()) for name in _OUT.split(", ")])


def whole_numbers(vector: Column) -> Column:
    """floor(256 * x) of each component, or null if the vector takes no part."""
    real = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(real, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(fine, F.transform(real, lambda x: F.floor(x * 256)))


def segment_features(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of the segments, times the root of the segment's width.

    The inner product of two rows bounds that of their vectors from above.
    """
    d = x.shape[1]
    bounds = np.unique(np.linspace(0, d, min(segments, d) + 1).astype(int))
    width = np.diff(bounds)
    mean = np.add.reduceat(x, bounds[:-1], axis=1) / width
    centred = x - np.repeat(mean, width, axis=1)
    return np.hstack([mean * np.sqrt(width), np.sqrt(np.add.reduceat(centred * centred, bounds[:-1], axis=1))])


def exact_scores(q: np.ndarray, x: np.ndarray, qi: np.ndarray, xi: np.ndarray) -> np.ndarray:
    """Inner products of the pairs (qi, xi) of integer rows, exact, within 64 bits."""
    out = np.empty(len(qi), np.int64)
    largest = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    if largest < EXACT:
        qf, xf = q.astype(float), x.astype(float)
        for begin in range(0, len(qi), PAIRS):
            part = slice(begin, begin + PAIRS)
            out[part] = np.einsum("ij,ij->i", qf[qi[part]], xf[xi[part]]).astype(np.int64)
        return out
    low, high = -(1 << 63), (1 << 63) - 1
    for n, (a, b) in enumerate(zip(qi, xi)):
        out[n] = min(high, max(low, sum(int(s) * int(t) for s, t in zip(q[a], x[b]))))
    return out


def _of_pairs(q: np.ndarray, x: np.ndarray, alive: np.ndarray) -> np.ndarray:
    """The inner products of the pairs that ``alive`` marks, in its order."""
    qi, xi = np.nonzero(alive)
    if len(qi) < FEW * alive.size:
        out = np.empty(len(qi))
        for begin in range(0, len(qi), PAIRS):
            part = slice(begin, begin + PAIRS)
            out[part] = np.einsum("ij,ij->i", q[qi[part]], x[xi[part]])
        return out
    rows, columns = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
    return (q[rows] @ x[columns].T)[alive[np.ix_(rows, columns)]]


def search(
    q: np.ndarray, query_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, hashes: np.ndarray, k: int, left: list[int] | None = None,
) -> tuple[np.ndarray, ...]:
    """(query row, row, score) of the k best rows of every query.

    ``left``, if given, gets the number of pairs in all and after each level added.
    """
    found: list[tuple[np.ndarray, ...]] = []
    if not x.shape[1] or not len(x):
        qi, xi = (a.reshape(-1) for a in np.indices((len(q), len(x))))
        other = query_ids[qi] != ids[xi]
        return _best(qi[other], xi[other], np.zeros(int(other.sum()), np.int64), ids, hashes, k)
    left = [] if left is None else left
    left += [0] * (len(LEVELS) + 1 - len(left))
    qf, xf = q.astype(float), x.astype(float)
    levels = [(segment_features(qf, s), segment_features(xf, s)) for s in LEVELS]
    norm_q, norm_x = np.sqrt((qf * qf).sum(axis=1)), np.sqrt((xf * xf).sum(axis=1))
    small = float(np.abs(qf).max(initial=0)) * float(np.abs(xf).max(initial=0)) * q.shape[1] < EXACT
    for begin in range(0, len(q), TOGETHER):
        part = slice(begin, begin + TOGETHER)
        own = query_ids[part][:, None] == ids[None, :]
        coarse = levels[0][0][part] @ levels[0][1].T
        coarse[own] = -np.inf
        # A first threshold from the rows with the best coarse bounds.
        some = min(len(x), max(8 * k, len(x) // 64))
        rows = np.argpartition(-coarse, some - 1, axis=1)[:, :some]
        qi = np.repeat(np.arange(len(rows)), some)
        seen = exact_scores(q[part], x, qi, rows.reshape(-1)).astype(float).reshape(rows.shape)
        seen[np.take_along_axis(own, rows, 1)] = -np.inf
        threshold = -np.partition(-seen, min(k, some) - 1, axis=1)[:, min(k, some) - 1] if some >= k else np.full(len(rows), -np.inf)
        margin = 1e-9 * norm_q[part][:, None] * norm_x[None, :] + 1e-6
        alive = ~own & (np.clip(coarse + margin, *LIMITS) >= threshold[:, None])  # as scores are
        left[0] += alive.size
        left[1] += int(alive.sum())
        for level, (of_queries, of_rows) in enumerate(levels[1:], 2):
            qi, xi = np.nonzero(alive)
            bound = np.clip(_of_pairs(of_queries[part], of_rows, alive) + margin[qi, xi], *LIMITS)
            kept = bound >= threshold[qi]
            alive[qi[~kept], xi[~kept]] = False
            left[level] += int(kept.sum())
        qi, xi = np.nonzero(alive)
        scores = _of_pairs(qf[part], xf, alive).astype(np.int64) if small else exact_scores(q[part], x, qi, xi)
        good = scores.astype(float) >= threshold[qi] * (1 - 1e-15 * np.sign(threshold[qi]))
        best = _best(qi[good], xi[good], scores[good], ids, hashes, k)
        found.append((best[0] + begin, *best[1:]))
    return tuple(np.concatenate([f[n] for f in found]) if found else np.empty(0, np.int64) for n in range(3))


def _best(qi, xi, scores, ids, hashes, k):
    order = np.lexsort((hashes[xi], ids[xi], ~scores, qi))  # ~ descends without overflow
    qi, xi, scores = qi[order], xi[order], scores[order]
    first = np.searchsorted(qi, qi, side="left")
    top = np.arange(len(qi)) - first < k
    return qi[top], xi[top], scores[top]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return values.reshape(len(lists), len(values) // max(len(lists), 1))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best rows of ``vectors`` for each of ``queries``.

    Both have vec_id and embedding.
    """
    def usable(df: DataFrame, label: str) -> DataFrame:
        rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), whole_numbers(F.col("embedding")).alias("v"))
        rows = rows.filter("vec_id IS NOT NULL AND v IS NOT NULL").distinct()
        return materialize(rows.select("vec_id", "v", F.xxhash64("v").alias("hash"), F.size("v").alias("d")), label)

    rows, asked = usable(vectors, "topk-rows"), usable(queries, "topk-queries")
    n_rows, n_asked = max(1, -(-rows.count() // block_rows)), max(1, -(-asked.count() // block_queries))

    def dealt(df: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        block = F.pmod(F.xxhash64("vec_id", "hash"), F.lit(n_own)).cast("int").alias(own)
        return df.select("*", block, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other))

    keys = ("d", "q_block", "x_block")
    left = dealt(asked, "q_block", n_asked, "x_block", n_rows).groupBy(*keys)
    right = dealt(rows, "x_block", n_rows, "q_block", n_asked).groupBy(*keys)

    def run(q: pa.Table, x: pa.Table) -> pa.Table:
        if not q.num_rows or not x.num_rows:
            return _ARROW.empty_table()
        ids, hashes = x["vec_id"].to_numpy(), x["hash"].to_numpy()
        qi, xi, scores = search(_matrix(q["v"]), q["vec_id"].to_numpy(), _matrix(x["v"]), ids, hashes, k)
        return pa.table([q["vec_id"].to_numpy()[qi], q["hash"].to_numpy()[qi], ids[xi], hashes[xi], scores], schema=_ARROW)

    best = left.cogroup(right).applyInArrow(run, _OUT)
    order = W.partitionBy("query_id", "query_hash").orderBy(F.col("score").desc(), "vec_id", "hash")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
