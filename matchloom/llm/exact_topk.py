"""Exact top-k inner-product search by columnar branch and bound.

Candidates are laid out vertically: for a block of vectors, one contiguous row per
dimension. A batch of queries accumulates inner products one block of dimensions after
another; after each, a candidate can gain at most |query's rest| * |candidate's rest|
(Cauchy-Schwarz on the mass in the dimensions still to come), so pairs whose partial
score plus that bound is below the query's k-th best so far are dropped and the
survivors compacted. Dense blocks use matrix products; few survivors use gathered pairs.
Every query starts with a threshold: its k-th best score in a bounded sample of the
candidates, a lower bound of the true k-th best, so that partitions emit little. The
sample only saves work; every candidate is examined and results are exact.

Queries go in passes of at most PASS_BYTES, broadcast, over all candidates; candidates
are never shuffled. Per pass only each partition's best k a query move. A pass's pairs are
held for one batch of queries and one block of candidates, on the driver (sample) and in
tasks, and its broadcast goes when its results are stored.

Sums are exact in doubles where both vectors are narrow: components of at most
2**26 / sqrt(dimensions). Pairs with a wide vector are pruned in the same way with the
rounding error added to the bound, and their survivors are summed in whole numbers, so a
few wide rows cost what they cost and change nothing for the others.

Cases: vectors that are null, or hold null or non-finite components (before or after
scaling), and rows without an id, take no part; vectors meet vectors of their own length
only (empty ones score 0), of any number of dimensions; ties go to the smaller vec_id;
scores beyond 64 bits saturate before they are ranked; of several rows with a query's id
the smallest vector is the query, and no row with that id is its candidate; other repeated
rows each take a rank; empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import stored

K = 20
SCALE = 64
#: Rows divisible by this are queries.
QUERY_STEP = 20
#: Dimensions accumulated between two prunings, candidates in a block, queries in a batch.
DIMS, BLOCK, BATCH = 16, 4096, 256
#: Candidates in the sample that gives the first thresholds, and bytes of queries in one pass.
SAMPLE, PASS_BYTES = 2048, 32 << 20
_MAX, _MIN = (1 << 63) - 1, -(1 << 63)
#: Components beyond this have no usable squares in doubles.
_HUGE = 1e150


def wide(rows: np.ndarray) -> np.ndarray:
    """Which rows (quantised) are too large for exact sums in doubles, even with others that are not."""
    return np.abs(rows).max(axis=1, initial=0.0) > 2.0**26 / np.sqrt(max(1, rows.shape[1]))


def _whole(queries: np.ndarray, q: np.ndarray, vertical: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Saturated integer scores of these pairs."""
    left = {i: [int(x) for x in queries[i]] for i in np.unique(q).tolist()}
    right = {i: [int(x) for x in vertical[:, i]] for i in np.unique(c).tolist()}
    return np.array([min(max(sum(map(mul, left[i], right[j])), _MIN), _MAX) for i, j in zip(q.tolist(), c.tolist())], dtype=np.int64)


def search_block(q_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, c_ids: np.ndarray, vertical: np.ndarray, exact: bool = True, k: int | None = None):
    """(query index, candidate index, score) of all pairs that can be in a query's best k of this block.

    queries: (n, dims); vertical: (dims, m); floors: per query, a lower bound of its k-th
    best score; exact: whether all sums are exact in doubles; k: of dense blocks whose sums
    are exact, only a query's k best pairs and those equal to the k-th are listed.
    """
    dims, other = len(vertical), q_ids[:, None] != c_ids[None, :]
    if dims == 0 or not exact and max(np.abs(queries).max(initial=0.0), np.abs(vertical).max(initial=0.0)) > _HUGE:
        q, c = np.nonzero(other)
        return q, c, _whole(queries, q, vertical, c)
    # Mass left after each block of dimensions; rounded up a little, as bounds must not be too low.
    slack = 1 + 1e-9
    left_c = np.sqrt(np.cumsum((vertical**2)[::-1], axis=0)[::-1]) * slack
    left_q = np.sqrt(np.cumsum((queries**2)[:, ::-1], axis=1)[:, ::-1]) * slack
    error = np.zeros(len(queries)) if exact else left_q[:, 0] * (dims * 2.0**-50)
    most = left_c[0]
    alive = np.arange(vertical.shape[1])
    partial = np.zeros((len(queries), len(alive)))
    at = 0
    while at < dims:
        end = min(dims, at + DIMS)
        partial += queries[:, at:end] @ vertical[at:end, alive]
        at = end
        if at < dims:
            can = partial + left_q[:, at, None] * left_c[at, alive] + error[:, None] * most[alive] >= floors[:, None]
            stay = can.any(axis=0)
            if stay.mean() < 0.9:
                alive, partial, can = alive[stay], partial[:, stay], can[:, stay]
            if can.mean() < 0.1:
                break
    if at == dims:
        can = partial + error[:, None] * most[alive] >= floors[:, None]
        if exact and k and len(alive) > k and can.mean() * len(alive) > 2 * k:
            # The own k-th best of this block is a floor, too.
            can &= partial >= np.partition(np.where(other[:, alive], partial, -np.inf), len(alive) - k, axis=1)[:, len(alive) - k, None]
    can &= other[:, alive]
    q, c = np.nonzero(can)
    score, c = partial[q, c], alive[c]
    while at < dims:
        end = min(dims, at + DIMS)
        score = score + np.einsum("ij,ij->i", queries[q, at:end], vertical[at:end, c].T)
        at = end
        bound = score if at == dims else score + left_q[q, at] * left_c[at, c]
        stay = bound + error[q] * most[c] >= floors[q]
        q, c, score = q[stay], c[stay], score[stay]
    return q, c, score.astype(np.int64) if exact else _whole(queries, q, vertical, c)


def best(q: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Indices of each query's k best, higher scores first, ties to smaller ids."""
    order = np.lexsort((ids, ~score, q))
    sorted_q = q[order]
    first = np.searchsorted(sorted_q, sorted_q, side="left")
    return order[np.arange(len(order)) - first < k]


def _floor(score: np.ndarray) -> np.ndarray:
    """Doubles that are not above these scores; none where the score may stand for a smaller one."""
    near = score.astype(float)
    return np.where(score == _MIN, -np.inf, np.where(np.abs(near) < 2.0**53, near, np.nextafter(near, -np.inf)))


class Search:
    """Running best k of a set of queries (one length) over blocks of candidates."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, floors: np.ndarray, k: int):
        self.ids, self.vectors, self.floors, self.k = ids, vectors, floors.astype(float), k
        big = wide(vectors)
        self.batches = [(own[b : b + BATCH], w) for w in (False, True) for own in [np.flatnonzero(big == w)] for b in range(0, len(own), BATCH)]
        # Per batch (query index in the batch, candidate, score): pairs of one batch and one block are held at a time.
        self.found = [tuple(np.zeros(0, np.int64) for _ in range(3)) for _ in self.batches]

    def add(self, c_ids: np.ndarray, candidates: np.ndarray) -> None:
        big = wide(candidates)
        for w in (False, True):
            own = np.flatnonzero(big == w)
            for at in range(0, len(own), BLOCK):
                self._add(c_ids[own[at : at + BLOCK]], np.ascontiguousarray(candidates[own[at : at + BLOCK]].T), w)

    def _add(self, ids: np.ndarray, vertical: np.ndarray, is_wide: bool) -> None:
        for b, (part, w) in enumerate(self.batches):
            q, c, s = search_block(self.ids[part], self.vectors[part], self.floors[part], ids, vertical, not (w or is_wide), self.k)
            if not len(q):
                continue
            q, c, s = (np.concatenate(x) for x in zip(self.found[b], (q, ids[c], s)))
            keep = best(q, c, s, self.k)
            self.found[b] = q, c, s = q[keep], c[keep], s[keep]
            counts = np.bincount(q, minlength=len(part))
            full = counts >= self.k
            self.floors[part[full]] = np.maximum(self.floors[part[full]], _floor(s[(np.cumsum(counts) - 1)[full]]))

    def _column(self, i: int) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.int64), *[x[i] if i else part[x[0]] for x, (part, _) in zip(self.found, self.batches)]])

    @property
    def q(self) -> np.ndarray:
        return self._column(0)

    @property
    def c(self) -> np.ndarray:
        return self._column(1)

    @property
    def s(self) -> np.ndarray:
        return self._column(2)


def _valid(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    vector = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    sound = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x * SCALE) == float("inf")))
    return rows.select(F.col(id_col).cast("long").alias("id"), vector.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull() & F.coalesce(sound, F.lit(False)))


def _by_length(table) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(length, ids, quantised vectors) of rows (id, v), by length."""
    ids, lists = (x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in (table.column(0), table.column(1)))
    ids, flat, sizes = (x.to_numpy(zero_copy_only=False) for x in (ids, lists.flatten(), lists.value_lengths()))
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64) if len(sizes) else np.zeros(0, np.int64)
    out = []
    for n in np.unique(sizes):
        own = np.flatnonzero(sizes == n)
        out.append((int(n), ids[own], np.floor(SCALE * flat[begins[own, None] + np.arange(n)[None, :]])))
    return out


def top_k(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, query_step: int = QUERY_STEP, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score): the best k of all rows for every row whose id is divisible by query_step."""
    spark = rows.sparkSession
    valid = _valid(rows, id_col, vector_col)
    queries = stored(valid.where(F.col("id") % query_step == 0).groupBy("id").agg(F.min("v").alias("v")))
    size = queries.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d")).first()
    width = 8 * (size["d"] or 1) + 24 * (k + 1)  # a query's vector and its running results
    # The sample: the first hashes; bounded by SAMPLE rows and by half a pass. Ids are taken once: a floor must not count a row twice.
    draw = valid.orderBy(F.xxhash64("id"), "id").limit(max(k, min(SAMPLE, pass_bytes // 2 // width))).dropDuplicates(["id"])
    sample = {n: (ids, vectors) for n, ids, vectors in _by_length(draw.toArrow())} if size["n"] else {}
    passes = max(1, -(-(size["n"] or 0) * width // pass_bytes))
    found = None
    for p in range(passes):
        packed = {}
        for n, ids, vectors in _by_length(queries.where(F.pmod(F.xxhash64("id"), F.lit(passes)) == p).toArrow()):
            search = Search(ids, vectors, np.full(len(ids), -np.inf), k)
            if n in sample:
                search.add(*sample[n])
            packed[n] = (search.ids, search.vectors, search.floors)
        shipped = spark.sparkContext.broadcast(packed)

        def run(batches, shipped=shipped):
            searches = {n: Search(*x, k) for n, x in shipped.value.items()}
            for batch in batches:
                for n, ids, vectors in _by_length(batch):
                    if n in searches:
                        searches[n].add(ids, vectors)
            for s in searches.values():
                yield pa.RecordBatch.from_arrays([pa.array(s.ids[s.q], pa.int64()), pa.array(s.c, pa.int64()), pa.array(s.s, pa.int64())], names=["query_id", "vec_id", "score"])

        part = valid.mapInArrow(run, "query_id long, vec_id long, score long")
        ranked = part.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= k)
        part = ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
        if passes > 1:
            part = stored(part)
            shipped.destroy()  # the driver holds one pass
        found = part if found is None else found.unionByName(part)
    return found


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP2_SQL = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND list_aggregate(list_transform(embedding, lambda x: CASE WHEN x IS NULL OR NOT isfinite(x) THEN 1 ELSE 0 END), 'sum') IS NOT DISTINCT FROM 0),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, list_aggregate(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]), 'sum')::BIGINT AS score
          FROM v q JOIN v c ON q.vec_id % {QUERY_STEP} = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= {K}
"""
