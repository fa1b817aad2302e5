"""Nearest neighbours by collision counting.

Each block of vectors keeps one sorted array per random projection, with cuts at which the vectors
before them are kept as bits.  A query opens a window around its own projection in every array,
from cut to cut, and counts how often each vector falls inside, 64 vectors to an operation; virtual
rehashing widens the windows round by round.  Vectors that collide often enough are verified
with exact inner products on the original values.  A query ends when the best verified so far are
so near that anything nearer would have collided often enough too.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

NEAREST = 20
QUERY_EVERY = 20
#: Vectors of a block and queries of a chunk: what one task holds at a time.
BLOCK = 8192
CHUNK = 16384
PROJECTIONS = 64
#: Half widths of the windows, in standard deviations of the projections of a block.
WIDTHS = (1.0, 1.4, 2.0, 3.0, 5.0)
#: A vector is verified once it has collided in this share of the projections.
THRESHOLD = 0.547
#: Standard deviations by which the collisions expected of the last neighbour must exceed THRESHOLD.
SURE = 3.0
#: Cuts of a sorted array; what stands before each is kept as bits.
CUTS = 128
#: Queries whose windows are counted together, few enough for a processor's cache.
TOGETHER = 32
#: Room for the error of products in single precision, in units of the largest norm and the query's.
ROUGH = 1e-4


class ProjectionIndex:
    """Sorted projections of one block of vectors, reduced to nearness in Euclidean distance.

    Largest inner product becomes least distance when every vector is lengthened to the same norm
    by one more component, which queries have as zero.
    """

    def __init__(self, vectors: np.ndarray, seed: int = 11):
        self.vectors = vectors
        norms = (vectors * vectors).sum(1)
        extra = np.sqrt(np.maximum(norms.max() - norms, 0))
        self.small = (vectors / np.sqrt(norms.max())).astype(np.float32)
        self.axes = np.random.default_rng(seed).normal(size=(PROJECTIONS, vectors.shape[1] + 1))
        places = vectors @ self.axes[:, :-1].T + np.outer(extra, self.axes[:, -1])
        self.spread = places.std(0) + 1e-12
        order = np.argsort(places, axis=0, kind="stable").T
        self.sorted = np.take_along_axis(places, order.T, 0).T.copy()
        self.below = self._below(order)
        self.norm = norms.max()
        self.trusted = [self._trusted(width * self.spread) for width in WIDTHS]

    def _below(self, order: np.ndarray) -> np.ndarray:
        """By projection and cut, one bit per row: whether it stands before the cut in the projection's array."""
        n = order.shape[1]
        self.step = -(-n // CUTS)
        cuts = np.arange(-(-n // self.step) + 1) * self.step
        out = np.zeros((len(order), len(cuts), -(-n // 64)), dtype=np.uint64)
        bits = np.zeros((len(cuts), out.shape[2] * 64), dtype=bool)
        rank = np.empty(n, dtype=np.int64)
        for p, rows in enumerate(order):
            rank[rows] = np.arange(n)
            np.less(rank, cuts[:, None], out=bits[:, :n])
            out[p] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
        return out

    @staticmethod
    def _trusted(reach: np.ndarray) -> float:
        """The largest distance whose vectors collide often enough within ``reach`` but for ``SURE`` deviations.

        Along an axis two vectors differ by a normal number with their distance as its deviation.
        """
        low, high = 0.0, 10 * float(reach.max())
        for _ in range(40):
            middle = (low + high) / 2
            p = np.array([math.erf(r / (middle * math.sqrt(2))) for r in reach])
            sure = p.sum() - SURE * math.sqrt((p * (1 - p)).sum()) >= THRESHOLD * PROJECTIONS
            low, high = (middle, high) if sure else (low, middle)
        return low

    def collided(self, queries: np.ndarray, k: int = NEAREST) -> tuple[np.ndarray, np.ndarray]:
        """Which rows of the block collide often enough with each query to be verified, and rough products.

        The windows of a query widen until the best ``k`` verified, and the query itself, lie within
        the distance that the width is trusted with; if the last width is not, all rows are verified.
        Windows are rounded out to the cuts.  The products are in single precision, of vectors
        shortened by the largest norm and the query's, and taken of the whole block at once.
        """
        n, lengths = len(self.vectors), np.sqrt((queries * queries).sum(1))
        rough = (queries / lengths[:, None]).astype(np.float32) @ self.small.T
        hit = np.ones((len(queries), n), dtype=bool)
        if n <= k + 1:
            return hit, rough
        centre = self.axes[:, :-1] @ queries.T
        axis = np.arange(PROJECTIONS)[:, None]
        open_ = np.arange(len(queries))
        for width, trusted in zip(WIDTHS, self.trusted):
            reach = width * self.spread
            a, b = np.empty((2, PROJECTIONS, len(open_)), dtype=np.int64)
            for p, (s, c, r) in enumerate(zip(self.sorted, centre[:, open_], reach)):
                a[p], b[p] = np.searchsorted(s, c - r, "left"), np.searchsorted(s, c + r, "right")
            windows = self.below[axis, -(-b // self.step)] & ~self.below[axis, a // self.step]
            found = np.unpackbits(at_least(windows, math.ceil(THRESHOLD * PROJECTIONS)).view(np.uint8), axis=1, count=n, bitorder="little").view(bool)
            # the last of the best lies near enough if more than k of those verified have this product
            away = lengths[open_] ** 2 + self.norm
            needed = (away - trusted * trusted) / (2 * lengths[open_] * math.sqrt(self.norm)) + ROUGH / 10
            done = (found & (rough[open_] >= needed[:, None])).sum(1) > k
            hit[open_[done]] = found[done]
            open_ = open_[~done]
            if not len(open_):
                break
        return hit, rough

    def candidates(self, query: np.ndarray, k: int = NEAREST) -> np.ndarray:
        """Rows of the block that are verified for one query."""
        return np.flatnonzero(self.collided(query[None], k)[0][0])

    def nearest_of(self, queries: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each query, ids and exact scores of the best ``k`` verified rows but its own, ties to the smaller id."""
        out = []
        for start in range(0, len(queries), TOGETHER):
            asked = queries[start : start + TOGETHER]
            for query, me, hit, rough in zip(asked, own[start : start + TOGETHER], *self.collided(asked, k)):
                if len(rough) > k + 1:  # single precision with room for its error leaves few for the exact measure
                    rough = np.where(hit, rough, np.float32(-np.inf))
                    hit = hit & (rough >= np.partition(rough, len(rough) - k - 1)[len(rough) - k - 1] - ROUGH)
                rows = np.flatnonzero(hit)
                rows = rows[ids[rows] != me]
                exact = (self.vectors[rows] * query).sum(1)
                top = np.lexsort((ids[rows], -exact))[:k]
                out.append((ids[rows][top], exact[top]))
        return out

    def nearest(self, query: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """``nearest_of`` a single query."""
        return self.nearest_of(query[None], ids, np.array([own]), k)[0]


def at_least(bits: np.ndarray, least: int) -> np.ndarray:
    """Bitwise, where at least ``least`` of the ``PROJECTIONS`` words along the first axis are set.

    The words are added in pairs, then pairs of pairs: a number is a list of its bits, lowest
    first, so that one operation adds a bit of 64 rows.
    """
    number = [bits]
    while len(number[0]) > 1:
        out, carry = [], None
        for bit in number:
            x, y = bit[0::2], bit[1::2]
            both, either = x & y, x ^ y
            out.append(either if carry is None else either ^ carry)
            carry = both if carry is None else both | (either & carry)
        number = [*out, carry]
    more, same = np.zeros_like(number[0][0]), ~np.zeros_like(number[0][0])
    for place in reversed(range(len(number))):
        bit = number[place][0]
        if least >> place & 1:
            same = same & bit
        else:
            more, same = more | (same & bit), same & ~bit
    return more | same


def _numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, vector``: rows with an id and a non-zero vector of finite numbers."""
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector")).filter("vec_id is not null and size(vector) > 0")
    rows = rows.filter(~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    return rows.filter(F.exists("vector", lambda x: x != 0))


def nearest_vectors(vectors: DataFrame, k: int = NEAREST, every: int = QUERY_EVERY) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each id divisible by ``every`` its ``k`` nearest found.

    Nearness is the inner product in double precision.  Vectors that are null, zero or hold null
    or non-finite components take no part.  Vectors of another length than the query's have no inner
    product with it: each length is searched among its own.  Equal vectors tie and go to the smaller id.  Rows that repeat an id are one vector, the smallest of
    them.  An empty table gives no rows; other columns are not read.

    Every vector is indexed, in blocks of bounded size; every query meets every block.  Both
    counts grow with the table, so no task holds more than a block and a chunk of queries.
    """
    rows = usable(vectors)
    n, queries = rows.agg(F.count("*"), F.count(F.when(F.col("vec_id") % every == 0, 1))).first()
    if not n:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    blocks, chunks = -(-n // BLOCK), max(1, -(-queries // CHUNK))
    rows = rows.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min("vector").alias("vector"))
    as_vector = rows.select(
        "vec_id", "vector", F.lit(False).alias("asks"), F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block"),
        F.explode(_numbers(chunks)).alias("chunk"))
    as_query = rows.filter(F.col("vec_id") % every == 0).select(
        "vec_id", "vector", F.lit(True).alias("asks"), F.explode(_numbers(blocks)).alias("block"),
        F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(chunks)).alias("chunk"))

    def search(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy()
        ids = table.column("vec_id").to_numpy()
        values = np.asarray(table.column("vector").combine_chunks().flatten(), dtype=np.float64).reshape(len(ids), -1)
        order = np.argsort(ids[~asks], kind="stable")
        own_ids, found = ids[~asks][order], []
        if len(own_ids):
            index = ProjectionIndex(values[~asks][order])
            found = [(q, *f) for q, f in zip(ids[asks], index.nearest_of(values[asks], own_ids, ids[asks], k))]
        return pa.table({
            "query_id": pa.array(np.repeat([f[0] for f in found], [len(f[1]) for f in found]).astype(np.int64)),
            "vec_id": pa.array(np.concatenate([f[1] for f in found] or [np.zeros(0, np.int64)]), pa.int64()),
            "score": pa.array(np.concatenate([f[2] for f in found] or [np.zeros(0)]), pa.float64()),
        })

    dealt = as_vector.unionByName(as_query).withColumn("length", F.size("vector"))
    found = dealt.groupBy("length", "block", "chunk").applyInArrow(search, "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
