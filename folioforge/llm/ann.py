"""Approximate nearest neighbours by randomly rotated one-bit codes.

Vectors are normalised and assigned to the nearest of CENTRES centroids. The residual from the centroid is
rotated at random (one rotation a dimension, fixed by a seed) and kept as one sign bit a dimension, with two
correction scalars: the residual's length and the code's inner product with it. A query's inner product with a
vector is estimated from its bits and the scalars, with an error bound of EPSILON standard errors. The vectors
with the best estimates are reranked by exact cosines, in double precision, on the original vectors; of the others
those whose upper bound reaches the k-th best exact cosine so far are reranked too, and no more. Every query is
estimated against the code of every vector: centroids only make residuals short, and no cell is left out, at any
size.

Distribution. The codes are a table in the shared folder, beside the vectors. A block of queries (QUERY_BYTES at
most) is broadcast and each task passes once over its codes, keeping k rows a query; a pass follows a pass
until all queries are through. Neither vectors nor codes are shuffled, only k rows a query and task. A vector that
many rows of a batch share is estimated once. Centroids are fitted on a bounded sample (SAMPLE rows, the first by
a hash). Estimates grow with queries times vectors, which the query set sets.

Edge cases: vectors that are null, zero, or hold null or non-finite components take no part, as query or
candidate. Vectors of different length are never compared. Fewer candidates than k give fewer rows; an empty
table gives none. Rows with a null id take no part; rows that repeat id and vector count once; a query whose id
repeats with another vector is two queries, and no row of its own id is a candidate. Ties go to the smaller id. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioforge.llm import shared

EPSILON = 3.0
CENTRES = 256
SAMPLE = 16_384
#: Bytes of query vectors in a block.
QUERY_BYTES = 32 << 20
#: Queries estimated, and pairs reranked, at once.
ESTIMATED = 64
RERANKED = 1 << 14
#: Estimates reranked at once for each wanted neighbour.
FIRST = 4

_FOUND = "query_id long, q long, c long, score double"


def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(42 + dim).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def centroids(sample: np.ndarray, n: int) -> np.ndarray:
    """k-means on unit vectors."""
    rng = np.random.default_rng(7)
    c = sample[rng.choice(len(sample), n, replace=False)]
    for _ in range(8):
        of = np.argmax(sample @ c.T, axis=1)
        total = np.zeros_like(c)
        np.add.at(total, of, sample)
        size = np.linalg.norm(total, axis=1)
        c = np.where(size[:, None] > 1e-12, total / np.maximum(size, 1e-12)[:, None], c)
    return c


def encode(unit: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits of rotated residuals, residual lengths, and inner products of code and unit residual."""
    rest = unit - centre
    length = np.linalg.norm(rest, axis=1)
    turned = (rest / np.maximum(length, 1e-12)[:, None]) @ turn
    bits = turned > 0
    own = np.abs(turned).sum(axis=1) / np.sqrt(unit.shape[1])
    return np.packbits(bits, axis=1), length, own


def estimate(queries: np.ndarray, codes: np.ndarray, length: np.ndarray, own: np.ndarray, centred: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inner products of unit queries with the coded vectors, a row a query, and each code's error bound.

    centred has the inner products of the queries with the centroid of each code.
    """
    dim = queries.shape[1]
    signs = np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * 2 - 1
    safe = np.maximum(own, 1e-3)
    scale = (length / safe / np.sqrt(dim)).astype(np.float32)
    guess = (queries @ turn).astype(np.float32) @ (signs * scale[:, None]).T + centred
    spread = length * np.sqrt(np.maximum(0, 1 - safe**2)) / safe * EPSILON / np.sqrt(max(1, dim - 1))
    return guess, (spread + 1e-5).astype(np.float32)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten()).astype(np.float64).reshape(-1, dim)


def _distinct(x: np.ndarray, ids: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the distinct rows of x, their `keep` smallest ids one after another, and the n + 1 places of each row's."""
    _, group = np.unique(np.ascontiguousarray(x).view(np.dtype((np.void, x.shape[1] * 8))).ravel(), return_inverse=True)
    order = np.lexsort((ids, group))
    group, named = group[order], ids[order]
    new = np.ones(len(order), bool)
    new[1:] = (group[1:] != group[:-1]) | (named[1:] != named[:-1])
    order, group, named = order[new], group[new], named[new]
    few = np.arange(len(group)) - np.searchsorted(group, group) < keep
    order, group, named = order[few], group[few], named[few]
    heads = np.searchsorted(group, np.arange(group[-1] + 1))
    return order[heads], named, np.append(heads, len(group))


class Nearest:
    """The k best candidates so far of each query of a block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, centres: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.norm = np.sqrt((vectors * vectors).sum(axis=1))
        self.unit = vectors / self.norm[:, None]
        self.turn = rotation(vectors.shape[1])
        self.centred = (self.unit @ centres.T).astype(np.float32)
        self.score = np.full((len(ids), k), -np.inf)
        self.found = np.zeros((len(ids), k), np.int64)

    def _exact(self, row: np.ndarray, col: np.ndarray, x: np.ndarray, norm: np.ndarray) -> np.ndarray:
        out = np.empty(len(row))
        for j in range(0, len(row), RERANKED):
            a, b = row[j : j + RERANKED], col[j : j + RERANKED]
            out[j : j + RERANKED] = (self.vectors[a] * x[b]).sum(axis=1) / (self.norm[a] * norm[b])
        return out

    def _keep(self, first: int, n: int, row: np.ndarray, c: np.ndarray, score: np.ndarray) -> None:
        """The best of what is held and of new pairs, for queries first to first + n."""
        held = np.repeat(np.arange(first, first + n), self.k)
        row = np.concatenate([held, row])
        c = np.concatenate([self.found[first : first + n].ravel(), c])
        score = np.concatenate([self.score[first : first + n].ravel(), score])
        some = np.isfinite(score) & (c != self.ids[row])
        row, c, score = row[some], c[some], score[some]
        order = np.lexsort((c, -score, row))
        row, c, score = row[order], c[order], score[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (c[1:] != c[:-1]) | (score[1:] != score[:-1])
        row, c, score = row[new], c[new], score[new]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        top = rank < self.k
        self.score[first : first + n], self.found[first : first + n] = -np.inf, 0
        self.score[row[top], rank[top]], self.found[row[top], rank[top]] = score[top], c[top]

    def add(self, ids: np.ndarray, x: np.ndarray, cell: np.ndarray, codes: np.ndarray, length: np.ndarray, own: np.ndarray) -> None:
        place, named, at = _distinct(x, ids, self.k + 1)
        x, cell, codes, length, own = x[place], cell[place], codes[place], length[place], own[place]
        size, norm = np.diff(at), np.sqrt((x * x).sum(axis=1))
        n_first = min(len(x), FIRST * (self.k + 1))

        def pairs(first: int, n: int, row: np.ndarray, col: np.ndarray) -> None:
            score = self._exact(row, col, x, norm)
            many = size[col]
            flat = np.repeat(at[col] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
            self._keep(first, n, np.repeat(row, many), named[flat], np.repeat(score, many))

        for i in range(0, len(self.ids), ESTIMATED):
            n = len(self.ids[i : i + ESTIMATED])
            guess, error = estimate(self.unit[i : i + n], codes, length, own, self.centred[i : i + n][:, cell], self.turn)
            best = np.argpartition(guess, len(x) - n_first, axis=1)[:, len(x) - n_first :]
            pairs(i, n, np.repeat(np.arange(i, i + n), n_first), best.ravel())
            guess += error
            np.put_along_axis(guess, best, -np.inf, axis=1)
            row, col = np.nonzero(guess >= self.score[i : i + n, -1:])
            if len(row):
                pairs(i, n, i + row, col)

    def rows(self, base: int) -> pa.RecordBatch:
        row, rank = np.nonzero(np.isfinite(self.score))
        columns = [self.ids[row], base + row, self.found[row, rank], self.score[row, rank]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [c.split()[0] for c in _FOUND.split(", ")])


def _in_one_dimension(good: DataFrame, dim: int, k: int) -> list[DataFrame]:
    """The k best of each task for each query, a table for each block of queries."""
    spark = good.sparkSession
    most = max(1, min(SAMPLE, (64 << 20) // (8 * dim)))
    sample = good.orderBy(F.xxhash64("id", "v")).limit(most).select("v").collect()  # bounded
    points = np.array([r["v"] for r in sample], np.float64)
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    centres = spark.sparkContext.broadcast(centroids(points, min(CENTRES, len(points))))
    turn = rotation(dim)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("v"), dim)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            cell = np.argmax(x @ centres.value.T, axis=1)
            bits, length, own = encode(x, centres.value[cell], turn)
            columns = [batch.column("id"), batch.column("v"), pa.array(cell, pa.int32()), pa.array([b.tobytes() for b in bits], pa.binary()), pa.array(length), pa.array(own)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "v", "cell", "code", "length", "own"])

    kind = good.schema["v"].dataType.simpleString()
    coded = shared.materialize(good.select("id", "v").mapInArrow(code, f"id long, v {kind}, cell int, code binary, length double, own double"), "codes")
    asks = shared.materialize(good.filter("ask").select("id", "v").distinct(), "queries")
    n_blocks = 1 + asks.count() * 8 * dim // QUERY_BYTES
    out = []
    for block in range(n_blocks):
        rows = asks.filter(F.pmod(F.xxhash64("id", "v"), F.lit(n_blocks)) == block).orderBy("id", "v").collect()  # QUERY_BYTES
        if not rows:
            continue
        queries = spark.sparkContext.broadcast((np.array([r["id"] for r in rows], np.int64), np.array([r["v"] for r in rows], np.float64)))

        def scan(batches: Iterator[pa.RecordBatch], queries=queries, base=block << 32) -> Iterator[pa.RecordBatch]:
            near = None
            for batch in batches:
                if not batch.num_rows:
                    continue
                near = near or Nearest(*queries.value, centres.value, k)
                codes = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                near.add(np.asarray(batch.column("id")), _matrix(batch.column("v"), dim), np.asarray(batch.column("cell")), codes, np.asarray(batch.column("length")), np.asarray(batch.column("own")))
            if near is not None:
                yield near.rows(base)

        out.append(shared.materialize(coded.mapInArrow(scan, _FOUND), "nearest"))
        queries.unpersist()
    return out


def nearest(vectors: DataFrame, is_query: F.Column, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest others of the rows of vectors (id, v) that is_query marks."""
    whole = "id IS NOT NULL AND v IS NOT NULL AND size(v) > 0 AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(v, x -> x <> 0)"
    good = vectors.select("id", "v", F.coalesce(is_query, F.lit(False)).alias("ask")).filter(whole)
    dims = good.select(F.size("v").alias("dim")).distinct().collect()  # a row a vector length
    pairs = None
    for dim in sorted(r["dim"] for r in dims):
        for part in _in_one_dimension(good.filter(F.size("v") == dim), dim, k):
            part = part.withColumn("dim", F.lit(dim))
            pairs = part if pairs is None else pairs.union(part)
    if pairs is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    order = Window.partitionBy("dim", "query_id", "q").orderBy(F.desc("score"), "c")
    best = pairs.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", F.col("c").alias("vec_id"), "score")


def op1_ann_rotated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shared.table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").alias("v"))
    return nearest(rows, F.col("id") % 50 == 0, 5)
