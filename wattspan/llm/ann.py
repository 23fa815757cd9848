"""Approximate nearest neighbours by inner product: multi-index hashing of learned binary codes.

Codes: a vector is scaled by the longest norm M and gets one more coordinate that completes it to unit
length, so that the inner product with a query is the cosine of their angle. Rotations are learned by
iterative quantisation on a sample of at most `FIT_ROWS` rows, from as many random starts as
`CODE_BITS` bits take; a bit is the sign of a rotated coordinate.

Search: a code is cut into substrings of 16 bits, and each shard of rows keeps, per substring, an index
from its values to its rows. Two codes within r = q * m + a bits of each other agree on one of the first
a + 1 of m substrings to q bits, or on one of the others to q - 1 (pigeonhole), so probing those balls
retrieves every code within r; the whole codes are checked, and the rows left are ranked by their inner
products in double precision. Every row is indexed. Shards and blocks of queries of fixed size meet by
their cell's shuffle; the best of the shards are merged by a window.

The radius is learned too: the exact neighbours of at most `PROBE_QUERIES` queries are found by one pass
over all rows, and r is the least radius that holds `TARGET` of them. A query with fewer than k
codes within r is searched again with a radius that holds every code.

Defined results: NULL, empty and zero vectors, vectors with a NULL or non-finite component, of a length
other than the most frequent, or without vec_id take no part; of rows that share a vec_id the one with
the least vector counts; equal scores rank by smaller vec_id; other columns are not read. An empty table
gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .vectors import matrix, met, numbers, one_per_id, sample, usable

CODE_BITS = 256
SUBSTRING = 16
FIT_ROWS = 4_096
FIT_STEPS = 20
PROBE_QUERIES = 256
TARGET = 0.98
#: Cost of looking up a value in an index, in values compared one after the other.
LOOKUP = 64
NEAREST = 20
EVERY = 20
SEED = 11


@dataclass(frozen=True)
class Coder:
    """Learned rotations of scaled and completed vectors."""

    longest: float
    rotations: tuple[np.ndarray, ...]

    def bits(self, unit: np.ndarray) -> np.ndarray:
        signs = np.concatenate([unit @ r >= 0 for r in self.rotations], axis=1)[:, :CODE_BITS]
        return np.packbits(signs, axis=1).view(np.uint64)

    def rows(self, vectors: np.ndarray) -> np.ndarray:
        return self.bits(completed(vectors, self.longest))

    def queries(self, vectors: np.ndarray) -> np.ndarray:
        return self.bits(np.hstack([vectors, np.zeros((len(vectors), 1))]))


def completed(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Vectors over the longest norm, with a coordinate that makes each a unit vector."""
    scaled = vectors / longest
    rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", scaled, scaled)))
    return np.hstack([scaled, rest[:, None]])


def learn(vectors: np.ndarray, longest: float) -> Coder:
    """Iterative quantisation: turn a random rotation until its signs lie near the rotated vectors."""
    unit, rng = completed(vectors, longest), np.random.default_rng(SEED)
    wide = unit.shape[1]
    basis = np.eye(wide)
    if wide > CODE_BITS:
        basis = np.linalg.eigh(unit.T @ unit)[1][:, ::-1][:, :CODE_BITS]
    turned, found = unit @ basis, []
    for _ in range(-(-CODE_BITS // turned.shape[1])):
        rotation = np.linalg.qr(rng.standard_normal((turned.shape[1],) * 2))[0]
        for _ in range(FIT_STEPS):
            signs = np.where(turned @ rotation >= 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(signs.T @ turned)
            rotation = (left @ right).T
        found.append(basis @ rotation)
    return Coder(longest, tuple(found))


def distances(code: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return np.bitwise_count(codes ^ code).sum(axis=1, dtype=np.int32)


def ball(radius: int) -> np.ndarray:
    """All substring differences of at most `radius` bits."""
    return np.flatnonzero(np.bitwise_count(np.arange(1 << SUBSTRING)) <= radius).astype(np.uint16)


class MultiIndex:
    """Per substring: the values that occur, the rows of each, and all rows' values."""

    def __init__(self, codes: np.ndarray):
        self.words = [np.ascontiguousarray(w) for w in codes.T]
        self.columns = [np.ascontiguousarray(c) for c in codes.view(np.uint16).T]
        self.tables = []
        for column in self.columns:
            order = np.argsort(column, kind="stable")
            values, starts = np.unique(column[order], return_index=True)
            self.tables.append((values, np.r_[starts, len(order)], order))

    def _probe(self, table: int, value: np.uint16, differences: np.ndarray, radius: int, hit: np.ndarray) -> None:
        """Mark the rows whose substring lies in the ball: those of each of the ball's values, or, where
        looking these up costs more, those whose own value lies in it."""
        values, starts, order = self.tables[table]
        if LOOKUP * len(differences) >= len(order):
            hit |= np.bitwise_count(self.columns[table] ^ value) <= radius
            return
        wanted = differences ^ value
        at = np.searchsorted(values, wanted)
        at = at[values[np.minimum(at, len(values) - 1)] == wanted]
        for start, end in zip(starts[at].tolist(), starts[at + 1].tolist()):
            hit[order[start:end]] = True

    def within(self, code: np.ndarray, radius: int, balls: dict[int, np.ndarray]) -> np.ndarray:
        """Rows whose codes differ from `code` in at most `radius` bits."""
        size = len(self.columns[0])
        if radius >= CODE_BITS:
            return np.arange(size)
        each, extra = divmod(radius, len(self.tables))
        hit = np.zeros(size, dtype=bool)
        for table, value in enumerate(code.view(np.uint16)):
            own = each if table <= extra else each - 1
            if own >= 0:
                self._probe(table, value, balls[own], own, hit)
        rows = np.flatnonzero(hit)
        apart = np.zeros(len(rows), dtype=np.uint16)
        for word, part in zip(self.words, code):
            apart += np.bitwise_count(word[rows] ^ part)
        return rows[apart <= radius]


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties by smaller id."""
    places = np.arange(len(ids))
    if len(ids) > k:
        places = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
    return places[np.lexsort((ids[places], -scores[places]))][:k]


def _search(coder: Coder, dim: int, radius: int, k: int):
    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[int, np.ndarray, np.ndarray]] = []
        if len(left) and len(right):
            ids, vectors = numbers(left.column("vec_id")), matrix(left.column("vector"), dim)
            asked, queries = numbers(right.column("vec_id")), matrix(right.column("vector"), dim)
            index, codes = MultiIndex(coder.rows(vectors)), coder.queries(queries)
            each = radius // len(index.tables)
            balls = {r: ball(r) for r in (each, each - 1) if r >= 0}
            for name, query, code in zip(asked.tolist(), queries, codes):
                rows = index.within(code, radius, balls)
                rows = rows[ids[rows] != name]
                scores = vectors[rows] @ query
                top = best(ids[rows], scores, k)
                found.append((name, ids[rows][top], scores[top]))
        sizes = [len(f[1]) for f in found]
        return pa.table({
            "query_id": pa.array(np.repeat(np.array([f[0] for f in found], dtype=np.int64), sizes)),
            "vec_id": pa.array(np.concatenate([np.empty(0, np.int64), *[f[1] for f in found]])),
            "score": pa.array(np.concatenate([np.empty(0), *[f[2] for f in found]])),
        })

    return cell


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _neighbour_distances(rows: DataFrame, coder: Coder, queries: np.ndarray, asked: np.ndarray, k: int) -> list[int]:
    """Code distances between the given queries and their exact k nearest rows, by one pass over all rows."""
    codes, dim = coder.queries(queries), queries.shape[1]

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = [(np.empty(0, np.int64), np.empty(0), np.empty(0, np.int32))] * len(asked)
        for batch in batches:
            ids, vectors = numbers(batch.column(0)), matrix(batch.column(1), dim)
            own, scores = coder.rows(vectors), vectors @ queries.T
            for q, name in enumerate(asked.tolist()):
                pick = best(ids, np.where(ids == name, -np.inf, scores[:, q]), k)
                pick = pick[ids[pick] != name]
                merged = [np.concatenate(p) for p in zip(top[q], (ids[pick], scores[pick, q], distances(codes[q], own[pick])))]
                keep = best(merged[0], merged[1], k)
                top[q] = tuple(part[keep] for part in merged)
        sizes = [len(t[0]) for t in top]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(asked, sizes)), *[pa.array(np.concatenate([t[i] for t in top])) for i in range(3)]],
            names=["query_id", "vec_id", "score", "distance"])

    found = rows.select("vec_id", "vector").mapInArrow(nearest, "query_id long, vec_id long, score double, distance int")
    return [r.distance for r in _ranked(found, k).select("distance").collect()]


def nearest(table: DataFrame, id_column: str, vector: str, every: int = EVERY, k: int = NEAREST,
            target: float = TARGET) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of each row whose id is divisible by `every`."""
    own = table.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    nonzero = usable(own.where(F.exists("vector", lambda x: x != 0)), "vector")
    rows = materialise(one_per_id(nonzero, "vector"), "ann-rows")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    asked = F.col("vec_id") % every == 0
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(asked).alias("q"), F.max(norm).alias("longest"),
                    F.max(F.size("vector")).alias("dim")).first()
    empty = "query_id long, rank int, vec_id long, score double"
    if size.n < 2 or not size.q:
        return table.sparkSession.createDataFrame([], empty)
    coder = learn(np.array([r.vector for r in sample(rows, FIT_ROWS, size.n)], dtype=np.float64), size.longest)
    probes = sample(rows.where(asked), PROBE_QUERIES, size.q)
    seen = _neighbour_distances(rows, coder, np.array([r.vector for r in probes], dtype=np.float64),
                                np.array([r.vec_id for r in probes], dtype=np.int64), k)
    radius = int(np.quantile(seen, target, method="higher"))

    def searched(queries: DataFrame, count: int, reach: int) -> DataFrame:
        cells = met(rows, queries, size.n, count)
        return _ranked(cells.applyInArrow(_search(coder, size.dim, reach, k), "query_id long, vec_id long, score double"), k)

    found = materialise(searched(rows.where(asked), size.q, radius), "ann-found")
    full = found.where(F.col("rank") == min(k, size.n - 1)).select(F.col("query_id").alias("vec_id"))
    short = materialise(rows.where(asked).join(full, "vec_id", "left_anti"), "ann-short")
    left = short.count()
    if left:
        again = searched(short, left, CODE_BITS)
        found = found.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").unionByName(again)
    return found.select("query_id", "rank", "vec_id", "score")


def query(table: DataFrame) -> DataFrame:
    return nearest(table, "vec_id", "embedding")
