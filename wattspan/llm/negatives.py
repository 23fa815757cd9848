"""Hard negatives over an inverted multi-index, with certified windows.

Vectors are integers (`floor(256 x)`), cut into two halves. Two codebooks of `CENTRES` centres, fitted by
k-means on at most `FIT_ROWS` rows, name the cell (i, j) of every row; each shard of rows keeps its rows by
cell, and for every centre the radius of its half-rows there. For an anchor a, no row of cell (i, j)
scores above  a1.c_i + |a1| r_i + a2.c_j + |a2| r_j. A heap visits cells by falling bound (multi-sequence), and
all rows of a visited cell are scored exactly. The next cell's bound certifies what is known: every row
above it has been seen. Positives stop once the last wanted score lies above it; a positive's window
of negatives stops once its first ten do, or once the window's lower end does.

Shards hold equal shares of any label or crowded region (drawn by hash); anchors meet them in blocks
of fixed size. Shards return at most the wanted number of rows per anchor or window; a window merges them.
All results are exact: codebooks and bounds only decide what is read first and when to stop.

Defined results: rows with a NULL label, NULL vec_id, NULL or empty vector, a NULL or non-finite
component, a length other than the most frequent, or an integer vector whose squared length reaches
2^62 (inner products would leave a long) take no part; of rows that share a vec_id the one with the
least (label, vector) counts; an anchor without another row of its label gives no rows; a negative
positive_score has an empty window; equal scores rank by smaller vec_id; other columns are not read.
An empty table gives an empty table.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .ann import best
from .vectors import matrix, met, numbers, one_per_id, sample, usable

SCALE = 256
EVERY = 100
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90
CENTRES = 16
FIT_ROWS = 4_096
FIT_STEPS = 15
SEED = 12
#: Rows that are scored at once before the bound is looked at again.
BATCH = 2_048


def codebook(halves: np.ndarray) -> np.ndarray:
    """k-means centres of the half-vectors; at most `CENTRES`."""
    rng = np.random.default_rng(SEED)
    distinct = np.unique(halves, axis=0)
    centres = distinct[rng.choice(len(distinct), min(CENTRES, len(distinct)), replace=False)]
    for _ in range(FIT_STEPS):
        own = assigned(halves, centres)
        for c in np.unique(own):
            centres[c] = halves[own == c].mean(axis=0)
    return centres


def assigned(halves: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Nearest centre of each half-vector."""
    return ((centres ** 2).sum(axis=1) - 2 * (halves @ centres.T)).argmin(axis=1)


class MultiIndex:
    """A shard's rows by cell, with the radii that make the cells' bounds."""

    def __init__(self, vectors: np.ndarray, books: tuple[np.ndarray, np.ndarray]):
        self.cut, self.books = vectors.shape[1] // 2, books
        exact = float(np.abs(vectors).max(initial=0)) ** 2 * vectors.shape[1] < 2.0 ** 53
        self.vectors = vectors.astype(np.float64) if exact else vectors
        halves = vectors[:, :self.cut].astype(np.float64), vectors[:, self.cut:].astype(np.float64)
        own, self.radii = [], []
        for half, centres in zip(halves, books):
            place = assigned(half, centres)
            far = np.sqrt(((half - centres[place]) ** 2).sum(axis=1))
            radius = np.full(len(centres), -np.inf)  # a centre without rows bounds nothing
            np.maximum.at(radius, place, far)
            own.append(place)
            self.radii.append(radius)
        cell = own[0] * len(books[1]) + own[1]
        self.order = np.argsort(cell, kind="stable")
        self.starts = np.searchsorted(cell[self.order], np.arange(len(books[0]) * len(books[1]) + 1))

    def scores(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        return (self.vectors[rows] @ anchor.astype(self.vectors.dtype)).astype(np.int64)

    def visits(self, anchor: np.ndarray):
        """(rows, next bound): batches of rows by falling cell bound; nothing unseen scores above the bound."""
        half_bounds = []
        for half, centres, radii in zip((anchor[:self.cut], anchor[self.cut:]), self.books, self.radii):
            half = half.astype(np.float64)
            half_bounds.append(centres @ half + np.sqrt(half @ half) * radii)
        first, second = (np.argsort(-b, kind="stable") for b in half_bounds)
        ones, others = (b[o].tolist() for b, o in zip(half_bounds, (first, second)))
        width, wide = len(second), self.starts
        heap, seen, taken, held = [(-(ones[0] + others[0]), 0, 0)], {(0, 0)}, [], 0
        while heap:
            _, i, j = heapq.heappop(heap)
            for up, on in ((i + 1, j), (i, j + 1)):
                if up < len(ones) and on < width and (up, on) not in seen:
                    bound = ones[up] + others[on]
                    if bound > -np.inf:  # centres without rows come last and hold nothing
                        seen.add((up, on))
                        heapq.heappush(heap, (-bound, up, on))
            cell = first[i] * width + second[j]
            if wide[cell + 1] > wide[cell]:
                taken.append(self.order[wide[cell]:wide[cell + 1]])
                held += wide[cell + 1] - wide[cell]
            if taken and (held >= BATCH or not heap):
                # Rounded up: bounds are sums of doubles, scores whole numbers.
                ahead = -heap[0][0] if heap else -np.inf
                yield np.concatenate(taken), ahead + 1e-9 * abs(ahead) + 1e-3 if heap else -np.inf
                taken, held = [], 0


def _first(pool: list[np.ndarray], ids: np.ndarray, scores: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    rows, values = np.concatenate(pool), np.concatenate(scores)
    top = best(ids[rows], values, k)
    return rows[top], values[top]


def local_positives(index: MultiIndex, ids: np.ndarray, labels: np.ndarray, name: int, label: int,
                    anchor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and scores of the anchor's best k rows of its label in this shard."""
    rows, values = np.empty(0, np.int64), np.empty(0, np.int64)
    for seen, bound in index.visits(anchor):
        seen = seen[(labels[seen] == label) & (ids[seen] != name)]
        rows, values = _first([rows, seen], ids, [values, index.scores(seen, anchor)], k)
        if len(rows) == k and values[-1] > bound:
            break
    return rows, values


def local_negatives(index: MultiIndex, ids: np.ndarray, labels: np.ndarray, label: int, anchor: np.ndarray,
                    positives: list[int], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per positive score: rows and scores of the window's first k rows of other labels in this shard."""
    found = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in positives]
    open_ = [i for i, p in enumerate(positives) if p >= 0]
    if not open_:
        return found
    for seen, bound in index.visits(anchor):
        seen = seen[labels[seen] != label]
        values = index.scores(seen, anchor)
        for i in open_:
            low, high = -(-LOW * positives[i] // 100), HIGH * positives[i] // 100
            inside = (values >= low) & (values <= high)
            found[i] = _first([found[i][0], seen[inside]], ids, [found[i][1], values[inside]], k)
        # A window is certified when no unseen row can enter it, or can come before its k-th.
        open_ = [i for i in open_ if not (100 * bound < LOW * positives[i] or len(found[i][0]) == k and found[i][1][-1] > bound)]
        if not open_:
            break
    return found


def _positive_cells(books, dim: int, k: int):
    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if len(left) and len(right):
            ids, labels = numbers(left.column("vec_id")), numbers(left.column("label"))
            index = MultiIndex(matrix(left.column("vector"), dim, np.int64), books)
            asked, own = numbers(right.column("vec_id")).tolist(), numbers(right.column("label")).tolist()
            for name, label, anchor in zip(asked, own, matrix(right.column("vector"), dim, np.int64)):
                rows, values = local_positives(index, ids, labels, name, label, anchor, k)
                out += [(name, *p) for p in zip(ids[rows].tolist(), values.tolist())]
        return _table(out, ("anchor_id", "positive_id", "positive_score"))

    return cell


def _negative_cells(books, dim: int, k: int):
    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if len(left) and len(right):
            ids, labels = numbers(left.column("vec_id")), numbers(left.column("label"))
            index = MultiIndex(matrix(left.column("vector"), dim, np.int64), books)
            asked, own = numbers(right.column("vec_id")).tolist(), numbers(right.column("label")).tolist()
            wanted = right.column("positives").to_pylist()
            for name, label, anchor, positives in zip(asked, own, matrix(right.column("vector"), dim, np.int64), wanted):
                scores = sorted({p["positive_score"] for p in positives})
                windows = dict(zip(scores, local_negatives(index, ids, labels, label, anchor, scores, k)))
                for p in positives:
                    rows, values = windows[p["positive_score"]]
                    out += [(name, p["positive_id"], p["positive_score"], *n) for n in zip(ids[rows].tolist(), values.tolist())]
        return _table(out, ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"))

    return cell


def _table(rows: list[tuple], names: tuple[str, ...]) -> pa.Table:
    columns = zip(*rows) if rows else [[] for _ in names]
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})


def mine(table: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, every: int = EVERY) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    own = usable(table.where("label IS NOT NULL").select(
        F.col("vec_id").cast("long").alias("vec_id"), moved.cast("long").alias("label"),
        F.col("embedding").alias("vector")), "vector")
    size = F.aggregate("vector", F.lit(0.0), lambda a, x: a + F.pow(F.floor(x.cast("double") * SCALE).cast("double"), 2))
    whole = F.transform("vector", lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    rows = materialise(one_per_id(own.where(size < 2.0 ** 62).withColumn("vector", whole), "vector", "label"), "negatives-rows")
    anchors = rows.where(F.col("vec_id") % every == 0)
    count = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("vec_id") % every == 0).alias("q"),
                     F.max(F.size("vector")).alias("dim")).first()
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    if count.n < 2 or not count.q:
        return table.sparkSession.createDataFrame([], ", ".join(f"{c} {'int' if c == 'rank' else 'long'}" for c in names))
    fit = np.array([r.vector for r in sample(rows, FIT_ROWS, count.n)], dtype=np.float64)
    cut = count.dim // 2
    books = codebook(fit[:, :cut]), codebook(fit[:, cut:])

    near = met(rows, anchors, count.n, count.q).applyInArrow(
        _positive_cells(books, count.dim, positives), "anchor_id long, positive_id long, positive_score long")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    kept = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= positives)
    lists = kept.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))  # at most `positives` each
    asked = materialise(anchors.join(lists, "vec_id"), "negatives-positives")

    windows = met(rows, asked, count.n, count.q).applyInArrow(
        _negative_cells(books, count.dim, negatives),
        "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    ranked = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return windows.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= negatives).select(*names)


def query(table: DataFrame) -> DataFrame:
    return mine(table)


#: Rows of `query` by brute force.
SQL = """
WITH base AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM base a JOIN base b ON a.vec_id % 100 = 0 AND a.vec_id != b.vec_id
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank,
       n.other_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id) <= 10
"""
