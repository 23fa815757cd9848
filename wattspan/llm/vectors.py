"""Embedding tables: usable rows, samples of bounded size, and blocks of rows against blocks of queries."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and queries that meet in one task, at most about.
SHARD_ROWS = 16_384
QUERY_ROWS = 2_048


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def finite(vector: Column) -> Column:
    """Whether the vector is there and all its components are finite numbers."""
    inside = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & inside, F.lit(False))


def usable(table: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is finite and as long as most are (of equally many, the longer)."""
    kept = table.where(finite(F.col(vector)))
    sizes = kept.groupBy(F.size(vector).alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return kept.where(F.size(vector) == (sizes["size"] if sizes else 0))


def one_per_id(rows: DataFrame, vector: str, *more: str) -> DataFrame:
    """One row per vec_id: of repeated ids the least row; a NULL id takes no part."""
    least = F.min(F.struct(*more, vector)).alias("row")
    return rows.where("vec_id IS NOT NULL").groupBy("vec_id").agg(least).select("vec_id", "row.*")


def sample(rows: DataFrame, size: int, total: int) -> list:
    """At most `size` rows, the same for any partitioning: those with the least hashes of their ids.

    Rows are thinned by hash first, so that what the tasks send follows the size, not the table.
    """
    draw = F.xxhash64(F.lit("sample"), F.col("vec_id"))
    share = min(1.0, 4.0 * size / max(total, 1))
    limit = int(-(2 ** 63) + share * 2.0 ** 64 * (1 - 1e-12)) if share < 1 else 2 ** 63 - 1
    return rows.withColumn("draw", draw).where(F.col("draw") <= limit).orderBy("draw", "vec_id").limit(size).collect()


def matrix(column: pa.ChunkedArray | pa.Array, dim: int, kind: type = np.float64) -> np.ndarray:
    """List column as a matrix of one row per list."""
    parts = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    flat = [np.asarray(p.flatten().to_numpy(zero_copy_only=False), dtype=kind) for p in parts]
    return np.concatenate([*flat, np.empty(0, kind)]).reshape(-1, dim)


def numbers(column: pa.ChunkedArray | pa.Array, kind: type = np.int64) -> np.ndarray:
    return np.asarray(column.to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.to_numpy(), dtype=kind)


def block_counts(rows: int, queries: int) -> tuple[int, int]:
    """Numbers of row shards and of query blocks."""
    return max(1, math.ceil(rows / SHARD_ROWS)), max(1, math.ceil(queries / QUERY_ROWS))


def met(rows: DataFrame, queries: DataFrame, n_rows: int, n_queries: int):
    """Every block of queries beside every shard of rows, as a cogroup on their cell.

    Shards and blocks are drawn by a hash of vec_id, so that a crowded region or label is spread over
    all of them.
    """
    shards, blocks = block_counts(n_rows, n_queries)
    cells = shards * blocks
    shard = F.pmod(F.xxhash64(F.lit("shard"), F.col("vec_id")), F.lit(shards))
    block = F.pmod(F.xxhash64(F.lit("block"), F.col("vec_id")), F.lit(blocks))

    def dealt(frame: DataFrame, fixed: Column, others: int, cell) -> DataFrame:
        every = F.sequence(F.lit(0), F.lit(others - 1))
        laid = frame.withColumn("cell", F.explode(F.transform(every, lambda o: cell(fixed, o).cast("long"))))
        return laid.repartition(cells, "cell")

    left = dealt(rows, shard, blocks, lambda own, o: own * blocks + o)
    right = dealt(queries, block, shards, lambda own, o: o * blocks + own)
    return left.groupBy("cell").cogroup(right.groupBy("cell"))
