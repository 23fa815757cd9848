"""SimHash near-duplicates, found with BK-trees.

A task hashes four-word shingles and sets each fingerprint bit that more than half of them set. Equal
fingerprints collapse first. Two fingerprints within `RADIUS` bits agree on at least one choice of
`blocks - RADIUS` out of `blocks` bit blocks, so every fingerprint goes to one shard per choice, keyed
by the chosen blocks; more blocks make longer keys and keep shards short as the corpus grows. Each shard
is a BK-tree: children are keyed by their Hamming distance to the parent, and a search follows only
edges within the radius of the current distance. Trees and searches meet by the shard key's shuffle,
not by broadcast, because the trees grow with the corpus. A shard reports one edge per linked
fingerprint to the least of its local component; the edges are then contracted globally.

Defined results: NULL and word-less texts have fingerprint 0 and link like any other; documents with
equal fingerprints share a component; a component without any doc_id has NULL as its id; repeated rows
stay. Other columns are not read by `query` and pass through `keep_one`, where clashing names are
safe. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import unused, whole_text
from .graph import components

SHINGLE = 4
RADIUS = 4
SEED = 42
#: Average shard length that the number of blocks aims at.
SHARD_ROWS = 64
_CHUNK = 1 << 16
_FRONTIER = 1 << 22


def fingerprint(text: bytes) -> int:
    """64-bit SimHash of a UTF-8 text; A-Z count as lower case."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    first, last = begins[: max(1, len(words) - SHINGLE + 1)].tolist(), ends[min(SHINGLE, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip(first, last)], dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _CHUNK):
        part = hashes[at: at + _CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.array([fingerprint(t.as_py()) for t in batch.column(1)], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["row_key", "fp"])


def fingerprints(docs: DataFrame, key: str) -> DataFrame:
    """(row_key, fp): one row per row of docs."""
    own = docs.select(F.col(key).cast("long").alias("row_key"), whole_text().cast("binary").alias("text"))
    return own.mapInArrow(_hash_batches, "row_key long, fp long")


def shard_masks(blocks: int) -> list[int]:
    """Bit masks of all choices of `blocks - RADIUS` blocks."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(blocks)]
    return [sum(parts[i] for i in choice) for choice in combinations(range(blocks), blocks - RADIUS)]


def blocks_for(count: int) -> int:
    """The fewest blocks whose keys are long enough for shards of `SHARD_ROWS` on average."""
    blocks = RADIUS + 1
    while count / 2 ** (64 * (blocks - RADIUS) / blocks) > SHARD_ROWS:
        blocks += 1
    return blocks


class Forest:
    """BK-trees of many shards, built level by level: a group's first row is its node, the rest descend."""

    def __init__(self, shard: np.ndarray, prints: np.ndarray):
        self.prints = prints
        size = len(prints)
        self.root = np.zeros(size, dtype=np.int64)
        parents, edges, nodes = [], [], []
        rows = np.argsort(shard, kind="stable")
        _, group = np.unique(shard[rows], return_inverse=True)
        level = 0
        while len(rows):
            starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            node = rows[starts]
            lengths = np.diff(np.r_[starts, len(rows)])
            over = np.repeat(node, lengths)
            if level == 0:
                self.root[rows] = over
            rest = np.ones(len(rows), dtype=bool)
            rest[starts] = False
            rows, over = rows[rest], over[rest]
            distance = np.bitwise_count(prints[rows] ^ prints[over]).astype(np.int64)
            key = over * 128 + distance
            order = np.argsort(key, kind="stable")
            rows, group = rows[order], key[order]
            child = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(rows) else np.zeros(0, np.int64)
            nodes.append(rows[child])
            parents.append(group[child] // 128)
            edges.append(group[child] % 128)
            level += 1
        if nodes:
            node, key = np.concatenate(nodes), np.concatenate(parents) * 128 + np.concatenate(edges)
            order = np.argsort(key, kind="stable")
            self.child, self.key = node[order], key[order]
        else:
            self.child = self.key = np.zeros(0, dtype=np.int64)

    def links(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (row, node) within the radius, in bounded pieces; a frontier that grows is split."""
        size = len(self.prints)
        stack = [(np.arange(a, min(a + _CHUNK, size)), self.root[a: a + _CHUNK]) for a in range(0, size, _CHUNK)]
        while stack:
            row, node = stack.pop()
            if len(row) > _FRONTIER:
                half = len(row) // 2
                stack += [(row[:half], node[:half]), (row[half:], node[half:])]
                continue
            distance = np.bitwise_count(self.prints[row] ^ self.prints[node]).astype(np.int64)
            near = (distance <= RADIUS) & (row != node)
            if near.any():
                yield row[near], node[near]
            low = np.searchsorted(self.key, node * 128 + np.maximum(distance - RADIUS, 0))
            high = np.searchsorted(self.key, node * 128 + distance + RADIUS, side="right")
            width = high - low
            if total := int(width.sum()):
                at = np.arange(total) - np.repeat(np.cumsum(width) - width, width) + np.repeat(low, width)
                stack.append((np.repeat(row, width), self.child[at]))


def _merge(label: np.ndarray, one: np.ndarray, other: np.ndarray) -> None:
    """Lower labels in place until linked rows agree; labels are row numbers."""
    while True:
        a, b = label[one], label[other]
        apart = a != b
        if not apart.any():
            return
        one, other = one[apart], other[apart]
        a, b = a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            hop = label[label]
            if np.array_equal(hop, label):
                break
            label[:] = hop


def shard_edges(shard: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, least of its local component) for linked fingerprints of the given shards."""
    label = np.arange(len(prints))
    for row, node in Forest(shard, prints).links():
        _merge(label, row, node)
    moved = np.flatnonzero(label != np.arange(len(prints)))
    return prints[moved], prints[label[moved]]


def _shard_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by shard; whole shards are searched as soon as enough rows are there."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def searched(shard: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
        a, b = shard_edges(shard, prints.view(np.uint64))
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        if sum(len(s) for s, _ in held) >= 4 * _CHUNK:
            shard, prints = (np.concatenate(x) for x in zip(*held))
            whole = int(np.searchsorted(shard, shard[-1]))
            if whole:
                yield from searched(shard[:whole], prints[:whole])
            held = [(shard[whole:], prints[whole:])]
    if held:
        yield from searched(*(np.concatenate(x) for x in zip(*held)))


def near_edges(distinct: DataFrame, blocks: int) -> DataFrame:
    """(a, b): edges that connect every two fingerprints within the radius. `distinct` has a column fp."""
    shards = F.array(*[
        F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(mask - (1 << 64) if mask >> 63 else mask))
        for i, mask in enumerate(shard_masks(blocks))
    ])
    return (distinct.select(F.explode(shards).alias("shard"), "fp")
            .repartition("shard").sortWithinPartitions("shard")
            .mapInArrow(_shard_batches, "a long, b long"))


def groups(prints: DataFrame) -> DataFrame:
    """(fp, component_id): the least row_key among all rows reachable from the fingerprint."""
    distinct = materialise(prints.groupBy("fp").agg(F.min("row_key").alias("first")), "simhash-distinct")
    edges = near_edges(distinct.select("fp"), blocks_for(distinct.count()))
    roots = components(edges, "a", "b")
    linked = distinct.join(roots, distinct["fp"] == roots["u"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    return linked.join(least, "root").select("fp", "component_id")


def query(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint as 16 hexadecimal digits, component_id."""
    prints = materialise(fingerprints(docs, "doc_id"), "simhash")
    return prints.join(groups(prints), "fp").select(
        F.col("row_key").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The document with the least doc_id of every component; rows of one doc_id stay or go together.

    Rows with NULL doc_id have no place in the order and stay.
    """
    key = unused(docs, "_doc_id")
    prints = materialise(fingerprints(docs, "doc_id"), "simhash")
    gone = prints.join(groups(prints), "fp").where("row_key != component_id").select(F.col("row_key").alias(key)).distinct()
    return docs.join(gone, docs["doc_id"] == gone[key], "left_anti").select(*docs.columns)
