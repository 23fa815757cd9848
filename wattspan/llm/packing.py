"""Best-fit packing of tokenised documents under several capacities.

Documents become id lists; one longer than a sequence is cut into full pieces, of which the first may
be shorter. A sequence has capacities for tokens, documents and attention cost (the sum of squared
piece lengths). Pieces are placed in order of falling length into the open sequence that the rule
prefers among those that can take the piece under every capacity: least weighted norm of what remains
free, or greatest weighted dot product of demand and free capacity. Pieces are dealt by hash to shards
of about `SHARD_PIECES`, whatever the corpus' size, and a task packs a shard; only lengths and checksums
are shuffled, never texts.

Defined results: NULL text counts as empty and packs as its end id alone; rows are packed one by one,
with repeated or NULL doc_id too; ties go to the lower doc_id, piece and sequence. A piece that alone
exceeds a capacity is refused with an error. Other columns are not read. An empty table gives an empty
table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .bpe import Encoder, read_json_ranks
from .common import whole_text

SHARD_PIECES = 40_000
END_ID = 2


@dataclass(frozen=True)
class Capacity:
    """What one sequence holds. A sum of squares never exceeds the square of the sum, so the default
    attention capacity and document capacity only bind when they are set lower."""

    tokens: int = 1024
    documents: int = 1024
    attention: int = 1024 * 1024
    rule: str = "norm"
    weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3)


def cut(size: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all but the first are full."""
    first = (size - 1) % most + 1
    return [(0, first), *[(at, most) for at in range(first, size, most)]]


def pieces(docs: DataFrame, json_path: str, pattern: str, tokens: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""
    ranks = read_json_ranks(json_path)  # text never becomes a special token, whatever it spells
    end = END_ID.to_bytes(4, "little")

    def tokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        encoder = Encoder(ranks, pattern, encode_run=library.encode_ordinary)
        for batch in batches:
            rows, columns = [], ([], [], [], [])
            for row, text in enumerate(batch.column(1)):
                packed = memoryview(encoder.encode(text.as_py()) + end)
                for number, (start, length) in enumerate(cut(len(packed) // 4, tokens)):
                    rows.append(row)
                    crc = zlib.crc32(packed[4 * start: 4 * (start + length)])
                    for column, value in zip(columns, (number, start, length, crc)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(columns[0], pa.int32()),
                 *[pa.array(c, pa.int64()) for c in columns[1:]]],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(
        tokenised, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) for pieces that come by falling length.

    Open sequences stand in levels by free tokens; a level's last one is its candidate, or the last
    that the other capacities allow.
    """
    if len(lengths) and (lengths.max() > capacity.tokens or int(lengths.max()) ** 2 > capacity.attention
                         or capacity.documents < 1):
        raise ValueError("a piece exceeds a capacity of an empty sequence")
    most, room = capacity.tokens, np.array([capacity.tokens, capacity.documents, capacity.attention], float)
    scale = np.array(capacity.weights)
    levels: list[list[tuple[int, int, int]]] = [[] for _ in range(most + 1)]
    tops = np.zeros((most + 1, 3))
    tops[:, 0] = np.arange(most + 1)
    open_ = np.zeros(most + 1, dtype=bool)
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    made = 0

    def refresh(level: int) -> None:
        open_[level] = bool(levels[level])
        if levels[level]:
            tops[level, 1:] = levels[level][-1][:2]

    for i, length in enumerate(lengths.tolist()):
        demand = np.array([length, 1, length * length], float)
        at = np.flatnonzero(open_[length:]) + length
        chosen = None
        if len(at):
            if capacity.rule == "norm":
                score = (scale * ((tops[at] - demand) / room) ** 2).sum(axis=1)
            else:
                score = -(scale * (tops[at] / room) * (demand / room)).sum(axis=1)
            fits = (tops[at, 1] >= 1) & (tops[at, 2] >= demand[2])
            if fits.all():
                chosen = (int(at[score.argmin()]), -1)
            else:
                for level in at[np.argsort(score, kind="stable")].tolist():
                    found = next((k for k in range(len(levels[level]) - 1, -1, -1)
                                  if levels[level][k][0] >= 1 and levels[level][k][1] >= demand[2]), None)
                    if found is not None:
                        chosen = (level, found)
                        break
        if chosen is None:
            documents, attention, number, level = capacity.documents, capacity.attention, made, most
            made += 1
        else:
            level = chosen[0]
            documents, attention, number = levels[level].pop(chosen[1])
            refresh(level)
        sequence[i], offset[i] = number, most - level
        left = level - length
        if left:
            levels[left].append((documents - 1, attention - length * length, number))
            refresh(left)
    return sequence, offset


def pack(parts: DataFrame, capacity: Capacity = Capacity()) -> DataFrame:
    """Add sequence_id and offset to the rows of `pieces`, which must be a written table."""
    shards = max(1, round(parts.count() / SHARD_PIECES))

    def placed(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        number, offset = best_fit(frame["length"].to_numpy(), capacity)
        shard = frame["shard"].to_numpy().astype(np.int64)
        return frame.drop(columns="shard").assign(sequence_id=(shard << 32) + number, offset=offset)

    kind = parts.schema["doc_id"].dataType.simpleString()
    return (parts.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards)))
            .groupBy("shard").applyInPandas(placed, f"doc_id {kind}, piece int, start long, length long, "
                                                    "ids_crc32 long, sequence_id long, offset long"))


def query(docs: DataFrame, json_path: str, pattern: str, capacity: Capacity = Capacity()) -> DataFrame:
    parts = materialise(pieces(docs, json_path, pattern, capacity.tokens), "packing-pieces")
    return pack(parts, capacity)
