"""Byte-level BPE: encoding by ranked merges, decoding by joining binary pieces.

The corpus' most frequent distinct words are encoded by Spark: higher-order functions fold ranked
merges over each word's byte array, looking ranks up in a literal table of hash buckets. Their number
is bounded (`FREQUENT_WORDS`), so they travel to the tasks as a table. Sending every distinct word's
ids back to every document would shuffle more than the texts themselves; the rest are therefore merged
inside the tasks that read the texts, by the same ranked merges, once per distinct word of a task. The
frequent words only save work: results don't depend on them.

Defined results: NULL text counts as empty: no ids, the hash of an empty string; rows are encoded one
by one, with repeated or NULL doc_id too; very long words are merged with a heap in n log n. Other
columns are not read. An empty table gives an empty table.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, whole_text

FREQUENT_WORDS = 20_000
FREQUENT_BYTES = 24
_BUCKETS = 1 << 15
_CACHE = 300_000
_SHORT = 48
_NONE = 1 << 30

#: Unicode white space, as the split pattern's \s means it.
_SPACE = "\t-\r \x85\xa0  -     　"
#: Coarse cut: a blank may lead a run of other characters. Every finer cut stays inside these runs.
_RUNS = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks from lines of `base64 rank`."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def read_json_ranks(path: str) -> dict[bytes, int]:
    """Ranks from a tokenizer file whose tokens are printable stand-ins for bytes."""
    with open(path, encoding="utf-8") as file:
        tokens = json.load(file)["model"]["vocab"]
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    return {bytes(byte_of[c] for c in t): i for t, i in tokens.items() if all(c in byte_of for c in t)}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: always merge the leftmost pair of least rank."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > _SHORT:
        return _merge_long(word, ranks)
    parts = [word[i: i + 1] for i in range(len(word))]
    pairs = [ranks.get(a + b, _NONE) for a, b in zip(parts, parts[1:])]
    while pairs and (least := min(pairs)) < _NONE:
        i = pairs.index(least)
        parts[i] += parts.pop(i + 1)
        pairs.pop(i)
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], _NONE)
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], _NONE)
    return [ranks[p] for p in parts]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges with a heap of pairs over a linked list."""
    size = len(word)
    end, previous = list(range(1, size + 1)), list(range(-1, size - 1))
    alive = [True] * size

    def rank(i: int) -> int | None:
        j = end[i]
        return ranks.get(word[i: end[j]]) if j < size else None

    heap = [(r, i, end[end[i]]) for i in range(size - 1) if (r := rank(i)) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or end[i] >= size or end[end[i]] != stop:
            continue
        j = end[i]
        alive[j], end[i] = False, stop
        if stop < size:
            previous[stop] = i
            if (r := rank(i)) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (before := previous[i]) >= 0 and (r := rank(before)) is not None:
            heapq.heappush(heap, (r, before, stop))
    ids, i = [], 0
    while i < size:
        ids.append(ranks[word[i: end[i]]])
        i = end[i]
    return ids


class Recent(dict):
    """A cache of two generations: the younger one fills up, then it becomes the older one."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, key: str) -> bytes:
        made = self.older.get(key)
        if made is None:
            made = self.make(key)
        if len(self) >= _CACHE:
            self.older = dict(self)
            self.clear()
        self[key] = made
        return made


class Encoder:
    """Texts to ids as packed little-endian 32-bit integers, with caches of bounded size."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, frequent: dict[str, list[int]] | None = None,
                 encode_run: Callable[[str], list[int]] | None = None):
        """`encode_run` replaces the cut into words and their merges."""
        self.ranks, self.cut = ranks, regex.compile(pattern).findall
        self.frequent = {w: self._pack(ids) for w, ids in (frequent or {}).items()}
        run = (lambda r: self._pack(encode_run(r))) if encode_run else self._run
        self.words, self.runs = Recent(self._word), Recent(run)

    @staticmethod
    def _pack(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: str) -> bytes:
        return self.frequent.get(word) or self._pack(merge(word.encode("utf-8"), self.ranks))

    def _run(self, run: str) -> bytes:
        return b"".join([self.words[w] for w in self.cut(run)])

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.runs.__getitem__, _RUNS.findall(text)))


def _latin(word: bytes) -> str:
    return word.decode("latin-1")


def _rank_table(ranks: dict[bytes, int]) -> Column:
    """A literal array of hash buckets of (bytes as Latin-1 characters, rank)."""
    buckets: list[list[dict]] = [[] for _ in range(_BUCKETS)]
    for word, rank in ranks.items():
        if len(word) <= FREQUENT_BYTES:
            key = _latin(word)
            buckets[xxhash.xxh64_intdigest(key.encode("utf-8"), 42) % _BUCKETS].append({"t": key, "r": rank})
    return F.from_json(F.lit(json.dumps(buckets)), "array<array<struct<t:string,r:int>>>")


def fold_merges(word: Column, ranks: dict[bytes, int]) -> Column:
    """Ids of a word of at most `FREQUENT_BYTES` bytes: ranked merges folded over its byte array."""
    table = _rank_table(ranks)

    def rank(key: Column) -> Column:
        bucket = F.get(table, F.xxhash64(key).bitwiseAND(_BUCKETS - 1).cast("int"))
        return let(key, lambda k: F.get(F.filter(bucket, lambda e: e["t"] == k), F.lit(0))["r"])

    def step(parts: Column, _: Column) -> Column:
        found = F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(parts) - 2, F.lit(0))),
            lambda i: rank(F.concat(F.get(parts, i), F.get(parts, i + 1))),
        )

        def joined(all_ranks: Column) -> Column:
            i = F.array_position(all_ranks, F.array_min(all_ranks)).cast("int")
            return F.when(F.array_min(all_ranks).isNull(), parts).otherwise(F.concat(
                F.slice(parts, F.lit(1), i - 1),
                F.array(F.concat(F.get(parts, i - 1), F.get(parts, i))),
                F.slice(parts, i + 2, F.size(parts)),
            ))

        return F.when(F.size(parts) < 2, parts).otherwise(let(found, joined))

    def folded(start: Column) -> Column:
        rounds = F.sequence(F.lit(1), F.greatest(F.size(start) - 1, F.lit(1)))
        return F.transform(F.aggregate(rounds, start, step), rank)

    whole = F.decode(F.encode(word, "utf-8"), "iso-8859-1")
    return let(whole, lambda w: F.coalesce(
        F.when(rank(w).isNotNull(), F.array(rank(w))),
        let(F.array_remove(F.split(w, ""), ""), folded),
    ))


def frequent_words(docs: DataFrame, pattern: str, rows: int) -> DataFrame:
    """The most frequent distinct words (at most `rows`) of all documents, counted before the shuffle."""
    cut = F.regexp_extract_all(whole_text(), F.lit(f"(?U){pattern}"), F.lit(0))
    return (docs.select(F.explode(cut).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.octet_length("word") <= FREQUENT_BYTES)
            .orderBy(F.desc("n"), "word").limit(rows))


def query(docs: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, and the hashes of the ids and of the decoded bytes."""
    ranks = read_ranks(rank_path)
    common = frequent_words(docs, pattern, FREQUENT_WORDS).repartition(
        docs.sparkSession.sparkContext.defaultParallelism, "word")
    frequent = {r["word"]: r["ids"] for r in common.select("word", fold_merges(F.col("word"), ranks).alias("ids")).collect()}

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks, pattern, frequent)
        pieces = [b""] * (max(ranks.values()) + 1)
        for word, rank in ranks.items():
            pieces[rank] = word
        decimal = [str(i) for i in range(len(pieces))]
        for batch in batches:
            counts, names, texts = [], [], []
            for text in batch.column(1):
                ids = np.frombuffer(encoder.encode(text.as_py()), dtype="<u4").tolist()
                counts.append(len(ids))
                names.append(hashlib.sha256(" ".join([decimal[i] for i in ids]).encode()).hexdigest())
                texts.append(hashlib.sha256(b"".join([pieces[i] for i in ids])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(names, pa.string()), pa.array(texts, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(
        coded, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
