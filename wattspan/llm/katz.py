"""Katz backoff bigram model: Good-Turing discounts and exactly normalised backoff weights.

Training and scoring never shuffle texts. A task turns its documents into chunks of word numbers, each
with its own list of distinct word hashes. Chunk lists meet in shards of the unigram table, which
return a global id and the training count of every word. Word pairs then meet in shards of the bigram
table, stored per shard in the shared folder; a shard derives its contexts' backoff weights and sends
back one sum of log probabilities per document of a chunk. A token's probability is evaluated
recursively: the discounted pair where it was seen, else the context's backoff weight times the
unigram, which itself backs off to unseen words. A context that holds more than 1 / `HOT_SHARE` of all
tokens is spread over all shards by its next word; there are at most `HOT_SHARE` of those, and their
sums are combined before scoring.

The text's start has the end token of the text before as context. Unseen words share the unigram mass
that discounting frees, over as many unseen types as there are words seen once. A context all of whose
counts are too high for discounts keeps one pseudo-count for backing off. Both distributions sum to
one.

Defined results: NULL text counts as empty and scores its end token; rows with NULL doc_id train and
are not held out; repeated rows count each; without training rows every score is 0. Other columns are
not read. An empty table gives an empty table. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialise
from .common import whole_text

CHUNK_TOKENS = 1_500_000
SHARD_TOKENS = 4_000_000
HOT_SHARE = 1000
#: Counts up to this one are discounted.
DISCOUNTED = 5


def packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values, dtype="<i8").tobytes())


def unpacked(blob: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype="<i8")


def _rows(names: list[str], kinds: list[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)


class _Numbers(dict):
    """Words to numbers, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


# --- chunks ---------------------------------------------------------------------------------------

_CHUNK_SCHEMA = ("chunk long, doc_ids array<long>, train binary, sizes binary, tokens binary, words binary")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["chunk", "doc_ids", "train", "sizes", "tokens", "words"]
    kinds = [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 4]
    part, made = TaskContext.get().partitionId() << 32, 0
    numbers, ids, train, tokens, held = _Numbers(), [], [], [], 0

    def row() -> pa.RecordBatch:
        words = np.array([xxhash.xxh64_intdigest(w) for w in numbers], dtype=np.uint64).view(np.int64)
        return _rows(names, kinds, [(part + made, ids, packed(np.array(train)), packed(np.array([len(t) for t in tokens])),
                                     packed(np.concatenate(tokens)), packed(words))])

    for batch in batches:
        for key, trained, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            words = text.as_py().lower().split()
            words.append(b"")  # the end token: no word is empty
            ids.append(key)
            train.append(int(trained))
            tokens.append(np.array(list(map(numbers.__getitem__, words)), dtype=np.int32))
            held += len(words)
            if held >= CHUNK_TOKENS:
                yield row()
                numbers, ids, train, tokens, held, made = _Numbers(), [], [], [], 0, made + 1
    if ids:
        yield row()


# --- unigrams -------------------------------------------------------------------------------------

def _shard_of(words: np.ndarray, shards: int) -> np.ndarray:
    return (words.view(np.uint64) % np.uint64(shards)).astype(np.int64)


def _groups(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(key, positions in order) for each distinct key."""
    order = np.argsort(keys, kind="stable")
    cuts = np.flatnonzero(np.r_[True, np.diff(keys[order]) != 0]) if len(order) else np.zeros(0, np.int64)
    for a, b in zip(cuts, np.r_[cuts[1:], len(order)]):
        yield int(keys[order[a]]), order[a:b]


def _word_requests(shards: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                tokens, words = unpacked(r["tokens"]), unpacked(r["words"])
                mask = np.repeat(unpacked(r["train"]), unpacked(r["sizes"])) == 1
                counts = np.bincount(tokens[mask], minlength=len(words))
                yield _rows(["shard", "chunk", "words", "counts"], [pa.int64(), pa.int64(), pa.binary(), pa.binary()],
                            [(s, r["chunk"], packed(words[at]), packed(counts[at]))
                             for s, at in _groups(_shard_of(words, shards))])

    return send


def _count_stats(counts: np.ndarray) -> list[int]:
    """Total, seen types, and how many types have each count up to one past the discounted ones."""
    low = np.bincount(counts[counts <= DISCOUNTED + 1], minlength=DISCOUNTED + 2)
    return [int(counts.sum()), int((counts > 0).sum()), *map(int, low[1: DISCOUNTED + 2])]


_STATS = DISCOUNTED + 3
_REPLY_SCHEMA = "shard long, chunk long, ids binary, counts binary, stats array<long>"


def _count_words(shards: int):
    def count(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
        parts = [(unpacked(r["words"]), unpacked(r["counts"])) for r in rows]
        kinds, at = np.unique(np.concatenate([w for w, _ in parts]), return_inverse=True)
        total = np.zeros(len(kinds), dtype=np.int64)
        np.add.at(total, at, np.concatenate([c for _, c in parts]))
        shard, out, begin = rows[0]["shard"], [], 0
        for r, (words, _) in zip(rows, parts):
            own = at[begin: begin + len(words)]
            begin += len(words)
            stats = _count_stats(total) if not out else [0] * _STATS
            out.append((shard, r["chunk"], packed(own * shards + shard), packed(total[own]), stats))
        return pa.Table.from_batches([_rows(["shard", "chunk", "ids", "counts", "stats"],
                                            [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())], out)])

    return count


def _totals(table: DataFrame) -> list[int]:
    row = table.agg(*[F.sum(F.get("stats", F.lit(i))).alias(f"s{i}") for i in range(_STATS)]).first()
    return [int(v or 0) for v in row]


def discounts(count_of_counts: list[int]) -> np.ndarray:
    """Factor by count: index 0 unused, then 1..DISCOUNTED; higher counts keep 1.

    Good-Turing where the counts of counts allow a factor between 0 and 1, else absolute discounting.
    """
    n = [0, *count_of_counts]
    step = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
    step = min(max(step, 0.05), 0.95)
    common = (DISCOUNTED + 1) * n[DISCOUNTED + 1] / n[1] if n[1] else 1.0
    factors = np.ones(DISCOUNTED + 1)
    for r in range(1, DISCOUNTED + 1):
        turing = (((r + 1) * n[r + 1] / n[r] / r - common) / (1 - common)) if n[r] and common < 1 else 0.0
        factors[r] = turing if 0 < turing < 1 else 1 - step / r
    return factors


class Unigram:
    """Discounted unigram probabilities by training count; 0 stands for any one unseen word."""

    def __init__(self, stats: list[int]):
        self.total, self.types = stats[0], stats[1]
        self.factors = discounts(stats[2:])
        low = np.array(stats[2: 2 + DISCOUNTED], dtype=float)
        r = np.arange(1, DISCOUNTED + 1)
        freed = float((low * r * (1 - self.factors[1:])).sum()) / self.total if self.total else 1.0
        if self.total and freed <= 0:
            freed = 1.0 / (self.total + 1)
            self.scale = 1 - freed
        else:
            self.scale = 1.0
        self.unseen = freed / max(1, stats[2])

    def probability(self, counts: np.ndarray) -> np.ndarray:
        factor = np.where(counts <= DISCOUNTED, self.factors[np.minimum(counts, DISCOUNTED)], 1.0)
        return np.where(counts > 0, factor * counts / max(1, self.total) * self.scale, self.unseen)


def _attach(shards: int, total: int, types: int):
    """A chunk with the ids and counts of its words, and its documents' base figures."""
    def join(chunks: pa.Table, replies: pa.Table) -> pa.Table:
        out = []
        for r in chunks.to_pylist():
            words, tokens, sizes = unpacked(r["words"]), unpacked(r["tokens"]), unpacked(r["sizes"])
            ids, counts = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
            place = dict(_groups(_shard_of(words, shards)))
            for reply in replies.to_pylist():
                at = place[reply["shard"]]
                ids[at], counts[at] = unpacked(reply["ids"]), unpacked(reply["counts"])
            logs = np.log10((counts + 0.5) / (total + 0.5 * (types + 1)))
            out.append((r["chunk"], r["doc_ids"], r["train"], r["sizes"], r["tokens"], packed(ids), packed(counts),
                        np.add.reduceat(logs[tokens], _starts(sizes)).tolist(),
                        np.add.reduceat((counts[tokens] > 0).astype(np.int64), _starts(sizes)).tolist()))
        kinds = [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 5, pa.list_(pa.float64()), pa.list_(pa.int64())]
        return pa.Table.from_batches([_rows(["chunk", "doc_ids", "train", "sizes", "tokens", "ids", "counts", "base", "known"], kinds, out)])

    return join


_READY_SCHEMA = ("chunk long, doc_ids array<long>, train binary, sizes binary, tokens binary, ids binary, "
                 "counts binary, base array<double>, known array<long>")


def _hot_ids(limit: float):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(unpacked(r["ids"])[unpacked(r["counts"]) > limit], pa.int64())], names=["id"])

    return find


# --- bigrams --------------------------------------------------------------------------------------

def _contexts(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The token before each one; a document's first token follows an end token."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[_starts(sizes)] = tokens[-1]  # each document ends with the end token
    return before


def _pair_shard(h: np.ndarray, w: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    mixed = (h.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
    spread = np.where(np.isin(h, hot), w, 0).astype(np.uint64)
    return ((mixed + spread) % np.uint64(shards)).astype(np.int64)


def _train_pairs(shards: int, hot: np.ndarray):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                tokens, sizes = unpacked(r["tokens"]), unpacked(r["sizes"])
                ids, counts = unpacked(r["ids"]), unpacked(r["counts"])
                mask = np.repeat(unpacked(r["train"]), sizes) == 1
                both = (_contexts(tokens, sizes) * len(ids) + tokens)[mask]
                both, times = np.unique(both, return_counts=True)
                first, second = both // len(ids), both % len(ids)
                h, w = ids[first], ids[second]
                for s, at in _groups(_pair_shard(h, w, hot, shards)):
                    yield _rows(["shard", "h", "w", "count", "word_count"], [pa.int64(), *[pa.binary()] * 4],
                                [(s, packed(h[at]), packed(w[at]), packed(times[at]), packed(counts[second[at]]))])

    return send


_TABLE_SCHEMA = "shard long, h binary, w binary, count binary, word_count binary, stats array<long>"


def _count_pairs(table: pa.Table) -> pa.Table:
    rows = table.to_pylist()
    h, w, count, word = (np.concatenate([unpacked(r[k]) for r in rows]) for k in ("h", "w", "count", "word_count"))
    order = np.lexsort((w, h))
    h, w, count, word = h[order], w[order], count[order], word[order]
    first = np.flatnonzero(np.r_[True, (np.diff(h) != 0) | (np.diff(w) != 0)]) if len(h) else np.zeros(0, np.int64)
    count = np.add.reduceat(count, first) if len(first) else count
    row = (rows[0]["shard"], packed(h[first]), packed(w[first]), packed(count), packed(word[first]), _count_stats(count))
    return pa.Table.from_batches([_rows(["shard", "h", "w", "count", "word_count", "stats"],
                                        [pa.int64(), *[pa.binary()] * 4, pa.list_(pa.int64())], [row])])


class Contexts:
    """Sums over a shard's pairs by context: occurrences, discounted occurrences, unigram mass seen."""

    def __init__(self, h: np.ndarray, count: np.ndarray, word_count: np.ndarray, unigram: Unigram, factors: np.ndarray):
        self.first = np.flatnonzero(np.r_[True, np.diff(h) != 0]) if len(h) else np.zeros(0, np.int64)
        self.h = h[self.first]
        factor = np.where(count <= DISCOUNTED, factors[np.minimum(count, DISCOUNTED)], 1.0)
        sums = (lambda x: np.add.reduceat(x, self.first)) if len(h) else (lambda x: x)
        self.total = sums(count.astype(float))
        self.kept = sums(factor * count)
        self.mass = sums(unigram.probability(word_count))

    def weights(self) -> tuple[np.ndarray, np.ndarray]:
        """(scale of a seen pair's discounted count, backoff weight) by context."""
        free = self.total - self.kept
        none = free <= 1e-9 * np.maximum(self.total, 1)
        scale = np.where(none, 1 / (self.total + 1), 1 / np.maximum(self.total, 1))
        left = np.where(none, 1 / (self.total + 1), free / np.maximum(self.total, 1))
        return scale, left / np.maximum(1 - self.mass, 1e-12)


def _hot_sums(hot: np.ndarray, unigram: Unigram, factors: np.ndarray):
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                c = Contexts(unpacked(r["h"]), unpacked(r["count"]), unpacked(r["word_count"]), unigram, factors)
                at = np.isin(c.h, hot)
                yield pa.RecordBatch.from_arrays([pa.array(c.h[at], pa.int64()), *[pa.array(x[at], pa.float64()) for x in (c.total, c.kept, c.mass)]],
                                                 names=["h", "total", "kept", "mass"])

    return sums


def _occurrences(shards: int, hot: np.ndarray):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                tokens, sizes = unpacked(r["tokens"]), unpacked(r["sizes"])
                ids, counts = unpacked(r["ids"]), unpacked(r["counts"])
                h, w = ids[_contexts(tokens, sizes)], ids[tokens]
                doc = np.repeat(np.arange(len(sizes)), sizes)
                word = counts[tokens]
                for s, at in _groups(_pair_shard(h, w, hot, shards)):
                    at = at[np.lexsort((w[at], h[at]))]  # equal neighbours pack well
                    yield _rows(["shard", "chunk", "h", "w", "word_count", "doc", "docs"],
                                [pa.int64(), pa.int64(), *[pa.binary()] * 4, pa.int64()],
                                [(s, r["chunk"], packed(np.diff(h[at], prepend=0)), packed(w[at]), packed(word[at]), packed(doc[at]), len(sizes))])

    return send


def _score(unigram: Unigram, factors: np.ndarray, hot: dict[int, tuple[float, float, float]]):
    def join(wanted: pa.Table, stored: pa.Table) -> pa.Table:
        kept = stored.to_pylist()
        h, w, count, word = ((unpacked(kept[0][k]) for k in ("h", "w", "count", "word_count")) if kept
                             else (np.zeros(0, np.int64) for _ in range(4)))
        contexts = Contexts(h, count, word, unigram, factors)
        for i in np.flatnonzero(np.isin(contexts.h, np.array(sorted(hot), dtype=np.int64))):
            contexts.total[i], contexts.kept[i], contexts.mass[i] = hot[int(contexts.h[i])]
        # Every shard knows the hot contexts, also those of which it stores no pair.
        hot_h = np.array(sorted(hot), dtype=np.int64)
        far = Contexts(hot_h, np.ones(len(hot_h), np.int64), np.ones(len(hot_h), np.int64), unigram, factors)
        far.total, far.kept, far.mass = (np.array([hot[int(x)][i] for x in hot_h]) for i in range(3))
        far_log = np.log10(far.weights()[1])
        scale, backoff = contexts.weights()
        which = np.repeat(np.arange(len(contexts.h)), np.diff(np.r_[contexts.first, len(h)]))
        span = int(w.max()) + 2 if len(w) else 2
        key = which * span + w
        factor = np.where(count <= DISCOUNTED, factors[np.minimum(count, DISCOUNTED)], 1.0)
        seen_log = np.log10(factor * count * scale[which])
        back_log = np.log10(backoff)
        out = []
        for r in wanted.to_pylist():
            hh, ww = np.cumsum(unpacked(r["h"])), unpacked(r["w"])
            logs = np.log10(unigram.probability(unpacked(r["word_count"])))
            if len(hot_h):
                near = np.minimum(np.searchsorted(hot_h, hh), len(hot_h) - 1)
                far_known = (hot_h[near] == hh) & ~np.isin(hh, contexts.h)
                logs = logs + np.where(far_known, far_log[near], 0.0)
            if len(contexts.h):
                at = np.minimum(np.searchsorted(contexts.h, hh), len(contexts.h) - 1)
                known = contexts.h[at] == hh
                sought = at * span + np.minimum(ww, span - 1)
                found = np.minimum(np.searchsorted(key, sought), len(key) - 1)
                seen = known & (key[found] == sought)
                logs = np.where(seen, seen_log[found], logs + np.where(known, back_log[at], 0.0))
            out.append((r["chunk"], np.bincount(unpacked(r["doc"]), weights=logs, minlength=r["docs"]).tolist()))
        return pa.Table.from_batches([_rows(["chunk", "sums"], [pa.int64(), pa.list_(pa.float64())], out)])

    return join


def _finish(total: int):
    def join(chunks: pa.Table, sums: pa.Table) -> pa.Table:
        rows = []
        for r in chunks.to_pylist():
            score = np.sum([np.array(s) for s in sums.column("sums").to_pylist()], axis=0)
            rows += zip(r["doc_ids"], (unpacked(r["train"]) == 0).tolist(), unpacked(r["sizes"]).tolist(), r["known"],
                        [total] * len(score), r["base"], score.tolist())
        return pa.Table.from_batches([_rows(
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()], rows)])

    return join


def trained_on(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 != 1, F.lit(True))


def query(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 of the text)."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), trained_on(F.col("doc_id")).alias("train"),
                      whole_text().cast("binary").alias("text"))
    chunks = materialise(own.mapInArrow(_chunks, _CHUNK_SCHEMA), "katz-chunks")
    size = chunks.agg(F.sum(F.size("doc_ids")), F.count(F.lit(1))).first()
    shards = max(4, round((size[1] or 0) * CHUNK_TOKENS / SHARD_TOKENS))

    requests = chunks.select("chunk", "train", "sizes", "tokens", "words").mapInArrow(
        _word_requests(shards), "shard long, chunk long, words binary, counts binary")
    replies = materialise(requests.groupBy("shard").applyInArrow(_count_words(shards), _REPLY_SCHEMA), "katz-unigrams")
    stats = _totals(replies)
    unigram = Unigram(stats)
    hot = np.array([r[0] for r in replies.select("ids", "counts").mapInArrow(
        _hot_ids(unigram.total / HOT_SHARE), "id long").distinct().orderBy("id").collect()], dtype=np.int64)
    ready = materialise(chunks.groupBy("chunk").cogroup(replies.drop("stats").groupBy("chunk")).applyInArrow(
        _attach(shards, unigram.total, unigram.types), _READY_SCHEMA), "katz-ready")
    discard(chunks)
    discard(replies)

    pairs = ready.select("train", "sizes", "tokens", "ids", "counts").mapInArrow(
        _train_pairs(shards, hot), "shard long, h binary, w binary, count binary, word_count binary")
    bigrams = materialise(pairs.groupBy("shard").applyInArrow(_count_pairs, _TABLE_SCHEMA), "katz-bigrams")
    factors = discounts(_totals(bigrams)[2:])
    sums = {r["h"]: (r["total"], r["kept"], r["mass"]) for r in bigrams.select("h", "count", "word_count").mapInArrow(
        _hot_sums(hot, unigram, factors), "h long, total double, kept double, mass double").groupBy("h").agg(
            *[F.sum(c).alias(c) for c in ("total", "kept", "mass")]).collect()}
    wanted = ready.select("chunk", "sizes", "tokens", "ids", "counts").mapInArrow(
        _occurrences(shards, hot), "shard long, chunk long, h binary, w binary, word_count binary, doc binary, docs long")
    scored = materialise(wanted.groupBy("shard").cogroup(bigrams.drop("stats").groupBy("shard")).applyInArrow(
        _score(unigram, factors, sums), "chunk long, sums array<double>"), "katz-sums")
    discard(bigrams)
    return (ready.select("chunk", "doc_ids", "train", "sizes", "base", "known").groupBy("chunk")
            .cogroup(scored.groupBy("chunk")).applyInArrow(
                _finish(unigram.total), "doc_id long, held_out boolean, n_tokens long, n_known long, "
                                        "train_tokens long, base_score double, score double"))
