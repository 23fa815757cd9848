"""Near-duplicate passages by compact windows.

A text is its sequence of five-word shingle hashes. For each of `HASHES` hash functions, a Cartesian
tree over the sequence groups all subsequences of at least `LEAST` shingles by the shingle that has
their minimum: one compact window (left, centre, right) per tree node that is long enough. A window
also carries signatures of the shingles just before and just after its centre, one of which lies inside
any passage around it. Windows of different texts with the same minimum and the same signature on one
side become candidates when their intervals overlap enough around the shared shingle. Candidate pairs
fetch both texts, and the longest aligned passage around each shared shingle is verified: at least
`LEAST_WORDS` words and a Jaccard similarity of `SIMILARITY` over its shingles.

Equal texts collapse first and are reported as copies of the one with the least doc_id. The windows of one
minimum and signature form a chain. A first round compares each with the one before it, which unites a
passage that many texts share by about one link per text. The places of chains that still hold several classes
of linked texts are then dealt again, by the shared shingle and each shingle `NEAREST` to `FARTHEST` places before
or after it: a shared line alone no longer joins texts, while a passage does. `ROUNDS` rounds keep one place of
every class in such a group, in an order that changes, and compare each with the `LAGS` before it. At last all
places of different classes in a group are compared, pairs compared earlier left out, so that no two texts that
share a place of a passage in a chain are left uncompared unless other links unite them. Only the pairs of texts
are shuffled for that; the places that two texts share in a group follow from each text's own places.

Verification deals pairs to blocks by their two texts, and sends a text once to each block that compares it. Pairs
without a stretch of `LEAST` shingles of which either text may hold enough of the other's are turned down together.

Rows of a key or chain are worked on in ordered portions; a task holds the rows of one key or chain at once.

Why a group holds them: a passage of 92 shingles or more holds a shorter one of 46 or more, so let it have at most
91. At most 10 of its shingles are not common then. 46 of its shingles around the place hold 17 or more that are
`NEAREST` or more places away, of which 7 are common; an insertion of `d` words costs `d + 4` shingles, so it
moves a shingle by 6 places at most, and 6 at most of the 7 to less than `NEAREST` places.

Defined results: texts of fewer than `LEAST_WORDS` words, NULL and empty texts have no passages and are a
class of their own; rows with NULL doc_id take no part; rows that repeat a doc_id with one text count
once, with several texts they join the texts' classes; A-Z count as lower case.
Repeats inside one document are not reported. Other columns are not read. An empty table gives an empty
table. Texts and shingles are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property, partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialise, task_count
from .common import whole_text
from .graph import components

SHINGLE = 5
LEAST_WORDS = 50
LEAST = LEAST_WORDS - SHINGLE + 1
SIMILARITY = 0.8
HASHES = 4
LAGS = 3
ROUNDS = 2
#: Places between a shared shingle and those that part its chain; the farthest is 45 and the 6 of an insertion.
NEAREST, FARTHEST = 15, 51
#: Shingles on either side that a passage of at most 91 shingles can reach.
_REACH = 90
#: Bytes of texts that are hashed at once.
_PORTION = 1 << 19
#: Rows that a task takes from ordered groups at once, at least.
_ROWS = 1 << 17
#: Rows with whole texts that a task holds at once.
_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "256"}
#: Bytes of texts on either side of a block, and the least number of parts that texts are dealt to.
_BLOCK, _PARTS = 4 << 20, 8
#: So many places of two texts are walked one by one, without judging them together first.
_FEW = 16
#: Bits of a shingle that tell whether a text may hold it.
_MARKS = 13
_SIDE = (LEAST + 1) // 2  # any passage reaches this far from each of its shingles on one side
_SEEDS = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]


_XXH = [np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]
_GAP = np.isin(np.arange(256), list(b" \t\n\v\f\r"))


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _word_hashes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """XXH64 of words of bytes, at least 8 of which follow the last word. Words of one size are hashed at once."""
    long = np.flatnonzero(sizes > 31)
    kinds = np.minimum(sizes, 32).astype(np.uint8)
    order = np.argsort(kinds, kind="stable")
    at, ends = starts[order], np.cumsum(np.bincount(kinds, minlength=33))
    lanes = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    one, two, three, four, five = _XXH
    out = np.empty(len(starts), dtype=np.uint64)
    for size in range(1, 32):
        own = slice(ends[size - 1], ends[size])
        if own.start == own.stop:
            continue
        place = at[own]
        total = np.full(len(place), five + np.uint64(size))
        for _ in range(size // 8):
            total = _turned(total ^ (_turned(lanes[place] * two, 31) * one), 27) * one + four
            place = place + 8
        rest = lanes[place] if size % 8 else None
        if size % 8 >= 4:
            total = _turned(total ^ ((rest & np.uint64(0xFFFFFFFF)) * one), 23) * two + three
            rest = rest >> np.uint64(32)
        for _ in range(size % 4):
            total = _turned(total ^ ((rest & np.uint64(0xFF)) * five), 11) * one
            rest = rest >> np.uint64(8)
        out[order[own]] = total
    out = (out ^ (out >> np.uint64(33))) * two
    out = (out ^ (out >> np.uint64(29))) * three
    out ^= out >> np.uint64(32)
    for k in long.tolist():
        out[k] = xxhash.xxh64_intdigest(data[starts[k]: starts[k] + sizes[k]].tobytes())
    return out


def shingled(texts: list[bytes]) -> list[np.ndarray]:
    """Hashes of the five-word shingles of each UTF-8 text; none if it has fewer words.

    Words are hashed, shingles are sums of their words' hashes with an odd factor for each place.
    """
    joined = b"\n".join([b"", *texts, b" " * 8]).lower()
    data = np.frombuffer(joined, dtype=np.uint8)
    gap = _GAP[data]
    edges = np.flatnonzero(gap[1:] != gap[:-1]) + 1  # starts and ends of words by turns
    starts = edges[::2]
    hashed = _word_hashes(data, starts, edges[1::2] - starts)
    size = max(len(hashed) - SHINGLE + 1, 0)
    total = np.zeros(size, dtype=np.uint64)
    for place in range(SHINGLE):
        total += hashed[place: place + size] * np.uint64(_SEEDS[place])
    total = (total ^ (total >> np.uint64(32))) * np.uint64(_SEEDS[0])
    total ^= total >> np.uint64(29)
    bounds = np.searchsorted(starts, np.cumsum([1, *(len(t) + 1 for t in texts)])).tolist()
    return [total[first: max(last - SHINGLE + 1, first)] for first, last in zip(bounds, bounds[1:])]


def shingles(text: bytes) -> np.ndarray:
    """Hashes of the five-word shingles of one text."""
    return shingled([text])[0]


def _portions(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """(first, stop) of runs of rows with about `_PORTION` bytes each, so that what is computed on a run stays in the cache."""
    first = held = 0
    for k, size in enumerate(sizes):
        held += size
        if held >= _PORTION or k + 1 == len(sizes):
            yield first, k + 1
            first, held = k + 1, 0


def mixed(hashes: np.ndarray, function: int) -> np.ndarray:
    """The value of each shingle under one of the hash functions."""
    v = (hashes ^ np.uint64(_SEEDS[function])) * np.uint64(_SEEDS[(function + 1) % len(_SEEDS)])
    return (v ^ (v >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def compact_windows(values: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(left, centre, right), ends included, of all Cartesian-tree nodes that span `least` or more."""
    found, open_ = [], [(0, len(values))] if len(values) >= least else []
    while open_:
        left, stop = open_.pop()
        centre = left + int(values[left:stop].argmin())
        found.append((left, centre, stop - 1))
        if centre - left >= least:
            open_.append((left, centre))
        if stop - centre - 1 >= least:
            open_.append((centre + 1, stop))
    return found


def _running(values: np.ndarray, size: int, pick: np.ufunc) -> np.ndarray:
    """`pick`, the least or greatest, of each `size` values in a row."""
    held = 1
    while 2 * held <= size:
        values, held = pick(values[:-held], values[held:]), 2 * held
    return pick(values[: len(values) - size + held], values[size - held:]) if size > held else values


def _nearest(values: np.ndarray, first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each value in its run first..stop: one past the last before it that is no greater, and the first after it that is less."""
    n, most = len(values), int((stop - first).max())
    least = [values]
    while 2 << len(least) - 1 <= most:
        half = 1 << len(least) - 1
        least.append(np.minimum(least[-1][:-half], least[-1][half:]))
    before, after = np.arange(n), np.arange(1, n + 1)
    for k in range(len(least) - 1, -1, -1):
        step, block = 1 << k, least[k]
        at = before - step
        before = np.where((at >= 0) & (block[np.maximum(at, 0)] > values), at, before)
        held = (after + step <= n) & (block[np.minimum(after, n - step)] >= values)
        after = np.where(held, after + step, after)
    return np.maximum(before, first), np.minimum(after, stop)


def _windows(hashes: list[np.ndarray], text_ids: np.ndarray) -> list[np.ndarray]:
    """key, text_id, centre, left, right and both signatures of the compact windows of texts, as `compact_windows` finds them.

    Texts lie in one array with gaps between them. A node of a tree that spans `LEAST` or more is the minimum of
    `LEAST` values in a row, and so are the nearest lesser values on its sides.
    """
    gap = LEAST - 1
    sizes = np.array([len(h) for h in hashes], dtype=np.int64)
    start = np.cumsum(sizes + gap) - sizes
    n = int(start[-1] + sizes[-1]) + gap
    owner = np.repeat(np.arange(len(sizes)), sizes)
    inside = np.arange(len(owner)) + np.repeat(start - np.cumsum(sizes) + sizes, sizes)
    flat = np.concatenate(hashes)
    side = np.full(n, ~np.uint64(0))
    side[inside] = mixed(flat, HASHES)
    signs = (_running(side, _SIDE + 1, np.minimum) >> np.uint64(33)).astype(np.int64)
    found = []
    for function in range(HASHES):
        values = np.zeros(n, dtype=np.uint64)
        values[inside] = mixed(flat, function)
        most = _running(_running(values, LEAST, np.minimum), LEAST, np.maximum)  # of the minima around each place
        held = np.flatnonzero(values[inside] == most[inside - gap])
        found.append((inside[held], owner[held], values[inside[held]]))
    run = np.concatenate([own + k * len(sizes) for k, (_, own, _) in enumerate(found)])
    at, own, values = (np.concatenate(x) for x in zip(*found))
    first, stop = np.searchsorted(run, run), np.searchsorted(run, run, side="right")
    before, after = _nearest(values, first, stop)
    left = np.where(before > first, at[before - 1] + 1, start[own])
    right = np.where(after < stop, at[np.minimum(after, len(at) - 1)], start[own] + sizes[own]) - 1
    wide = right - left + 1 >= LEAST
    at, own, left, right, values = at[wide], own[wide], left[wide], right[wide], values[wide]
    return [values.view(np.int64), text_ids[own], at - start[own], at - left, right - at, signs[at - _SIDE], signs[at]]


def _window_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["key", "text_id", "centre", "left", "right", "sign_before", "sign_after"]
    kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 5]
    seen: set[int] = set()
    for batch in batches:
        own = {text_id: text for text_id, text in zip(*(c.to_pylist() for c in batch.columns)) if text_id not in seen}
        seen.update(own)
        ids, held = list(own), list(own.values())
        for first, stop in _portions([len(t) for t in held]):
            long = [(i, h) for i, h in zip(ids[first:stop], shingled(held[first:stop])) if len(h) >= LEAST]
            if long:
                found = _windows([h for _, h in long], np.array([i for i, _ in long], dtype=np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()).cast(k) for c, k in zip(found, kinds)], names=names)


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text_id, text) of the rows that take part."""
    return (docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
            .where(F.length("text") >= 2 * LEAST_WORDS - 1).withColumn("text_id", F.xxhash64("text")))


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns of rows that come in the order of the first, in portions of `_ROWS` or more that end where a group ends."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(len(x) for x in held) < _ROWS:
            continue
        column = batch.column(0).to_numpy()
        stop = int(np.searchsorted(column, column[-1])) if len(column) else 0
        if stop or len(held) > 1 and held[-2].column(0)[-1] != batch.column(0)[0]:
            yield _columns([*held[:-1], batch.slice(0, stop)])
            held = [batch.slice(stop)]
    if held:
        yield _columns(held)


def _columns(batches: list[pa.RecordBatch]) -> list[np.ndarray]:
    table = pa.Table.from_batches(batches)
    return [c.to_numpy() for c in table.columns]


def _several(group: np.ndarray, member: np.ndarray) -> np.ndarray:
    """Which rows, ordered by group, are in a group with different members."""
    if not len(group):
        return np.zeros(0, dtype=bool)
    starts = np.concatenate([[0], np.flatnonzero(group[1:] != group[:-1]) + 1])
    several = np.minimum.reduceat(member, starts) != np.maximum.reduceat(member, starts)
    return np.repeat(several, np.diff(starts, append=len(group)))


def _chain_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows come by key. Those of one key and one signature form a chain, if they are of several texts."""
    names = ["chain", "text_id", "centre", "left", "right"]
    for columns in _whole_groups(batches):
        kept = _several(columns[0], columns[1])
        key, text_id, centre, left, right, *signs = (c[kept] for c in columns)
        for side, sign in enumerate(signs):
            chain = mixed(key.view(np.uint64) ^ mixed(sign.astype(np.uint64), 0), 1 + side).view(np.int64)
            order = np.argsort(chain)
            order = order[_several(chain[order], text_id[order])]
            yield pa.RecordBatch.from_arrays([pa.array(c[order]) for c in (chain, text_id, centre, left, right)], names=names)


def chains(own: DataFrame) -> DataFrame:
    """(chain, text_id, centre, left, right): windows whose minimum and a side's signature two texts share."""
    windows = own.select("text_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        _window_batches, "key long, text_id long, centre int, left int, right int, sign_before int, sign_after int")

    return windows.repartition("key").sortWithinPartitions("key").mapInArrow(
        _chain_batches, "chain long, text_id long, centre int, left int, right int")


def _live_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by chain, with their class as `root`; those of chains of several classes are kept."""
    for columns in _whole_groups(batches):
        kept = _several(columns[0], columns[2])
        yield pa.RecordBatch.from_arrays([pa.array(c[kept]) for c in columns], names=["chain", "text_id", "root", "centre", "left", "right"][:len(columns)])


def _surroundings(hashes: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, centres): a key for each different shingle `NEAREST` to `FARTHEST` places before or after each centre."""
    centres = np.sort(centres)
    own = hashes[centres]
    if len(np.unique(own)) < len(own):
        seen, fresh = set(), np.zeros(len(centres), dtype=bool)
        for k, centre in enumerate(centres.tolist()):
            start = max(centre - _REACH, 0)
            known = (centre - start, hashes[start: centre + _REACH + 1].tobytes())
            fresh[k] = known not in seen  # the same surroundings hold the same passages
            seen.add(known)
        centres, own = centres[fresh], own[fresh]
    far = np.arange(NEAREST, FARTHEST + 1)
    at = centres[:, None] + np.concatenate([-far, far])
    inside = (at >= 0) & (at < len(hashes))
    keys = hashes[np.where(inside, at, 0)] ^ mixed(own, 0)[:, None]
    half = len(far)
    keys[:, :half], keys[:, half:] = mixed(keys[:, :half], 1), mixed(keys[:, half:], 2)
    keys = np.where(inside, keys, ~np.uint64(0))
    keys.sort(axis=1)
    inside = np.arange(2 * half) < inside.sum(axis=1)[:, None]  # the others have gone to the end
    inside[:, 1:] &= keys[:, 1:] != keys[:, :-1]
    return keys[inside].view(np.int64), np.repeat(centres, inside.sum(axis=1))


def _around_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["chain", "text_id", "root", "centre", "left", "right"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), *[pa.int32()] * 3]
    for batch in batches:
        columns: list[list[np.ndarray]] = [[] for _ in names]
        ids, roots, held, centres = (batch.column(c).to_pylist() for c in range(4))
        hashed = (h for first, stop in _portions([len(t) for t in held]) for h in shingled(held[first:stop]))
        for text_id, root, hashes, own in zip(ids, roots, hashed, centres):
            keys, at = _surroundings(hashes, np.array(own, dtype=np.int64))
            for column, part in zip(columns, (keys, np.full(len(at), text_id), np.full(len(at), root), at, at, len(hashes) - at - 1)):
                column.append(part)
        joined = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in columns]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()).cast(k) for c, k in zip(joined, kinds)], names=names)


def _by_chain(rows: DataFrame) -> DataFrame:
    return rows.repartition("chain").sortWithinPartitions("chain")


def around(all_chains: DataFrame, roots: DataFrame, own: DataFrame) -> DataFrame:
    """(chain, text_id, root, centre, left, right): places of chains of several classes, dealt by a shingle near them."""
    rooted = all_chains.select("chain", "text_id", "centre").join(
        roots, all_chains["text_id"] == roots["u"], "left").select("chain", "text_id", F.coalesce("root", "text_id").alias("root"), "centre")
    live = _by_chain(rooted).mapInArrow(_live_batches, "chain long, text_id long, root long, centre int")
    places = live.groupBy("text_id").agg(F.first("root").alias("root"), F.collect_set("centre").alias("centres"))
    known = own.select("text_id", F.col("text").cast("binary").alias("text")).join(places.select("text_id"), "text_id", "left_semi")
    names = "chain long, text_id long, root long, centre int, left int, right int"
    dealt = (known.dropDuplicates(["text_id"]).join(places, "text_id").select("text_id", "root", "text", "centres")
             .mapInArrow(_around_batches, names))
    return _by_chain(dealt).mapInArrow(_live_batches, names)


def _neighbour_batches(lags: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by chain. With a seventh column, a class, one row of every class in a chain takes part."""
    for chain, rank, text_id, centre, left, right, *root in _whole_groups(batches):
        if root:
            order = np.lexsort((centre, text_id, rank, root[0], chain))
            first = np.ones(len(order), dtype=bool)
            first[1:] = (np.diff(chain[order]) != 0) | (np.diff(root[0][order]) != 0)
            kept = order[first]
            chain, rank, text_id, centre, left, right = (c[kept] for c in (chain, rank, text_id, centre, left, right))
        order = np.lexsort((centre, text_id, rank, chain))
        chain, text_id, centre, left, right = (c[order] for c in (chain, text_id, centre, left, right))
        for lag in range(1, lags + 1):
            at = np.flatnonzero(chain[lag:] == chain[:-lag]) + lag
            overlap = np.minimum(left[at], left[at - lag]) + np.minimum(right[at], right[at - lag]) + 1
            at = at[(overlap >= int(SIMILARITY * LEAST)) & (text_id[at] != text_id[at - lag])]
            turned = text_id[at] < text_id[at - lag]
            first, second = np.where(turned, at, at - lag), np.where(turned, at - lag, at)
            places = (centre[first].astype(np.int64) << 32) + centre[second]  # both in one long: sets of them are shuffled
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (text_id[first], text_id[second], places)], names=["a", "b", "at"])


def neighbours(rows: DataFrame, turn: int, lags: int) -> DataFrame:
    """(a, b, at): texts a < b at up to `lags` places from each other in a chain, and the shared shingles' places, a's in the upper half.

    Where rows have a class, as `root`, one place of every class in a chain takes part, which `turn` chooses.
    """
    rank = F.xxhash64(F.lit(turn), F.col("text_id")) if turn else F.lit(0).cast("long")
    ranked = rows.select("chain", rank.alias("rank"), "text_id", "centre", "left", "right", *(["root"] if "root" in rows.columns else []))
    return _by_chain(ranked).mapInArrow(partial(_neighbour_batches, lags), "a long, b long, at long").groupBy("a", "b").agg(F.collect_set("at").alias("at"))


def _across_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by chain. A portion's pairs come once each, some thousands at a time."""
    for chain, text_id, root in _whole_groups(batches):
        order = np.lexsort((text_id, chain))
        fresh = np.ones(len(order), dtype=bool)
        fresh[1:] = (np.diff(chain[order]) != 0) | (np.diff(text_id[order]) != 0)
        chain, text_id, root = (c[order][fresh] for c in (chain, text_id, root))
        held: list[np.ndarray] = []
        at, lag = np.arange(len(chain)), 0
        while len(at):
            lag += 1
            at = at[at >= lag]
            at = at[chain[at] == chain[at - lag]]  # a row without another so many places before it has none further off
            met = at[root[at] != root[at - lag]]
            held.append(np.stack([text_id[met - lag], text_id[met]], axis=1))
            if sum(map(len, held)) >= _ROWS or not len(at):
                pairs = np.concatenate(held)
                pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
                once = np.ones(len(pairs), dtype=bool)
                once[1:] = (np.diff(pairs, axis=0) != 0).any(axis=1)
                a, b = pairs[once].T
                held = [pairs[once]]
                if len(held[0]) >= _ROWS or not len(at):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
                    held = []


def across(rooted: DataFrame) -> DataFrame:
    """(a, b): all texts a < b of different classes that share a chain."""
    return _by_chain(rooted.select("chain", "text_id", "root")).mapInArrow(_across_batches, "a long, b long").distinct()


def _totals(values: np.ndarray) -> np.ndarray:
    """The sums of the first values, by their number."""
    total = np.zeros(len(values) + 1)
    values.cumsum(out=total[1:])
    return total


def _longest(both: np.ndarray, back: int) -> tuple[int, int]:
    """(shingles before position `back`, size) of the longest stretch through it with enough of `both`."""
    gain = both - 2 * SIMILARITY / (1 + SIMILARITY)  # common shingles per shingle, for the similarity
    before = _totals(gain[:back][::-1])  # by number of shingles taken to the left
    after = np.cumsum(gain[back:])  # by number taken from the place on, less one
    reach = np.maximum.accumulate(after[::-1])[::-1]
    last = np.searchsorted(-reach, before + 1e-9, side="right") - 1  # farthest end for each start
    length = np.where(last >= 0, np.arange(len(before)) + last + 1, 0)
    left = int(length.argmax())
    return left, int(length[left])


def _stretches(one: np.ndarray, other: np.ndarray, both: np.ndarray, p: int, q: int) -> Iterator[tuple[int, int, int]]:
    """(start in one, start in other, shingles) around a place, longest first.

    Shingles that occur elsewhere in the other text may carry a stretch past the passage, so it shrinks to
    what its own two sides have in common, then to shingles equal in place, last to an unbroken run of those.
    """
    a, size, narrowed = p - min(p, q), len(both), False
    while True:
        left, found = _longest(both, p - a)
        shrunk, a, size = found < size, p - left, found
        if size < LEAST:
            if not narrowed:
                return  # what is equal in place is in common too, so no stretch of it is longer
            break
        b = a + q - p
        yield a, b, size
        if not shrunk:
            break
        x, y = one[a: a + size], other[b: b + size]
        both, narrowed = np.isin(x, y) & np.isin(y, x), True
    back, ahead = min(p, q), min(len(one) - p, len(other) - q)
    equal = one[p - back: p + ahead] == other[q - back: q + ahead]
    left, size = _longest(equal, back)
    yield p - left, q - left, size
    unequal = np.flatnonzero(~equal)
    at = int(np.searchsorted(unequal, back))
    begin = int(unequal[at - 1]) + 1 if at else 0
    end = int(unequal[at]) if at < len(unequal) else len(equal)
    yield p - back + begin, q - back + begin, end - begin


def _promising(both: np.ndarray) -> np.ndarray:
    """Which positions lie in a stretch of `LEAST` or more with enough of `both`; no other place can be in a passage."""
    total = _totals(both - 2 * SIMILARITY / (1 + SIMILARITY))
    reach = np.maximum.accumulate(total[::-1])[::-1]
    last = np.searchsorted(-reach, 1e-6 - total, side="right") - 1  # farthest end for each start
    starts = np.flatnonzero(last - np.arange(len(total)) >= LEAST)
    steps = np.zeros(len(total), dtype=np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, last[starts], -1)
    return np.cumsum(steps)[:-1] > 0


def _spans(both: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, size) for each position of the longest stretch through it with enough of `both`, as `_longest` finds it."""
    total = _totals(both - 2 * SIMILARITY / (1 + SIMILARITY))
    reach = np.maximum.accumulate(total[::-1])[::-1]
    last = np.searchsorted(-reach, 1e-9 - total, side="right") - 1  # farthest end for each start
    begin = np.flatnonzero(last[1:] > np.maximum.accumulate(last)[:-1]) + 1  # not inside an earlier start's stretch
    begin = np.concatenate([[0], begin]) if last[0] >= 0 else begin
    begin = begin[last[begin] > begin]
    start, size = np.zeros(len(both), np.int64), np.zeros(len(both), np.int64)
    for i in begin[np.lexsort((begin, last[begin] - begin))].tolist():  # longest last, then the latest start
        start[i: last[i]], size[i: last[i]] = i, last[i] - i
    return start, size


def _distinct(ordered: np.ndarray) -> np.ndarray:
    """Each value of an ordered array once."""
    kept = np.ones(len(ordered), dtype=bool)
    np.not_equal(ordered[1:], ordered[:-1], out=kept[1:])
    return ordered[kept]


def _similarity(x: np.ndarray, y: np.ndarray) -> float:
    if np.array_equal(x, y):
        return 1.0
    x, y = _distinct(np.sort(x)), _distinct(np.sort(y))
    either = np.sort(np.concatenate([x, y]))
    common = np.count_nonzero(either[1:] == either[:-1])
    return common / (len(x) + len(y) - common)


def _holds(one: np.ndarray, other: np.ndarray, both: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Which places of a diagonal lie in a similar stretch that `_stretches` would yield.

    `one` and `other` are the parts of the texts that the diagonal runs through. All places of a stretch are judged at once.
    """
    held = np.zeros(len(places), dtype=bool)

    def split(common: np.ndarray, shift: int, members: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        start, size = (x[places[members] - shift] for x in _spans(common))
        for begin in np.unique(start[size >= LEAST]).tolist():
            own = (start == begin) & (size >= LEAST)
            yield shift + begin, int(size[own][0]), members[own]

    open_ = [(both, 0, np.arange(len(places)))]
    while open_:
        common, shift, members = open_.pop()
        for a, size, own in split(common, shift, members):
            x, y = one[a: a + size], other[a: a + size]
            if _similarity(x, y) >= SIMILARITY:
                held[own] = True
            elif size < len(common):
                open_.append((np.isin(x, y) & np.isin(y, x), a, own))
    left = np.flatnonzero(~held)
    equal = one == other
    if len(left) and equal.sum() >= LEAST * 2 * SIMILARITY / (1 + SIMILARITY) - 1e-6:
        for a, size, own in split(equal, 0, left):
            held[own] = _similarity(one[a: a + size], other[a: a + size]) >= SIMILARITY
        # An unbroken run through a place, if it is long enough, is a passage.
        edges = np.r_[-1, np.flatnonzero(~equal), len(equal)]
        after = np.searchsorted(edges, places, side="right")
        after = np.minimum(after, len(edges) - 1)
        held |= equal[places] & (edges[after] - edges[after - 1] - 1 >= LEAST)
    return held


class _Known:
    """A text's shingles, and its places to be compared."""

    def __init__(self, hashes: np.ndarray, centres: np.ndarray | None = None):
        self.hashes, self.centres = hashes, centres

    @cached_property
    def slots(self) -> np.ndarray:
        """The lowest bits of the shingles."""
        return (self.hashes & np.uint64((1 << _MARKS) - 1)).astype(np.int16)

    @cached_property
    def sorted(self) -> np.ndarray:
        return np.sort(self.hashes)

    @cached_property
    def least(self) -> int:
        """The least number of distinct shingles in any `LEAST` in a row; 0 if there are fewer."""
        n = len(self.hashes)
        if n < LEAST:
            return 0
        order = np.argsort(self.hashes, kind="stable")
        again = np.flatnonzero(self.hashes[order][1:] == self.hashes[order][:-1])
        first = np.maximum(np.arange(n) - LEAST + 1, 0)  # the windows in which a shingle is the first of its kind
        first[order[again + 1]] = np.maximum(first[order[again + 1]], order[again] + 1)
        steps = np.bincount(first, minlength=n + 1) - np.bincount(np.arange(1, n + 1), minlength=n + 1)
        return int(np.cumsum(steps)[:n - LEAST + 1].min())

    @cached_property
    def ordered(self) -> tuple[np.ndarray, np.ndarray]:
        """The shingles of the places in order, and the places."""
        own = self.hashes[self.centres]
        order = np.argsort(own, kind="stable")
        return own[order], self.centres[order]


def _found_in(one: _Known, other: _Known) -> np.ndarray | None:
    """Which shingles of one text occur in the other; None if fewer than any similar stretch of `LEAST` has in common."""
    least = LEAST * 2 * SIMILARITY / (1 + SIMILARITY) - 1e-6
    # A table of the lowest bits turns most texts down, and leaves few shingles to be looked for.
    marks = np.zeros(1 << _MARKS, dtype=bool)
    marks[other.slots] = True
    at = np.flatnonzero(marks[one.slots])
    if len(at) < least:
        return None
    wanted, held = one.hashes[at], other.sorted
    at = at[held[np.minimum(np.searchsorted(held, wanted), len(held) - 1)] == wanted]
    if len(at) < least:
        return None
    found = np.zeros(len(one.hashes), dtype=bool)
    found[at] = True
    return found


def _in_common(one: _Known, other: _Known, many: bool) -> tuple[np.ndarray, np.ndarray] | None:
    """Which shingles occur in the other text; None if too few for any stretch of `LEAST` that is similar enough.

    What two similar stretches have in common is `SIMILARITY` of the distinct shingles of either at least; these are
    counted where there are `many` places.
    """
    here = _found_in(one, other)
    there = None if here is None else _found_in(other, one)
    if there is None:
        return None
    if many:
        shared = len(_distinct(np.sort(one.hashes[here])))
        if shared < SIMILARITY * LEAST and shared < SIMILARITY * max(one.least, other.least) - 1e-6:
            return None
    return here, there


def _shared_places(one: _Known, other: _Known) -> tuple[np.ndarray, np.ndarray]:
    """The places of two texts with one shingle that overlap enough."""
    (x, at_x), (y, at_y) = one.ordered, other.ordered
    low, high = np.searchsorted(y, x, side="left"), np.searchsorted(y, x, side="right")
    n = high - low
    p = np.repeat(at_x, n)
    q = at_y[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)]
    overlap = np.minimum(p, q) + np.minimum(len(one.hashes) - p, len(other.hashes) - q)
    enough = overlap >= int(SIMILARITY * LEAST)
    return p[enough], q[enough]


def _dealt_together(one: np.ndarray, other: np.ndarray, p: int, q: int) -> bool:
    """Whether two places share a shingle `NEAREST` to `FARTHEST` places before or after them, so a group of `around`."""
    def near(text: np.ndarray, at: int) -> tuple[np.ndarray, np.ndarray]:
        return text[max(at - FARTHEST, 0): max(at - NEAREST + 1, 0)], text[at + NEAREST: at + FARTHEST + 1]

    return any(np.isin(x, y).any() for x, y in zip(near(one, p), near(other, q)))


def _aligned(one: _Known, other: _Known, at: tuple[np.ndarray, np.ndarray] | None) -> list[tuple[int, int, int, float]]:
    common = _in_common(one, other, at is None or len(at[0]) > _FEW)
    if common is None:
        return []
    (here, there), (x, y) = common, (one.hashes, other.hashes)
    ps, qs = _shared_places(one, other) if at is None else at
    few = len(ps) <= _FEW
    if not few:
        chosen = _promising(here)[ps] & _promising(there)[qs]  # whatever the diagonal, it has no more in common
        ps, qs = ps[chosen], qs[chosen]
    order = np.argsort(ps - qs, kind="stable")
    ps, qs = ps[order], qs[order]
    places: list[tuple[int, int]] = []
    alongs: dict[int, np.ndarray] = {}
    cuts = np.flatnonzero(np.diff(ps - qs)) + 1
    for p, q in zip(np.split(ps, cuts), np.split(qs, cuts)) if len(cuts) else [(ps, qs)] if len(ps) else ():
        from_x, from_y = max(int(p[0] - q[0]), 0), max(int(q[0] - p[0]), 0)
        size = min(len(x) - from_x, len(y) - from_y)
        both = here[from_x: from_x + size] & there[from_y: from_y + size]
        if np.count_nonzero(both) < LEAST * 2 * SIMILARITY / (1 + SIMILARITY) - 1e-6:
            continue
        if not few:
            p = np.unique(p[_promising(both)[p - from_x]])
            if len(p):
                p = p[_holds(x[from_x: from_x + size], y[from_y: from_y + size], both, p - from_x)]
        alongs[from_x - from_y] = both
        places += [(a, a - from_x + from_y) for a in p.tolist()]
    found: list[tuple[int, int, int, float]] = []
    for p, q in sorted(places):
        if any(a <= p < a + n and b <= q < b + n for a, b, n, _ in found):
            continue
        if at is None and not _dealt_together(x, y, p, q):
            continue
        for a, b, size in _stretches(x, y, alongs[p - q], p, q):
            if size < LEAST:
                continue
            similarity = _similarity(x[a: a + size], y[b: b + size])
            if similarity >= SIMILARITY:
                found.append((a, b, size, similarity))
                break
    return found


def aligned(one: np.ndarray, other: np.ndarray, at: list[tuple[int, int]]) -> list[tuple[int, int, int, float]]:
    """Verified passages (start in one, start in other, shingles, similarity) around the given places.

    On a place's diagonal, the longest stretch through it is taken in which enough shingles occur in
    both texts; its own shingle sets then decide, and shorter stretches follow until one is similar.
    """
    places = np.array(at, dtype=np.int64).reshape(-1, 2).T
    return _aligned(_Known(one), _Known(other), (places[0], places[1]))


def _hopeful(pairs: list[tuple[int, int]], known: dict[int, _Known]) -> np.ndarray:
    """Which pairs of texts have in either a stretch of `LEAST` or more with enough shingles that the other may hold.

    No other pair has a passage. Pairs are judged together, by tables of the lowest bits of the texts' shingles.
    """
    ids = {text_id: k for k, text_id in enumerate(dict.fromkeys(x for pair in pairs for x in pair))}
    texts = [known[i] for i in ids]
    sizes = np.array([len(t.hashes) for t in texts], dtype=np.int64)
    slots, starts = np.concatenate([t.slots for t in texts]).astype(np.int64), np.cumsum(sizes) - sizes
    held = np.zeros(len(texts) << _MARKS, dtype=bool)
    held[slots + (np.repeat(np.arange(len(texts)), sizes) << _MARKS)] = True
    ends = np.array([(ids[a], ids[b]) for a, b in pairs], dtype=np.int64).reshape(-1, 2).T
    hopeful = np.ones(len(pairs), dtype=bool)
    for one, other in (ends, ends[::-1]):
        n = sizes[one]
        first = np.cumsum(n + 1) - n - 1  # each pair's place in one array, with a gap after it
        inside = np.arange(n.sum()) + np.repeat(np.arange(len(n)), n)
        at = np.arange(n.sum()) + np.repeat(starts[one] - np.cumsum(n) + n, n)
        gain = np.full(n.sum() + len(n), -1.0 - n.max())
        gain[inside] = held[slots[at] + np.repeat(other << _MARKS, n)] - 2 * SIMILARITY / (1 + SIMILARITY)
        total = _totals(gain)
        reach = np.maximum.accumulate(total[::-1])[::-1]
        wide = np.zeros(len(gain), dtype=bool)
        wide[: max(len(total) - LEAST, 0)] = reach[LEAST:] >= total[: max(len(total) - LEAST, 0)] - 1e-5
        hopeful &= np.logical_or.reduceat(wide, first)
    return hopeful


def _verified_rows(pairs: list[tuple], known: dict[int, _Known]) -> Iterator[tuple]:
    for first, stop in _portions([8 * (len(known[a].hashes) + len(known[b].hashes)) for a, b, _ in pairs]):
        for (a, b, at), hopeful in zip(pairs[first:stop], _hopeful([x[:2] for x in pairs[first:stop]], known)):
            if not hopeful:
                continue
            if at is not None:
                at = at.to_numpy(zero_copy_only=False)
                at = at >> 32, at & 0xFFFFFFFF
            for p, q, size, similarity in _aligned(known[a], known[b], at):
                yield a, b, p, p + size + SHINGLE - 1, q, q + size + SHINGLE - 1, similarity


def _verify_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by block, its texts before its pairs."""
    names = ["a", "b", "a_start", "a_end", "b_start", "b_end", "similarity"]
    kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.float64()]
    known: dict[int, _Known] = {}
    current = None
    for batch in batches:
        rows: list[tuple] = []
        pairs: list[tuple] = []
        blocks, ones, others = (batch.column(c).to_pylist() for c in (0, 2, 3))
        held = [t for t in batch.column(4).to_pylist() if t is not None]
        hashed = iter([h for first, stop in _portions([len(t) for t in held]) for h in shingled(held[first:stop])])
        for i, (block, a, b) in enumerate(zip(blocks, ones, others)):
            if block != current:
                rows += _verified_rows(pairs, known)
                pairs = []
                known.clear()
                current = block
            if b is None:
                centres = batch.column(5)[i].values
                known[a] = _Known(next(hashed), None if centres is None else centres.to_numpy(zero_copy_only=False).astype(np.int64))
            else:
                pairs.append((a, b, batch.column(6)[i].values))
        rows += _verified_rows(pairs, known)
        columns = list(zip(*rows)) if rows else [[] for _ in names]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)


def verified(pairs: DataFrame, own: DataFrame, dealt: DataFrame | None = None) -> DataFrame:
    """(a, b, a_start, a_end, b_start, b_end, similarity): passages of the candidate pairs, in words.

    Pairs name the places to look `at`; with the rows of `around`, they are all places that two texts share in a group.
    """
    ends = pairs.select(F.explode(F.array("a", "b")).alias("text_id")).distinct()
    held = own.select("text_id", F.col("text").cast("binary").alias("text")).join(ends, "text_id", "left_semi").dropDuplicates(["text_id"])
    if dealt is None:
        held = held.withColumn("centres", F.lit(None).cast("array<int>"))
    else:
        pairs = pairs.withColumn("at", F.lit(None).cast("array<long>"))
        held = held.join(dealt.groupBy("text_id").agg(F.collect_set("centre").alias("centres")), "text_id")
    known = materialise(held, "passages-texts")
    size = known.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(_PARTS, -(-size // _BLOCK))
    blocks = pairs.withColumn("block", F.pmod(F.xxhash64("a"), F.lit(parts)) * parts + F.pmod(F.xxhash64("b"), F.lit(parts)))
    sent = blocks.select("block", F.explode(F.array("a", "b")).alias("text_id")).distinct().join(known, "text_id").select(
        "block", F.lit(0).alias("turn"), F.col("text_id").alias("a"), F.lit(None).cast("long").alias("b"), "text", "centres",
        F.lit(None).cast("array<long>").alias("at"))
    rows = sent.unionByName(blocks.select("block", F.lit(1).alias("turn"), "a", "b", "at"), allowMissingColumns=True)
    out = materialise(rows.repartition(task_count(own.sparkSession), "block").sortWithinPartitions("block", "turn", "a").mapInArrow(
        _verify_batches, "a long, b long, a_start int, a_end int, b_start int, b_end int, similarity double"), "passages-links", _BATCH)
    discard(known)
    return out


def joined_classes(roots: DataFrame, more: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The roots (u, root) with further links in, and (u, root) of the classes' roots that these links touch.

    Only the links between classes are followed, by their roots: what the classes hold stays together.
    """
    ends = more.select("a", "b").distinct()
    for end in ("a", "b"):
        of = roots.select(F.col("u").alias(end), F.col("root").alias("root"))
        ends = ends.join(of, end, "left").withColumn(end, F.coalesce("root", end)).drop("root")
    moved = materialise(components(ends.select("a", "b"), "a", "b"), "passages-roots")
    named = moved.select(F.col("u").alias("root"), F.col("root").alias("least"))
    kept = roots.join(named, "root", "left").select("u", F.coalesce("least", "root").alias("root"))
    return materialise(kept.unionByName(moved.join(roots, "u", "left_anti")), "passages-roots"), moved


def passages(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Verified passages of two texts, and (u, root): the least text of every linked text's class."""
    all_chains = materialise(chains(own), "passages-chains")
    pairs = materialise(neighbours(all_chains, 0, 1), "passages-pairs")
    compared, found = pairs.select("a", "b"), verified(pairs, own)
    roots = materialise(components(found, "a", "b"), "passages-roots")
    dealt = materialise(around(all_chains, roots, own), "passages-around")
    discard(all_chains)
    rooted = dealt
    for turn in range(1, ROUNDS + 2):
        met = neighbours(rooted, turn, LAGS) if turn <= ROUNDS else across(rooted)
        pairs = materialise(met.join(compared, ["a", "b"], "left_anti"), "passages-pairs")
        more = verified(pairs, own, dealt if turn > ROUNDS else None)
        compared, found = compared.unionByName(pairs.select("a", "b")), found.unionByName(more)
        if not more.isEmpty():
            roots, moved = joined_classes(roots, more)
            rooted = rooted.join(moved, rooted["root"] == moved["u"], "left").select(
                "chain", "text_id", F.coalesce(moved["root"], rooted["root"]).alias("root"), "centre", "left", "right")
    discard(dealt)
    return found, roots


def links(docs: DataFrame) -> DataFrame:
    """One row per link: doc_id, other_doc_id (the lower id), kind, and the passage's words in either.

    `passage` rows link the least documents of two different texts; `copy` rows link every document of
    at least `LEAST_WORDS` words to the least document with the same text.
    """
    own = texts(docs)
    least = own.groupBy("text_id").agg(F.min("doc_id").alias("first"))
    found, _ = passages(own)
    a, b = (least.select(F.col("text_id").alias(x), F.col("first").alias(f"doc_{x}")) for x in "ab")
    turned = F.col("doc_a") > F.col("doc_b")

    def side(of_a: str, of_b: str):
        return F.when(turned, F.col(of_a)).otherwise(F.col(of_b))

    links = found.join(a, "a").join(b, "b").select(
        side("doc_a", "doc_b").alias("doc_id"), side("doc_b", "doc_a").alias("other_doc_id"), F.lit("passage").alias("kind"),
        side("a_start", "b_start").alias("start"), side("a_end", "b_end").alias("end"),
        side("b_start", "a_start").alias("other_start"), side("b_end", "a_end").alias("other_end"), "similarity")
    n_words = F.size(F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), ""))
    copies = (own.select("doc_id", "text_id", n_words.alias("n")).where(F.col("n") >= LEAST_WORDS).distinct()
              .join(least, "text_id").where("doc_id != first").select(
                  "doc_id", F.col("first").alias("other_doc_id"), F.lit("copy").alias("kind"), F.lit(0).alias("start"),
                  F.col("n").alias("end"), F.lit(0).alias("other_start"), F.col("n").alias("other_end"),
                  F.lit(1.0).alias("similarity")))
    return links.unionByName(copies)


def query(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, n_links, n_copies of every document.

    class_id: the least doc_id that shared passages or equal texts lead to, itself included; n_links: other
    texts with which a passage was verified; n_copies: other documents with the same text.
    """
    own = materialise(texts(docs).drop("text"), "passages-ids")
    found, roots = passages(texts(docs))
    held = own.distinct()
    copies = held.groupBy("text_id").agg((F.count(F.lit(1)) - 1).alias("n_copies"))
    counts = (found.select("a", "b").distinct().select(F.explode(F.array("a", "b")).alias("text_id"))
              .groupBy("text_id").agg(F.count(F.lit(1)).alias("n_links")))
    classed = (held.join(copies, "text_id").join(counts, "text_id", "left")
               .join(roots, held["text_id"] == roots["u"], "left").withColumn("root", F.coalesce("root", "text_id")))
    # Only documents that share a class take part; the others are their own.
    least = classed.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    judged = classed.where("n_links IS NOT NULL OR n_copies > 0").join(least, "root").groupBy("doc_id").agg(
        F.min("class_id").alias("class_id"), F.sum(F.coalesce("n_links", F.lit(0))).alias("n_links"), F.max("n_copies").alias("n_copies"))
    every = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    return every.join(judged, "doc_id", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_links", "n_copies")])
