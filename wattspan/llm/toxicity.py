"""Toxicity: a weighted finite-state grammar over clauses.

Lexical arcs map words to tags (insult, threat, target, negation, reported speech) with a weight. Five
transducers, kept as tables of states and arcs, read the tags: negation and reported speech open scopes,
targets mark the words near them (one copy reads from the left, one from the right), insult and threat
arcs leave the clause on a path. `compose` joins those that read from the left into one machine, which is
built once and run over each clause. Each insult leaves on one path (plain, aimed at a target, negated,
reported) with the insult's weight; a threat counts only when a target follows it. A document's score is
the logistic value of its summed path weights and of its strongest clause.

Insult arcs (whole words and word stems) and path weights are learned from at most `LABELLED_ROWS`
labelled documents, taken by hash order of doc_id, of which exact copies count once; that bound is the
only one. Every document is scored whole, in Arrow batches without a shuffle.

Defined results: NULL and empty texts have no clauses and score by the constant alone; labels with
NULL fields, and unlabelled documents, are not learned from; without positive labels the fixed
vocabulary and the prior path weights hold; rows with NULL doc_id are held in (crc32 of NULL is not
remainder 2); repeated rows are scored row by row. Other columns pass through `keep_clean`. An empty
table gives an empty table.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import whole_text

#: Seed vocabularies in the four languages of the corpus.
INSULTS = ("idiot stupid moron dumb imbecile loser scum trash worthless pathetic disgusting "
           "dummkopf trottel abschaum connard imbécile ordure idiota estúpido basura").split()
THREATS = "kill hurt destroy beat shoot stab burn töten schlagen tuer frapper matar golpear".split()
TARGETS = ("you your you're yours u they them he she him her du dich dir ihr euch sie tu te toi vous "
           "tú ti usted ustedes él ella ellos").split()
NEGATIONS = "not no never isn't aren't don't nicht kein keine nie pas jamais ne nunca jamás".split()
REPORTS = ("said says say called calls wrote claimed quoted according sagte sagt nannte schrieb dit "
           "disait appelle écrit dijo dice llamó escribió").split()

LABELLED_ROWS = 20_000
STEM_LENGTHS = (4, 5, 6)
MIN_EVIDENCE = 20.0
MIN_LOG_ODDS = 2.0
THRESHOLD = 0.3
NEGATION_SCOPE = 3
TARGET_SCOPE = 4

_INSULT, _THREAT, _TARGET, _NEGATION, _REPORT, _END = 1, 2, 4, 8, 16, 32
_LEXICAL = _INSULT | _THREAT | _TARGET | _NEGATION | _REPORT
#: Tags that the transducers add: they stand beside the lexical ones, in place of the clause's end and above.
_AHEAD, _NEGATED, _REPORTED, _BEHIND = 32, 64, 128, 256
_PATHS = ("plain", "aimed", "negated", "reported", "threat", "strongest")
#: Where learning starts from and is drawn to: the constant, then one weight per path.
_PRIOR = np.array([-3.0, 2.0, 2.5, 1.0, 1.0, 2.0, 2.0])
#: How hard each learned row lets the path weights be drawn back, so that paths keep their order.
_HOLD = 0.002
_PUNCTUATION = ".,;:!?…\"'()[]«»“”„%&$*#|"
_CACHED_WORDS = 300_000


@dataclass(frozen=True)
class Grammar:
    """Arcs of the insult transducer (word or stem to weight in 0..1) and the path weights."""

    words: dict[str, float]
    stems: dict[str, float]
    paths: tuple[float, ...]


class Tagger(dict):
    """Word to tag bits, with the insult weight in thousandths above them; filled as words come."""

    def __init__(self, grammar: Grammar):
        super().__init__()
        self.grammar = grammar
        self.fixed = {}
        for bit, vocabulary in ((_THREAT, THREATS), (_TARGET, TARGETS), (_NEGATION, NEGATIONS), (_REPORT, REPORTS)):
            for w in vocabulary:
                self.fixed[w] = self.fixed.get(w, 0) | bit

    def insult(self, word: str) -> float:
        found = self.grammar.words.get(word, 0.0)
        for length in STEM_LENGTHS:
            if len(word) >= length:
                found = max(found, self.grammar.stems.get(word[:length], 0.0))
        return found

    def __missing__(self, word: str) -> int:
        bare = word.strip(_PUNCTUATION)
        tag = self.fixed.get(bare, 0)
        if word[-1] in ".,;:!?":
            tag |= _END
        if weight := self.insult(bare):
            tag |= _INSULT | int(1000 * weight) << 8
        if len(self) >= _CACHED_WORDS:
            self.clear()
        self[word] = tag
        return tag


@dataclass(frozen=True)
class Transducer:
    """A complete deterministic transducer from tag sets to tag sets; state 0 is the start.

    `arcs[state, tags]` is (next state, tags put out, paths on which the word leaves the clause).
    """

    tags: tuple[int, ...]
    arcs: dict[tuple[int, int], tuple[int, int, tuple[int, ...]]]


def scope(tags: tuple[int, ...], opener: int, adds: int, words: int, itself: bool = True) -> Transducer:
    """Adds a tag to the `words` words behind each opener, and to the opener; a scope of 0 lasts to the end."""
    arcs, last = {}, words or 1
    for state in range(last + 1):
        for t in tags:
            after = last if t & opener else state if not words else max(state - 1, 0)
            inside = state > 0 or bool(itself and t & opener)
            arcs[state, t] = (after, t | adds if inside else t, ())
    return Transducer(tags, arcs)


def leaving(tags: tuple[int, ...]) -> Transducer:
    """Insult and threat arcs: the paths of a word whose tags hold its scopes."""
    arcs = {}
    for t in tags:
        paths = ()
        if t & _INSULT:
            paths += (3 if t & _REPORTED else 2 if t & _NEGATED else 1 if t & (_TARGET | _BEHIND | _AHEAD) else 0,)
        if t & _THREAT and t & _AHEAD and not t & _NEGATED:
            paths += (3 if t & _REPORTED else 4,)
        arcs[0, t] = (0, t, paths)
    return Transducer(tags, arcs)


def compose(one: Transducer, other: Transducer) -> Transducer:
    """The machine whose output is `other`'s on `one`'s output, over the pairs of states that can be reached."""
    number, arcs, todo = {(0, 0): 0}, {}, [(0, 0)]
    while todo:
        pair = todo.pop()
        for t in one.tags:
            left, middle, first = one.arcs[pair[0], t]
            right, out, second = other.arcs[pair[1], middle]
            if (left, right) not in number:
                number[left, right] = len(number)
                todo.append((left, right))
            arcs[number[pair], t] = (number[left, right], out, first + second)
    return Transducer(one.tags, arcs)


def _grammar() -> tuple[Transducer, Transducer]:
    """(from the right: targets ahead; from the left: negation, reported speech, targets behind, then the paths)."""
    plain = tuple(range(_LEXICAL + 1))
    every = tuple(range(2 * _BEHIND))
    ahead = scope(plain, _TARGET, _AHEAD, TARGET_SCOPE, itself=False)
    negation = scope(every, _NEGATION, _NEGATED, NEGATION_SCOPE)
    reported = scope(every, _REPORT, _REPORTED, 0)
    behind = scope(every, _TARGET, _BEHIND, TARGET_SCOPE, itself=False)
    return ahead, compose(compose(compose(negation, reported), behind), leaving(every))


AHEAD, CLAUSE = _grammar()


def clause_paths(tags: list[int]) -> list[float]:
    """Path weights (plain, aimed, negated, reported, threat) of one clause's tags."""
    found, seen, state = [0.0] * 5, [], 0
    for tag in reversed(tags):
        state, out, _ = AHEAD.arcs[state, tag & _LEXICAL]
        seen.append(out)
    state = 0
    for tag, read in zip(tags, reversed(seen)):
        state, _, paths = CLAUSE.arcs[state, read]
        for k, path in enumerate(paths):
            found[path] += (tag >> 8) / 1000 if k == 0 and tag & _INSULT else 1.0
    return found


def match(text: str, tagger: Tagger) -> tuple[list[float], int, str]:
    """Document features by `_PATHS`, the number of matched clauses, and the strongest clause."""
    words = text.lower().replace("\n", " .\n").split()
    tags = [tagger[w] for w in words]
    hits = [i for i, t in enumerate(tags) if t & (_INSULT | _THREAT)]
    sums, strongest, count, best, done = [0.0] * 5, 0.0, 0, "", -1
    for hit in hits:
        if hit <= done:
            continue
        first = hit
        while first > done + 1 and not tags[first - 1] & _END:
            first -= 1
        last = hit
        while last + 1 < len(tags) and not tags[last] & _END:
            last += 1
        done = last
        found = clause_paths(tags[first: last + 1])
        score = sum(f * p for f, p in zip(found, _PRIOR[1:6]))
        if any(found):
            count += 1
            sums = [a + b for a, b in zip(sums, found)]
            if score > strongest or not best:
                strongest, best = max(score, strongest), " ".join(words[first: last + 1])
    return [*[math.log1p(s) for s in sums], min(strongest, 4.0) / 4.0], count, best


def value(features: list[float], paths: tuple[float, ...]) -> float:
    return 1.0 / (1.0 + math.exp(-(paths[0] + sum(f * p for f, p in zip(features, paths[1:])))))


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> DataFrame:
    """(text, toxic) of the rows to learn from, each text once, in the shared folder."""
    chosen = (labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    texts = (docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(chosen), "doc_id")
             .groupBy("text").agg(F.max("toxic").alias("toxic")))
    return materialise(texts, "toxicity-labelled")


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch: words and stems (marked by a final *) with the documents of each label that hold them."""
    for batch in batches:
        counts = (Counter(), Counter())
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            bare = {w.strip(_PUNCTUATION) for w in text.lower().split()}
            bare |= {f"{w[:n]}*" for w in list(bare) for n in STEM_LENGTHS if len(w) >= n}
            counts[toxic].update(bare - {""})
        names = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), *[pa.array([c[n] for n in names], pa.int64()) for c in counts]],
            names=["feature", "clean", "toxic"],
        )


def mine(train: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """Insult words and stems with weights: strong log odds that a likelihood-ratio test supports."""
    sizes = {r["toxic"]: r["count"] for r in train.groupBy("toxic").count().collect()}
    clean_all, toxic_all = sizes.get(0, 0), sizes.get(1, 0)
    words = {w: 0.6 for w in INSULTS}
    if not clean_all or not toxic_all:
        return words, {}
    share = toxic_all / (clean_all + toxic_all)
    counted = (train.select("text", "toxic").mapInArrow(_candidates, "feature string, clean long, toxic long")
               .groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))
    n = F.col("clean") + F.col("toxic")
    odds = (F.log((F.col("toxic") + 0.5) / (toxic_all + 1.0)) - F.log((F.col("clean") + 0.5) / (clean_all + 1.0)))
    part = F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / (n * (1 - share)))).otherwise(0.0)
    evidence = 2 * (F.col("toxic") * F.log(F.col("toxic") / (n * share)) + part)
    rows = (counted.where("toxic > 1").withColumn("odds", odds).withColumn("evidence", evidence)
            .where((F.col("odds") >= MIN_LOG_ODDS) & (F.col("evidence") >= MIN_EVIDENCE)).collect())
    stems = {r["feature"][:-1]: min(r["odds"], 6.0) / 6.0 for r in rows if r["feature"].endswith("*")}
    words |= {r["feature"]: min(r["odds"], 6.0) / 6.0 for r in rows if not r["feature"].endswith("*")}
    return words, stems


def fit(features: np.ndarray, toxic: np.ndarray) -> tuple[float, ...]:
    """Logistic regression drawn to the prior weights, by Newton steps; path weights stay positive."""
    x, weights = np.column_stack([np.ones(len(features)), features]), _PRIOR.copy()
    pull = np.r_[0.01, np.full(len(_PATHS), 0.5 + _HOLD * len(features))]
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - toxic) + pull * (weights - _PRIOR)
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(pull)
        step = np.linalg.solve(curve, slope)
        weights = weights - step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        weights[1:] = np.maximum(weights[1:], 0.05)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(w) for w in weights)


def learn(docs: DataFrame, labels: DataFrame) -> Grammar:
    train = labelled(docs, labels)
    words, stems = mine(train)
    start = Grammar(words, stems, tuple(_PRIOR))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(start)
        for batch in batches:
            found = [match(t, tagger)[0] for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.list_(pa.float64())), batch.column(1)], names=["features", "toxic"])

    rows = train.select("text", "toxic").mapInArrow(featured, "features array<double>, toxic int").collect()
    if not rows or len({r["toxic"] for r in rows}) < 2:
        return start
    rows.sort(key=lambda r: (r["features"], r["toxic"]))
    paths = fit(np.array([r["features"] for r in rows]), np.array([r["toxic"] for r in rows], dtype=float))
    return Grammar(words, stems, paths)


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, and the matched clauses' number and strongest one."""
    grammar = learn(docs, labels)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(grammar)
        for batch in batches:
            found = [match(t.as_py(), tagger) for t in batch.column(2)]
            scores = [value(f, grammar.paths) for f, _, _ in found]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(scores, pa.float64()),
                pa.array([int(s >= THRESHOLD) for s in scores], pa.int32()),
                pa.array([n for _, n, _ in found], pa.int32()), pa.array([c for _, _, c in found], pa.string()),
            ], names=["doc_id", "held_out", "score", "predicted", "n_clauses", "top_clause"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), whole_text().alias("text")).mapInArrow(
        scored, f"doc_id {kind}, held_out boolean, score double, predicted int, n_clauses int, top_clause string")


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows whose score stays below the threshold, with all their columns."""
    grammar = learn(docs, labels)
    at = docs.columns.index("text")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(grammar)
        for batch in batches:
            clean = [value(match(t.as_py() or "", tagger)[0], grammar.paths) < THRESHOLD
                     for t in batch.column(at)]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)
