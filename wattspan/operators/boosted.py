"""Boosted-tree forecast: histogram boosting of all folds at once, pooled over all points.

The history is cut into overlapping day ranges of a few folds each. A range's rows are binned once, by
quantiles of the training rows of its first fold, so that no fold sees later values. Every fold keeps a
running prediction of its training rows; a tree grows level by level from sums over
(fold, node, feature, bin), best split first: the one that lowers the squared error most, of equal ones
the lowest feature and bin.

A range whose rows fit one block is grown in one task, so that all folds take one Spark job whatever
their number. Wider ranges (many points) are dealt over blocks of bounded size: then each level is one
job that adds the blocks' sums and picks the splits, and each round one job that stores the blocks'
new predictions in the shared folder. Both ways add the same sums.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..config import Model
from ..session import discard, materialise, task_count
from .baselines import as_forecast
from .folds import DAY_IDX, first_origin, with_mature_folds

BINS = 64
RATE = 0.1
LEAST = 20
#: Rows of one range that one task holds at most, on average.
BLOCK_ROWS = 1_000_000
#: Ranges that the folds are cut into at least, where there are as many folds.
LEAST_RANGES = 64
_KEYS = [S.POINT, S.HOUR, S.DAY, S.INTERVAL, S.REGIME]
#: Quantiles are exact up to this number of training rows.
_ACCURACY = 1_000_000


@dataclass(frozen=True)
class Plan:
    """Where folds and ranges lie on the day index."""

    start: int
    step: int
    window: int
    folds: int
    per: int

    @classmethod
    def of(cls, model: Model, days: int) -> Plan:
        start, step = first_origin(model), model.recalibrate_every_days
        folds = max(0, -(-(days - start) // step))
        per = max(1, min(model.window_days // (4 * step), -(-folds // LEAST_RANGES)))
        return cls(start, step, model.window_days, folds, per)

    def origin(self, fold: int) -> int:
        return self.start + fold * self.step

    def in_range(self, number: int) -> range:
        return range(number * self.per, min((number + 1) * self.per, self.folds))

    def ranges_of(self, idx: Column) -> Column:
        """Ranges that need the day: those whose folds it trains, and the one it is tested in."""
        span, last = self.per * self.step, -(-self.folds // self.per) - 1
        low = F.greatest(F.floor((idx - self.start) / span).cast("int"), F.lit(0))
        high = F.least(F.floor((idx - self.start + self.window) / span).cast("int"), F.lit(last))
        return F.when(low <= high, F.sequence(low, high))


@dataclass
class Trees:
    """One growing tree of a fold: per level the split of each node, and the values of its leaves."""

    levels: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    values: np.ndarray = field(default_factory=lambda: np.zeros(1))

    def nodes(self, codes: np.ndarray) -> np.ndarray:
        at = np.zeros(len(codes), dtype=np.int64)
        rows = np.arange(len(codes))
        for features, bins in self.levels:
            feature = features[at]
            at = 2 * at + ((feature >= 0) & (codes[rows, feature] > bins[at]))
        return at


def sums(offsets: np.ndarray, at: np.ndarray, nodes: int, rest: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(count, sum of rest) by (node, feature, bin); offsets: feature * BINS + bin of each row."""
    flat = (offsets + at[:, None] * (width * BINS)).ravel()
    size = nodes * width * BINS
    shape = (nodes, width, BINS)
    return (np.bincount(flat, minlength=size).reshape(shape),
            np.bincount(flat, weights=np.repeat(rest, width), minlength=size).reshape(shape))


def best_splits(count: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Feature (-1: none), bin, gain and the children's mean values, per node."""
    n, s = count[:, 0].sum(axis=-1), total[:, 0].sum(axis=-1)
    nl, sl = count.cumsum(axis=-1)[..., :-1], total.cumsum(axis=-1)[..., :-1]
    nr, sr = n[:, None, None] - nl, s[:, None, None] - sl
    whole = s * s / np.maximum(n, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where((nl >= LEAST) & (nr >= LEAST), sl * sl / nl + sr * sr / nr - whole[:, None, None], -np.inf)
    # Gains are compared after rounding, so that sums added in another order pick the same split.
    flat = gain.reshape(len(n), -1)
    with np.errstate(invalid="ignore"):
        unit = 1e-9 * np.maximum(np.abs(flat.max(axis=1)), 1e-300)
        flat = np.where(np.isfinite(flat), np.rint(flat / unit[:, None]), -np.inf)
    pick = flat.argmax(axis=1)
    rows = np.arange(len(n))
    found = gain.reshape(len(n), -1)[rows, pick]
    split = found > 1e-9 * (1 + whole)
    feature, bin_ = pick // (BINS - 1), pick % (BINS - 1)
    nl, sl, nr, sr = (a.reshape(len(n), -1)[rows, pick] for a in (nl, sl, nr, sr))
    mean = s / np.maximum(n, 1)
    left = np.where(split, sl / np.maximum(nl, 1), mean)
    right = np.where(split, sr / np.maximum(nr, 1), 0.0)
    return np.where(split, feature, -1), np.where(split, bin_, 0), np.where(split, found, 0.0), np.stack([left, right], 1).ravel()


class Block:
    """Some or all rows of a range, by day, and a prediction of each for every fold of the range."""

    def __init__(self, number: int, plan: Plan, day, fold, price, features, edges: list[list[float]]):
        order = np.argsort(day, kind="stable")
        self.number, self.plan, self.order = number, plan, order
        self.day, self.fold, self.price = day[order], fold[order], price[order]
        codes = [np.searchsorted(e, features[order, i], side="left") for i, e in enumerate(edges)]
        self.codes = np.stack(codes, axis=1).astype(np.uint8)
        self.ready()

    def ready(self) -> None:
        self.width = self.codes.shape[1]
        self.offsets = self.codes.astype(np.int64) + np.arange(self.width) * BINS
        self.members = {}
        for f in self.plan.in_range(self.number):
            origin = self.plan.origin(f)
            lo, hi = np.searchsorted(self.day, [max(0, origin - self.plan.window), origin])
            self.members[f] = (slice(lo, hi), np.flatnonzero(self.fold == f))

    def start(self, base: dict[int, float]) -> None:
        self.train = {f: np.full(m[0].stop - m[0].start, base.get(f, 0.0)) for f, m in self.members.items()}
        self.test = {f: np.full(len(m[1]), base.get(f, 0.0)) for f, m in self.members.items()}

    def base_parts(self) -> dict[int, tuple[int, float]]:
        return {f: (m[0].stop - m[0].start, float(self.price[m[0]].sum())) for f, m in self.members.items()}

    def level(self, fold: int, tree: Trees) -> tuple[np.ndarray, np.ndarray]:
        rows = self.members[fold][0]
        at = tree.nodes(self.codes[rows])
        return sums(self.offsets[rows], at, 1 << len(tree.levels), self.price[rows] - self.train[fold], self.width)

    def add(self, fold: int, tree: Trees) -> None:
        rows, tested = self.members[fold]
        self.train[fold] = self.train[fold] + RATE * tree.values[tree.nodes(self.codes[rows])]
        self.test[fold] = self.test[fold] + RATE * tree.values[tree.nodes(self.codes[tested])]

    def predictions(self) -> tuple[np.ndarray, np.ndarray]:
        """(place of the row as it came, prediction) of every tested row with a trained fold."""
        live = [f for f, m in self.members.items() if len(m[1])]
        return (np.concatenate([np.empty(0, np.int64), *[self.order[self.members[f][1]] for f in live]]),
                np.concatenate([np.empty(0), *[self.test[f] for f in live]]))


def _grown(block: Block, fold: int, depth: int) -> Trees:
    """A whole tree from one block; a row's node is carried from level to level."""
    tree, rows = Trees(), block.members[fold][0]
    codes, offsets = block.codes[rows], block.offsets[rows]
    rest, at, line = block.price[rows] - block.train[fold], np.zeros(rows.stop - rows.start, np.int64), np.arange(rows.stop - rows.start)
    for level in range(depth):
        feature, bin_, _, values = best_splits(*sums(offsets, at, 1 << level, rest, block.width))
        own = feature[at]
        at = 2 * at + ((own >= 0) & (codes[line, own] > bin_[at]))
        tree.levels.append((feature, bin_))
        tree.values = values
    block.train[fold] = block.train[fold] + RATE * tree.values[at]
    tested = block.members[fold][1]
    block.test[fold] = block.test[fold] + RATE * tree.values[tree.nodes(block.codes[tested])]
    return tree


def _ranged(matrix: DataFrame, model: Model) -> tuple[Plan, DataFrame, DataFrame, list[str]]:
    """The plan, the stored rows, the same per range with their features, and the feature names."""
    names = S.feature_names(model)
    rows = materialise(with_mature_folds(matrix, model), "boosted-rows")
    days = rows.agg(F.max(DAY_IDX)).first()[0]
    plan = Plan.of(model, 0 if days is None else days + 1)
    own = F.floor((F.col(DAY_IDX) - plan.start) / (plan.per * plan.step))
    laid = rows.select(
        *_KEYS, DAY_IDX, S.FOLD, F.col(S.PRICE).cast("double").alias("y"),
        F.array(*[F.col(n).cast("double") for n in names]).alias("x"),
        F.explode(plan.ranges_of(F.col(DAY_IDX))).alias("range"),
    ) if plan.folds else rows.limit(0).select(
        *_KEYS, DAY_IDX, S.FOLD, F.lit(0.0).alias("y"), F.array(F.lit(0.0)).alias("x"), F.lit(0).alias("range"))
    # A row is tested in its own range only.
    laid = laid.withColumn(S.FOLD, F.when(own == F.col("range"), F.col(S.FOLD)))
    return plan, rows, laid, names


def _edges(plan: Plan, laid: DataFrame, width: int) -> dict[int, list[list[float]]]:
    """Per range and feature: the distinct quantiles of its first fold's training rows."""
    origin = F.lit(plan.start) + F.col("range") * plan.per * plan.step
    past = laid.where((F.col(DAY_IDX) < origin) & (F.col(DAY_IDX) >= origin - plan.window))
    shares = F.array(*[F.lit(k / BINS) for k in range(1, BINS)])
    cut = past.groupBy("range").agg(*[
        F.percentile_approx(F.get("x", F.lit(i)), shares, F.lit(_ACCURACY)).alias(f"q{i}") for i in range(width)])
    return {r["range"]: [sorted(set(r[f"q{i}"] or [])) for i in range(width)] for r in cut.collect()}


def _number(column: pd.Series) -> np.ndarray:
    return column.fillna(-1).to_numpy(np.int64)


def _block(number: int, plan: Plan, rows: pd.DataFrame, edges: dict) -> Block:
    features = np.stack(rows["x"].to_numpy()) if len(rows) else np.empty((0, 0))
    return Block(number, plan, rows[DAY_IDX].to_numpy(np.int64), _number(rows[S.FOLD]), rows["y"].to_numpy(float),
                 features, edges[number])


def boosted(matrix: DataFrame, model: Model, rounds: int = 100, depth: int = 5, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Forecasts of every fold; folds without training rows have none."""
    spark = matrix.sparkSession
    plan, rows, laid, names = _ranged(matrix, model)
    if not plan.folds:  # history is still too short for a first fold
        return spark.createDataFrame([], S.FORECASTS)
    edges = _edges(plan, laid, len(names))
    most = laid.groupBy("range").count().agg(F.max("count")).first()[0]
    kept = [f for f in laid.schema.fields if f.name not in ("x", "y", "range", DAY_IDX)]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", y double, predicted double"
    names_out = [f.name for f in kept] + ["y", "predicted"]
    if most <= block_rows:
        def fit(frame: pd.DataFrame) -> pd.DataFrame:
            number = int(frame["range"].iloc[0])
            if number not in edges:
                return frame.assign(predicted=0.0)[names_out].iloc[:0]
            block = _block(number, plan, frame, edges)
            block.start({f: s / n for f, (n, s) in block.base_parts().items() if n})
            for fold, (trained, tested) in block.members.items():
                if len(tested) and trained.stop > trained.start:
                    for _ in range(rounds):
                        _grown(block, fold, depth)
            place, values = block.predictions()
            return frame.iloc[place].assign(predicted=values)[names_out]

        parts = min(task_count(spark) * 4, -(-plan.folds // plan.per))
        done = laid.repartition(parts, "range").groupBy("range").applyInPandas(fit, schema)
        return as_forecast(done.withColumnRenamed("y", S.PRICE), S.BOOSTED, F.col("predicted"))
    done = _in_blocks(plan, laid, edges, rounds, depth, -(-most // block_rows), schema, names_out)
    return as_forecast(done.withColumnRenamed("y", S.PRICE), S.BOOSTED, F.col("predicted"))


# -- ranges wider than a block ------------------------------------------------------------------


def _stored(block: Block) -> bytes:
    """What a block holds, as one value of the blocks' table."""
    out = io.BytesIO()
    np.savez(out, order=block.order, day=block.day, fold=block.fold, price=block.price, codes=block.codes,
             **{f"train{f}": v for f, v in block.train.items()}, **{f"test{f}": v for f, v in block.test.items()})
    return out.getvalue()


def _loaded(number: int, plan: Plan, held: bytes) -> Block:
    block = Block.__new__(Block)
    block.number, block.plan = number, plan
    with np.load(io.BytesIO(held)) as parts:
        for name in ("order", "day", "fold", "price", "codes"):
            setattr(block, name, parts[name])
        block.ready()
        block.train = {f: parts[f"train{f}"] for f in block.members}
        block.test = {f: parts[f"test{f}"] for f in block.members}
    return block


def _in_blocks(plan: Plan, laid: DataFrame, edges: dict, rounds: int, depth: int, salts: int, schema: str,
               names_out: list[str]) -> DataFrame:
    """The same trees, grown level by level over blocks of every range."""
    salted = laid.where(F.col("range").isin(*edges)).withColumn("salt", F.pmod(F.xxhash64(S.INTERVAL, S.POINT), F.lit(salts)))
    blocks = salted.repartition(max(task_count(laid.sparkSession), salts * len(edges)), "range", "salt")

    def pack(table: pa.Table) -> pa.Table:
        number, keys, out = table.column("range")[0].as_py(), table.select(names_out[:-1]), io.BytesIO()
        block = _block(number, plan, table.select(["range", DAY_IDX, S.FOLD, "x", "y"]).to_pandas(), edges)
        block.start({})
        with pa.ipc.new_stream(out, keys.schema) as sink:
            sink.write_table(keys)
        return pa.table({"range": pa.array([number], pa.int32()), "held": pa.array([_stored(block)], pa.binary()),
                         "keys": pa.array([out.getvalue()], pa.binary())})

    state = materialise(blocks.groupBy("range", "salt").applyInArrow(pack, "range int, held binary, keys binary"), "boosted-blocks")

    def each(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for number, held, keys in zip(*(batch.column(i) for i in range(3))):
                yield _loaded(number.as_py(), plan, held.as_py()), keys.as_py()

    def stored(change) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block, keys in each(batches):
                change(block)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block.number], pa.int32()), pa.array([_stored(block)], pa.binary()), pa.array([keys], pa.binary())],
                    names=["range", "held", "keys"])

        fresh = materialise(state.mapInArrow(run, state.schema), "boosted-blocks")
        discard(state)
        return fresh

    def bases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _ in each(batches):
            parts = block.base_parts()
            yield pa.RecordBatch.from_arrays([
                pa.array(list(parts), pa.int32()), pa.array([p[0] for p in parts.values()], pa.int64()),
                pa.array([p[1] for p in parts.values()], pa.float64())], names=["fold", "n", "s"])

    base = {r.fold: r.s / r.n for r in state.mapInArrow(bases, "fold int, n long, s double")
            .groupBy("fold").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).where("n > 0").collect()}
    state = stored(lambda block: block.start(base))
    for _ in range(rounds):
        trees = {f: Trees() for f in base}
        for _ in range(depth):
            for fold, feature, bin_, values in _split_level(state, each, trees):
                trees[fold].levels.append((feature, bin_))
                trees[fold].values = values
        state = stored(lambda block, trees=trees: [block.add(f, trees[f]) for f in block.members if f in trees])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, keys in each(batches):
            place, values = block.predictions()
            table = pa.ipc.open_stream(keys).read_all().take(pa.array(place))
            yield from table.append_column("predicted", pa.array(values)).to_batches()

    return state.mapInArrow(emit, schema)


def _split_level(state: DataFrame, each, trees: dict[int, Trees]):
    """One level of every fold's tree: sums of all blocks, added by fold, and the splits they give."""
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _ in each(batches):
            for fold in block.members:
                if fold in trees:
                    count, total = block.level(fold, trees[fold])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([fold], pa.int32()), pa.array([block.width], pa.int32()),
                         pa.array([count.astype(np.int64).tobytes()], pa.binary()), pa.array([total.tobytes()], pa.binary())],
                        names=["fold", "width", "n", "s"])

    def pick(table: pa.Table) -> pa.Table:
        shape = (-1, table.column("width")[0].as_py(), BINS)
        count = sum(np.frombuffer(v.as_py(), np.int64) for v in table.column("n"))
        total = sum(np.frombuffer(v.as_py(), np.float64) for v in table.column("s"))
        feature, bin_, _, values = best_splits(count.reshape(shape), total.reshape(shape))
        return pa.table({"fold": table.column("fold")[:1], "feature": pa.array([feature.tolist()], pa.list_(pa.int32())),
                         "bin": pa.array([bin_.tolist()], pa.list_(pa.int32())), "values": pa.array([values.tolist()], pa.list_(pa.float64()))})

    found = state.mapInArrow(parts, "fold int, width int, n binary, s binary").groupBy("fold").applyInArrow(
        pick, "fold int, feature array<int>, bin array<int>, values array<double>")
    for r in found.collect():  # a few numbers per fold and node
        yield r["fold"], np.array(r["feature"]), np.array(r["bin"]), np.array(r["values"])


def first_splits(matrix: DataFrame, model: Model) -> DataFrame:
    """fold, n_train, base, feature, threshold, n_left, gain: the root of each fold's first tree."""
    plan, _, laid, names = _ranged(matrix, model)
    schema = "fold int, n_train long, base double, feature string, threshold double, n_left long, gain double"
    if not plan.folds:
        return matrix.sparkSession.createDataFrame([], schema)
    edges = _edges(plan, laid, len(names))

    def roots(frame: pd.DataFrame) -> pd.DataFrame:
        number, out = int(frame["range"].iloc[0]), []
        block = _block(number, plan, frame, edges) if number in edges else None
        for fold, (trained, _) in block.members.items() if block else ():
            n = trained.stop - trained.start
            if n:
                base = float(block.price[trained].mean())
                count, total = sums(block.offsets[trained], np.zeros(n, np.int64), 1, block.price[trained] - base, block.width)
                feature, bin_, gain, _ = (a[0] for a in best_splits(count, total))
                if feature >= 0:
                    left = int(count[0, feature, :bin_ + 1].sum())
                    out.append((fold, n, base, names[feature], edges[number][feature][bin_], left, gain))
        return pd.DataFrame(out, columns=["fold", "n_train", "base", "feature", "threshold", "n_left", "gain"])

    return laid.repartition(-(-plan.folds // plan.per), "range").groupBy("range").applyInPandas(roots, schema)
