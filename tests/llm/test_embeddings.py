"""Nearest neighbours, hard negatives and whitening against brute force."""

import math

import numpy as np
import pytest

from compare import connect, difference
from wattspan.llm import ann, negatives, queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, vector string, rank int, cell string, row int"
NAN, INF = float("nan"), float("inf")


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 7, "y", 1) for r in rows], SCHEMA)


def odd_rows(rng, count=260, dim=8):
    """Vectors of many lengths in tight clusters, with every kind of row that takes no part."""
    centre = rng.standard_normal((3, dim))
    rows = [(i, [float(np.float32(x)) for x in (centre[i % 3] + 0.2 * rng.standard_normal(dim)) * (1 + i % 4)], i % 5)
            for i in range(count)]
    rows += [(300 + i, rows[40][1], rows[40][2]) for i in range(6)]  # equal vectors: ties by id
    rows += [(400, None, 1), (420, [], 1), (440, [None] + [1.0] * (dim - 1), 1), (460, [NAN] * dim, 1),
             (480, [INF] + [0.0] * (dim - 1), 1), (500, [1.0] * (dim + 1), 1), (None, [1.0] * dim, 1)]
    rows += [rows[7], (20, rows[9][1], 4)]  # an exact repeat, and an id with two vectors
    return rows


def sound(rows, dim):
    """The least row of each id that takes part."""
    kept = {}
    for key, vector, label in rows:
        if key is None or not vector or len(vector) != dim or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept[key] = min(kept.get(key, (vector, label)), (vector, label))
    return kept


def test_index_returns_every_code_within_the_radius(monkeypatch):
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 2 ** 64, (600, 4), dtype=np.uint64)
    codes[100:200] = codes[0] ^ (np.uint64(1) << rng.integers(0, 64, (100, 4), dtype=np.uint64))
    for lookup in (0, ann.LOOKUP):  # by the index alone, and as built
        monkeypatch.setattr(ann, "LOOKUP", lookup)
        index = ann.MultiIndex(codes)
        for radius in (0, 4, 15, 16, 40, 118, 256):
            each = radius // 16
            balls = {r: ann.ball(r) for r in (each, each - 1) if 0 <= r}
            for row in (0, 150, 300):
                want = np.flatnonzero(ann.distances(codes[row], codes) <= radius)
                assert (index.within(codes[row], radius, balls) == want).all()


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_nearest_reach_their_recall(spark, size):
    table = spark.read.parquet(f"/root/testdata/{size}/embeddings.parquet")
    data = {r.vec_id: np.array(r.embedding, dtype=float) for r in table.collect()}
    ids, vectors = np.array(list(data)), np.array(list(data.values()))
    found = {}
    for r in ann.query(table).collect():
        found.setdefault(r.query_id, []).append(r)
        assert r.score == pytest.approx(float(data[r.query_id] @ data[r.vec_id]), abs=1e-14)
    assert set(found) == {i for i in data if i % 20 == 0}
    hits = 0
    for name, rows in found.items():
        rows.sort(key=lambda r: r.rank)
        assert [r.rank for r in rows] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
        scores = np.where(ids == name, -9, vectors @ data[name])
        hits += len({r.vec_id for r in rows} & set(ids[np.lexsort((ids, -scores))[:20]].tolist()))
    assert hits >= 0.95 * 20 * len(found)


def test_nearest_on_odd_rows(spark):
    """With every code in reach the result is exact; few, tied, long and unusable vectors included."""
    rows = odd_rows(np.random.default_rng(4))
    rows.append((600, [0.0] * 8, 2))
    kept = {k: v for k, (v, _) in sound(rows, 8).items() if any(v)}
    got = {}
    for r in ann.nearest(frame(spark, rows), "vec_id", "embedding", target=1.0).collect():
        got.setdefault(r.query_id, {})[r.rank] = r.vec_id
    assert set(got) == {k for k in kept if k % 20 == 0}
    hits = 0
    for name, ranks in got.items():
        order = sorted((-float(np.dot(kept[name], v)), k) for k, v in kept.items() if k != name)
        assert len(ranks) == 20
        hits += len(set(ranks.values()) & {k for _, k in order[:20]})
    assert hits == 20 * len(got)
    few = frame(spark, [(0, [1.0, 0.0], 1), (1, [0.5, 0.5], 1), (2, [-1.0, 0.0], 1)])
    assert [(r.rank, r.vec_id) for r in ann.query(few).orderBy("rank").collect()] == [(1, 1), (2, 2)]
    assert ann.query(few.limit(0)).count() == 0 and ann.query(few.where("vec_id = 1")).count() == 0


def test_second_search_completes_short_queries(spark, monkeypatch):
    """A radius that holds almost nothing still gives every query its neighbours."""
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    whole = {(r.query_id, r.rank, r.vec_id) for r in ann.nearest(table, "vec_id", "embedding", target=1.0).collect()}
    some = {(r.query_id, r.rank, r.vec_id) for r in ann.nearest(table, "vec_id", "embedding", target=0.0).collect()}
    assert len(whole) == len(some) and len(whole & some) >= 0.95 * len(whole)


def mined(kept):
    """Brute force of the contract."""
    whole = {k: (np.floor(256 * np.array(v)).astype(int), (c + 1) % 10 if k % 7 == 0 else c) for k, (v, c) in kept.items()}
    out = set()
    for a in (k for k in whole if k % 100 == 0):
        scores = sorted((-int(whole[a][0] @ v), k) for k, (v, _) in whole.items() if k != a)
        same = [(s, k) for s, k in scores if whole[k][1] == whole[a][1]][:5]
        for p, positive in same:
            inside = [(-s, k) for s, k in scores if whole[k][1] != whole[a][1] and 30 * -p <= 100 * -s <= 90 * -p]
            out |= {(a, positive, i + 1, k, -p, s) for i, (s, k) in enumerate(inside[:10])}
    return out


@pytest.mark.parametrize("seed,centres,batch", [(2, 16, 2048), (3, 4, 8), (5, 40, 1)])
def test_negatives_equal_brute_force(spark, monkeypatch, seed, centres, batch):
    for name, value in (("CENTRES", centres), ("BATCH", batch)):
        monkeypatch.setattr(negatives, name, value)
    rows = [r for r in odd_rows(np.random.default_rng(seed)) if r[2] is not None] + [(700, [1.0] * 8, None)]
    columns = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    got = {tuple(r[c] for c in columns) for r in negatives.query(frame(spark, rows)).collect()}
    least = {}
    for key, vector, label in rows:
        if label is not None and key in sound([(key, vector, label)], 8):
            moved = (label + 1) % 10 if key % 7 == 0 else label
            whole = [math.floor(256 * x) for x in vector]
            least[key] = min(least.get(key, (moved, whole, vector, label)), (moved, whole, vector, label))
    assert got == mined({k: (v[2], v[3]) for k, v in least.items()}) and len(got) > 50


def test_negatives_stop_early_on_clusters():
    """Bounds hold for every unseen row, and clustered rows are certified before all cells are read."""
    rng = np.random.default_rng(8)
    centre = rng.integers(-300, 300, (40, 16))
    vectors = centre[rng.integers(0, 40, 4000)] + rng.integers(-6, 7, (4000, 16))
    books = negatives.codebook(vectors[:, :8].astype(float)), negatives.codebook(vectors[:, 8:].astype(float))
    index, read = negatives.MultiIndex(vectors, books), []
    for anchor in centre[:5]:
        scores, seen = vectors @ anchor, np.zeros(4000, dtype=bool)
        for rows, bound in index.visits(anchor):
            assert not seen[rows].any()
            seen[rows] = True
            assert not (scores[~seen] > bound).any()
        assert seen.all()
        labels, ids, before = np.zeros(4000, dtype=int), np.arange(4000), []
        plain = index.scores
        index.scores = lambda r, a: before.append(len(r)) or plain(r, a)
        rows, values = negatives.local_positives(index, ids, labels, -1, 0, anchor, 5)
        index.scores = plain
        assert values.tolist() == sorted(scores.tolist(), reverse=True)[:5]
        read.append(sum(before))
    assert min(read) < 4000


def test_negatives_twin_and_edges(spark):
    con = connect("/root/testdata/sf0.01")
    found = queries.registered()["op12_hard_negatives"](spark, "/root/testdata/sf0.01")
    assert difference(found, con, queries.twins()["op12_hard_negatives"]) is None
    table = frame(spark, [(0, [1.0, 0.0], 1), (100, [1.0], 2)])
    assert negatives.query(table).count() == 0 and negatives.query(table.limit(0)).count() == 0


def check_whitened(found, vectors):
    """All figures against float64 numpy; returns the components."""
    x = np.floor(64 * vectors).astype(np.int64) + 1_000_000
    n, total = len(x), x.sum(axis=0)
    off = (x - 1_000_000) - (total - n * 1_000_000) / n
    values, axes = np.linalg.eigh(off.T @ off / n)
    values = values[::-1]
    got = found.sort_values(["vec_id", "component"])
    kept = got.component.max()
    z = got.whitened.to_numpy().reshape(n, kept)
    assert np.abs(z.T @ z / n - np.eye(kept)).max() < 1e-10 and got.identity_error.iloc[0] < 1e-10
    assert np.allclose(got.explained.to_numpy().reshape(n, kept)[0], values[:kept] / values.sum(), rtol=1e-10)
    assert (got.deviation.to_numpy().reshape(n, kept)[:, 0] == ((n * x - total) ** 2).sum(axis=1)).all()
    assert set(got.n) == {n}
    # The components span what the eigenvectors span: projecting back gives the covariance's leading part.
    back = z.T @ off / n / np.sqrt(values[:kept])[:, None]
    assert np.abs(back @ back.T - np.eye(kept)).max() < 1e-9
    assert np.abs((off.T @ off / n) @ back.T - back.T * values[:kept]).max() < 1e-9 * values[0]


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_whitening_figures(spark, size):
    table = spark.read.parquet(f"/root/testdata/{size}/embeddings.parquet")
    rows = sorted((r.vec_id, r.embedding) for r in table.collect())
    found = whitening.query(table).toPandas()
    assert len(found) == 32 * len(rows)
    check_whitened(found, np.array([v for _, v in rows], dtype=float))


def test_whitening_on_odd_rows(spark):
    rows = [r for r in odd_rows(np.random.default_rng(6)) if r[0] is not None]
    rows += [(800, [3e38] * 8, 1)]
    found = whitening.query(frame(spark, rows)).toPandas()
    part = [(k, v) for k, v, _ in rows if v and len(v) == 8 and all(x is not None and math.isfinite(x) and abs(x) < 1e30 for x in v)]
    assert len(found) == 8 * len(part)  # repeated ids are rows of their own
    unique = {k for k, _ in part if sum(k == j for j, _ in part) == 1}
    x = np.floor(64 * np.array([v for _, v in part])).astype(np.int64) + 1_000_000
    want = dict(zip([k for k, _ in part], ((len(x) * x - x.sum(axis=0)) ** 2).sum(axis=1).tolist()))
    assert {r.vec_id: r.deviation for r in found.itertuples() if r.vec_id in unique} == {k: want[k] for k in unique}
    flat = frame(spark, [(i, [0.5, 0.25 * (i % 2)], 1) for i in range(6)])
    assert {r.component for r in whitening.query(flat).collect()} == {1}  # the constant dimension has no scale
    for none in (flat.limit(0), flat.where("vec_id = 1"), flat.where("vec_id % 2 = 0")):
        assert whitening.query(none).count() == 0


@pytest.mark.parametrize("gap", [1e-3, 1e-7, 1e-11])
def test_refinement_parts_clusters(gap):
    """Clustered and equal eigenvalues: orthonormal vectors with residuals beyond double precision."""
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.standard_normal((24, 24)))[0].astype(np.longdouble)
    for _ in range(3):
        q = q + q @ (np.eye(24, dtype=np.longdouble) - q.T @ q) / 2
    values = np.r_[5.0 + gap * np.arange(6), 2.0, 2.0, 2.0, np.linspace(0.1, 1, 14), 9.0].astype(np.longdouble)
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    found, x = whitening.refined(a)
    assert np.abs(x.T @ x - np.eye(24)).max() < 1e-17 and (np.diff(found) <= 1e-17).all()
    assert np.abs(found - np.sort(values)[::-1]).max() < 1e-16
    assert np.abs(a @ x - x * found).max() < 1e-15
    own = np.abs(q[:, np.argsort(-values)[:7]].T @ x[:, :7])  # each parted vector is its own
    assert np.abs(own - np.eye(7)).max() < max(1e-15, 1e-17 / gap)


def test_refinement_beats_single_precision():
    rng = np.random.default_rng(9)
    a = np.cov(rng.standard_normal((24, 4000)), bias=True)
    single = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1].astype(float)
    values, x = whitening.refined(a.astype(np.longdouble))
    before = np.abs(a @ single - single * values.astype(float)).max()
    after = float(np.abs(a.astype(np.longdouble) @ x - x * values).max())
    assert after < 1e-16 < 1e-8 < before


def test_covariance_is_exact_under_the_shift(spark):
    """Sums beyond double precision: a shift of 1,000,000 and wide ranges change no digit."""
    rng = np.random.default_rng(10)
    vectors = np.round(rng.standard_normal((400, 3)) * [1e3, 1.0, 1e9], 3)
    table = spark.createDataFrame([(v.tolist(),) for v in vectors], "vector array<double>").repartition(5)
    n, total = whitening.sums(table, 3)
    found = whitening.covariance(table, 3, n, total)
    x = whitening.integers(vectors).astype(object)
    assert total == list(x.sum(axis=0))
    assert (found == n * (x.T @ x) - np.outer(x.sum(axis=0), x.sum(axis=0))).all()
