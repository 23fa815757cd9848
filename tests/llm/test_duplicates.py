"""Near duplicates of documents, lines and passages against brute force."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from wattspan.llm import lines, passages, simhash
from wattspan.llm.graph import components


def roots(ids, linked):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components_of_long_paths_and_stars(spark):
    random.seed(5)
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7), (2000, 1999), (1999, 2000)]
    random.shuffle(edges)
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r.u: r.root for r in components(frame, "a", "b").collect()}
    want = roots({x for e in edges for x in e}, edges)
    assert got == want
    assert components(frame.limit(0), "a", "b").count() == 0


def slow_fingerprint(text):
    words = bytes(text, "utf-8").lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_components(sample):
    got = {r.doc_id: r for r in simhash.query(sample).collect()}
    prints = {r.doc_id: slow_fingerprint(r.text) for r in sample.collect()}
    near = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    want = roots(prints, near)
    assert all(got[i].fingerprint == f"{prints[i]:016x}" and got[i].component_id == want[i] for i in prints)


@pytest.mark.parametrize("blocks", [5, 6, 7])
def test_forest_finds_every_link(blocks):
    rng = np.random.default_rng(blocks)
    core = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = [np.bitwise_xor.reduce(np.uint64(1) << rng.integers(0, 64, k).astype(np.uint64)) if k else np.uint64(0)
             for k in rng.integers(0, 7, 600)]
    prints = np.unique(np.array([core[i % 40] ^ f for i, f in enumerate(flips)], dtype=np.uint64))
    linked = set()
    for mask in simhash.shard_masks(blocks):
        keys = (prints & np.uint64(mask)).view(np.int64)
        for a, b in simhash.Forest(keys, prints).links():
            linked |= {(min(x, y), max(x, y)) for x, y in zip(a.tolist(), b.tolist())}
    want = {(i, j) for i in range(len(prints)) for j in range(i + 1, len(prints))
            if int(prints[i] ^ prints[j]).bit_count() <= simhash.RADIUS}
    assert linked == want


def test_simhash_edges(spark, awkward):
    rows = simhash.query(awkward).collect()
    assert len(rows) == awkward.count()
    assert {r.component_id for r in rows if r.fingerprint == "0" * 16} == {1}
    kept = simhash.keep_one(awkward)
    assert kept.columns == awkward.columns and {r.doc_id for r in kept.collect()} >= {1, None, 5, 6}
    assert {r.doc_id for r in kept.collect()}.isdisjoint({2, 3})
    assert simhash.query(awkward.limit(0)).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def changed(text, times):
    chars = list(text)
    for _ in range(times):
        at = random.randrange(len(chars))
        kind = random.randrange(3)
        if kind == 0:
            chars[at] = random.choice("abcé😀")
        elif kind == 1:
            chars.insert(at, random.choice("abc"))
        else:
            del chars[at]
    return "".join(chars)


def line_fixture():
    random.seed(1)
    sizes = [8, 10, 11, 12, 18, 19, 20, 21, 22, 23, 30, 60]
    base = ["".join(random.choice("abcdefg hij") for _ in range(random.choice(sizes))) for _ in range(40)]
    docs = [(i, "\n".join(changed(random.choice(base), random.randint(0, 3)) for _ in range(random.randint(1, 6))))
            for i in range(120)]
    first = docs[0][1]
    return docs + [(None, first), (500, None), (501, ""), (502, "\n\n"), (3, docs[3][1]), (600, first), (601, (first + "\n") * 3)]


def slow_dedup(docs):
    def eligible(x):
        return len(x) >= lines.MIN_LENGTH and x.strip(" \t\n\v\f\r") != ""

    first = {}
    for key, text in docs:
        for x in (text or "").split("\n") if key is not None else []:
            if eligible(x):
                first[x] = min(first.get(x, key), key)
    known = list(first)
    linked = []
    for i, a in enumerate(known):
        for b in known[:i]:
            k = lines.edits(min(len(a), len(b)))
            if abs(len(a) - len(b)) <= k and distance(a, b) <= k:
                linked.append((a, b))
    root = roots(known, linked)
    keeper = {}
    for x in known:
        keeper[root[x]] = min(keeper.get(root[x], first[x]), first[x])
    out = Counter()
    for key, text in docs:
        if key is None or text is None:
            out[key, text] += 1
            continue
        kept, seen = [], set()
        for x in text.split("\n"):
            if eligible(x):
                if keeper[root[x]] != key or root[x] in seen:
                    continue
                seen.add(root[x])
            kept.append(x)
        out[key, "\n".join(kept)] += 1
    return out, len(linked)


@pytest.mark.parametrize("crowd", [0, 16])
def test_line_dedup_equals_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(lines, "CROWD", crowd)
    docs = line_fixture()
    want, linked = slow_dedup(docs)
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS _gone", "'y' AS line_counts")
    out = lines.dedup(frame)
    assert Counter((r.doc_id, r.text) for r in out.collect()) == want and linked > 100
    assert out.columns == ["doc_id", "text", "_gone", "line_counts", "line_counts_"]
    assert lines.strip(frame).columns == frame.columns


def test_lines_of_one_template_part_by_finer_pieces(spark):
    """Lines with one first half, and the same characters in the second, don't all meet; near ones do."""
    random.seed(8)
    words = [f"{a}{b}" for a in "bcdfg" for b in ("ra", "lo", "mi")]
    known = []
    for _ in range(250):
        random.shuffle(words)
        known.append("the template says as always that " + " ".join(words))
    known += [x[:-1] + "#" for x in known[:40]] + [x[:40] + "_" + x[40:] for x in known[40:80]]
    frame = spark.createDataFrame([(i + 1, i + 1, x) for i, x in enumerate(known)], "h long, root long, line string")
    pairs = lines.met_by_pieces(frame.select("h", "root"), frame.select("h", "line"))
    got = {(min(r), max(r)) for r in pairs.collect()}
    assert {(i + 1, i + 251) for i in range(80)} <= got
    assert pairs.count() < 2 * lines.CROWD * len(known) < len(known) ** 2 / 8


def test_line_dedup_edges(awkward):
    assert lines.query(awkward).count() == awkward.count()
    assert lines.query(awkward.limit(0)).count() == 0


def test_compact_windows_cover_every_subsequence():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 50, 80, dtype=np.uint64)
    windows = passages.compact_windows(values, 7)
    for i in range(80):
        for j in range(i + 6, 80):
            held = [w for w in windows if w[0] <= i <= w[1] <= j <= w[2]]
            assert len(held) == 1 and values[held[0][1]] == values[i:j + 1].min()


def planted(seed=3, pairs=20):
    random.seed(seed)
    filler = [f"w{random.randint(0, 5000)}" for _ in range(60_000)]
    docs = []
    for k in range(pairs):
        passage = [f"p{k}_{i}" for i in range(random.randint(55, 90))]
        for j in range(2):
            own = list(passage)
            if k % 3 == 2 and j:
                own[len(own) // 2] = "other"
            at = random.randint(0, 50_000)
            docs.append((2 * k + j, " ".join(filler[at:at + 150] + own + filler[at + 300:at + 400])))
    return docs + [(900, docs[0][1]), (901, "short text"), (None, docs[0][1]), (902, None)]


def test_passages_find_planted_pairs(spark):
    docs = planted()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = passages.links(frame).collect()
    linked = {(r.doc_id, r.other_doc_id) for r in rows}
    assert {(2 * k + 1, 2 * k) for k in range(20)} <= linked and (900, 0) in linked
    assert not {901, 902} & {x for pair in linked for x in pair}
    words = dict((k, (t or "").lower().split()) for k, t in docs if k is not None)
    for r in rows:
        a, b = words[r.doc_id][r.start:r.end], words[r.other_doc_id][r.other_start:r.other_end]
        x, y = ({tuple(z[i:i + 5]) for i in range(len(z) - 4)} for z in (a, b))
        assert len(a) >= 50 and abs(len(x & y) / len(x | y) - r.similarity) < 1e-9 and r.similarity >= 0.8
    classes = {r.doc_id: r for r in passages.query(frame).collect()}
    assert set(classes) == set(words) and all(classes[2 * k + 1].class_id == classes[2 * k].class_id for k in range(20))
    assert (classes[900].class_id, classes[900].n_copies, classes[901].class_id, classes[901].n_links) == (0, 1, 901, 0)
    assert classes[3].n_links >= 1


def test_passages_link_variants_of_a_template(spark):
    """Texts whose chains are full of others that share shingles, but not the passage: links by brute force."""
    random.seed(13)
    base = [f"t{i}" for i in range(60)]
    docs = []
    for k in range(60):
        own = list(base)
        for at in random.sample(range(60), 2 + k % 3 * 4):
            own[at] = f"v{k}_{at}"
        for j in range(2):
            docs.append((2 * k + j, " ".join([f"a{k}_{j}_{i}" for i in range(40)] + own + [f"b{k}_{j}_{i}" for i in range(40)])))
    sets = [[frozenset(tuple(w[i:i + 5]) for i in range(s, s + n - 4)) for s, n in ((40, 60),)] for w in (t.split() for _, t in docs)]
    want = roots(range(len(docs)), [(i, j) for j in range(len(docs)) for i in range(j)
                                    if len(sets[i][0] & sets[j][0]) >= 0.8 * len(sets[i][0] | sets[j][0])])
    got = {r.doc_id: r.class_id for r in passages.query(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    pairs = [(i, j) for j in range(len(docs)) for i in range(j) if want[i] == want[j]]
    joined = sum(got[i] == got[j] for i, j in pairs)
    assert len(pairs) >= 60 and joined >= 0.95 * len(pairs)


def test_passages_join_all_exact_repeats(sample):
    docs = {r.doc_id: r.text.lower().split() for r in sample.collect()}
    seen, linked = {}, []
    for key, words in docs.items():
        for i in range(len(words) - 49):
            linked.append((key, seen.setdefault(tuple(words[i:i + 50]), key)))
    got = roots(docs, [(r.doc_id, r.other_doc_id) for r in passages.links(sample).collect()])
    assert all(got[a] == got[b] for a, b in linked)


def test_passage_edges(awkward):
    assert {(r.doc_id, r.other_doc_id) for r in passages.links(awkward).collect()} == set()
    assert {(r.doc_id, r.class_id) for r in passages.query(awkward).collect()} == {(i, i) for i in (1, 2, 3, 5, 6, 7, 8)}
    assert passages.query(awkward.limit(0)).count() == 0


def test_aligned_shrinks_to_passages_in_another_order():
    """Y noise P X against X noise P Y: every shared part is an exact passage, none may get lost."""
    x, y, noise, p = ([f"{n}{i}" for i in range(k)] for n, k in (("x", 30), ("y", 30), ("n", 40), ("p", 60)))
    other_noise = [f"m{i}" for i in range(40)]
    one, other = (passages.shingles(" ".join(w).encode()) for w in (y + noise + p + x, x + other_noise + p + y))
    for place in (70, 95, 125):
        found = passages.aligned(one, other, [(place, place)])
        assert found and all(a <= 70 and a + n >= 126 and s >= 0.8 for a, _, n, s in found)
    # A word changed in the passage, and a part that repeats, which the sets of shingles count once.
    changed = p[:30] + ["new"] + p[31:]
    other = passages.shingles(" ".join(x + other_noise + changed + y).encode())
    assert passages.aligned(one, other, [(75, 75)])
    one, other = (passages.shingles(" ".join(w).encode()) for w in (y + noise + p + x * 3, x + other_noise + p + y * 3))
    assert passages.aligned(one, other, [(95, 95)])


def test_aligned_walks_no_place_of_texts_with_too_little_in_common(monkeypatch):
    """40 shingles in common are too few for a passage of 46 at 0.8, 41 are enough to look."""
    def pair(shared):
        part = [f"s{i}" for i in range(shared + 4)]
        return (passages.shingles(" ".join(part + [f"{x}{i}" for i in range(60)]).encode()) for x in "pq")

    walked = []
    monkeypatch.setattr(passages, "_stretches", lambda *args: walked.append(args) or iter(()))
    assert passages.aligned(*pair(40), [(20, 20)]) == [] and not walked
    assert passages.aligned(*pair(41), [(20, 20)]) == [] and len(walked) == 1


@pytest.mark.parametrize("rounds", [0, 2])
def test_passages_compare_all_classes_of_a_chain(spark, monkeypatch, rounds):
    """One chain of 40 texts with a common line; two of them, not next to each other, share a passage around it."""
    line = [f"l{i}" for i in range(8)]
    docs = []
    for k in range(40):
        left, right = ([f"{side}{k}_{i}" for i in range(60)] for side in "xy")
        docs.append((k, " ".join(left + line + right)))
    words = [t.split() for _, t in docs]
    twin = " ".join(words[30][:40] + words[5][40:60] + line + words[5][68:95] + words[30][95:])
    ids = {k: int(np.uint64(xxhash.xxh64_intdigest(t, seed=42)).astype(np.int64)) for k, t in [*docs, (40, twin)] if k != 30}
    order = sorted(ids.values())
    between = order[(place := order.index(ids[5])) + 1: order.index(ids[40])] or order[order.index(ids[40]) + 1: place]
    assert len(between) > 3
    docs = [d for d in docs if d[0] != 30] + [(40, twin)]
    own = passages.texts(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r.doc_id: r.text_id for r in own.collect()} == ids
    chain = [(1, text_id, 60, 60, 60) for text_id in ids.values()]
    monkeypatch.setattr(passages, "chains", lambda own: spark.createDataFrame(
        chain, "chain long, text_id long, centre int, left int, right int"))
    monkeypatch.setattr(passages, "ROUNDS", rounds, raising=False)
    found, _ = passages.passages(own)
    assert {(r.a, r.b) for r in found.collect()} == {(min(ids[5], ids[40]), max(ids[5], ids[40]))}


def test_places_outside_any_stretch_hold_no_passage():
    """The early refusal of a place agrees with the walk around it."""
    random.seed(4)
    for share in (0.8, 0.88, 0.92, 0.97):
        both = np.array([random.random() < share for _ in range(200)])
        promising = passages._promising(both)
        assert [bool(p) for p in promising] == [passages._longest(both, k)[1] >= passages.LEAST for k in range(200)]


def walked(one, other, at):
    """Every place walked by itself, without any refusal before."""
    here, there = np.isin(one, other), np.isin(other, one)
    found = []
    for p, q in sorted(at):
        if any(a <= p < a + n and b <= q < b + n for a, b, n, _ in found):
            continue
        back, ahead = min(p, q), min(len(one) - p, len(other) - q)
        for a, b, size in passages._stretches(one, other, here[p - back: p + ahead] & there[q - back: q + ahead], p, q):
            x, y = set(one[a: a + size].tolist()), set(other[b: b + size].tolist())
            if size >= passages.LEAST and len(x & y) >= passages.SIMILARITY * len(x | y):
                found.append((a, b, size, len(x & y) / len(x | y)))
                break
    return found


def repeating(n_words, kinds):
    """Words that repeat 5 to 30 times each, as in junk texts."""
    words = []
    while len(words) < n_words:
        words += [f"w{random.randrange(kinds)}"] * random.randint(5, 30)
    return words


def test_refused_places_hold_no_passage():
    """Places judged together on a diagonal give what walking each of them gives, with repeats and without."""
    random.seed(7)
    hits = 0
    for k in range(60):
        first, second = repeating(random.randint(60, 160), 4 + k % 5), repeating(random.randint(60, 160), 4 + k % 5)
        if k % 2:
            part = [f"s{i}" for i in range(70)]
            first, second = first + part, part[:30] + ["new"] * (k % 4) + part[30 + k % 3:] + second
        one, other = (passages.shingles(" ".join(w).encode()) for w in (first, second))
        at = [(int(p), int(q)) for p, q in zip(*np.nonzero(one[:, None] == other[None, :]))]
        at = random.sample(at, min(len(at), 300))
        got = passages.aligned(one, other, at)
        assert got == walked(one, other, at)
        hits += bool(got)
    assert 10 < hits < 60


def test_longest_stretches_of_all_places_at_once():
    random.seed(5)
    for share in (0.7, 0.85, 0.9, 0.95):
        both = np.array([random.random() < share for _ in range(200)])
        start, size = passages._spans(both)
        for k in range(200):
            back, longest = passages._longest(both, k)
            assert size[k] == longest and (not longest or start[k] == k - back)


def test_all_classes_are_compared_without_shuffling_places(spark):
    """Texts of repeated words meet at the square of their places: only the texts' pairs are joined, the places follow."""
    random.seed(11)
    texts = [" ".join(repeating(250, 5)) for _ in range(4)]
    own = passages.texts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    rows = [(r.text_id, r.text_id, r.text.encode(), list(range(len(r.text.split()) - 4))) for r in own.collect()]
    dealt = spark.createDataFrame(rows, "text_id long, root long, text binary, centres array<int>").mapInArrow(
        passages._around_batches, "chain long, text_id long, root long, centre int, left int, right int").cache()
    met = passages.across(dealt)
    assert met.columns == ["a", "b"]
    pairs = {(r.a, r.b) for r in met.collect()}
    # The places of a pair are those that its texts' rows share by chain.
    one, other = (dealt.select("chain", *[F.col(c).alias(f"{c}_{x}") for c in ("text_id", "centre", "left", "right")]) for x in "ab")
    overlap = F.least("left_a", "left_b") + F.least("right_a", "right_b") + 1
    want = {}
    for r in one.join(other, "chain").where("text_id_a < text_id_b").where(overlap >= 36).select(
            "text_id_a", "text_id_b", "centre_a", "centre_b").distinct().collect():
        want.setdefault((r[0], r[1]), set()).add((r[2], r[3]))
    assert want and set(want) <= pairs and max(map(len, want.values())) > 1000
    centres = {}
    for r in dealt.select("text_id", "centre").distinct().collect():
        centres.setdefault(r.text_id, []).append(r.centre)
    known = {i: passages._Known(passages.shingles(text), np.array(sorted(centres[i]))) for i, _, text, _ in rows}
    for a, b in pairs:
        places = {(int(p), int(q)) for p, q in zip(*passages._shared_places(known[a], known[b]))}
        assert {z for z in places if passages._dealt_together(known[a].hashes, known[b].hashes, *z)} == want.get((a, b), set())
    got = {(r.a, r.b, r.a_start, r.b_start) for r in passages.verified(met, own, dealt).collect()}
    assert got == {(a, b, p, q) for (a, b), at in want.items() for p, q, _, _ in walked(known[a].hashes, known[b].hashes, at)}


def test_words_of_any_size_are_hashed_at_once():
    """Every size of word, and every kind of gap, gives the hashes of the words one by one."""
    random.seed(17)
    texts = [b"", b" ", b"one two three four", b"A b\x0bC\x0cd\rE\x00 f \x1c g\x85 h", "é😀 Ä ".encode() * 9,
             b" ".join(bytes([97 + k % 26]) * k for k in range(1, 70)), b" \t\n lead A b c d e f "]
    texts += [" ".join(f"{random.getrandbits(random.randint(1, 140)):x}" for _ in range(80)).encode() for _ in range(20)]
    for text, got in zip(texts, passages.shingled(texts), strict=True):
        hashed = [xxhash.xxh64_intdigest(w) for w in text.lower().split()]
        sums = [sum(h * seed for h, seed in zip(hashed[k:], passages._SEEDS)) % 2 ** 64 for k in range(len(hashed) - 4)]
        sums = [(x ^ x >> 32) * passages._SEEDS[0] % 2 ** 64 for x in sums]
        assert got.tolist() == [x ^ x >> 29 for x in sums] == passages.shingles(text).tolist()


def test_windows_of_many_texts_at_once():
    """The windows of texts that lie side by side are the nodes of each text's own trees."""
    random.seed(19)
    texts = [" ".join(repeating(n, kinds)) for n in (50, 51, 120, 700) for kinds in (1, 2, 9, 5000)]
    texts += [" ".join(random.choices("abcdefgh", k=900)), *(" ".join(f"{n}_{i}" for i in range(n)) for n in (50, 97, 400))]
    hashes = [passages.shingles(t.encode()) for t in texts]
    hashes = [h for h in hashes if len(h) >= passages.LEAST]
    got = sorted(zip(*(c.tolist() for c in passages._windows(hashes, np.arange(len(hashes))))))
    want = []
    for k, h in enumerate(hashes):
        side = passages.mixed(h, passages.HASHES) >> np.uint64(33)
        for function in range(passages.HASHES):
            values = passages.mixed(h, function)
            for left, centre, right in passages.compact_windows(values, passages.LEAST):
                want.append((int(values[centre].view(np.int64)), k, centre, centre - left, right - centre,
                             int(side[max(centre - passages._SIDE, 0): centre + 1].min()), int(side[centre: centre + passages._SIDE + 1].min())))
    assert got == sorted(want)


def test_pairs_without_hope_hold_no_passage():
    """Pairs judged together: none that has a passage is turned down, and texts just under the length are."""
    random.seed(23)
    run, known, pairs = [f"r{i}" for i in range(300)], {}, []
    for k in range(40):
        shared = 35 + k
        at = random.randrange(200)
        for j in range(2):
            own = [f"{j}_{k}_{i}" for i in range(random.randint(0, 60))]
            known[2 * k + j] = passages._Known(passages.shingles(" ".join(own + run[at:at + shared] + own[::-1]).encode()))
        pairs.append((2 * k, 2 * k + 1))
    hopeful = passages._hopeful(pairs, known)
    for (a, b), hope in zip(pairs, hopeful):
        one, other = known[a].hashes, known[b].hashes
        at = [(int(p), int(q)) for p, q in zip(*np.nonzero(one[:, None] == other[None, :]))]
        assert hope or not walked(one, other, at)
    assert not hopeful[:6].any() and hopeful[15:].all()


def test_groups_come_whole_and_pairs_of_classes_once(monkeypatch):
    """Portions end where a chain ends, however batches cut it; a chain's pairs are those of different classes."""
    random.seed(29)
    monkeypatch.setattr(passages, "_ROWS", 5)
    rows = sorted((chain, text, text % 7) for chain in range(12) for text in random.sample(range(30), random.choice((1, 2, 3, 17))))
    for size in (1, 4, 1000):
        cut = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[k:k + size])], names=["chain", "text_id", "root"])
               for k in range(0, len(rows), size)]
        portions = [set(columns[0].tolist()) for columns in passages._whole_groups(iter(cut))]
        assert sum(map(len, portions)) == 12
        got = {(a, b) for batch in passages._across_batches(iter(cut)) for a, b in zip(*(c.to_pylist() for c in batch.columns))}
        assert got == {(a, b) for c, a, x in rows for d, b, y in rows if c == d and a < b and x != y}
