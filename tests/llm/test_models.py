"""Toxicity, Katz backoff, byte-level BPE and packing: exact round trips, brute force, held-out accuracy."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from wattspan.llm import bpe, katz, packing, toxicity  # noqa: E402

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN


def test_toxicity_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.query(docs, labels).join(labels, "doc_id").where("held_out").select("score", "predicted", "toxic").collect()
    bad, good = ([r for r in rows if r.toxic == k] for k in (1, 0))
    auc = np.mean([[(b.score > g.score) + 0.5 * (b.score == g.score) for g in good] for b in bad])
    assert auc > 0.9 and sum(r.predicted for r in good) < 0.02 * len(good)
    assert all(0 <= r.score <= 1 for r in rows)


def clause(text, words=None):
    tagger = toxicity.Tagger(toxicity.Grammar(words or {"moron": 1.0}, {"vequ": 0.5}, (0.0,) * 7))
    return toxicity.match(text, tagger)


def test_clause_paths():
    names = dict(zip(toxicity._PATHS, range(6)))

    def path(text):
        return [n for n in toxicity._PATHS[:5] if clause(text)[0][names[n]] > 0]

    assert path("That moron again.") == ["plain"]
    assert path("You total moron!") == ["aimed"]
    assert path("You are not a moron.") == ["negated"]
    assert path("She said, he is here. He said moron") == ["reported"]
    assert path("I will kill you") == ["threat"] and path("I will not kill you") == []
    assert path("vequis la") == ["plain"] and path("Not here. Moron") == ["plain"]
    assert clause("Nice day.\nMoron.\nBye")[1:] == (1, "moron.")


def slow_paths(tags):
    """The grammar's rules word by word, from the positions of all tags."""
    insult, threat, target, negation, report = (1 << k for k in range(5))
    found = [0.0] * 5
    for i, tag in enumerate(tags):
        negated = any(t & negation for t in tags[max(0, i - toxicity.NEGATION_SCOPE):i + 1])
        reported = any(t & report for t in tags[:i + 1])
        near = any(t & target for t in tags[max(0, i - toxicity.TARGET_SCOPE):i + toxicity.TARGET_SCOPE + 1])
        if tag & insult:
            found[3 if reported else 2 if negated else 1 if near else 0] += (tag >> 8) / 1000
        if tag & threat and not negated and any(t & target for t in tags[i + 1:i + toxicity.TARGET_SCOPE + 1]):
            found[3 if reported else 4] += 1.0
    return found


def test_composed_machine_equals_its_rules():
    rng = np.random.default_rng(4)
    for share in (0.15, 0.5):
        for _ in range(3000):
            tags = [int(sum((rng.random() < share) << k for k in range(6))) for _ in range(rng.integers(0, 14))]
            tags = [t | int(rng.integers(1, 1001)) << 8 if t & 1 else t for t in tags]
            assert toxicity.clause_paths(tags) == pytest.approx(slow_paths(tags))


def test_composition_runs_both_transducers_in_turn():
    rng = np.random.default_rng(5)
    tags = tuple(range(512))
    one, other = toxicity.scope(tags, 8, 64, 3), toxicity.scope(tags, 64, 256, 2, itself=False)
    both = toxicity.compose(one, other)
    for _ in range(300):
        s = r = q = 0
        for t in rng.integers(0, 64, 12).tolist():
            s, middle, _ = one.arcs[s, t]
            r, want, _ = other.arcs[r, middle]
            q, got, _ = both.arcs[q, t]
            assert got == want


def test_toxicity_edges(awkward, labels):
    rows = toxicity.query(awkward, labels).collect()
    assert len(rows) == awkward.count() and all(r.predicted == 0 for r in rows)
    kept = toxicity.keep_clean(awkward, labels.limit(0))
    assert kept.columns == awkward.columns and kept.count() == awkward.count()
    assert toxicity.query(awkward.limit(0), labels).count() == 0


def tokens(text):
    return [*(text or "").encode().lower().split(), b""]


def trained(key):
    return key is None or zlib.crc32(str(key).encode()) % 5 != 1


def test_katz_equals_brute_force(spark, sample, monkeypatch):
    monkeypatch.setattr(katz, "CHUNK_TOKENS", 5_000)
    monkeypatch.setattr(katz, "SHARD_TOKENS", 9_000)
    docs = sample.select("doc_id", "text").union(spark.createDataFrame([(9_000, None), (9_001, ""), (None, "a the")], "doc_id long, text string"))
    rows = {r.doc_id: r for r in katz.query(docs).collect()}
    texts = [(r.doc_id, tokens(r.text)) for r in docs.collect()]
    words, pairs = Counter(), Counter()
    for key, own in texts:
        if trained(key):
            words.update(own)
            pairs.update(zip([b"", *own[:-1]], own))
    n, types = sum(words.values()), len(words)

    def of_counts(counts):
        held = Counter(counts.values())
        return [held[r] for r in range(1, katz.DISCOUNTED + 2)]

    unigram, factors = katz.Unigram([n, types, *of_counts(words)]), katz.discounts(of_counts(pairs))

    def p1(word):
        return float(unigram.probability(np.array([words.get(word, 0)]))[0])

    def kept(count):
        return count * (factors[count] if count <= katz.DISCOUNTED else 1.0)

    after = defaultdict(dict)
    for (h, w), count in pairs.items():
        after[h][w] = count
    scale, weight = {}, {}
    for h, seen in after.items():
        total, free = sum(seen.values()), sum(seen.values()) - sum(map(kept, seen.values()))
        scale[h] = 1 / (total + 1) if free <= 1e-9 * total else 1 / total
        weight[h] = (1 / (total + 1) if free <= 1e-9 * total else free / total) / (1 - sum(map(p1, seen)))
    for h in list(after)[:20]:  # both levels sum to one
        unseen = max(1, of_counts(words)[0]) * unigram.unseen + sum(p1(w) for w in words if w not in after[h])
        assert abs(sum(map(kept, after[h].values())) * scale[h] + weight[h] * unseen - 1) < 1e-9
    for key, own in texts:
        score = base = 0.0
        for h, w in zip([b"", *own[:-1]], own):
            count = pairs.get((h, w), 0)
            score += math.log10(kept(count) * scale[h]) if count else math.log10(weight.get(h, 1.0)) + math.log10(p1(w))
            base += math.log10((words.get(w, 0) + 0.5) / (n + 0.5 * (types + 1)))
        got = rows[key]
        assert abs(got.score - score) < 1e-6 * len(own) and abs(got.base_score - base) < 1e-6 * len(own)
        assert (got.n_tokens, got.n_known, got.train_tokens, got.held_out) == (
            len(own), sum(words.get(w, 0) > 0 for w in own), n, not trained(key))
    held = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_katz_edges(awkward):
    assert katz.query(awkward).count() == awkward.count()
    assert katz.query(awkward.limit(0)).count() == 0


TRICKY = ["it's    x\x1c\x1d y\n\n  z 's 日本語テキスト" * 20, "ab" * 5000, " " * 900 + "x", "é😀" * 600, "<|endoftext|> end", "", None]


def test_bpe_equals_the_library(spark, sample):
    tiktoken = pytest.importorskip("tiktoken")
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    docs = sample.select("doc_id", "text").union(spark.createDataFrame([(5_000 + i, t) for i, t in enumerate(TRICKY)], "doc_id long, text string"))
    found = {r.doc_id: r for r in bpe.query(docs, RANKS, PATTERN).collect()}
    for row in docs.collect():
        ids, got = library.encode_ordinary(row.text or ""), found[row.doc_id]
        assert got.n_tokens == len(ids)
        assert got.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got.decoded_sha256 == hashlib.sha256((row.text or "").encode()).hexdigest()


def test_folded_merges_equal_merged_words(sample):
    ranks = bpe.read_ranks(RANKS)
    frequent = bpe.frequent_words(sample, PATTERN, 500)
    rows = frequent.select("word", bpe.fold_merges(frequent["word"], ranks).alias("ids")).collect()
    assert len(rows) == 500 and all(r.ids == bpe.merge(r.word.encode(), ranks) for r in rows)


def test_long_merges_equal_short_ones(monkeypatch):
    ranks = bpe.read_ranks(RANKS)
    rng = np.random.default_rng(1)
    for size in (2, 3, 20, 47):
        word = bytes(rng.choice(list(b"abcdeth "), size).tolist())
        assert bpe._merge_long(word, ranks) == bpe.merge(word, ranks) or word in ranks


def test_bpe_edges(awkward):
    assert bpe.query(awkward, RANKS, PATTERN).count() == awkward.count()
    assert bpe.query(awkward.limit(0), RANKS, PATTERN).count() == 0


def test_packing_ids_and_places(spark, sample):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(JSON)
    library.encode_special_tokens = True
    docs = sample.select("doc_id", "text").union(spark.createDataFrame([(5_000 + i, t) for i, t in enumerate(TRICKY)], "doc_id long, text string"))
    rows = packing.query(docs, JSON, PATTERN).collect()
    by_doc, by_sequence, total = defaultdict(list), defaultdict(list), 0
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for row in docs.collect():
        ids = np.array([*library.encode(row.text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        total += len(ids)
        parts = sorted(by_doc[row.doc_id], key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(len(parts))) and sum(r.length for r in parts) == len(ids)
        assert all(r.length == 1024 for r in parts[1:])
        assert all(zlib.crc32(ids[r.start:r.start + r.length].tobytes()) == r.ids_crc32 for r in parts)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    assert len(by_sequence) <= 1.03 * total / 1024 + 1


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_holds(rule):
    rng = np.random.default_rng(2)
    lengths = np.sort(rng.integers(1, 100, 800))[::-1].astype(np.int64)
    capacity = packing.Capacity(tokens=100, documents=5, attention=10_000, rule=rule)
    sequence, offset = packing.best_fit(lengths, capacity)
    for s in np.unique(sequence):
        own = lengths[sequence == s]
        assert own.sum() <= 100 and len(own) <= 5 and (own ** 2).sum() <= capacity.attention
        assert sorted(offset[sequence == s]) == sorted(np.cumsum(own) - own)
    tight = packing.Capacity(tokens=100, documents=100, attention=9_900, rule=rule)
    sequence, _ = packing.best_fit(np.full(40, 20), packing.Capacity(tokens=100, documents=100, attention=850, rule=rule))
    assert np.bincount(sequence).max() == 2  # the attention capacity binds before the tokens do
    with pytest.raises(ValueError):
        packing.best_fit(np.array([100]), tight)


def test_packing_edges(awkward):
    rows = packing.query(awkward, JSON, PATTERN).collect()
    assert len({r.doc_id for r in rows}) == awkward.select("doc_id").distinct().count()
    assert packing.query(awkward.limit(0), JSON, PATTERN).count() == 0
