"""Personal data, quality rules and fingerprints against brute force in plain Python."""

import hashlib
import re
import threading

import pytest

from wattspan.llm import fingerprints, pii, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def luhn(number):
    doubled = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(reversed(number))]
    return sum(v - 9 if v > 9 else v for v in doubled) % 10 == 0


def base_spans(text):
    kinds = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    out = []
    for kind, pattern in kinds.items():
        for m in re.finditer(pattern, text) if kind != "email" or "@" in text else []:
            figures = re.sub("[^0-9]", "", m.group(0))
            good = {"email": True, "phone": 8 <= len(figures) <= 15,
                    "ip": kind == "ip" and all(int(p) <= 255 for p in m.group(0).split(".")),
                    "card": 16 <= len(figures) <= 19 and luhn(figures)}[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


HARD = ("a@b.c_d@e.fx and 1.2.3.4.5.6.7.8 300.1.1.1 007.1.1.1 \u0001 IBAN DE89 3704 0044 0532 0130 00 ok 😀 x@y.zz "
        "call 555-123-4567 ssn 123-45-6789 4111 1111-1111 1111 +1 (456) 555-2186")


def test_pii_base_spans(spark, sample, awkward):
    extra = spark.createDataFrame([(10_000, HARD), (10_001, "x@y.zz " * 700)], "doc_id long, text string")
    docs = sample.select("doc_id", "text").union(extra).union(awkward.select("doc_id", "text").where("doc_id > 5").dropDuplicates(["doc_id"]).selectExpr("doc_id + 20000", "text"))
    found = {r.doc_id: r for r in pii.query(docs).collect()}
    for row in docs.collect():
        got = found[row.doc_id]
        want = base_spans(row.text or "")
        assert got.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert got.spans.startswith(want)
    assert "iban:" in found[10_000].spans and "ssn:" in found[10_000].spans and "tel:" in found[10_000].spans


def test_pii_redaction_and_edges(spark, awkward):
    docs = spark.createDataFrame([(1, HARD, 0), (2, None, 0)], "doc_id long, text string, n_chars long")
    rows = {r.doc_id: r for r in pii.redact(docs).collect()}
    assert rows[1].text.startswith("[EMAIL][EMAIL] and [IP].[IP] 300.1.1.1 [IP] \u0001 IBAN [IBAN] ok 😀 [EMAIL]")
    assert rows[1].n_chars == len(rows[1].text) and rows[2].text is None
    assert pii.query(awkward).count() == awkward.count()
    assert pii.query(awkward.limit(0)).count() == 0
    assert pii.redact(awkward).columns == awkward.columns
    assert {r.pii for r in pii.redact(awkward).collect()} == {r.pii for r in awkward.collect()}


def repeats(words):
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i:i + 8]), []).append(i)
    return len({k for at in places.values() if len(at) > 1 for i in at for k in range(i, i + 8)})


def test_quality_base_figures(spark, sample, labels):
    found = {r.doc_id: r for r in quality.query(sample, labels).collect()}
    for row in sample.collect():
        words, lines = WORD.findall(row.text), row.text.split("\n")
        duplicate = sum(bool(WORD.search(x)) and x in lines[:i] for i, x in enumerate(lines))
        got = found[row.doc_id]
        assert (got.n_words, got.word_chars, got.n_symbols, got.n_dup_lines, got.n_repeat_words) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", row.text)), duplicate, repeats(words))
        assert got.base_failed == (len(words) < 20 or 100 * repeats(words) > 30 * len(words))
        assert not (got.base_failed and got.kept)


def ends_within(spark, seconds, frame):
    """Rows of the frame; its jobs are cancelled, and the test fails, after the time."""
    timer = threading.Timer(seconds, spark.sparkContext.cancelAllJobs)
    timer.start()
    try:
        return frame.collect()
    finally:
        timer.cancel()


@pytest.mark.parametrize("name,condition", [
    ("op3", "NOT base_failed"), ("op3", "n_repeat_words > 0 AND kept"), ("op8", "n_email > 0"),
    ("op10", "near_edited > 0.5"), ("op10", "near_next < 0.2"),
])
def test_native_operators_end_under_a_filter(spark, sample, labels, name, condition):
    made = {"op3": lambda: quality.query(sample, labels), "op8": lambda: pii.query(sample),
            "op10": lambda: fingerprints.query(sample)}[name]()
    all_rows = {r.doc_id: r for r in ends_within(spark, 120, made)}
    rows = ends_within(spark, 120, made.where(condition))
    assert rows and all(all_rows[r.doc_id] == r for r in rows)
    few = made.select("doc_id", made.columns[-1])
    assert len(ends_within(spark, 120, few)) == len(all_rows)


def test_quality_verdict_follows_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    judged = quality.query(docs, labels).join(labels, "doc_id").where("NOT base_failed").select("kept", "quality")
    rows = ends_within(spark, 240, judged)
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_quality_edges(awkward, labels):
    rows = quality.query(awkward, labels).collect()
    assert len(rows) == awkward.count() and all(r.kept is False for r in rows if r.n_words < 20)
    assert quality.query(awkward.limit(0), labels).count() == 0
    assert all(r.llr == 0 for r in quality.query(awkward, labels.limit(0)).collect())


def shingle_set(text):
    words = text.split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_estimate_similarity(sample):
    found = {r.doc_id: r for r in fingerprints.query(sample).collect()}
    docs = sorted((r.doc_id, r.text) for r in sample.collect())
    off, by_text = [], {}
    for i, (key, text) in enumerate(docs):
        after = docs[(i + 1) % len(docs)][1]
        cut = len(text) // 4
        edited = text[:len(text) - cut] + after[:cut]
        got = found[key]
        assert got.n_chars == len(text) and got.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(text, got.fingerprint) == got.fingerprint
        assert len(got.fingerprint) == fingerprints.BINS * fingerprints.BITS // 4
        off += [got.near_edited - jaccard(shingle_set(text), shingle_set(edited)),
                got.near_next - jaccard(shingle_set(text), shingle_set(after))]
    assert abs(sum(off) / len(off)) < 0.01 and (sum(x * x for x in off) / len(off)) ** 0.5 < 0.05


def test_fingerprint_edges(awkward):
    rows = fingerprints.query(awkward).collect()
    assert len(rows) == awkward.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].fingerprint == "" == by_id[3].fingerprint and by_id[1].near_next == 1.0
    assert by_id[None].near_next == 0.0 and by_id[6].near_edited > 0
    assert fingerprints.query(awkward.limit(0)).count() == 0


@pytest.mark.parametrize("size", [1, 255, 256, 257, 1000])
def test_running_starts(spark, size):
    from pyspark.sql import functions as F

    from wattspan.llm.common import running_starts

    got = spark.range(1).select(running_starts(F.sequence(F.lit(1), F.lit(size))).alias("s")).first().s
    assert got == [i * (i + 1) // 2 for i in range(size)]


def test_every_trusted_document_is_counted(spark):
    """Where all documents are trusted, both multinomials are the same, however many there are."""
    docs = spark.range(25_000).selectExpr("id AS doc_id", "'one word more' AS text")
    rows = quality.query(docs, docs.selectExpr("doc_id", "1 AS quality", "0 AS toxic"))
    assert rows.where("llr = 0").count() == 25_000
