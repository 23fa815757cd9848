"""The pipeline's stages on a small corpus, and its registration."""

import random

import corpus_pipeline
from wattspan.llm import queries, simhash
from wattspan.session import materialise


def test_every_operator_is_registered():
    names = {n.split("_")[0] for n in queries.registered()}
    assert names == {f"op{i}" for i in range(1, 14)}


def test_stages_keep_columns_and_decide(spark, sf_dir):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"test-{name}")
        assert docs.columns == columns and docs.count() <= before
        before = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert packed.select("doc_id").distinct().count() == before


def test_stages_take_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0


def test_near_dedup_keeps_the_least_of_every_simhash_component(spark, awkward):
    """Copies with a few words changed: the stage keeps what brute force over fingerprints keeps."""
    random.seed(11)
    docs = []
    for k in range(60):
        words = [f"k{k}_{random.randint(0, 400)}" for _ in range(random.randint(120, 260))]
        for copy in range(5):
            own = list(words)
            for at in random.sample(range(len(own)), copy):
                own[at] = f"new{random.random()}"
            docs.append((5 * k + copy, " ".join(own)))
    prints = [simhash.fingerprint(t.encode()) for _, t in docs]
    label = list(range(len(docs)))
    for j in range(len(docs)):
        for i in range(j):
            if (prints[i] ^ prints[j]).bit_count() <= 4 and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS _doc_id", "2 AS fp")
    kept = corpus_pipeline.STAGES[2][1](spark, frame, "")
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, x in enumerate(label) if i == x}
    assert 60 < len(set(label)) < 290
    assert corpus_pipeline.STAGES[2][1](spark, awkward, "").where("doc_id IS NULL").count() == 1
